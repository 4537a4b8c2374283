"""N-gram Jaccard join: a size-aware heavy-light set similarity join, and the components of its links.

A document's set holds the hashes of its distinct word shingles. Equal sets are one class, joined once
through its smallest doc_id. Two different sets of similarity t share, under any common order of
shingles, one of the first n - ceil(t n) + 1 shingles of each, and two of the first n - ceil(t n) + 2.
Light (small) sets are keyed by all subsets of two of the latter, heavy (large) sets stand in the
inverted list of each of the former; sets just above the boundary do both, since they may meet light
ones. The boundary is where the rows of subsets and the scans of lists, counted over all sets, cost least together.

The order is by rarity: shingles of the first part of the hash range (HEAD) by the number of documents that hold them,
then all others by hash. A shingle of one document alone meets nothing, so sets with many shingles of their own have
few keys or none. A list's key names a band of sizes too: the larger set of a pair is at home in its band, a
smaller one visits the next band as well. The place of a shared shingle in the order bounds what two sets can share behind
it, and so how large the other set may be.

A list's members are not paired with each other. First each round verifies one member (the centre)
of every list against the others of different components, merges components, and takes the centre off the
list; lists within one component are done, so copies cost one verification each. Bucket counts of the sets bound
what two of them can share; pairs that this rules out are dropped, the others are verified exactly.
When rounds no longer halve what is left, the lists that are still open are scanned in tasks of at most two
blocks of BLOCK members: first each member's NEAREST others by that bound are verified, which connects dense groups, then all
pairs that are still not connected and not ruled out. No link between components is
lost: every pair of a list is settled by a link, a connection, a bound or a test.

Defined results: null and empty texts and texts without words have size 0 and are linked with nothing;
a document of fewer words than a shingle has its whole word sequence as the one element; repeated rows
are one class; rows of one doc_id with different texts are one node of the links, whose rows keep their own sizes; rows with a
null doc_id take no part in join() and all stay in keep_one(); other columns are left out by join() and kept by keep_one(); no documents
give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.common import U64, Scratch, byte_keys, mixed, pieces, texts, word_cuts
from ledgerlark.llm.components import components
from ledgerlark.llm.toxicity import powers

#: Times the share of a set that its keys are at most (1 - t), the part of the hash range whose shingles are counted.
HEAD = 1.4
#: Members of a list's block, and rounds of centres at most before the rest is settled in blocks.
BLOCK, MOST_ROUNDS = 1024, 4
#: Others of a member that are verified before all pairs are.
NEAREST = 2
#: Entries of a list that are scanned at the cost of one entry written and shuffled.
SCANNED = 512
#: Bits of the map of documents whose sets are read again, for each of them, and at most (16 MB); others that the map lets through are joined away.
BITS_EACH, MOST_BITS = 16, 1 << 27
#: Buckets of a set's sketch.
BUCKETS = 512
_space = np.zeros(256, bool)
_space[[0x20, *range(0x09, 0x0E)]] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def word_hashes(data: np.ndarray, offsets: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word, and each row's first word; long texts are gone through in slices that end between words."""
    low = _lower[data]
    gap = _space[low]
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    starts, hashes = [], []
    keys = byte_keys(seed)
    for lo, hi in word_cuts(gap, edges):
        word = ~gap[lo:hi]
        begins = word.copy()
        begins[1:] &= ~word[:-1] | edges[lo + 1 : hi]
        ends = word.copy()
        ends[:-1] &= ~word[1:] | begins[1:]
        start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        up, down = powers(hi - lo)
        total = np.zeros(hi - lo + 1, U64)
        np.cumsum(keys[low[lo:hi]] * up, out=total[1:])
        hashes.append(mixed((total[stop] - total[start]) * down[start]))
        starts.append(start + lo)
    start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    return np.concatenate(hashes) if hashes else np.zeros(0, U64), np.searchsorted(start, offsets)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int, seed: int) -> list[np.ndarray]:
    """Each row's sorted distinct shingle hashes."""
    none = np.zeros(0, U64)
    if not len(data):
        return [none] * (len(offsets) - 1)
    h, at = word_hashes(data, offsets, seed)
    run = np.zeros(max(len(h) - width + 1, 0), U64)
    for k in range(width):
        run += h[k : k + len(run)] * U64(pow(0x9E3779B97F4A7C15, k + 1, 1 << 64))
    run = mixed(run)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            part = np.sort(run[a : b - width + 1])
            out.append(part[np.r_[True, part[1:] != part[:-1]]])
        elif b > a:
            mark = np.array([b - a], U64)
            for x in h[a:b]:
                mark = mixed(mark + x)
            out.append(mark)
        else:
            out.append(none)
    return out


def class_of(items: np.ndarray) -> np.ndarray:
    """The set's first hash."""
    return np.add.reduce(mixed(items))


def least_overlap(n: np.ndarray | int, percent: int):
    """The fewest shared elements of a set of n with any similar set: ceil(t n)."""
    return -(-n * percent // 100)


def head_limit(percent: int) -> np.uint64:
    """Hashes from here on aren't counted."""
    return U64(min(int(HEAD * (100 - percent) / 100 * 2**64), 2**64 - 1))


def bands(percent: int) -> np.ndarray:
    """The first size of each band; a similar larger set is in the same band or in the next."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(out[-1] * 100 // percent + 1)
    return np.array(out)


def per_document(docs: DataFrame, width: int, seed: int, schema: str, of_sets) -> DataFrame:
    """What of_sets(ids, sets) gives of each slice of the documents (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(1))
            ids = batch.column(0).to_numpy().astype(np.int64)
            for lo, hi in pieces(offsets):
                yield of_sets(ids[lo:hi], shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], width, seed))

    return docs.mapInArrow(work, schema)


def described(docs: DataFrame, width: int, seed: int, percent: int) -> DataFrame:
    """doc_id, size of its set, two hashes of the set, elements in the head of the hash range."""
    limit = head_limit(percent)

    def of_sets(ids: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        h1 = np.array([class_of(s) for s in sets], U64)
        h2 = np.array([class_of(s ^ U64(0xA5A5A5A5A5A5A5A5)) for s in sets], U64)
        n = np.array([len(s) for s in sets], np.int32)
        head = np.array([np.searchsorted(s, limit) for s in sets], np.int32)
        return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), pa.array(head)], ["doc_id", "n", "h1", "h2", "head"])

    return per_document(docs, width, seed, "doc_id long, n int, h1 long, h2 long, head int", of_sets)


def leading(items: np.ndarray, percent: int, limit: np.uint64) -> np.ndarray:
    """The elements that may be keys: all of the head, and others as far as keys may reach."""
    n = len(items)
    return items[: max(int(np.searchsorted(items, limit)), n - int(least_overlap(n, percent)) + 2)]


def counted(docs: DataFrame, width: int, seed: int, percent: int) -> DataFrame:
    """(token, count) of possible keys, summed over a slice."""
    limit = head_limit(percent)

    def of_sets(ids: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate([leading(s, percent, limit) for s in sets]) if sets else np.zeros(0, U64)
        token, count = np.unique(every, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(count.astype(np.int32))], ["token", "count"])

    return per_document(docs, width, seed, "token long, count int", of_sets)


def possible_keys(docs: DataFrame, width: int, seed: int, percent: int) -> DataFrame:
    """(token, cls) of possible keys; equal sets of a slice count once."""
    limit = head_limit(percent)

    def of_sets(ids: np.ndarray, sets: list[np.ndarray]) -> pa.RecordBatch:
        distinct = {int(class_of(s)): s for s in sets if len(s)}
        lead = [leading(s, percent, limit) for s in distinct.values()]
        token = np.concatenate(lead) if lead else np.zeros(0, U64)
        cls = np.repeat(np.array(list(distinct), U64), [len(x) for x in lead])
        return pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(cls.view(np.int64))], ["token", "cls"])

    return per_document(docs, width, seed, "token long, cls long", of_sets)


def placed(tokens: np.ndarray, count: np.ndarray, n: int, head: int, percent: int, limit: np.uint64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a set's shared possible keys those within reach: (token, place in the common order, documents that hold it).

    The set's elements in the head that are not given are its own alone and come before the given ones.
    """
    reach = n - int(least_overlap(n, percent)) + 2
    inside = tokens < limit
    order = np.lexsort((tokens, np.where(inside, count, 0), ~inside))
    tokens, count, shared = tokens[order], count[order], int(inside.sum())
    # Outside the head the order is by hash; elements there that aren't given only move the others back, which may keep more keys than needed.
    place = np.arange(len(tokens)) + np.where(np.arange(len(tokens)) < shared, head - shared, max(head - shared, 0))
    keep = place < reach
    return tokens[keep], place[keep], count[keep]


def keys_of(tokens: np.ndarray, place: np.ndarray, n: int, percent: int, light: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a set from its placed tokens, and the largest set that each may stand for."""
    need = int(least_overlap(n, percent))
    largest = n * 100 // percent
    if n == need and largest == n:  # nothing but an equal set is similar
        return np.zeros(0, U64), np.zeros(0, np.int64)
    key, most = [], []
    if need >= 2 and n * percent <= light * 100:
        i, j = np.triu_indices(len(tokens), 1)
        key.append(mixed(tokens[i] * U64(0xD1342543DE82EF95) + tokens[j]))
        most.append(np.full(len(i), largest))
    if n > light or need < 2:
        within = place < n - need + 1
        key.append(tokens[within])
        # With `place` elements before the first shared one, at most n - place are shared.
        most.append(np.minimum((n - place[within]) * (100 + percent) // percent - n, largest))
    return np.concatenate(key), np.concatenate(most).astype(np.int64)


def prefixes(possible: DataFrame, shared: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(cls, id, n, tokens, places, counts) of each class with keys: a row is bounded by its document."""
    limit = head_limit(percent)
    grouped = possible.join(shared, "token").groupBy("cls").agg(F.collect_set(F.struct("token", "count")).alias("held")).join(classes.select("cls", F.col("rep").alias("id"), "n", "head"), "cls")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(3)
            at = held.offsets.to_numpy()
            token, count = (x.to_numpy(zero_copy_only=False)[at[0] :] for x in (held.values.field(0), held.values.field(1)))
            at = at - at[0]
            out = [placed(token[a:b].astype(np.int64).view(U64), count[a:b], n, head, percent, limit) for a, b, n, head in zip(at[:-1].tolist(), at[1:].tolist(), batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True)]
            lists = [[np.ascontiguousarray(o[k]).view(np.int64) if k == 0 else o[k].astype(np.int64) for o in out] for k in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *(pa.array(x, pa.list_(pa.int64())) for x in lists)], ["cls", "id", "n", "tokens", "places", "counts"])

    kind = "array<long>"
    return grouped.select("cls", "id", "n", "held", "head").mapInArrow(work, f"cls long, id long, n int, tokens {kind}, places {kind}, counts {kind}").filter(F.size("tokens") > 0)


def cheapest_boundary(costs: list[tuple[int, float, float]], percent: int) -> int:
    """The largest light size for which subsets of small sets and lists of large ones cost least together.

    costs: (largest size, rows of subsets, rows and scans of lists) of groups of sets. Sets above the boundary, but not by
    more than a similar set's share, pay both.
    """
    def cost(light: int) -> float:
        return sum((pairs if n * percent <= light * 100 else 0) + (lists if n > light else 0) for n, pairs, lists in costs)

    return min([0, *(n for n, _, _ in costs)], key=lambda b: (cost(b), b))


def boundary(held: DataFrame, percent: int) -> int:
    """The boundary from the counts of all sets; sizes are grouped by eighths of a doubling, so few rows come to the driver."""
    group = F.floor(F.log2(F.col("n").cast("double")) * 8)
    many = F.size("tokens").cast("double")
    scans = F.aggregate("counts", F.lit(0).cast("long"), lambda a, c: a + c).cast("double")
    rows = held.groupBy(group.alias("g")).agg(F.max("n").alias("n"), F.sum(many * (many - 1) / 2).alias("pairs"), F.sum(many + scans / SCANNED).alias("lists")).collect()
    return cheapest_boundary([(r["n"], r["pairs"], r["lists"]) for r in rows], percent)


def postings(held: DataFrame, percent: int, light: int) -> DataFrame:
    """(key, id, cls, n, most, home): a set's entry in each list of its own band (home), and of the next where a larger set may be."""
    first = bands(percent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cls, ids, sizes = (batch.column(k).to_numpy() for k in range(3))
            parts = []
            for i, n in enumerate(sizes.tolist()):
                tokens, place = batch.column(3)[i].values.to_numpy().view(U64), batch.column(4)[i].values.to_numpy()
                key, most = keys_of(tokens, place, n, percent, light)
                band = int(np.searchsorted(first, n, "right")) - 1
                up = most >= first[band + 1]
                for step, some in ((0, np.ones(len(key), bool)), (1, up)):
                    parts.append((mixed(key[some] + U64((band + step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)), most[some], i, step == 0))
            times = [len(p[0]) for p in parts]
            row = np.repeat([p[2] for p in parts], times).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array((np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, U64)).view(np.int64)),
                    pa.array(ids[row]),
                    pa.array(cls[row]),
                    pa.array(sizes[row]),
                    pa.array((np.concatenate([p[1] for p in parts]) if parts else np.zeros(0)).astype(np.int64)),
                    pa.array(np.repeat([p[3] for p in parts], times).astype(bool)),
                ],
                ["key", "id", "cls", "n", "most", "home"],
            )

    return held.select("cls", "id", "n", "tokens", "places").mapInArrow(work, "key long, id long, cls long, n int, most long, home boolean")


def sketch(items: np.ndarray) -> np.ndarray:
    """How many elements fall into each bucket of the hash: no two sets share more than the sum of the buckets' minima."""
    return np.minimum(np.bincount((items >> U64(24)).astype(np.int64) & (BUCKETS - 1), minlength=BUCKETS), 65535).astype(np.uint16)


def element_sets(docs: DataFrame, width: int, seed: int, wanted: DataFrame, whole: bool) -> DataFrame:
    """(cls, items), or (cls, sketch) if not whole, once for each class in wanted (id, cls).

    A bit map of the ids, put together on the executors, leaves most other documents out before they are shingled.
    """
    name, kind = ("items", "array<long>") if whole else ("sketch", "binary")
    wanted = wanted.distinct()
    bits = 1 << max(16, min((wanted.count() * BITS_EACH).bit_length(), MOST_BITS.bit_length() - 1))
    flags = flagged(wanted, bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy().astype(np.int64)
            bit = (mixed(ids.view(U64)) & U64(bits - 1)).astype(np.int64)
            some = np.flatnonzero((flags.value[bit >> 6] >> (bit & 63).astype(U64)) & U64(1))
            if not len(some):
                continue
            data, offsets = texts(batch.column(1).take(pa.array(some)))
            for lo, hi in pieces(offsets):
                sets = [s for s in shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], width, seed) if len(s)]
                if sets:
                    if whole:
                        body = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, sets)]), pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                    else:
                        body = pa.array([sketch(s).tobytes() for s in sets])
                    yield pa.RecordBatch.from_arrays([pa.array(np.array([class_of(s) for s in sets], U64).view(np.int64)), body], ["cls", name])

    rows = docs.mapInArrow(work, f"cls long, {name} {kind}").join(wanted.select("cls").distinct(), "cls", "left_semi")
    return rows.groupBy("cls").agg(F.any_value(name).alias(name))


def flagged(ids: DataFrame, bits: int):
    """The bit map of the ids, as a broadcast of bits / 8 bytes."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = np.unique((mixed(batch.column(0).to_numpy().astype(np.int64).view(U64)) & U64(bits - 1)).astype(np.int64))
            word, first = np.unique(bit >> 6, return_index=True)
            both = np.bitwise_or.reduceat(U64(1) << (bit & 63).astype(U64), first) if len(bit) else np.zeros(0, U64)
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(both.view(np.int64))], ["w", "bits"])

    rows = ids.select("id").mapInArrow(words, "w long, bits long").groupBy("w").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return ids.sparkSession.sparkContext.broadcast(out.view(U64))


def distinct_lists(rows: DataFrame) -> DataFrame:
    """Of lists with the same members one stays, with the largest bounds that any of them sets: they would all settle the same pairs."""
    entry = ["cls", "home"]
    marks = rows.groupBy("key").agg(F.bit_xor(F.xxhash64(*entry)).alias("x"), F.bit_xor(F.xxhash64(*entry, F.lit(7))).alias("y"), F.count(F.lit(1)).alias("m"))
    keep = marks.withColumn("kept", F.min("key").over(Window.partitionBy("x", "y", "m"))).select("key", "kept")
    same = [c for c in rows.columns if c not in ("key", "most", "c")]
    return rows.join(keep, "key").groupBy(F.col("kept").alias("key"), *same).agg(F.max("most").alias("most"))


def fitting(n: Column, most: Column, other_n: Column, other_most: Column) -> Column:
    """Whether a list's key can be the first that two sets of these sizes share."""
    return (n <= other_most) & (other_n <= most)


def not_ruled_out(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, a_cls, b, b_cls) whose sketches allow similarity."""
    for side in "ba":
        pairs = pairs.join(sketches.select(F.col("cls").alias(f"{side}_cls"), F.col("sketch").alias(f"{side}_sketch")), f"{side}_cls")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2048):
                part = batch.slice(lo, 2048)
                x, y = (np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint16).reshape(-1, BUCKETS) for k in (4, 5))
                most = np.minimum(x, y).sum(1, dtype=np.int64)
                keep = most * 100 >= (x.sum(1, dtype=np.int64) + y.sum(1, dtype=np.int64) - most) * percent
                yield pa.RecordBatch.from_arrays(part.columns[:4], ["a", "a_cls", "b", "b_cls"]).filter(pa.array(keep))

    return pairs.select("a", "a_cls", "b", "b_cls", "a_sketch", "b_sketch").mapInArrow(work, "a long, a_cls long, b long, b_cls long")


def tested(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs (a, a_cls, b, b_cls) that are similar, by exact intersection."""
    for side in "ba":
        pairs = pairs.join(sets.select(F.col("cls").alias(f"{side}_cls"), F.col("items").alias(f"{side}_items")), f"{side}_cls")
    shared = F.size(F.array_intersect("a_items", "b_items"))
    return pairs.filter(shared * 100 >= (F.size("a_items") + F.size("b_items") - shared) * percent).select("a", "b").distinct()


def centre_pairs(rest: DataFrame) -> DataFrame:
    """Each list's centre with its members of other components; a pair counts once for all its lists."""
    rows = rest.filter(fitting(F.col("n"), F.col("most"), F.col("c.n"), F.col("c.most")) & (F.col("component") != F.col("c.component")))
    return rows.select(F.col("c.id").alias("a"), F.col("c.cls").alias("a_cls"), F.col("id").alias("b"), F.col("cls").alias("b_cls")).distinct()


def possible_pairs(rows: dict[str, np.ndarray], sketches: np.ndarray, percent: int, nearest: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one list's members, one at home at least, in different components, whose sketches don't rule similarity out; of two blocks, those between them. Of each member all, or the nearest."""
    n, most, home, component, block = (rows[k] for k in ("n", "most", "home", "component", "own"))
    two = len(np.unique(block)) > 1
    left, right = [], []
    for i in range(len(n) - 1):
        j = np.arange(i + 1, len(n))
        j = j[(n[j] <= most[i]) & (n[i] <= most[j]) & (component[j] != component[i]) & (home[i] | home[j]) & ((block[j] != block[i]) if two else True)]
        if len(j):
            share = np.minimum(sketches[i], sketches[j]).sum(1, dtype=np.int64)
            near = share * 100 >= (n[i] + n[j] - share) * percent
            j, share = j[near], share[near]
            if nearest is not None and len(j) > nearest:
                j = j[np.argsort(-share / (n[i] + n[j] - share), kind="stable")[:nearest]]
            left.append(np.full(len(j), i))
            right.append(j)
    none = np.zeros(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def left_pairs(rest: DataFrame, sketches: DataFrame, percent: int, nearest: int | None) -> DataFrame:
    """(a, a_cls, b, b_cls) of all pairs (or each member's nearest) of each list that may be similar and aren't connected, found in tasks of one or two blocks."""
    blocks = F.ceil(F.col("members") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("cls"), blocks).cast("int")
    names = ["id", "cls", "n", "most", "home", "component", "own"]
    rows = rest.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), *names)
    held = rows.join(sketches, "cls").select("key", "i", "j", *names, "sketch")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def pairs(table: pa.Table) -> pa.RecordBatch:
            cols = {k: table[k].to_numpy() for k in names}
            counts = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, BUCKETS)
            a, b = possible_pairs(cols, counts, percent, nearest)
            i, c = cols["id"], cols["cls"]
            swap = c[a] > c[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)
            return pa.RecordBatch.from_arrays([pa.array(i[a]), pa.array(c[a]), pa.array(i[b]), pa.array(c[b])], ["a", "a_cls", "b", "b_cls"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            if kept is not None:
                table = pa.concat_tables([kept, table])
            marks = [table.column(k).to_numpy() for k in range(3)]
            edge = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1
            for lo, hi in zip([0, *edge.tolist()], edge.tolist(), strict=False):
                yield pairs(table.slice(lo, hi - lo))
            kept = table.slice(edge[-1] if len(edge) else 0)
        if kept is not None and kept.num_rows:
            yield pairs(kept)

    dealt = held.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return dealt.mapInArrow(work, "a long, a_cls long, b long, b_cls long").distinct()


def open_lists(lists: DataFrame, found: DataFrame | None) -> DataFrame:
    """The entries of lists that hold different components and a member at home, with the list's centre (a member at home) and size."""
    now = lists.withColumn("component", F.col("id")) if found is None else lists.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    centre = F.min(F.when(F.col("home"), F.struct("cls", "id", "n", "most", "component"))).alias("c")
    heads = now.groupBy("key").agg(centre, F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("members"), F.min("n").alias("least"), F.max("most").alias("largest"))
    # An entry goes if even the smallest other set is too large for it, or no other may stand for one of its size.
    return now.join(heads.filter("low < high and c is not null").drop("low", "high"), "key").filter("most >= least and n <= largest").drop("least", "largest")


def classes_and_links(docs: DataFrame, width: int = 4, percent: int = 85, seed: int = 17) -> tuple[DataFrame, DataFrame, Scratch]:
    """(doc_id, n, rep) of every document, (id, component) of the representatives that are linked, and where they are written."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter("doc_id is not null")
    while True:
        members = scratch.save(described(rows, width, seed, percent), f"described-{seed}")
        classes = members.filter("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"), F.any_value("head").alias("head"))
        classes = scratch.save(classes.select(F.col("h1").alias("cls"), "h2", "n", "rep", "head"), f"classes-{seed}")
        facts = classes.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("cls").alias("distinct")).first()
        if facts["n"] == facts["distinct"]:
            break
        scratch.drop(f"described-{seed}", f"classes-{seed}")
        seed += 1  # two sets shared a hash: other hashes
    docs_of = members.join(classes.select(F.col("cls").alias("h1"), "h2", "rep"), ["h1", "h2"], "left").select("doc_id", "n", "rep")
    # An id with several texts joins their classes.
    several = docs_of.filter("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    found = scratch.save(docs_of.join(several, "doc_id").filter("rep <> low").select(F.col("rep").alias("a"), F.col("low").alias("b")).distinct(), "same-id")
    found = None if found.isEmpty() else scratch.save(components(found, scratch, "cc-id"), "found-id")

    shared = scratch.save(counted(rows, width, seed, percent).groupBy("token").agg(F.sum("count").alias("count")).filter("count > 1"), "counts")
    held = scratch.save(prefixes(possible_keys(rows, width, seed, percent), shared, classes, percent), "prefixes")
    scratch.drop("counts")
    entries = scratch.save(postings(held, percent, boundary(held, percent)), "postings")
    lists = scratch.save(open_lists(entries, None).drop("c", "members", "component"), "shared")
    scratch.drop("prefixes", "postings")
    lists = scratch.save(distinct_lists(lists), "unlike")
    scratch.drop("shared")
    sketches = scratch.save(element_sets(rows, width, seed, lists.select("id", "cls"), False), "sketches")

    size, turn, way = None, 0, "centres"
    while True:
        rest = scratch.save(open_lists(lists, found), f"rest-{turn}")
        before, size = size, rest.count()
        if not size:
            break
        if way == "nearest":
            way = "all"
        elif turn == MOST_ROUNDS or (before is not None and size > before / 2):
            way = "nearest"
        pairs = not_ruled_out(centre_pairs(rest), sketches, percent) if way == "centres" else left_pairs(distinct_lists(rest), sketches, percent, NEAREST if way == "nearest" else None)
        pairs = scratch.save(pairs, f"pairs-{turn}")
        # Whole sets are read again for the pairs that are left alone.
        ends = pairs.select(F.col("a").alias("id"), F.col("a_cls").alias("cls")).unionByName(pairs.select(F.col("b").alias("id"), F.col("b_cls").alias("cls")))
        sets = scratch.save(element_sets(rows, width, seed, ends, True), f"sets-{turn}")
        links = scratch.save(tested(pairs, sets, percent), f"links-{turn}")
        if not links.isEmpty():
            every = links if found is None else links.unionByName(found.select(F.col("id").alias("a"), F.col("component").alias("b")))
            found = scratch.save(components(every, scratch, f"cc-{turn}"), f"found-{turn}")
        scratch.drop(f"links-{turn}", f"pairs-{turn}", f"sets-{turn}", f"rest-{turn - 1}")
        if way == "all":
            break
        # A centre has met its whole list.
        lists = rest.filter((F.col("cls") != F.col("c.cls")) | F.lit(way != "centres")).select("key", "id", "cls", "n", "most", "home")
        turn += 1
    if found is None:
        found = spark.createDataFrame([], "id long, component long")
    scratch.drop("sketches", "unlike")
    return docs_of, found, scratch


def join(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of each document."""
    members, found, _ = classes_and_links(docs, width, percent)
    labelled = members.join(found.withColumnRenamed("id", "rep"), "rep", "left")
    return labelled.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.coalesce("component", "rep", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents of which each component keeps the one with the smallest id; those without words all stay."""
    found = join(docs, width, percent)
    gone = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
