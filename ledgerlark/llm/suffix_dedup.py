"""Removal of repeated passages by threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes if a string of `depth` bytes over it also starts anywhere else. Each such string (window) has a
least gram, its anchor; equal windows have equal anchors, so the windows of one anchor can be judged
apart from all others. Runs of windows with one anchor are carried together, as a segment. Anchors
that occur once are dropped after a count; a fixed-size bit map of the others goes to the scan, which
lets some single ones through. Equal segments of an anchor become one string with a count. The strings
are then joined in chunks of whole anchors; on each chunk's transform, breadth-first backward extension
derives common prefixes by increasing length and stops at `depth`: suffixes whose neighbours are still
unknown then are repeated. An anchor with a single distinct string needs no transform. An anchor with
more than HOT bytes of distinct strings (edges of a passage that very many documents share) would not fit one
task; its windows are counted one by one under 128 bits of hash, which is exact and deals them out.

Defined results: null texts count as empty; texts under `depth` bytes lose nothing; matches never cross
documents; repeated rows are copies of each other and go as a whole if they have `depth` bytes; other
columns are kept by removed() and left out by digests(); a null doc_id is an id like any other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import U64, Scratch, byte_keys, gram_hashes, mixed, pieces, texts
from ledgerlark.llm.toxicity import powers

DEPTH, GRAM = 200, 32
#: Bytes of one anchor's distinct strings that a task takes; bytes of a chunk (both together stay below 2 million); bits of the anchors' map.
HOT, CHUNK, MAP_BITS = 1_750_000, 1 << 18, 1 << 24


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each width adjacent values."""
    have, length = h, 1
    while length * 2 <= width:
        have = np.minimum(have[:-length], have[length:])
        length *= 2
    rest = width - length
    return np.minimum(have[: len(have) - rest], have[rest:]) if rest else have

def segments(data: np.ndarray, offsets: np.ndarray, depth: int = DEPTH, gram: int = GRAM, most: int = 2048):
    """(row, start, windows, anchor, loops) of each run of windows with the same least gram; start counts from the row's.

    loops: the least gram stands in the run more than once, without which no two of its windows can be equal.
    """
    none = np.zeros(0, np.int64)
    if len(data) < depth:
        return none, none, none, np.zeros(0, U64), np.zeros(0, bool)
    grams, reach = gram_hashes(data, gram), depth - gram
    least = sliding_min(grams, reach + 1)
    n = len(least)
    fits = np.zeros(len(data) + 1, np.int64)  # windows that end within their row
    size = np.diff(offsets)
    long = size >= depth
    np.add.at(fits, offsets[:-1][long], 1)
    np.add.at(fits, offsets[1:][long] - depth + 1, -1)
    inside = np.cumsum(fits)[:n] > 0
    fresh = np.ones(n, bool)
    fresh[1:] = least[1:] != least[:-1]
    fresh[offsets[:-1][(offsets[:-1] < n)]] = True
    fresh[1:] |= ~inside[:-1]
    at = np.flatnonzero(fresh & inside)
    stop = np.ones(n, bool)
    stop[:-1] = fresh[1:] | ~inside[1:]
    count = np.flatnonzero(stop & inside) + 1 - at
    row = np.searchsorted(offsets, at, "right") - 1
    anchor = least[at]
    # If two windows of a run are equal, the gram at some window's start and that at another's end are the anchor at different places.
    opens, closes = np.flatnonzero((grams[:n] == least) & inside), np.flatnonzero((grams[reach:] == least) & inside)
    run = np.searchsorted(at, np.concatenate([opens, closes]), "right") - 1
    place = np.concatenate([opens, closes + reach])
    low, high = np.full(len(at), len(data)), np.full(len(at), -1)
    np.minimum.at(low, run, place)
    np.maximum.at(high, run, place)
    loops = high > low
    if count.max(initial=0) > most:
        parts = -(-count // most)
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        row, anchor, loops = np.repeat(row, parts), np.repeat(anchor, parts), np.repeat(loops, parts)
        at, count = np.repeat(at, parts) + k * most, np.minimum(np.repeat(count, parts) - k * most, most)
    return row, at - offsets[row], count, anchor, loops


def suffix_order(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array by the first `depth` symbols at least, and its inverse; ends: places of the (distinct) end marks."""
    n = len(data)
    rank = data.astype(np.int64) + len(ends)
    rank[ends] = np.arange(len(ends))
    bits = int(max(n, len(ends) + 256)).bit_length()
    if bits > 21:
        raise ValueError("a chunk holds 2 million symbols at most")
    known = 1
    while True:
        key = rank << (2 * bits)
        key[:-known] |= rank[known:] << bits
        key[: -2 * known] |= rank[2 * known :]
        order = np.argsort(key)
        known *= 3
        sorted_key = key[order]
        fresh = np.ones(n, np.int64)
        fresh[0] = 0
        fresh[1:] = sorted_key[1:] != sorted_key[:-1]
        values = np.cumsum(fresh)
        rank = np.empty(n, np.int64)
        rank[order] = values
        if known >= depth or values[-1] == n - 1:
            break
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return order, place


def long_prefixes(data: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array, and of each entry whether it shares `depth` symbols at least with the entry before it.

    Intervals of the transform are extended backward, breadth first: an interval of a string of length l yields
    those of the strings one symbol longer; where such an interval ends, the common prefix with the next entry
    is l, if it isn't known to be less, and only then the interval is followed. Lengths come out in increasing order, so at
    `depth` the entries without a known length are those that share more.
    """
    n = len(data)
    order, place = suffix_order(data, ends, depth)
    symbol = data.astype(np.int16)
    symbol[ends] = -1
    before = np.where(order > 0, order - 1, n - 1)
    jump = place[before]  # the transform's backward extension: where the entry with the symbol before stands
    first = symbol[order]
    owner = np.zeros(n, np.int32)
    open_ = np.ones(n + 1, bool)
    open_[0] = open_[n] = False
    low, high = np.zeros(1, np.int64), np.full(1, n - 1, np.int64)
    for _ in range(depth):
        size = high - low + 1
        total = int(size.sum())
        if not total:
            break
        # The targets of an interval's entries with one symbol before them are one interval, apart from all others.
        if total == len(low):
            new_low = new_high = jump[low]
        else:
            entry = np.arange(total) + np.repeat(low - (np.cumsum(size) - size), size)
            target = jump[entry]
            owner[target] = np.repeat(np.arange(len(low), dtype=np.int32), size)
            target.sort()
            mine, lead = owner[target], first[target]
            apart = (mine[1:] != mine[:-1]) | (lead[1:] != lead[:-1]) | (lead[1:] < 0)  # an end mark is like no other
            new_low, new_high = target[np.r_[True, apart]], target[np.r_[apart, True]]
        fresh = open_[new_high + 1]
        new_low, new_high = new_low[fresh], new_high[fresh]
        open_[new_high + 1] = False
        low, high = new_low, new_high
    return order, open_[:n]


def keyed(docs: DataFrame) -> DataFrame:
    """The documents with a key of id and text, so that repeated ids stay apart."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.withColumns({"__k": F.xxhash64("doc_id", text), "__k2": F.hash(text, "doc_id")})


def bit_map(column: str, bits: int) -> tuple[Column, Column]:
    """Word number and bit of a hash's place in a map."""
    return F.shiftright(F.col(column).bitwiseAND(F.lit(bits - 1)), 6), F.expr(f"shiftleft(1L, cast(({column} & {bits - 1}) & 63 as int))")


def anchor_map(rows: DataFrame, depth: int) -> np.ndarray:
    """The bit map of all anchors that occur twice at least, in one run or in several."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(0))
            for lo, hi in pieces(offsets):
                _, _, _, anchor, loops = segments(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], depth)
                anchor, n = np.unique(np.concatenate([anchor, anchor[loops]]), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(n.astype(np.int32))], ["anchor", "n"])

    counted = rows.select("text").mapInArrow(count, "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    word, bit = bit_map("anchor", MAP_BITS)
    out = np.zeros(MAP_BITS // 64, np.int64)
    for r in counted.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("bits")).collect():
        out[r["w"]] = r["bits"]
    return out.view(U64)


def flagged_segments(rows: DataFrame, flags: np.ndarray, depth: int) -> DataFrame:
    """Segments of flagged anchors; their text is sent with the first of equals of a batch alone."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(2))
            k, k2 = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sent = np.zeros(0, U64)
            for lo, hi in pieces(offsets):
                part, at = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
                row, start, count, anchor, loops = segments(part, at, depth)
                place = (anchor & U64(MAP_BITS - 1)).astype(np.int64)
                keep = (flags[place >> 6] >> (place & 63).astype(U64)) & U64(1) == 1
                row, start, count, anchor, loops = row[keep], start[keep], count[keep], anchor[keep], loops[keep]
                if not len(row):
                    continue
                up, down = powers(len(part))
                total = np.zeros(len(part) + 1, U64)
                np.cumsum(byte_keys(23)[part] * up, out=total[1:])
                begin = at[row] + start
                end = begin + count + depth - 1
                seg = mixed((total[end] - total[begin]) * down[begin] + (end - begin).astype(U64))
                both = mixed(anchor ^ (seg * U64(3)))
                distinct, first = np.unique(both, return_index=True)
                new = ~np.isin(distinct, sent)
                sent = np.concatenate([sent, distinct[new]])
                body: list[bytes | None] = [None] * len(row)
                for i in first[new].tolist():
                    body[i] = part[begin[i] : end[i]].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64)), pa.array(k[lo + row]), pa.array(k2[lo + row]), pa.array(start.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(loops), pa.array(body, pa.binary())],
                    ["anchor", "seg", "k", "k2", "start", "windows", "loops", "body"],
                )

    return rows.select("__k", "__k2", "text").mapInArrow(cut, "anchor long, seg long, k long, k2 int, start int, windows int, loops boolean, body binary")


def runs_of(flags: np.ndarray) -> list[int]:
    """First and last place of each run of true values, flattened."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False].astype(np.int8)))
    edge[1::2] -= 1
    return edge.tolist()


def repeated_runs(bodies: list[bytes], counts: list[int], depth: int) -> list[list[int]]:
    """Runs of repeated windows of each string: equal to another window of the strings, or of a string counted twice."""
    sizes = np.array([len(b) + 1 for b in bodies])
    data = np.frombuffer(b"".join(b + b"\0" for b in bodies), np.uint8)
    ends = np.cumsum(sizes) - 1
    order, shares = long_prefixes(data, ends, depth)
    repeated = np.zeros(len(data), bool)
    repeated[order[shares | np.r_[shares[1:], False]]] = True
    out = []
    for a, b, n in zip((ends - sizes + 1).tolist(), ends.tolist(), counts, strict=True):
        windows = max(0, b - a - depth + 1)
        out.append([0, windows - 1] if n > 1 and windows else runs_of(repeated[a : a + windows]))
    return out


def judged(strings: DataFrame, depth: int) -> DataFrame:
    """(anchor, seg, runs) of the strings with repeated windows; an anchor's strings meet in one chunk."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        size = 0

        def close() -> pa.RecordBatch:
            runs = repeated_runs([h[3] for h in held], [h[2] for h in held], depth)
            good = [i for i, r in enumerate(runs) if r]
            return pa.RecordBatch.from_arrays([pa.array([held[i][0] for i in good], pa.int64()), pa.array([held[i][1] for i in good], pa.int64()), pa.array([runs[i] for i in good], pa.list_(pa.int32()))], ["anchor", "seg", "runs"])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= CHUNK and row[0] != held[-1][0]:
                    yield close()
                    held, size = [], 0
                held.append(row)
                size += len(row[3]) + 1
        if held:
            yield close()

    dealt = strings.select("anchor", "seg", "count", "body").repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(work, "anchor long, seg long, runs array<int>")


def windows_of(strings: DataFrame, depth: int) -> DataFrame:
    """Every window of the strings under two hashes."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for anchor, seg, count, body in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(body, np.uint8)
                w1, w2 = gram_hashes(data, depth, 31), gram_hashes(data, depth, 37)
                n = len(w1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)), pa.array(np.full(n, anchor)), pa.array(np.full(n, seg)), pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, count))],
                    ["w1", "w2", "anchor", "seg", "at", "count"],
                )

    return strings.select("anchor", "seg", "count", "body").mapInArrow(work, "w1 long, w2 long, anchor long, seg long, at int, count long")


def repeats(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(k, k2, spans): byte spans [start, end) to remove, unmerged, of the keyed documents that have any."""
    scratch = Scratch(docs.sparkSession, "suffix")
    rows = keyed(docs).select("__k", "__k2", F.col("text").cast("string").alias("text"))
    members = scratch.save(flagged_segments(rows, anchor_map(rows, depth), depth), "members")
    given = F.col("body").isNotNull()
    distinct = members.groupBy("anchor", "seg").agg(F.count(F.lit(1)).alias("count"), F.min(F.when(given, F.struct("k", "k2", "start", "windows"))).alias("one"), F.max("loops").alias("loops"))
    distinct = scratch.save(distinct, "distinct")
    shared = distinct.groupBy("anchor").agg(F.sum("count").alias("total"), F.count(F.lit(1)).alias("strings"), F.sum(F.col("one.windows") + depth).alias("bytes"), F.max("loops").alias("any")).filter("total > 1 or any")
    strings = scratch.save(distinct.join(shared, "anchor").select("anchor", "seg", "count", "strings", "bytes", "one.k", "one.k2", "one.start"), "strings")
    scratch.drop("distinct")
    single = (F.col("strings") == 1) & (F.col("count") > 1)
    alone = strings.filter(single).select("anchor", "seg", F.lit(None).cast("array<int>").alias("runs"))
    several = strings.filter(~single).join(members.filter(given).select("anchor", "seg", "k", "k2", "start", "body"), ["anchor", "seg", "k", "k2", "start"])
    light = scratch.save(judged(several.filter(F.col("bytes") <= HOT), depth), "light")
    hot = scratch.save(windows_of(several.filter(F.col("bytes") > HOT), depth), "windows")
    twice = hot.groupBy("w1", "w2").agg(F.sum("count").alias("n")).filter("n > 1").select("w1", "w2")
    heavy = hot.join(twice, ["w1", "w2"]).groupBy("anchor", "seg").agg(F.flatten(F.collect_list(F.array("at", "at"))).alias("runs"))
    found = alone.unionByName(light).unionByName(heavy)
    start = F.col("start")
    spans = F.when(F.col("runs").isNull(), F.array(F.struct(start.alias("s"), (start + F.col("windows") + (depth - 1)).alias("e")))).otherwise(
        F.transform(F.sequence(F.lit(0), (F.size("runs") / 2).cast("int") - 1), lambda i: F.struct((start + F.get("runs", i * 2)).alias("s"), (start + F.get("runs", i * 2 + 1) + depth).alias("e")))
    )
    placed = members.select("anchor", "seg", "k", "k2", "start", "windows").join(found, ["anchor", "seg"]).select("k", "k2", spans.alias("spans"))
    out = scratch.save(placed.groupBy("k", "k2").agg(F.flatten(F.collect_list("spans")).alias("spans")), "spans")
    scratch.drop("members", "strings", "light", "windows")
    return out


def merged(starts: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
    """Overlapping and touching spans joined."""
    order = np.argsort(starts, kind="stable")
    out: list[list[int]] = []
    for s, e in zip(starts[order].tolist(), ends[order].tolist(), strict=True):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def rest_of(body: bytes, spans: list[tuple[int, int]]) -> bytes:
    last, kept = 0, []
    for s, e in spans:
        kept.append(body[last:s])
        last = e
    return b"".join([*kept, body[last:]])


def whole_characters(body: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans shrunk to whole UTF-8 characters."""
    out = []
    for s, e in spans:
        while s < e and body[s] & 0xC0 == 0x80:
            s += 1
        while e > s and e < len(body) and body[e] & 0xC0 == 0x80:
            e -= 1
        if s < e:
            out.append((s, e))
    return out


def with_spans(docs: DataFrame, depth: int) -> DataFrame:
    """The keyed documents with their spans; texts without any keep null."""
    found = repeats(docs, depth).select(F.col("k").alias("__fk"), F.col("k2").alias("__fk2"), F.col("spans.s").alias("__s"), F.col("spans.e").alias("__e"))
    rows = keyed(docs)
    return rows.join(found, (rows["__k"] == found["__fk"]) & (rows["__k2"] == found["__fk2"]), "left").drop("__fk", "__fk2", "__k", "__k2")


def bodies(batch: pa.RecordBatch, text: int, starts: int, ends: int) -> Iterator[tuple[bytes, list[tuple[int, int]]]]:
    for t, s, e in zip(batch.column(text).to_pylist(), batch.column(starts).to_pylist(), batch.column(ends).to_pylist(), strict=True):
        yield (t or "").encode("utf-8"), merged(np.array(s), np.array(e)) if s else []


def digests(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, n, digest = [], [], [], []
            for body, spans in bodies(batch, 1, 2, 3):
                size.append(len(body))
                gone.append(sum(e - s for s, e in spans))
                n.append(len(spans))
                digest.append(hashlib.sha256(rest_of(body, spans)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(n, pa.int64()), pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_spans(rows, depth).select("doc_id", "text", "__s", "__e").mapInArrow(work, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def removed(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """The documents with their repeated passages cut out, to whole characters; all rows and columns are kept."""
    names = docs.columns
    at = names.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [rest_of(body, whole_characters(body, spans)).decode("utf-8") if spans else None for body, spans in bodies(batch, at, len(names), len(names) + 1)]
            old = batch.column(at).to_pylist()
            columns = [*batch.columns[: len(names)]]
            columns[at] = pa.array([o if n is None else n for o, n in zip(old, out, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(columns, names)

    return with_spans(docs, depth).select(*names, "__s", "__e").mapInArrow(work, docs.schema)
