"""Benchmark decontamination by the q-gram lemma in overlapping diagonal bands.

Benchmark items and documents are normalised (lower case, runs of anything but letters, digits and
non-ASCII bytes become one space). Every passage of WINDOW bytes of an item is a window, at each offset (an item
under WINDOW bytes is one window); a window within EDITS edit operations of a region of a document shares at least
len - Q + 1 - Q * EDITS of its q-grams with it, on diagonals that lie within one of two overlapping
bands. A document's q-grams are looked up in the index of the items' q-grams, shared ones are counted along each
(item, band) for all windows at once, and windows that meet the bound are verified: equal bytes are distance 0, else
banded alignment gives the smallest edit distance of the window to any substring of the band's region. A document with
a verified window is contaminated. Items under LEAST bytes must stand in a document whole and unedited between word borders.

The benchmark is the query set: it is gone through in blocks of at most BLOCK_BYTES, each held by every
task, and every block meets all documents. All texts of an id are in one block, so its results come together within a
task. Documents aren't shuffled.

Defined results: null or empty texts and items match nothing; a border of words is a space of the normalised text or an
end of it, and an item under LEAST bytes counts as one window; repeated documents are each judged; all different texts of an item_id are
passages of one item, and each different text without an id is an item of its own, with a null item_id; other columns are kept by flag() and left out by regions().
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import U64, Scratch, gram_hashes, pieces, texts

Q, WINDOW, EDITS, LEAST = 12, 96, 5, 40
#: Diagonals of a band: twice the width of a region's, and as many edits on either side.
BAND = 2 * (2 * EDITS + 1) + 2 * EDITS
BLOCK_BYTES = 1_000_000
_same = np.full(256, 32, np.uint8)
_same[[*range(48, 58), *range(97, 123), *range(128, 256)]] = [*range(48, 58), *range(97, 123), *range(128, 256)]
_same[65:91] = np.arange(97, 123)


def normalised(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, their offsets, and for each normalised byte its place in the input; each row begins with a space."""
    mapped = _same[data]
    second = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    mapped[1:][second] += 0x20
    keep = mapped != 32
    space = ~keep
    space[1:] &= keep[:-1]
    starts = offsets[:-1][offsets[:-1] < len(data)]
    space[starts] = ~keep[starts]
    at = np.flatnonzero(keep | space)
    return mapped[at], np.searchsorted(at, offsets), at


def owner(item: int | None, number: int) -> tuple[bool, int]:
    """What results are gathered by: the item_id, or for a text without one its number in the block."""
    return (True, number) if item is None else (False, item)


class Index:
    """Q-grams of a block of items, each held once with its place in `body`, the items' normalised bytes one after the other."""

    def __init__(self, items: list[tuple[int | None, str]]):
        data, offsets = texts(pa.array([t for _, t in items], pa.large_string()))
        norm, cuts, _ = normalised(data, offsets)
        ids, owners, bodies, short = [], [], [], {}
        for k, (item, _) in enumerate(items):
            text = norm[cuts[k] : cuts[k + 1]]
            while len(text) and text[-1] == 32:
                text = text[:-1]
            while len(text) and text[0] == 32:
                text = text[1:]
            if len(text) < LEAST:
                if len(text):
                    short.setdefault(len(text), {}).setdefault(text.tobytes(), []).append(owner(item, k))
                continue
            ids.append(item)
            owners.append(owner(item, k))
            bodies.append(text)
        self.owners = owners
        # By length: the short items' bytes in order, and the owners of each.
        self.short = {n: (np.array(sorted(by), f"S{n}"), [by[t] for t in sorted(by)]) for n, by in short.items()}
        lengths = np.array([len(t) for t in bodies], np.int64)
        self.body = np.concatenate(bodies) if bodies else np.zeros(0, np.uint8)
        self.starts = np.concatenate([[0], np.cumsum(lengths)])
        # By item: size and edit budget of its windows, shared q-grams that a window needs, number of windows, number of the first.
        self.size = np.minimum(lengths, WINDOW)
        self.budget = np.minimum(EDITS, (self.size - Q) // Q)
        self.bound = self.size - Q + 1 - Q * self.budget
        self.many = lengths - self.size + 1
        self.first_window = np.cumsum(self.many) - self.many
        self.ids, self.n_windows = ids, int(self.many.sum())
        h = gram_hashes(self.body, Q)
        place = np.arange(len(h))
        within = place + Q <= self.starts[np.searchsorted(self.starts, place, "right")] if len(h) else np.zeros(0, bool)
        h, place = h[within], place[within]
        order = np.argsort(h, kind="stable")
        self.place = place[order].astype(np.int32)
        self.keys, first, count = np.unique(h[order], return_index=True, return_counts=True)
        self.first, self.count = first.astype(np.int32), count.astype(np.int32)
        bits = max(16, int(len(self.keys) * 32).bit_length())
        self.mask = U64((1 << bits) - 1)
        # A bit map, in bytes: whether any key ends in these bits.
        self.maybe = np.zeros(1 << bits - 3, np.uint8)
        place = (self.keys & self.mask).astype(np.int64)
        np.bitwise_or.at(self.maybe, place >> 3, (1 << (place & 7)).astype(np.uint8))

    @property
    def items(self) -> np.ndarray:
        """The item_id of each window."""
        return np.repeat(np.array(self.ids, object), self.many)

    @property
    def budgets(self) -> np.ndarray:
        return np.repeat(self.budget, self.many)

    @property
    def windows(self) -> Iterator[np.ndarray]:
        """The bytes of all windows, in the order of their numbers."""
        for start, many, size in zip(self.starts.tolist(), self.many.tolist(), self.size.tolist(), strict=False):
            for at in range(start, start + many):
                yield self.body[at : at + size]

    def hits(self, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in the text, place in the items' bytes) of all shared q-grams."""
        if not len(self.keys) or len(norm) < Q:
            return (np.zeros(0, np.int64),) * 2
        h = gram_hashes(norm, Q)
        spot = (h & self.mask).astype(np.int64)
        at = np.flatnonzero(self.maybe[spot >> 3] >> (spot & 7).astype(np.uint8) & 1)
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        same = self.keys[k] == h[at]
        at, k = at[same], k[same]
        n = self.count[k].astype(np.int64)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(at, n), self.place[np.repeat(self.first[k], n) + inner].astype(np.int64)

    def candidates(self, norm: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, item's number, window's place in the items' bytes, band's lowest diagonal, a hit's diagonal) of windows that meet the bound."""
        at, place = self.hits(norm)
        row = np.searchsorted(cuts, at, "right") - 1
        inside = at + Q <= cuts[row + 1]
        at, place, row = at[inside], place[inside], row[inside]
        # Bands of twice the width of a region's diagonals, each overlapping the next by half.
        width = 2 * EDITS + 1
        band = (at - place) // width
        at, place, row, band = np.tile(at, 2), np.tile(place, 2), np.tile(row, 2), np.concatenate([band, band - 1])
        order = np.lexsort((at, place, band, row))
        at, place, row, band = at[order], place[order], row[order], band[order]
        item = np.searchsorted(self.starts, place, "right") - 1
        other = np.ones(len(at), bool)  # whether another row, band or item begins here
        other[1:] = (row[1:] != row[:-1]) | (band[1:] != band[:-1]) | (item[1:] != item[:-1])
        # A q-gram of the item counts once in a band however often the text repeats it there.
        new = other.copy()
        new[1:] |= place[1:] != place[:-1]
        at, place, row, band, item, group = at[new], place[new], row[new], band[new], item[new], np.cumsum(other)[new]
        # The bound's number of q-grams from hit i on lies within the windows from low to high; both rise with i in a group.
        i = np.arange(len(at))
        j = i + self.bound[item] - 1
        fits = j < len(at)
        i, j = i[fits], j[fits]
        fits = (group[i] == group[j]) & (place[j] - place[i] <= self.size[item[i]] - Q)
        i, j = i[fits], j[fits]
        k = item[i]
        low = np.maximum(place[j] - (self.size[k] - Q), self.starts[k])
        high = np.minimum(place[i], self.starts[k] + self.many[k] - 1)
        again = group[i][1:] == group[i][:-1]
        low[1:][again] = np.maximum(low[1:][again], high[:-1][again] + 1)
        n = np.maximum(high - low + 1, 0)
        start = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        i = np.repeat(i, n)
        return row[i], item[i], start, band[i] * width, at[i] - place[i]

    def verified(self, norm: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, window, distance) of windows within their edit budgets of the row's text, each once with the smallest distance."""
        row, item, start, low, diagonal = self.candidates(norm, cuts)
        window = self.first_window[item] + start - self.starts[item]
        size = self.size[item]
        base = start + low - EDITS
        distance = np.full(len(row), EDITS + 1, np.int64)
        for n in np.unique(size).tolist():
            mine = np.flatnonzero(size == n)
            for part in np.array_split(mine, len(mine) // 4096 + 1):
                whole = part[(start[part] + diagonal[part] >= cuts[row[part]]) & (start[part] + diagonal[part] + n <= cuts[row[part] + 1])]
                spot = start[whole][:, None] + np.arange(n)
                distance[whole[(self.body[spot] == norm[spot + diagonal[whole][:, None]]).all(axis=1)]] = 0
            # What stands verbatim in one band needs no alignment in the other.
            key = row * self.n_windows + window
            mine = mine[~np.isin(key[mine], key[mine[distance[mine] == 0]])]
            for part in np.array_split(mine, len(mine) // 512 + 1) if len(mine) else []:
                distance[part] = nearest(self.body[start[part][:, None] + np.arange(n)], norm, base[part], cuts[row[part]], cuts[row[part] + 1])
        good = np.flatnonzero(distance <= self.budget[item])
        good = good[np.lexsort((distance[good], window[good], row[good]))]
        first = np.ones(len(good), bool)
        first[1:] = (row[good][1:] != row[good][:-1]) | (window[good][1:] != window[good][:-1])
        good = good[first]
        return row[good], window[good], distance[good]


    def whole(self, norm: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, tuple[bool, int]]]:
        """(row, owner) of each row and short item that stands in it between word borders."""
        if not self.short:
            return
        space = norm == 32
        border = np.zeros(len(norm) + 1, bool)
        border[cuts] = True
        border[:-1] |= space
        border[1:] |= space
        begins = np.flatnonzero(border[:-1] & ~space)
        row = np.searchsorted(cuts, begins, "right") - 1
        for n, (known, owners) in self.short.items():
            fits = np.flatnonzero(begins + n <= cuts[row + 1])
            fits = fits[border[begins[fits] + n]]
            found = norm[begins[fits][:, None] + np.arange(n)].view(f"S{n}")[:, 0]
            k = np.minimum(np.searchsorted(known, found), len(known) - 1)
            same = known[k] == found
            for r, j in dict.fromkeys(zip(row[fits[same]].tolist(), k[same].tolist(), strict=True)):
                for who in owners[j]:
                    yield r, who


def nearest(windows: np.ndarray, norm: np.ndarray, base: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The smallest edit distance of each window to a substring of norm[low:high] along its band of diagonals.

    Cell (i, k) stands after i bytes of the window and at place base + i + k of the text: only the band's BAND diagonals are
    kept, whatever the window's length. What lies outside the text is like no byte, so that it costs what leaving out costs.
    """
    k = np.arange(BAND)
    row = np.zeros((len(base), BAND), np.int16)
    steps = k.astype(np.int16)
    for i in range(windows.shape[1]):
        at = base[:, None] + i + k
        there = (at >= low[:, None]) & (at < high[:, None])
        new = row + ~(there & (norm[np.clip(at, 0, len(norm) - 1)] == windows[:, i : i + 1]))
        new[:, :-1] = np.minimum(new[:, :-1], row[:, 1:] + 1)  # a byte of the window is left out: the diagonal below
        row = np.minimum.accumulate(new - steps, axis=1) + steps  # bytes of the text are left out along the row
    return row.min(axis=1).astype(np.int64)


def blocks(benchmark: DataFrame, most: int = BLOCK_BYTES) -> Iterator[list[tuple[int | None, str]]]:
    """The items' texts in blocks of at most `most` bytes; an item over that alone. One block at a time is held."""
    block, size = [], 0
    rows = benchmark.select("item_id", F.col("text").cast("string").alias("text")).filter("text is not null")
    rows = enumerate(rows.distinct().orderBy("item_id", "text").toLocalIterator())
    for _, item in groupby(rows, lambda x: owner(x[1]["item_id"], x[0])):
        passages = [(r["item_id"], r["text"]) for _, r in item]
        more = sum(len(t.encode("utf-8")) for _, t in passages)
        if block and size + more > most:
            yield block
            block, size = [], 0
        block += passages
        size += more
    if block:
        yield block


def regions(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_windows (verified ones), distance (the smallest), of each contaminated document and item."""
    schema = "doc_id long, item_id long, n_windows long, distance long"
    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = None
    for block in blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(block)  # BLOCK_BYTES at most, or one item

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                ids = batch.column(0)
                data, offsets = texts(batch.column(1))
                for lo, hi in pieces(offsets):
                    yield pa.RecordBatch.from_pylist([{**r, "doc_id": ids[lo + r["row"]].as_py()} for r in judged(index, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])], FOUND)

        part = chosen.mapInArrow(work, schema)
        found = part if found is None else found.unionByName(part)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_windows", pa.int64()), ("distance", pa.int64())])


def judged(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[dict]:
    """One entry for each row and item with a verified region."""
    if not len(data):
        return []
    norm, cuts, _ = normalised(data, offsets)
    best: dict[tuple[int, tuple[bool, int]], list[int]] = {}
    row, window, distance = index.verified(norm, cuts)
    passage = np.searchsorted(index.first_window, window, "right") - 1
    for r, p, d in zip(row.tolist(), passage.tolist(), distance.tolist(), strict=True):
        best.setdefault((r, index.owners[p]), []).append(d)
    for r, who in index.whole(norm, cuts):
        best.setdefault((r, who), []).append(0)
    return [{"row": r, "item_id": None if bare else i, "n_windows": len(ds), "distance": min(ds)} for (r, (bare, i)), ds in sorted(best.items())]


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a verified region of any item, all columns kept.

    Of a benchmark of several blocks, each block's pass is written down before the next, so that a worker holds one block's index.
    """
    columns = docs.columns
    at = columns.index("text")
    out, scratch, last = docs, None, None
    for number, block in enumerate(blocks(benchmark)):
        if number:
            scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
            out = scratch.save(out, f"pass-{number}")
            if last:
                scratch.drop(last)
            last = f"pass-{number}"
        shared = docs.sparkSession.sparkContext.broadcast(block)  # BLOCK_BYTES at most, or one item

        def work(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value)
            for batch in batches:
                data, offsets = texts(batch.column(at))
                keep = np.ones(batch.num_rows, bool)
                for lo, hi in pieces(offsets):
                    for r in judged(index, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]):
                        keep[lo + r["row"]] = False
                yield batch.filter(pa.array(keep))

        out = out.mapInArrow(work, docs.schema)
    return out
