"""Quality by a linear-chain conditional random field over a document's lines.

Each line is labelled good or bad from its own features and those of the lines before and after it, with
transition weights between adjacent labels. Forward-backward gives every line's marginal; the marginals,
weighted by line length, average to the document's quality, which a one-variable logistic fit turns
into a probability. Lines inherit their document's label for fitting, in numpy, on a bounded sample
(SAMPLE documents of at most LONGEST bytes and MOST_LINES lines); scoring reads every whole text, long ones by slices and blocks of
lines, with the same result.

Defined results: a null text counts as empty; an empty text has one empty line; without labels of both
kinds every score is the share of label 1 (1, if there are none); repeated rows score alike; other
input columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import U64, byte_keys, pieces, texts
from ledgerlark.llm.sampling import label_of, sample_ids, sample_texts
from ledgerlark.llm.toxicity import powers

#: Bounds of the fitting sample.
SAMPLE, LONGEST, MOST_LINES = 3000, 100_000, 400
#: Bytes and lines of a slice whose features are held at a time.
SLICE, LINES = 1 << 20, 1 << 16
KINDS, AGAIN = 10, 21
_kind = np.zeros(256, np.int64)
_kind[65:91], _kind[97:123], _kind[48:58], _kind[[9, 32]], _kind[128:] = 1, 2, 3, 4, 9
_kind[ord("|")], _kind[ord("!")] = 5, 6
_kind[[*b"#$%&*@^~=+<>{}[]\\/_"]], _kind[[*b".,;:?'\"()-"]] = 7, 8


def lines_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each line and its row; a newline ends a line, and each row has one line at least."""
    breaks = np.flatnonzero(data == 10)
    start = np.concatenate([offsets[:-1], breaks + 1])
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1])
    rank = np.lexsort((start, row))  # empty rows and a newline at a row's end share places
    start, row = start[rank], row[rank]
    end = np.empty(len(start), np.int64)
    end[:-1] = start[1:] - 1
    last = np.r_[row[1:] != row[:-1], True]
    end[last] = offsets[row[last] + 1]
    return start, end, row


def line_slices(start: np.ndarray, n_bytes: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of whole lines and their bytes, of about SLICE bytes and at most LINES lines each; a longer line is one of its own."""
    i, n = 0, len(start)
    while i < n:
        j = int(np.searchsorted(start, start[i] + SLICE, "right")) - 1
        j = min(max(j, i + 1), i + LINES, n)
        yield i, j, int(start[i]), int(start[j]) if j < n else n_bytes
        i = j


def own_features(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line by itself, and its hash; data begins with the first line."""
    n, size = len(start), end - start
    counts, words, ends_well, stuck, hashed = np.zeros((n, KINDS)), np.zeros(n), np.zeros(n), np.zeros(n), np.zeros(n, U64)
    if len(data):
        line = np.repeat(np.arange(n), np.diff(np.r_[start, len(data)]))
        kind = _kind[data]
        counts = np.bincount(line * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS).astype(float)
        counts[:, 0] -= data[np.minimum(end, len(data) - 1)] == 10
        counts = np.maximum(counts, 0)
        gap = (kind == 4) | (data == 10)
        word = ~gap
        word[1:] &= gap[:-1]
        begun = start[start < len(data)]
        word[begun] = ~gap[begun]
        words = np.bincount(line[word], minlength=n).astype(float)
        up, down = powers(len(data) + 1)
        total = np.zeros(len(data) + 1, U64)
        np.cumsum(byte_keys(11)[data] * up[:-1], out=total[1:])
        hashed = (total[end] - total[start]) * down[start]
        final = ~gap
        final[:-1] &= gap[1:] | word[1:]
        first, stop = np.flatnonzero(word), np.flatnonzero(final) + 1
        spelt = (total[stop] - total[first]) * down[first]
        twice = (spelt[1:] == spelt[:-1]) & (line[first][1:] == line[first][:-1])
        stuck = np.bincount(line[first[1:]][twice], minlength=n) / np.maximum(words, 1)
        ends_well = np.isin(data[np.maximum(end - 1, 0)], [*b".!?"]) & (size > 0)
    share = counts / np.maximum(size, 1)[:, None]
    letters = counts[:, 1] + counts[:, 2] + counts[:, 9]
    own = np.column_stack([
        share,
        np.minimum(share[:, 5:8] * 5, 1),
        np.log1p(size),
        np.log1p(words),
        np.minimum(size / np.maximum(words, 1), 40) / 10,
        counts[:, 1] / np.maximum(letters, 1),
        counts[:, 1] > 0.6 * np.maximum(letters, 1),
        share[:, 5] + share[:, 6] + share[:, 7] > 0.05,
        size == 0,
        words == 1,
        np.zeros(n),  # AGAIN: set when all lines' hashes are known
        stuck,
        ends_well,
    ]).astype(float)
    return own, hashed


def repeated_lines(row: np.ndarray, size: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether a line stands elsewhere in its row too; empty lines don't count."""
    order = np.lexsort((hashed, row))
    same = (row[order][1:] == row[order][:-1]) & (hashed[order][1:] == hashed[order][:-1])
    again = np.zeros(len(row), bool)
    again[order] = np.r_[False, same] | np.r_[same, False]
    return again & (size > 0)


def line_features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, length, features) of each line, its neighbours' features included: what fitting goes by."""
    start, end, row = lines_of(data, offsets)
    parts = [own_features(data[a:b], start[i:j] - a, end[i:j] - a) for i, j, a, b in line_slices(start, len(data))]
    own = np.concatenate([p[0] for p in parts])
    own[:, AGAIN] = repeated_lines(row, end - start, np.concatenate([p[1] for p in parts]))
    before, after = np.zeros_like(own), np.zeros_like(own)
    joined = row[1:] == row[:-1]
    before[1:][joined] = own[:-1][joined]
    after[:-1][joined] = own[1:][joined]
    edge = np.column_stack([np.r_[True, ~joined], np.r_[~joined, True], np.ones(len(row))])
    return row, end - start, np.hstack([own, before, after, edge])


def potentials(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, length, features @ weights) of each line, without all lines' features at a time.

    A slice's features are turned into three numbers a line: what it adds to its own potential, to the next line's and to the
    one's before.
    """
    start, end, row = lines_of(data, offsets)
    width = (len(weights) - 3) // 3
    each = weights[: 3 * width].reshape(3, width).T  # of the line itself, as the line before, as the line after
    adds, hashed = np.zeros((len(row), 3)), np.zeros(len(row), U64)
    for i, j, a, b in line_slices(start, len(data)):
        own, hashed[i:j] = own_features(data[a:b], start[i:j] - a, end[i:j] - a)
        adds[i:j] = own @ each
    adds[repeated_lines(row, end - start, hashed)] += each[AGAIN]
    joined = row[1:] == row[:-1]
    out = adds[:, 0] + weights[-1]
    out[1:] += np.where(joined, adds[:-1, 1], weights[-3])
    out[:-1] += np.where(joined, adds[1:, 2], weights[-2])
    out[0] += weights[-3]
    out[-1] += weights[-2]
    return row, end - start, out


class Chains:
    """Rows' lines laid out so that step t of all rows that long is one slice."""

    def __init__(self, row: np.ndarray):
        count = np.bincount(row)
        self.order = np.argsort(-count, kind="stable")
        self.first = np.searchsorted(row, self.order)
        self.count = count[self.order]
        self.steps = int(count.max(initial=0))

    def at(self, t: int) -> np.ndarray:
        """The line numbers of step t, of the rows that have it."""
        return self.first[: np.searchsorted(-self.count, -t)] + t


def marginals(chains: Chains, unary: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """P(good) of each line, expected transition counts, log partition of each row.

    unary: a good line's potential (a bad one's is 0); trans[a, b]: of label b after a, 1 is good.
    """
    n = len(unary)
    node = np.exp(np.clip(np.column_stack([np.zeros(n), unary]), -30, 30))
    step = np.exp(np.clip(trans, -30, 30))
    forward, scale = np.zeros((n, 2)), np.ones(n)
    for t in range(chains.steps):
        i = chains.at(t)
        f = node[i] if t == 0 else (forward[i - 1] @ step) * node[i]
        scale[i] = f.sum(1)
        forward[i] = f / scale[i][:, None]
    backward = np.ones((n, 2))
    pairs = np.zeros((2, 2))
    for t in range(chains.steps - 1, 0, -1):
        i = chains.at(t)
        g = node[i] * backward[i] / scale[i][:, None]
        pairs += step * (forward[i - 1].T @ g)
        backward[i - 1] = g @ step.T
    both = forward * backward
    return both[:, 1] / both.sum(1), pairs, np.log(scale)


def good_marginals(row: np.ndarray, unary: np.ndarray, trans: np.ndarray, block: int = 256) -> np.ndarray:
    """P(good) of each line as marginals() has it, with long rows cut into blocks of lines.

    A block's lines come to one 2 x 2 matrix; these carry the messages from block to block, and all blocks are gone through
    side by side, so that the steps grow with the block and the number of a row's blocks, and not with its lines.
    """
    n = len(unary)
    new = np.r_[True, row[1:] != row[:-1]]
    at = np.arange(n) - np.maximum.accumulate(np.where(new, np.arange(n), 0))
    first = np.flatnonzero(at % block == 0)
    size, opens = np.diff(np.r_[first, n]), new[first]
    ordinal = at[first] // block
    node = np.exp(np.clip(np.column_stack([np.zeros(n), unary]), -30, 30))
    step = np.exp(np.clip(trans, -30, 30))

    def alive(t: int) -> np.ndarray:
        return np.flatnonzero(size > t)

    def after(message: np.ndarray, some: np.ndarray, t: int) -> np.ndarray:
        """Row vectors (or matrices' rows) moved over line t of these blocks; a row's first line takes what comes as it is."""
        moved = message @ step
        if t == 0:
            moved = np.where(opens[some].reshape(-1, *[1] * (message.ndim - 1)), message, moved)
        out = moved * (node[first[some] + t][:, None, :] if message.ndim == 3 else node[first[some] + t])
        return out / out.sum(tuple(range(1, message.ndim)), keepdims=True)

    into, back = np.ones((len(first), 2)), np.ones((len(first), 2))
    if ordinal.max(initial=0):
        whole = np.repeat(np.eye(2)[None], len(first), axis=0)
        for t in range(int(size.max())):
            some = alive(t)
            whole[some] = after(whole[some], some, t)
        for o in range(1, int(ordinal.max()) + 1):
            here = np.flatnonzero(ordinal == o)
            carried = np.einsum("ni,nij->nj", into[here - 1], whole[here - 1])
            into[here] = carried / carried.sum(1, keepdims=True)
        for o in range(int(ordinal.max()), 0, -1):
            here = np.flatnonzero(ordinal == o)
            carried = np.einsum("nij,nj->ni", whole[here], back[here])
            back[here - 1] = carried / carried.sum(1, keepdims=True)
    forward, backward = np.zeros((n, 2)), np.ones((n, 2))
    message = into.copy()
    for t in range(int(size.max(initial=0))):
        some = alive(t)
        message[some] = after(message[some], some, t)
        forward[first[some] + t] = message[some]
    backward[first + size - 1] = back
    for t in range(int(size.max(initial=0)) - 1, 0, -1):
        i = first[alive(t)] + t
        g = (node[i] * backward[i]) @ step.T
        backward[i - 1] = g / g.sum(1, keepdims=True)
    both = forward * backward
    return both[:, 1] / both.sum(1)


class Model:
    def __init__(self, weights, trans, centre, spread, slope, shift):
        self.weights, self.trans, self.centre, self.spread, self.slope, self.shift = weights, trans, centre, spread, slope, shift

    def average(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Each row's length-weighted marginal."""
        scaled = self.weights / self.spread
        row, size, unary = potentials(data, offsets, scaled)
        good = good_marginals(row, unary - self.centre @ scaled, self.trans)
        weight = size + 1.0
        return np.bincount(row, good * weight) / np.bincount(row, weight)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(offsets) - 1, self.shift)
        mean = np.clip(self.average(data, offsets), 1e-6, 1 - 1e-6)
        return 1 / (1 + np.exp(-(self.slope * np.log(mean / (1 - mean)) + self.shift)))


def fit(rows: list[str], labels: list[int], rounds: int = 150, decay: float = 1e-3) -> Model:
    """Maximum likelihood by full gradients, then the logistic fit on the documents' averages."""
    y = np.asarray(labels, float)
    if len(y) == 0 or y.min() == y.max():
        return Model(None, None, None, None, 0.0, float(y.mean()) if len(y) else 1.0)
    data, offsets = texts(pa.array(rows, pa.large_string()))
    parts, lo_row = [], 0
    for lo, hi in pieces(offsets):
        r, s, x = line_features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        parts.append((r + lo, s, x))
    row, size, x = (np.concatenate([p[k] for p in parts]) for k in range(3))
    few = np.bincount(row)[row] <= MOST_LINES
    kept, row = np.unique(row[few], return_inverse=True)
    size, x, y = size[few], x[few], y[kept]
    centre, spread = x.mean(0), x.std(0) + 1e-3
    centre[-1], spread[-1] = 0.0, 1.0
    x = (x - centre) / spread
    chains, good = Chains(row), y[row]
    # Lines count by their share of the document, and both labels alike in all.
    joined = row[1:] == row[:-1]
    seen = np.zeros((2, 2))
    np.add.at(seen, (good[:-1][joined].astype(int), good[1:][joined].astype(int)), 1)
    balance = np.where(good == 1, 0.5 / max(good.sum(), 1), 0.5 / max((1 - good).sum(), 1)) * len(good)
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(x.shape[1] + 4), np.zeros(x.shape[1] + 4)
    for step in range(1, rounds + 1):
        p, pairs, _ = marginals(chains, x @ w, trans)
        g = np.r_[x.T @ ((p - good) * balance) / len(good) + decay * w, (pairs - seen).ravel() / len(good) + decay * 10 * trans.ravel()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * m / (1 - 0.9**step) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, trans = w - move[:-4], np.clip(trans - move[-4:].reshape(2, 2), -3, 3)
    model = Model(w, trans, centre, spread, 1.0, 0.0)
    good, _, _ = marginals(chains, x @ w, trans)
    weight = size + 1.0
    mean = np.clip(np.bincount(row, good * weight) / np.bincount(row, weight), 1e-6, 1 - 1e-6)
    z, a, b = np.log(mean / (1 - mean)), 0.5, 0.0
    for _ in range(50):  # Newton steps of the logistic fit, with a small ridge
        q = 1 / (1 + np.exp(-np.clip(a * z + b, -50, 50)))
        h = q * (1 - q)
        hess = np.array([[(h * z * z).sum() + 1, (h * z).sum()], [(h * z).sum(), h.sum() + 1]])
        da, db = np.linalg.solve(hess, [((q - y) * z).sum() + a, (q - y).sum() + b])
        a, b = a - da, b - db
        if abs(da) + abs(db) < 1e-9:
            break
    model.slope, model.shift = float(a), float(b)
    return model


def learn(docs: DataFrame, labels: DataFrame, learnt: Column) -> Model:
    """Fit on documents that may be learnt from; only their quality labels are read."""
    known = label_of(labels, "quality", learnt)
    ids = sample_ids(known, SAMPLE)
    label = {r["doc_id"]: r["label"] for r in known.filter(F.col("doc_id").isin(ids)).collect()} if ids else {}
    rows = sample_texts(docs, ids, LONGEST)
    return fit([t for _, t in rows], [label[i] for i, _ in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = chosen.drop("text").withColumn("score", F.lit(0.0)).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = texts(batch.column(1))
            for lo, hi in pieces(offsets):
                found = model.scores(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(found, pa.float64())], ["doc_id", "score"])

    return chosen.mapInArrow(work, schema)
