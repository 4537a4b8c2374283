"""Toxicity by non-negative positive-unlabelled learning with numpy.

Confirmed toxic documents are the positives; all other text is unlabelled, never negative. A linear
classifier on the presence of words and word beginnings minimises the class-prior-corrected risk
pi * R_p(+) + max(0, R_u(-) - pi * R_p(-)); where the bracket turns negative its gradient is reversed.
The prior is the toxic share of the labels that may be learnt from. Fitting takes a bounded sample
(POSITIVES and UNLABELLED documents of at most LONGEST bytes); scoring reads every whole text.

Defined results: a null text counts as empty; an empty text or one without any known feature gets the
score of the bias alone; without labels of both kinds all scores are 0; repeated rows score alike;
other input columns are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlark.llm.common import U64, byte_keys, mixed, pieces, texts, word_cuts
from ledgerlark.llm.sampling import label_of, sample_ids, sample_texts

#: Bounds of the fitting sample.
POSITIVES, UNLABELLED, LONGEST = 1500, 4500, 100_000
#: Byte lengths of the word beginnings that are features beside whole words.
BEGINNINGS = (5, 6, 7, 8, 9, 10)
#: Most features, the fewest positives that a feature must occur in, and the standard errors that its share must be above the rest's.
FEATURES, LEAST_POSITIVES, SURPLUS = 6000, 3, 2.7
BASE = 0xD1342543DE82EF95
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_word = np.zeros(256, bool)
_word[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True


def lowered(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z and the Latin-1 capitals in lower case."""
    out = _lower[data]
    if len(out) > 1:
        second = out[1:]
        cap = (out[:-1] == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)
        second[cap] += 0x20
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2 ** 64, for i < n."""
    up, down = np.full(n, BASE, U64), np.full(n, pow(BASE, -1, 1 << 64), U64)
    up[:1] = down[:1] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, feature hash) of whole words, then of word beginnings of each length; a word never spans rows. Long texts come in slices."""
    if not len(data):
        return
    whole = lowered(data)
    edges = np.zeros(len(data) + 1, bool)
    edges[offsets] = True
    keys = byte_keys(7)
    for lo, hi in word_cuts(~_word[whole], edges):
        low = whole[lo:hi]
        inside = _word[low]
        first = inside.copy()
        first[1:] &= ~inside[:-1] | edges[lo + 1 : hi]
        start = np.flatnonzero(first)
        last = np.ones(len(low), bool)
        last[:-1] = ~inside[1:] | first[1:]
        end = np.flatnonzero(inside & last) + 1
        up, down = powers(len(low))
        total = np.zeros(len(low) + 1, U64)
        np.cumsum(keys[low] * up, out=total[1:])
        row = np.searchsorted(offsets, start + lo, "right") - 1
        at, back = total[start], down[start]
        yield row, mixed((total[end] - at) * back)
        size = end - start
        for n in BEGINNINGS:
            keep = np.flatnonzero(size > n)
            yield row[keep], mixed((total[start[keep] + n] - at[keep]) * back[keep] + U64(n))


class Model:
    """Weights of sorted feature hashes and a bias."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, bias: float, prior: float):
        self.keys, self.weights, self.bias, self.prior = keys, weights, bias, prior

    def hits(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, known feature) pairs."""
        if not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.zeros(1 << 20, bool)
        maybe[(self.keys & U64((1 << 20) - 1)).astype(np.int64)] = True
        found = []
        for row, h in features(data, offsets):
            near = np.flatnonzero(maybe[(h & U64((1 << 20) - 1)).astype(np.int64)])
            h, row = h[near], row[near]
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            same = self.keys[at] == h
            found.append(row[same] * len(self.keys) + at[same])
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        return both // len(self.keys), both % len(self.keys)

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        row, feature = self.hits(data, offsets)
        f = np.bincount(row, self.weights[feature], len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(f, -500, 500)))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -50, 50)))


def risk(f_p: np.ndarray, f_u: np.ndarray, prior: float) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative risk of the positives' and the unlabelled texts' outputs, and the gradient to go down, by output.

    Logistic loss: l(+) = log(1 + e^-f), l(-) = log(1 + e^f). Where the estimate of the negatives' part is below 0, it counts
    as 0, and the gradient is that part's own, reversed.
    """
    positive = prior * np.logaddexp(0, -f_p).mean()
    negative = np.logaddexp(0, f_u).mean() - prior * np.logaddexp(0, f_p).mean()
    up_p, up_u = sigmoid(f_p) / len(f_p), sigmoid(f_u) / len(f_u)
    if negative >= 0:
        return positive + negative, prior * (up_p - 1 / len(f_p)) - prior * up_p, up_u
    return positive, prior * up_p, -up_u


def joined(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return texts(pa.array(rows, pa.large_string()))


def fit(positive: list[str], unlabelled: list[str], prior: float, rounds: int = 400, rate: float = 0.5, decay: float = 1e-4) -> Model:
    """Choose features that positives have more often than other text, then minimise the non-negative risk by full gradients."""
    if not positive or not unlabelled or not 0 < prior < 1:
        return Model(np.zeros(0, U64), np.zeros(0), -500.0 if not positive else 500.0 * (prior >= 1) - 500.0 * (prior <= 0), prior)
    distinct = []
    data, offsets = joined(positive)
    for lo, hi in pieces(offsets):
        parts = [*features(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])]
        row, h = (np.concatenate([p[k] for p in parts]) for k in range(2)) if parts else (np.zeros(0, np.int64), np.zeros(0, U64))
        order = np.lexsort((row, h))
        h, row = h[order], row[order]
        distinct.append(h[np.r_[True, (h[1:] != h[:-1]) | (row[1:] != row[:-1])]] if len(h) else h)
    keys, df_p = np.unique(np.concatenate(distinct), return_counts=True)
    keys, df_p = keys[df_p >= LEAST_POSITIVES], df_p[df_p >= LEAST_POSITIVES]
    model = Model(keys, np.zeros(len(keys)), 0.0, prior)

    def pairs(rows: list[str]) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = joined(rows)
        out = [(r + lo, f) for lo, hi in pieces(offsets) for r, f in [model.hits(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])]]
        return np.concatenate([r for r, _ in out]), np.concatenate([f for _, f in out])

    row_u, feat_u = pairs(unlabelled)
    n_p, n_u = len(positive), len(unlabelled)
    p, u = df_p / n_p, np.bincount(feat_u, minlength=len(keys)) / n_u
    # How many standard errors the positives' share is above the other text's: chance must not make features of few positives.
    surplus = (p - u) / np.sqrt(u / n_p + 1 / n_p**2)
    best = np.sort(np.argsort(-np.where(p > 1.5 * u, surplus, -1), kind="stable")[:FEATURES])
    best = best[((p > 1.5 * u) & (surplus > SURPLUS))[best]]
    keep = np.full(len(keys), -1)
    keep[best] = np.arange(len(best))
    model = Model(keys[best], np.zeros(len(best)), 0.0, prior)
    row_p, feat_p = pairs(positive)
    mask = keep[feat_u] >= 0
    row_u, feat_u = row_u[mask], keep[feat_u[mask]]
    w, b = np.zeros(len(best)), 0.0
    moment, second, mb, sb = np.zeros(len(best)), np.zeros(len(best)), 0.0, 0.0

    for step in range(1, rounds + 1):
        _, g_p, g_u = risk(np.bincount(row_p, w[feat_p], n_p) + b, np.bincount(row_u, w[feat_u], n_u) + b, prior)
        g = np.bincount(feat_p, g_p[row_p], len(best)) + np.bincount(feat_u, g_u[row_u], len(best)) + decay * w
        gb = g_p.sum() + g_u.sum()
        moment, second = 0.9 * moment + 0.1 * g, 0.999 * second + 0.001 * g * g
        mb, sb = 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb * gb
        pace = rate * 0.1 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        w -= pace * moment / (np.sqrt(second) + 1e-8)
        b -= pace * mb / (np.sqrt(sb) + 1e-8)
    return Model(model.keys, w, float(b), prior)


def learn(docs: DataFrame, labels: DataFrame, learnt: Column) -> Model:
    """Fit on documents that may be learnt from; only their toxic labels are read."""
    known = label_of(labels, "toxic", learnt)
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = counts.get(1, 0), counts.get(0, 0)
    positive = sample_ids(known.filter("label = 1"), POSITIVES)
    other = sorted({*sample_ids(docs.filter(learnt), UNLABELLED, seed=2)})
    rows = dict(sample_texts(docs, sorted({*positive, *other}), LONGEST))
    return fit([rows[i] for i in positive if i in rows], [rows[i] for i in other if i in rows], n1 / max(1, n1 + n0))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every document."""
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = chosen.drop("text").withColumn("score", F.lit(0.0)).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scored(model, batch.column(1)), pa.float64())], ["doc_id", "score"])

    return chosen.mapInArrow(work, schema)


def accepted(docs: DataFrame, model: Model, below: float = 0.5) -> DataFrame:
    """The documents that score below the limit, all columns kept."""
    at = docs.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                yield part.filter(pa.array(scored(model, part.column(at)) < below))

    return docs.mapInArrow(work, docs.schema)


def scored(model: Model, column: pa.Array) -> np.ndarray:
    data, offsets = texts(column)
    parts = [model.scores(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]) for lo, hi in pieces(offsets)]
    return np.concatenate(parts) if parts else np.zeros(0)
