"""Approximate nearest neighbours by learned partitions.

On a bounded sample the exact neighbour graph is built and cut into balanced parts; a softmax classifier
learns the parts (each sample's own and its neighbours'). It routes every vector to its most probable part
and every query to several of them, as many as reached RECALL on held-out sample queries, and as many
as hold enough vectors. Within those parts all vectors are reranked by the exact inner product in double
precision. Large parts are cut into blocks of vectors and of queries, so no task grows with the data.

Defined results: vectors that are null, zero, hold a null or non-finite component or have another length
than most of the sample take no part, neither as queries nor as neighbours; rows with a null id neither; ties go to the
smaller vec_id; repeated rows count once, and of different vectors under one vec_id the best score counts; other columns
are left out; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.llm.common import Scratch

#: Bounds of the fitting sample: vectors of the graph, and queries that the number of probes is fitted on.
SAMPLE, TRIALS = 4096, 512
#: Edges of a vector in the graph; the recall that the probes must reach on the trials.
EDGES, RECALL = 10, 0.97
#: Vectors and queries of one task's block.
BLOCK = 4096
LEAST_PARTS, MOST_PARTS = 8, 256


class Router:
    """Softmax weights, the number of probes, the vectors' length."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, probes: int):
        self.weights, self.bias, self.probes, self.size = weights, bias, probes, len(weights)

    def ranking(self, x: np.ndarray) -> np.ndarray:
        """The parts of each vector, the most probable first."""
        return np.argsort(-(x @ self.weights + self.bias), axis=1, kind="stable").astype(np.int32)


def balanced_parts(x: np.ndarray, graph: np.ndarray, n_parts: int, rounds: int = 12) -> np.ndarray:
    """Parts of near equal size that cut few edges: grown around spread seeds, then moved along gains within the size limit."""
    n = len(x)
    limit = int(np.ceil(1.05 * n / n_parts))
    seeds = [0]
    far = 1 - x @ x[0]
    for _ in range(n_parts - 1):
        seeds.append(int(np.argmax(far)))
        far = np.minimum(far, 1 - x @ x[seeds[-1]])
    centres = x[seeds]
    part = np.zeros(n, np.int64)
    for _ in range(8):
        near = x @ centres.T
        part[:], room = -1, np.full(n_parts, limit)
        order = np.argsort(-(near.max(1) - np.partition(near, -2, axis=1)[:, -2]), kind="stable")
        choice = np.argsort(-near, axis=1)
        for i in order.tolist():
            for c in choice[i].tolist():
                if room[c]:
                    part[i] = c
                    room[c] -= 1
                    break
        centres = np.stack([x[part == c].mean(0) if (part == c).any() else centres[c] for c in range(n_parts)])
    for _ in range(rounds):
        votes = np.zeros((n, n_parts))
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(1)
        gain = votes[np.arange(n), best] - votes[np.arange(n), part]
        size, moved = np.bincount(part, minlength=n_parts), 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            if size[best[i]] < limit:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i], moved = best[i], moved + 1
        if not moved:
            break
    return part


def fit(x: np.ndarray, trials: np.ndarray, n_parts: int, k: int, rounds: int = 200) -> Router:
    """Graph, parts, classifier and number of probes from sample vectors (rows of x) and trial queries."""
    size = x.shape[1]
    n_parts = min(n_parts, max(1, len(x) // 8))
    if n_parts < 2:
        return Router(np.zeros((size, 1)), np.zeros(1), 1)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T
    np.fill_diagonal(near, -np.inf)
    edges = min(EDGES, len(x) - 1)
    graph = np.argpartition(-near, edges - 1, axis=1)[:, :edges]
    part = balanced_parts(unit, graph, n_parts)
    target = np.zeros((len(x), n_parts))
    np.add.at(target, (np.arange(len(x)), part), float(edges))
    np.add.at(target, (np.repeat(np.arange(len(x)), edges), part[graph].ravel()), 1.0)
    target /= target.sum(1, keepdims=True)
    w, b = np.stack([unit[part == c].mean(0) if (part == c).any() else np.zeros(size) for c in range(n_parts)], 1) * 8, np.zeros(n_parts)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)
    for step in range(1, rounds + 1):
        z = x @ w + b
        p = np.exp(z - z.max(1, keepdims=True))
        d = (p / p.sum(1, keepdims=True) - target) / len(x)
        gw, gb = x.T @ d + 1e-5 * w, d.sum(0)
        mw, vw, mb, vb = 0.9 * mw + 0.1 * gw, 0.999 * vw + 0.001 * gw**2, 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb**2
        c1, c2 = 1 - 0.9**step, 1 - 0.999**step
        w -= 0.1 * (mw / c1) / (np.sqrt(vw / c2) + 1e-9)
        b -= 0.1 * (mb / c1) / (np.sqrt(vb / c2) + 1e-9)
    router = Router(w, b, n_parts)
    trials = trials if len(trials) else x
    score = trials @ x.T
    home = router.ranking(x)[:, 0]
    ranks = np.argsort(router.ranking(trials), axis=1)  # rank of each part for each trial
    best = np.argsort(-score, axis=1)[:, : k + 1]
    needed = np.sort(ranks[np.arange(len(trials))[:, None], home[best]].ravel())
    router.probes = int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1
    return router


def stacked(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    """Vectors of one length as doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), size)


def valid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    v = F.col(column)
    sound = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & v.isNotNull() & sound & F.exists(v, lambda c: c != 0))


def top(q: np.ndarray, q_id: np.ndarray, v: np.ndarray, v_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, vector id, score) of each query's k best, ties to the smaller id, itself left out; an id counts once with its best score."""
    order = np.argsort(v_id, kind="stable")
    v, v_id = v[order], v_id[order]
    start = np.flatnonzero(np.r_[True, v_id[1:] != v_id[:-1]])
    s = q @ v.T
    s[q_id[:, None] == v_id[None, :]] = -np.inf
    by_id = s if len(start) == len(v_id) else np.maximum.reduceat(s, start, axis=1)
    keep = min(k, len(start))
    edge = np.partition(by_id, len(start) - keep, axis=1)[:, len(start) - keep]
    row, col = np.nonzero((s >= edge[:, None] - 1e-9 * (1 + np.abs(np.where(np.isfinite(edge), edge, 0)))[:, None]) & np.isfinite(s))
    score = (q[row] * v[col]).sum(1)  # summed alike for each pair, wherever it stands in the block
    order = np.lexsort((-score, v_id[col], row))
    row, col, score = row[order], col[order], score[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (v_id[col[1:]] != v_id[col[:-1]])
    row, col, score = row[new], col[new], score[new]
    order = np.lexsort((v_id[col], -score, row))
    row, col, score = row[order], col[order], score[order]
    first = np.searchsorted(row, row)
    best = np.arange(len(row)) - first < k
    return q_id[row[best]], v_id[col[best]], score[best]


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest found of each query row; all other rows are candidates."""
    spark = vectors.sparkSession
    out = "query_id long, rank int, vec_id long, score double"
    rows = valid(vectors)
    total = rows.count()
    if not total:
        return spark.createDataFrame([], out)
    hashed = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    share = min(1.0, (SAMPLE + TRIALS) / total)
    taken = rows.filter(hashed < int((1 << 30) * share) + 1).limit(2 * (SAMPLE + TRIALS)).collect()
    taken.sort(key=lambda r: r["vec_id"])
    lengths = np.array([len(r["v"]) for r in taken] or [1])
    size = int(np.bincount(lengths).argmax())
    x = np.array([r["v"] for r in taken if len(r["v"]) == size], np.float64).reshape(-1, size)
    x = x[np.sort(np.unique(x, axis=0, return_index=True)[1])]  # copies would be each other's only neighbours in the graph
    trial = np.random.default_rng(5).permutation(len(x)) < min(TRIALS, len(x) // 8)
    n_parts = int(np.clip(2 ** round(np.log2(max(1.0, total**0.5 / 8))), LEAST_PARTS, MOST_PARTS))
    router = fit(x[~trial], x[trial], n_parts, k) if len(x) else Router(np.zeros((size, 1)), np.zeros(1), 1)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranking = router.ranking(stacked(batch.column(1), size))
            flat = pa.array(ranking.ravel())
            at = pa.array(np.arange(0, ranking.size + 1, ranking.shape[1]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(at, flat), batch.column(2)], ["vec_id", "v", "parts", "is_query"])

    kind = rows.schema["v"].dataType.simpleString()
    routed = rows.filter(F.size("v") == size).withColumn("is_query", is_query).mapInArrow(route, f"vec_id long, v {kind}, parts array<int>, is_query boolean")
    # The whole ranking matters for queries alone.
    routed = routed.withColumn("parts", F.when(F.col("is_query"), F.col("parts")).otherwise(F.slice("parts", 1, 1)))
    routed = Scratch(spark, "partitions").save(routed, "routed")
    counts = routed.groupBy(F.col("parts")[0].alias("p")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("vec_id").alias("ids")).collect()
    held, sizes = {r["p"]: r["n"] for r in counts}, {r["p"]: r["ids"] for r in counts}
    sizes = F.array(*(F.lit(sizes.get(p, 0)) for p in range(router.weights.shape[1])))

    queries = routed.filter("is_query").select(F.col("vec_id"), "v", "parts")
    # As many parts as were fitted, and on until they hold k others.
    reach = F.aggregate(
        "parts",
        F.struct(F.lit(0).alias("n"), F.lit(0).cast("long").alias("held")),
        lambda a, p: F.when((a["n"] >= router.probes) & (a["held"] > k), a).otherwise(F.struct((a["n"] + 1).alias("n"), (a["held"] + F.get(sizes, p)).alias("held"))),
        lambda a: a["n"],
    )
    asked = queries.select("vec_id", "v", F.explode(F.slice("parts", F.lit(1), reach)).alias("part"))
    n_asked = {r["part"]: r["n"] for r in asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()}

    def blocks(counts: dict[int, int]) -> Column:
        return F.get(F.array(*(F.lit(-(-counts.get(p, 0) // BLOCK) or 1) for p in range(router.weights.shape[1]))), F.col("part"))

    def dealt(df: DataFrame, own: str, other: str, n_own: Column, n_other: Column) -> DataFrame:
        """Each row in one block of its own side and in all of the other's."""
        df = df.withColumn(own, F.pmod(F.xxhash64("vec_id"), n_own).cast("int"))
        return df.withColumn(other, F.explode(F.sequence(F.lit(0), n_other - 1)))

    q = dealt(asked, "qb", "vb", blocks(n_asked), blocks(held)).select("part", "qb", "vb", "vec_id", "v")
    v = dealt(routed.select("vec_id", "v", F.col("parts")[0].alias("part")), "vb", "qb", blocks(held), blocks(n_asked)).select("part", "qb", "vb", "vec_id", "v")

    def rerank(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = left.num_rows == 0 or right.num_rows == 0
        found = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)) if empty else top(
            stacked(left["v"], size), left["vec_id"].to_numpy(), stacked(right["v"], size), right["vec_id"].to_numpy(), k
        )
        return pa.table({"query_id": pa.array(found[0], pa.int64()), "vec_id": pa.array(found[1], pa.int64()), "score": pa.array(found[2], pa.float64())})

    cell = ["part", "qb", "vb"]
    found = q.groupBy(*cell).cogroup(v.groupBy(*cell)).applyInArrow(rerank, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
