"""Bounded, repeatable samples of labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sample_ids(rows: DataFrame, most: int, seed: int = 1) -> list[int]:
    """About most doc_ids of the rows (all, if fewer), chosen by a hash of the id alone; at most twice as many."""
    ids = rows.select("doc_id").filter(F.col("doc_id").isNotNull())
    total = ids.count()
    if total > most:
        ids = ids.filter(F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 30)) < int((1 << 30) * most / total))
    return sorted({r["doc_id"] for r in ids.limit(2 * most).collect()})


#: Bytes of text that a fitting sample holds at most.
SAMPLE_BYTES = 48_000_000


def sample_texts(docs: DataFrame, ids: list[int], longest: int, most: int | None = None) -> list[tuple[int, str]]:
    """The sampled rows' texts; texts over `longest` bytes don't serve for fitting, and no more than `most` bytes are taken.

    Where they would be more, as many ids as fit are kept, in the order of a hash of the id.
    """
    if not ids:
        return []
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).filter(F.col("doc_id").isin(ids)).filter(F.octet_length("text") <= longest)
    sizes = rows.groupBy("doc_id").agg(F.sum(F.octet_length("text")).alias("size"), F.xxhash64("doc_id", F.lit(3)).alias("h")).collect()
    total, kept = 0, []
    for r in sorted(sizes, key=lambda r: r["h"]):
        total += r["size"]
        if total > (most or SAMPLE_BYTES):
            break
        kept.append(r["doc_id"])
    return sorted((r["doc_id"], r["text"]) for r in rows.filter(F.col("doc_id").isin(kept)).collect()) if kept else []


def label_of(labels: DataFrame, column: str, learnt: Column) -> DataFrame:
    """doc_id and one label 0 or 1 of each document that may be learnt from; of contradictory labels the larger counts."""
    return labels.filter(learnt & F.col(column).isin(0, 1)).groupBy("doc_id").agg(F.max(column).alias("label"))
