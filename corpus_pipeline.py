"""The corpus pipeline: five stages over documents, each written as Parquet and read again by the next.

Defined results, stage by stage. toxicity: null and empty texts score as the classifier's bias has it; without labels of both
kinds nothing is rejected. ngram_jaccard_join: texts without words and rows with a null doc_id all stay; of rows that repeat an id
all stay if that id is kept. suffix_array_dedup: null texts stay null, repeated rows of 200 bytes lose their whole text and stay
as rows; n_chars, where there is one, counts what is left. benchmark_decontamination: null and empty texts stay; an empty
benchmark removes nothing. bpe_encoding: null and empty texts have no tokens. Very long texts are read whole in all stages; other
columns, whatever their names, are kept by all but the last; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe_codec, decontaminate, jaccard_join, suffix_dedup, toxicity
from ledgerlark.llm.common import Scratch, split_rule, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go; the labels' held-out fold isn't learnt from."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), split_rule("doc_id", 5) != 0)
    return toxicity.accepted(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8."""
    return jaccard_join.keep_one(docs, width=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes that repeat are cut out; the documents stay, and n_chars follows."""
    cut = suffix_dedup.removed(docs)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else cut


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids."""
    return bpe_codec.encode(docs, "word_bpe_49k.json", outputs=("ids",))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("bpe_encoding", encode),
]

#: Classifier, tokenizer and edit distance are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to documents in turn."""
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
