"""Registered queries of the operators, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.llm import bpe_codec, decontaminate, exact_dedup, filter_audit, jaccard_join, license_scan, line_crf, neural_partitions, preference_format, prefix_trie, suffix_dedup, toxicity, url_rules
from ledgerlark.llm.common import split_rule, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(query):
    QUERIES[query.__name__] = query
    return query


@registered
def op9_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of ids and decoded text of each document."""
    return bpe_codec.encode(table(spark, sf_dir, "documents"), "word_bpe_49k.json", outputs=("digests",))


@registered
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence places and labels of each document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@registered
def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page's url."""
    return url_rules.judge(table(spark, sf_dir, "pages"))


ORACLES["op6_url_rules"] = url_rules.ORACLE_SQL


@registered
def op10_preference_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompt and masked completions of each pair; a mask's spans as start-end, comma-joined."""
    pairs = preference_format.format_pairs(table(spark, sf_dir, "conversations"))
    for name in ("chosen_mask", "rejected_mask"):
        pairs = pairs.withColumn(name, F.array_join(F.transform(name, lambda s: F.concat_ws("-", s["start"], s["end"])), ","))
    return pairs


ORACLES["op10_preference_format"] = preference_format.ORACLE_SQL


@registered
def op3_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of each document; labels of the held-out fold are never learnt."""
    docs, held_out = table(spark, sf_dir, "documents"), split_rule("doc_id", 4) == 2
    model = line_crf.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = line_crf.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@registered
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document; labels of the held-out fold are never learnt."""
    docs, held_out = table(spark, sf_dir, "documents"), split_rule("doc_id", 5) == 0
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"), ~held_out)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


@registered
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each contaminated document with each item it holds."""
    return decontaminate.regions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@registered
def op2_neural_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found of each vector whose id is divisible by 20."""
    return neural_partitions.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@registered
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of each document."""
    return jaccard_join.join(table(spark, sf_dir, "documents"))


@registered
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without passages of 200 bytes that repeat."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@registered
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the rebuilt conversations' trie."""
    return prefix_trie.build(table(spark, sf_dir, "conversations"))


ORACLES["op11_prefix_trie"] = prefix_trie.ORACLE_SQL


@registered
def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of equal texts."""
    return exact_dedup.mark(table(spark, sf_dir, "documents"), digests={"text_sha256": F.sha2(exact_dedup.normalised(F.col("text")), 256)})


ORACLES["op12_exact_dedup"] = exact_dedup.ORACLE_SQL


@registered
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each of five filters removes in every order of them, by language."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLES["op13_filter_audit"] = filter_audit.ORACLE_SQL
