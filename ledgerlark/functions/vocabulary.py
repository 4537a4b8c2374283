"""Closed vocabularies: raw labels to codes. A label that isn't listed is an anomaly, an empty one is unknown."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlark.functions.text import vocabulary_key

# Field -> code -> labels.
VOCABULARIES = {
    "material": {
        "gold": ["золото"],
        "silver": ["срібло"],
        "nickel_silver": ["нейзильбер"],
        "cupronickel": ["мельхіор"],
        "bimetallic": ["біметал", "біметалеві із недорогоцінних металів"],
        "bimetallic_precious": ["біметалеві із дорогоцінних металів"],
        "zinc_alloy": ["сплав на основі цинку"],
        "banknote": ["інший (банкнота)"],
        "not_specified": ["не вказується (набір)"],
    },
    "quality": {
        "proof": ["пруф"],
        "proof_like": ["пруф-лайк"],
        "uncirculated": ["звичайна", "анциркулейтед"],
        "special_uncirculated": ["спеціальний анциркулейтед"],
        "improved": ["підвищена"],
        "not_specified": ["<not assigned>"],
    },
    "edge": {
        "plain": ["гладкий"],
        "reeded": ["рифлений"],
        "plain_incuse_lettering": ["гладкий із заглибленим написом", "гладкий із заглибленими написами"],
        "sector_reeded": ["секторальне рифлення"],
        "not_specified": ["<не вказується>"],
    },
    "unit": {"hryvnia": ["грн", "грн."], "karbovanets": ["крб", "крб.", "карб", "карб."]},
}


def labels(spark: SparkSession, field: str, vocabularies: dict | None = None) -> DataFrame:
    """(label_key, code): a table of fixed size."""
    rows = [(label, code) for code, variants in (vocabularies or VOCABULARIES)[field].items() for label in variants]
    return spark.createDataFrame(rows, "label string, code string").select(vocabulary_key(F.col("label")).alias("label_key"), "code").dropDuplicates(["label_key"])


def coded(df: DataFrame, raw: str, field: str, out: str, vocabularies: dict | None = None) -> DataFrame:
    """Adds the code of a raw label and whether the label is an anomaly: given, but not in the vocabulary (FL7)."""
    listed = F.broadcast(labels(df.sparkSession, field, vocabularies).withColumnRenamed("code", "__code"))  # the vocabulary's few labels
    joined = df.withColumn("__key", vocabulary_key(F.col(raw))).join(listed, F.col("__key") == F.col("label_key"), "left")
    unknown = F.coalesce(F.col(raw) != "", F.lit(False)) & F.col("__code").isNull()
    return joined.select(*df.columns, F.col("__code").alias(out), unknown.alias(f"{out}_unknown"))
