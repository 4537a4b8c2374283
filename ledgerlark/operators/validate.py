"""Validation that rejects whole groups, with the first reason of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def strictly_increasing(df: DataFrame, group: list[str], order: list[Column], value: str) -> tuple[DataFrame, DataFrame]:
    """(good, rejected): groups in which `value` doesn't rise from each row to the next go as a whole (WN1)."""
    before = F.lag(value).over(Window.partitionBy(*group).orderBy(*order))
    broken = F.max(F.coalesce(F.col(value) <= F.col("__before"), F.col(value).isNull())).over(Window.partitionBy(*group))
    told = df.withColumn("__before", before).withColumn("__broken", broken).drop("__before")
    return told.filter(~F.col("__broken")).drop("__broken"), told.filter("__broken").drop("__broken")


def first_failure(df: DataFrame, group: list[str], pos: list[str], rules: list[tuple[str, Column]]) -> DataFrame:
    """(group, reason): the first rule that the group's first failing row breaks, null for a sound group (WN2).

    rules: (reason, condition that fails), in order of precedence.
    """
    reason = F.coalesce(*(F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules))
    return df.withColumn("__reason", reason).groupBy(*group).agg(F.min(F.when(F.col("__reason").isNotNull(), F.struct(*pos, "__reason")))["__reason"].alias("reason"))


def entry_errors(rules: list[tuple[str, Column]]) -> Column:
    """All rules that a row breaks, as an array (FL6)."""
    return F.filter(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules)), lambda x: x.isNotNull())


def dictionary_errors(slug: Column, is_official: Column, name: Column, membership: Column) -> Column:
    """What is wrong with a dictionary entry (FL6), in this order; empty if nothing.

    membership: struct(title_prefix string, card_ids array), null if the entry has none. A curated entry needs one with either.
    """
    curated, empty = F.coalesce(~is_official, F.lit(False)), F.lit("")
    return entry_errors([
        ("official with membership", F.coalesce(is_official, F.lit(False)) & membership.isNotNull()),
        ("curated without membership", curated & membership.isNull()),
        ("membership without prefix or ids", curated & membership.isNotNull() & membership["title_prefix"].isNull() & membership["card_ids"].isNull()),
        ("neither official nor curated", is_official.isNull()),
        ("no name", F.coalesce(name, empty) == empty),
        ("no slug", F.coalesce(slug, empty) == empty),
    ])


def membership(rows: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, extra, missing) of rows against a list of wanted keys (FL3, SE1)."""
    return rows.join(wanted, key, "left_semi"), rows.join(wanted, key, "left_anti"), wanted.join(rows, key, "left_anti")


def need_some(values: list, what: str) -> list:
    """An empty scope is an error, not an empty result (FL2)."""
    if not values:
        raise ValueError(f"no {what}")
    return values


def need_columns(df: DataFrame, columns: list[str], name: str = "table") -> DataFrame:
    """Stop before any work if a table lacks columns (SC14)."""
    if missing := [c for c in columns if c not in df.columns]:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df


def scoped(df: DataFrame, column: str, scope: DataFrame, key: str, most: int = 1000) -> DataFrame:
    """Rows of a scope (SC13, FL1): up to `most` keys are pushed down to the scan as a list, more are a semi join. An empty scope is an error.

    The scope is counted no further than most + 1 keys; nulls are no keys.
    """
    keys = scope.select(F.col(key).alias("__k")).filter("__k is not null").distinct()
    few = [r[0] for r in keys.limit(most + 1).collect()]  # most + 1 at most
    need_some(few, f"keys in the scope of {column}")
    return df.filter(F.col(column).isin(few)) if len(few) <= most else df.join(keys, F.col(column) == F.col("__k"), "left_semi")
