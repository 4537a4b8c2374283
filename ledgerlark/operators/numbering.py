"""Places of rows in their groups, however large a group is, and tables that are written down between steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlark.plans.shared import shared_folder


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again: later steps use the same rows, and lost executors don't bring back earlier ones."""
    path = shared_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame) -> DataFrame:
    """The rows dealt evenly to all cores, before work that takes far longer than reading them: a file of many small rows is few partitions.

    The number is the session's own for shuffles, or four for each core; as it is given, adaptive execution doesn't merge small ones.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def numbered(df: DataFrame, group: list[str], order: list[str], out: str) -> DataFrame:
    """df with each row's place in its group from 1, in a total order; group columns hold no nulls, without any all rows are one group.

    The rows are range-sorted and written once, so the places hold whatever later steps do. A group that spans several partitions is
    numbered by all of them: what a partition adds is the rows of the group in the partitions before it.
    """
    keys = [*group, *order]
    dealt = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()})
    rows = written(dealt, "numbered")
    runs = rows.groupBy(*group, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    ahead = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    shifts = runs.select(*group, "__part", (F.coalesce(F.sum("__n").over(ahead), F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    return rows.join(shifts, [*group, "__part"]).withColumn(out, (F.col("__at") + F.col("__shift")).cast("long")).select(*df.columns, out)


def exploded_range(df: DataFrame, low: Column, high: Column, out: str, block: int = 4096) -> DataFrame:
    """A row for each number from low to high, in blocks that are dealt out, so that a long range isn't one task's array; none if high < low."""
    blocks = df.withColumns({"__lo": low.cast("long"), "__hi": high.cast("long")}).filter("__hi >= __lo").withColumn("__b", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("__hi") - F.col("__lo")) / block))))
    first = F.col("__lo") + F.col("__b") * block
    return blocks.repartition(*df.columns, "__b").withColumn(out, F.explode(F.sequence(first, F.least(first + (block - 1), F.col("__hi"))))).select(*df.columns, out)


#: A key of over 1 / HEAVY of all rows is joined by broadcast; fewer than HEAVY keys can be.
HEAVY = 1000


def spread_join(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int, how: str = "inner") -> DataFrame:
    """rows, `total` at most, joined (inner, left_semi or left_anti) with groups, one row a key with its number of rows in `size`.

    Keys of very many rows, fewer than a thousand of them, are broadcast, so that their rows stay where they are; the others are shuffled.
    """
    heavy, light = F.broadcast(groups.filter(F.col(size) * HEAVY > total)), groups.filter(F.col(size) * HEAVY <= total)
    rest = rows.join(heavy.select(key), key, "left_anti").join(light, key, how)
    return rest if how == "left_anti" else rows.join(heavy, key, how).unionByName(rest)
