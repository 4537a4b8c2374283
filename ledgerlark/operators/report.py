"""Run accounting."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def status_counts(df: DataFrame, status: str, values: list[str], by: list[str] | None = None) -> DataFrame:
    """One count a status (AG1), for the whole run or by columns."""
    counts = [F.count_if(F.col(status) == v).alias(v) for v in values]
    return df.groupBy(*(by or [])).agg(F.count(F.lit(1)).alias("total"), *counts)


def verdict(ok: Column, any_ok: Column) -> Column:
    """ok if all parts are, partial if some are, else failed (AG2)."""
    return F.when(ok, "ok").when(any_ok, "partial").otherwise("failed")


def run_verdict(df: DataFrame, good: Column, by: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(by or [])).agg(verdict(F.bool_and(good), F.bool_or(good)).alias("verdict"))


def first_some(items: Column, most: int = 10) -> Column:
    """The first items of a list and how many more there are (AG10)."""
    more = F.size(items) - most
    return F.concat(F.concat_ws(", ", F.slice(items, 1, most)), F.when(more > 0, F.concat(F.lit(" (+"), more.cast("string"), F.lit(")"))).otherwise(F.lit("")))


def failure_streaks(df: DataFrame, group: list[str], order: list[Column], failed: Column) -> DataFrame:
    """Adds the length of the run of failures that ends at each row, 0 after a success (WN5)."""
    w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = df.withColumn("__bad", failed.cast("int")).withColumn("__island", F.sum(1 - F.col("__bad")).over(w))
    run = Window.partitionBy(*group, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return marked.withColumn("streak", F.sum("__bad").over(run)).drop("__bad", "__island")


def until_breaker(df: DataFrame, group: list[str], order: list[Column], failed: Column, limit: int = 5) -> DataFrame:
    """The rows that still run when `limit` failures in a row stop the rest (WN5, ST7)."""
    streaks = failure_streaks(df, group, order, failed)
    stopped = F.max((F.col("streak") >= limit).cast("int")).over(Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1))
    return streaks.withColumn("__stopped", F.coalesce(stopped, F.lit(0))).filter("__stopped = 0").drop("__stopped", "streak")


def widened(df: DataFrame, number: str, by: int = 1) -> DataFrame:
    """The distinct numbers and their neighbours (AG6)."""
    return df.select(F.explode(F.sequence(F.col(number) - by, F.col(number) + by)).alias(number)).distinct()


def series_stats(points: DataFrame, group: list[str], at: str, value: str) -> DataFrame:
    """Count, span and range of each series (AG3)."""
    return points.groupBy(*group).agg(F.count(F.lit(1)).alias("points"), F.min(at).alias("first_ts"), F.max(at).alias("last_ts"), F.min(value).alias("low"), F.max(value).alias("high"))


def membership_stats(cards: DataFrame, group: list[str], card: str, year: str) -> DataFrame:
    """Distinct cards and first and last year of each series (AG4)."""
    return cards.groupBy(*group).agg(F.count_distinct(card).alias("n_cards"), F.min(year).alias("first_year"), F.max(year).alias("last_year"))


class JobRun:
    """A run's row in a table of runs: opened when it starts, finished or crashed when it ends (SK15).

    Used as a context: what the run notes down is kept with its end; an exception marks it as crashed and goes on. A table that can't be
    written never changes the run's outcome; it is warned of.
    """

    def __init__(self, spark: SparkSession, root: str, kind: str, run: str):
        self.spark, self.root, self.kind, self.run, self.notes = spark, root, kind, run, {}

    def note(self, **counts: int) -> None:
        self.notes |= counts

    def _tell(self, state: str, error: str | None = None) -> None:
        row = [(self.kind, state, error, {k: int(v) for k, v in self.notes.items()})]
        try:
            self.spark.createDataFrame(row, JOB_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{self.root}/run={self.run}/{'open' if state == 'running' else 'end'}")
        except Exception as e:  # whatever a sink does, the run's outcome stands
            warnings.warn(f"run {self.run} isn't reported: {e}", stacklevel=2)

    def __enter__(self) -> JobRun:
        self._tell("running")
        return self

    def __exit__(self, kind, error, trace) -> bool:
        self._tell("finished" if error is None else "crashed", None if error is None else type(error).__name__)
        return False


JOB_SCHEMA = "kind string, state string, error string, notes map<string,long>"


def job_runs(spark: SparkSession, root: str) -> DataFrame:
    """(run, kind, state, error, notes): each run as of its last report; one without an end is running, or was cut off."""
    rows = spark.read.schema(JOB_SCHEMA).json(f"{root}/run=*/*").withColumn("run", F.regexp_extract(F.col("_metadata.file_path"), "run=([^/]+)/", 1))
    last = F.max_by(F.struct("kind", "state", "error", "notes"), F.when(F.col("state") == "running", 0).otherwise(1))
    return rows.groupBy("run").agg(last.alias("r")).select("run", "r.*")
