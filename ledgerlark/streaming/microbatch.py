"""Incremental ingestion: available input in micro-batches, each stored under its number; tables.py keeps tables by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.operators.upsert import append_new, correct_recent


def file_stream(spark: SparkSession, folder: str, schema: str, name_glob: str | None = None, per_trigger: int = 100) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger)
    return (reader.option("pathGlobFilter", name_glob) if name_glob else reader).parquet(folder)


def upsert_stream(stream: DataFrame, load: Callable[[], DataFrame], store: Callable[[DataFrame], None], checkpoint: str, keys: list[str], order: list[Column], values: list[str], compare: str, day: str, as_of: Column, days: int = 7) -> StreamingQuery:
    """Each batch appends new keys, and corrects rows of the last `days` days that end with as_of (ST1, ST2, ST4).

    This is no watermark: late rows with new keys are still appended, they just can't change what is older. load gives
    the current table, store makes the next one current. Rows are keyed, so a batch that runs twice writes once. The caller keeps the
    table; tables.KeyedTable keeps it itself, as snapshots.
    """
    def apply(batch: DataFrame, _: int) -> None:
        current = load()
        recent = F.col(day) >= F.date_sub(as_of, days - 1)
        corrected, _ = correct_recent(current, batch, keys, values, compare, recent, order=order)
        following, _ = append_new(corrected, batch, keys, order, keys[0])
        store(following)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def isolated(stream: DataFrame, sound: Column, reason: Column, good: Callable[[DataFrame, int], None], bad: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Poison rows of each batch go to a side output with their reason; the rest is stored (ST6).

    Both outputs get the batch's number, so that a batch that runs again replaces what it wrote.
    """
    def apply(batch: DataFrame, number: int) -> None:
        told = batch.withColumn("__sound", F.coalesce(sound, F.lit(False)))
        bad(told.filter(~F.col("__sound")).drop("__sound").withColumn("reason", reason), number)
        good(told.filter("__sound").drop("__sound"), number)

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def by_batch(path: str) -> Callable[[DataFrame, int], None]:
    """A store that keeps each batch in a folder of its number."""
    return lambda df, number: df.write.mode("overwrite").parquet(f"{path}/batch={number}")


def stored(stream: DataFrame, store: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Store what is there now, batch by batch under its number."""
    return stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
