"""Keyed tables that streams keep up to date: a snapshot for each batch, so that a batch that runs again changes nothing.

Parquet has no MERGE, so a batch joins what the table has with what came, in one full join, and writes the result anew: of a table that
is split into parts by its keys, only the parts that the batch touches. A snapshot is a small list of the parts' folders; its own folder is
named by its version, the writer and the writer's batch number: a batch that ran to its end is found by that name and skipped; one that
was cut off is done again from the version below. A folder without Spark's _SUCCESS mark was cut off and isn't read.
"""

from __future__ import annotations

import re
import threading
from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlark.operators.upsert import merge_recent, one_per_key
from ledgerlark.sources.folders import Folders


class KeyedTable:
    """A table under a key, fed by one or more streams through merge() (ST1, ST2, ST4, ST8).

    New keys are appended whatever their day; a key that is there is corrected if its day is one of the last `days` that end with
    `today`, or with the newest day that the table or the batch has, and `compare` differs. Days are no watermark: late rows with new keys
    come in. The writers of one driver take turns; the last `keep` snapshots stay for readers that are under way. Rows with a null key
    part are one key; of a batch's rows of one key the first by `order` counts.

    part: splits the table by a text that is computed from key columns alone, a month for instance, so that a night's batch reads and
    writes the months that it has rows of. A batch touches few parts: their names go through the driver.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: list[str], compare: str, day: str, order: list[str], days: int = 7, keep: int = 2, today: date | None = None, part: Callable[[], Column] | None = None):
        self.spark, self.root, self.schema, self.keys, self.compare, self.day, self.order, self.days, self.keep, self.today = spark, root, schema, keys, compare, day, order, days, keep, today
        self.part = lambda: F.coalesce(part().cast("string"), F.lit("none")) if part else F.lit("all")
        self.turn = threading.Lock()

    def versions(self) -> list[tuple[int, str, int]]:
        """(version, writer, batch) of the snapshots that were written to their end, oldest first."""
        found = (re.fullmatch(r"snapshot=(\d+)-(.+)-(\d+)", n) for n in Folders(self.spark, f"{self.root}/snapshots").complete())
        return sorted((int(m[1]), m[2], int(m[3])) for m in found if m)

    def name(self, version: tuple[int, str, int]) -> str:
        return f"{version[0]:09d}-{version[1]}-{version[2]}"

    def at(self, version: tuple[int, str, int]) -> str:
        return f"{self.root}/snapshots/snapshot={self.name(version)}"

    def parts(self, version: tuple[int, str, int] | None) -> tuple[dict[str, str], date | None]:
        """The folder of each part as of a snapshot, and the newest day that any had: a row a part."""
        rows = self.spark.read.schema(PARTS).json(self.at(version)).collect() if version else []
        return {r["part"]: r["folder"] for r in rows if r["part"] is not None}, max((r["newest"] for r in rows if r["newest"]), default=None)

    def _rows(self, folders: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/data/{f}" for f in folders)) if folders else self.spark.createDataFrame([], self.schema)

    def read(self, version: tuple[int, str, int] | None = None) -> DataFrame:
        """The table as of a snapshot, the last one if none is named."""
        known = self.versions()
        return self._rows(sorted(self.parts(version or (known[-1] if known else None))[0].values()))

    def merge(self, batch: DataFrame, writer: str, number: int) -> None:
        """The next snapshot from a writer's batch; nothing if that batch is in the table already."""
        with self.turn:
            if self.told(writer, number):
                return
            known = self.versions()
            version = next((v for v in known if v[1:] == (writer, number)), None)
            if version is None:
                folders, newest = self.parts(known[-1] if known else None)
                version = (known[-1][0] + 1 if known else 1, writer, number)
                rows = one_per_key(batch.select(*self.schema.names), self.keys, [F.col(c) for c in self.order])
                told = batch.groupBy(self.part().alias("part")).agg(F.to_date(F.max(self.day)).alias("newest")).collect()  # a row a part
                touched = [r["part"] for r in told]
                newest = max((d for d in (newest, *(r["newest"] for r in told)) if d), default=None)
                recent = F.to_date(self.day) >= F.date_sub(F.lit(self.today or newest).cast("date"), self.days - 1)
                merged = merge_recent(self._rows([folders[p] for p in touched if p in folders]), rows, self.keys, self.compare, recent)
                merged.withColumn("__part", self.part()).write.mode("overwrite").partitionBy("__part").parquet(f"{self.root}/data/{self.name(version)}")
                # Folders are told as Spark wrote them: it escapes what a folder's name can't hold.
                places = Folders(self.spark, f"{self.root}/data/{self.name(version)}").values("__part")
                folders |= {p: f"{self.name(version)}/{name}" for p, name in places.items()}
                self.spark.createDataFrame([(p, f, newest) for p, f in folders.items()] or [(None, None, newest)], PARTS).coalesce(1).write.mode("overwrite").json(self.at(version))
            counts = self.changes(version).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
            counts.coalesce(1).write.mode("overwrite").parquet(f"{self.root}/outcomes/writer={writer}/batch={number}")  # three rows at most
            self._prune()

    def _prune(self) -> None:
        """Drop the snapshots before the kept ones, and parts that none of the kept ones has."""
        known = self.versions()
        used = {f for v in known[-self.keep :] for f in self.parts(v)[0].values()}
        for old in known[: -self.keep]:
            folders = Folders(self.spark, f"{self.root}/data/{self.name(old)}")
            for name in folders.values("__part").values():
                if f"{self.name(old)}/{name}" not in used:
                    folders.drop(name)
            if not folders.values("__part"):
                Folders(self.spark, f"{self.root}/snapshots").drop(f"snapshot={self.name(old)}")

    def told(self, writer: str, number: int) -> bool:
        """Whether a batch's outcome was written, which is the last thing that merge() does for it."""
        return f"batch={number}" in Folders(self.spark, f"{self.root}/outcomes/writer={writer}").complete()

    def outcomes(self) -> DataFrame:
        """(writer, batch, outcome, n): inserted, corrected and repeated keys of each batch."""
        schema, folders = "outcome string, n long, writer string, batch int", Folders(self.spark, f"{self.root}/outcomes")
        if not folders.exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", folders.root).parquet(folders.root)

    def changes(self, version: tuple[int, str, int]) -> DataFrame:
        """The rows of a kept snapshot's batch, with their outcome."""
        schema = StructType([*self.schema, StructField("outcome", StringType())])
        places = Folders(self.spark, f"{self.root}/data/{self.name(version)}").values("__part").values()
        rows = self.spark.read.schema(schema).parquet(*(f"{self.root}/data/{self.name(version)}/{p}" for p in places)) if places else self.spark.createDataFrame([], schema)
        return rows.filter("outcome <> 'kept'")

    def changes_of(self, writer: str, number: int) -> DataFrame:
        """The rows of a writer's batch that is still among the kept snapshots."""
        return self.changes(next(v for v in self.versions() if v[1:] == (writer, number)))

    def feed(self, stream: DataFrame, writer: str, checkpoint: str) -> StreamingQuery:
        """Merge the stream's batches until what is there now is through."""
        return stream.writeStream.foreachBatch(lambda batch, number: self.merge(batch, writer, number)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


PARTS = "part string, folder string, newest date"


def split_late(stream: DataFrame, root: str, ts: str, width: str, delay: str, checkpoint: str) -> StreamingQuery:
    """Rows whose time window closed before their batch go to `root`/late, the others to `root`/ontime, in folders of the batch's number (ST3).

    A window is closed once its end isn't after the watermark: the newest time of all earlier batches less the delay, which each batch
    writes down beside its rows. It is the rule by which a streaming aggregation drops rows, so that one over `root`/ontime that is
    run after each batch drops none. Rows without a time are late.
    """
    spark, kind = stream.sparkSession, stream.schema[ts].dataType.simpleString()

    def apply(batch: DataFrame, number: int) -> None:
        batch.agg(F.max(ts).alias("newest")).write.mode("overwrite").parquet(f"{root}/newest/batch={number:06d}")
        earlier = [n for n in Folders(spark, f"{root}/newest").complete() if int(n.split("=")[1]) < number]
        marks = spark.read.schema(f"newest {kind}").parquet(*(f"{root}/newest/{n}" for n in earlier)) if earlier else batch.limit(0).select(F.col(ts).alias("newest"))
        mark = F.broadcast(marks.agg((F.max("newest") - F.expr(f"interval {delay}")).alias("__mark")))  # one row
        end = F.window(F.coalesce(F.col(ts), F.lit("1970-01-01").cast(kind)), width)["end"]  # a window of a null would drop its row
        late = F.col(ts).isNull() | F.coalesce(end <= F.col("__mark"), F.lit(False))
        told = batch.crossJoin(mark).withColumn("__late", late).drop("__mark")
        for name, side in (("late", F.col("__late")), ("ontime", ~F.col("__late"))):
            told.filter(side).drop("__late").write.mode("overwrite").parquet(f"{root}/{name}/batch={number:06d}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, ts: str, by: list[str], width: str, delay: str, store: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Counts by time window and columns, held as the stream's state until the watermark passes a window; each batch stores what changed (ST3)."""
    counts = stream.withWatermark(ts, delay).groupBy(F.window(ts, width), *by).agg(F.count(F.lit(1)).alias("n"))
    told = counts.select(F.col("window.start").alias("start"), *by, "n")
    return told.writeStream.outputMode("update").foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
