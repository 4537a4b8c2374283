"""Helpers of the operators: table reading, shared scratch tables, Arrow text buffers, numpy hashes."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Tables written to the folder in spark.checkpoint.dir, which every executor shares.

    The folder is read from the session; only where it is unset and Spark is local (tests) a temporary one is set.
    A written table cuts lineage and outlives lost executors.
    """

    def __init__(self, spark: SparkSession, label: str):
        root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            root = tempfile.mkdtemp(prefix="ledgerlark-")
            spark.sparkContext.setCheckpointDir(root)
            root = spark.sparkContext.getCheckpointDir()
        self.spark, self.root = spark, f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path, schema = f"{self.root}/{name}", df.schema
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        del df
        # The job's shuffle files go when the driver collects what refers to them; nothing reads them any more.
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(schema).parquet(path)

    def levels(self, name: str, like: DataFrame) -> DataFrame:
        """The tables saved as name/depth=<d> as one, with their depth; their columns are those of `like`."""
        return self.spark.read.schema(StructType([*like.schema, StructField("depth", LongType())])).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(conf).delete(path, True)


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the n + 1 offsets into them; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.type not in (pa.large_string(), pa.large_binary()):
        column = column.cast(pa.large_string() if pa.types.is_string(column.type) else pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, pa.scalar("" if pa.types.is_large_string(column.type) else b"", column.type))
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def pieces(offsets: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Row ranges of about size bytes each, for working memory that doesn't grow with the batch; a row is never cut."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def word_cuts(gap: np.ndarray, edges: np.ndarray, size: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Slices of about size bytes that end at a gap or at a row's edge, so that no word is cut; a longer word is a slice of its own."""
    lo, n = 0, len(gap)
    while lo < n:
        hi = min(lo + size, n)
        while hi < n:
            ahead = np.flatnonzero(gap[hi : hi + size] | edges[hi : hi + size][: n - hi])
            hi = min(hi + (int(ahead[0]) if len(ahead) else size), n)
            if len(ahead):
                break
        yield lo, hi
        lo = hi


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix constants): close keys become far apart."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def byte_keys(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte."""
    return mixed(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed))


def gram_hashes(data: np.ndarray, k: int, seed: int = 1) -> np.ndarray:
    """The mixed 64-bit hash of the k bytes from each position on; positions too near the end are left out."""
    if len(data) < k:
        return np.zeros(0, U64)
    base = 0x9E3779B97F4A7C15
    powers: dict[int, np.ndarray] = {1: byte_keys(seed)[data]}
    length, have = 1, powers[1]
    while length * 2 <= k:
        step = U64(pow(base, length, 1 << 64))
        have = have[:-length] * step + have[length:]
        length *= 2
        powers[length] = have
    out, done = None, 0
    n = len(data) - k + 1
    for length in sorted(powers, reverse=True):
        if k - done >= length:
            part = powers[length][done : done + n]
            out = part.copy() if out is None else out * U64(pow(base, length, 1 << 64)) + part
            done += length
    return mixed(out)


def split_rule(column: str, modulus: int):
    """crc32 of an id's decimal text modulo a number: the folds that the labels are held out by."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(modulus))


#: A group of over 1 / HEAVY of all rows is joined by broadcast.
HEAVY = 1000


def spread_join(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, total: int, how: str = "inner") -> DataFrame:
    """rows with the columns of groups, which has one row a key and its number of rows in `size`; keys hold no nulls.

    Groups of over a thousandth of all rows, fewer than a thousand, are broadcast, so that their rows stay where they are; the
    others are shuffled, and no key gives a task more than a thousandth of the rows. rows is read twice and should be a written table.
    """
    hot = F.col(size) * HEAVY > total
    heavy = F.broadcast(groups.filter(hot))
    return rows.join(heavy, keys).unionByName(rows.join(heavy.select(*keys), keys, "left_anti").join(groups.filter(~hot), keys, how))
