"""Folders that jobs write, seen through the file system that Spark uses for them."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession


class Folders:
    """Names and marks of the folders below a path, through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.files = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.root = root

    def exists(self) -> bool:
        return self.files.exists(self.path(self.root))

    def complete(self) -> list[str]:
        """Names of the folders that a job wrote to its end."""
        if not self.exists():
            return []
        names = [s.getPath().getName() for s in self.files.listStatus(self.path(self.root)) if s.isDirectory()]
        return sorted(n for n in names if self.files.exists(self.path(f"{self.root}/{n}/_SUCCESS")))

    def values(self, column: str) -> dict[str, str]:
        """The values of a partition column that folders below the path are named by, and those names."""
        if not self.exists():
            return {}
        names = [s.getPath().getName() for s in self.files.listStatus(self.path(self.root)) if s.isDirectory()]
        return {unquote(n.split("=", 1)[1]): n for n in names if n.startswith(f"{column}=")}

    def drop(self, name: str) -> None:
        self.files.delete(self.path(self.root, name), True)
