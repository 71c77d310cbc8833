"""Files in any store that the session's file systems reach, with a local copy kept beside it."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


class StoredFile:
    """A file under a store's path and where its local copy is: fetched once by get, written to the store by put.

    The store is whatever Hadoop's file systems reach by the path's scheme; a local path is its own copy. Data is better
    read by Spark where it lies; this is for what a library must have as a file (a model, a vocabulary).
    """

    def __init__(self, spark: SparkSession, path: str, local: str | None = None) -> None:
        self.spark, self.path = spark, path
        scheme = path.partition("://")[0] if "://" in path else ""
        self.is_local = scheme in ("", "file")
        plain = path.removeprefix("file://")
        self.local = local or (plain if self.is_local else os.path.join(os.path.expanduser("~"), ".cache", "millrace", plain.partition("://")[2]))

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        there = jvm.org.apache.hadoop.fs.Path(self.path)
        return there, there.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path(f"file://{os.path.abspath(self.local)}")

    @property
    def exists(self) -> bool:
        there, fs, _ = self._fs()
        return bool(fs.exists(there))

    def get(self, again: bool = False) -> str:
        """The local copy's path; copied from the store where it isn't there yet, or if asked for again."""
        there, fs, here = self._fs()
        if not fs.exists(there):
            raise FileNotFoundError(self.path)
        if again or not os.path.exists(self.local):
            os.makedirs(os.path.dirname(os.path.abspath(self.local)), exist_ok=True)
            fs.copyToLocalFile(False, there, here, True)
        return self.local

    def put(self) -> None:
        """Write the local copy to the store, over what may be there."""
        if not os.path.exists(self.local):
            raise FileNotFoundError(self.local)
        there, fs, here = self._fs()
        if not self.is_local or os.path.abspath(self.local) != os.path.abspath(self.path.removeprefix("file://")):
            fs.copyFromLocalFile(False, True, here, there)
