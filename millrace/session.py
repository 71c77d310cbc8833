"""Session helpers: settings for tests and benches, and tables written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "millrace", cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


#: The folders of local sessions without the setting, by application.
_own: dict[str, str] = {}
#: Paths given out since the block of scratch began.
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, from spark.checkpoint.dir.

    Where the setting is absent, a local session gets a folder of its own; on a cluster its absence is an error,
    as a machine's own temporary folder would be lost with that machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = f"file://{tempfile.mkdtemp(prefix='millrace-')}"
        _gone_at_exit(spark, _own[app])
    return _own[app]


def _gone_at_exit(spark: SparkSession, path: str) -> None:
    """Have Hadoop delete the path when the application ends."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _gone_at_exit(spark, path)
    _made.append(path)
    return path


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors.

    The table goes when the application ends, or with the block of scratch it is made in.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end of the block, the tables staged in it; what is made of them must be written by then.

    A session that runs many queries wraps each in a block of its own, so that their intermediate tables don't pile up.
    """
    outer = list(_made)
    _made.clear()
    try:
        yield
    finally:
        for path in _made:
            there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(there, True)
        _made[:] = outer


def shuffle_parts(df: DataFrame) -> int:
    """The number of shuffle partitions of the session."""
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
