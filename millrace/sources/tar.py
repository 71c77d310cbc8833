"""Tar shards: a data source of their members, and writing rows as shards."""

from __future__ import annotations

import glob
import io
import os
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition

from millrace.operators.ordered import with_position

SCHEMA = "shard string, member string, stem string, size long, payload binary"


class Shard(InputPartition):
    def __init__(self, path: str):
        super().__init__(path)
        self.path = path


class TarReader(DataSourceReader):
    """One task a shard, streaming; shards that a filter on shard rules out aren't opened, members likewise not read."""

    def __init__(self, options: dict[str, str]):
        self.paths = sorted(p for part in options["path"].split(",") for p in glob.glob(part.removeprefix("file://")))
        self.payload = options.get("payload", "true").lower() == "true"
        self.members: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            name = ".".join(f.attribute) if isinstance(f, (EqualTo, In)) else ""
            wanted = {f.value} if isinstance(f, EqualTo) else set(f.value) if isinstance(f, In) else set()
            if name == "shard":
                self.paths = [p for p in self.paths if os.path.basename(p) in wanted]
            elif name == "member":
                self.members = wanted if self.members is None else self.members & wanted
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        return [Shard(p) for p in self.paths]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        if not isinstance(partition, Shard):
            return
        with tarfile.open(partition.path, "r|*") as tar:
            for m in tar:
                if m.isfile() and (self.members is None or m.name in self.members):
                    data = tar.extractfile(m).read() if self.payload else None
                    yield os.path.basename(partition.path), m.name, os.path.splitext(os.path.basename(m.name))[0], m.size, data


class TarSource(DataSource):
    """Members of tar files. Options: path (may have wild cards and commas), payload (false leaves it null)."""

    @classmethod
    def name(cls) -> str:
        return "tar_shards"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TarReader:  # noqa: ANN001
        return TarReader(dict(self.options))


def read_tar(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Members of the tar files that the path matches; every machine must see the folder."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TarSource)
    return spark.read.format("tar_shards").option("path", path).option("payload", str(payload).lower()).load()


def assign_shards(df: DataFrame, order: list[str], shard_size: int) -> DataFrame:
    """Rows with shard, a new one every shard_size rows in order, and index in the shard."""
    placed = with_position(df, order, "_at")
    return placed.withColumn("shard", F.floor(F.col("_at") / shard_size)).withColumn("index", (F.col("_at") % shard_size).cast("int")).drop("_at")


def write_tar(df: DataFrame, shard: str, order: str, member: str, payload: str, folder: str, prefix: str = "audio") -> DataFrame:
    """Each shard as folder/prefix_N.tar, written by one task: shard, path, members.

    A file is written under another name and then moved, so a task that is run again leaves no half of a shard. The result
    must be acted on for the files to be written.
    """
    root = folder.removeprefix("file://")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        os.makedirs(root, exist_ok=True)
        path = f"{root}/{prefix}_{key[0]}.tar"
        part = f"{path}.{os.getpid()}"
        with tarfile.open(part, "w") as tar:
            for r in pdf.sort_values(order).itertuples(index=False):
                data = getattr(r, payload)
                data = data.encode() if isinstance(data, str) else bytes(data or b"")
                info = tarfile.TarInfo(str(getattr(r, member)))
                info.size = len(data)
                tar.addfile(info, io.BytesIO(data))
        os.replace(part, path)
        return pd.DataFrame({"shard": [key[0]], "path": [path], "members": [len(pdf)]})

    return df.groupBy(shard).applyInPandas(run, "shard long, path string, members long")
