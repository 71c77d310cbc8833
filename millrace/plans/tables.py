"""Reading the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table of that name; its columns and filters are pushed into the scan by Catalyst."""
    return spark.read.parquet(f"{folder}/{name}.parquet")
