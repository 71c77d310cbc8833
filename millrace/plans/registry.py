"""All queries of the core by name, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.plans import interfaces, metrics, problems, prompting, relational, scores, sequences, sources, streams, texts

MODULES = [problems, texts, relational, metrics, sequences, prompting, sources, streams, scores, interfaces]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
    for m in MODULES:
        out |= m.QUERIES
    return out


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in MODULES:
        out |= m.SQL
    return out


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return relational.q_reason_filter_stats(spark, folder)
