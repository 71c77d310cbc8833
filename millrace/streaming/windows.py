"""Event-time aggregates over streams: sessions, windows and deduplication with watermarks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sessions(events: DataFrame, key: str, time: str, gap: str, delay: str, aggs: Sequence[Column]) -> DataFrame:
    """Sessions of a key: an event within gap of the one before belongs to its session; events later than delay are late."""
    out = events.withWatermark(time, delay).groupBy(key, F.session_window(time, gap).alias("_w")).agg(*aggs)
    return out.select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *[c for c in out.columns if c not in (key, "_w")])


def windows(events: DataFrame, keys: Sequence[str], time: str, width: str, slide: str | None, delay: str, aggs: Sequence[Column]) -> DataFrame:
    """Tumbling (slide None) or sliding windows of event time per keys."""
    w = F.window(time, width, slide) if slide else F.window(time, width)
    out = events.withWatermark(time, delay).groupBy(w.alias("_w"), *keys).agg(*aggs)
    return out.select(*keys, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *[c for c in out.columns if c not in (*keys, "_w")])


def once(events: DataFrame, keys: Sequence[str], time: str, delay: str) -> DataFrame:
    """Events without what was delivered again within delay."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
