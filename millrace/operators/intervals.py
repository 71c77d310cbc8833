"""Merging the intervals of each entity into periods, and the gaps between them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import PART
from millrace.session import shuffle_parts, stage


def _local_islands(keys: list[str]):
    """Merge what overlaps within a sorted partition; an entity's open island goes on over Arrow batches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: pd.DataFrame | None = None
        for batch in batches:
            pdf = batch if last is None else pd.concat([last, batch], ignore_index=True)
            if not len(pdf):
                continue
            new = np.zeros(len(pdf), bool)
            new[0] = True
            for k in keys:
                v = pdf[k]
                new[1:] |= (v.values[1:] != v.values[:-1]) & ~(v.isna().values[1:] & v.isna().values[:-1])
            start, end = pdf["start"].to_numpy(np.int64), pdf["end"].to_numpy(np.int64)
            group = np.cumsum(new)
            reach = pd.Series(end).groupby(group).cummax().to_numpy()  # an entity's furthest end so far
            new[1:] |= start[1:] > reach[:-1]
            first = np.flatnonzero(new)
            out = pdf.iloc[first].copy()
            out["end"] = np.maximum.reduceat(end, first)
            last = out.iloc[-1:]
            yield out.iloc[:-1]
        if last is not None:
            yield last

    return run


def periods_and_gaps(df: DataFrame, keys: Sequence[str], start: str, end: str, parts: int | None = None) -> DataFrame:
    """Periods and gaps of each entity: columns keys, kind ('period' or 'gap'), start, end (bigint).

    start and end must be whole numbers (see to_millis). Intervals that overlap, nest or touch form one period; a gap
    lies between two successive periods. Rows with a null key, start or end, or an end not after the start, are left
    out; repeated rows change nothing; an empty table gives an empty result; other columns are ignored.

    Method: rows are range-sorted by entity and start, so a hot entity is spread over many partitions; each partition
    merges its own rows and leaves a summary, its furthest end per entity; the summaries' prefix maxima are carried
    into the rescan, which tells where periods really begin, and a second prefix maximum labels them.
    """
    keys = list(keys)
    rows = df.select(*[F.col(k) for k in keys], F.col(start).cast("bigint").alias("start"), F.col(end).cast("bigint").alias("end"))
    rows = rows.dropna().where("end > start").groupBy(*keys, "start").agg(F.max("end").alias("end"))
    order = [*keys, "start"]
    sort = rows.repartitionByRange(parts or shuffle_parts(df), *order).sortWithinPartitions(*order)
    islands = stage(sort.mapInPandas(_local_islands(keys), sort.schema).withColumn(PART, F.spark_partition_id()), "islands")

    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    own = Window.partitionBy(PART, *keys).orderBy("start").rowsBetween(Window.unboundedPreceding, -1)

    # One row per partition and entity; only entities that go beyond a partition have anything to carry.
    ends = islands.groupBy(PART, *keys).agg(F.max("end").alias("_end"))
    reach = ends.withColumn("_reach", F.max("_end").over(before)).where(F.col("_reach").isNotNull()).drop("_end")
    marked = islands.join(F.broadcast(reach), [PART, *keys], "left")
    marked = marked.withColumn("_prior", F.greatest(F.col("_reach"), F.max("end").over(own))).drop("_reach")
    marked = stage(marked.withColumn("_new", F.col("_prior").isNull() | (F.col("start") > F.col("_prior"))), "marked")

    begun = marked.groupBy(PART, *keys).agg(F.max(F.when(F.col("_new"), F.col("start"))).alias("_begun"))
    open_at = begun.withColumn("_open", F.max("_begun").over(before)).where(F.col("_open").isNotNull()).drop("_begun")
    upto = Window.partitionBy(PART, *keys).orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    label = F.coalesce(F.max(F.when(F.col("_new"), F.col("start"))).over(upto), F.col("_open"))
    labelled = marked.join(F.broadcast(open_at), [PART, *keys], "left").withColumn("_label", label)
    periods = labelled.groupBy(*keys, "_label").agg(F.max("end").alias("end"))
    periods = periods.select(*keys, F.lit("period").alias("kind"), F.col("_label").alias("start"), "end")
    gaps = marked.where(F.col("_new") & F.col("_prior").isNotNull())
    gaps = gaps.select(*keys, F.lit("gap").alias("kind"), F.col("_prior").alias("start"), F.col("start").alias("end"))
    return periods.unionByName(gaps)


def to_millis(seconds: str):
    """Seconds as the nearest whole millisecond; null for null and not-a-number."""
    c = F.col(seconds)
    return F.when(c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 9e15), F.round(c * 1000).cast("bigint"))
