"""Order-dependent work over a whole table without one task seeing it all.

The pattern: range-partition by the order, sort within partitions, keep each row's partition and place, reduce every
partition to a summary of bounded size, combine the summaries in partition order, and rescan with what was carried.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import shuffle_parts, stage

PART, PLACE = "_part", "_place"


def as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def range_sorted(df: DataFrame, order: Sequence[str | Column], parts: int | None = None) -> DataFrame:
    """df range-partitioned and sorted by order, staged, with the partition (_part) and the place in it (_place).

    Equal keys meet in one partition, so order should end in a unique column where one value can be hot.
    """
    cols = as_columns(order)
    at = F.monotonically_increasing_id()
    out = df.repartitionByRange(parts or shuffle_parts(df), *cols).sortWithinPartitions(*cols)
    out = out.withColumn("_at", at)
    out = out.withColumn(PART, F.shiftright("_at", 33).cast("int")).withColumn(PLACE, F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
    return stage(out.drop("_at"), "sorted")


def with_position(df: DataFrame, order: Sequence[str | Column], name: str = "position", parts: int | None = None) -> DataFrame:
    """Add the row's place from 0 in the order over the whole table; an empty table stays empty.

    Only the partitions' row counts (one row each) are combined in one task and broadcast.
    """
    there = range_sorted(df, order, parts)
    counts = there.groupBy(PART).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    return there.join(F.broadcast(starts), PART).withColumn(name, F.col("_start") + F.col(PLACE)).drop(PART, PLACE, "_start")


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str, parts: int | None = None) -> DataFrame:
    """Add the sum of value over the rows of the same keys up to and with this one, in the given order.

    keys may be empty or hot: a key's rows are spread over partitions, and only one sum per partition and key that
    goes beyond a partition is carried. Null values count as 0.
    """
    there = range_sorted(df, [*keys, *order], parts)
    own = Window.partitionBy(PART, *keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    local = there.withColumn("_sum", F.coalesce(F.sum(value).over(own), F.lit(0)))
    edges = there.groupBy(PART, *keys).agg(F.coalesce(F.sum(value), F.lit(0)).alias("_total"))
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = edges.withColumn("_before", F.sum("_total").over(before)).where(F.col("_before").isNotNull()).drop("_total")
    same = [local[c].eqNullSafe(carried[c]) for c in (PART, *keys)]
    joined = local.join(F.broadcast(carried), _all(same), "left")
    return joined.select(*[local[c] for c in df.columns], (local["_sum"] + F.coalesce(carried["_before"], F.lit(0))).alias(name))


def scanned(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], sums: dict[str, str], before: dict[str, str] | None = None, parts: int | None = None) -> DataFrame:
    """Several running sums (name to value), and values of the row before (name to value), in one pass per keys and order."""
    before = before or {}
    there = range_sorted(df, [*keys, *order], parts)
    w = Window.partitionBy(PART, *keys).orderBy(PLACE)
    upto, prior = w.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    local = there.withColumns({f"_s_{n}": F.coalesce(F.sum(v).over(upto), F.lit(0)) for n, v in sums.items()} | {f"_b_{n}": F.lag(F.struct(F.col(v).alias("v"))).over(w) for n, v in before.items()})
    edges = there.groupBy(PART, *keys).agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(f"_t_{n}") for n, v in sums.items()], *[F.max_by(F.struct(F.col(v).alias("v")), PLACE).alias(f"_t_{n}") for n, v in before.items()])
    carried = edges.select(PART, *keys, *[F.sum(f"_t_{n}").over(prior).alias(f"_c_{n}") for n in sums], *[F.last(f"_t_{n}").over(prior).alias(f"_c_{n}") for n in before], F.count(F.lit(1)).over(prior).alias("_k")).where("_k > 0").drop("_k")
    joined = local.join(F.broadcast(carried), _all([local[c].eqNullSafe(carried[c]) for c in (PART, *keys)]), "left")
    return joined.select(
        *[local[c] for c in df.columns], *[(F.col(f"_s_{n}") + F.coalesce(F.col(f"_c_{n}"), F.lit(0))).alias(n) for n in sums],
        *[F.coalesce(f"_b_{n}", f"_c_{n}")["v"].alias(n) for n in before],
    )


def carry_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], value: str, name: str, parts: int | None = None) -> DataFrame:
    """Add the last non-null value of the rows strictly before this one with the same keys, in the given order.

    As running_sum, but what is carried over partition borders is each key's last non-null value.
    """
    there = range_sorted(df, [*keys, *order], parts)
    own = Window.partitionBy(PART, *keys).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, -1)
    local = there.withColumn("_last", F.last(value, ignorenulls=True).over(own))
    edges = there.where(F.col(value).isNotNull()).groupBy(PART, *keys).agg(F.max_by(value, PLACE).alias("_edge"))
    spans = there.groupBy(PART, *keys).agg(F.lit(1).alias("_one"))
    spans = spans.join(edges, [spans[c].eqNullSafe(edges[c]) for c in (PART, *keys)], "left").select(*[spans[c] for c in (PART, *keys)], "_edge")
    before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.withColumn("_before", F.last("_edge", ignorenulls=True).over(before)).where(F.col("_before").isNotNull()).drop("_edge")
    same = [local[c].eqNullSafe(carried[c]) for c in (PART, *keys)]
    joined = local.join(F.broadcast(carried), _all(same), "left")
    return joined.select(*[local[c] for c in df.columns], F.coalesce(local["_last"], carried["_before"]).alias(name))


def _all(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out & t
    return out
