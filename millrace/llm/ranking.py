"""One ranking from several scores on unlike scales (problem 1)."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import running_sum, with_position
from millrace.session import stage


class Score(NamedTuple):
    """A score column, whether a high value is good, and its weight."""

    name: str
    high_is_good: bool = True
    weight: float = 1.0


def _valid(name: str) -> Column:
    c = F.col(name).cast("double")
    return F.when(~F.isnan(c), c)


def average_ranks(values: DataFrame, key: str, value: str) -> DataFrame:
    """Per key and distinct value, the competition rank from 1 (smallest first) averaged over its ties.

    Columns: key, value, n (rows of that value), n_key (rows of that key), rank. Counts are summed before the shuffle
    and the running count goes over range partitions, so neither a hot value nor a hot key meets in one task.
    """
    counts = values.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    upto = stage(running_sum(counts, [key], [value], "n", "_upto"), "ranks")
    whole = upto.groupBy(key).agg(F.sum("n").alias("n_key"))
    return upto.join(F.broadcast(whole), key).select(key, value, "n", "n_key", (F.col("_upto") - F.col("n") + (F.col("n") + 1) / 2).alias("rank"))


def borda_ranking(df: DataFrame, ident: str, scores: Sequence[Score], hot_share: float = 0.001) -> DataFrame:
    """One ranking of all rows by weighted Borda points: columns ident, a points column per score, points, rank.

    Within a score, ties share the average of their competition ranks; points run from 1 (best) to 0 (worst), the share
    of the other rows with that score that this row beats, ties half. So every score has the same range, however it is
    distributed and however many of its values are missing. A missing score (null or not-a-number) stands at the middle
    rank: 0.5 points; so does the only value of a score. Ranks go from 1 by points, ties by ident. Rows with a null
    ident are left out; of rows that repeat an ident the one with the smallest scores in column order counts (nulls
    first). An empty table gives an empty ranking. Other columns are ignored.
    """
    names = [s.name for s in scores]
    one = df.select(F.col(ident).alias("_id"), *[_valid(n).alias(f"_s{i}") for i, n in enumerate(names)]).where("_id is not null")
    one = one.groupBy("_id").agg(F.min(F.struct(*[f"_s{i}" for i in range(len(names))])).alias("_s")).select("_id", "_s.*")
    one = stage(one, "scores")
    signed = [F.struct(F.lit(i).alias("_k"), (F.col(f"_s{i}") * (-1.0 if s.high_is_good else 1.0) + 0.0).alias("_v")) for i, s in enumerate(scores)]
    long = one.select("_id", F.explode(F.array(*signed)).alias("_x")).select("_id", "_x.*")
    ranks = average_ranks(long.where("_v is not null"), "_k", "_v")
    points = F.when(F.col("n_key") > 1, (F.col("n_key") - F.col("rank")) / (F.col("n_key") - 1)).otherwise(0.5)
    ranks = stage(ranks.select("_k", "_v", "n", "n_key", points.alias("_p")), "points")
    # A value of over hot_share of a score's rows goes by broadcast: 1 / hot_share rows a score at most.
    hot = ranks.where(F.col("n") > hot_share * F.col("n_key")).select("_k", "_v", "_p")
    cold = ranks.where(F.col("n") <= hot_share * F.col("n_key")).select("_k", "_v", "_p")
    met = long.join(F.broadcast(hot), ["_k", "_v"], "left")
    done = met.where("_p is not null or _v is null").select("_id", "_k", F.coalesce("_p", F.lit(0.5)).alias("_p"))
    rest = met.where("_p is null and _v is not null").select("_id", "_k", "_v").join(cold, ["_k", "_v"]).select("_id", "_k", "_p")
    each = [F.max(F.when(F.col("_k") == i, F.col("_p"))).alias(f"{n}_points") for i, n in enumerate(names)]
    total = sum((F.col(f"{s.name}_points") * F.lit(float(s.weight)) for s in scores), F.lit(0.0))
    summed = done.unionByName(rest).groupBy("_id").agg(*each).withColumn("points", F.round(total, 9))
    ranked = with_position(summed, [F.col("points").desc(), F.col("_id").asc()], "_at")
    return ranked.select(F.col("_id").alias(ident), *[f"{n}_points" for n in names], "points", (F.col("_at") + 1).alias("rank"))
