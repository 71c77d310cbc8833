"""Mixing sources to target shares of the total size (problem 3)."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.joins import join_skewed
from millrace.operators.ordered import running_sum
from millrace.session import stage

CELLS = 4096


def source_key(source: str) -> Column:
    """A source's name without case, outer blanks and the dash for an underscore; null for a blank one."""
    key = F.lower(F.regexp_replace(F.regexp_replace(F.col(source), r"^[\s ]+|[\s ]+$", ""), r"[-\s]+", "_"))
    return F.when(key != "", key)


def without_superseded(df: DataFrame, ident: str, key: str, order: list[str], size: str) -> DataFrame:
    """df with a null size in rows whose key was delivered again later by order, so that no entry is used under two ids.

    A null key is a key of its own. The last row of a key is found by an aggregate that reduces before the shuffle, and
    meets its rows by broadcast if the key holds over a thousandth of the rows.
    """
    keyed = df.withColumn("_key", F.coalesce(F.col(key).cast("string"), F.concat(F.lit("\0"), F.col(ident).cast("string"))))
    last = keyed.groupBy("_key").agg(F.max_by(ident, F.struct(*order, ident)).alias("_last"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    last = stage(last, "deliveries")
    hot = last.where(F.col("_n") > 0.001 * df.count()).select("_key").collect()  # a thousand rows at most
    hot = df.sparkSession.createDataFrame(hot, "_key string") if hot else None
    met = join_skewed(keyed, last.select("_key", "_last"), ["_key"], hot, "left")
    return met.withColumn(size, F.when(F.col("_last").isNull() | (F.col("_last") == F.col(ident)), F.col(size))).select(*df.columns)


def _plan(have: pd.DataFrame, targets: pd.DataFrame, total: float | None) -> pd.DataFrame:
    """Per target source: its size, quota and repeats; one row a source."""
    plan = targets.merge(have, on="source", how="left").fillna({"available": 0.0, "n": 0, "weighted": 0.0})
    live = (plan.available > 0) & (plan.target_share > 0) & (plan.max_repeats > 0)
    share = plan.target_share.where(live, 0.0)
    share = share / (share.sum() or 1)
    limit = plan.available * plan.max_repeats
    if total is None:  # the largest total at which no source goes beyond its repeats
        total = float((limit[live] / share[live]).min()) if live.any() else 0.0
    plan["quota"], plan["scaled_share"] = (share * total).clip(upper=limit), share
    return plan


def mix_entries(df: DataFrame, targets: DataFrame, ident: str, source: str, size: str, max_size: float = 120.0, total: float | None = None, weight: str | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """How often each entry is used, and what each source reaches.

    targets: source, target_share, max_repeats; one row a source, a small table. Sources are compared by source_key.
    Entries without a target source, or whose size isn't a number above 0 and up to max_size, aren't used (0 copies).

    total is the size of the mix; None takes the largest total at which every target source that has entries meets its
    share within its repeats. Sources without entries can't contribute; the shares of the others are scaled up to 1.

    An entry's expected copies are in proportion to weight (null: 1), held to its source's max_repeats, and such that a
    source's expected size is its quota. The whole part is given for certain. The fractions are the inclusion
    probabilities p of a Pareto order sample: entries are ranked by (u / (1 - u)) / (p / (1 - p)), u drawn from the hash
    of ident and seed, and the first are taken until the quota is met; the entry at the cut is taken if that comes
    nearer. The rank is cut in cells; only the cell where the quota is met is sorted, over range partitions, so no source
    and no cell meets in one task. What is broadcast has a row per source, weight level or range partition.

    First result: ident, source, copies. Second: source, target_share, scaled_share, max_repeats, entries, available, quota, used_entries,
    reached, actual_share. An empty table gives no entries and shares of null.
    """
    spark = df.sparkSession
    good = F.col(size).isNotNull() & ~F.isnan(size) & (F.col(size) > 0) & (F.col(size) <= max_size)
    w = F.coalesce(F.col(weight).cast("double"), F.lit(1.0)) if weight else F.lit(1.0)
    w = F.when(w > 0, F.round(F.log2(w) * 4) / 4).otherwise(F.lit(-8.0))  # weights in steps of a quarter octave: few levels
    rows = df.select(F.col(ident).alias("_id"), source_key(source).alias("source"), F.when(good, F.col(size).cast("double")).alias("_size"), F.least(F.greatest(w, F.lit(-8.0)), F.lit(8.0)).alias("_w"))
    rows = stage(rows, "entries")
    goal = targets.select(source_key("source").alias("source"), F.col("target_share").cast("double").alias("target_share"), F.col("max_repeats").cast("int").alias("max_repeats"))
    goal = goal.where("source is not null").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats")).toPandas()
    names = spark.createDataFrame(goal[["source"]], "source string")
    used = rows.where("_size is not null").join(F.broadcast(names), "source")
    levels = used.groupBy("source", "_w").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n")).toPandas()  # 65 levels a source
    have = levels.groupby("source", as_index=False).agg(available=("size", "sum"), n=("n", "sum")).assign(weighted=0.0)
    plan = _plan(have, goal, total)
    lift = _lift(levels, plan)
    expected = spark.createDataFrame(lift, "source string, _w double, _whole int, _p double, _rest double")
    u = (F.shiftrightunsigned(F.xxhash64(F.col("_id"), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    x = used.join(F.broadcast(expected), ["source", "_w"])
    odds = (u / (1 - u)) / (F.col("_p") / (1 - F.col("_p")))
    x = x.withColumn("_q", F.when(F.col("_p") > 0, odds)).withColumn("_cell", F.floor(F.col("_q") / (1 + F.col("_q")) * CELLS).cast("int"))
    cells = x.where("_q is not null").groupBy("source", "_cell", "_rest").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n")).toPandas()
    cuts = _cuts(cells)
    cut = spark.createDataFrame(cuts, "source string, _cut int, _need double")
    x = x.join(F.broadcast(cut), "source", "left")
    taken = F.when(F.col("_q").isNull() | F.col("_cut").isNull(), 0).when(F.col("_cell") < F.col("_cut"), 1).when(F.col("_cell") > F.col("_cut"), 0)
    x = stage(x.select("_id", "source", "_size", "_whole", "_q", "_need", taken.alias("_extra")), "sampled")
    # The cells at the cuts: a running sum by rank over range partitions, so a cell may hold any number of rows.
    edge = running_sum(x.where("_extra is null").drop("_extra"), ["source"], ["_q", "_id"], "_size", "_upto")
    rest = edge.select("_id", "source", "_size", (F.col("_whole") + (F.col("_upto") - F.col("_size") / 2 <= F.col("_need")).cast("int")).alias("copies"))
    sure = x.where("_extra is not null").select("_id", "source", "_size", (F.col("_whole") + F.col("_extra")).alias("copies"))
    picked = stage(sure.unionByName(rest), "picked")
    unused = rows.join(F.broadcast(names.withColumn("_t", F.lit(True))), "source", "left").where("_size is null or _t is null").select("_id", "source", F.lit(None).cast("double").alias("_size"), F.lit(0).alias("copies"))
    entries = picked.unionByName(unused).select(F.col("_id").alias(ident), "source", "copies")
    got = picked.groupBy("source").agg(F.sum(F.when(F.col("copies") > 0, 1).otherwise(0)).alias("used_entries"), F.sum(F.col("_size") * F.col("copies")).alias("reached"))
    report = spark.createDataFrame(plan[["source", "target_share", "scaled_share", "max_repeats", "n", "available", "quota"]].astype({"n": "int64"}), "source string, target_share double, scaled_share double, max_repeats int, entries long, available double, quota double")
    report = report.join(F.broadcast(got), "source", "left").na.fill({"used_entries": 0, "reached": 0.0})
    report = report.withColumn("actual_share", F.try_divide("reached", F.sum("reached").over(Window.partitionBy())))  # one row a source
    return entries, report


def _lift(levels: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
    """Per source and weight level: whole copies, the fraction, and the size the fractions must add up to."""
    out = []
    for row in plan.itertuples():
        own = levels[levels.source == row.source]
        if not len(own) or not row.quota:
            continue
        weight, cap, low, high = 2.0 ** own["_w"], float(row.max_repeats), 0.0, 1e9
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if float((own["size"] * (mid * weight).clip(upper=cap)).sum()) < row.quota else (low, mid)
        copies = (high * weight).clip(upper=cap)
        copies = copies.where((copies - copies.round()).abs() > 1e-9, copies.round())
        whole = copies.astype(int)
        rest = float(row.quota - (own["size"] * whole).sum())
        p = (copies - whole).clip(upper=1 - 1e-12)
        out.append(pd.DataFrame({"source": row.source, "_w": own["_w"], "_whole": whole.astype("int32"), "_p": p, "_rest": max(0.0, rest)}))
    return pd.concat(out) if out else pd.DataFrame({"source": pd.Series(dtype=str), "_w": pd.Series(dtype=float), "_whole": pd.Series(dtype="int32"), "_p": pd.Series(dtype=float), "_rest": pd.Series(dtype=float)})


def _cuts(cells: pd.DataFrame) -> pd.DataFrame:
    """Per source, the cell where the running size passes what is needed, and what is then still needed."""
    out = []
    for source, own in cells.sort_values("_cell").groupby("source"):
        own = own.groupby("_cell", as_index=False).agg(size=("size", "sum"), need=("_rest", "first"))
        upto = own["size"].cumsum()
        at = int((upto < own["need"]).sum())
        if at < len(own):
            out.append((source, int(own["_cell"].iloc[at]), float(own["need"].iloc[at] - (upto.iloc[at] - own["size"].iloc[at]))))
        else:
            out.append((source, int(own["_cell"].iloc[-1]) + 1, 0.0))
    return pd.DataFrame(out, columns=["source", "_cut", "_need"]).astype({"_cut": "int32"})
