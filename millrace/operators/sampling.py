"""Sampling, splitting, interleaving and blending, all deterministic by hash."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators.ordered import running_sum, with_position
from millrace.session import stage


def hash_order(key: str, seed: int | str) -> list[Column]:
    """A shuffled order: by the md5 of seed and key, ties by key."""
    return [F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string"))), F.col(key)]


def split_exactly(df: DataFrame, key: str, shares: Sequence[tuple[str, float]], seed: int | str) -> DataFrame:
    """Each row's split by its place in hash order; a split but the last has int(share * n) rows."""
    n = df.count()
    placed = with_position(df, hash_order(key, seed), "_at")
    edge, name = 0, F.lit(shares[-1][0])
    cuts = []
    for label, share in shares[:-1]:
        edge += int(share * n)
        cuts.append((label, edge))
    for label, cut in reversed(cuts):
        name = F.when(F.col("_at") < cut, label).otherwise(name)
    return placed.withColumn("split", name).drop("_at")


def ranks_within(df: DataFrame, group: Sequence[str], order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Each row's rank from 1 within its group; a group may hold most rows."""
    return running_sum(df.withColumn("_one", F.lit(1)), list(group), order, "_one", name).drop("_one")


def stratified_split(df: DataFrame, key: str, label: str, share: float, seed: int | str) -> DataFrame:
    """'test' for the first ceil(share * n) rows of each label in hash order, 'train' for the others."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    ranked = ranks_within(df, [label], hash_order(key, seed), "_r")
    met = ranked.join(F.broadcast(sizes.withColumnRenamed(label, "_l")), F.col(label).eqNullSafe(F.col("_l"))) if sizes.count() <= 100_000 else ranked.join(sizes.withColumnRenamed(label, "_l"), F.col(label).eqNullSafe(F.col("_l")))
    return met.withColumn("split", F.when(F.col("_r") <= F.ceil(share * F.col("_n")), "test").otherwise("train")).select(*df.columns, "split")


def rebalance(df: DataFrame, key: str, label: str, seed: int | str) -> DataFrame:
    """Rows with the number of copies that bring every label to the size of the largest; extras go by hash order."""
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    most = sizes.agg(F.max("_n")).first()[0] or 0
    ranked = ranks_within(df, [label], hash_order(key, seed), "_r").join(sizes, label)
    return ranked.withColumn("copies", (F.floor(F.lit(most) / F.col("_n")) + (F.col("_r") <= F.lit(most) % F.col("_n")).cast("bigint")).cast("bigint")).select(*df.columns, "copies")


def repeated(df: DataFrame, copies: str, name: str = "copy") -> DataFrame:
    """Each row as often as its copies say; 0 copies drop it."""
    return df.where(F.col(copies) > 0).withColumn(name, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(copies).cast("bigint"))))


def round_robin(df: DataFrame, group: str, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """One row of each group in turn, in the groups' order; groups that are exhausted are skipped."""
    ranked = ranks_within(df, [group], order, "_r")
    return with_position(ranked, ["_r", group], name).drop("_r")


def nested_round_robin(df: DataFrame, group: str, source: str, order: Sequence[Column | str], name: str = "place") -> DataFrame:
    """Groups in turn, and within a group its sources in turn."""
    inner = ranks_within(df, [group, source], order, "_s")
    outer = ranks_within(inner, [group], ["_s", source], "_r")
    return with_position(outer, ["_r", group], name).drop("_s", "_r")


def balanced_draws(sizes: DataFrame, group: str, source: str, size: str, draws: int) -> DataFrame:
    """draws of each group with its sources in turn, an exhausted source starting again: group, draw, source, index, cycle."""
    n = F.count(F.lit(1)).over(Window.partitionBy(group))
    at = F.row_number().over(Window.partitionBy(group).orderBy(source)) - 1
    s = sizes.select(group, source, F.col(size).alias("_size"), at.alias("_at"), n.alias("_n"))
    k = F.explode(F.sequence(F.lit(0), F.lit(draws - 1))).alias("draw")
    turns = sizes.select(group).distinct().select(group, k)
    met = turns.join(s, group).where(F.col("draw") % F.col("_n") == F.col("_at"))
    turn = F.floor(F.col("draw") / F.col("_n"))
    return met.select(group, "draw", source, (turn % F.col("_size")).alias("index"), F.floor(turn / F.col("_size")).alias("cycle"))


def bin_table(weights: Sequence[float], bins: int) -> list[tuple[int, int, int, int]]:
    """Per bin: bin, source, bias and the source's number of bins; the last source takes what is left over."""
    total = float(sum(weights))
    out: list[tuple[int, int]] = []
    for i, w in enumerate(weights):
        out += [(i, k) for k in range(int(w / total * bins))]
    last = out[-1][1]
    out += [(len(weights) - 1, last + k) for k in range(bins - len(out))]
    held = {i: sum(s == i for s, _ in out) for i in range(len(weights))}
    if min(held.values()) < 1:
        raise ValueError("a source has no bin; take more bins or a larger weight")
    return [(b, s, bias, held[s]) for b, (s, bias) in enumerate(out)]


def blend_by_bins(spark: SparkSession, weights: Sequence[float], sizes: Sequence[int], size: int, bins: int = 100) -> DataFrame:
    """Which source and sample each place of a blend takes, by a closed form: place, source, sample."""
    bins = min(bins, size)
    table = spark.createDataFrame([(b, s, bias, n, int(sizes[s])) for b, s, bias, n in bin_table(weights, bins)], "bin int, source int, bias long, held long, size long")
    places = spark.range(size).select(F.col("id").alias("place"), (F.col("id") % bins).cast("int").alias("bin"))
    return places.join(F.broadcast(table), "bin").select("place", "source", ((F.col("bias") + F.floor(F.col("place") / bins) * F.col("held")) % F.col("size")).alias("sample"))


def blend_by_deficit(spark: SparkSession, weights: Sequence[float], size: int) -> DataFrame:
    """As blend_by_bins, each place taking the source that lacks most: place, source, sample.

    The sequence depends on the weights only and is made in one task, batch by batch.
    """
    w = np.asarray(weights, float) / float(sum(weights))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken = np.zeros(len(w))
        for pdf in batches:
            source, sample = np.zeros(len(pdf), np.int32), np.zeros(len(pdf), np.int64)
            for j, i in enumerate(pdf["id"].to_numpy()):
                k = int(np.argmax(w * max(float(i), 1.0) - taken))
                source[j], sample[j] = k, int(taken[k])
                taken[k] += 1
            yield pd.DataFrame({"place": pdf["id"], "source": source, "sample": sample})

    return spark.range(0, size, 1, 1).mapInPandas(run, "place long, source int, sample long")


def temperature_quotas(sizes: DataFrame, size: str, temperature: float, total: int) -> DataFrame:
    """Sources with probability p = n^(1/T) normalized and their whole quota of total."""
    p = F.pow(F.col(size), F.lit(1.0 / temperature))
    return sizes.withColumn("probability", p / F.sum(p).over(Window.partitionBy())).withColumn("quota", F.round(F.col("probability") * total).cast("bigint"))  # one row a source


def weighted_draws(df: DataFrame, key: str, weight: str, draws: int, seed: int) -> DataFrame:
    """draws rows with replacement, in proportion to weight: draw, key. Weights are cut to whole millionths of the total.

    Each draw is a number below the total; it meets the row whose range of the running weight holds it by an equi-join on
    blocks of the running weight.
    """
    total = df.agg(F.sum(weight)).first()[0] or 0
    spark = df.sparkSession
    if not total:
        return df.select(F.lit(0).cast("bigint").alias("draw"), key).where("false")
    rows = df.where(F.col(weight) > 0).select(F.col(key).alias("_k"), F.col(weight).alias("_w"))
    upto = stage(running_sum(rows, [], ["_k"], "_w", "_hi"), "weights")
    block = max(float(total) / 1024, 1e-12)
    rows = upto.withColumn("_lo", F.col("_hi") - F.col("_w")).withColumn("_b", F.explode(F.sequence(F.floor(F.col("_lo") / block).cast("bigint"), F.floor(F.col("_hi") / block).cast("bigint"))))
    u = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string"))), 1, 12), 16, 10).cast("double") / float(1 << 48) * float(total)
    drawn = spark.range(draws).select(F.col("id").alias("draw"), u.alias("_u")).withColumn("_b", F.floor(F.col("_u") / block).cast("bigint"))
    return drawn.join(rows, "_b").where((F.col("_u") >= F.col("_lo")) & (F.col("_u") < F.col("_hi"))).select("draw", F.col("_k").alias(key))


def data_parallel(df: DataFrame, order: Sequence[Column | str], ranks: int, micro_batch: int, consumed: int = 0, drop_last: bool = True) -> DataFrame:
    """Each row's step, rank and slot in data-parallel batches after the consumed rows; an odd last step may be dropped."""
    n = df.count()
    wide = ranks * micro_batch
    placed = with_position(df, order, "_at").where(F.col("_at") >= consumed)
    i = F.col("_at") - consumed
    out = placed.withColumn("step", F.floor(i / wide)).withColumn("rank", F.floor(i % wide / micro_batch).cast("int")).withColumn("slot", (i % micro_batch).cast("int")).drop("_at")
    return out.where(F.col("step") < max(0, n - consumed) // wide) if drop_last else out
