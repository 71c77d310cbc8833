"""Joins of manifests with payloads, predictions, annotations and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import with_position


def hot_keys(df: DataFrame, on: Sequence[str], share: float = 0.001) -> DataFrame | None:
    """The keys that hold over share of df's rows, at most 1 / share of them, or None where no key does."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    found = counts.where(F.col("_n") > share * total).select(*on).collect()
    return df.sparkSession.createDataFrame(found, df.select(*on).schema) if found else None


def join_skewed(left: DataFrame, right: DataFrame, on: Sequence[str], hot: DataFrame | None, how: str = "inner") -> DataFrame:
    """left joined with a right side that has each key once; rows of the hot keys (see hot_keys) meet it by broadcast.

    Only the hot keys' rows of the right side are broadcast, so their number has the bound of hot_keys; the others are
    shuffled on both sides, and no key among them holds more than the share. how is inner or left.
    """
    rest = right.hint("merge")  # by sorting, so that what is broadcast doesn't grow with the data
    if hot is None:
        return left.join(rest, list(on), how)
    marked = left.join(F.broadcast(hot.select(*on, F.lit(True).alias("_hot"))), list(on), "left")
    few = right.join(F.broadcast(hot.select(*on)), list(on), "left_semi")
    done = marked.where("_hot").drop("_hot").join(F.broadcast(few), list(on), how)
    return done.unionByName(marked.where("_hot is null").drop("_hot").join(rest, list(on), how))


def member_stem(path: str | Column) -> Column:
    """The name under which a payload is found: '-subN' before the extension falls away."""
    c = F.col(path) if isinstance(path, str) else path
    return F.regexp_replace(c, r"-sub\d+(\.\w+)?$", "$1")


def with_payload(manifest: DataFrame, payload: DataFrame, path: str, member: str, strict: bool = False) -> DataFrame:
    """Manifest rows with their payload; one payload may serve several rows. Rows without one go, or are an error."""
    keyed = manifest.withColumn("_stem", member_stem(path))
    if strict:
        missing = keyed.join(payload, keyed["_stem"] == payload[member], "left_anti").limit(1).collect()
        if missing:
            raise ValueError(f"no payload for {missing[0][path]!r}")
    return keyed.join(payload, keyed["_stem"] == payload[member]).drop("_stem")


def set_difference_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys that only one side has: key, side ('left' or 'right'); no rows if the sets are equal."""
    x, y = a.select(key).distinct(), b.select(key).distinct()
    return x.join(y, key, "left_anti").select(key, F.lit("left").alias("side")).unionByName(y.join(x, key, "left_anti").select(key, F.lit("right").alias("side")))


def last_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of the rows of a key the last in order; a map-side aggregate, so a hot key is reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*").select(*df.columns)


def with_predictions(rows: DataFrame, predictions: DataFrame, keys: Sequence[str], text: str, predicted: str, order: Sequence[str]) -> DataFrame:
    """Rows with the prediction's text where there is one: columns of rows, orig_text.

    The last prediction of a key in order wins; a matched row's text becomes orig_text and the prediction its text.
    """
    last = last_by_key(predictions.select(*keys, F.col(predicted).alias("_pred"), *[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)]), list(keys), [f"_o{i}" for i in range(len(order))])
    met = rows.join(last.select(*keys, "_pred", F.lit(True).alias("_met")), list(keys), "left")
    return met.withColumn("orig_text", F.when(F.col("_met"), F.col(text))).withColumn(text, F.when(F.col("_met"), F.col("_pred")).otherwise(F.col(text))).select(*rows.columns, "orig_text")


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """old with the rows of new in place of those of the same keys; new must hold a key once."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*old.columns))


def zip_rows(left: DataFrame, left_order: Sequence[str], right: DataFrame, right_order: Sequence[str]) -> DataFrame:
    """Rows side by side by their place in each order; the longer side is cut."""
    a, b = with_position(left, left_order, "_at"), with_position(right, right_order, "_at")
    return a.join(b, "_at").withColumnRenamed("_at", "ordinal")


def bounded_hash(n: int, *parts: Column | str | int) -> Column:
    """A number from 0 to n - 1 from the md5 of the parts; alike in any engine."""
    text = F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])
    # Fifteen digits of the md5, 60 bits, once eight no longer tell all rows of a side apart.
    return F.conv(F.substring(F.md5(text), 1, 8 if n <= 1 << 31 else 15), 16, 10).cast("bigint") % n


def sample_side(df: DataFrame, key: str, side: DataFrame, side_order: Sequence[str], seed: int) -> DataFrame:
    """Each row with a row of the side table that its key and the seed pick."""
    there = with_position(side, side_order, "_at")
    n = there.count()
    return df.withColumn("_at", bounded_hash(max(n, 1), F.col(key), seed)).join(there, "_at").drop("_at")


def overlapping(a: DataFrame, b: DataFrame, keys: Sequence[str], width: float, tolerance: float = 0.0) -> DataFrame:
    """Pairs of intervals of the same keys that overlap; each side has start and end (numbers, start <= end).

    Intervals are cut into bins of width and met by an equi-join on keys and bin; a pair is kept in the bin where the
    later of the two starts, so it comes once. Tolerance widens the first side. Rows with a null bound don't overlap.
    """
    names = lambda df, p: [F.col(c).alias(c if c in keys else f"{p}_{c}") for c in df.columns]
    x = a.select(*names(a, "a")).where("a_start is not null and a_end is not null")
    y = b.select(*names(b, "b")).where("b_start is not null and b_end is not null")
    bins = lambda lo, hi: F.explode(F.sequence(F.floor(lo / width).cast("bigint"), F.floor(hi / width).cast("bigint")))
    x = x.withColumn("_bin", bins(F.col("a_start") - tolerance, F.col("a_end") + tolerance))
    y = y.withColumn("_bin", bins(F.col("b_start"), F.col("b_end")))
    met = x.join(y, [*keys, "_bin"]).where((F.col("a_start") - tolerance < F.col("b_end")) & (F.col("b_start") < F.col("a_end") + tolerance))
    later = F.greatest(F.col("a_start") - tolerance, F.col("b_start"))
    return met.where(F.col("_bin") == F.floor(later / width)).drop("_bin")
