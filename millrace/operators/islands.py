"""Runs, gaps and folds over ordered rows and arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordered import carry_last, running_sum


def island_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str], starts: str, name: str = "island") -> DataFrame:
    """Add the number of rows flagged by starts up to this one, per keys; keys may be hot."""
    flagged = df.withColumn("_one", F.when(F.col(starts), 1).otherwise(0))
    return running_sum(flagged, keys, order, "_one", name).drop("_one")


def runs_of_equal(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, name: str = "run") -> DataFrame:
    """Add the number, from 1, of the run of equal values that a row is in, per keys."""
    boxed = df.withColumn("_boxed", F.struct(F.col(value).alias("v")))
    before = carry_last(boxed, keys, order, "_boxed", "_before").drop("_boxed")
    flagged = before.withColumn("_new", F.col("_before").isNull() | ~F.col("_before.v").eqNullSafe(F.col(value))).drop("_before")
    return island_ids(flagged, keys, order, "_new", name).drop("_new")


def gap_sessions(df: DataFrame, keys: Sequence[str], order: Sequence[str], start: str, end: str, gap: float, name: str = "session") -> DataFrame:
    """Add the number of the session, a new one where a row starts gap or more after the end of the row before."""
    before = carry_last(df, keys, order, end, "_before")
    flagged = before.withColumn("_new", F.col("_before").isNull() | (F.col(start) - F.col("_before") >= gap)).drop("_before")
    return island_ids(flagged, keys, order, "_new", name).drop("_new")


def delimited_segments(words: Column, delimiters: str) -> Column:
    """An array of words as an array of segments, each ended by a word whose last sign is a delimiter."""
    start = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("open"))
    add = lambda a, w: F.when(a["open"] == "", w).otherwise(F.concat(a["open"], F.lit(" "), w))
    ends = lambda w: F.lit(delimiters).contains(F.right(w, F.lit(1))) & (w != "")
    step = lambda a, w: F.when(ends(w), F.struct(F.array_append(a["done"], add(a, w)).alias("done"), F.lit("").alias("open"))).otherwise(F.struct(a["done"].alias("done"), add(a, w).alias("open")))
    folded = F.aggregate(words, start, step)
    return F.when(folded["open"] == "", folded["done"]).otherwise(F.array_append(folded["done"], folded["open"]))


def end_by_timestamps(steps: Column, length: Column, silence: int) -> Column:
    """Where an utterance ends by its tokens' time steps: after a trailing silence, else the last gap, above silence.

    silence 0 always ends at length; a negative one never; null where no end is found or there are no steps.
    """
    if silence < 0:
        return F.lit(None).cast("int")
    if silence == 0:
        return F.when(F.size(steps) > 0, length)
    start = F.struct(F.lit(None).cast("int").alias("last"), F.lit(None).cast("int").alias("gap"))
    step = lambda a, t: F.struct(t.cast("int").alias("last"), F.when(t - a["last"] - 1 > silence, a["last"]).otherwise(a["gap"]).alias("gap"))
    found = F.aggregate(steps, start, step)
    return F.when(length - found["last"] - 1 > silence, found["last"]).otherwise(found["gap"]) + 1 + silence // 2


def end_by_emissions(emissions: Column, blank: int, pivot: Column, search_start: int, silence: int) -> Column:
    """Where an utterance ends by a run of more than silence blanks, looked for backwards down to silence before the pivot.

    null where none is found. The run may be cut by the lower end of the search. Time grows with the number of emissions.
    """
    low = F.greatest(F.lit(0), F.lit(search_start), pivot - silence).cast("int")
    scanned = F.reverse(F.slice(emissions, low + 1, F.greatest(F.size(emissions) - low, F.lit(0))))
    start = F.struct((F.size(emissions) - 1).alias("i"), F.lit(0).alias("n"), F.lit(-1).alias("at"), F.lit(False).alias("closed"))

    def step(a: Column, x: Column) -> Column:
        n, i = a["n"] + 1, a["i"] - 1
        on = F.struct(i.alias("i"), n.alias("n"), F.when(n > silence, a["i"]).otherwise(a["at"]).alias("at"), a["closed"].alias("closed"))
        off = F.when(a["n"] > silence, F.struct(i.alias("i"), a["n"].alias("n"), a["at"].alias("at"), F.lit(True).alias("closed"))).otherwise(F.struct(i.alias("i"), F.lit(0).alias("n"), F.lit(-1).alias("at"), F.lit(False).alias("closed")))
        return F.when(a["closed"], a).when(x == blank, on).otherwise(off)

    if silence <= 0:
        return F.lit(None).cast("int")
    found = F.aggregate(scanned, start, step)
    return F.when((F.size(emissions) > 0) & (found["n"] > silence), found["at"] + silence // 2)


def end_by_speech(segments: Column, search_start: float, buffer_seconds: float, silence_seconds: float, step_seconds: float) -> Column:
    """As end_by_timestamps over [start, end] pairs of speech, in time steps; ends before search_start don't count."""
    start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(None).cast("double").alias("gap"))

    def step(a: Column, s: Column) -> Column:
        low, high = F.greatest(F.round(s["start"], 4), F.lit(search_start * step_seconds)), F.round(s["end"], 4)
        met = F.struct(high.alias("last"), F.when(low - a["last"] > silence_seconds, a["last"]).otherwise(a["gap"]).alias("gap"))
        return F.when(high > search_start * step_seconds, met).otherwise(a)

    found = F.aggregate(segments, start, step)
    end = F.when(buffer_seconds - found["last"] > silence_seconds, found["last"]).otherwise(found["gap"])
    return F.floor((end + silence_seconds / 2) / step_seconds).cast("int")


def merged_steps(a: Column, b: Column) -> Column:
    """Two arrays of time steps as one that rises: each begins at 0 if it begins below, and b after a's last."""
    up = lambda x: F.when(F.element_at(x, 1) < 0, F.transform(x, lambda t: t - F.element_at(x, 1))).otherwise(x)
    x, y = F.when(F.size(a) > 0, up(a)).otherwise(a), F.when(F.size(b) > 0, up(b)).otherwise(b)
    gap = F.element_at(y, 1) - F.element_at(x, -1)
    return F.when(F.size(x) < 1, y).when(F.size(y) < 1, x).otherwise(F.concat(x, F.when(gap <= 0, F.transform(y, lambda t: t + F.abs(gap) + 1)).otherwise(y)))


def overlap_length(old: Column, new: Column, limit: int) -> Column:
    """The longest end of old, up to limit, with which new begins; 0 if none."""
    most = F.least(F.size(old), F.size(new), F.lit(limit))
    ks = F.filter(F.sequence(F.lit(0), most), lambda k: (k > 0) & (F.slice(old, F.size(old) - k + 1, k) == F.slice(new, F.lit(1), k)))
    return F.coalesce(F.array_max(ks), F.lit(0))


def timed_overlap(old: Column, old_steps: Column, new: Column, new_steps: Column, limit: int = 3, close: float = 2.0) -> Column:
    """overlap_length, but 0 where the new tokens come more than close steps after the old ones."""
    k = overlap_length(old, new, limit)
    late = F.element_at(new_steps, k.cast("int")) - F.element_at(old_steps, (-k).cast("int")) > close
    return F.when(k < 1, 0).when(late, 0).otherwise(k)


def collapse_repeats(labels: Column, blank: int) -> Column:
    """Labels without blanks and with repeats in a row taken once (a blank between keeps both)."""
    kept = F.filter(F.sequence(F.lit(1), F.size(labels)), lambda i: (i == 1) | (F.element_at(labels, i.cast("int")) != F.element_at(labels, F.greatest(i - 1, F.lit(1)).cast("int"))))
    out = F.filter(F.transform(kept, lambda i: F.element_at(labels, i.cast("int"))), lambda x: x != blank)
    return F.when(F.size(labels) > 0, out).otherwise(labels)


def clamped_offsets(starts: Column, ends: Column, chunks: Column, chunk_starts: Sequence[int], subsampling: int) -> Column:
    """Starts and ends shifted by their chunk's offset, each start held to the end before it: array of structs."""
    shift = F.array(*[F.lit(sum(chunk_starts[: i + 1]) // subsampling) for i in range(len(chunk_starts))])
    rows = F.transform(F.arrays_zip(starts.alias("s"), ends.alias("e"), chunks.alias("c")), lambda r: F.struct((r["s"] + F.element_at(shift, r["c"] + 1)).alias("s"), (r["e"] + F.element_at(shift, r["c"] + 1)).alias("e")))
    none = F.array().cast("array<struct<s:int,e:int>>")

    def step(a: Column, r: Column) -> Column:
        low = F.when(F.size(a) > 0, F.element_at(a, -1)["e"]).otherwise(r["s"])
        return F.array_append(a, F.struct(F.greatest(r["s"], low).cast("int").alias("s"), r["e"].cast("int").alias("e")))

    return F.aggregate(rows, none, step)


def resetting_groups(sizes: Column, least: float) -> Column:
    """Group numbers from 0 for an array of sizes: a group closes once its sum reaches least; an unfinished one is -1."""
    start = F.struct(F.array().cast("array<int>").alias("ids"), F.lit(0).alias("id"), F.lit(0.0).alias("sum"))

    def step(a: Column, x: Column) -> Column:
        total = a["sum"] + x
        full = total >= least
        return F.struct(F.array_append(a["ids"], a["id"]).alias("ids"), F.when(full, a["id"] + 1).otherwise(a["id"]).alias("id"), F.when(full, F.lit(0.0)).otherwise(total).alias("sum"))

    folded = F.aggregate(sizes, start, step)
    return F.transform(folded["ids"], lambda i: F.when(i < folded["id"], i).otherwise(-1))


def subsegments(start: Column, duration: Column, window: float, shift: float) -> Column:
    """Windows of a segment as structs of start and duration: every shift, the last one shortened to the segment's end.

    A segment no longer than a window is one window.
    """
    n = F.greatest(F.ceil((duration - window) / shift + 1), F.lit(1)).cast("int")
    return F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct((start + i * shift).alias("start"), F.least(F.lit(window), duration - i * shift).alias("duration")))
