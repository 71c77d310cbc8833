"""Frames of streams as tables: count windows, interleaving and sliding buffers."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def framed(df: DataFrame, stream: str, samples: str, size: int, pad: bool = False) -> DataFrame:
    """Arrays of samples cut into frames of size: stream, frame_no, samples, length, is_first, is_last.

    The last frame may be short; with pad it is filled with zeros, its length being that before. A stream without samples
    has no frames.
    """
    n = F.ceil(F.size(samples) / size).cast("int")
    rows = df.where(F.size(samples) > 0).select(stream, F.col(samples).alias("_s"), n.alias("_n"), F.explode(F.sequence(F.lit(0), n - 1)).alias("frame_no"))
    cut = F.slice("_s", F.col("frame_no") * size + 1, F.lit(size))
    filled = F.concat(cut, F.array_repeat(F.lit(0).cast(df.schema[samples].dataType.elementType), F.lit(size) - F.size(cut))) if pad else cut
    return rows.select(stream, "frame_no", filled.alias("samples"), F.size(cut).alias("length"), (F.col("frame_no") == 0).alias("is_first"), (F.col("frame_no") == F.col("_n") - 1).alias("is_last"))


def interleaved(frames: DataFrame, stream: str, n: int) -> DataFrame:
    """Frames with turn: n frames of each stream at a time; within a turn streams come in order."""
    return frames.withColumn("turn", F.floor(F.col("frame_no") / n))


def admitted(frames: DataFrame, stream: str, slots: int) -> DataFrame:
    """Frames with step: at most slots streams run at once, and a new one begins when one ends.

    Streams take the slot that is free first. When one begins depends on all before it, so the streams' lengths, a number
    each, pass one task in order, which holds the slots only.
    """
    kind = frames.schema[stream].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        free = [(0, i) for i in range(slots)]
        for pdf in batches:
            begun = []
            for n in pdf["n"]:
                at, slot = heapq.heappop(free)
                heapq.heappush(free, (at + int(n), slot))
                begun.append(at)
            yield pd.DataFrame({"_k": pdf["_k"], "_at": begun})

    lengths = frames.groupBy(F.col(stream).alias("_k")).agg(F.count(F.lit(1)).alias("n"))
    begun = lengths.repartitionByRange(1, "_k").sortWithinPartitions("_k").mapInPandas(run, f"_k {kind}, _at int")
    return frames.join(begun, F.col(stream) == F.col("_k")).withColumn("step", (F.col("_at") + F.col("frame_no")).cast("int")).drop("_k", "_at")


def buffered(frames: DataFrame, stream: str, frame_samples: int, buffer_samples: int) -> DataFrame:
    """Frames with buffer, the last buffer_samples samples up to and with the frame, zeros before the stream's beginning,
    and left_padding, how many of them are such zeros. A frame longer than the buffer is an error when it is met."""
    back = -(-buffer_samples // max(1, frame_samples))
    w = Window.partitionBy(stream).orderBy("frame_no").rowsBetween(-back, 0)
    all_of = F.flatten(F.collect_list("samples").over(w))
    kind = frames.schema["samples"].dataType.simpleString()
    seen = frames.withColumn("_all", all_of)
    kept = F.slice("_all", F.greatest(F.size("_all") - buffer_samples + 1, F.lit(1)), F.lit(buffer_samples))
    short = F.lit(buffer_samples) - F.size(kept)
    zeros = F.array_repeat(F.lit(0).cast(frames.schema["samples"].dataType.elementType), short)
    good = F.when(F.size("samples") <= buffer_samples, F.concat(zeros, kept)).otherwise(F.raise_error(F.lit("the frame is longer than the buffer")).cast(kind))
    return seen.withColumns({"buffer": good, "left_padding": short}).drop("_all")


def last_frames(frames: DataFrame, keys: Sequence[str]) -> DataFrame:
    return frames.where("is_last").select(*keys)
