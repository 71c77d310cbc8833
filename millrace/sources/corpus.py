"""Token corpora (an index file and a file of ids side by side, or a table of arrays) and weighted blends of them."""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.buckets import sequential_packs
from millrace.operators.sampling import blend_by_bins
from millrace.session import stage

# Fixed values of the index format: its first bytes, its version, and the kinds of numbers by code.
MAGIC, VERSION = b"MMIDIDX\x00\x00", 1
KINDS = {1: "u1", 2: "i1", 3: "<i2", 4: "<i4", 5: "<i8", 6: "<f8", 7: "<f4", 8: "<u2"}
HEAD = "<QBQQ"  # version, kind, sequences, document borders


def _header(prefix: str) -> tuple[np.dtype, int, int]:
    """The kind of ids, the number of sequences and that of document borders of an index."""
    with open(f"{prefix}.idx", "rb") as f:
        if f.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{prefix}.idx isn't an index of a token corpus")
        version, code, sequences, documents = struct.unpack(HEAD, f.read(struct.calcsize(HEAD)))
    if version != VERSION:
        raise ValueError(f"{prefix}.idx has version {version}")
    return np.dtype(KINDS[code]), sequences, documents


def read_token_files(spark: SparkSession, prefix: str, rows_a_task: int = 100_000) -> DataFrame:
    """The sequences of prefix.idx and prefix.bin, which must be there on every machine: sequence, tokens.

    The header alone is read on the driver; each task maps the files and reads the sequences of its range.
    """
    kind, n, _ = _header(prefix)
    at = len(MAGIC) + struct.calcsize(HEAD)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes = np.memmap(f"{prefix}.idx", "<i4", "r", at, (n,)) if n else np.empty(0, "<i4")
        starts = np.memmap(f"{prefix}.idx", "<i8", "r", at + 4 * n, (n,)) if n else np.empty(0, "<i8")
        ids = np.memmap(f"{prefix}.bin", kind, "r") if n and sizes.any() else np.empty(0, kind)
        for pdf in batches:
            first = [(int(starts[i]) // kind.itemsize, int(sizes[i])) for i in pdf["id"]]
            yield pd.DataFrame({"sequence": pdf["id"], "tokens": [ids[a : a + k].astype(np.int64).tolist() for a, k in first]})

    return spark.range(0, n, 1, max(1, -(-n // rows_a_task))).mapInPandas(run, "sequence long, tokens array<bigint>")


def write_token_files(df: DataFrame, order: Sequence[str], tokens: str, folder: str, code: int = 4, parts: int | None = None) -> list[str]:
    """Write arrays of ids as pairs of files part-N.idx and part-N.bin in a folder that all machines share; the prefixes.

    Rows are range-partitioned by order, a pair of files a partition, so the files in order hold the rows in order.
    """
    kind = np.dtype(KINDS[code])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        prefix = f"{folder}/part-{TaskContext.get().partitionId():05d}"
        sizes = []
        with open(f"{prefix}.bin", "wb") as f:
            for pdf in batches:
                for x in pdf["_t"]:
                    sizes.append(len(x))
                    f.write(np.asarray(x, kind).tobytes())
        starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)[:-1]]) * kind.itemsize if sizes else np.empty(0, np.int64)
        with open(f"{prefix}.idx", "wb") as f:
            f.write(MAGIC + struct.pack(HEAD, VERSION, code, len(sizes), len(sizes) + 1))
            f.write(np.asarray(sizes, "<i4").tobytes() + starts.astype("<i8").tobytes() + np.arange(len(sizes) + 1, dtype="<i8").tobytes())
        yield pd.DataFrame({"prefix": [prefix], "n": [len(sizes)]})

    rows = df.select(*order, F.col(tokens).alias("_t"))
    rows = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    return sorted(r["prefix"] for r in rows.mapInPandas(run, "prefix string, n long").collect() if r["n"])  # a row per file


def weighted_paths(paths: Sequence[str | float]) -> list[tuple[float, str]]:
    """[w1, p1, w2, p2, ...] or [p1, p2, ...] as weights and paths; without weights all are alike."""
    def number(x: str | float) -> float | None:
        try:
            return float(x)
        except ValueError:
            return None

    first = [number(x) for x in paths[::2]]
    if not paths:
        raise ValueError("there are no paths")
    if first[0] is None:
        return [(1.0, str(p)) for p in paths]
    if len(paths) % 2 or None in first:
        raise ValueError("weights and paths must take turns")
    return list(zip(first, map(str, paths[1::2]), strict=True))


def token_samples(corpus: DataFrame, order: Sequence[str], tokens: str, length: int) -> DataFrame:
    """A corpus as samples of length tokens, documents laid end to end, the short last one left out: sample, tokens."""
    packs = sequential_packs(corpus, order, tokens, length)
    return packs.where(F.col("used") == length).select(F.col("pack").alias("sample"), "tokens")


def blended(corpora: Sequence[tuple[float, DataFrame]], size: int, bins: int = 100) -> DataFrame:
    """size places of a blend, each with its source, sample and tokens; corpora are weights and tables of token_samples.

    Which sample a place takes is a closed form of its number (see blend_by_bins), so the blend is one equi-join on source
    and sample; a source that runs out starts again.
    """
    tables = [stage(c, "samples") for _, c in corpora]
    sizes = [t.count() for t in tables]
    if not all(sizes):
        raise ValueError("a corpus has no samples")
    spark = tables[0].sparkSession
    places = blend_by_bins(spark, [w for w, _ in corpora], sizes, size, bins)
    whole = None
    for k, t in enumerate(tables):
        part = t.select(F.lit(k).alias("source"), "sample", "tokens")
        whole = part if whole is None else whole.unionByName(part)
    return places.join(whole, ["source", "sample"]).select("place", "source", "sample", "tokens")
