"""Filling containers of fixed capacity with whole documents (problem 7)."""

from __future__ import annotations

import base64
import bisect
import os
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.ordered import running_sum
from millrace.session import stage

TOKENIZERS = "/opt/tokenizers"
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the pattern by which these rank files split text before their merges.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_CAPACITY = 1 << 20

_loaded: dict[str, object] = {}


def _encoding(path: str):
    """The tokenizer of a rank file, read once a worker."""
    if path not in _loaded:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[path] = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    return _loaded[path]


def token_count(text: str | Column, path: str = f"{TOKENIZERS}/{VOCABULARY}") -> Column:
    """The number of tokens of a text; 0 for null. The vocabulary file must be there on every machine."""

    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = _encoding(path)
        for s in texts:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in s], dtype="int64")

    return F.pandas_udf(count, T.LongType())(F.col(text) if isinstance(text, str) else text)


def pack_lengths(histogram: dict[int, int], capacity: int, fit: str = "shortest") -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Packing patterns with their counts for items given as length to number.

    Lengths are placed longest first, each into as many packs at once as both have. fit 'shortest' is shortest-pack-first:
    the pack with the most room takes the next item, and only where that is too little a new pack is opened. fit 'best' is
    best-fit: the pack with the least room that still takes it. A pattern is its (length, times) in order of placing.
    Time and patterns grow with the number of distinct lengths, not with the number of items.
    """
    if fit not in ("shortest", "best"):
        raise ValueError("fit is 'shortest' or 'best'")
    if any(x > capacity or x < 1 for x in histogram):
        raise ValueError("lengths must be from 1 to the capacity")
    open_by_room: dict[int, dict[tuple, int]] = {}
    rooms: list[int] = []

    def add(room: int, pattern: tuple, count: int) -> None:
        if room not in open_by_room:
            open_by_room[room] = {}
            bisect.insort(rooms, room)
        open_by_room[room][pattern] = open_by_room[room].get(pattern, 0) + count

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            at = len(rooms) - 1 if fit == "shortest" else bisect.bisect_left(rooms, length)
            if not 0 <= at < len(rooms) or rooms[at] < length:
                # New packs: as many of this length as fit in each, one pack for what doesn't fill one.
                per = capacity // length
                packs, odd = divmod(left, per)
                if packs:
                    add(capacity - per * length, ((length, per),), packs)
                if odd:
                    add(capacity - odd * length, ((length, odd),), 1)
                break
            room = rooms[at]
            pattern, count = open_by_room[room].popitem()
            if not open_by_room[room]:
                del open_by_room[room]
                rooms.pop(at)
            per = 1 if fit == "shortest" else min(room // length, left)
            packs = min(count, left // per)
            if count > packs:
                add(room, pattern, count - packs)
            add(room - per * length, _and(pattern, length, per), packs)
            left -= packs * per
    return [(p, n) for room in sorted(open_by_room) for p, n in sorted(open_by_room[room].items(), reverse=True)]


def _and(pattern: tuple, length: int, per: int) -> tuple:
    """The pattern with per more items of a length no longer than its last."""
    if pattern and pattern[-1][0] == length:
        return (*pattern[:-1], (length, pattern[-1][1] + per))
    return (*pattern, (length, per))


def _places(patterns: list[tuple[tuple[tuple[int, int], ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per length, where its items go by rank: the ranks at which a run begins, its first pack, its items per pack and its first slot."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    pack = 0
    for pattern, count in patterns:
        slot = 0
        for length, per in pattern:
            begin = used.get(length, 0)
            out.setdefault(length, []).append((begin, pack, per, slot))
            used[length] = begin + count * per
            slot += per
        pack += count
    return {k: tuple(np.array(x, np.int64) for x in zip(*v, strict=True)) for k, v in out.items()}


def pack_documents(sizes: DataFrame, ident: str, size: str, capacities: Sequence[tuple[str, int]], fit: str = "shortest", cell_rows: int = 100_000) -> DataFrame:
    """Packs of each named capacity: columns pack_name, pack, slot, ident, piece, size (of the piece).

    sizes has one row per document with its length (see token_count). A document is one piece, piece 0, unless it is
    longer than the capacity; then its full pieces fill packs of their own and the last piece is packed like a short
    document. Rows with a null ident, or a size that is null or under 1, are left out; ids that repeat are documents of
    their own. An empty table gives no packs.

    The lengths' histogram (capacity rows at most) is packed on the driver, see pack_lengths; the resulting patterns meet
    the documents by their rank within their length. All capacities are ranked at once. A length is ranked in hash cells
    of about cell_rows documents, so that one that most documents share is spread over tasks.
    """
    for _, capacity in capacities:
        if not 0 < capacity <= MAX_CAPACITY:
            raise ValueError(f"the capacity must be from 1 to {MAX_CAPACITY}")
    kind = sizes.schema[ident].dataType.simpleString()
    names = [name for name, _ in capacities]
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("_k"), F.lit(c).cast("bigint").alias("_cap")) for k, (_, c) in enumerate(capacities)]))
    rows = sizes.select(F.col(ident).alias("_id"), F.col(size).cast("bigint").alias("_n")).where("_id is not null and _n >= 1").select("_id", "_n", each.alias("_e"))
    whole = F.floor((F.col("_n") - 1) / F.col("_e._cap")).cast("bigint")  # pieces before the last one
    rows = rows.select("_e._k", "_id", whole.alias("_full"), (F.col("_n") - whole * F.col("_e._cap")).cast("int").alias("_len"))
    sums = rows.groupBy("_k", "_len").agg(F.count(F.lit(1)).alias("_c")).collect()  # as many rows as the capacities, at most
    cells = sizes.sparkSession.createDataFrame([(r[0], r[1], -(-r[2] // cell_rows)) for r in sums], "_k int, _len int, _cells int")
    rows = rows.join(F.broadcast(cells), ["_k", "_len"]).withColumn("_cell", F.pmod(F.xxhash64("_id", "_full"), F.col("_cells")).cast("int")).drop("_cells")
    counts = stage(rows.groupBy("_k", "_len", "_cell").agg(F.count(F.lit(1)).alias("_c")), "histogram")
    places, packs = [], []
    for k, (_, capacity) in enumerate(capacities):
        patterns = pack_lengths({r[1]: r[2] for r in sums if r[0] == k}, capacity, fit)
        places.append(_places(patterns))
        packs.append(sum(n for _, n in patterns))
    before = F.sum("_c").over(Window.partitionBy("_k", "_len").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_k", "_len", "_cell", F.coalesce(before, F.lit(0)).alias("_start"))
    rank = F.row_number().over(Window.partitionBy("_k", "_len", "_cell").orderBy("_id", "_full"))
    ranked = rows.withColumn("_r", rank).join(starts, ["_k", "_len", "_cell"]).withColumn("_rank", F.col("_start") + F.col("_r") - 1)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            which, length, rank = (pdf[c].to_numpy(np.int64) for c in ("_k", "_len", "_rank"))
            pack, slot = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            order = np.lexsort((length, which))
            edges = np.flatnonzero(np.diff(which[order]) | np.diff(length[order])) + 1
            for own in np.split(order, edges) if len(order) else []:
                begin, first, per, at = places[which[own[0]]][int(length[own[0]])]
                run = np.searchsorted(begin, rank[own], side="right") - 1
                off = rank[own] - begin[run]
                pack[own], slot[own] = first[run] + off // per[run], at[run] + off % per[run]
            yield pd.DataFrame({"_k": which.astype("int32"), "pack": pack, "slot": slot.astype("int32"), "_id": pdf["_id"], "piece": pdf["_full"].astype("int32"), "size": length.astype("int32")})

    last = ranked.select("_k", "_len", "_rank", "_id", "_full").mapInPandas(place, f"_k int, pack long, slot int, _id {kind}, piece int, size int")
    # Full pieces are numbered after the packs, by range partitions of the documents that have any.
    long = running_sum(rows.where("_full > 0").select("_k", "_id", "_full", "_len"), ["_k"], ["_id", "_full", "_len"], "_full", "_upto")
    packed = F.element_at(F.array(*[F.lit(n).cast("bigint") for n in packs]), F.col("_k") + 1)
    held = F.element_at(F.array(*[F.lit(c).cast("int") for _, c in capacities]), F.col("_k") + 1)
    full = long.select("_k", "_id", "_full", (packed + F.col("_upto") - F.col("_full")).alias("_pack"))
    full = full.select("_k", "_id", "_pack", F.posexplode(F.sequence(F.lit(0).cast("bigint"), F.col("_full") - 1)).alias("_p", "piece"))
    full = full.select("_k", (F.col("_pack") + F.col("piece")).alias("pack"), F.lit(0).alias("slot"), "_id", F.col("piece").cast("int").alias("piece"), held.alias("size"))
    name = F.element_at(F.array(*map(F.lit, names)), F.col("_k") + 1)
    return last.unionByName(full).select(name.alias("pack_name"), "pack", "slot", F.col("_id").alias(ident), "piece", "size")
