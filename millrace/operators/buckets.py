"""Length buckets, batches, packs and sample indices."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import let
from millrace.operators.ordered import running_sum, with_position
from millrace.session import stage


def bucket_1d(length: Column, edges: Sequence[float]) -> Column:
    """The first bucket whose upper edge isn't below the length; null beyond the last."""
    out = F.lit(None).cast("int")
    for i, edge in reversed(list(enumerate(edges))):
        out = F.when(length <= edge, i).otherwise(out)
    return out


def bucket_2d(a: Column, b: Column, buckets: Sequence[tuple[float, float]], strict: bool = True, max_ratio: Sequence[float] | None = None) -> Column:
    """A bucket by two lengths. strict: only among the buckets of the first edge that takes a; else the first that takes both."""
    out = F.lit(None).cast("int")
    if not strict:
        for i, (x, y) in reversed(list(enumerate(buckets))):
            out = F.when((a <= x) & (b <= y), i).otherwise(out)
        return out
    for edge in sorted({x for x, _ in buckets}, reverse=True):
        inner = F.lit(None).cast("int")
        for i, (x, y) in reversed(list(enumerate(buckets))):
            if x == edge:
                fit = F.lit(i) if max_ratio is None else F.when(b / a <= max_ratio[i], i)
                inner = F.when(b <= y, fit).otherwise(inner)
        out = F.when(a <= edge, inner).otherwise(out)
    return out


def audio_tokens(seconds: Column, token_seconds: float) -> Column:
    return F.ceil(seconds / token_seconds)


def conversation_length(turns: Column, token_seconds: float) -> Column:
    """Tokens of a conversation of structs (tokens, seconds): text tokens, and for each audio turn its tokens less its placeholder."""
    return F.aggregate(turns, F.lit(0).cast("bigint"), lambda n, t: n + F.coalesce(t["tokens"], F.lit(0)) + F.coalesce(F.ceil(t["seconds"] / token_seconds) - 1, F.lit(0)))


def equal_mass_edges(df: DataFrame, size: str, buckets: int) -> list[float]:
    """Edges that cut sorted sizes into buckets of equal mass: a cut falls on the row at which the sum since the last cut
    has gone beyond total / buckets, and the sum starts again at that row.

    Sizes are summed by value over range partitions; each edge is then one lookup in that table.
    """
    rows = df.where(F.col(size) > 0).groupBy(F.col(size).alias("v")).agg(F.count(F.lit(1)).alias("n")).withColumn("m", F.col("v") * F.col("n"))
    upto = stage(running_sum(rows, [], ["v"], "m", "hi"), "mass")
    total = upto.agg(F.max("hi")).first()[0]
    if not total:
        return []
    limit, base, edges = total / buckets, 0.0, []
    while len(edges) < 10 * buckets:
        # The first value at which some row has more than limit before it.
        before = F.col("hi") - F.col("m")
        got = upto.where(F.col("hi") - F.col("v") - base > limit).agg(F.min(F.struct("v", before.alias("lo"), "n"))).first()[0]
        if got is None:
            return edges
        v, lo = float(got["v"]), float(got["lo"])
        skip = max(0, int((limit + base - lo) // v) + 1) if lo - base <= limit else 0
        edges.append(round(v, 3))
        base = lo + skip * v
    return edges


def token_batches(df: DataFrame, keys: Sequence[str], order: Sequence[str], tokens: str, budget: int) -> DataFrame:
    """Batches of rows in order whose tokens add up to no more than the budget, a larger row being a batch alone: adds batch.

    Batches are made per keys (a shard or bucket), in one pass over its sorted rows; a shard must be of bounded size.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable").reset_index(drop=True)
        ids, batch, used = [], 0, 0
        for x in pdf[tokens].fillna(0):
            if used and used + x > budget:
                batch, used = batch + 1, 0
            used += x
            ids.append(batch)
        return pdf.assign(batch=pd.array(ids, "int32"))

    return df.groupBy(*keys).applyInPandas(run, f"{kinds}, batch int")


def first_fit_decreasing(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """First-fit-decreasing packs as (pattern, count) in the order of the packs, from numbers per length.

    Equal packs in a row are held as one run, so the work depends on the lengths, not on the items; the result is what
    placing item by item gives.
    """
    if any(x > capacity for x in histogram):
        raise ValueError("an item is longer than the capacity")
    runs: list[list] = []
    for length in sorted(histogram, reverse=True):
        left, out = histogram[length], []
        for pattern, room, count in runs:
            per = room // length if length else left
            if not left or not per:
                out.append([pattern, room, count])
                continue
            full = min(count, left // per)
            if full:
                out.append([(*pattern, (length, per)), room - per * length, full])
                left -= full * per
            if full < count and left:
                out.append([(*pattern, (length, left)), room - left * length, 1])
                full, left = full + 1, 0
            if full < count:
                out.append([pattern, room, count - full])
        per = capacity // length if length else left
        while left:
            n = left // per
            if n:
                out.append([((length, per),), capacity - per * length, n])
                left -= n * per
            else:
                out.append([((length, left),), capacity - left * length, 1])
                left = 0
        runs = out
    return [(tuple(p), c) for p, _, c in runs]


def greedy_knapsacks(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Packs as (pattern, count), each filled with the largest item that still fits; an item above the capacity is an error."""
    if any(x > capacity for x in histogram):
        raise ValueError("an item is longer than the capacity")
    left = {k: v for k, v in histogram.items() if v}
    out = []
    while left:
        room, pattern = capacity, []
        for length in sorted(left, reverse=True):
            per = min(left[length], room // length)
            if per:
                pattern.append((length, per))
                room -= per * length
        # The same pack comes again while no length in it runs short.
        times = 1 if any(n == left[k] for k, n in pattern) else min(left[k] // n for k, n in pattern)
        for k, n in pattern:
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((tuple(pattern), times))
    return out


def histogram(df: DataFrame, length: str, most: int = 1 << 20) -> dict[int, int]:
    """Numbers per length on the driver; lengths above most are an error, so the table has at most most rows."""
    rows = df.where(F.col(length).isNotNull()).groupBy(F.col(length).cast("int").alias("x")).agg(F.count(F.lit(1)).alias("n"))
    top = rows.agg(F.max("x")).first()[0]
    if top is not None and top > most:
        raise ValueError(f"a length is above {most}")
    return {r["x"]: r["n"] for r in rows.collect()}


def pack_report(patterns: list[tuple[tuple[tuple[int, int], ...], int]], capacity: int) -> dict[str, float]:
    """Packs, the most items in a pack, items per pack, and the filled share in percent."""
    packs = sum(n for _, n in patterns)
    items = [sum(k for _, k in p) for p, _ in patterns]
    used = sum(x * k * n for p, n in patterns for x, k in p)
    total = sum(i * n for i, (_, n) in zip(items, patterns, strict=True))
    return {"packs": packs, "most_items": max(items, default=0), "factor": round(total / packs, 2) if packs else 0.0, "percent": round(used / (packs * capacity) * 100, 2) if packs else 0.0}


def packed(df: DataFrame, order: Sequence[str | Column], length: str, patterns: list[tuple[tuple[tuple[int, int], ...], int]]) -> DataFrame:
    """Rows with pack and slot: items meet the patterns by their rank within their length."""
    ranked = running_sum(df.withColumn("_one", F.lit(1)), [length], order, "_one", "_rank").drop("_one")
    runs, used, pack = [], {}, 0
    for pattern, count in patterns:
        slot = 0
        for x, per in pattern:
            begin = used.get(x, 0)
            runs.append((int(x), begin, begin + per * count, pack, per, slot))
            used[x] = begin + per * count
            slot += per
        pack += count
    table = df.sparkSession.createDataFrame(runs, "_x int, _lo long, _hi long, _pack long, _per long, _slot long")
    r = F.col("_rank") - 1
    met = ranked.join(F.broadcast(table), (F.col(length) == F.col("_x")) & (r >= F.col("_lo")) & (r < F.col("_hi")))
    off = r - F.col("_lo")
    return met.select(*df.columns, (F.col("_pack") + F.floor(off / F.col("_per"))).alias("pack"), (F.col("_slot") + off % F.col("_per")).cast("int").alias("slot"))


def sample_starts(df: DataFrame, order: Sequence[str], size: str, length: int, extra: int = 1, drop_last: bool = True) -> DataFrame:
    """Where each training sample of length tokens begins in the documents in order: sample, doc_place, offset.

    Sample s begins at token s * length of all documents in a row; there is a row more than samples, where the last ends.
    """
    placed = with_position(df.select(*order, size).where(F.col(size) > 0), order, "doc_place")
    upto = stage(running_sum(placed, [], ["doc_place"], size, "_hi"), "tokens")
    total = upto.agg(F.max("_hi")).first()[0] or 0
    whole = total - extra
    n = whole // length if drop_last else -(-whole // length)
    lo = F.col("_hi") - F.col(size)
    # Sample s lies in the document with lo <= s * length < hi.
    s = F.explode(F.sequence(F.ceil(lo / length).cast("bigint"), F.ceil(F.col("_hi") / length).cast("bigint") - 1))
    rows = upto.where(F.ceil(lo / length) <= F.ceil(F.col("_hi") / length) - 1).select(s.alias("sample"), "doc_place", lo.alias("_lo"))
    rows = rows.select("sample", "doc_place", (F.col("sample") * length - F.col("_lo")).cast("bigint").alias("offset")).where(F.col("sample") <= max(n, 0))
    return rows if drop_last or whole % length == 0 else rows.where(F.col("sample") < n).unionByName(_last_start(upto, size, n, extra))


def _last_start(upto: DataFrame, size: str, n: int, extra: int) -> DataFrame:
    return upto.orderBy(F.desc("doc_place")).limit(1).select(F.lit(n).cast("bigint").alias("sample"), "doc_place", (F.col(size) - extra).cast("bigint").alias("offset"))


def sentence_spans(sizes: Column, target: int, least: int = 2, longest: int = 512, one_left: bool = True) -> Column:
    """Spans of a document's sentences as structs (start, end): a span closes once its length reaches target and more than
    one sentence (one_left) or at least least sentences are left and it has least itself, or at the end of the document.

    A document with fewer than least sentences, or one above longest, has no spans.
    """
    none = F.array().cast("array<struct<start:int,end:int>>")
    start = F.struct(none.alias("done"), F.lit(0).alias("from"), F.lit(0).alias("sum"), F.lit(0).alias("i"), F.size(sizes).alias("n"), F.coalesce(F.array_max(sizes) > longest, F.lit(True)).alias("bad"))

    def step(a: Column, x: Column) -> Column:
        total, end = (a["sum"] + x).cast("int"), (a["i"] + 1).cast("int")
        left, taken = a["n"] - end, end - a["from"]
        enough = (left > 1) if one_left else (left >= least)
        close = ((total >= target) & enough & (taken >= least)) | (left == 0)
        done = F.when(close, F.array_append(a["done"], F.struct(a["from"].alias("start"), end.alias("end")))).otherwise(a["done"])
        return F.struct(done.alias("done"), F.when(close, end).otherwise(a["from"]).alias("from"), F.when(close, 0).otherwise(total).alias("sum"), end.alias("i"), a["n"].alias("n"), a["bad"].alias("bad"))

    return F.aggregate(sizes, start, step, lambda a: F.when((a["n"] >= least) & ~a["bad"], a["done"]).otherwise(none))


def sequential_packs(df: DataFrame, order: Sequence[str], ids: str, size: int, pad: int = 0) -> DataFrame:
    """Arrays of tokens laid end to end and cut into packs of size, items split across packs: pack, tokens, used.

    The place of each item in the whole is a running sum over range partitions; a pack is gathered from its pieces.
    """
    rows = running_sum(df.select(*order, F.col(ids).alias("_t")).where(F.size("_t") > 0).withColumn("_n", F.size("_t")), [], order, "_n", "_hi")
    lo = F.col("_hi") - F.col("_n")
    pieces = rows.withColumn("_lo", lo).withColumn("pack", F.explode(F.sequence(F.floor(lo / size).cast("bigint"), F.floor((F.col("_hi") - 1) / size).cast("bigint"))))
    first = F.greatest(F.col("pack") * size - F.col("_lo"), F.lit(0))
    last = F.least((F.col("pack") + 1) * size - F.col("_lo"), F.col("_n").cast("bigint"))
    cut = pieces.select("pack", (F.col("_lo") + first).alias("_at"), F.slice("_t", (first + 1).cast("int"), (last - first).cast("int")).alias("_t"))
    out = cut.groupBy("pack").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_t"))), lambda x: x["_t"])).alias("tokens"))
    used = F.size("tokens")
    return out.select("pack", F.concat("tokens", F.array_repeat(F.lit(pad), F.lit(size) - used)).alias("tokens"), used.alias("used"))


def padded(ids: Column, length: Column | int, pad: int = 0, left: bool = False) -> Column:
    """An array cut or padded to a length."""
    n = length if isinstance(length, Column) else F.lit(length)
    more = F.array_repeat(F.lit(pad), F.greatest(n - F.size(ids), F.lit(0)).cast("int"))
    cut = F.slice(ids, F.lit(1), n.cast("int"))
    return F.concat(more, cut) if left else F.concat(cut, more)


def up_to_multiple(length: Column, multiple: int) -> Column:
    return F.ceil(length / multiple) * multiple


def position_mask(length: Column, width: int) -> Column:
    """true for the first length places of width."""
    return F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: i <= length)


def merged_utterances(df: DataFrame, keys: Sequence[str], order: Sequence[str], seconds: str, text: str, most: float, silence: float) -> DataFrame:
    """Neighbours of a group (key of two or more rows) merged if they fit: keys, text joined by '|', seconds, eou_positions.

    They fit if their durations and a silence between each two stay within most and the first text ends as a sentence.
    """
    g = df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(seconds).alias("_s"), F.col(text).alias("_t")))).alias("_x"))
    total = F.aggregate("_x", F.lit(0.0), lambda a, x: a + x["_s"]) + (F.size("_x") - 1) * silence
    fits = (F.size("_x") > 1) & (total <= most) & F.element_at("_x", 1)["_t"].rlike(r"[.!?。！？…]\s*$")
    ends = F.transform(F.sequence(F.lit(1), F.size("_x")), lambda i: F.aggregate(F.slice("_x", F.lit(1), i), F.lit(0.0), lambda a, x: a + x["_s"]) + (i - 1) * silence)
    return g.where(fits).select(*keys, F.array_join(F.transform("_x", lambda x: x["_t"]), "|").alias("text"), total.alias("seconds"), ends.alias("eou_positions"))


def merge_stream(keys: Sequence[str], order: Sequence[str], seconds: str, text: str, most: float, count: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """The function for applyInPandas that merges up to count neighbours of a key while they stay within most."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable")
        out, open_rows, used = [], [], 0.0
        for r in pdf.itertuples(index=False):
            s = float(getattr(r, seconds) or 0)
            if open_rows and (len(open_rows) >= count or used + s > most):
                out.append((len(open_rows), used, "|".join(open_rows)))
                open_rows, used = [], 0.0
            open_rows.append(getattr(r, text) or "")
            used += s
        if open_rows:
            out.append((len(open_rows), used, "|".join(open_rows)))
        first = pdf.iloc[0]
        return pd.DataFrame([(*[first[k] for k in keys], i, *x) for i, x in enumerate(out)], columns=[*keys, "merged", "parts", "seconds", "text"])

    return run


def filled_packs(df: DataFrame, ids: str, mask: str | None = None, answer_start: str | None = None) -> DataFrame:
    """Packs (see packed) with their contents: pack, input_ids, loss_mask, position_ids, seq_start_id, cu_seqlens.

    The loss mask is each item's mask moved one place to the left, as labels are; without a mask it is true from the place
    before answer_start on, and without either everywhere. A pack has at most its capacity, so it fits in a row.
    """
    own = F.col(ids)
    if mask:
        loss = F.concat(F.slice(F.col(mask), F.lit(2), F.size(mask)), F.array(F.lit(False)))
    elif answer_start:
        loss = F.transform(own, lambda _, i: i >= F.col(answer_start) - 1)
    else:
        loss = F.transform(own, lambda _: F.lit(True))
    g = df.select("pack", F.struct("slot", own.alias("ids"), loss.alias("loss")).alias("_x")).groupBy("pack").agg(F.array_sort(F.collect_list("_x")).alias("_x"))
    ends = F.aggregate("_x", F.array(F.lit(0)), lambda a, x: F.array_append(a, (F.element_at(a, -1) + F.size(x["ids"])).cast("int")))
    flat = lambda f: F.flatten(F.transform("_x", f))
    out = g.select("pack", flat(lambda x: x["ids"]).alias("input_ids"), flat(lambda x: x["loss"]).alias("loss_mask"), flat(lambda x: F.transform(x["ids"], lambda _, i: i)).alias("position_ids"), ends.alias("cu_seqlens"))
    return out.select("pack", "input_ids", "loss_mask", "position_ids", F.slice("cu_seqlens", F.lit(1), F.size("cu_seqlens") - 1).alias("seq_start_id"), "cu_seqlens")


def block_causal_mask(lengths: Column) -> Column:
    """A pack's attention mask from the lengths of its sequences: rows of booleans, true where a place sees another.

    A place sees itself and those before it in its own sequence. The mask has the square of the pack's size, so it is for
    a batch at hand; cu_seqlens of filled_packs says the same in a row.
    """
    owner = F.flatten(F.transform(lengths, lambda n, i: F.array_repeat(i, n.cast("int"))))
    return let(owner, lambda o: F.transform(o, lambda a, i: F.transform(o, lambda b, j: (a == b) & (j <= i))))


def first_fit_shuffled(df: DataFrame, key: str, length: str, capacity: int, seed: int | str = 0, cells: int = 1) -> DataFrame:
    """First-fit packs of rows in hash order: adds cell and pack. An item above the capacity is an error.

    Which pack an item meets depends on all before it, so first-fit is made cell by cell; rows go to cells by hash, and
    cells is chosen so that a cell fits in a task (a hundred thousand rows, say). Packs don't cross cells.
    """
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_h", key], kind="stable")
        # The most room of a range of packs stands at its node, so the first pack with room is found from the top.
        size = 1 << max(0, len(pdf) - 1).bit_length()
        room, out = [capacity] * (2 * size), []
        for n in pdf[length]:
            if n > capacity:
                raise ValueError("an item is longer than the capacity")
            at = 1
            while at < size:
                at *= 2
                at += room[at] < n
            out.append(at - size)
            room[at] -= n
            while at > 1:
                at //= 2
                room[at] = max(room[2 * at], room[2 * at + 1])
        return pdf.assign(pack=out).drop(columns="_h")

    rows = df.withColumns({"cell": F.pmod(F.xxhash64(key), F.lit(cells)).cast("int"), "_h": h})
    return rows.groupBy("cell").applyInPandas(run, f"{kinds}, cell int, pack long")


#: Ways of packing a histogram of lengths by name.
PACKERS: dict[str, Callable[[dict[int, int], int], list]] = {"first_fit_decreasing": first_fit_decreasing, "greedy_knapsack": greedy_knapsacks}
