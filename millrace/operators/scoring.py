"""Scores that need an alignment or a matching: word errors by kind, BLEU, ROUGE, punctuation, speakers, spotted words."""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import split_words
from millrace.operators.joins import overlapping
from millrace.operators.ordered import scanned
from millrace.session import shuffle_parts, stage


def _rows(ref: Sequence, hyp: Sequence) -> np.ndarray:
    """The table of edit distances, a row at a time."""
    codes: dict = {}
    r, h = (np.array([codes.setdefault(x, len(codes)) for x in side], np.int64) for side in (ref, hyp))
    steps = np.arange(len(h) + 1)
    d = np.zeros((len(r) + 1, len(h) + 1), np.int32)
    d[0] = steps
    for i in range(1, len(r) + 1):
        row = d[i - 1] + 1
        row[1:] = np.minimum(row[1:], d[i - 1, :-1] + (h != r[i - 1]))
        d[i] = np.minimum.accumulate(row - steps) + steps
    return d


def distance(ref: Sequence, hyp: Sequence) -> int:
    """The edit distance, two rows of the table at a time."""
    codes: dict = {}
    r, h = (np.array([codes.setdefault(x, len(codes)) for x in side], np.int64) for side in (ref, hyp))
    steps = np.arange(len(h) + 1)
    last = steps.copy()
    for i in range(1, len(r) + 1):
        row = last + 1
        row[1:] = np.minimum(row[1:], last[:-1] + (h != r[i - 1]))
        last = np.minimum.accumulate(row - steps) + steps
    return int(last[-1])


def align(ref: Sequence, hyp: Sequence) -> list[tuple[int | None, int | None]]:
    """Places of ref and hyp side by side at the least edits; a substitution is taken before a deletion and an insertion."""
    d = _rows(ref, hyp)
    out: list[tuple[int | None, int | None]] = []
    i, j = len(ref), len(hyp)
    while i or j:
        if i and j and d[i, j] == d[i - 1, j - 1] + (ref[i - 1] != hyp[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and d[i, j] == d[i - 1, j] + 1:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    return out[::-1]


def edits(ref: str | None, hyp: str | None, chars: bool = False) -> tuple[int, int, int, int]:
    """Insertions, deletions, substitutions and the reference's size."""
    r, h = (list(ref or ""), list(hyp or "")) if chars else ((ref or "").split(), (hyp or "").split())
    pairs = align(r, h)
    ins, dele = sum(a is None for a, _ in pairs), sum(b is None for _, b in pairs)
    return ins, dele, sum(a is not None and b is not None and r[a] != h[b] for a, b in pairs), len(r)


EDITS = T.StructType([T.StructField(n, T.IntegerType()) for n in ("ins", "del", "sub", "size")])


def edit_kinds(hyp: str, ref: str, chars: bool = False) -> Column:
    """A struct of ins, del, sub and size; an empty reference makes all insertions, two empty texts no error."""

    def run(h: pd.Series, r: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([edits(b, a, chars) for a, b in zip(h, r, strict=True)], columns=["ins", "del", "sub", "size"], dtype="int32")

    return F.pandas_udf(run, EDITS)(F.col(hyp), F.col(ref))


def error_detail(df: DataFrame, hyp: str, ref: str, chars: bool = False) -> DataFrame:
    """Rates of the corpus in one row: rate, ins_rate, del_rate, sub_rate, size, each the ratio of sums."""
    x = df.select(edit_kinds(hyp, ref, chars).alias("e")).select("e.*")
    n = F.nullif(F.sum("size"), F.lit(0))
    return x.agg((F.sum(F.col("ins") + F.col("del") + F.col("sub")) / n).alias("rate"), *[(F.sum(k) / n).alias(f"{k}_rate") for k in ("ins", "del", "sub")], F.sum("size").alias("size"))


def bleu(df: DataFrame, ident: str, hyp: str, ref: str, order: int = 4, smooth: bool = False) -> DataFrame:
    """Corpus BLEU in one row, by aggregates only: n-grams are counted per row and order, clipped, and summed.

    smooth adds one to orders above the first. A corpus without a match of some order has 0.
    """
    h, r = split_words(F.lower(F.coalesce(hyp, F.lit("")))), split_words(F.lower(F.coalesce(ref, F.lit(""))))

    def grams(words: Column, n: int) -> Column:
        return F.when(F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - n + 1), lambda i: F.array_join(F.slice(words, i, F.lit(n)), "\u0001"))).otherwise(F.array().cast("array<string>"))

    rows = df.select(F.col(ident).alias("_id"), h.alias("h"), r.alias("r"))
    sizes = rows.agg(F.sum(F.size("h")).alias("hn"), F.sum(F.size("r")).alias("rn")).first()
    hn, rn = sizes["hn"] or 0, sizes["rn"] or 0
    side = lambda c: rows.select("_id", F.explode(F.array(*[F.struct(F.lit(n).alias("n"), grams(F.col(c), n).alias("g")) for n in range(1, order + 1)])).alias("x")).select("_id", "x.n", F.explode("x.g").alias("g")).groupBy("_id", "n", "g").agg(F.count(F.lit(1)).alias(c))
    both = side("h").join(side("r"), ["_id", "n", "g"], "left")
    by = both.groupBy("n").agg(F.sum(F.least("h", F.coalesce("r", F.lit(0)))).alias("met"), F.sum("h").alias("all"))
    by = by.select("n", F.when(F.lit(smooth) & (F.col("n") > 1), (F.col("met") + 1) / (F.col("all") + 1)).otherwise(F.col("met") / F.col("all")).alias("p"))
    total = by.agg(F.count(F.lit(1)).alias("k"), F.min("p").alias("least"), F.avg(F.when(F.col("p") > 0, F.log("p"))).alias("mean"))
    brevity = 1.0 if hn >= rn else math.exp(1 - rn / hn) if hn else 0.0
    return total.select(F.when((F.col("k") == order) & (F.col("least") > 0), 100 * brevity * F.exp("mean")).otherwise(0.0).alias("bleu"))


def rouge_values(pred: str | None, ref: str | None) -> tuple[float, float, float]:
    """F-measures of shared words, pairs of words, and the longest common subsequence."""
    p, r = (pred or "").lower().split(), (ref or "").lower().split()

    def f(same: int, a: int, b: int) -> float:
        return 2 * same / (a + b) if same else 0.0

    out = []
    for n in (1, 2):
        a, b = (Counter(zip(*[x[i:] for i in range(n)], strict=False)) for x in (p, r))
        out.append(f(sum((a & b).values()), sum(a.values()), sum(b.values())))
    row = [0] * (len(r) + 1)
    for x in p:
        last = 0
        for j, y in enumerate(r, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return out[0], out[1], f(row[-1], len(p), len(r))


def rouge(pred: str, ref: str) -> Column:
    """A struct of rouge1, rouge2 and rougeL."""
    kind = T.StructType([T.StructField(n, T.DoubleType()) for n in ("rouge1", "rouge2", "rougeL")])

    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([rouge_values(x, y) for x, y in zip(a, b, strict=True)], columns=["rouge1", "rouge2", "rougeL"], dtype="float64")

    return F.pandas_udf(run, kind)(F.col(pred), F.col(ref))


def punctuation_edits(ref: str | None, hyp: str | None, marks: str) -> list[tuple[str, str, str]]:
    """(mark, operation, the mark that stands there instead) for each mark in an alignment of words and marks."""
    def tokens(t: str | None) -> list[str]:
        out = t or ""
        for m in marks:
            out = out.replace(m, f" {m} ")
        return out.lower().split()

    r, h = tokens(ref), tokens(hyp)
    is_mark = lambda x: len(x) == 1 and x in marks
    masked = lambda xs: ["\u0001" if is_mark(x) else x for x in xs]
    out = []
    for i, j in align(masked(r), masked(h)):
        a, b = (r[i] if i is not None else None), (h[j] if j is not None else None)
        ma, mb = a is not None and is_mark(a), b is not None and is_mark(b)
        if ma and mb:
            out.append((a, "Correct" if a == b else "Substitutions", b))
        elif ma:
            out.append((a, "Deletions", ""))
        elif mb:
            out.append((b, "Insertions", ""))
    return out


def punctuation_rates(df: DataFrame, ref: str, hyp: str, marks: str = ",.?") -> DataFrame:
    """Per mark and over all (mark null): correct, deletions, insertions, substitutions and their rates, punct_er."""
    kind = T.ArrayType(T.StructType([T.StructField(n, T.StringType()) for n in ("mark", "op", "other")]))

    def run(r: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([punctuation_edits(a, b, marks) for a, b in zip(r, h, strict=True)], dtype=object)

    x = df.select(F.explode(F.pandas_udf(run, kind)(F.col(ref), F.col(hyp))).alias("e")).select("e.*")
    out = x.groupingSets([[F.col("mark")], []], "mark").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("op") == o).alias(o.lower()) for o in ("Correct", "Deletions", "Insertions", "Substitutions")])
    return out.withColumn("punct_er", F.try_divide(F.col("n") - F.col("correct"), "n"))


def assignment(cost: np.ndarray) -> list[int]:
    """The column of each row at the least total cost (rows <= columns)."""
    n, m = cost.shape
    u, v, match, way = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int), np.zeros(m + 1, int)
    for i in range(1, n + 1):
        match[0], j0 = i, 0
        least, used = np.full(m + 1, math.inf), np.zeros(m + 1, bool)
        while True:
            used[j0] = True
            i0, free = match[j0], ~used
            free[0] = False
            c = np.full(m + 1, math.inf)
            c[1:] = cost[i0 - 1] - u[i0] - v[1:]
            nearer = free & (c < least)
            least[nearer], way[nearer] = c[nearer], j0
            j1 = int(np.argmin(np.where(free, least, math.inf)))
            delta = least[j1]
            np.add.at(u, match[used], delta)
            v[used] -= delta
            least[free] -= delta
            j0 = j1
            if not match[j0]:
                break
        while j0:
            match[j0], j0 = match[way[j0]], way[j0]
    out = [0] * n
    for j in range(1, m + 1):
        if match[j]:
            out[match[j] - 1] = j - 1
    return out


def speaker_errors(hyps: list[str], refs: list[str]) -> tuple[int, int]:
    """Word edits and reference words at the best matching of speakers; a speaker without counterpart meets an empty text."""
    n = max(len(hyps), len(refs))
    h, r = hyps + [""] * (n - len(hyps)), refs + [""] * (n - len(refs))
    cost = np.array([[distance(b.split(), a.split()) for b in r] for a in h], float) if n else np.zeros((0, 0))
    pick = assignment(cost) if n else []
    return int(sum(cost[i, j] for i, j in enumerate(pick))), sum(len(x.split()) for x in refs)


def speaker_word_errors(df: DataFrame, session: str, side: str, speaker: str, text: str) -> DataFrame:
    """Per session: errors, size, cpwer. side says 'hyp' or 'ref'; a row is a speaker's whole text in a session.

    The distance of each pair of texts is a row of its own, spread over tasks whatever its session; only a session's
    numbers, one for each pair and each speaker, meet in a task, where speakers are matched at the least total.
    """
    kind = df.schema[session].dataType.simpleString()
    rows = df.select(F.col(session).alias("_s"), F.col(side).alias("_side"), F.col(speaker).alias("_k"), F.coalesce(F.col(text), F.lit("")).alias("_t"))
    rows = stage(rows.withColumn("_n", F.size(split_words("_t"))), "speakers")
    h, r = (rows.where(F.col("_side") == x).select("_s", F.col("_k").alias(f"_k{x}"), F.col("_t").alias(f"_t{x}")) for x in ("hyp", "ref"))
    pairs = h.join(r, "_s").repartition(shuffle_parts(df), "_s", "_khyp", "_kref")  # work goes with the lengths' product, not the bytes
    words = F.pandas_udf(lambda a, b: pd.Series([distance(x.split(), y.split()) for x, y in zip(a, b, strict=True)], dtype="int32"), T.IntegerType())
    pairs = pairs.select("_s", F.col("_khyp").alias("h"), F.col("_kref").alias("r"), words("_thyp", "_tref").alias("d"))
    alone = rows.select("_s", F.when(F.col("_side") == "hyp", F.col("_k")).alias("h"), F.when(F.col("_side") == "ref", F.col("_k")).alias("r"), F.col("_n").alias("d"))

    def match(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        own_h, own_r = (pdf[pdf[a].notna() & pdf[b].isna()].set_index(a)["d"] for a, b in (("h", "r"), ("r", "h")))
        n = max(len(own_h), len(own_r))
        cost = np.zeros((n, n))
        cost[: len(own_h), :] = own_h.to_numpy(float)[:, None]
        cost[:, : len(own_r)] = np.maximum(cost[:, : len(own_r)], own_r.to_numpy(float)[None, :])
        both = pdf[pdf["h"].notna() & pdf["r"].notna()]
        cost[own_h.index.get_indexer(both["h"]), own_r.index.get_indexer(both["r"])] = both["d"]
        pick = assignment(cost) if n else []
        return pd.DataFrame({session: [key[0]], "errors": [int(sum(cost[i, j] for i, j in enumerate(pick)))], "size": [int(own_r.sum())]})

    out = pairs.unionByName(alone).groupBy("_s").applyInPandas(match, f"{session} {kind}, errors long, size long")
    return out.withColumn("cpwer", F.try_divide("errors", "size"))


def diarization_errors(ref: DataFrame, hyp: DataFrame, session: str, width: float = 30.0) -> DataFrame:
    """Per session: total, miss, false_alarm, confusion (seconds) and der. Both sides: session, speaker, start, end, a
    speaker's own intervals being disjoint.

    Speakers are matched so that they share the most time: the shared time of each pair comes from a binned interval join,
    the matching from its small table. The rest is one sweep over the borders of all intervals by running sums.
    """
    a, b = ref.select(session, F.col("speaker").alias("r"), "start", "end"), hyp.select(session, F.col("speaker").alias("h"), "start", "end")
    met = overlapping(a, b, [session], width)
    shared = met.select(session, F.col("a_r").alias("r"), F.col("b_h").alias("h"), F.greatest("a_start", "b_start").alias("s"), F.least("a_end", "b_end").alias("e"))
    shared = stage(shared, "shared")
    table = shared.groupBy(session, "r", "h").agg(F.sum(F.col("e") - F.col("s")).alias("t"))
    kind = ref.schema[session].dataType.simpleString()

    def match(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        (ri, rs), (hi, hs) = pd.factorize(pdf["r"], sort=True), pd.factorize(pdf["h"], sort=True)
        cost = np.zeros((len(rs), len(hs)))
        np.add.at(cost, (ri, hi), -pdf["t"].to_numpy(float))
        flip = cost.shape[0] > cost.shape[1]
        pick = assignment(cost.T if flip else cost)
        rows = [(rs[j], hs[i]) if flip else (rs[i], hs[j]) for i, j in enumerate(pick)]
        return pd.DataFrame([(key[0], r, h) for r, h in rows], columns=[session, "r", "h"])

    pairs = table.groupBy(session).applyInPandas(match, f"{session} {kind}, r string, h string")
    right = shared.join(pairs, [session, "r", "h"])
    edge = lambda df, s, e, c: [df.select(session, F.col(s).alias("t"), *[F.lit(v * (k == c)).alias(k) for k in ("nr", "nh", "nc")]) if v == 1 else df.select(session, F.col(e).alias("t"), *[F.lit(v * (k == c)).alias(k) for k in ("nr", "nh", "nc")]) for v in (1, -1)]
    parts = [*edge(a, "start", "end", "nr"), *edge(b, "start", "end", "nh"), *edge(right, "s", "e", "nc")]
    events = parts[0]
    for p in parts[1:]:
        events = events.unionByName(p)
    events = events.groupBy(session, "t").agg(*[F.sum(k).alias(k) for k in ("nr", "nh", "nc")])
    x = scanned(events, [session], ["t"], {"_nr": "nr", "_nh": "nh", "_nc": "nc"}, {"_t": "t"}).where("_t is not null").withColumn("d", F.col("t") - F.col("_t"))
    r, h, c = (F.col(f"_{k}") - F.col(k) for k in ("nr", "nh", "nc"))  # what was on before this border
    out = x.groupBy(session).agg(
        F.sum(r * F.col("d")).alias("total"), F.sum(F.greatest(r - h, F.lit(0)) * F.col("d")).alias("miss"),
        F.sum(F.greatest(h - r, F.lit(0)) * F.col("d")).alias("false_alarm"), F.sum((F.least(r, h) - c) * F.col("d")).alias("confusion"),
    )
    return out.withColumn("der", F.try_divide(F.col("miss") + F.col("false_alarm") + F.col("confusion"), "total"))


def clipped_references(ref: DataFrame, pred: DataFrame, session: str) -> DataFrame:
    """Reference intervals up to the last predicted end of their session; without predictions none is left."""
    last = pred.groupBy(session).agg(F.max("end").alias("_t"))
    return ref.join(last, session).where(F.col("start") < F.col("_t")).withColumn("end", F.least("end", "_t")).drop("_t")


def best_spots(spots: list[tuple[int, int, float]], threshold: float = 10.0) -> list[int]:
    """Of spotted words (start, end, score; frames inclusive) in order, those that stay: a word that covers threshold
    percent of a kept one takes its place if its score is higher, and falls away otherwise."""
    kept: list[int] = []
    for k, (s, e, score) in enumerate(spots):
        stays = True
        for i in list(kept):
            a, b, other = spots[i]
            shared = max(0, min(e, b) - max(s, a) + 1)
            if 100 * shared / (b - a + 1) >= threshold:
                if score > other:
                    kept.remove(i)
                    stays = True
                    break
                stays = False
        if stays:
            kept = [i for i in kept if spots[i][:2] != (s, e)] + [k]
    return kept


def spotted_words(df: DataFrame, utterance: str, order: Sequence[str], start: str, end: str, score: str, threshold: float = 10.0) -> DataFrame:
    """The rows of best_spots per utterance."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(list(order), kind="stable").reset_index(drop=True)
        return pdf.iloc[best_spots(list(zip(pdf[start], pdf[end], pdf[score], strict=True)), threshold)]

    return df.groupBy(utterance).applyInPandas(run, df.schema)


def replaced_words(words: DataFrame, spots: DataFrame, utterance: str, threshold: float = 10.0) -> DataFrame:
    """Words of an alignment (utterance, start, end, word, score) with spotted ones in place of those that they cover by
    threshold percent, in order of time. A spot whose score is below that of all words it covers is left out."""
    w = words.select(utterance, "start", "end", "word", "score")
    s = spots.select(utterance, "start", "end", "word", "score")
    met = overlapping(w, s, [utterance], 100.0, 1e-9)
    share = 100 * (F.least("a_end", "b_end") - F.greatest("a_start", "b_start")) / F.greatest(F.col("a_end") - F.col("a_start"), F.lit(1e-9))
    met = met.where(share >= threshold)
    lost = met.groupBy(utterance, F.col("b_start").alias("start"), F.col("b_end").alias("end"), F.col("b_word").alias("word")).agg(F.max("a_score").alias("_best"), F.max("b_score").alias("_own")).where("_own < _best").select(utterance, "start", "end", "word")
    good = s.join(lost, [utterance, "start", "end", "word"], "left_anti")
    covered = met.select(utterance, F.col("a_start").alias("start"), F.col("a_end").alias("end"), F.col("a_word").alias("word"), F.col("b_start"), F.col("b_word"))
    gone = covered.join(good.select(utterance, F.col("start").alias("b_start"), F.col("word").alias("b_word")), [utterance, "b_start", "b_word"]).select(utterance, "start", "end", "word")
    return w.join(gone, [utterance, "start", "end", "word"], "left_anti").withColumn("spotted", F.lit(False)).unionByName(good.withColumn("spotted", F.lit(True)))


def phrase_scores(df: DataFrame, ident: str, hyp: str, ref: str, phrases: Sequence[str]) -> DataFrame:
    """Per phrase and over all (phrase null): true positives, references, false positives, precision, recall, f1."""
    listed = F.explode(F.array(*map(F.lit, phrases))).alias("phrase")
    times = lambda c: F.size(F.split(F.concat(F.lit(" "), F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\s+", "  "), F.lit(" ")), F.concat(F.lit(r"\Q "), F.regexp_replace("phrase", " ", "  "), F.lit(r" \E")), -1)) - 1
    x = df.select(ident, hyp, ref, listed).select("phrase", times(hyp).alias("h"), times(ref).alias("r"))
    out = x.groupingSets([[F.col("phrase")], []], "phrase").agg(F.sum(F.least("h", "r")).alias("tp"), F.sum("r").alias("gt"), F.sum(F.greatest(F.col("h") - F.col("r"), F.lit(0))).alias("fp"))
    p, r = F.col("tp") / (F.col("tp") + F.col("fp") + 1e-8), F.col("tp") / (F.col("gt") + 1e-8)
    return out.withColumns({"precision": p, "recall": r, "f1": 2 * p * r / (p + r + 1e-8)})


def layers(items: list[tuple[float, float]]) -> list[int]:
    """The layer, from 1, of each (low is good, high is good) pair when the unbeaten ones are taken off again and again."""
    left, out, layer = list(range(len(items))), [0] * len(items), 0
    while left:
        layer += 1
        beaten = lambda i: any(items[j][0] <= items[i][0] and items[j][1] >= items[i][1] and items[j] != items[i] for j in left)
        free = [i for i in left if not beaten(i)]
        for i in free:
            out[i] = layer
        left = [i for i in left if i not in set(free)]
    return out


def pareto_layers(df: DataFrame, key: str, low: str, high: str) -> DataFrame:
    """Rows with layer, per key (a key's samples, few of them); rows with a null score are left out."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return pdf.assign(layer=np.array(layers(list(zip(pdf[low], pdf[high], strict=True))), "int32"))

    return df.where(F.col(low).isNotNull() & F.col(high).isNotNull()).groupBy(key).applyInPandas(run, f"{kinds}, layer int")


def normalized_rewards(df: DataFrame, columns: Sequence[str], name: str = "reward") -> DataFrame:
    """1 less the sum over columns of the normal probability of the population z-score; a constant column counts 0.5."""
    stats = df.agg(*[F.avg(c).alias(f"_m{i}") for i, c in enumerate(columns)], *[F.stddev_pop(c).alias(f"_s{i}") for i, c in enumerate(columns)]).first()

    def cdf(z: pd.Series) -> pd.Series:
        return z.map(lambda x: 0.5 * (1 + math.erf(x / math.sqrt(2))), na_action="ignore")

    phi = F.pandas_udf(cdf, T.DoubleType())
    total = F.lit(0.0)
    for i, c in enumerate(columns):
        m, s = stats[f"_m{i}"], stats[f"_s{i}"]
        total = total + (phi((F.col(c) - m) / s) if s else F.lit(0.5))
    return df.withColumn(name, 1 - total)


def session_talk(df: DataFrame, session: str) -> DataFrame:
    """Per session of intervals (session, start, end): span, silence and overlap in seconds and as shares of the span."""
    ev = df.select(session, F.col("start").alias("t"), F.lit(1).alias("n")).unionByName(df.select(session, F.col("end").alias("t"), F.lit(-1).alias("n")))
    x = scanned(ev.groupBy(session, "t").agg(F.sum("n").alias("n")), [session], ["t"], {"_upto": "n"}, {"_t": "t"}).where("_t is not null")
    x = x.withColumns({"d": F.col("t") - F.col("_t"), "_on": F.col("_upto") - F.col("n")})
    out = x.groupBy(session).agg(F.sum("d").alias("span"), F.sum(F.when(F.col("_on") == 0, F.col("d")).otherwise(0.0)).alias("silence"), F.sum(F.when(F.col("_on") > 1, F.col("d")).otherwise(0.0)).alias("overlap"))
    return out.withColumns({"silence_share": F.try_divide("silence", "span"), "overlap_share": F.try_divide("overlap", "span")})


def best_permutation(hyps: list[str], refs: list[str]) -> int:
    """Edits at the best matching by trying all (for tests and few speakers)."""
    n = max(len(hyps), len(refs))
    h, r = hyps + [""] * (n - len(hyps)), refs + [""] * (n - len(refs))
    return min((sum(sum(edits(b, a)[:3]) for a, b in zip(p, r, strict=True)) for p in itertools.permutations(h)), default=0)
