"""Evaluation metrics and corpus statistics as one-pass aggregates."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import edit_distance_words, let, split_words
from millrace.operators.joins import hot_keys, join_skewed
from millrace.operators.ordered import running_sum, with_position
from millrace.session import stage


def errors_and_size(hyp: str, ref: str, chars: bool = False) -> tuple[Column, Column]:
    """Edits between hypothesis and reference, and the reference's size, in words or characters."""
    h, r = F.coalesce(F.col(hyp), F.lit("")), F.coalesce(F.col(ref), F.lit(""))
    if chars:
        return F.levenshtein(h, r), F.length(r)
    return edit_distance_words(h, r), F.size(split_words(r))


def rate(errors: Column, size: Column) -> Column:
    """An aggregate: the ratio of sums; infinite where there is nothing to refer to, null over no rows."""
    e, n = F.sum(errors), F.sum(size)
    return F.when(n > 0, e / n).when(n == 0, F.lit(float("inf")))


def error_rates(df: DataFrame, hyp: str, ref: str, by: Sequence[str] = (), chars: bool = False) -> DataFrame:
    """Error rate overall (by null) and per group of each column in by: columns by, errors, size, rate; one scan."""
    e, n = errors_and_size(hyp, ref, chars)
    rows = df.select(*by, e.alias("_e"), n.alias("_n"))
    sets = [[]] + [[c] for c in by]
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *by) if by else rows.groupBy()
    return out.agg(F.sum("_e").alias("errors"), F.sum("_n").alias("size"), rate(F.col("_e"), F.col("_n")).alias("rate"))


def slot(value: Column, slots: Sequence[tuple[float, float]]) -> Column:
    """The first half-open range that holds the value, as 'low-high', or null."""
    return reduce(lambda out, s: F.when((value >= s[0]) & (value < s[1]), F.lit(f"{s[0]:g}-{s[1]:g}")).otherwise(out), reversed(slots), F.lit(None).cast("string"))


def top_k_correct(scores: Column, label: Column, k: int) -> Column:
    """Whether the label is among the k positions of highest score; ties to the lower position."""
    ranked = F.array_sort(F.transform(scores, lambda x, i: F.struct((-x).alias("s"), i.alias("i"))))
    return F.exists(F.slice(ranked, 1, k), lambda t: t["i"] == label)


def token_overlap(a: Column, b: Column) -> Column:
    """How many tokens two arrays share, each as often as in the one that has it less."""
    return F.aggregate(F.array_distinct(a), F.lit(0), lambda n, w: n + F.least(F.size(F.filter(a, lambda x: x == w)), F.size(F.filter(b, lambda x: x == w))))


def token_f1(pred: Column, ref: Column) -> Column:
    """F1 of shared tokens; 0 where none is shared."""
    same = token_overlap(pred, ref).cast("double")
    return F.when(same > 0, 2 * (same / F.size(pred)) * (same / F.size(ref)) / (same / F.size(pred) + same / F.size(ref))).otherwise(0.0)


def softmax(scores: Column) -> Column:
    top = F.array_max(scores)
    e = F.transform(scores, lambda x: F.exp(x.cast("double") - top))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, y: a + y))


def _total(xs: Column) -> Column:
    return F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)


def entropy(probs: Column) -> Column:
    return -_total(F.transform(probs, lambda p: F.when(p > 0, p * F.log(p)).otherwise(0.0)))


def confidence(probs: Column, size: int, measure: str = "max_prob", alpha: float = 1.0) -> Column:
    """A confidence from 0 to 1 of a distribution over size classes.

    measure: max_prob, or entropy_gibbs, entropy_tsallis or entropy_renyi, with _lin or _exp for its scaling. With alpha 1
    all entropies are Shannon's.
    """
    v, t = float(size), float(alpha)
    powers = _total(F.transform(probs, lambda p: F.pow(p, F.lit(t))))
    kind, _, scale = measure.removeprefix("entropy_").partition("_")
    if measure == "max_prob":
        return (F.pow(F.array_max(probs), F.lit(t)) * v**t - 1) / (v**t - 1)
    if kind not in ("gibbs", "tsallis", "renyi") or scale not in ("lin", "exp"):
        raise ValueError(f"no such measure: {measure}")
    if t == 1.0:
        return 1 - entropy(probs) / F.log(F.lit(v)) if scale == "lin" else (F.exp(-entropy(probs)) * v - 1) / (v - 1)
    if kind == "gibbs":
        weighted = _total(F.transform(probs, lambda p: F.when(p > 0, F.pow(p, F.lit(t)) * F.log(p)).otherwise(0.0)))
        least = v ** (-t * v ** (1 - t))
        return 1 + weighted / (F.log(F.lit(v)) * v ** (1 - t)) if scale == "lin" else (F.exp(weighted * t) - least) / (1 - least)
    if kind == "tsallis":
        least = math.exp((1 - v ** (1 - t)) / (1 - t))
        return 1 + (1 - powers) / (v ** (1 - t) - 1) if scale == "lin" else (F.exp((1 - powers) / (1 - t)) - least) / (1 - least)
    return 1 + F.log2(powers) / ((t - 1) * F.log2(F.lit(v))) if scale == "lin" else (F.pow(powers, F.lit(1 / (t - 1))) * v - 1) / (v - 1)


def aggregate_scores(scores: Column, how: str) -> Column:
    """mean, min, max or product of an array of scores; null for an empty one."""
    if how == "min":
        return F.array_min(scores)
    if how == "max":
        return F.array_max(scores)
    if how == "prod":
        return F.when(F.size(scores) > 0, F.aggregate(scores, F.lit(1.0), lambda a, x: a * x))
    if how == "mean":
        return _total(scores) / F.when(F.size(scores) > 0, F.size(scores))
    raise ValueError(f"no such aggregation: {how}")


def ranking_metrics(df: DataFrame, truth: str, score: str) -> DataFrame:
    """auc_roc, auc_pr and auc_nt of a 0/1 truth by a score, in one row.

    Ties count half (roc) or at once (pr, nt). Only one class: auc_roc 0.5; no positives: auc_pr 0; no negatives: auc_nt 0.
    Rows are counted by score first; the running counts go over range partitions.
    """
    rows = df.select(F.col(truth).cast("int").alias("t"), F.col(score).cast("double").alias("s")).dropna()
    counts = rows.groupBy("s").agg(F.sum("t").alias("p"), F.sum(1 - F.col("t")).alias("n"))
    upto = running_sum(running_sum(counts, [], ["s"], "p", "cp"), [], ["s"], "n", "cn")
    tot = counts.agg(F.coalesce(F.sum("p"), F.lit(0)).alias("tp"), F.coalesce(F.sum("n"), F.lit(0)).alias("tn")).first()
    # In doubles, as the products of counts go beyond whole numbers; the counts themselves are exact to 2 ** 53.
    x = upto.select(*[F.col(c).cast("double").alias(c) for c in ("p", "n", "cp", "cn")], F.lit(float(tot["tp"])).alias("tp"), F.lit(float(tot["tn"])).alias("tn"))
    above_p, above_n = F.col("tp") - F.col("cp") + F.col("p"), F.col("tn") - F.col("cn") + F.col("n")
    roc = F.sum(F.col("p") * (F.col("cn") - F.col("n") / 2)) / F.max(F.nullif(F.col("tp") * F.col("tn"), F.lit(0)))
    pr = F.sum(F.when(F.col("p") > 0, F.col("p") * above_p / (above_p + above_n)).otherwise(0.0)) / F.max(F.nullif(F.col("tp"), F.lit(0)))
    nt = F.sum(F.when(F.col("n") > 0, F.col("n") * F.col("cn") / (F.col("cn") + F.col("cp"))).otherwise(0.0)) / F.max(F.nullif(F.col("tn"), F.lit(0)))
    return x.agg(F.coalesce(roc, F.lit(0.5)).alias("auc_roc"), F.coalesce(pr, F.lit(0.0)).alias("auc_pr"), F.coalesce(nt, F.lit(0.0)).alias("auc_nt"))


def normalized_cross_entropy(truth: Column, score: Column, eps: float = 2.220446049250313e-16) -> Column:
    """An aggregate: (entropy of the truth - log loss) / entropy; minus infinity for a single class."""
    p = F.avg(truth.cast("double"))
    s = F.greatest(F.least(score, F.lit(1 - eps)), F.lit(eps))
    loss = -F.avg(F.when(truth == 1, F.log(s)).otherwise(F.log(1 - s)))
    h = -(F.log(p + 1e-15) * p + F.log(1 - p + 1e-15) * (1 - p))
    return F.when((p > 0) & (p < 1), (h - loss) / F.when(h != 0, h)).when(p.isNotNull(), F.lit(float("-inf")))


def calibration_error(df: DataFrame, truth: str, score: str, bins: int = 100) -> DataFrame:
    """Expected calibration error in one row: ece, rows counted over the bins.

    In bin m the class is 1 where the score reaches the bin's middle; a row counts where the probability of that class lies
    in the bin. That holds for two bins at most, so each row is spread to those and not to all.
    """
    s, y = F.col(score), F.col(truth).cast("int")
    mid = lambda m: (m / bins + (m + 1) / bins) / 2
    at = lambda p: F.ceil(p * bins).cast("int") - 1
    one = F.struct(at(s).alias("m"), s.alias("v"), F.lit(1).alias("c"))
    zero = F.struct(at(1 - s).alias("m"), (1 - s).alias("v"), F.lit(0).alias("c"))
    rows = df.where(s.isNotNull() & y.isNotNull()).select(y.alias("y"), s.alias("s"), F.explode(F.array(one, zero)).alias("x")).select("y", "s", "x.*")
    met = rows.where((F.col("m") >= 0) & ((F.col("c") == 1) == (F.col("s") >= mid(F.col("m")))))
    each = met.groupBy("m").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("c") == F.col("y")).cast("int")).alias("right"), F.sum("v").alias("conf"))
    return each.agg((F.sum(F.abs(F.col("right") - F.col("conf"))) / F.sum("n")).alias("ece"), F.sum("n").alias("counted"))


def youden_curve(df: DataFrame, truth: str, score: str, bins: int = 100) -> DataFrame:
    """Mean, deviation and maximum of |true negative rate - false negative rate| over bins + 1 thresholds; one row.

    Scores are counted by the first threshold above them, bins + 2 rows at any input.
    """
    rows = df.where(F.col(score).isNotNull() & F.col(truth).isNotNull())
    first = F.least(F.floor(F.col(score) * bins + F.lit(1e-9)).cast("int") + 1, F.lit(bins + 1))
    counts = rows.groupBy(first.alias("k")).agg(F.sum(1 - F.col(truth).cast("int")).alias("n"), F.sum(F.col(truth).cast("int")).alias("p"))
    grid = df.sparkSession.range(bins + 1).select(F.col("id").cast("int").alias("t"))
    both = grid.join(F.broadcast(counts), F.col("k") <= F.col("t"), "left").groupBy("t").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("p"), F.lit(0)).alias("p"))
    total = counts.agg(F.sum("n").alias("tn"), F.sum("p").alias("tp")).first()
    neg, pos = total["tn"] or 0, total["tp"] or 0
    y = both.select((F.abs(F.col("n") / neg - F.col("p") / pos) if neg and pos else F.lit(0.0)).alias("y"))
    return y.agg(F.avg("y").alias("auc_yc"), F.stddev_pop("y").alias("std"), F.max("y").alias("max"))


def average_lagging(delays: Column, source: Column, target: Column) -> Column:
    """Length-adaptive average lagging of an array of delays; null for an empty one."""
    gamma = F.greatest(F.size(delays), target) / source
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("tau"), F.lit(False).alias("over"))
    step = lambda a, d: F.when(a["over"], a).otherwise(F.struct((a["sum"] + d - a["tau"] / gamma).alias("sum"), (a["tau"] + 1).alias("tau"), (d >= source).alias("over")))
    folded = F.aggregate(delays, start, step)
    return F.when(F.size(delays) < 1, F.lit(None)).when(F.element_at(delays, 1) > source, F.element_at(delays, 1)).otherwise(folded["sum"] / folded["tau"])


def stats_by(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean and sample deviation per key and, under 'default', over all rows; one scan."""
    out = df.groupingSets([[F.col(key)], []], key).agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"), F.grouping(key).alias("_all"))
    return out.select(F.when(F.col("_all") == 1, "default").otherwise(F.col(key)).alias(key), "mean", "std")


def label_index(df: DataFrame, label: str, name: str = "index") -> DataFrame:
    """Distinct labels with an index from 0 in sorted order."""
    return with_position(df.select(label).where(F.col(label).isNotNull()).distinct(), [label], name)


def hierarchical_weights(df: DataFrame, group: str, source: str, weight: str, temperatures: tuple[float, float]) -> DataFrame:
    """Weights of sources within groups, each level reweighted as w^t / sum(w^t): group, source, weight."""
    leaf = df.groupBy(group, source).agg(F.sum(weight).alias("_w"))
    own = F.pow(F.col("_w"), F.lit(temperatures[1]))
    inner = leaf.withColumn("_in", own / F.sum(own).over(Window.partitionBy(group)))
    groups = leaf.groupBy(group).agg(F.sum("_w").alias("_g"))
    g = F.pow(F.col("_g"), F.lit(temperatures[0]))
    groups = groups.withColumn("_out", g / F.sum(g).over(Window.partitionBy()))  # one row a group
    return inner.join(groups, group).select(group, source, (F.col("_in") * F.col("_out")).alias("weight"))


def dense_histogram(df: DataFrame, value: str, most: int | None = None) -> DataFrame:
    """Counts of the whole numbers from 0 to most, else to the largest value, zeros included: value, n."""
    if most is None:
        largest = df.agg(F.max(value)).first()[0]
        most = -1 if largest is None else max(int(largest), -1)
    counts = df.where(F.col(value).between(0, most)).groupBy(F.col(value).cast("int").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return df.sparkSession.range(most + 1).select(F.col("id").cast("int").alias("value")).join(counts, "value", "left").na.fill(0, ["n"])


def nearest_rank(df: DataFrame, value: str, share: float) -> float | None:
    """The value at place ceil(share * n) of the sorted values; found by counts of distinct values."""
    counts = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.count(F.lit(1)).alias("n"))
    upto = running_sum(counts, [], [value], "n", "_upto")
    total = counts.agg(F.sum("n")).first()[0]
    if not total:
        return None
    return upto.where(F.col("_upto") >= F.ceil(F.lit(share * total - 1e-9))).agg(F.min(value)).first()[0]


def commonest(df: DataFrame, value: str, first: str, n: int) -> DataFrame:
    """The n commonest values, ties by where they first appear."""
    return df.groupBy(value).agg(F.count(F.lit(1)).alias("n"), F.min(first).alias("_first")).orderBy(F.desc("n"), "_first").limit(n).select(value, "n")


def pareto_front(df: DataFrame, keys: Sequence[str], low: str, high: str) -> DataFrame:
    """Rows that no other row of their keys beats in both: a lower low and a higher high, one of them strictly."""
    before = Window.partitionBy(*keys).orderBy(F.col(low))
    best_before = F.max(high).over(before.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    strictly = df.withColumn("_best", best_before).where(F.col(high) >= F.col("_best")).drop("_best")
    return strictly


#: Confidence measures by name, each of a distribution and its number of classes.
CONFIDENCE: dict[str, Callable[..., Column]] = {m: partial(confidence, measure=m) for m in ("max_prob", *(f"entropy_{k}_{s}" for k in ("gibbs", "tsallis", "renyi") for s in ("lin", "exp")))}


def ngram_counts(df: DataFrame, words: Column, n: int = 2) -> DataFrame:
    """Counts of n-grams of words between sentence marks: context, word, n."""
    marked = F.concat(F.array_repeat(F.lit("<s>"), n - 1), words, F.array(F.lit("</s>")))
    gram = lambda w, i: F.struct(F.array_join(F.slice(w, i, F.lit(n - 1)), " ").alias("context"), F.element_at(w, i + n - 1).alias("word"))
    grams = let(marked, lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: gram(w, i)))
    return df.select(F.explode(grams).alias("g")).groupBy("g.context", "g.word").agg(F.count(F.lit(1)).alias("n"))


def merged_counts(tables: Sequence[tuple[DataFrame, float]]) -> DataFrame:
    """Counts of several corpora as one, each times its weight."""
    whole = reduce(lambda a, b: a.unionByName(b), [t.withColumn("n", F.col("n") * F.lit(float(w))) for t, w in tables])
    return whole.groupBy("context", "word").agg(F.sum("n").alias("n"))


def ngram_perplexity(counts: DataFrame, seen: DataFrame, add: float = 1.0) -> DataFrame:
    """Perplexity, in one row, of counted n-grams (seen) under a model of counts with add-one smoothing: words, perplexity.

    Both sides are counted before they meet, so a frequent n-gram is one row; contexts that may be hot meet by join_skewed.
    """
    counts, seen = stage(counts, "counts"), stage(seen, "seen")
    size = counts.select("word").distinct().count()
    whole = counts.groupBy("context").agg(F.sum("n").alias("_c"))
    met = seen.join(counts.select("context", "word", F.col("n").alias("_w")), ["context", "word"], "left")
    met = join_skewed(met, whole, ["context"], hot_keys(seen, ["context"]), "left")
    p = (F.coalesce("_w", F.lit(0.0)) + add) / (F.coalesce("_c", F.lit(0.0)) + add * size)
    return met.agg(F.sum("n").alias("words"), F.exp(-F.sum(F.col("n") * F.log(p)) / F.sum("n")).alias("perplexity"))


#: Fixed value: seconds of an epoch per byte of data and row of a batch.
SECONDS_A_BYTE = 0.0025


def epoch_time(df: DataFrame, columns: Sequence[str], batch: int) -> DataFrame:
    """How long an epoch takes, by the data's bytes over the batch size: seconds, shown (in seconds, minutes or hours)."""
    size = reduce(lambda a, b: a + b, [F.coalesce(F.octet_length(c), F.lit(0)) for c in columns])
    s = df.agg(F.coalesce(F.sum(size), F.lit(0)).alias("_b")).select((F.col("_b") / batch * SECONDS_A_BYTE).alias("seconds"))
    t = F.col("seconds")
    shown = F.when(t < 60, F.format_string("%.2f seconds", t)).when(t < 3600, F.format_string("%.2f minutes", t / 60)).otherwise(F.format_string("%.2f hours", t / 3600))
    return s.withColumn("shown", shown)
