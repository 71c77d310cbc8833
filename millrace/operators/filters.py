"""Row filters over training rows, each a predicate column or a frame of kept rows, and their reports."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import count_words, strip
from millrace.operators.ordered import carry_last


def within(value: Column, least: float | None = None, most: float | None = None) -> Column:
    """least <= value <= most; a bound of None is open; a null value passes (the filter doesn't apply to the row).

    Said without coalesce, so that a filter on a plain column reaches the scan.
    """
    bounds = [value >= least] * (least is not None) + [value <= most] * (most is not None)
    return value.isNull() | reduce(and_, bounds) if bounds else F.lit(True)


def equals_or_missing(value: Column, keep: str) -> Column:
    return value.isNull() | (value == keep)


def tokens_per_second(tokens: Column, seconds: Column, least: float | None = None, most: float | None = None) -> Column:
    """The rate in range; rows without tokens or a positive duration pass."""
    return within(tokens / F.when(seconds > 0, seconds), least, most)


def tokens_per_token(answer: Column, context: Column, least: float | None = None, most: float | None = None) -> Column:
    """The length of the answer over that of the context in range; rows without context pass."""
    return within(answer / F.when(context > 0, context), least, most)


REASONS = ["too_short", "too_long", "too_few_chars", "too_many_chars"]


def drop_reason(seconds: Column, text: str, min_seconds: float = 0.5, max_seconds: float = 30.0, min_chars: int = 1, max_chars: int = 500) -> Column:
    """The first rule that a row fails, or null; characters are counted without outer white space, nulls count as 0."""
    s, n = F.coalesce(seconds, F.lit(0.0)), F.length(strip(F.coalesce(F.col(text), F.lit(""))))
    return F.when(s < min_seconds, REASONS[0]).when(s > max_seconds, REASONS[1]).when(n < min_chars, REASONS[2]).when(n > max_chars, REASONS[3])


def word_range(text: str, least: int, most: int) -> Column:
    n = count_words(text)
    return (n >= least) & (n <= most)


def frequent_only(df: DataFrame, label: str, least: int) -> DataFrame:
    """Rows whose label has at least least rows; a null label is a label of its own.

    Labels are counted first and met by an equi-join, so a hot label isn't gathered in one task.
    """
    kept = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= least).select(F.col(label).alias("_label"))
    return df.join(kept, df[label].eqNullSafe(kept["_label"]), "left_semi")


def without_outliers(df: DataFrame, value: str, threshold: float) -> DataFrame:
    """Rows whose value is at most threshold population deviations above the mean; constant and null values stay."""
    stats = df.agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s")).first()
    if stats is None or not stats["_s"]:
        return df
    return df.where(F.coalesce((F.col(value) - stats["_m"]) / stats["_s"] <= threshold, F.lit(True)))


def unskipped(df: DataFrame, flag: str = "_skipme") -> DataFrame:
    return df.where(~F.coalesce(F.col(flag), F.lit(False)))


def select_shards(df: DataFrame, shard: str, wanted: str) -> DataFrame:
    """Shards by 'a:b' (half-open), 'n' or 'all'; a plain predicate on the shard column, so partitions are pruned."""
    if wanted == "all":
        return df
    first, colon, last = wanted.partition(":")
    if not colon:
        return df.where(F.col(shard) == int(wanted))
    return df.where((F.col(shard) >= int(first or 0)) & (F.col(shard) < int(last) if last else F.lit(True)))


_TOKEN = re.compile(r"\s*(?:(\(|\))|(and|or|xor|not)\b|(\.[\w.]+)\s*(==|!=)\s*(\.[\w.]+|\"[^\"]*\"|'[^']*'|[^\s()]+))")


def constraint(text: str, columns: Sequence[str]) -> Column:
    """A predicate in the small constraint language: .key==value, .a!=.b, and, or, xor, not, parentheses.

    'not' binds most, then 'and', then 'or', then 'xor'. Values compare as strings; a key that isn't a column is null, and
    null equals nothing but another null key, as a missing key would. An empty constraint holds for every row.
    """
    tokens, at = [], 0
    text = text.strip()
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise ValueError(f"the constraint can't be read from: {text[at:]!r}")
        tokens.append(m)
        at = m.end()
        while at < len(text) and text[at].isspace():
            at += 1
    if not tokens:
        return F.lit(True)
    place = 0

    def side(x: str) -> Column:
        if x.startswith("."):
            name = x[1:]
            return F.col(name).cast("string") if name.split(".")[0] in columns else F.lit(None).cast("string")
        return F.lit(x.strip("'\""))

    def peek(*words: str) -> bool:
        return place < len(tokens) and (tokens[place][1] or tokens[place][2]) in words

    def unit() -> Column:
        nonlocal place
        if place >= len(tokens):
            raise ValueError("the constraint ends too early")
        m = tokens[place]
        place += 1
        if m[2] == "not":
            return ~unit()
        if m[1] == "(":
            out = level(0)
            if not peek(")"):
                raise ValueError("a parenthesis isn't closed")
            place += 1
            return out
        if not m[3]:
            raise ValueError(f"unexpected {m[0].strip()!r}")
        same = side(m[3]).eqNullSafe(side(m[5]))
        return same if m[4] == "==" else ~same

    def level(i: int) -> Column:
        nonlocal place
        if i == 3:
            return unit()
        word = ("xor", "or", "and")[i]
        out = level(i + 1)
        while peek(word):
            place += 1
            right = level(i + 1)
            out = (out & right) if word == "and" else (out | right) if word == "or" else (out != right)
        return out

    out = level(0)
    if place < len(tokens):
        raise ValueError(f"unexpected {tokens[place][0].strip()!r}")
    return out


def routed(df: DataFrame, metrics: dict[str, tuple[Column, str]]) -> DataFrame:
    """Metrics, each over the rows of its own constraint, in one pass; a row may count for several or none."""
    return df.agg(*[F.expr("count(1)").alias("rows"), *[agg_if(value, constraint(rule, df.columns)).alias(name) for name, (value, rule) in metrics.items()]])


def agg_if(value: Column, when: Column) -> Column:
    return F.avg(F.when(when, value))


def last_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """A null value gives way to the last value before it among the rows of the same keys, however many those are."""
    filled = carry_last(df, keys, order, value, "_before")
    return filled.withColumn(value, F.coalesce(value, "_before")).drop("_before")
