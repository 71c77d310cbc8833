"""Metrics as mergeable states: kept per day or shard, added up later, and worked out only at the end.

A metric is a set of named sums (or least and greatest values) over rows, and a formula over them. updated makes a table
of states, merged adds such tables up over coarser keys, computed gives the values; states of any two sets of rows merge to
the state of their union.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.aggregates import errors_and_size

#: How states of one name are brought together.
JOINED: dict[str, Callable[[Column], Column]] = {"sum": F.sum, "min": F.min, "max": F.max}


class Metric(NamedTuple):
    """states: name to (how they are joined, the row's part); value: from the states' columns to the metric."""

    states: dict[str, tuple[str, Column]]
    value: Callable[..., Column]


def _share(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


def exact_match(pred: str, target: str) -> Metric:
    """The share of rows whose prediction is the target; a null on either side is no match."""
    hit = F.coalesce(F.col(pred) == F.col(target), F.lit(False)).cast("bigint")
    return Metric({"correct": ("sum", hit), "total": ("sum", F.lit(1).cast("bigint"))}, lambda correct, total: _share(correct, total))


def word_errors(hyp: str, ref: str, chars: bool = False) -> Metric:
    """Edits over the references' sizes."""
    e, n = errors_and_size(hyp, ref, chars)
    return Metric({"errors": ("sum", e.cast("bigint")), "size": ("sum", n.cast("bigint"))}, lambda errors, size: _share(errors, size))


def perplexity(log_probability: str, tokens: str) -> Metric:
    """exp of the mean negative log-probability per token."""
    return Metric({"nll": ("sum", -F.col(log_probability).cast("double")), "tokens": ("sum", F.col(tokens).cast("bigint"))}, lambda nll, tokens: F.exp(F.try_divide(nll, tokens.cast("double"))))


def mean_loss(loss: str, weight: str) -> Metric:
    """The mean of a loss weighted by batch size."""
    known = F.col(loss).isNotNull() & F.col(weight).isNotNull()
    return Metric({"loss": ("sum", F.when(known, F.col(loss) * F.col(weight)).cast("double")), "weight": ("sum", F.when(known, F.col(weight)).cast("double"))}, lambda loss, weight: F.try_divide(loss, weight))


def spread(value: str) -> Metric:
    """Greatest less least value."""
    return Metric({"low": ("min", F.col(value)), "high": ("max", F.col(value))}, lambda low, high: high - low)


#: Metrics by name; register adds to them.
METRICS: dict[str, Callable[..., Metric]] = {"exact_match": exact_match, "word_errors": word_errors, "perplexity": perplexity, "mean_loss": mean_loss, "spread": spread}


def register(name: str, make: Callable[..., Metric]) -> None:
    METRICS[name] = make


def updated(df: DataFrame, metrics: dict[str, Metric], by: Sequence[str] = ()) -> DataFrame:
    """The states of the rows, a row per keys: columns by, and metric__state for each state; one pass, reduced before the shuffle."""
    return df.groupBy(*by).agg(*[JOINED[how](part).alias(f"{m}__{s}") for m, x in metrics.items() for s, (how, part) in x.states.items()])


def merged(states: Sequence[DataFrame] | DataFrame, metrics: dict[str, Metric], by: Sequence[str] = ()) -> DataFrame:
    """States of several tables, or of finer keys, as one: columns by and the states."""
    tables = [states] if isinstance(states, DataFrame) else list(states)
    whole = reduce(lambda a, b: a.unionByName(b), tables)
    return whole.groupBy(*by).agg(*[JOINED[how](f"{m}__{s}").alias(f"{m}__{s}") for m, x in metrics.items() for s, (how, _) in x.states.items()])


def computed(states: DataFrame, metrics: dict[str, Metric], by: Sequence[str] = ()) -> DataFrame:
    """The metrics' values: columns by and a column per metric; null where nothing was counted."""
    return states.select(*by, *[x.value(*[F.col(f"{m}__{s}") for s in x.states]).alias(m) for m, x in metrics.items()])
