"""Levels of signals held as arrays of samples."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rms(samples: Column) -> Column:
    """The root of the mean square; null for no samples."""
    total = F.aggregate(samples, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.sqrt(total / F.when(F.size(samples) > 0, F.size(samples)))


def magnitude_to_db(value: Column) -> Column:
    return 20 * F.log10(value)


def db_to_magnitude(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 20)


def peak(samples: Column) -> Column:
    return F.array_max(F.transform(samples, lambda x: F.abs(x.cast("double"))))
