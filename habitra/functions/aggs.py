"""Aggregates by name; all skip NULL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _iqr(v: Column) -> Column:
    p = F.percentile(v, F.array(F.lit(0.25), F.lit(0.75)))
    return p[1] - p[0]


#: std is the population's; the sum of no values is 0, all else of no values is NULL; mode is the least of the most frequent values.
AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "median": F.median,
    "std": F.stddev_pop,
    "sum": lambda v: F.coalesce(F.sum(v), F.lit(0.0)),
    "min": F.min,
    "max": F.max,
    "iqr": _iqr,
    "mode": lambda v: F.mode(v, True),
}


def aggregate(name: str, value: Column) -> Column:
    if name not in AGGREGATES:
        raise ValueError(f"unknown aggregate {name!r}; known: {', '.join(AGGREGATES)}")
    return AGGREGATES[name](value)
