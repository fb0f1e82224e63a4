"""Monthly climate: wide to long, day-weighted years, nearest pixels, look-back windows; and soil means."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unpivot_bands(wide: DataFrame, ids: Sequence[str], variables: Sequence[str]) -> DataFrame:
    """Variables as rows: the ids, ``band`` (lower case) and ``value``."""
    return wide.unpivot(list(ids), list(variables), "band", "value").withColumn("band", F.lower("band"))


def annual(monthly: DataFrame, how: str, by: Sequence[str] = ("variable",)) -> DataFrame:
    """``year`` and ``value`` from ``ts``, ``value``: months weighted by their share of the days of the year's months.

    ``mean`` divides by the weights of months with a value; anything else gives the weighted sum.
    """
    days = F.day(F.last_day("ts"))
    weights = days / F.sum(days).over(Window.partitionBy(*by, F.year("ts")))
    w = monthly.withColumns({"year": F.year("ts"), "_w": weights})
    total = F.coalesce(F.sum(F.col("value") * F.col("_w")), F.lit(0.0))
    seen = F.sum(F.when(F.col("value").isNotNull(), F.col("_w")).otherwise(0.0))
    return w.groupBy(*by, "year").agg((F.try_divide(total, seen) if how == "mean" else total).alias("value"))


def annual_each(monthly: DataFrame, how: dict[str, str], band: str = "band") -> DataFrame:
    """``annual`` of several variables at once, each with its own function; names in lower case, other variables left out."""
    ways = {k.lower(): v for k, v in how.items()}
    named = monthly.withColumn(band, F.lower(band)).where(F.lower(band).isin(*ways))
    both = [annual(named.where(F.col(band).isin(*[k for k, v in ways.items() if (v == "mean") == mean])), "mean" if mean else "sum", (band,)) for mean in (True, False)]
    return both[0].unionByName(both[1])


def nearest_point(points: DataFrame, grid: DataFrame, key: str, width: float, names: tuple[str, str] = ("grid_lon", "grid_lat")) -> DataFrame:
    """The key of each point and the coordinates ``lon, lat`` of a regular grid that are nearest to it on each axis."""
    out = points.select(key)
    for axis, name in zip(("lon", "lat"), names):
        places = grid.select(F.col(axis).alias(name)).distinct()
        out = out.join(nearest_pixel(points.select(key, axis), places, name, axis, key, width), key)
    return out


def nearest_pixel(points: DataFrame, axis: DataFrame, coord: str, point: str, key: str, width: float) -> DataFrame:
    """Each point with the nearest coordinate of a regular axis, the lesser one on a tie.

    ``width`` is the axis' step: the nearest lies in the point's cell of that
    size or a neighbouring one, so the join is by cell.  Points farther than a
    step from any coordinate get the nearest end of the axis.
    """
    cell = lambda c: F.floor(F.col(c) / F.lit(float(width))).cast("long")
    ends = axis.agg(F.min(coord).alias("_lo"), F.max(coord).alias("_hi"))
    within = points.crossJoin(F.broadcast(ends)).withColumn("_p", F.greatest(F.least(F.col(point), F.col("_hi")), F.col("_lo")))
    asked = within.select("*", F.explode(F.sequence(F.lit(-1), F.lit(1))).alias("_k")).withColumn("_c", cell("_p") + F.col("_k"))
    met = asked.join(axis.select(F.col(coord).alias("_v"), cell(coord).alias("_c")), "_c")
    best = met.groupBy(key).agg(F.min(F.struct(F.abs(F.col(point) - F.col("_v")).alias("d"), F.col("_v").alias("v"))).alias("_b"))
    return best.select(key, F.col("_b.v").alias(coord))


def lookback(year: Column, first: int, last: int) -> tuple[Column, Column]:
    """First and last day of the years from ``first`` to ``last`` before or after the given one."""
    return F.make_date(year + first, F.lit(1), F.lit(1)), F.make_date(year + last, F.lit(12), F.lit(31))


def soil_features(pixels: DataFrame, modal: str, means: Sequence[str]) -> DataFrame:
    """``soil_{band}_total``: the most frequent value of one band, means of the others."""
    at = lambda b: F.when(F.col("band") == b, F.col("value"))
    return pixels.groupBy("chip").agg(F.mode(at(modal), True).alias(f"soil_{modal}_total"), *[F.avg(at(b)).alias(f"soil_{b}_total") for b in means])
