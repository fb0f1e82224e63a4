"""Space-time grids for inference, and their merge with gold rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from habitra.functions.geo import lonlat
from habitra.operators.gold import numbered

#: Columns that a merged row sheds before scoring.
MERGE_DROPS = ("soil_mukey_total", "id", "gbifid", "x", "y", "decimallatitude", "decimallongitude", "time", "year")


def _steps(lo: float, hi: float, step: float) -> int:
    n = int((hi - lo) / step)
    return n + (lo + n * step < hi)


#: Months between the period ends of a stride.
MONTHS = {"m": 1, "q": 3, "y": 12}


def period_ends(first: date, last: date, stride: str) -> tuple[int, Callable[[Column], Column]]:
    """How many ends of years, quarters, months, weeks (Sundays) or days lie from first to last, and the k-th as a date."""
    if stride in ("d", "w"):
        days = 1 if stride == "d" else 7
        start = first if stride == "d" else first + timedelta(days=(6 - first.weekday()) % 7)
        n = max(0, (last - start).days // days + 1)
        return n, lambda k: F.date_add(F.lit(start), (k * days).cast("int"))
    if stride not in MONTHS:
        raise ValueError(f"unknown stride {stride!r}; known: d, w, {', '.join(MONTHS)}")
    step = MONTHS[stride]
    at = first.year * 12 + first.month - 1
    at += (step - 1 - at) % step  # the month that ends the first period
    end = last.year * 12 + last.month - 1 - ((last + timedelta(days=1)).month == last.month)
    n = max(0, (end - at) // step + 1)
    return n, lambda k: F.last_day(F.add_months(F.lit(date(at // 12, at % 12 + 1, 1)), (k * step).cast("int")))


def segment_grid(spark: SparkSession, bbox: tuple[float, float, float, float], stride_x: float, stride_y: float, first: int | date, last: int | date, buffer: bool = True, stride: str = "y", zone: int | None = None, south: bool = False) -> DataFrame:
    """``x, y, time``: points of the box (ends excluded) at the ends of all periods from first to last (days, or whole years); ranges, so made in parallel.

    With a UTM ``zone`` also ``decimallatitude`` and ``decimallongitude``.
    """
    minx, miny, maxx, maxy = bbox
    if buffer:
        minx, miny, maxx, maxy = minx - stride_x / 2, miny - stride_y / 2, maxx + stride_x / 2, maxy + stride_y / 2
    first, last = (date(d, m, n) if isinstance(d, int) else d for d, m, n in ((first, 1, 1), (last, 12, 31)))
    nt, end = period_ends(first, last, stride)
    nx, ny = _steps(minx, maxx, stride_x), _steps(miny, maxy, stride_y)
    at = spark.range(nx * ny * nt).withColumn("n", F.col("id"))
    i, j, t = F.floor(F.col("n") / (ny * nt)), F.floor(F.col("n") / nt) % ny, F.col("n") % nt
    out = at.select((F.lit(minx) + i * stride_x).alias("x"), (F.lit(miny) + j * stride_y).alias("y"), F.date_format(end(t), "yyyy-MM-dd").alias("time"))
    if zone is None:
        return out
    lon, lat = lonlat(F.col("x"), F.col("y"), zone, "WGS84", south)
    return out.withColumns({"decimallatitude": lat, "decimallongitude": lon})


def segment_ids(grid: DataFrame, prefix: str = "CPT") -> DataFrame:
    """``id``: the prefix and the row's number in order of x, y, time, padded to one digit more than the count has."""
    total = grid.agg(F.count("*").alias("_n"))
    width = F.length(F.col("_n").cast("string")) + 1
    counted = numbered(grid, ["x", "y", "time"], "_i").crossJoin(F.broadcast(total))
    return counted.withColumn("id", F.concat(F.lit(prefix), F.lpad(F.col("_i").cast("string"), width, F.lit("0")))).drop("_i", "_n")


def year_month(df: DataFrame, time: str = "time") -> DataFrame:
    """``year`` and ``month`` of a time string."""
    part = F.split(F.col(time), "-")
    return df.withColumns({"year": part[0].cast("int"), "month": part[1].cast("int")})


def merge_segments(segments: DataFrame, gold: DataFrame, skip_year: str = "2013", drop: tuple[str, ...] = ()) -> DataFrame:
    """All segments with their gold row, but those of the skipped year; columns dropped must be there."""
    merged = segments.join(gold, segments["id"] == gold["gbifid"], "left").where(F.split("time", "-")[0] != skip_year)
    missing = set(drop) - set(merged.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    return merged.drop(*drop)
