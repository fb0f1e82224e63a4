"""Readers and writers of tables; schemas are given, never guessed."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from habitra.functions.geo import in_rings
from habitra.functions.text import sanitise_columns, slug
from habitra.operators.chips import resample
from habitra.sources.vector import box_meets


def parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def first_partition(df: DataFrame) -> DataFrame:
    """The rows of the first partition, for a look at the data."""
    return df.where(F.spark_partition_id() == 0)


def csv(spark: SparkSession, path: str | Sequence[str], schema: str | T.StructType, sanitise: bool = True) -> DataFrame:
    """A CSV file with a header; column names lose odd signs."""
    df = spark.read.csv(path if isinstance(path, str) else list(path), schema=schema, header=True, enforceSchema=True)
    return sanitise_columns(df) if sanitise else df


def feature_folders(spark: SparkSession, root: str, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """All files of each feature's folder as one table."""
    return {name: csv(spark, f"{root}/{name}", schema) for name, schema in schemas.items()}


def union_all(tables: Sequence[DataFrame]) -> DataFrame:
    """Rows of all tables by column names; a column that one lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [t.select("*") for t in tables])


def write_features(df: DataFrame, path: str, keys: Sequence[str] = ("cluster", "year")) -> None:
    """Feature rows by cluster and year; a run replaces the parts it writes and leaves the others."""
    df.repartition(*keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def write_species(df: DataFrame, path: str) -> None:
    """Rows by species, as CSV in folders named after the species."""
    df.withColumn("species_slug", slug(F.col("species"))).write.mode("overwrite").partitionBy("species_slug").csv(path, header=True)


#: What a mode of the chips' store means: make anew; make, or fail if it is there; replace or add bands; replace bands that are there.
MODES = {"w": "overwrite", "w-": "errorifexists", "a": "overwrite", "r+": "overwrite"}


def write_chips(pixels: DataFrame, path: str, mode: str = "w") -> None:
    """Pixels by band; colons in column names become underscores."""
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode!r}; known: {', '.join(MODES)}")
    named = pixels.withColumnsRenamed({c: c.replace(":", "_") for c in pixels.columns})
    if mode == "r+":
        held = pixels.sparkSession.read.parquet(path).select("band").distinct()
        new = named.select("band").distinct().join(held, "band", "left_anti").limit(5).collect()
        if new:
            raise ValueError(f"bands that aren't there: {sorted(r['band'] for r in new)}")
    dynamic = "dynamic" if mode in ("a", "r+") else "static"
    named.repartition("band", "chip").write.mode(MODES[mode]).option("partitionOverwriteMode", dynamic).partitionBy("band").parquet(path)


def quarantine(df: DataFrame, tests: dict[str, Column]) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all tests, and the others with ``error``, the name of the first test that fails or is NULL."""
    error = F.coalesce(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in tests.items()])
    marked = df.withColumn("error", error)
    return marked.where("error IS NULL").drop("error"), marked.where("error IS NOT NULL")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def parameters(text: str) -> dict:
    """JSON parameters, whose ``values`` may be JSON themselves."""
    out = json.loads(text)
    if isinstance(out.get("values"), str):
        out["values"] = json.loads(out["values"])
    return out


def time_range(period: str | tuple[str | date, str | date] | None, buffer_days: int = 0) -> tuple[date, date] | None:
    """First and last day of ``a/b`` (taken as it is), or of a pair widened by a buffer on both sides."""
    if period is None:
        return None
    if isinstance(period, str):
        a, _, b = period.partition("/")
        return date.fromisoformat(a), date.fromisoformat(b or a)
    a, b = (date.fromisoformat(x) if isinstance(x, str) else x for x in period)
    return a - timedelta(days=buffer_days), b + timedelta(days=buffer_days)


def bbox(points: DataFrame, x: str = "lon", y: str = "lat", by: Sequence[str] = ()) -> DataFrame:
    """``minx, miny, maxx, maxy`` of points."""
    return points.groupBy(*by).agg(F.min(x).alias("minx"), F.min(y).alias("miny"), F.max(x).alias("maxx"), F.max(y).alias("maxy"))


def buffered(box: DataFrame, by: float) -> DataFrame:
    """Boxes widened on all sides."""
    return box.withColumns({"minx": F.col("minx") - by, "miny": F.col("miny") - by, "maxx": F.col("maxx") + by, "maxy": F.col("maxy") + by})


_PROPERTY = {"lt": Column.__lt__, "lte": Column.__le__, "gt": Column.__gt__, "gte": Column.__ge__, "eq": Column.__eq__, "neq": Column.__ne__}


def search_scenes(catalog: DataFrame, collections: Sequence[str], area: tuple[float, float, float, float], period: tuple[date, date] | None, query: dict[str, dict[str, object]] | None = None, bad: DataFrame | None = None, shape: Column | None = None) -> DataFrame:
    """Scenes (``collection, scene, ts, minx, miny, maxx, maxy`` and properties) that meet the area, the period and the property tests.

    ``shape``, rings as in ``vector``, asks for scenes whose box it meets, beyond the area's box.  ``bad`` lists scenes known to be corrupt.  Property names are columns, their colons underscores.
    """
    minx, miny, maxx, maxy = area
    out = catalog.where(F.col("collection").isin(*collections) & (F.col("minx") <= maxx) & (F.col("maxx") >= minx) & (F.col("miny") <= maxy) & (F.col("maxy") >= miny))
    if shape is not None:
        out = out.where(box_meets([F.col(c) for c in ("minx", "miny", "maxx", "maxy")], shape))
    if period:
        out = out.where(F.col("ts").between(F.lit(period[0]), F.lit(period[1])))
    for name, tests in (query or {}).items():
        for test, value in tests.items():
            out = out.where(_PROPERTY[test](F.col(name.replace(":", "_")), F.lit(value)))
    return out.join(bad.select("scene"), "scene", "left_anti") if bad is not None else out


def load_pixels(
    pixels: DataFrame, scenes: DataFrame, assets: Sequence[str], area: tuple[float, float, float, float] | None = None, period: tuple[date, date] | None = None, clip: Column | None = None, step: float | None = None, resolution: float | None = None
) -> DataFrame:
    """Pixels of the scenes found, of the bands asked for (names in lower case), cut to an area, a period and a shape, at a resolution.

    ``clip`` is a shape's rings (``vector.rings_literal``): values outside of it
    become NULL.  ``resolution`` takes the nearest of pixels ``step`` apart.
    """
    out = pixels.where(F.lower("band").isin(*[a.lower() for a in assets])).join(scenes.select("scene"), "scene", "left_semi")
    if area:
        out = out.where(F.col("x").between(area[0], area[2]) & F.col("y").between(area[1], area[3]))
    if period:
        out = out.where(F.col("ts").between(F.lit(period[0]), F.lit(period[1])))
    if resolution and step and resolution != step:
        out = resample(out, step, resolution)
    if clip is not None:
        out = out.withColumn("value", F.when(in_rings(F.col("x"), F.col("y"), clip), F.col("value")))
    return out.withColumn("band", F.lower("band"))
