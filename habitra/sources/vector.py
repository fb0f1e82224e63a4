"""Regions from text: WKT and GeoJSON polygons, of one or several parts, with holes.

A shape is ``rings``, an array of rings, each an array of structs ``x, y``.
Parts and holes are alike: a point is inside if it is within an odd number of
rings (``functions.geo.in_rings``), so neither needs a mark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from habitra.functions.geo import in_rings

RINGS = "array<array<struct<x: double, y: double>>>"
#: In GeoJSON of both kinds: a polygon's rings, and a list of them.
_PAIRS = "array<array<array<double>>>"


def wkt_rings(text: Column) -> Column:
    """Rings of a POLYGON or MULTIPOLYGON, a third coordinate left out; NULL for other text."""
    rings = F.regexp_extract_all(text, F.lit(r"\(([^()]+)\)"), F.lit(1))
    point = lambda p: F.split(F.trim(p), r"\s+")
    corner = lambda p: F.struct(F.get(point(p), F.lit(0)).try_cast("double").alias("x"), F.get(point(p), F.lit(1)).try_cast("double").alias("y"))
    shape = F.transform(rings, lambda r: F.transform(F.split(r, ","), corner))
    return F.when(F.upper(F.trim(text)).rlike(r"^(SRID=\d+;)?\s*(MULTI)?POLYGON"), shape)


def geojson_rings(geometry: Column) -> Column:
    """Rings of a Polygon or MultiPolygon given as JSON; NULL for other geometries."""
    corners = lambda rings: F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    kind, text = F.get_json_object(geometry, "$.type"), F.get_json_object(geometry, "$.coordinates")
    return F.when(kind == "Polygon", corners(F.from_json(text, _PAIRS))).when(kind == "MultiPolygon", corners(F.flatten(F.from_json(text, f"array<{_PAIRS}>"))))


def boxed(regions: DataFrame, rings: str = "rings") -> DataFrame:
    """Regions with the corners of their boxes, ``minx, miny, maxx, maxy``; those without a shape are left out."""
    points = F.flatten(rings)
    end = lambda f, c: f(F.transform(points, lambda p: p[c]))
    return regions.where(F.size(rings) > 0).withColumns({"minx": end(F.array_min, "x"), "miny": end(F.array_min, "y"), "maxx": end(F.array_max, "x"), "maxy": end(F.array_max, "y")})


def read_wkt(spark: SparkSession, path: str, schema: str, column: str = "geometry", sep: str = ",") -> DataFrame:
    """Regions of a delimited file with a header, whose shapes are WKT in one column."""
    rows = spark.read.csv(path, schema=schema, header=True, sep=sep, quote='"', escape='"', multiLine=True)
    return boxed(rows.withColumn("rings", wkt_rings(F.col(column))).drop(column))


def read_geojson(spark: SparkSession, path: str, properties: Sequence[str]) -> DataFrame:
    """Features of GeoJSON files, with the properties asked for as text."""
    file = spark.read.text(path, wholetext=True)
    features = F.from_json("value", "features array<struct<properties: string, geometry: string>>")["features"]
    rows = file.select(F.explode(features).alias("f"))
    named = [F.get_json_object("f.properties", f"$.{p}").alias(p) for p in properties]
    return boxed(rows.select(*named, geojson_rings(F.col("f.geometry")).alias("rings")))


def rings_literal(rings: Sequence[Sequence[tuple[float, float]]]) -> Column:
    """A shape given in Python."""
    return F.array(*[F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in r]) for r in rings])


def box_meets(box: Sequence[Column], rings: Column) -> Column:
    """Whether a box and a shape have a point in common: a corner of one is in the other, or their edges cross."""
    minx, miny, maxx, maxy = box
    inside = F.exists(F.flatten(rings), lambda p: p["x"].between(minx, maxx) & p["y"].between(miny, maxy))

    def crossed(ring: Column) -> Column:
        n = F.size(ring)

        def edge(i: Column) -> Column:
            a, b = F.get(ring, i), F.get(ring, (i + 1) % n)
            at = lambda v, p, q: F.try_divide(v - a[p], b[p] - a[p]) * (b[q] - a[q]) + a[q]
            meets = lambda v, p, q, lo, hi: F.coalesce(v.between(F.least(a[p], b[p]), F.greatest(a[p], b[p])) & at(v, p, q).between(lo, hi), F.lit(False))
            return meets(minx, "x", "y", miny, maxy) | meets(maxx, "x", "y", miny, maxy) | meets(miny, "y", "x", minx, maxx) | meets(maxy, "y", "x", minx, maxx)

        return F.exists(F.sequence(F.lit(0), n - 1), edge)

    return inside | in_rings(minx, miny, rings) | F.exists(rings, crossed)
