"""Projection and geometry expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Semi-major axis and inverse flattening of the two ellipsoids, scale, false easting and southern false northing of UTM.
ELLIPSOIDS = {"GRS80": (6378137.0, 298.257222101), "WGS84": (6378137.0, 298.257223563)}
SCALE, FALSE_EASTING, FALSE_NORTHING = 0.9996, 500000.0, 10000000.0


def utm_zone(lon: Column) -> Column:
    """Zone number of a longitude."""
    return (F.floor((lon + 180.0) / 6.0) + 1).cast("int")


def utm_epsg(lon: Column, lat: Column | None = None) -> Column:
    """EPSG code of the zone; northern unless a latitude is given."""
    base = F.lit(32600) if lat is None else F.when(lat < 0, 32700).otherwise(32600)
    return base + utm_zone(lon)


def kruger(ellipsoid: str = "GRS80") -> dict[str, float | tuple[float, ...]]:
    """Constants of the transverse Mercator series of third order."""
    a, inverse = ELLIPSOIDS[ellipsoid]
    f = 1 / inverse
    n = f / (2 - f)
    return {
        "A": a / (1 + n) * (1 + n**2 / 4 + n**4 / 64),
        "e": 2 * math.sqrt(n) / (1 + n),
        "beta": (n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96, n**2 / 48 + n**3 / 15, 17 * n**3 / 480),
        "delta": (2 * n - 2 * n**2 / 3 - 2 * n**3, 7 * n**2 / 3 - 8 * n**3 / 5, 56 * n**3 / 15),
        "alpha": (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240),
    }


def _centre(zone: Column | int) -> Column:
    return (F.lit(zone) if isinstance(zone, int) else zone) * 6.0 - 183.0


def _northing(south: Column | bool) -> Column:
    return F.when(F.lit(south) if isinstance(south, bool) else south, FALSE_NORTHING).otherwise(0.0)


def utm(lon: Column, lat: Column, zone: Column | int, ellipsoid: str = "GRS80", south: Column | bool = False) -> tuple[Column, Column]:
    """Easting and northing in a zone, a northern one unless told so."""
    k = kruger(ellipsoid)
    centre = _centre(zone)
    sine = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - F.lit(k["e"]) * F.atanh(F.lit(k["e"]) * sine))
    turn = F.radians(lon - centre)
    xi = F.atan2(t, F.cos(turn))
    eta = F.atanh(F.sin(turn) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for i, alpha in enumerate(k["alpha"], 1):
        x = x + F.lit(alpha) * F.cos(2 * i * xi) * F.sinh(2 * i * eta)
        y = y + F.lit(alpha) * F.sin(2 * i * xi) * F.cosh(2 * i * eta)
    return F.lit(SCALE * k["A"]) * x + FALSE_EASTING, F.lit(SCALE * k["A"]) * y + _northing(south)


def lonlat(x: Column, y: Column, zone: Column | int, ellipsoid: str = "GRS80", south: Column | bool = False) -> tuple[Column, Column]:
    """Longitude and latitude of an easting and northing: the inverse of ``utm``."""
    k = kruger(ellipsoid)
    eta0, xi0 = (x - FALSE_EASTING) / F.lit(SCALE * k["A"]), (y - _northing(south)) / F.lit(SCALE * k["A"])
    eta, xi = eta0, xi0
    for i, beta in enumerate(k["beta"], 1):
        eta = eta - F.lit(beta) * F.cos(2 * i * xi0) * F.sinh(2 * i * eta0)
        xi = xi - F.lit(beta) * F.sin(2 * i * xi0) * F.cosh(2 * i * eta0)
    chi = F.asin(F.sin(xi) / F.cosh(eta))
    lat = chi
    for i, delta in enumerate(k["delta"], 1):
        lat = lat + F.lit(delta) * F.sin(2 * i * chi)
    return _centre(zone) + F.degrees(F.atan2(F.sinh(eta), F.cos(xi))), F.degrees(lat)


def boxes(box: tuple[Column, Column, Column, Column], source: int, target: int) -> tuple[Column, Column, Column, Column]:
    """Corners ``minx, miny, maxx, maxy`` from one system to another by its lower left and upper right; EPSG 4326 and the codes of UTM zones."""

    def zone(code: int) -> tuple[int, bool]:
        if not (32601 <= code <= 32660 or 32701 <= code <= 32760):
            raise ValueError(f"unknown system {code}")
        return code % 100, code >= 32700

    if source == target:
        return box
    corners = [(box[0], box[1]), (box[2], box[3])]
    if source != 4326:
        corners = [lonlat(x, y, zone(source)[0], "WGS84", zone(source)[1]) for x, y in corners]
    if target != 4326:
        corners = [utm(x, y, zone(target)[0], "WGS84", zone(target)[1]) for x, y in corners]
    return (*corners[0], *corners[1])


def in_ring(lon: Column, lat: Column, ring: Column) -> Column:
    """Whether a point lies in a polygon or on its border; the ring is an array of structs x, y, closed or not."""
    side = ring_side(lon, lat, ring)
    return side["on"] | side["in"]


def in_rings(lon: Column, lat: Column, rings: Column) -> Column:
    """Whether a point lies in a shape of several rings, parts and holes alike, or on one of its borders: within an odd number of them."""
    start = F.struct(F.lit(False).alias("on"), F.lit(False).alias("in"))

    def step(acc: Column, ring: Column) -> Column:
        side = ring_side(lon, lat, ring)
        return F.struct((acc["on"] | side["on"]).alias("on"), (acc["in"] != side["in"]).alias("in"))

    return F.aggregate(rings, start, step, lambda a: a["on"] | a["in"])


def ring_side(lon: Column, lat: Column, ring: Column) -> Column:
    """``on`` the border of a ring, and ``in`` it."""
    n = F.size(ring)
    edge = lambda i: (F.get(ring, i), F.get(ring, (i + 1) % n))

    def step(acc: Column, i: Column) -> Column:
        a, b = edge(i)
        cross = (b["x"] - a["x"]) * (lat - a["y"]) - (b["y"] - a["y"]) * (lon - a["x"])
        on = (cross == 0) & lon.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & lat.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        spans = (a["y"] > lat) != (b["y"] > lat)
        left = spans & (((b["y"] > a["y"]) & (cross > 0)) | ((b["y"] < a["y"]) & (cross < 0)))
        return F.struct((acc["on"] | on).alias("on"), (acc["in"] != left).alias("in"))

    start = F.struct(F.lit(False).alias("on"), F.lit(False).alias("in"))
    return F.aggregate(F.sequence(F.lit(0), n - 1), start, step)
