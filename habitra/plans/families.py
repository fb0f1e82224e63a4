"""The six feature families, from pixels to feature rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habitra.functions import raster
from habitra.functions.nulls import nan_to_null
from habitra.operators import chips, climate, terrain

#: Bands of the sources.
LANDSAT = ("coastal", "blue", "green", "red", "nir08", "swir16", "swir22", "lwir", "lwir11", "qa_pixel")
WATER = ("blue", "green", "red", "nir08", "swir16", "swir22", "qa_pixel")
SOIL = ("mukey", "aws0_100", "soc0_100", "tk0_100a", "tk0_100s", "musumcpct", "musumcpcta", "musumcpcts")
CLIMATE = ("Q", "Ws", "Aet", "Def", "Pet", "Ppt", "Swe", "Vap", "Vpd", "Pdsi", "Soil", "Srad", "Tmax", "Tmin")
WATER_BINS = {0: "nowater", 1: "water", 2: "water", 3: "wetland", 4: "wetland"}
NOT_FEATURES = ("qa_pixel", "lwir11")


@dataclass(frozen=True)
class Family:
    """What to read, and how to aggregate it.

    ``years`` are the first and last year relative to the observation's;
    ``fixed_year`` names the year of a layer that doesn't change.
    """

    name: str
    collection: str
    assets: tuple[str, ...]
    spatial: str | None = None
    temporal: str | None = None
    slices: str = "total"
    query: dict = field(default_factory=dict)
    formulas: dict[str, str] = field(default_factory=dict)
    to_reflectance: bool = False
    resolution: int | None = None
    years: tuple[int, int] | None = None
    fixed_year: int | None = None
    threshold: float = 0.05


#: What each family reads and how it is aggregated.
_SCENES = {"eo:cloud_cover": {"lt": 50}, "platform": {"eq": "landsat-8"}}
FAMILIES = {
    "landsat8": Family("l8", "landsat-c2-l2", LANDSAT, "mean", "median", "seasonal", _SCENES, to_reflectance=True, resolution=30, years=(-1, -1)),
    "indices": Family("indices", "landsat-c2-l2", LANDSAT, "mean", "mean", "seasonal", _SCENES, {"ndvi": "([nir08]-[red]) / ([nir08]+[red])"}, True, 30, (-1, -1)),
    "water": Family("water", "landsat-c2-l2", WATER, "perc_total", "mean", "seasonal", _SCENES, resolution=30, years=(-1, -1)),
    "nasadem": Family("nasadem", "nasadem", ("elevation",), fixed_year=2000),
    "gnatsgo": Family("soil", "gnatsgo-rasters", SOIL, "mean", fixed_year=2020),
    "terraclimate": Family("climate", "terraclimate", CLIMATE, "mean", "mean", "seasonal", years=(-10, -1)),
}


def family(kind: str, **changes: object) -> Family:
    """A family's settings, some of them changed."""
    if kind not in FAMILIES:
        raise ValueError(f"feature type {kind!r} isn't known; known: {', '.join(FAMILIES)}")
    return replace(FAMILIES[kind], **changes)


def wide_bands(pixels: DataFrame, bands: Sequence[str]) -> DataFrame:
    """``chip, ts, y, x`` and a column for each band."""
    return pixels.groupBy("chip", "ts", "y", "x").agg(*[F.max(F.when(F.col("band") == b, F.col("value"))).alias(b) for b in bands])


def long_bands(wide: DataFrame, bands: Sequence[str]) -> DataFrame:
    return wide.unpivot(["chip", "ts", "y", "x"], list(bands), "band", "value")


def rows(pixels: DataFrame, f: Family, scale: float = 10000.0) -> DataFrame:
    """The family's feature row of each chip, from ``chip, ts, y, x, band, value``.

    ``scale`` holds for the water tests' normalised differences, whose thresholds are meant for 10,000.
    """
    px = nan_to_null(pixels)
    clear = lambda p: chips.apply_mask(p, "qa_pixel", lambda v: raster.qa_cloud(v, cirrus=False))
    if f.name == "l8":
        bands = [b for b in f.assets if b not in NOT_FEATURES]
        seen = clear(px.where(F.col("band").isin(*bands, "qa_pixel")))
        if f.to_reflectance:
            seen = seen.withColumn("value", raster.reflectance(F.col("value")))
        return chips.features(seen, f.name, f.spatial, f.temporal, f.slices, bands)
    if f.name == "indices":
        bands = [b for b in f.assets if b not in NOT_FEATURES]
        seen = clear(px.where(F.col("band").isin(*bands, "qa_pixel")))
        if f.to_reflectance:
            seen = seen.withColumn("value", raster.reflectance(F.col("value")))
        found = wide_bands(seen, bands).select("chip", "ts", "y", "x", *[raster.formula(text).alias(n) for n, text in f.formulas.items()])
        return chips.features(long_bands(found, list(f.formulas)), f.name, f.spatial, f.temporal, f.slices, list(f.formulas))
    if f.name == "water":
        wide = wide_bands(px, f.assets)
        named = {"blue": "blue", "green": "green", "red": "red", "nir": "nir08", "swir1": "swir16", "swir2": "swir22"}
        found = wide.withColumns(raster.water_indices(*[F.col(c) for c in named.values()], scale=scale))
        parts = {k: F.col(c) for k, c in named.items()} | {k: F.col(k) for k in ("mndwi", "mbsr", "ndvi", "awesh")}
        classes = found.withColumn("value", F.when(~raster.qa_cloud(F.col("qa_pixel"), cirrus=False), raster.water_class(raster.water_tests(parts))))
        order = ("nowater", "water", "wetland")
        shares = chips.perc_total(classes.select("chip", "ts", "value"), WATER_BINS, order, f.threshold)
        return chips.features(shares, f.name, "mean", f.temporal, f.slices, order)
    if f.name == "nasadem":
        return terrain.features(px.groupBy("chip", "y", "x").agg(F.max("value").alias("value")))
    if f.name == "soil":
        return climate.soil_features(chips.nodata_mask(px), "mukey", [a for a in f.assets if a != "mukey"])
    names = [a.lower() for a in f.assets]
    return chips.features(px.withColumn("band", F.lower("band")), f.name, f.spatial, f.temporal, f.slices, names)
