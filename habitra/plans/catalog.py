"""Queries of every operator over the driver's tables, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from habitra.functions import geo, raster, text
from habitra.functions.geo import SCALE, kruger
from habitra.functions.nulls import nan_to_null
from habitra.operators import chips, climate, gold, grid, ml, occurrences, segments, terrain
from habitra.plans import families
from habitra.plans import surrogates as S
from habitra.session import small, stored

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def add(name: str, query: Query, sql: str | None = None) -> None:
    QUERIES[name] = query
    if sql:
        SQL[name] = f"WITH {S.SQL}{',' if sql.lstrip().startswith('+') else ''}{sql.lstrip().lstrip('+')}"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})


def day(df: DataFrame, column: str = "ts") -> DataFrame:
    return df.withColumn(column, F.date_format(column, "yyyy-MM-dd"))


# aggregates in space, in time, and in slices of time
_AGG = {"mean": "avg({v})", "median": "median({v})", "std": "stddev_pop({v})", "sum": "coalesce(sum({v}), 0e0)", "min": "min({v})", "max": "max({v})", "iqr": "quantile_cont({v}, 0.75) - quantile_cont({v}, 0.25)"}


def _grouped(source: str, keys: str, how: str, value: str = "value") -> str:
    if how != "mode":
        return f"SELECT {keys}, {_AGG[how].format(v=value)} AS value FROM {source} GROUP BY ALL"
    return (
        f"SELECT {keys}, max(CASE WHEN r = 1 THEN {value} END) AS value FROM (SELECT {keys}, {value}, row_number() OVER (PARTITION BY {keys} ORDER BY ({value} IS NULL), n DESC, {value}) AS r "
        f"FROM (SELECT {keys}, {value}, count(*) AS n FROM {source} GROUP BY ALL)) GROUP BY ALL"
    )


for _how in (*_AGG, "mode"):
    add(
        f"spatial_agg_{_how}",
        lambda s, d, how=_how: rounded(day(chips.spatial_aggregate(nan_to_null(S.pixels(s, d)), how)), "value"),
        f"SELECT chip, strftime(ts, '%Y-%m-%d') AS ts, band, round(value, 6) AS value FROM ({_grouped('pixels', 'chip, ts, band', _how)})",
    )
    add(
        f"temporal_agg_{_how}",
        lambda s, d, how=_how: rounded(chips.temporal_aggregate(rounded(chips.spatial_aggregate(S.pixels(s, d), "mean"), "value"), how), "value", digits=9),
        f"SELECT chip, band, round(value, 9) AS value FROM ({_grouped('(SELECT chip, ts, band, round(avg(value), 6) AS value FROM pixels GROUP BY ALL)', 'chip, band', _how)})",
    )

_SERIES = "+ series AS (SELECT chip, ts, band, avg(value) AS value FROM pixels GROUP BY ALL)"
_SLICE = {"total": "'total'", "seasonal": "list_extract(['s_jfm', 's_amj', 's_jas', 's_ond'], quarter(ts))", "monthly": "'m_' || month(ts)"}
for _kind, _expr in _SLICE.items():
    _names = ", ".join(f"('{n}')" for n in chips.slice_names(_kind))
    add(
        f"feat_{_kind}",
        lambda s, d, kind=_kind: rounded(chips.sliced(chips.spatial_aggregate(S.pixels(s, d), "mean"), kind, "median"), "value"),
        f"""{_SERIES}, v AS (SELECT chip, band, {_expr} AS slice, median(value) AS value FROM series GROUP BY ALL)
        SELECT k.chip, k.band, k.slice, round(v.value, 6) AS value
        FROM (SELECT chip, band, n.slice FROM (SELECT DISTINCT chip, band FROM series), (VALUES {_names}) AS n(slice)) k
        LEFT JOIN v ON v.chip = k.chip AND v.band = k.band AND v.slice = k.slice""",
    )
add(
    "feat_yearly",
    lambda s, d: rounded(chips.sliced(chips.spatial_aggregate(S.pixels(s, d), "mean"), "yearly", "mean"), "value"),
    f"""{_SERIES}, r AS (SELECT *, 'y_' || dense_rank() OVER (PARTITION BY chip ORDER BY year(ts)) AS slice FROM series)
    SELECT chip, band, slice, round(avg(value), 6) AS value FROM r GROUP BY ALL""",
)
add(
    "feat_seasonal_contiguous",
    lambda s, d: rounded(chips.sliced(chips.spatial_aggregate(S.pixels(s, d), "mean"), "seasonal", "mean", contiguous=True), "value", digits=9),
    f"""{_SERIES}, m AS (SELECT *, {_SLICE["seasonal"]} AS slice FROM series),
    w AS (SELECT chip, slice, min(ts) AS lo, max(ts) AS hi FROM m GROUP BY ALL)
    SELECT k.chip, k.band, k.slice, round(avg(m.value), 9) AS value
    FROM (SELECT chip, band, n.slice FROM (SELECT DISTINCT chip, band FROM series), (VALUES ('s_jfm'), ('s_amj'), ('s_jas'), ('s_ond')) AS n(slice)) k
    LEFT JOIN w ON w.chip = k.chip AND w.slice = k.slice LEFT JOIN m ON m.chip = k.chip AND m.band = k.band AND m.ts BETWEEN w.lo AND w.hi GROUP BY ALL""",
)

_WIDE = ", ".join(f"round(median(CASE WHEN band = '{b}' AND quarter(ts) = {q} THEN value END), 6) AS l8_{b}_{n}" for b in "ANR" for q, n in enumerate(chips.SEASONS, 1))


def chip_features_wide(s: SparkSession, d: str) -> DataFrame:
    out = chips.features(nan_to_null(S.pixels(s, d)), "l8", "mean", "median", "seasonal", ("A", "N", "R"))
    return rounded(out, *out.columns[1:])


add("chip_features_wide", chip_features_wide, f"{_SERIES} SELECT chip, {_WIDE} FROM series GROUP BY chip")

add(
    "perc_total",
    lambda s, d: rounded(day(chips.perc_total(S.pixels(s, d).withColumn("value", F.floor(F.col("value") / 10)), {0: "low", 1: "low", 2: "mid", 3: "mid", 4: "high"}, ("low", "mid", "high"), 0.25)), "value"),
    """+ q AS (SELECT chip, ts, floor(value / 10) AS v FROM pixels),
    g AS (SELECT chip, ts, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE) AS miss, count(*) AS n,
          sum(CASE WHEN v IN (0, 1) THEN 1 ELSE 0 END) AS low, sum(CASE WHEN v IN (2, 3) THEN 1 ELSE 0 END) AS mid, sum(CASE WHEN v IN (4) THEN 1 ELSE 0 END) AS high FROM q GROUP BY ALL)
    SELECT chip, strftime(ts, '%Y-%m-%d') AS ts, b.band, round(CASE WHEN miss < 0.25 THEN CASE b.band WHEN 'low' THEN low WHEN 'mid' THEN mid ELSE high END / CAST(n AS DOUBLE) END, 6) AS value
    FROM g, (VALUES ('low'), ('mid'), ('high')) AS b(band)""",
)

# masks
_CONF = {"high": "(3)", "low": "(1, 2, 3)", "medium": "(2, 3)"}
for _level, _in in _CONF.items():
    add(
        f"cloud_mask_qa_{_level}",
        lambda s, d, level=_level: S.scenes(s, d).groupBy("qa").agg(F.count("*").alias("n")).select("qa", "n", raster.cloud_mask("QA_PIXEL", F.col("qa"), level).alias("cloud")),
        f"SELECT qa, count(*) AS n, ((qa >> 8) & 3) IN {_in} OR ((qa >> 14) & 3) IN {_in} AS cloud FROM scenes GROUP BY qa",
    )
add(
    "cloud_mask_scl",
    lambda s, d: S.scenes(s, d).groupBy((F.col("qa") % 12).alias("scl")).agg(F.count("*").alias("n")).select("scl", "n", raster.cloud_mask("scl", F.col("scl"), "medium").alias("medium"), raster.cloud_mask("SCL", F.col("scl"), "high", cirrus=False).alias("high")),
    "SELECT qa % 12 AS scl, count(*) AS n, qa % 12 IN (8, 9, 10) AS medium, qa % 12 IN (9) AS high FROM scenes GROUP BY ALL",
)
add(
    "apply_cloud_mask",
    lambda s, d: day(chips.apply_mask(S.pixels(s, d), "R", lambda v: v > 25).groupBy("chip", "ts", "band").agg(F.count("*").alias("n"), F.count("value").alias("clear"))),
    """+ m AS (SELECT *, max(CASE WHEN band = 'R' THEN value END) OVER (PARTITION BY chip, ts, y, x) AS mask FROM pixels)
    SELECT chip, strftime(ts, '%Y-%m-%d') AS ts, band, count(*) AS n, count(CASE WHEN NOT (mask > 25) THEN value END) AS clear FROM m WHERE band <> 'R' GROUP BY ALL""",
)
add(
    "nodata_mask",
    lambda s, d: chips.nodata_mask(S.pixels(s, d), "R", 10).groupBy("chip", "band").agg(F.count("*").alias("n"), F.sum("value").alias("total")),
    """+ m AS (SELECT *, max(CASE WHEN band = 'R' THEN value END) OVER (PARTITION BY chip, ts, y, x) AS t FROM pixels)
    SELECT chip, band, count(*) AS n, sum(value) AS total FROM m WHERE t > 10 GROUP BY ALL""",
)

# indices and water
add(
    "dn_to_reflectance",
    lambda s, d: S.scenes(s, d).select("l_orderkey", "l_linenumber", *[F.round(raster.reflectance(F.col(b) * 10), 6).alias(b) for b in S.BANDS]),
    "SELECT l_orderkey, l_linenumber, " + ", ".join(f"round({b} * 10 * 0.0000275e0 - 0.2e0, 6) AS {b}" for b in S.BANDS) + " FROM scenes",
)
add(
    "index_ndvi",
    lambda s, d: S.scenes(s, d).select("l_orderkey", "l_linenumber", F.round(raster.formula("([nir08]-[red]) / ([nir08]+[red])"), 6).alias("ndvi")),
    "SELECT l_orderkey, l_linenumber, round((nir08 - red) / (nir08 + red), 6) AS ndvi FROM scenes",
)
add(
    "index_formula_custom",
    lambda s, d: S.scenes(s, d).select("l_orderkey", F.round(raster.formula("([swir22]-[red]+[blue])*([red]/1000)**2"), 4).alias("abc"), F.round(raster.formula("[green]-[swir16]/[swir22]+0.12"), 6).alias("def_")),
    "SELECT l_orderkey, round((swir22 - red + blue) * power(red / 1000, 2), 4) AS abc, round(green - swir16 / swir22 + 0.12, 6) AS def_ FROM scenes",
)


def _water(df: DataFrame) -> DataFrame:
    return df.withColumns(raster.water_indices(*[F.col(b) for b in S.BANDS]))


_WATER_SQL = """+ w AS (SELECT *, (green - swir16) / (green + swir16) * 10000 AS mndwi, (nir08 - red) / (nir08 + red) * 10000 AS ndvi,
    (green + red) - (nir08 + swir16) AS mbsr, blue + 2.5e0 * green - 1.5e0 * (nir08 + swir16) - 0.25e0 * swir22 AS awesh FROM scenes),
t AS (SELECT *, (CASE WHEN mndwi > 124 THEN 1 ELSE 0 END) + (CASE WHEN mbsr > 0 THEN 10 ELSE 0 END) + (CASE WHEN awesh > 0 THEN 100 ELSE 0 END)
    + (CASE WHEN mndwi > -4400 AND swir16 < 9000 AND nir08 < 15000 AND ndvi < 7000 THEN 1000 ELSE 0 END)
    + (CASE WHEN mndwi > -5000 AND blue < 1000 AND nir08 < 2500 AND swir16 < 3000 AND swir22 < 1000 THEN 10000 ELSE 0 END) AS code FROM w),
k AS (SELECT *, code % 10 + code // 10 % 10 + code // 100 % 10 + code // 1000 % 10 + code // 10000 AS n FROM t),
c AS (SELECT *, CASE WHEN n >= 4 THEN 1 WHEN n = 3 THEN 2 WHEN code = 11000 THEN 3 WHEN n = 2 OR code = 10000 THEN 4 ELSE 0 END AS dswe FROM k)
"""


def _codes(df: DataFrame) -> DataFrame:
    px = {"blue": "blue", "nir": "nir08", "swir1": "swir16", "swir2": "swir22"} | {n: n for n in ("mndwi", "mbsr", "ndvi", "awesh")}
    return _water(df).withColumn("code", raster.water_tests({k: F.col(v) for k, v in px.items()}))


add("mndwi_ndvi", lambda s, d: rounded(_water(S.scenes(s, d)).select("l_orderkey", "mndwi", "ndvi"), "mndwi", "ndvi"), _WATER_SQL + "SELECT l_orderkey, round(mndwi, 6) AS mndwi, round(ndvi, 6) AS ndvi FROM w")
add("mbsr_awesh", lambda s, d: rounded(_water(S.scenes(s, d)).select("l_orderkey", "mbsr", "awesh"), "mbsr", "awesh"), _WATER_SQL + "SELECT l_orderkey, round(mbsr, 6) AS mbsr, round(awesh, 6) AS awesh FROM w")
add("dswe_tests", lambda s, d: _codes(S.scenes(s, d)).groupBy("code").agg(F.count("*").alias("n")), _WATER_SQL + "SELECT code, count(*) AS n FROM t GROUP BY code")
add("dswe_classify", lambda s, d: _codes(S.scenes(s, d)).select("l_orderkey", "code", raster.water_class(F.col("code")).alias("dswe")), _WATER_SQL + "SELECT l_orderkey, code, dswe FROM c")


def dswe_end_to_end(s: SparkSession, d: str) -> DataFrame:
    """Water classes, clouds cut, as shares of each part's pixels."""
    px = _codes(S.scenes(s, d)).withColumn("value", F.when(~raster.qa_cloud(F.col("qa")), raster.water_class(F.col("code"))))
    rows = px.select((F.col("l_partkey") % 100).alias("chip"), F.lit(None).cast("date").alias("ts"), "value")
    return rounded(chips.perc_total(rows, {0: "nowater", 1: "water", 2: "water", 3: "wetland", 4: "wetland"}, ("nowater", "water", "wetland"), 0.5).drop("ts"), "value")


add(
    "dswe_end_to_end",
    dswe_end_to_end,
    _WATER_SQL
    + """, v AS (SELECT l_partkey % 100 AS chip, CASE WHEN NOT (((qa >> 8) & 3) = 3 OR ((qa >> 14) & 3) = 3) THEN dswe END AS v FROM c),
    g AS (SELECT chip, CAST(count(*) AS DOUBLE) AS n, sum(CASE WHEN v IS NULL THEN 1 ELSE 0 END) AS miss, sum(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS a, sum(CASE WHEN v IN (1, 2) THEN 1 ELSE 0 END) AS b, sum(CASE WHEN v IN (3, 4) THEN 1 ELSE 0 END) AS w FROM v GROUP BY chip)
    SELECT chip, t.band, round(CASE WHEN miss / n < 0.5 THEN CASE t.band WHEN 'nowater' THEN a WHEN 'water' THEN b ELSE w END / n END, 6) AS value FROM g, (VALUES ('nowater'), ('water'), ('wetland')) AS t(band)""",
)

# terrain
_GRAD = """+ g AS (SELECT c.chip, c.y, c.x, c.value, sum(n.value * (n.x - c.x) * (CASE WHEN n.y = c.y THEN 2 ELSE 1 END)) / 8 AS dx, sum(n.value * (n.y - c.y) * (CASE WHEN n.x = c.x THEN 2 ELSE 1 END)) / 8 AS dy
    FROM grid8 c JOIN grid8 n ON c.chip = n.chip AND abs(n.y - c.y) <= 1 AND abs(n.x - c.x) <= 1 GROUP BY c.chip, c.y, c.x, c.value HAVING count(*) = 9),
a AS (SELECT *, degrees(atan(sqrt(dx * dx + dy * dy))) AS slope, degrees(atan2(dy, -dx)) AS r FROM g),
f AS (SELECT *, CASE WHEN dx = 0 AND dy = 0 THEN -1 WHEN r < 0 THEN 90 - r WHEN r > 90 THEN 450 - r ELSE 90 - r END AS aspect FROM a)
"""
_g = lambda s, d: terrain.gradients(S.grid8(s, d))
_asp = lambda t: lambda s, d: _g(s, d).select("chip", "y", "x", F.round(terrain.aspect(F.col("dx"), F.col("dy"), t), 4).alias("aspect"))
add("terrain_slope", lambda s, d: _g(s, d).select("chip", "y", "x", F.round(terrain.slope(F.col("dx"), F.col("dy")), 6).alias("slope")), _GRAD + "SELECT chip, y, x, round(slope, 6) AS slope FROM f")
add("terrain_aspect", _asp(None), _GRAD + "SELECT chip, y, x, round(aspect, 4) AS aspect FROM f")
add("terrain_northness", _asp("cos"), _GRAD + "SELECT chip, y, x, round(CASE WHEN aspect = -1 THEN -1 ELSE cos(radians(aspect)) + 1 END, 4) AS aspect FROM f")
add("terrain_eastness", _asp("sin"), _GRAD + "SELECT chip, y, x, round(CASE WHEN aspect = -1 THEN -1 ELSE sin(radians(aspect)) + 1 END, 4) AS aspect FROM f")
add(
    "terrain_features",
    lambda s, d: rounded(terrain.features(S.grid8(s, d)), "nasadem_elevation_total", "nasadem_slope_total", "nasadem_aspect_total"),
    _GRAD + """SELECT e.chip, round(e.v, 6) AS nasadem_elevation_total, round(avg(f.slope), 6) AS nasadem_slope_total, round(avg(cos(radians(f.aspect)) + 1), 6) AS nasadem_aspect_total
    FROM (SELECT chip, avg(value) AS v FROM grid8 GROUP BY chip) e LEFT JOIN f ON e.chip = f.chip GROUP BY e.chip, e.v""",
)
add("center_crop", lambda s, d: chips.centre_crop(S.grid8(s, d).where("y < 5"), 5, 8).select("chip", "y", "x", "value"), "SELECT chip, y, x, value FROM grid8 WHERE y < 5 AND y BETWEEN 0 AND 4 AND x BETWEEN 1 AND 6")
add("nearest_box", lambda s, d: chips.nearest_box(S.grid8(s, d), (1.2, 0.4, 6.6, 2.0), 1).select("chip", "y", "x", "value"), "SELECT chip, y, x, value FROM grid8 WHERE x BETWEEN 0 AND 7 AND y BETWEEN 0 AND 3")
add(
    "resample_nearest",
    lambda s, d: chips.resample(S.grid8(s, d).withColumns({c: F.col(c) + 0.5 for c in "xy"}), 1.0, 0.5).select("chip", "y", "x", "value"),
    "SELECT chip, 0.25e0 + j * 0.5e0 AS y, 0.25e0 + i * 0.5e0 AS x, value FROM grid8 JOIN (SELECT unnest(range(16)) AS i) ON i // 2 = x JOIN (SELECT unnest(range(16)) AS j) ON j // 2 = y",
)
add("center_subset", lambda s, d: chips.centre_subset(S.grid8(s, d), 8, 8, 0.5), "SELECT chip, y, x, value FROM grid8 WHERE y BETWEEN 2 AND 5 AND x BETWEEN 2 AND 5")

# soil and climate
add(
    "soil_features",
    lambda s, d: rounded(climate.soil_features(chips.nodata_mask(S.pixels(s, d), "N", -9000), "A", ("N", "R")), "soil_N_total", "soil_R_total"),
    """+ m AS (SELECT *, max(CASE WHEN band = 'N' THEN value END) OVER (PARTITION BY chip, ts, y, x) AS t FROM pixels),
    k AS (SELECT * FROM m WHERE t > -9000),
    mode AS (SELECT chip, value FROM (SELECT chip, value, row_number() OVER (PARTITION BY chip ORDER BY n DESC, value) AS r FROM (SELECT chip, value, count(*) AS n FROM k WHERE band = 'A' AND value IS NOT NULL GROUP BY ALL)) WHERE r = 1)
    SELECT k.chip, any_value(mode.value) AS "soil_A_total", round(avg(CASE WHEN band = 'N' THEN k.value END), 6) AS "soil_N_total", round(avg(CASE WHEN band = 'R' THEN k.value END), 6) AS "soil_R_total"
    FROM k LEFT JOIN mode ON k.chip = mode.chip GROUP BY k.chip""",
)
add(
    "unpivot_bands",
    lambda s, d: day(climate.unpivot_bands(S.climate(s, d), ["ts"], ["Ppt", "Tmax"])),
    "SELECT strftime(ts, '%Y-%m-%d') AS ts, 'ppt' AS band, ppt AS value FROM climate UNION ALL SELECT strftime(ts, '%Y-%m-%d'), 'tmax', tmax FROM climate",
)
for _how in ("mean", "sum"):
    add(
        f"annual_weighted_{_how}",
        lambda s, d, how=_how: rounded(climate.annual(climate.unpivot_bands(S.climate(s, d), ["ts"], ["Ppt", "Tmax"]), how, ("band",)), "value"),
        """+ u AS (SELECT ts, 'ppt' AS band, ppt AS value FROM climate UNION ALL SELECT ts, 'tmax', tmax FROM climate),
        w AS (SELECT *, day(last_day(ts)) / CAST(sum(day(last_day(ts))) OVER (PARTITION BY band, year(ts)) AS DOUBLE) AS w FROM u)
        SELECT band, CAST(year(ts) AS INT) AS year, round(coalesce(sum(value * w), 0)"""
        + (" / sum(CASE WHEN value IS NOT NULL THEN w ELSE 0 END)" if _how == "mean" else "")
        + ", 6) AS value FROM w GROUP BY ALL",
    )


def nearest_pixel_join(s: SparkSession, d: str) -> DataFrame:
    axis = s.range(20).select((F.lit(-122.4) + F.col("id") * F.lit(0.03)).alias("cell_lon"))
    found = climate.nearest_pixel(S.obs(s, d), axis, "cell_lon", "lon", "id", 0.03)
    return rounded(found, "cell_lon")


add(
    "nearest_pixel_join",
    nearest_pixel_join,
    """+ axis AS (SELECT -122.4e0 + i * 0.03e0 AS v FROM (SELECT unnest(range(20)) AS i))
    SELECT id, round(v, 6) AS cell_lon FROM (SELECT id, v, row_number() OVER (PARTITION BY id ORDER BY abs(lon - v), v) AS r FROM obs, axis) WHERE r = 1""",
)


def nearest_point_join(s: SparkSession, d: str) -> DataFrame:
    cells = s.range(400).select((F.lit(-122.4) + F.floor(F.col("id") / 20) * F.lit(0.03)).alias("lon"), (F.lit(47.3) + (F.col("id") % 20) * F.lit(0.03)).alias("lat"))
    return rounded(climate.nearest_point(S.obs(s, d), cells, "id", 0.03), "grid_lon", "grid_lat")


add(
    "nearest_point_join",
    nearest_point_join,
    """+ axis AS (SELECT i, -122.4e0 + i * 0.03e0 AS lon, 47.3e0 + i * 0.03e0 AS lat FROM (SELECT unnest(range(20)) AS i)),
    a AS (SELECT obs.id, axis.lon AS v, row_number() OVER (PARTITION BY id ORDER BY abs(obs.lon - axis.lon), axis.lon) AS r FROM obs, axis),
    b AS (SELECT obs.id, axis.lat AS v, row_number() OVER (PARTITION BY id ORDER BY abs(obs.lat - axis.lat), axis.lat) AS r FROM obs, axis)
    SELECT a.id, round(a.v, 6) AS grid_lon, round(b.v, 6) AS grid_lat FROM a JOIN b ON a.id = b.id AND a.r = 1 AND b.r = 1""",
)
add(
    "annual_by_variable",
    lambda s, d: rounded(climate.annual_each(climate.unpivot_bands(S.climate(s, d), ["ts"], ["Ppt", "Tmax"]), {"Ppt": "sum", "Tmax": "mean"}), "value"),
    """+ u AS (SELECT ts, 'ppt' AS band, ppt AS value FROM climate UNION ALL SELECT ts, 'tmax', tmax FROM climate),
    w AS (SELECT *, day(last_day(ts)) / CAST(sum(day(last_day(ts))) OVER (PARTITION BY band, year(ts)) AS DOUBLE) AS w FROM u)
    SELECT band, year, round(CASE WHEN band = 'tmax' THEN s / n ELSE s END, 6) AS value FROM (SELECT band, CAST(year(ts) AS INT) AS year, coalesce(sum(value * w), 0) AS s, sum(CASE WHEN value IS NOT NULL THEN w ELSE 0 END) AS n FROM w GROUP BY ALL)""",
)


def lookback_window(s: SparkSession, d: str) -> DataFrame:
    a, b = climate.lookback(F.col("year"), -10, -1)
    show = lambda c, n: F.date_format(c, "yyyy-MM-dd").alias(n)
    return S.obs(s, d).select("year").distinct().select("year", show(a, "first_day"), show(b, "last_day"))


add("lookback_window", lookback_window, "SELECT DISTINCT year, CAST(year - 10 AS VARCHAR) || '-01-01' AS first_day, CAST(year - 1 AS VARCHAR) || '-12-31' AS last_day FROM obs")

# occurrences
add(
    "scan_filter_project",
    lambda s, d: occurrences.scan(S.obs(s, d), [("year", ">=", 1996), ("status", "in", ("F", "O"))], ["id", "species", "month", "year"], ("BUILDING", "MACHINERY"), required=("species", "month")),
    "SELECT id, species, month, year FROM obs WHERE year >= 1996 AND status IN ('F', 'O') AND class IN ('BUILDING', 'MACHINERY') AND species IS NOT NULL AND month IS NOT NULL",
)
add(
    "quality_rank_map",
    lambda s, d: S.obs(s, d).select("id", occurrences.quality_rank(F.col("basis")).alias("source_quality_rank")),
    "SELECT id, CASE basis WHEN 'PRESERVED_SPECIMEN' THEN 9 WHEN 'MATERIAL_SAMPLE' THEN 7 WHEN 'MACHINE_OBSERVATION' THEN 8 WHEN 'OCCURRENCE' THEN 6 WHEN 'FOSSIL_SPECIMEN' THEN 1 END AS source_quality_rank FROM obs",
)
add("utm_zone", lambda s, d: S.obs(s, d).select("id", geo.utm_zone(F.col("lon")).alias("zone"), geo.utm_epsg(F.col("lon")).cast("int").alias("epsg")), "SELECT id, CAST(floor((lon + 180) / 6) + 1 AS INT) AS zone, CAST(32601 + floor((lon + 180) / 6) AS INT) AS epsg FROM obs")

_K = kruger("GRS80")
_TERMS = [(i, a) for i, a in enumerate(_K["alpha"], 1)]
_UTM_SQL = f"""+ p0 AS (SELECT *, sin(radians(lat)) AS sn, radians(lon + 123.0e0) AS dl FROM obs),
p1 AS (SELECT *, sinh(atanh(sn) - {_K["e"]:.17e} * atanh({_K["e"]:.17e} * sn)) AS t FROM p0),
p2 AS (SELECT *, atan2(t, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + t * t)) AS eta FROM p1),
utm AS (SELECT *, {SCALE * _K["A"]:.17e} * (eta + {" + ".join(f"{a:.17e} * cos(2 * {i} * xi) * sinh(2 * {i} * eta)" for i, a in _TERMS)}) + 500000.0e0 AS px,
               {SCALE * _K["A"]:.17e} * (xi + {" + ".join(f"{a:.17e} * sin(2 * {i} * xi) * cosh(2 * {i} * eta)" for i, a in _TERMS)}) AS py FROM p2)
"""


def in_utm(points: DataFrame) -> DataFrame:
    x, y = geo.utm(F.col("lon"), F.col("lat"), 10)
    return points.withColumns({"x": x, "y": y})


def projected(s: SparkSession, d: str) -> DataFrame:
    return in_utm(S.obs(s, d))


add("utm_project", lambda s, d: rounded(projected(s, d).select("id", "x", "y"), "x", "y", digits=3), _UTM_SQL + "SELECT id, round(px, 3) AS x, round(py, 3) AS y FROM utm")
add(
    "chip_bbox_utm",
    lambda s, d: projected(s, d).select("id", *[F.round(F.col(c) + o, 3).alias(n) for c, o, n in (("x", -100, "minx"), ("y", -100, "miny"), ("x", 100, "maxx"), ("y", 100, "maxy"))]),
    _UTM_SQL + "SELECT id, round(px - 100, 3) AS minx, round(py - 100, 3) AS miny, round(px + 100, 3) AS maxx, round(py + 100, 3) AS maxy FROM utm",
)
def _back_sql(x: str, y: str, zone: int, ellipsoid: str) -> tuple[str, str]:
    """Longitude and latitude of an easting and northing, as DuckDB expressions over a row of them."""
    k = kruger(ellipsoid)
    eta0, xi0 = f"(({x} - 500000.0e0) / {SCALE * k['A']:.17e})", f"(({y}) / {SCALE * k['A']:.17e})"
    terms = list(enumerate(k["beta"], 1))
    eta = f"({eta0} - " + " - ".join(f"{b:.17e} * cos(2 * {i} * {xi0}) * sinh(2 * {i} * {eta0})" for i, b in terms) + ")"
    xi = f"({xi0} - " + " - ".join(f"{b:.17e} * sin(2 * {i} * {xi0}) * cosh(2 * {i} * {eta0})" for i, b in terms) + ")"
    chi = f"asin(sin({xi}) / cosh({eta}))"
    lat = f"degrees({chi} + " + " + ".join(f"{c:.17e} * sin(2 * {i} * {chi})" for i, c in enumerate(k["delta"], 1)) + ")"
    return f"({zone * 6 - 183}e0 + degrees(atan2(sinh({eta}), cos({xi}))))", lat


def chip_bbox_wgs84(s: SparkSession, d: str) -> DataFrame:
    left, bottom = geo.lonlat(F.col("x") - 100, F.col("y") - 100, 10)
    right, top = geo.lonlat(F.col("x") + 100, F.col("y") + 100, 10)
    return projected(s, d).select("id", *[F.round(c, 7).alias(n) for c, n in ((left, "minx"), (bottom, "miny"), (right, "maxx"), (top, "maxy"))])


_LOW, _HIGH = _back_sql("(px - 100)", "(py - 100)", 10, "GRS80"), _back_sql("(px + 100)", "(py + 100)", 10, "GRS80")
add("chip_bbox_wgs84", chip_bbox_wgs84, _UTM_SQL + f"SELECT id, round({_LOW[0]}, 7) AS minx, round({_LOW[1]}, 7) AS miny, round({_HIGH[0]}, 7) AS maxx, round({_HIGH[1]}, 7) AS maxy FROM utm")
add("points_bbox", lambda s, d: S.obs(s, d).groupBy("species").agg(F.min("lon").alias("minx"), F.min("lat").alias("miny"), F.max("lon").alias("maxx"), F.max("lat").alias("maxy")), "SELECT species, min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy FROM obs GROUP BY species")
add(
    "spatial_join_filter",
    lambda s, d: occurrences.spatial_join(S.obs(s, d), S.regions(s, d), "key", ("ALGERIA", "BRAZIL", "CANADA", "EGYPT", "FRANCE", "NATION_1", "NATION_3", "NATION_6")).select("id", "key"),
    "SELECT id, key FROM obs JOIN regions ON lon BETWEEN minx AND maxx AND lat BETWEEN miny AND maxy WHERE key IN ('ALGERIA', 'BRAZIL', 'CANADA', 'EGYPT', 'FRANCE', 'NATION_1', 'NATION_3', 'NATION_6')",
)
_RANK_SQL = "CASE basis WHEN 'PRESERVED_SPECIMEN' THEN 9 WHEN 'MATERIAL_SAMPLE' THEN 7 WHEN 'MACHINE_OBSERVATION' THEN 8 WHEN 'OCCURRENCE' THEN 6 WHEN 'FOSSIL_SPECIMEN' THEN 1 END"
add(
    "subsample_dedup",
    lambda s, d: occurrences.subsample(projected(s, d).withColumn("source_quality_rank", occurrences.quality_rank(F.col("basis"))), 5000.0).select("species", "year", "month", "xr", "yr", "id", "source_quality_rank"),
    _UTM_SQL
    + f""", q AS (SELECT *, round_even(px / 5000, 0) * 5000 AS xr, round_even(py / 5000, 0) * 5000 AS yr, {_RANK_SQL} AS source_quality_rank FROM utm)
    SELECT species, year, month, xr, yr, id, source_quality_rank FROM (SELECT *, row_number() OVER (PARTITION BY species, year, month, xr, yr ORDER BY source_quality_rank DESC, id) AS r FROM q) WHERE r = 1""",
)

# clustering
_STEPS = []
for _t in range(1, 5):
    _STEPS.append(f"d{_t} AS (SELECT *, CASE WHEN fu{_t - 1} > 0.5 THEN 1 ELSE 0 END AS a{_t}, CASE WHEN fv{_t - 1} > 0.5 THEN 1 ELSE 0 END AS b{_t}, 2 * fu{_t - 1} - CASE WHEN fu{_t - 1} > 0.5 THEN 1 ELSE 0 END AS fu{_t}, 2 * fv{_t - 1} - CASE WHEN fv{_t - 1} > 0.5 THEN 1 ELSE 0 END AS fv{_t}, p{_t - 1} || '__' || CASE WHEN fu{_t - 1} > 0.5 THEN 1 ELSE 0 END || CASE WHEN fv{_t - 1} > 0.5 THEN 1 ELSE 0 END AS p{_t} FROM d{_t - 1})")
_GRID_SQL = (
    """+ o AS (SELECT min(lon) - 1e-4 AS lon0, min(lat) - 1e-4 AS lat0 FROM obs), u AS (SELECT id, (lon - lon0) / 0.1e0 AS u, (lat - lat0) / 0.1e0 AS v FROM obs, o),
d0 AS (SELECT id, u - (ceil(u) - 1) AS fu0, v - (ceil(v) - 1) AS fv0, CAST(CAST(ceil(u) - 1 AS BIGINT) AS VARCHAR) || '_' || CAST(CAST(ceil(v) - 1 AS BIGINT) AS VARCHAR) AS p0 FROM u), """
    + ", ".join(_STEPS)
    + ", "
    + ", ".join(f"c{t} AS (SELECT p{t}, count(*) AS n{t} FROM d4 GROUP BY p{t})" for t in range(5))
    + ", m AS (SELECT "
    + ", ".join(f"(SELECT avg(n{t}) FROM c{t} WHERE n{t} > 50) AS m{t}" for t in range(5))
    + """), cap AS (SELECT CASE WHEN m2 >= m1 THEN 2 WHEN m3 >= m2 THEN 3 WHEN m4 >= m3 THEN 4 ELSE 4 END AS cap FROM m),
grid AS (SELECT d4.id, CASE WHEN n0 <= 50 OR cap = 0 THEN d4.p0 WHEN n1 <= 50 OR cap = 1 THEN d4.p1 WHEN n2 <= 50 OR cap = 2 THEN d4.p2 WHEN n3 <= 50 OR cap = 3 THEN d4.p3 ELSE d4.p4 END AS cell
  FROM d4 JOIN c0 ON d4.p0 = c0.p0 JOIN c1 ON d4.p1 = c1.p1 JOIN c2 ON d4.p2 = c2.p2 JOIN c3 ON d4.p3 = c3.p3 JOIN c4 ON d4.p4 = c4.p4, cap)
"""
)
_cells = lambda s, d: grid.adaptive(S.obs(s, d).select("id", "lon", "lat"), 0.1, 1e-4, 50)
add("adaptive_grid_counts", lambda s, d: _cells(s, d).groupBy("cell").agg(F.count("*").alias("n")), _GRID_SQL + "SELECT cell, count(*) AS n FROM grid GROUP BY cell")
add("adaptive_grid_assign", lambda s, d: _cells(s, d).select("id", "cell"), _GRID_SQL + "SELECT id, cell FROM grid")


def assign_grid_cluster(s: SparkSession, d: str) -> DataFrame:
    """Points to the cells of a table of clusters, by arithmetic keys."""
    o = S.obs(s, d)
    key = lambda c, lo: grid.cell_key(F.col(c), F.lit(lo), 0.05)
    cells = s.range(64).select((F.col("id") % 8).alias("i"), F.floor(F.col("id") / 8).alias("j"), F.concat(F.lit("c"), F.col("id").cast("string")).alias("cluster"))
    return o.withColumns({"i": key("lon", -122.301), "j": key("lat", 47.399)}).join(cells, ["i", "j"]).select("id", "cluster")


add(
    "assign_grid_cluster",
    assign_grid_cluster,
    """+ cells AS (SELECT 'c' || i AS cluster, -122.301e0 + (i % 8) * 0.05e0 AS x0, 47.399e0 + (i // 8) * 0.05e0 AS y0 FROM (SELECT unnest(range(64)) AS i))
    SELECT id, cluster FROM obs JOIN cells ON lon > x0 AND lon <= x0 + 0.05e0 AND lat > y0 AND lat <= y0 + 0.05e0""",
)
add("distinct_cluster_year", lambda s, d: S.obs(s, d).select("class", "year").distinct().orderBy("class", "year"), "SELECT DISTINCT class, year FROM obs ORDER BY class, year")


def chip_range_join(s: SparkSession, d: str) -> DataFrame:
    at = stored(projected(s, d).select("id", "x", "y"))
    return chips.range_totals(at.toDF("point", "px", "py"), at.toDF("pixel", "x", "y"), 1500.0)


add(
    "chip_range_join",
    chip_range_join,
    _UTM_SQL + "SELECT a.id AS point, count(*) AS n, CAST(sum(b.id) AS BIGINT) AS total FROM utm a JOIN utm b ON b.px BETWEEN a.px - 1500 AND a.px + 1500 AND b.py BETWEEN a.py - 1500 AND a.py + 1500 GROUP BY a.id",
)
add(
    "resume_antijoin",
    lambda s, d: grid.resume(S.obs(s, d).select("class", "year").distinct(), S.obs(s, d).where("year < 1997 AND class <> 'BUILDING'").select("class", "year").distinct(), ["class", "year"]),
    "SELECT DISTINCT class, year FROM obs EXCEPT SELECT class, year FROM obs WHERE year < 1997 AND class <> 'BUILDING'",
)

# candidate species
_OBS_SQL = "+ sp AS (SELECT species, count(*) AS obs FROM obs GROUP BY species HAVING count(*) >= 10)"
_QCUT = "CASE WHEN {v} <= e[2] THEN 0 WHEN {v} <= e[3] THEN 1 WHEN {v} <= e[4] THEN 2 WHEN {v} <= e[5] THEN 3 END"
_EDGES = "(SELECT quantile_cont(CAST({v} AS DOUBLE), [0.0, 0.25, 0.5, 0.75, 1.0]) AS e FROM {t})"
_DIST_SQL = (
    _UTM_SQL
    + f""", sample AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY species ORDER BY md5(CAST(id AS VARCHAR)), id) AS r, count(*) OVER (PARTITION BY species) AS n FROM utm) WHERE r <= round_even(n * 0.2e0, 0)),
dist AS (SELECT a.species, a.id, avg(sqrt(power(a.px - b.px, 2) + power(a.py - b.py, 2))) AS dist FROM sample a JOIN sample b ON a.species = b.species GROUP BY a.species, a.id),
sp AS (SELECT species, count(*) AS obs FROM obs GROUP BY species HAVING count(*) >= 10),
md AS (SELECT sp.species, any_value(obs) AS obs, round(avg(dist), 3) AS mean_distance FROM sp JOIN dist ON sp.species = dist.species GROUP BY sp.species),
q AS (SELECT md.*, CAST({_QCUT.format(v="obs").replace("e[", "eo[")} AS INT) AS quantilerank, CAST({_QCUT.format(v="mean_distance").replace("e[", "ed[")} AS INT) AS quantilerank_dist
  FROM md, (SELECT quantile_cont(CAST(obs AS DOUBLE), [0.0, 0.25, 0.5, 0.75, 1.0]) AS eo, quantile_cont(mean_distance, [0.0, 0.25, 0.5, 0.75, 1.0]) AS ed FROM md)),
cand AS (SELECT species, obs, quantilerank, quantilerank_dist, dense_rank() OVER (ORDER BY first) - 1 AS candidate FROM (SELECT *, min(species) OVER (PARTITION BY quantilerank, quantilerank_dist) AS first FROM q))
"""
)


def seen(s: SparkSession, d: str, *more: str) -> DataFrame:
    """Observations joined with their customers once, for readers that count, sample and draw from them."""
    return stored(S.obs(s, d).select("id", "species", "lat", "lon", *more))


def sampled(obs: DataFrame) -> DataFrame:
    return in_utm(occurrences.sample_fraction(obs.select("id", "species", "lon", "lat"), 0.2, ["species"])).select("id", "species", "x", "y")


def sampled_distances(s: SparkSession, d: str) -> DataFrame:
    return occurrences.mean_distance(stored(sampled(seen(s, d))))


def candidate_table(s: SparkSession, d: str, obs: DataFrame | None = None) -> DataFrame:
    obs = seen(s, d) if obs is None else obs
    mean = occurrences.group_distance(sampled(obs), "mean_distance").withColumn("mean_distance", F.round("mean_distance", 3))
    species = small(occurrences.min_obs(obs, 10).join(mean, "species"))
    both = occurrences.qcut(occurrences.qcut(species, "obs", "quantilerank"), "mean_distance", "quantilerank_dist")
    return small(occurrences.group_numbers(both, ["quantilerank", "quantilerank_dist"], "species", "candidate"))  # a row for each species, read several times


add("min_obs_having", lambda s, d: occurrences.min_obs(S.obs(s, d), 10), _OBS_SQL + " SELECT species, obs FROM sp")
add("qcut_obs", lambda s, d: occurrences.qcut(occurrences.min_obs(S.obs(s, d), 10), "obs", "quantilerank"), _OBS_SQL + f" SELECT species, obs, CAST({_QCUT.format(v='obs')} AS INT) AS quantilerank FROM sp, {_EDGES.format(v='obs', t='sp')}")
add("pairwise_mean_distance", lambda s, d: rounded(sampled_distances(s, d), "mean_euclidean_dist", digits=2), _DIST_SQL + "SELECT species, id, round(dist, 2) AS mean_euclidean_dist FROM dist")
# for every point; SQL would compare all pairs, so a test has brute force instead
add("pairwise_mean_distance_all", lambda s, d: rounded(occurrences.mean_distance(stored(projected(s, d).select("id", "species", "x", "y"))), "mean_euclidean_dist", digits=2))
add("qcut_distance", lambda s, d: candidate_table(s, d).select("species", "mean_distance", "quantilerank_dist"), _DIST_SQL + "SELECT species, mean_distance, quantilerank_dist FROM q")
add("candidate_ngroup", lambda s, d: candidate_table(s, d).select("species", "candidate"), _DIST_SQL + "SELECT species, candidate FROM cand")
add("semi_species", lambda s, d: occurrences.semi_species(S.obs(s, d), occurrences.min_obs(S.obs(s, d), 26)).select("id", "species"), "SELECT id, species FROM obs WHERE species IN (SELECT species FROM obs GROUP BY species HAVING count(*) >= 26)")
add(
    "hash_sample_frac",
    lambda s, d: occurrences.sample_fraction(S.obs(s, d), 0.3, ["species"]).select("id", "species"),
    "SELECT id, species FROM (SELECT *, row_number() OVER (PARTITION BY species ORDER BY md5(CAST(id AS VARCHAR)), id) AS r, count(*) OVER (PARTITION BY species) AS n FROM obs) WHERE r <= round_even(n * 0.3e0, 0)",
)
_candidates = lambda s, d: occurrences.sample_per_group(candidate_table(s, d), 1, ["candidate"], "species")
_CAND_SQL = _DIST_SQL + ", pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY candidate ORDER BY md5(species), species) AS r FROM cand) WHERE r = 1)"
add("sample_per_group", lambda s, d: _candidates(s, d).select("candidate", "species", "obs"), _CAND_SQL + " SELECT candidate, species, obs FROM pick")
_OUT = ("id", "species", "year", "month", "status", "lat", "lon")


def _absences(s: SparkSession, d: str, table: DataFrame | None = None) -> DataFrame:
    obs = seen(s, d, "year", "month")
    table = candidate_table(s, d, obs) if table is None else table
    return occurrences.pseudo_absences(obs, table, occurrences.sample_per_group(table, 1, ["candidate"], "species"), short="keep").select(*_OUT)


_ABS_SQL = (
    _CAND_SQL
    + """, pool AS (SELECT o.*, p.species AS target, p.obs, row_number() OVER (PARTITION BY p.species ORDER BY md5(CAST(o.id AS VARCHAR)), o.id) AS k
  FROM pick p JOIN cand c ON c.candidate = p.candidate AND c.species <> p.species JOIN obs o ON o.species = c.species),
absent AS (SELECT id, target AS species, year, month, 'ABSENT' AS status, lat, lon FROM pool WHERE k <= obs)
"""
)
def _presence_absence(s: SparkSession, d: str) -> DataFrame:
    table = candidate_table(s, d)
    picked = occurrences.sample_per_group(table, 1, ["candidate"], "species")
    return occurrences.presence_absence(occurrences.semi_species(S.obs(s, d), picked).select(*_OUT), _absences(s, d, table))


add("pseudo_absence", _absences, _ABS_SQL + "SELECT * FROM absent")
add(
    "union_presence_absence",
    _presence_absence,
    _ABS_SQL + "SELECT id, species, year, month, status, lat, lon FROM obs WHERE species IN (SELECT species FROM pick) UNION ALL SELECT * FROM absent",
)

# the gold table
_tables = lambda s, d: [gold.keep_last(S.feat_a(s, d), "gbifid", "seq").drop("seq"), S.feat_b(s, d), S.feat_c(s, d).drop("zone")]
_GOLD_SQL = "+ a AS (SELECT gbifid, price, zone FROM feat_a WHERE seq = 1), gold AS (SELECT a.gbifid, a.price, a.zone, b.quantity, b.discount, c.year, c.occurrencestatus FROM a JOIN feat_b b ON a.gbifid = b.gbifid JOIN feat_c c ON a.gbifid = c.gbifid)"
add("dedup_keep_last", lambda s, d: gold.keep_last(S.feat_a(s, d), "gbifid", "seq"), "SELECT gbifid, price, zone, seq FROM feat_a WHERE seq = 1")
add("intersect_ids", lambda s, d: gold.common_ids([S.feat_a(s, d), S.feat_b(s, d), S.feat_c(s, d)], "gbifid"), "SELECT gbifid FROM feat_a INTERSECT SELECT gbifid FROM feat_b INTERSECT SELECT gbifid FROM feat_c")
add("gold_inner_join", lambda s, d: gold.gold(_tables(s, d), nans="keep"), _GOLD_SQL + " SELECT * FROM gold")
add("gold_drop_nan", lambda s, d: gold.gold(_tables(s, d), nans="drop"), _GOLD_SQL + " SELECT * FROM gold WHERE price IS NOT NULL AND discount IS NOT NULL")
add("gold_fill_const", lambda s, d: gold.gold(_tables(s, d), nans="fill", fill_value=-1.0), _GOLD_SQL + " SELECT gbifid, coalesce(price, -1) AS price, zone, quantity, coalesce(discount, -1) AS discount, year, occurrencestatus FROM gold")
for _how, _fn in (("mean", "avg"), ("median", "median")):
    add(
        f"fill_{_how}",
        lambda s, d, how=_how: rounded(gold.gold(_tables(s, d), nans="fill", fill_value=how), "price", "discount"),
        _GOLD_SQL + f" SELECT gbifid, round(coalesce(price, mp), 6) AS price, zone, quantity, round(coalesce(discount, md), 6) AS discount, year, occurrencestatus FROM gold, (SELECT {_fn}(price) AS mp, {_fn}(discount) AS md FROM gold)",
    )
add("gold_rename", lambda s, d: gold.gold(_tables(s, d), nans="keep", renames={"price": "total_price", "zone": "climate_zone"}), _GOLD_SQL + " SELECT gbifid, price AS total_price, zone AS climate_zone, quantity, discount, year, occurrencestatus FROM gold")

# datasets, splits, metrics
_left = lambda s, d: gold.keep_last(S.feat_a(s, d), "gbifid", "seq").drop("seq").withColumn("gbifid", F.col("gbifid") + F.lit(0.25))
_PREP_SQL = "+ prep AS (SELECT a.gbifid, a.price, a.zone AS zone_all, c.year, c.occurrencestatus, c.zone AS zone_species FROM feat_a a JOIN feat_c c ON a.gbifid = c.gbifid WHERE seq = 1)"
add("prep_inner_join", lambda s, d: ml.suffixed_join(_left(s, d), S.feat_c(s, d), "gbifid"), _PREP_SQL + " SELECT * FROM prep")
add("prepare_dataset_features", lambda s, d: ml.prepare(_left(s, d), S.feat_c(s, d), "gbifid", "occurrencestatus", ["price"])[0], _PREP_SQL + " SELECT gbifid, zone_all, year, zone_species FROM prep WHERE price IS NOT NULL")
add("prepare_dataset_targets", lambda s, d: ml.prepare(_left(s, d), S.feat_c(s, d), "gbifid", "occurrencestatus", ["price"])[1], _PREP_SQL + " SELECT gbifid, CASE occurrencestatus WHEN 'PRESENT' THEN 1 ELSE 0 END AS occurrencestatus FROM prep WHERE price IS NOT NULL")
add("target_encode", lambda s, d: S.feat_c(s, d).select("gbifid", ml.encode_target(F.col("occurrencestatus")).alias("target")), "SELECT gbifid, CASE occurrencestatus WHEN 'PRESENT' THEN 1 ELSE 0 END AS target FROM feat_c")
_HASHED = "+ h AS (SELECT id, row_number() OVER (ORDER BY md5(CAST(id AS VARCHAR)), id) - 1 AS i, count(*) OVER () AS n FROM obs)"
add("split_train_test", lambda s, d: ml.split(S.obs(s, d).select("id"), 0.9), _HASHED + " SELECT id, CASE WHEN i < floor(0.9e0 * n) THEN 'train' ELSE 'test' END AS part FROM h")
add(
    "split_train_val_test",
    lambda s, d: ml.split(S.obs(s, d).select("id"), 0.9, 0.05),
    _HASHED + f" SELECT id, CASE WHEN i < floor(0.9e0 * n) THEN 'train' WHEN i < floor(0.9e0 * n) + floor({0.05 / (1 - 0.9):.17e} * (n - floor(0.9e0 * n))) THEN 'validation' ELSE 'test' END AS part FROM h",
)
add(
    "confusion_matrix",
    lambda s, d: ml.confusion_matrix(S.preds(s, d), "truth", "pred"),
    "SELECT t.truth, p.predicted, (SELECT count(*) FROM preds x WHERE x.truth = t.truth AND x.pred = p.predicted) AS n FROM (VALUES (0), (1)) AS t(truth), (VALUES (0), (1)) AS p(predicted)",
)
_REPORT = """+ k AS (SELECT label, (SELECT count(*) FROM preds WHERE truth = label AND pred = label) AS tp, (SELECT count(*) FROM preds WHERE pred = label) AS pp, (SELECT count(*) FROM preds WHERE truth = label) AS s FROM (VALUES (0), (1)) AS v(label)),
r AS (SELECT label, coalesce(tp / CAST(nullif(pp, 0) AS DOUBLE), 0) AS p, coalesce(tp / CAST(nullif(s, 0) AS DOUBLE), 0) AS r, s FROM k),
f AS (SELECT *, coalesce(2 * p * r / nullif(p + r, 0), 0) AS f FROM r)
SELECT CAST(label AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support FROM f
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(s) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(p * s) / sum(s), 6), round(sum(r * s) / sum(s), 6), round(sum(f * s) / sum(s), 6), CAST(sum(s) AS BIGINT) FROM f"""
add("classification_report", lambda s, d: rounded(ml.classification_report(S.preds(s, d), "truth", "pred"), "precision", "recall", "f1"), _REPORT)
add(
    "roc_auc_hard",
    lambda s, d: rounded(ml.hard_auc(S.preds(s, d), "truth", "pred"), "roc_auc", "accuracy"),
    "SELECT round((avg(CASE WHEN truth = 1 THEN CAST(pred = 1 AS INT) END) + avg(CASE WHEN truth = 0 THEN CAST(pred = 0 AS INT) END)) / 2, 6) AS roc_auc, round(avg(CAST(truth = pred AS INT)), 6) AS accuracy FROM preds",
)

# inference
_BOX = (500000.0, 5300000.0, 503000.0, 5302000.0)
_grid = lambda s: segments.segment_grid(s, _BOX, 60.0, 60.0, 2013, 2016)
_SEG = """+ seg AS (SELECT 499970.0e0 + i * 60.0e0 AS x, 5299970.0e0 + j * 60.0e0 AS y, CAST(t AS VARCHAR) || '-12-31' AS time
  FROM (SELECT unnest(range(60)) AS i), (SELECT unnest(range(60)) AS j), (SELECT unnest(range(2013, 2017)) AS t) WHERE 499970.0e0 + i * 60.0e0 < 503030 AND 5299970.0e0 + j * 60.0e0 < 5302030),
ids AS (SELECT *, 'CPT' || lpad(CAST(row_number() OVER (ORDER BY x, y, time) - 1 AS VARCHAR), CAST(length(CAST(count(*) OVER () AS VARCHAR)) + 1 AS INT), '0') AS id FROM seg)
"""
add("segment_grid", lambda s, d: _grid(s), _SEG + "SELECT x, y, time FROM seg")
add("segment_ids", lambda s, d: segments.segment_ids(_grid(s)), _SEG + "SELECT x, y, time, id FROM ids")
_LON, _LAT = _back_sql("x", "y", 10, "WGS84")
add(
    "segment_coords",
    lambda s, d: rounded(segments.segment_grid(s, _BOX, 60.0, 60.0, 2013, 2016, zone=10), "decimallatitude", "decimallongitude", digits=8),
    _SEG + f"SELECT x, y, time, round({_LAT}, 8) AS decimallatitude, round({_LON}, 8) AS decimallongitude FROM seg",
)
add(
    "segment_months",
    lambda s, d: segments.segment_grid(s, (0.0, 0.0, 300.0, 300.0), 100.0, 100.0, date(2019, 11, 30), date(2020, 6, 30), stride="m"),
    """SELECT i * 100.0e0 - 50.0e0 AS x, j * 100.0e0 - 50.0e0 AS y, strftime(last_day(DATE '2019-11-01' + to_months(CAST(t AS INT))), '%Y-%m-%d') AS time
    FROM (SELECT unnest(range(4)) AS i), (SELECT unnest(range(4)) AS j), (SELECT unnest(range(8)) AS t)""",
)
add("derive_year_month", lambda s, d: segments.year_month(_grid(s)), _SEG + "SELECT x, y, time, CAST(split_part(time, '-', 1) AS INT) AS year, CAST(split_part(time, '-', 2) AS INT) AS month FROM seg")
_goldrows = lambda s, d: S.feat_b(s, d).select(F.concat(F.lit("CPT"), F.lpad(F.col("gbifid").cast("string"), 5, F.lit("0"))).alias("gbifid"), "quantity")
add(
    "merge_segments",
    lambda s, d: segments.merge_segments(segments.segment_ids(_grid(s)), _goldrows(s, d), drop=("gbifid", "x", "y")),
    _SEG + "SELECT ids.time, ids.id, b.quantity FROM ids LEFT JOIN (SELECT 'CPT' || CASE WHEN length(CAST(gbifid AS VARCHAR)) >= 5 THEN substr(CAST(gbifid AS VARCHAR), 1, 5) ELSE lpad(CAST(gbifid AS VARCHAR), 5, '0') END AS g, quantity FROM feat_b) b ON ids.id = b.g WHERE split_part(time, '-', 1) <> '2013'",
)


def assemble_predictions(s: SparkSession, d: str) -> DataFrame:
    o = S.obs(s, d)
    p = o.where("species IN ('sp1', 'sp2', 'sp3')").select("id", "species", (F.col("id") % 100 / 100).alias("PRESENT"))
    return ml.assemble(o.select("id", "year"), p, "id", ("sp1", "sp2", "sp3"))


add("assemble_predictions", assemble_predictions, "SELECT id, year, " + ", ".join(f"CASE WHEN species = 'sp{k}' THEN (id % 100) / 100.0e0 END AS sp{k}" for k in (1, 2, 3)) + " FROM obs")

# strings and names
add("string_normalize", lambda s, d: S.read(s, d, "part").select("p_partkey", text.normalise(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" "))).alias("name")), "SELECT p_partkey, replace(lower(trim('  ' || upper(p_name) || ' ')), ' ', '_') AS name FROM part")
add("slugify", lambda s, d: S.read(s, d, "part").select("p_partkey", text.slug(F.concat_ws(" ", "p_name", "p_brand", "p_type"), 31).alias("slug")), "SELECT p_partkey, substr(lower(replace(p_name || ' ' || p_brand || ' ' || p_type, ' ', '_')), 1, 31) AS slug FROM part")
add("json_params", lambda s, d: S.read(s, d, "events").select("event_id", F.from_json("props", "k INT")["k"].alias("k")), "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS k FROM events")
add("sanitize_columns", lambda s, d: text.sanitise_columns(S.read(s, d, "part").select(F.col("p_partkey").alias("p-part key"), F.col("p_size").alias("p.size(%)"))), "SELECT p_partkey AS ppartkey, p_size AS psize FROM part")


# models: their numbers have no SQL
def _dataset(s: SparkSession, d: str) -> DataFrame:
    return gold.gold(_tables(s, d), nans="drop").withColumn("target", ml.encode_target(F.col("occurrencestatus")))


_INPUTS = ("price", "zone", "quantity", "discount", "year")


def train_gbt_metrics(s: SparkSession, d: str) -> DataFrame:
    parts = ml.split(_dataset(s, d), 0.9, key="gbifid")
    model = ml.train(parts.where("part = 'train'"), _INPUTS, "target", trees=5, depth=3)
    return ml.classification_report(model.transform(parts.where("part = 'test'")), "target", "prediction")


def batch_score_proba(s: SparkSession, d: str) -> DataFrame:
    rows = _dataset(s, d)
    return ml.score(rows, ml.train(rows, _INPUTS, "target", trees=5, depth=3), ["gbifid"])


add("train_gbt_metrics", train_gbt_metrics)
add("batch_score_proba", batch_score_proba)

# the six feature families; their steps have SQL above, and a test holds them against numpy
for _kind in families.FAMILIES:
    add(f"family_{_kind}", lambda s, d, k=_kind: families.rows(S.family_pixels(s, d, k), families.family(k)))
