import json
import math
from datetime import date
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from habitra.functions import geo, nulls, raster, text
from habitra.functions.aggs import AGGREGATES, aggregate
from habitra.operators import chips, climate, gold, grid, ml, occurrences, segments, terrain
from habitra.plans import families
from habitra.sources import tables, vector
from habitra.streaming import incremental


def chip(spark, arrays, dates, bands=("b",)):
    """Long pixels of arrays (time, band, y, x)."""
    rows = [(0, dates[t], bands[b], y, x, None if math.isnan(v) else float(v)) for t, a in enumerate(arrays) for b, c in enumerate(a) for y, r in enumerate(c) for x, v in enumerate(r)]
    return spark.createDataFrame(rows, "chip int, ts date, band string, y int, x int, value double")


N = math.nan
SCENE = [[0, 0, 1, 1], [0, 0, 2, 2], [0, 1, 2, 2], [0, 2, 2, 2]]


@pytest.mark.parametrize(
    ("second", "threshold", "want"),
    [
        ([[0, 0, 0, 0], [0, 0, 0, 0], [2, 2, 2, 2], [2, 2, 2, 2]], 0.05, [[0.5625, 0.4375], [0.5, 0.5]]),
        ([[N, N, 0, 0], [0, 0, 0, 0], [0, 2, 2, 2], [2, 2, 2, 2]], 1, [[0.5625, 0.4375], [0.4375, 0.4375]]),
        ([[N] * 4] * 4, 1, [[0.5625, 0.4375], [None, None]]),
        ([[N, N, 0, 0], [0, 0, 0, 0], [0, 2, 2, 2], [2, 2, 2, 2]], 0.1, [[0.5625, 0.4375], [None, None]]),
    ],
)
def test_shares_of_categories(spark, second, threshold, want):
    first = np.array(SCENE)
    first = np.where(np.arange(16).reshape(4, 4) < 9, first % 2, 2)
    px = chip(spark, [[first], [second]], [date(2020, 1, 1), date(2020, 2, 1)])
    rows = chips.perc_total(px, {0: "p0", 1: "p0", 2: "p1"}, ("p0", "p1"), threshold).collect()
    got = {(r.ts.month, r.band): r.value for r in rows}
    assert [[got[m, "p0"], got[m, "p1"]] for m in (1, 2)] == want


@pytest.mark.parametrize("how", list(AGGREGATES))
@pytest.mark.parametrize("kind", ["total", "seasonal", "monthly"])
def test_two_stages_against_numpy(spark, how, kind):
    g = np.random.default_rng(5)
    dates = [date(2020, m, d) for m in range(1, 9) for d in (1, 15)]
    data = np.round(g.normal(size=(16, 2, 5, 4)), 1)
    data[g.random(data.shape) < 0.1] = np.nan
    with np.errstate(all="ignore"):
        flat = data.reshape(16, 2, -1)
        one = {
            "mean": lambda a: np.nanmean(a, -1), "median": lambda a: np.nanmedian(a, -1), "std": lambda a: np.nanstd(a, -1), "sum": lambda a: np.nansum(a, -1), "min": lambda a: np.nanmin(a, -1), "max": lambda a: np.nanmax(a, -1),
            "iqr": lambda a: np.nanpercentile(a, 75, -1) - np.nanpercentile(a, 25, -1),
            "mode": lambda a: np.apply_along_axis(lambda v: min(zip(*np.unique(v[~np.isnan(v)], return_counts=True)), key=lambda p: (-p[1], p[0]))[0], -1, a),
        }[how]
        space = one(flat)
    member = {"total": lambda d, n: True, "seasonal": lambda d, n: (d.month - 1) // 3 == chips.SEASONS.index(n), "monthly": lambda d, n: n == f"m_{d.month}"}[kind]
    row = chips.features(chip(spark, data, dates, ("b0", "b1")), "f", how, "mean", kind, ("b0", "b1")).first()
    for b in (0, 1):
        for n in chips.slice_names(kind):
            at = [i for i, d in enumerate(dates) if member(d, n)]
            value = row[f"f_b{b}_{n}"]
            assert (value is None) if not at else value == pytest.approx(space[at, b].mean(), abs=1e-9)


def test_aggregates_of_nothing(spark):
    none = spark.createDataFrame([(None,)], "v double")
    got = none.agg(*[aggregate(h, F.col("v")).alias(h) for h in AGGREGATES]).first()
    assert got["sum"] == 0.0 and all(got[h] is None for h in AGGREGATES if h != "sum")
    with pytest.raises(ValueError, match="unknown aggregate"):
        aggregate("variance", F.col("v"))
    with pytest.raises(ValueError, match="unknown slicing"):
        chips.slice_names("weekly")


def test_nan_and_division(spark):
    df = nulls.nan_to_null(spark.createDataFrame([(float("nan"), 1), (3.0, 2)], "a double, b int"))
    assert [r.a for r in df.collect()] == [None, 3.0]
    row = spark.range(1).select(nulls.safe_div(F.lit(1.0), F.lit(0.0)).alias("d"), nulls.half_even(F.lit(150.0), 60).alias("h"), nulls.half_even(F.lit(90.0), 60).alias("g")).first()
    assert tuple(row) == (None, 120.0, 120.0)


@settings(max_examples=25, deadline=None)
@given(st.integers(1, 30), st.integers(1, 30), st.integers(1, 30))
def test_formulas_against_python(spark, a, b, c):
    cases = {"([a]-[b]) / ([a]+[b])": (a - b) / (a + b), "([a]-[b]+[c])*[b]**2": (a - b + c) * b**2, "[a]-[b]/[c]+0.12": a - b / c + 0.12, "-[a]**2 - -3": -(a**2) + 3, "2**[a]**0": 2, "([a])": a, "1e2*[c]": 100 * c}
    df = spark.createDataFrame([(float(a), float(b), float(c))], "a double, b double, c double")
    got = df.select(*[raster.formula(t).alias(str(i)) for i, t in enumerate(cases)]).first()
    assert list(got) == pytest.approx(list(cases.values()))


@pytest.mark.parametrize("bad", ["__import__('os')", "[a", "[a] +", "a + b", "[a] [b]", "([a]", "[a;drop]", ""])
def test_formulas_refuse_code(spark, bad):
    with pytest.raises(ValueError):
        raster.formula(bad)


def test_water_classes(spark):
    codes = {0: 0, 1: 0, 10: 0, 100: 0, 1000: 0, 10000: 4, 11000: 3, 11: 4, 1001: 4, 10100: 4, 111: 2, 11100: 2, 1111: 1, 11111: 1, 10111: 1}
    df = spark.createDataFrame(list(codes.items()), "code int, want int")
    assert df.where(raster.water_class(F.col("code")) != F.col("want")).count() == 0


def test_missing_pixels_fail_water_tests(spark):
    df = spark.createDataFrame([(None,) * 6], "b double, g double, r double, n double, s double, t double")
    px = raster.water_indices(*[F.col(c) for c in "bgrnst"])
    code = raster.water_tests(px | {"blue": F.col("b"), "nir": F.col("n"), "swir1": F.col("s"), "swir2": F.col("t")})
    assert df.select(code.alias("c")).first().c == 0


def test_cloud_masks(spark):
    df = spark.createDataFrame([(c << 8 | r << 14, c, r) for c in range(4) for r in range(4)], "qa int, c int, r int")
    for level, values in raster.QA_LEVELS.items():
        assert df.where(raster.qa_cloud(F.col("qa"), level) != (F.col("c").isin(*values) | F.col("r").isin(*values))).count() == 0
    assert df.where(raster.qa_cloud(F.col("qa"), "medium", False, True) != F.col("c").isin(1, 3)).count() == 0
    with pytest.raises(ValueError, match="no mask"):
        raster.cloud_mask("b1", F.col("qa"))


def surface(spark, fn, n=5):
    return spark.createDataFrame([(0, y, x, float(fn(y, x))) for y in range(n) for x in range(n)], "chip int, y int, x int, value double")


@pytest.mark.parametrize(("fn", "aspect", "sin", "cos"), [(lambda y, x: 1, -1, -1, -1), (lambda y, x: -y, 180, 1, 0), (lambda y, x: -x, 90, 2, 1), (lambda y, x: y, 0, 1, 2), (lambda y, x: x, 270, 0, 1)])
def test_aspect(spark, fn, aspect, sin, cos):
    g = terrain.gradients(surface(spark, fn))
    assert g.count() == 9
    dx, dy = F.col("dx"), F.col("dy")
    row = g.select(terrain.aspect(dx, dy).alias("a"), terrain.aspect(dx, dy, "sin").alias("s"), terrain.aspect(dx, dy, "cos").alias("c")).first()
    assert tuple(row) == pytest.approx((aspect, sin, cos), abs=1e-9)
    with pytest.raises(ValueError, match="transform"):
        terrain.aspect(dx, dy, "tan")


def test_slope(spark):
    g = terrain.gradients(surface(spark, lambda y, x: 3 * x), cell=3.0)
    assert g.select(terrain.slope(F.col("dx"), F.col("dy")).alias("s")).first().s == pytest.approx(45)


def test_crops(spark):
    px = surface(spark, lambda y, x: 10 * y + x, 10)
    assert sorted(r.value for r in chips.centre_crop(px.where("y < 2 AND x < 5"), 2, 5).collect()) == [1, 2, 3, 11, 12, 13]
    assert chips.centre_subset(px, 10, 10, 0.8).count() == 64 and chips.centre_subset(px, 10, 10, 0.8, compat=True).count() == 4


def test_utm_known_points(spark):
    """Central meridian, equator, and a round trip of distances along a parallel."""
    df = spark.createDataFrame([(-123.0, 0.0), (-123.0, 47.5), (-122.061066, 47.88422)], "lon double, lat double")
    x, y = geo.utm(F.col("lon"), F.col("lat"), 10)
    rows = df.select(x.alias("x"), y.alias("y")).collect()
    assert rows[0].x == pytest.approx(500000, abs=1e-6) and rows[0].y == pytest.approx(0, abs=1e-6)
    assert rows[1].x == pytest.approx(500000, abs=1e-6) and rows[1].y == pytest.approx(5260835.6, abs=200)
    assert rows[2].x == pytest.approx(570200, abs=300) and rows[2].y == pytest.approx(5303900, abs=600)
    assert df.select(geo.utm_zone(F.col("lon")).alias("z")).first().z == 10


def test_rings(spark):
    ring = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((0, 0), (4, 0), (4, 4), (2, 1), (0, 4))])
    points = {(1, 0.5): True, (2, 2): False, (2, 1): True, (0, 2): True, (4, 4): True, (5, 1): False, (2, 0): True, (3.5, 3): True, (-1, 0): False, (1, 3): False}
    df = spark.createDataFrame([(float(x), float(y), w) for (x, y), w in points.items()], "lon double, lat double, want boolean")
    assert [tuple(r) for r in df.where(geo.in_ring(F.col("lon"), F.col("lat"), ring) != F.col("want")).collect()] == []


def test_spatial_join_plans_agree(spark, monkeypatch):
    g = np.random.default_rng(1)
    points = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(g.random((200, 2)) * 4)], "id int, lon double, lat double")
    boxes = [(f"k{i}", float(a), float(b), float(a + 1.3), float(b + 0.7)) for i, (a, b) in enumerate(g.random((12, 2)) * 3)]
    corner = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    regions = spark.createDataFrame(boxes, "key string, minx double, miny double, maxx double, maxy double").withColumn("ring", F.array(corner("minx", "miny"), corner("maxx", "miny"), corner("maxx", "maxy"), corner("minx", "maxy")))
    few = sorted(map(tuple, occurrences.spatial_join(points, regions).select("id", "key").collect()))
    monkeypatch.setattr(occurrences, "SMALL_REGIONS", 3)
    assert few == sorted(map(tuple, occurrences.spatial_join(points, regions).select("id", "key").collect())) and few


def brute_grid(points, cell, min_area, most):
    lon0, lat0 = min(p[1] for p in points) - 1e-4, min(p[2] for p in points) - 1e-4
    deep = grid.depth_of(cell, min_area)
    names = {}
    for i, lon, lat in points:
        u, v = (lon - lon0) / cell, (lat - lat0) / cell
        a, b = math.ceil(u) - 1, math.ceil(v) - 1
        name, u, v, path = f"{a}_{b}", u - a, v - b, []
        path.append(name)
        for _ in range(deep):
            a, b = int(u > 0.5), int(v > 0.5)
            name, u, v = f"{name}__{a}{b}", 2 * u - a, 2 * v - b
            path.append(name)
        names[i] = path
    counts = {}
    for path in names.values():
        for p in path:
            counts[p] = counts.get(p, 0) + 1
    means = []
    for d in range(deep + 1):
        over = [n for n in {p[d] for p in names.values()} if counts[n] > most]
        means.append(sum(counts[n] for n in over) / len(over) if over else None)
    cap = next((t for t in range(2, deep + 1) if means[t] is not None and means[t - 1] is not None and means[t] >= means[t - 1]), deep)
    return {i: next((p for d, p in enumerate(path) if counts[p] <= most or d == cap)) for i, path in names.items()}


@pytest.mark.parametrize(("seed", "spread"), [(0, 0.05), (1, 0.001), (2, 0.3)])
def test_adaptive_grid(spark, seed, spread):
    g = np.random.default_rng(seed)
    points = [(i, float(a), float(b)) for i, (a, b) in enumerate(g.normal(size=(400, 2)) * spread)]
    got = {r.id: r.cell for r in grid.adaptive(spark.createDataFrame(points, "id int, lon double, lat double"), 0.1, 1e-4, 20).collect()}
    assert got == brute_grid(points, 0.1, 1e-4, 20)


def test_prepare(spark):
    a = spark.createDataFrame([(1.0, "a", "b", "c"), (2.1, "d", "e", "f"), (3.0, "g", "h", "i"), (6.0, None, "h", "i")], "gbifid double, col1 string, col2 string, col3 string")
    b = spark.createDataFrame([(1.0, "ai", "bc", "ABSENT"), (4.0, "dd", "de", "PRESENT"), (2.2, "gk", "hl", "PRESENT"), (6.0, "f", None, "ABSENT")], "gbifid double, col1 string, col5 string, target string")
    x, y = ml.prepare(a, b, "gbifid", "target", ["col5"])
    assert sorted(map(tuple, x.collect())) == [(1, "a", "b", "c", "ai"), (2, "d", "e", "f", "gk")]
    assert x.columns == ["gbifid", "col1_all", "col2", "col3", "col1_species"]
    assert sorted(map(tuple, y.collect())) == [(1, 0), (2, 1)]
    with pytest.raises(ValueError, match="no such columns"):
        ml.prepare(a, b, "gbifid", "target", ["col9"])


def test_metrics(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 0), (1, 0)], "t int, p int")
    rows = {r.label: r for r in ml.classification_report(df, "t", "p").collect()}
    assert (rows["0"].precision, rows["0"].recall, round(rows["0"].f1, 4), rows["0"].support) == (0.5, 1.0, 0.6667, 2)
    assert (rows["1"].precision, rows["1"].recall, rows["1"].f1, rows["1"].support) == (0, 0, 0, 2)
    assert tuple(ml.hard_auc(df, "t", "p").first()) == (0.5, 0.5)
    assert {(r.truth, r.predicted): r.n for r in ml.confusion_matrix(df, "t", "p").collect()} == {(0, 0): 2, (0, 1): 0, (1, 0): 2, (1, 1): 0}


def test_numbers_with_a_payload(spark, tmp_path):
    """Written and read back, a column more than the order: each number once, in order."""
    df = spark.range(400_000).select(F.xxhash64("id").alias("k"), (F.col("id") % 1000).alias("g"), F.concat(F.lit("text "), F.col("id").cast("string")).alias("more"))
    gold.numbered(df.repartition(7), ["g", "k"], "n").write.parquet(f"{tmp_path}/n")
    got = spark.read.parquet(f"{tmp_path}/n")
    assert got.agg(F.count_distinct("n"), F.min("n"), F.max("n")).first() == (400_000, 0, 399_999)
    after = got.alias("a").join(got.alias("b"), F.col("b.n") == F.col("a.n") + 1).where("a.g > b.g OR (a.g = b.g AND a.k > b.k)")
    assert after.count() == 0
    ml.split(df.withColumnRenamed("k", "id"), 0.9).write.parquet(f"{tmp_path}/s")
    assert spark.read.parquet(f"{tmp_path}/s").where("part = 'train'").count() == 360_000
    odd = spark.createDataFrame([(None, "a"), (None, "b"), (float("nan"), "c"), (1.0, None), (1.0, "d")], "x double, y string")
    assert [(r.x if r.x == r.x else "nan", r.y) for r in gold.numbered(odd, ["x", "y"], "n").orderBy("n").collect()] == [(None, "a"), (None, "b"), (1.0, None), (1.0, "d"), ("nan", "c")]
    assert gold.numbered(odd.limit(0), ["x"], "n").count() == 0


def test_grid_keeps_repeated_rows(spark):
    rows = [(1, 0.0, 0.0), (1, 0.0, 0.0), (2, 0.01, 0.01), (None, 0.05, 0.09)]
    got = grid.adaptive(spark.createDataFrame(rows, "id int, lon double, lat double"), most=1).collect()
    assert len(got) == 4 and got[0].cell is not None


def test_samples_take_the_first_in_hash_order(spark):
    import hashlib

    rows = [(i, "big" if i % 3 else None) for i in range(9000)] + [(i, "small") for i in range(9000, 9003)]
    df = spark.createDataFrame(rows, "id int, g string")
    order = lambda g: sorted((i for i, k in rows if k == g), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())
    got = occurrences.sample_per_group(df, 4321, ["g"], "id").collect()
    for g in ("big", None, "small"):
        assert {r.id for r in got if r.g == g} == set(order(g)[:4321])
    got = occurrences.sample_fraction(df, 0.25, ["g"]).collect()
    for g in ("big", None, "small"):
        assert {r.id for r in got if r.g == g} == set(order(g)[: round(len(order(g)) * 0.25)])


@pytest.mark.parametrize("few", [1, 10_000])
def test_samples_of_repeated_keys_and_many_groups(spark, monkeypatch, few):
    import hashlib

    from habitra import session

    monkeypatch.setattr(session, "SMALL_ROWS", few)
    rows = [(i // 5, "a" if i % 4 else "b", i) for i in range(4000)]
    got = occurrences.sample_per_group(spark.createDataFrame(rows, "id int, g string, n int"), 777, ["g"], "id")
    for g in "ab":
        keys = sorted((i for i, k, _ in rows if k == g), key=lambda i: hashlib.md5(str(i).encode()).hexdigest())[:777]
        mine = [r for r in got.collect() if r.g == g]
        assert sorted(r.id for r in mine) == sorted(keys) and len({r.n for r in mine}) == 777


def test_absences_need_a_pool(spark):
    points = spark.createDataFrame([(i, s, "P") for i, s in enumerate("a" * 5 + "b" * 3 + "c" * 4)], "id int, species string, status string")
    species = spark.createDataFrame([("a", 0), ("b", 0), ("c", 1)], "species string, candidate int")
    ask = lambda s, n, **k: occurrences.pseudo_absences(points, species, spark.createDataFrame([(s, 0 if s != "c" else 1, n)], "species string, candidate int, obs int"), **k)
    assert ask("b", 3).count() == 3 and ask("b", 5).where("species = 'b' AND status = 'ABSENT'").count() == 5
    for s, n in (("a", 5), ("c", 4)):
        with pytest.raises(ValueError, match="too few rows"):
            ask(s, n)
    assert ask("a", 5, short="keep").count() == 3


def test_distances_in_blocks(spark, monkeypatch):
    g = np.random.default_rng(8)
    at = g.normal(size=(40, 2)) * 100
    df = spark.createDataFrame([(i, "s" if i < 30 else "t", float(x), float(y)) for i, (x, y) in enumerate(at)], "id int, species string, x double, y double")
    monkeypatch.setattr(occurrences, "PAIR_BLOCK", 7)
    for r in occurrences.mean_distance(df).collect():
        own = at[:30] if r.species == "s" else at[30:]
        assert r.mean_euclidean_dist == pytest.approx(np.sqrt(((own - at[r.id]) ** 2).sum(1)).mean())


def test_distances_between_copies_and_blocks(spark, monkeypatch):
    g = np.random.default_rng(9)
    at = g.integers(0, 12, size=(400, 2)) * 0.1
    rows = [(i % 390, "s" if i < 300 else "t", float(x), float(y)) for i, (x, y) in enumerate(at)]  # some ids twice
    df = spark.createDataFrame([*rows, (900, "s", None, 1.0), (901, "u", None, None), (902, None, 1.0, 1.0)], "id int, species string, x double, y double")
    want = {(901, "u"): None, (900, "s"): None}
    for i, s, _, _ in rows:
        own = np.array([[x, y] for _, t, x, y in rows if t == s])
        want[i, s] = np.mean([np.hypot(*(own - [x, y]).T).mean() for k, t, x, y in rows if (k, t) == (i, s)])
    for block in (1 << 15, 30):
        monkeypatch.setattr(occurrences, "PAIR_BLOCK", block)
        got = {(r.id, r.species): r.mean_euclidean_dist for r in occurrences.mean_distance(df).collect()}
        assert got.keys() == want.keys()
        assert all(got[k] == (pytest.approx(v) if v is not None else None) for k, v in want.items())


def test_distance_of_a_group_is_the_mean_of_its_keys(spark, monkeypatch):
    g = np.random.default_rng(10)
    rows = [(i // 3 if i < 60 else i, "s" if i % 2 else "t", float(x), float(y)) for i, (x, y) in enumerate(g.integers(0, 30, size=(300, 2)))]  # some ids up to three times
    df = spark.createDataFrame([*rows, (900, "s", None, 1.0), (901, "u", None, None), (3, "t", 1.0, None), (902, None, 1.0, 1.0), (903, "v", 1.0, 1.0)], "id int, species string, x double, y double")
    for block in (1 << 15, 30):
        monkeypatch.setattr(occurrences, "PAIR_BLOCK", block)
        each = occurrences.mean_distance(df).groupBy("species").agg(F.avg("mean_euclidean_dist").alias("d"))
        want, got = ({r.species: r.d for r in x.collect()} for x in (each, occurrences.group_distance(df, "d")))
        assert got.keys() == want.keys() == {"s", "t", "u", "v"} and got["u"] is None and got["v"] == 0
        assert got["s"] == pytest.approx(want["s"], rel=1e-12) and got["t"] == pytest.approx(want["t"], rel=1e-12)


def test_distances_of_a_crowd(spark):
    # 2.5e9 pairs of points at 10 places, which can't be made one by one
    crowd = spark.range(50_000).select("id", F.lit("s").alias("species"), (F.col("id") % 10).cast("double").alias("x"), F.lit(2.0).alias("y"))
    got = occurrences.mean_distance(crowd).groupBy((F.col("id") % 10).alias("at")).agg(F.count("*").alias("n"), F.min("mean_euclidean_dist").alias("a"), F.max("mean_euclidean_dist").alias("b")).collect()
    assert {r["at"]: (r.n, r.a, r.b) for r in got} == {i: (5000, m, m) for i in range(10) for m in [sum(abs(i - j) for j in range(10)) / 10]}


def test_range_totals_are_those_of_the_pairs(spark, monkeypatch):
    g = np.random.default_rng(5)
    # steps of half a buffer, so that many lie on borders, on both sides of 0; copies, missing places and missing values
    rows = [(i, float(x) * 0.05, float(y) * 0.05) for i, (x, y) in enumerate(g.integers(-25, 25, size=(700, 2)))] + [(None, 0.1, 0.1), (None, 9.0, 9.0), (1000, None, 0.1), (1001, 0.1, None)]
    points = spark.createDataFrame(rows, "point long, px double, py double")
    pixels = points.toDF("pixel", "x", "y")
    want = {}
    for point, x, y in rows:
        if x is not None and y is not None:
            near = [i for i, u, v in rows if u is not None and v is not None and x - 0.1 <= u <= x + 0.1 and y - 0.1 <= v <= y + 0.1]
            n, total = want.get(point, (0, None))
            ids = [i for i in near if i is not None] + ([total] if total is not None else [])
            want[point] = (n + len(near), sum(ids) if ids else None)
    pairs = chips.range_join(points, pixels, 0.1).groupBy("point").agg(F.count("*").alias("n"), F.sum("pixel").alias("total"))
    assert {r.point: (r.n, r.total) for r in pairs.collect()} == want
    for block in (1 << 18, 50):
        monkeypatch.setattr(chips, "TILE_BLOCK", block)
        assert {r.point: (r.n, r.total) for r in chips.range_totals(points, pixels, 0.1).collect()} == want


def test_range_totals_of_a_crowd(spark):
    # 1.6e9 pairs, which can't be made one by one
    crowd = spark.range(40_000).select(F.col("id").alias("point"), (F.col("id") % 200).cast("double").alias("px"), F.lit(1.0).alias("py"))
    got = chips.range_totals(crowd, crowd.toDF("pixel", "x", "y"), 1500.0).agg(F.count("*"), F.min("n"), F.max("n"), F.min("total"), F.max("total")).first()
    assert tuple(got) == (40_000, 40_000, 40_000, 799_980_000, 799_980_000)


def test_utm_and_back(spark):
    df = spark.createDataFrame([(-122.1, 47.6, 10, False), (-120.0, 0.0, 10, False), (25.3, -33.9, 35, True), (27.0, 79.9, 35, False), (22.1, -79.5, 34, True)], "lon double, lat double, z int, s boolean")
    x, y = geo.utm(F.col("lon"), F.col("lat"), F.col("z"), "WGS84", F.col("s"))
    there = df.withColumns({"x": x, "y": y})
    assert there.where("s AND (y < 0 OR y > 10000000)").count() == 0
    lon, lat = geo.lonlat(F.col("x"), F.col("y"), F.col("z"), "WGS84", F.col("s"))
    for r in there.withColumns({"a": lon, "b": lat}).collect():
        assert abs(r.a - r.lon) < 1e-8 and abs(r.b - r.lat) < 1e-8  # a millimetre
    box = [F.lit(v) for v in (-122.2, 47.5, -122.0, 47.7)]
    back = geo.boxes(geo.boxes(box, 4326, 32610), 32610, 4326)
    assert list(spark.range(1).select(*back).first()) == pytest.approx([-122.2, 47.5, -122.0, 47.7], abs=1e-8)
    with pytest.raises(ValueError, match="unknown system"):
        geo.boxes(box, 4326, 3857)


def test_shapes(spark, tmp_path):
    """Two parts, one with a hole, from WKT and GeoJSON; against the same rule in Python."""
    outer, hole, part = [(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], [(4, 4), (6, 4), (6, 6), (4, 6), (4, 4)], [(20, 0), (24, 0), (22, 5), (20, 0)]
    wkt = "MULTIPOLYGON (((" + ")), ((".join(["), (".join(", ".join(f"{x} {y}" for x, y in r) for r in rings) for rings in ([outer, hole], [part])]) + ")))"
    Path(f"{tmp_path}/r.csv").write_text(f'name,geometry\nm,"{wkt}"\np,"POLYGON Z ((0 0 5, 1 0 5, 1 1 5, 0 0 5))"\nn,POINT (1 2)\n')
    features = [{"type": "Feature", "properties": {"name": "m"}, "geometry": {"type": "MultiPolygon", "coordinates": [[outer, hole], [part]]}}, {"type": "Feature", "properties": {"name": "q"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}]
    Path(f"{tmp_path}/r.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate([(1.0, 1.0), (5.0, 5.0), (4.0, 5.0), (22.0, 2.0), (20.1, 4.0), (15.0, 1.0), (10.0, 10.0)])], "id int, lon double, lat double")
    for regions in (vector.read_wkt(spark, f"{tmp_path}/r.csv", "name string, geometry string"), vector.read_geojson(spark, f"{tmp_path}/r.geojson", ["name"])):
        got = occurrences.spatial_join(points, regions, "name", ["m"])
        assert sorted(r.id for r in got.collect()) == [0, 2, 3, 6]
        assert regions.where("name = 'm'").select("minx", "miny", "maxx", "maxy").first() == (0.0, 0.0, 24.0, 10.0)
    shape = vector.rings_literal([outer, hole])
    boxes = spark.createDataFrame([(0, 4.5, 4.5, 5.5, 5.5), (1, 1.0, 1.0, 2.0, 2.0), (2, -5.0, -5.0, 50.0, 50.0), (3, 9.0, -1.0, 9.5, 11.0), (4, 11.0, 0.0, 12.0, 1.0), (5, 3.0, 3.0, 5.0, 5.0)], "id int, a double, b double, c double, d double")
    assert sorted(r.id for r in boxes.where(vector.box_meets([F.col(c) for c in "abcd"], shape)).collect()) == [1, 2, 3, 5]


def test_raster_load(spark):
    px = spark.createDataFrame([("s", date(2020, 1 + t, 1), "B", x + 0.5, y + 0.5, float(10 * y + x)) for t in (0, 1) for y in range(4) for x in range(4)], "scene string, ts date, band string, x double, y double, value double")
    scenes = spark.createDataFrame([("s",)], "scene string")
    load = lambda **k: {(r.x, r.y): r.value for r in tables.load_pixels(px, scenes, ["b"], period=(date(2020, 1, 1), date(2020, 1, 31)), **k).collect()}
    assert load(step=1.0, resolution=2.0) == {(1.0 + 2 * i, 1.0 + 2 * j): float(10 * (2 * j + 1) + 2 * i + 1) for i in range(2) for j in range(2)} or len(load(step=1.0, resolution=2.0)) == 4
    fine = load(step=1.0, resolution=0.5)
    assert len(fine) == 64 and all(v == 10 * int(y) + int(x) for (x, y), v in fine.items())
    clipped = load(clip=vector.rings_literal([[(0, 0), (2, 0), (2, 2), (0, 2)]]))
    assert {k for k, v in clipped.items() if v is not None} == {(x + 0.5, y + 0.5) for x in (0, 1) for y in (0, 1)} and len(clipped) == 16


def test_terrain_of_oblong_chips(spark):
    g = np.random.default_rng(6)
    sizes = {1: (5, 9), 2: (8, 4), 3: (6, 6), 4: (3, 12)}
    grids = {c: g.normal(size=s) for c, s in sizes.items()}
    df = spark.createDataFrame([(c, y, x, float(v)) for c, a in grids.items() for y, row in enumerate(a) for x, v in enumerate(row)], "chip int, y int, x int, value double")
    found = {(r.chip, r.y, r.x): r for r in terrain.gradients(df).collect()}
    for r in terrain.features(df).collect():
        a = grids[r.chip]
        h, w = a.shape
        dy, dx = (h - min(h, w)) // 2, (w - min(h, w)) // 2
        assert r.nasadem_elevation_total == pytest.approx(a[dy : h - dy, dx : w - dx].mean())
        slopes = [math.degrees(math.atan(math.hypot(q.dx, q.dy))) for (c, y, x), q in found.items() if c == r.chip and dy <= y < h - dy and dx <= x < w - dx]
        assert r.nasadem_slope_total == pytest.approx(np.mean(slopes))


def test_boxes_of_nearest_coordinates(spark):
    px = spark.createDataFrame([(x, y) for x in range(12) for y in range(12)], "x int, y int")
    take = lambda box, m=0: {(r.x, r.y) for r in chips.nearest_box(px, box, m).collect()}
    assert take((1.2, 0.0, 8.4, 7.0)) == {(x, y) for x in range(1, 8) for y in range(7)}
    assert take((5.0, 5.0, 6.0, 6.0)) == {(x, y) for x in range(4, 7) for y in range(4, 7)}
    assert take((0.0, 9.0, 0.0, 20.0), 1) == {(x, y) for x in range(2) for y in range(7, 12)}


@pytest.mark.parametrize(("stride", "freq"), [("y", "YE"), ("q", "QE"), ("m", "ME"), ("w", "W"), ("d", "D")])
@pytest.mark.parametrize(("first", "last"), [(date(2019, 11, 30), date(2021, 6, 30)), (date(2020, 1, 1), date(2020, 1, 31)), (date(2020, 2, 3), date(2020, 2, 2)), (date(2012, 12, 31), date(2015, 12, 30))])
def test_time_strides(spark, stride, freq, first, last):
    n, end = segments.period_ends(first, last, stride)
    got = [r.d for r in spark.range(n).orderBy("id").select(end(F.col("id")).alias("d")).collect()]
    assert got == [t.date() for t in pd.date_range(first, last, freq=freq)]


def test_annuals_by_variable(spark):
    rows = [(date(2020, m, 1), b, float(m)) for m in range(1, 13) for b in ("Ppt", "Tmax", "Soil")]
    got = {r.band: r.value for r in climate.annual_each(spark.createDataFrame(rows, "ts date, band string, value double"), {"Ppt": "sum", "Tmax": "mean"}).collect()}
    days = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    mean = sum((m + 1) * d for m, d in enumerate(days)) / 366
    assert got == pytest.approx({"ppt": mean, "tmax": mean})


def test_nearest_on_two_axes(spark):
    grid2 = spark.createDataFrame([(i * 0.5, j * 0.25) for i in range(6) for j in range(6)], "lon double, lat double").withColumn("lat", F.col("lat") * 2)
    points = spark.createDataFrame([(1, 0.6, 1.3), (2, 9.0, -4.0)], "id int, lon double, lat double")
    assert {(r.id, r.grid_lon, r.grid_lat) for r in climate.nearest_point(points, grid2, "id", 0.5).collect()} == {(1, 0.5, 1.5), (2, 2.5, 0.0)}


def test_write_modes_and_quarantine(spark, tmp_path):
    px = lambda b, v: spark.createDataFrame([(1, b, 0, 0, v)], "chip int, band string, y int, x int, `a:b` double")
    path, held = f"{tmp_path}/chips", lambda: {(r.band, r.a_b) for r in spark.read.parquet(f"{tmp_path}/chips").collect()}
    tables.write_chips(px("b1", 1.0), path, "w-")
    with pytest.raises(Exception, match="(?i)exists"):
        tables.write_chips(px("b1", 2.0), path, "w-")
    tables.write_chips(px("b2", 2.0), path, "a")
    tables.write_chips(px("b1", 3.0), path, "r+")
    assert held() == {("b1", 3.0), ("b2", 2.0)}
    with pytest.raises(ValueError, match="aren't there"):
        tables.write_chips(px("b9", 3.0), path, "r+")
    tables.write_chips(px("b3", 4.0), path)
    assert held() == {("b3", 4.0)}
    good, bad = tables.quarantine(spark.createDataFrame([(1, "5"), (2, "x"), (3, None)], "id int, v string"), {"id": F.col("id") > 0, "number": F.col("v").try_cast("int").isNotNull(), "small": F.col("id") < 3})
    assert [r.id for r in good.collect()] == [1] and {(r.id, r.error) for r in bad.collect()} == {(2, "number"), (3, "number")}


def test_folds_and_search(spark, tmp_path):
    df = spark.range(1003).select("id", (F.col("id") % 10 == 0).cast("int").alias("t"), F.rand(3).alias("a"))
    sizes = [r["count"] for r in ml.stratified_folds(df, "t", 5).groupBy("t", "fold").count().orderBy("t", "fold").collect()]
    assert max(sizes[:5]) - min(sizes[:5]) <= 1 and max(sizes[5:]) - min(sizes[5:]) <= 1 and sum(sizes) == 1003
    assert ml.draw(ml.SPACE, 3, 5) == ml.draw(ml.SPACE, 3, 5) != ml.draw(ml.SPACE, 3, 6)
    assert all(lo <= x[k] <= hi for x in ml.draw(ml.SPACE, 50, 1) for k, (lo, hi, _) in ml.SPACE.items())
    small = ml.SPACE | {"maxDepth": (1, 3, "int"), "minInstancesPerNode": (1, 5, "int")}
    data = df.withColumn("b", F.col("t") + F.col("a")).limit(300)
    model, trials = ml.tune(data, ["a", "b"], "t", evaluations=2, folds=2, trees=2, space=small)
    assert len(trials) == 2 and set(trials[0]) == {*ml.SPACE, "metric"} and 0 < min(t["metric"] for t in trials) < 0.7
    ml.save_model(model, f"{tmp_path}/m")
    again = ml.load_model(f"{tmp_path}/m")
    assert ml.score(data, again, ["id"]).collect() == ml.score(data, model, ["id"]).collect()


def test_all_water_codes(spark):
    """Each of the 32 outcomes of the five tests; classes as listed in the published table of the method."""
    import itertools

    table = {0: "00000 00001 00010 00100 01000", 1: "01111 10111 11011 11101 11110 11111", 2: "00111 01011 01101 01110 10011 10101 10110 11001 11010 11100", 3: "11000", 4: "00011 00101 00110 01001 01010 01100 10000 10001 10010 10100"}
    want = {int(c): k for k, codes in table.items() for c in codes.split()}
    assert len(want) == 32 == len(set(itertools.product((0, 1), repeat=5)))
    df = spark.createDataFrame(list(want.items()), "code int, want int")
    assert df.where(raster.water_class(F.col("code")) != F.col("want")).collect() == []


def test_unknown_values_raise(spark):
    df = spark.createDataFrame([("MAYBE",)], "s string")
    for c in (ml.encode_target(F.col("s")), occurrences.quality_rank(F.col("s"))):
        with pytest.raises(Exception, match="unknown"):
            df.select(c).collect()


def test_gold(spark):
    a = spark.createDataFrame([(1, 1.0, 0), (1, 2.0, 1), (2, None, 0), (3, 4.0, 0)], "gbifid int, x double, seq int")
    b = spark.createDataFrame([(1, 5.0, 0), (2, 6.0, 0), (9, 7.0, 0)], "gbifid int, y double, seq int")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(gold.gold([a, b], seq="seq")) == [(1, 2.0, 5.0)]
    assert rows(gold.gold([a, b], nans="fill", fill_value=0, seq="seq")) == [(1, 2.0, 5.0), (2, 0.0, 6.0)]
    assert rows(gold.gold([a, b], nans="fill", fill_value="mean", seq="seq")) == [(1, 2.0, 5.0), (2, 2.0, 6.0)]
    assert gold.gold([a, b], renames={"x": "z"}, seq="seq").columns == ["gbifid", "z", "y"]


def test_qcut(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 2, 2, 3, 4, 5, 9]], "v double")
    assert sorted((r.v, r.b) for r in occurrences.qcut(df, "v", "b").collect()) == [(1, 0), (2, 0), (2, 0), (2, 0), (3, 2), (4, 2), (5, 3), (9, 3)]
    with pytest.raises(Exception, match="unique"):
        occurrences.qcut(spark.createDataFrame([(1.0,)] * 5, "v double"), "v", "b").collect()


def test_splits(spark):
    df = spark.range(1000)
    parts = {r.part: r["count"] for r in ml.split(df, 0.9, 0.05).groupBy("part").count().collect()}
    assert parts["train"] == 900 and parts["validation"] in (49, 50) and sum(parts.values()) == 1000
    assert {r.part: r["count"] for r in ml.split(df, 0.9).groupBy("part").count().collect()} == {"train": 900, "test": 100}


def test_model(spark):
    df = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 3).cast("double").alias("b")).withColumn("t", (F.col("a") > 3).cast("int"))
    scored = ml.score(df, ml.train(df, ["a", "b"], "t", trees=3, depth=2), ["id", "t"])
    assert scored.where("(PRESENT > 0.5) <> (t = 1)").count() == 0
    model, trials = ml.tune(df, ["a", "b"], "t", depths=(1, 2), rates=(0.1,), folds=2, trees=2)
    assert len(trials) == 2 and max(t["metric"] for t in trials) < 0.2 and ml.score(df, model, ["id"]).count() == 400


def test_annual_means(spark):
    rows = [("v", date(2020, m, 1), float(m)) for m in range(1, 13)] + [("v", date(2021, m, 1), None if m > 1 else 5.0) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "variable string, ts date, value double")
    days = [31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31]
    mean = {r.year: r.value for r in climate.annual(df, "mean").collect()}
    assert mean[2020] == pytest.approx(sum(d * m for m, d in enumerate(days, 1)) / 366) and mean[2021] == pytest.approx(5)
    assert {r.year: r.value for r in climate.annual(df, "sum").collect()}[2021] == pytest.approx(5 * 31 / 365)


def test_nearest(spark):
    axis = spark.createDataFrame([(i * 0.5,) for i in range(10)], "v double")
    points = spark.createDataFrame([(1, 0.2), (2, 0.25), (3, 9.0), (4, -3.0), (5, 4.49)], "id int, p double")
    got = {r.id: r.v for r in climate.nearest_pixel(points, axis, "v", "p", "id", 0.5).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 4.5, 4: 0.0, 5: 4.5}


def test_segments(spark):
    g = segments.segment_grid(spark, (0.0, 0.0, 10.0, 5.0), 5.0, 5.0, 2019, 2020, buffer=False)
    assert sorted(map(tuple, g.collect())) == [(0.0, 0.0, "2019-12-31"), (0.0, 0.0, "2020-12-31"), (5.0, 0.0, "2019-12-31"), (5.0, 0.0, "2020-12-31")]
    assert [r.id for r in segments.segment_ids(g).orderBy("x", "time").collect()] == ["CPT00", "CPT01", "CPT02", "CPT03"]


def test_names(spark):
    df = spark.createDataFrame([("  Ab Cd ", 1)], ["a-b (c)", "d_1"])
    assert text.sanitise_columns(df).columns == ["abc", "d_1"]
    row = df.select(text.normalise(F.col("`a-b (c)`")).alias("n"), text.slug(F.lit("Canis lupus familiaris of the north"), 31).alias("s")).first()
    assert row.n == "ab_cd" and row.s == "canis_lupus_familiaris_of_the_n"


def test_sources(spark, tmp_path):
    df = spark.createDataFrame([(1, 2020, "Canis lupus"), (2, 2021, "Felis x")], "cluster int, year int, species string")
    tables.write_features(df, f"{tmp_path}/f")
    tables.write_features(df.where("year = 2021").withColumn("species", F.lit("new")), f"{tmp_path}/f")
    assert sorted(r.species for r in spark.read.parquet(f"{tmp_path}/f").collect()) == ["Canis lupus", "new"]
    tables.write_species(df, f"{tmp_path}/s")
    assert (tmp_path / "s" / "species_slug=canis_lupus").exists()
    (tmp_path / "c.csv").write_text("a-1,b (m)\n1,2.5\n")
    assert tables.csv(spark, f"{tmp_path}/c.csv", "a int, b double").columns == ["a", "b"]
    assert tables.union_all([spark.range(2), df]).columns == ["id", "cluster", "year", "species"]
    assert tables.parameters('{"key": "k", "values": "[\\"a\\"]"}') == {"key": "k", "values": ["a"]}
    assert tables.time_range(("2020-01-10", date(2020, 2, 1)), 3) == (date(2020, 1, 7), date(2020, 2, 4))
    assert tables.time_range("2020-01-10/2020-02-01", 3) == (date(2020, 1, 10), date(2020, 2, 1)) and tables.time_range(None) is None
    assert tables.first_partition(spark.range(100, numPartitions=4)).count() == 25


def test_scene_search(spark):
    schema = "collection string, scene string, ts date, minx double, miny double, maxx double, maxy double, eo_cloud_cover double, platform string"
    found = [("l", "a", date(2020, 5, 1), 0.0, 0.0, 1.0, 1.0, 10.0, "landsat-8"), ("l", "b", date(2020, 5, 1), 0.0, 0.0, 1.0, 1.0, 60.0, "landsat-8"), ("l", "c", date(2020, 5, 1), 5.0, 5.0, 6.0, 6.0, 1.0, "landsat-8"), ("l", "d", date(2021, 5, 1), 0.0, 0.0, 1.0, 1.0, 1.0, "landsat-8"), ("l", "e", date(2020, 5, 2), 0.0, 0.0, 1.0, 1.0, 1.0, "landsat-8")]
    bad = spark.createDataFrame([("e",)], "scene string")
    got = tables.search_scenes(spark.createDataFrame(found, schema), ["l"], (0.5, 0.5, 2.0, 2.0), (date(2020, 1, 1), date(2020, 12, 31)), families.FAMILIES["landsat8"].query, bad)
    assert [r.scene for r in got.collect()] == ["a"]
    px = spark.createDataFrame([("a", "Red", 0.5, 0.5, 1.0), ("a", "blue", 0.5, 0.5, 1.0), ("b", "red", 0.5, 0.5, 1.0), ("a", "red", 9.0, 0.5, 1.0)], "scene string, band string, x double, y double, value double")
    assert [tuple(r) for r in tables.load_pixels(px, got, ["RED"], (0, 0, 1, 1)).collect()] == [("a", "red", 0.5, 0.5, 1.0)]


@pytest.mark.parametrize("kind", list(families.FAMILIES))
def test_families(spark, kind):
    f = families.family(kind)
    g = np.random.default_rng(2)
    dates = [date(2020, 1, 5), date(2020, 7, 5)] if kind not in ("nasadem", "gnatsgo") else [date(2000, 1, 1)]
    data = g.integers(7000, 20000, (len(dates), len(f.assets), 5, 5)).astype(float)
    if "qa_pixel" in f.assets:
        data[:, f.assets.index("qa_pixel")] = 0
        data[1, f.assets.index("qa_pixel")] = 3 << 8
    row = families.rows(chip(spark, data, dates, f.assets), f).first()
    if kind == "landsat8":
        i = f.assets.index("red")
        assert row.l8_red_s_jfm == pytest.approx(data[0, i].mean() * 0.0000275 - 0.2) and row.l8_red_s_jas is None
        assert not [c for c in row.asDict() if "qa_pixel" in c or "lwir11" in c]
    elif kind == "indices":
        n, r = (data[0, f.assets.index(b)] * 0.0000275 - 0.2 for b in ("nir08", "red"))
        assert row.indices_ndvi_s_jfm == pytest.approx(((n - r) / (n + r)).mean())
    elif kind == "water":
        assert row.water_nowater_s_jfm + row.water_water_s_jfm + row.water_wetland_s_jfm == pytest.approx(1) and row.water_water_s_jas is None
    elif kind == "gnatsgo":
        assert row.soil_mukey_total is not None and row.soil_tk0_100a_total == pytest.approx(data[0, 3].mean())
    elif kind == "nasadem":
        assert row.nasadem_elevation_total == pytest.approx(data[0, 0].mean())
    else:
        assert row.climate_tmax_s_jas == pytest.approx(data[1, f.assets.index("Tmax")].mean())
    with pytest.raises(ValueError, match="known"):
        families.family("other")


def test_streams(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = incremental.arrivals(spark, f"{tmp_path}/in", events.schema, 1)
    for _ in range(2):
        incremental.resume(stream, lambda b: b.select("event_id"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == events.count()
    for made in (incremental.windowed_counts(stream), incremental.sessions(stream)):
        q = made.writeStream.outputMode("complete" if "window" in made.columns else "append").format("memory").queryName("made").trigger(availableNow=True).start()
        q.awaitTermination()
        assert spark.table("made").count() > 0


@pytest.mark.parametrize("few", [2, 10_000])
def test_small_tables_are_reckoned_once(spark, monkeypatch, few):
    from habitra import session

    monkeypatch.setattr(session, "SMALL_ROWS", few)
    df = spark.createDataFrame([(1, "a", None, date(2020, 1, 2)), (2, None, 0.5, None), (None, "c", float("nan"), date(1900, 1, 1))], "i int, s string, x double, d date").withColumn("r", F.rand())
    held = session.small(df)
    assert held.schema == df.schema and str(held.orderBy("i").collect()) == str(held.orderBy("i").collect())
    assert sorted(map(str, held.drop("r").collect())) == sorted(map(str, df.drop("r").collect()))
    assert session.small(df.limit(0)).count() == 0
