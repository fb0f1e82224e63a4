"""Observations: reading, joining to regions, thinning, candidate species and pseudo-absences."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitra.functions.geo import in_ring, in_rings
from habitra.functions.nulls import half_even
from habitra.functions.pairs import pair_sums
from habitra.session import small, stored

#: How good a source is, by the basis of its records.
QUALITY_RANKS = {
    "PRESERVED_SPECIMEN": 9,
    "FOSSIL_SPECIMEN": 1,
    "MATERIAL_SAMPLE": 7,
    "HUMAN_OBSERVATION": 9,
    "MACHINE_OBSERVATION": 8,
    "OCCURRENCE": 6,
    "MATERIAL_CITATION": 7,
    "LIVING_SPECIMEN": 9,
}
CLASSES = ("Aves", "Mammalia", "Reptilia", "Amphibia")
_TESTS = {"==": lambda c, v: c == v, "!=": lambda c, v: c != v, ">": lambda c, v: c > v, ">=": lambda c, v: c >= v, "<": lambda c, v: c < v, "<=": lambda c, v: c <= v, "in": lambda c, v: c.isin(*v)}


def scan(table: DataFrame, filters: Sequence[tuple] = (), columns: Sequence[str] | None = None, classes: Sequence[str] | None = CLASSES, class_col: str = "class", required: Sequence[str] = ("species", "month", "day")) -> DataFrame:
    """Rows that pass all filters (column, test, value), of the given classes, with the required columns; Spark pushes all of it to the files."""
    for name, test, value in filters:
        table = table.where(_TESTS[test](F.col(name), value))
    if classes is not None:
        table = table.where(F.col(class_col).isin(*classes))
    return (table.select(*columns) if columns else table).na.drop(subset=list(required))


def quality_rank(basis: Column, ranks: dict[str, int] = QUALITY_RANKS) -> Column:
    """The rank of a basis; an unknown one raises."""
    known = F.create_map(*[F.lit(x) for pair in ranks.items() for x in pair])
    rank = F.try_element_at(known, basis)
    return F.when(rank.isNull(), F.raise_error(F.concat(F.lit("unknown basis of record: "), F.coalesce(basis, F.lit("NULL")))).cast("int")).otherwise(rank)


#: Up to this many regions, with so many corners (16 bytes each) together, go to all executors; more are met by grid cells.
SMALL_REGIONS, SMALL_CORNERS = 2000, 500_000


def spatial_join(points: DataFrame, regions: DataFrame, key: str | None = None, values: Sequence | None = None, cell: float = 0.5) -> DataFrame:
    """Points with the columns of every region that holds them, borders included.

    A region has ``minx, miny, maxx, maxy`` and ``ring``, or ``rings`` of several
    parts and holes (``sources.vector``).  A filter on the regions' key goes
    before the join.  Regions and corners are counted: few are broadcast; else boxes are spread over grid cells of ``cell`` degrees and the
    join is by cell.  Both plans give the same rows.
    """
    if key is not None and values is not None:
        regions = regions.where(F.col(key).isin(*values))
    several = "rings" in regions.columns
    corners = F.aggregate("rings", F.lit(0), lambda n, r: n + F.size(r)) if several else F.size("ring")
    boxed = F.col("lon").between(F.col("minx"), F.col("maxx")) & F.col("lat").between(F.col("miny"), F.col("maxy"))
    held, total = regions.agg(F.count("*"), F.coalesce(F.sum(corners), F.lit(0))).first()
    if held <= SMALL_REGIONS and total <= SMALL_CORNERS:
        met = points.join(F.broadcast(regions), boxed)
    else:
        at = lambda c: F.floor(F.col(c) / F.lit(cell)).cast("long")
        spread = regions.select("*", F.explode(F.sequence(at("minx"), at("maxx"))).alias("_cx")).select("*", F.explode(F.sequence(at("miny"), at("maxy"))).alias("_cy"))
        met = points.withColumns({"_cx": at("lon"), "_cy": at("lat")}).join(spread, ["_cx", "_cy"]).where(boxed).drop("_cx", "_cy")
    return met.where(in_rings(F.col("lon"), F.col("lat"), F.col("rings")) if several else in_ring(F.col("lon"), F.col("lat"), F.col("ring")))


def subsample(points: DataFrame, step: float = 60.0, rank: str = "source_quality_rank", key: str = "id") -> DataFrame:
    """One row for each species, year, month and cell of ``step`` metres: the best rank, then the least id."""
    cells = points.withColumns({"xr": half_even(F.col("x"), step), "yr": half_even(F.col("y"), step)}).na.drop(subset=["species", "year", "month", "xr", "yr"])
    others = [c for c in cells.columns if c not in ("species", "year", "month", "xr", "yr")]
    best = cells.groupBy("species", "year", "month", "xr", "yr").agg(F.min_by(F.struct(*others), F.struct((-F.col(rank)).alias("r"), F.col(key))).alias("_row"))
    return best.select("species", "year", "month", "xr", "yr", "_row.*")


def min_obs(points: DataFrame, at_least: int = 300) -> DataFrame:
    """``species, obs`` of species with that many rows."""
    return points.groupBy("species").agg(F.count("*").alias("obs")).where(F.col("obs") >= at_least)


def qcut(df: DataFrame, value: str, out: str, q: int = 4) -> DataFrame:
    """Quantile bins 0 to q-1, closed on the right; equal values share a bin.  Edges that coincide raise."""
    edges = df.agg(F.percentile(value, F.array(*[F.lit(i / q) for i in range(q + 1)])).alias("_e"))
    same = F.size(F.array_distinct("_e")) < q + 1
    checked = edges.select(F.when(same & F.col("_e").isNotNull(), F.raise_error(F.lit("bin edges must be unique")).cast("array<double>")).otherwise(F.col("_e")).alias("_e"))
    rank = F.when(F.col(value) <= F.col("_e")[1], 0)
    for i in range(2, q + 1):
        rank = rank.when(F.col(value) <= F.col("_e")[i], i - 1)
    return df.crossJoin(F.broadcast(checked)).withColumn(out, rank).drop("_e")  # one row is broadcast


def hash_order(key: Column) -> Column:
    """A shuffled order that any engine repeats."""
    return F.md5(key.cast("string"))


def first_in_hash_order(df: DataFrame, limit: Callable[[Column], Column], by: Sequence[str], key: str) -> DataFrame:
    """Of each group the rows that come first in hash order, then by key, as many as ``limit`` says of its number of rows.

    Rows are counted by group and the first three digits of their hashes.  What
    is left of that is a row for each group, the last part that gives rows; only
    that part is ranked, so a group is never sorted in one task.  Rows are read
    twice, so ``df`` that is dear is ``stored`` first.
    """
    hashed = df.withColumn("_h", hash_order(F.col(key))).withColumn("_d", F.substring("_h", 1, 3))
    parts = hashed.groupBy(*by, "_d").agg(F.count("*").alias("_n"))  # at most 4096 rows for each group
    upto = Window.partitionBy(*by).orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    sums = parts.withColumns({"_b": F.coalesce(F.sum("_n").over(upto), F.lit(0)), "_most": limit(F.sum("_n").over(Window.partitionBy(*by)))})
    some = F.when(F.col("_b") + F.col("_n") > F.col("_most"), F.col("_most") - F.col("_b"))
    last = sums.where("_b < _most").groupBy(*by).agg(F.max("_d").alias("_e"), F.max_by(some, "_d").alias("_some"))
    ends = small(last.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(by)], "_e", "_some"))
    met = hashed.join(ends, [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(by)] + [F.col("_d") <= F.col("_e")])
    ranked = (F.col("_d") == F.col("_e")) & F.col("_some").isNotNull()
    order = [F.when(ranked, F.col(c)) for c in ("_h", key)]  # other parts are whole, and need none
    return met.withColumn("_r", F.row_number().over(Window.partitionBy(*by, "_d").orderBy(*order))).where(~ranked | (F.col("_r") <= F.col("_some"))).select(*df.columns)


def sample_fraction(df: DataFrame, fraction: float, by: Sequence[str], key: str = "id") -> DataFrame:
    """In each group the first half-even-rounded ``fraction`` of the rows in hash order."""
    return first_in_hash_order(df, lambda n: F.bround(n * fraction, 0).cast("long"), by, key)


def sample_per_group(df: DataFrame, n: int, by: Sequence[str], key: str) -> DataFrame:
    """In each group the first ``n`` rows in hash order."""
    return first_in_hash_order(df, lambda _: F.lit(n).cast("long"), by, key)


#: Places of a group that meet as many others in a task.
PAIR_BLOCK = 1 << 16
#: Tasks, at least, that pairs of blocks are dealt to: they are few and long, so more tasks than cores even them out.
PAIR_TASKS = 128


def mean_distance(points: DataFrame, by: str = "species", key: str = "id") -> DataFrame:
    """For each point the mean distance to all points of its group, itself included.

    Points are counted by place, and places meet in numpy (``pair_sums``); large
    groups are dealt in blocks, so that no task compares a whole group.  The
    work grows with a group's places, and beyond a block with their number times
    that of its blocks.  A point finds its place by its floats, so ``points`` that are
    dear or that machines may reckon differently are ``stored`` first.
    """
    points = points.select(by, key, F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y")).where(F.col(by).isNotNull())
    placed = F.col("x").isNotNull() & F.col("y").isNotNull()
    places = points.where(placed).groupBy(by, "x", "y").agg(F.count("*").alias("_w"))
    sizes = places.groupBy(by).agg(F.ceil(F.count("*") / F.lit(PAIR_BLOCK)).cast("int").alias("_blocks"), F.sum("_w").alias("_all"))
    met = blocks_met(places, sizes, by, "_w", "_all")

    def meet(held: pa.Table) -> pa.Table:
        order, x, y, _, sums = block_sums(held)
        return pa.table([held[by].take(pa.array(order)), pa.array(x), pa.array(y), pa.array(sums), held["_all"]], names=[by, "x", "y", "_d", "_all"])

    kind = points.schema[by].dataType.simpleString()
    parts = met.groupBy(by, "_p", "_q").applyInArrow(meet, f"`{by}` {kind}, x double, y double, _d double, _all long")
    means = parts.groupBy(by, "x", "y").agg((F.sum("_d") / F.first("_all")).alias("_mean"))
    lost = F.when(placed & F.col("_mean").isNull(), F.raise_error(F.lit("a point's place was reckoned differently; store the points first")).cast("double"))
    return points.join(means, [by, "x", "y"], "left").groupBy(by, key).agg(F.avg(F.coalesce("_mean", lost)).alias("mean_euclidean_dist"))


def group_distance(points: DataFrame, out: str, by: str = "species", key: str = "id") -> DataFrame:
    """For each group the mean of its keys' ``mean_distance``.

    Places meet as they do there, but a pair of blocks gives one number, and no
    point has to find its place again.
    """
    placed = F.col("x").isNotNull() & F.col("y").isNotNull()
    points = points.where(F.col(by).isNotNull()).select(by, key, *[F.when(placed, F.col(c).cast("double")).alias(c) for c in ("x", "y")])
    share = F.when(placed, 1 / F.count("x").over(Window.partitionBy(by, key)))  # points of one key share its part of the mean
    places = stored(points.withColumn("_u", share).groupBy(by, "x", "y").agg(F.count("*").alias("_w"), F.sum("_u").alias("_u")))
    held = lambda c: F.sum(F.when(placed, F.col(c)))
    sizes = small(places.groupBy(by).agg(F.ceil(F.count("x") / F.lit(PAIR_BLOCK)).cast("int").alias("_blocks"), held("_w").alias("_all"), held("_u").alias("_keys")))
    met = blocks_met(places.where(placed), sizes.select(by, "_blocks"), by, "_w", "_u")

    def meet(held: pa.Table) -> pa.Table:
        order, _, _, _, sums = block_sums(held)
        return pa.table([held[by].slice(0, 1), pa.array([float(held["_u"].to_numpy()[order] @ sums)])], names=[by, "_d"])

    kind = points.schema[by].dataType.simpleString()
    totals = met.groupBy(by, "_p", "_q").applyInArrow(meet, f"`{by}` {kind}, _d double").groupBy(by).agg(F.sum("_d").alias("_d"))
    return sizes.join(totals, by, "left").select(by, (F.col("_d") / (F.col("_all") * F.col("_keys"))).alias(out))


def blocks_met(places: DataFrame, sizes: DataFrame, by: str, *more: str) -> DataFrame:
    """Places in blocks ``_i``, each with every block of its group as the pair ``_p, _q``, dealt by pairs; ``sizes`` has ``_blocks`` of a group."""
    dealt = places.join(sizes, by).withColumn("_i", F.pmod(F.xxhash64("x", "y"), F.col("_blocks")).cast("int"))
    met = dealt.select(by, "x", "y", *more, "_i", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_o")).select("*", F.least("_i", "_o").alias("_p"), F.greatest("_i", "_o").alias("_q"))
    tasks = max(int(places.sparkSession.conf.get("spark.sql.shuffle.partitions")), PAIR_TASKS)
    return met.repartition(tasks, by, "_p", "_q")


def block_sums(held: pa.Table) -> tuple[np.ndarray, ...]:
    """The order, x, y, weights and sums of distances of a pair of blocks; the same sums in any order of rows."""
    x, y, w, i, p, q = (held[c].to_numpy() for c in ("x", "y", "_w", "_i", "_p", "_q"))
    order = np.lexsort((y, x, i))
    x, y, w = x[order], y[order], w[order].astype(float)
    return order, x, y, w, pair_sums(x, y, w, 0 if p[0] == q[0] else int(np.count_nonzero(i == p[0])))


def group_numbers(df: DataFrame, by: Sequence[str], order: str, out: str) -> DataFrame:
    """Numbers of groups in the order in which ``order`` first meets them, from 0; over the groups, not the rows."""
    groups = df.groupBy(*by).agg(F.min(order).alias("_first"))
    numbered = groups.withColumn(out, F.dense_rank().over(Window.orderBy("_first")) - 1).drop("_first")
    return df.join(F.broadcast(numbered), list(by))  # at most q * q groups of quantile bins


def semi_species(points: DataFrame, species: DataFrame) -> DataFrame:
    """Points of the listed species."""
    return points.join(species.select("species"), "species", "left_semi")


def pseudo_absences(points: DataFrame, species: DataFrame, candidates: DataFrame, key: str = "id", short: str = "raise") -> DataFrame:
    """For each candidate as many rows of the other species of its bin as it has observations, in hash order, relabelled as its absences.

    ``species`` has ``species, candidate``; ``candidates`` also ``obs``.  Where
    the other species have too few rows, that raises; ``short="keep"`` takes all
    there are.
    """
    others = candidates.select("candidate", F.col("species").alias("target"), "obs").join(species.select("species", "candidate"), "candidate").where(F.col("species") != F.col("target"))
    if short == "raise":
        held = points.groupBy("species").agg(F.count("*").alias("n")).join(others, "species").groupBy("target").agg(F.sum("n").alias("n"))
        missing = candidates.select(F.col("species").alias("target"), "obs").join(held, "target", "left").where(F.coalesce("n", F.lit(0)) < F.col("obs")).limit(5).collect()
        if missing:
            raise ValueError(f"too few rows of other species for the absences of {sorted(r['target'] for r in missing)}")
    elif short != "keep":
        raise ValueError(f"unknown way with too few rows: {short!r}")
    pool = points.join(small(others.select("species", "target", F.col("obs").alias("_obs"))), "species")
    first = first_in_hash_order(pool, lambda _: F.col("_obs"), ["target", "_obs"], key)
    return first.drop("species", "_obs").withColumnRenamed("target", "species").withColumn("status", F.lit("ABSENT"))


def presence_absence(presence: DataFrame, absence: DataFrame) -> DataFrame:
    """Both, by column names."""
    return presence.unionByName(absence, allowMissingColumns=True)
