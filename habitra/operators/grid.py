"""Adaptive grids: cells that hold too many points are halved on both axes.

All depths of a point's path are arithmetic, so the grid takes one count over
(depth, path) pairs instead of a loop over cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARGIN = 1e-4


def depth_of(cell: float, min_area: float) -> int:
    """Halvings until a cell's area is at most ``min_area``."""
    depth = 0
    while cell * cell > min_area:
        cell, depth = cell / 2, depth + 1
    return depth


def cell_key(value: Column, origin: Column, step: float) -> Column:
    """Index of the cell (lo, hi] that holds a value."""
    return (F.ceil((value - origin) / F.lit(step)) - 1).cast("long")


def paths(points: DataFrame, cell: float = 0.1, min_area: float = 1e-4) -> DataFrame:
    """Points with ``paths``: the cell's name at each depth, ``i_j`` then ``__ab`` for each halving."""
    origin = points.agg((F.min("lon") - MARGIN).alias("_lon0"), (F.min("lat") - MARGIN).alias("_lat0"))
    u = points.crossJoin(F.broadcast(origin)).withColumns({"_u": (F.col("lon") - F.col("_lon0")) / cell, "_v": (F.col("lat") - F.col("_lat0")) / cell})  # one row is broadcast
    i, j = F.ceil("_u") - 1, F.ceil("_v") - 1
    name = F.concat(i.cast("string"), F.lit("_"), j.cast("string"))
    names, fu, fv = [name], F.col("_u") - i, F.col("_v") - j
    for _ in range(depth_of(cell, min_area)):
        a, b = (fu > 0.5).cast("int"), (fv > 0.5).cast("int")
        name = F.concat(name, F.lit("__"), a.cast("string"), b.cast("string"))
        names.append(name)
        fu, fv = 2 * fu - a, 2 * fv - b
    return u.withColumn("paths", F.array(*names)).drop("_lon0", "_lat0", "_u", "_v")


def adaptive(points: DataFrame, cell: float = 0.1, min_area: float = 1e-4, most: int = 50_000) -> DataFrame:
    """Points with ``cell``: the shallowest cell of at most ``most`` points, or the deepest reached.

    Halving ends early at the first depth from 2 on where the cells above
    ``most`` don't hold fewer points on average than a depth before.
    """
    deep = depth_of(cell, min_area)
    held = paths(points, cell, min_area)
    cells = held.groupBy("paths").agg(F.count("*").alias("n"))  # the deepest cells; the upper ones are summed from them
    counts = cells.select("n", F.posexplode("paths").alias("depth", "path")).groupBy("depth", "path").agg(F.sum("n").alias("n"))
    over = counts.where(F.col("n") > most)
    means = over.groupBy("depth").agg(F.avg("n").alias("m"))
    one = means.agg(F.map_from_entries(F.collect_list(F.struct("depth", "m"))).alias("by"))  # one entry for each depth
    at = lambda d: F.try_element_at(F.col("by"), F.lit(d))
    stop = F.coalesce(*[F.when(at(t) >= at(t - 1), t) for t in range(2, deep + 1)], F.lit(deep)) if deep >= 2 else F.lit(deep)
    cap = one.select(stop.alias("_cap"))
    # cells that are too full and may be halved, by their top cell: at most 4 ** depth to each, and their points go on
    full = over.crossJoin(F.broadcast(cap)).where(F.col("depth") < F.col("_cap"))
    tops = full.groupBy(F.substring_index("path", "__", 1).alias("_top")).agg(F.collect_set("path").alias("_full"))
    below = held.withColumn("_top", F.get("paths", F.lit(0))).join(tops, "_top", "left")
    stays = F.filter("paths", lambda p: ~F.coalesce(F.array_contains(F.col("_full"), p), F.lit(False)))
    return below.select(*points.columns, F.get(stays, F.lit(0)).alias("cell"))


def resume(work: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """The work whose keys aren't done."""
    return work.join(done.select(*keys), keys, "left_anti")
