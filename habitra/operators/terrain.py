"""Slope and aspect of elevation grids ``chip, y, x, value`` by 3 x 3 windows; border cells have none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitra.operators.chips import centre_crop_each

def gradients(grid: DataFrame, cell: float = 1.0) -> DataFrame:
    """``chip, y, x, value, dx, dy`` with Horn's weights, for cells whose nine neighbours all have values.

    A row's neighbours come from a window along x; their sums from one along y.
    """
    row = Window.partitionBy("chip", "y").orderBy("x")
    column = Window.partitionBy("chip", "x").orderBy("y")
    at = lambda c, w, k, axis: F.when(F.lag(axis, k).over(w) == F.col(axis) - k, F.lag(c, k).over(w))
    across = grid.select("chip", "y", "x", "value", at("value", row, 1, "x").alias("w"), at("value", row, -1, "x").alias("e"))
    sums = across.select("chip", "y", "x", "value", (F.col("e") - F.col("w")).alias("d"), (F.col("w") + 2 * F.col("value") + F.col("e")).alias("s"))
    up, down = (lambda c: at(c, column, 1, "y")), (lambda c: at(c, column, -1, "y"))
    return sums.select("chip", "y", "x", "value", ((up("d") + 2 * F.col("d") + down("d")) / (8 * cell)).alias("dx"), ((down("s") - up("s")) / (8 * cell)).alias("dy")).where("dx IS NOT NULL AND dy IS NOT NULL")


def slope(dx: Column, dy: Column) -> Column:
    """Degrees from level."""
    return F.degrees(F.atan(F.sqrt(dx * dx + dy * dy)))


def aspect(dx: Column, dy: Column, transform: str | None = None) -> Column:
    """Degrees clockwise from north that a slope faces, -1 where level; ``sin`` or ``cos`` give that plus 1, -1 where level."""
    a = F.degrees(F.atan2(dy, -dx))
    turned = F.when(a < 0, 90.0 - a).when(a > 90, 450.0 - a).otherwise(90.0 - a)
    level = (dx == 0) & (dy == 0)
    if transform is None:
        return F.when(level, -1.0).otherwise(turned)
    if transform not in ("sin", "cos"):
        raise ValueError(f"unknown transform {transform!r}")
    turn = F.sin if transform == "sin" else F.cos
    return F.when(level, -1.0).otherwise(turn(F.radians(turned)) + 1.0)


def features(grid: DataFrame, cell: float = 1.0) -> DataFrame:
    """Means of elevation, slope and northness over the central square of each chip: ``nasadem_{elevation,slope,aspect}_total``.

    Slopes come from the whole chip, so the square's border cells have them where the chip goes on.
    """
    g = gradients(grid, cell).select("chip", "y", "x", "dx", "dy")
    both = centre_crop_each(grid.select("chip", "y", "x", "value").join(g, ["chip", "y", "x"], "left"))
    northness = F.when(F.col("dx").isNotNull(), aspect(F.col("dx"), F.col("dy"), "cos"))
    return both.groupBy("chip").agg(
        F.avg("value").alias("nasadem_elevation_total"), F.avg(slope(F.col("dx"), F.col("dy"))).alias("nasadem_slope_total"), F.avg(northness).alias("nasadem_aspect_total")
    )
