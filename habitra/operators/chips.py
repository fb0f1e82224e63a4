"""Raster chips in long form: ``chip, ts, band, y, x, value``; aggregation in space, then in time.

Columns other than those named are left out.  NULL values are missing pixels;
callers turn NaN to NULL first (``functions.nulls.nan_to_null``).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from habitra.functions.aggs import aggregate

SEASONS = ("s_jfm", "s_amj", "s_jas", "s_ond")
MONTHS = tuple(f"m_{i}" for i in range(1, 13))
SLICES = ("total", "yearly", "seasonal", "monthly")


def spatial_aggregate(pixels: DataFrame, how: str) -> DataFrame:
    """One value for each chip, time and band."""
    return pixels.groupBy("chip", "ts", "band").agg(aggregate(how, F.col("value")).alias("value"))


def temporal_aggregate(series: DataFrame, how: str, by: Sequence[str] = ("chip", "band")) -> DataFrame:
    """One value for each chip and band (and slice, if asked for) over time."""
    return series.groupBy(*by).agg(aggregate(how, F.col("value")).alias("value"))


def slice_names(kind: str, years: int | None = None) -> tuple[str, ...]:
    """The names of a slicing's parts in order; a yearly one needs the number of years."""
    if kind == "total":
        return ("total",)
    if kind == "seasonal":
        return SEASONS
    if kind == "monthly":
        return MONTHS
    if kind == "yearly" and years:
        return tuple(f"y_{i}" for i in range(1, years + 1))
    raise ValueError(f"unknown slicing {kind!r}; known: {', '.join(SLICES)}")


def slice_of(kind: str, ts: Column) -> Column:
    """The part that a time falls in."""
    if kind == "total":
        return F.lit("total")
    if kind == "seasonal":
        return F.element_at(F.array(*map(F.lit, SEASONS)), F.quarter(ts))
    if kind == "monthly":
        return F.concat(F.lit("m_"), F.month(ts).cast("string"))
    if kind == "yearly":
        years = Window.partitionBy("chip").orderBy(F.year(ts))
        return F.concat(F.lit("y_"), F.dense_rank().over(years).cast("string"))
    raise ValueError(f"unknown slicing {kind!r}; known: {', '.join(SLICES)}")


def sliced(series: DataFrame, kind: str, how: str, names: Sequence[str] | None = None, contiguous: bool = False) -> DataFrame:
    """``chip, band, slice, value``, dense: a part without data has NULL.

    The parts are spread by conditional aggregates in the one shuffle by chip
    and band.  Yearly parts need ``names`` to be dense; without them only parts
    with data are given.  ``contiguous`` takes all times from the first to the
    last one of a season, whatever lies between.
    """
    if kind == "yearly" and names is None:
        return temporal_aggregate(series.withColumn("slice", slice_of(kind, F.col("ts"))), how, ("chip", "band", "slice"))
    names = names or slice_names(kind)
    marked = series.withColumn("slice", slice_of(kind, F.col("ts")))
    if contiguous:
        chip = Window.partitionBy("chip")
        within = [F.col("ts").between(F.min(F.when(F.col("slice") == n, F.col("ts"))).over(chip), F.max(F.when(F.col("slice") == n, F.col("ts"))).over(chip)) for n in names]
        marked = marked.withColumns({f"in_{i}": w for i, w in enumerate(within)})
        member = [F.col(f"in_{i}") for i in range(len(names))]
    else:
        member = [F.col("slice") == n for n in names]
    empty = [F.max(m) for m in member]
    wide = marked.groupBy("chip", "band").agg(*[F.when(F.coalesce(e, F.lit(False)), aggregate(how, F.when(m, F.col("value")))).alias(n) for n, m, e in zip(names, member, empty)])
    return wide.unpivot(["chip", "band"], list(names), "slice", "value")


def features(pixels: DataFrame, name: str, spatial: str, temporal: str, kind: str, bands: Sequence[str]) -> DataFrame:
    """The wide feature row of each chip: ``chip`` and ``{name}_{band}_{slice}`` for the given bands, so the schema is fixed."""
    series = spatial_aggregate(pixels.where(F.col("band").isin(*bands)), spatial)
    marked = series.withColumn("slice", slice_of(kind, F.col("ts")))
    columns = []
    for band in bands:
        for part in slice_names(kind):
            here = (F.col("band") == band) & (F.col("slice") == part)
            columns.append(F.when(F.coalesce(F.max(here), F.lit(False)), aggregate(temporal, F.when(here, F.col("value")))).alias(f"{name}_{band}_{part}"))
    return marked.groupBy("chip").agg(*columns)


def perc_total(pixels: DataFrame, bins: dict[int, str], order: Sequence[str], threshold: float = 0.05) -> DataFrame:
    """``chip, ts, band, value``: the share of all pixels in each bin as a band; NULL for a scene whose missing share reaches ``threshold``."""
    missing = F.count_if(F.col("value").isNull()) / F.count("*")
    shares = [F.when(missing < threshold, F.count_if(F.col("value").isin(*[k for k, b in bins.items() if b == name])) / F.count("*")).alias(name) for name in order]
    return pixels.groupBy("chip", "ts").agg(*shares).unpivot(["chip", "ts"], list(order), "band", "value")


def nodata_mask(pixels: DataFrame, band: str = "soc0_100", limit: float = -9000) -> DataFrame:
    """Pixels, all bands, of places where ``band`` is above ``limit``; dealt by scene, as ``spatial_aggregate`` needs them."""
    place = Window.partitionBy("chip", "ts", "y", "x")
    return pixels.repartition("chip", "ts").withColumn("_test", F.max(F.when(F.col("band") == band, F.col("value"))).over(place)).where(F.col("_test") > limit).drop("_test")


def apply_mask(pixels: DataFrame, band: str, cloudy) -> DataFrame:
    """The other bands, NULL where ``cloudy`` of the mask band's value at the same place holds or is missing; dealt by scene."""
    place = Window.partitionBy("chip", "ts", "y", "x")
    seen = F.max(F.when(F.col("band") == band, F.col("value"))).over(place)
    return pixels.repartition("chip", "ts").withColumn("_mask", seen).where(F.col("band") != band).withColumn("value", F.when(~cloudy(F.col("_mask")), F.col("value"))).drop("_mask")


def range_join(points: DataFrame, pixels: DataFrame, buffer: float) -> DataFrame:
    """Pixels within ``buffer`` of each point on both axes, borders included: cells of that size as keys, each point asking those from its lower to its upper ends."""
    cell = lambda c: F.floor(c / F.lit(float(buffer))).cast("long")
    keyed = pixels.withColumns({"_cx": cell(F.col("x")), "_cy": cell(F.col("y"))})
    near = lambda c: F.explode(F.sequence(cell(F.col(c) - buffer), cell(F.col(c) + buffer)))
    asked = points.select("*", near("px").alias("_cx")).select("*", near("py").alias("_cy"))
    close = F.col("x").between(F.col("px") - buffer, F.col("px") + buffer) & F.col("y").between(F.col("py") - buffer, F.col("py") + buffer)
    return asked.join(keyed, ["_cx", "_cy"]).where(close).drop("_cx", "_cy")


#: Places, or points, of a tile that meet in a task.
TILE_BLOCK = 1 << 18


def range_totals(points: DataFrame, pixels: DataFrame, buffer: float, key: str = "point", value: str = "pixel") -> DataFrame:
    """``key, n, total``: number of the pixels that ``range_join`` gives to a key, and sum of their whole-number ``value``, without making the pairs.

    Pixels are added up by place and copied to the tiles (four buffers wide)
    whose points may reach them, so a point asks one tile; there a wavelet
    matrix gives a box in logarithmic time.  Large tiles are dealt in blocks,
    points against places; only between these the work grows with the square.
    """
    tile = lambda c: F.floor(c / F.lit(4.0 * buffer))
    # a little more than the buffer, for what rounding adds; borders are tested exactly later
    reach = lambda c: F.lit(float(buffer)) + (F.abs(c) + F.lit(float(buffer))) * F.lit(1e-12)
    tiles = lambda c: F.explode(F.sequence(tile(F.col(c) - reach(F.col(c))), tile(F.col(c) + reach(F.col(c)))))
    places = pixels.where("x IS NOT NULL AND y IS NOT NULL").groupBy("x", "y").agg(F.count("*").alias("_n"), F.count(value).alias("_m"), F.coalesce(F.sum(F.col(value).cast("long")), F.lit(0)).alias("_v"))
    spread = places.select("*", tiles("x").alias("_tx")).select("*", tiles("y").alias("_ty"))
    asked = points.where("px IS NOT NULL AND py IS NOT NULL").select(key, F.col("px").cast("double"), F.col("py").cast("double"), tile(F.col("px")).alias("_tx"), tile(F.col("py")).alias("_ty"))
    count = lambda df, name: df.groupBy("_tx", "_ty").agg(F.ceil(F.count("*") / F.lit(TILE_BLOCK)).cast("int").alias(name))
    sizes = count(spread, "_bi").join(count(asked, "_bj"), ["_tx", "_ty"])
    deal = lambda df, own, columns, other: df.join(sizes, ["_tx", "_ty"]).select(
        *df.columns, F.pmod(F.xxhash64(*columns), F.col(f"_b{own}")).cast("int").alias(f"_{own}"), F.explode(F.sequence(F.lit(0), F.col(f"_b{other}") - 1)).alias(f"_{other}")
    )
    meet = ["_tx", "_ty", "_i", "_j"]
    kind = points.select(key).schema[0].dataType.simpleString()
    met = deal(asked, "j", [key, "px", "py"], "i").groupBy(*meet).cogroup(deal(spread.withColumns({c: F.col(c).cast("double") for c in "xy"}), "i", ["x", "y"], "j").groupBy(*meet))

    def totals(asking: pa.Table, held: pa.Table) -> pa.Table:
        at = np.empty(asking.num_rows, np.complex128)
        at.real, at.imag = asking["px"].to_numpy(), asking["py"].to_numpy()
        at, back = np.unique(at, return_inverse=True)
        x, y, *sums = (held[c].to_numpy() for c in ("x", "y", "_n", "_m", "_v"))
        n, m, v = box_sums(x, y, sums, at.real - buffer, at.real + buffer, at.imag - buffer, at.imag + buffer)
        return pa.table([asking[key], pa.array(n[back]), pa.array(m[back]), pa.array(v[back])], names=[key, "n", "m", "v"])

    parts = met.applyInArrow(totals, f"`{key}` {kind}, n long, m long, v long").where("n > 0")
    return parts.groupBy(key).agg(F.sum("n").alias("n"), F.when(F.sum("m") > 0, F.sum("v")).alias("total"))


def box_sums(x: np.ndarray, y: np.ndarray, sums: Sequence[np.ndarray], x0: np.ndarray, x1: np.ndarray, y0: np.ndarray, y1: np.ndarray) -> list[np.ndarray]:
    """Sums of each of ``sums`` over the places in boxes, borders included: a wavelet matrix of the ranks in y, in order of x, a level at a time."""
    order = np.argsort(x, kind="stable")
    by_y = np.argsort(y, kind="stable")
    rank = np.empty(len(x), np.int64)
    rank[by_y] = np.arange(len(x))
    rank, sums = rank[order], [np.asarray(s, np.int64)[order] for s in sums]
    across, up = x[order], y[by_y]
    first, last = np.searchsorted(across, x0, "left"), np.searchsorted(across, x1, "right")
    # places between first and last of a rank below the upper end, less those of a rank below the lower end
    first, last, below = np.tile(first, 2), np.tile(last, 2), np.concatenate([np.searchsorted(up, y1, "right"), np.searchsorted(up, y0, "left")])
    out = [np.zeros(len(below), np.int64) for _ in sums]
    for bit in range(len(x).bit_length() - 1, -1, -1):
        one = (rank >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~one)])
        right = (below >> bit & 1).astype(bool)
        a, b = zeros[first], zeros[last]
        left = np.flatnonzero(~one)
        turned = np.concatenate([left, np.flatnonzero(one)])
        for total, s in zip(out, sums):
            upto = np.concatenate([[0], np.cumsum(s[left])])
            total += np.where(right, upto[b] - upto[a], 0)
        first, last = np.where(right, len(left) + first - a, a), np.where(right, len(left) + last - b, b)
        rank, sums = rank[turned], [s[turned] for s in sums]
    half = len(x0)
    return [t[:half] - t[half:] for t in out]


def centre_crop(pixels: DataFrame, height: int, width: int) -> DataFrame:
    """The square of the shorter side around the centre; one row or column longer where the sides' parity differs."""
    side = min(height, width)
    dy, dx = (height - side) // 2, (width - side) // 2
    return pixels.where(F.col("y").between(dy, height - dy - 1) & F.col("x").between(dx, width - dx - 1))


def centre_crop_each(pixels: DataFrame) -> DataFrame:
    """The same for chips of any sizes, each by its own height and width, counted from its least row and column."""
    sides = pixels.groupBy("chip").agg(F.min("y").alias("_y"), F.min("x").alias("_x"), (F.max("y") - F.min("y") + 1).alias("_h"), (F.max("x") - F.min("x") + 1).alias("_w"))
    cut = lambda n: F.floor((F.col(n) - F.least("_h", "_w")) / 2)
    within = lambda c, low, n: (F.col(c) - F.col(low)).between(cut(n), F.col(n) - cut(n) - 1)
    return pixels.join(sides, "chip").where(within("y", "_y", "_h") & within("x", "_x", "_w")).drop("_y", "_x", "_h", "_w")


def resample(pixels: DataFrame, step: float, to: float) -> DataFrame:
    """Pixels of a regular grid (``x, y`` are centres, ``step`` apart) at the centres of a grid of step ``to``: the value of the pixel that a centre lies in.

    Both grids start at 0; a finer target repeats values, a coarser one leaves some out.
    """
    first = lambda c: F.ceil((F.col(c) - step / 2) / to - 0.5).cast("long")
    last = lambda c: (F.ceil((F.col(c) + step / 2) / to - 0.5) - 1).cast("long")
    centres = lambda c: F.explode(F.when(first(c) <= last(c), F.sequence(first(c), last(c))))
    out = pixels.withColumn("_i", centres("x")).withColumn("_j", centres("y"))
    return out.withColumns({"x": (F.col("_i") + 0.5) * to, "y": (F.col("_j") + 0.5) * to}).drop("_i", "_j")


def nearest_box(pixels: DataFrame, box: tuple[float, float, float, float], margin: int = 0) -> DataFrame:
    """Pixels from the coordinates nearest to the box' lower ends to before those nearest to its upper ends, on both axes.

    Spans of fewer than five steps are widened by one on both sides, then all
    by the margin; the grid's ends bound both.  Of two coordinates that are
    equally near the lesser one counts.  The axes, not the pixels, are numbered.
    """
    out = pixels
    for axis, low, high in (("x", box[0], box[2]), ("y", box[1], box[3])):
        places = pixels.select(F.col(axis).alias("_v")).distinct().withColumn("_i", F.row_number().over(Window.orderBy("_v")) - 1)
        near = lambda v: F.min_by("_i", F.struct(F.abs(F.col("_v") - F.lit(v)), "_v"))
        ends = places.agg(near(low).alias("_a"), near(high).alias("_b"))  # one row
        wide = F.when(F.col("_b") - F.col("_a") < 5, margin + 1).otherwise(margin)
        taken = places.crossJoin(F.broadcast(ends)).where((F.col("_i") >= F.col("_a") - wide) & (F.col("_i") < F.col("_b") + wide)).select("_v")
        out = out.join(taken, F.col(axis) == F.col("_v"), "left_semi")
    return out


def centre_subset(pixels: DataFrame, height: int, width: int, share: float, compat: bool = False) -> DataFrame:
    """The central ``share`` of each side; with ``compat`` that share is cut off instead of kept."""
    cut = (share if compat else 1 - share) / 2
    dy, dx = int(height * cut + 1e-9), int(width * cut + 1e-9)
    return pixels.where(F.col("y").between(dy, height - dy - 1) & F.col("x").between(dx, width - dx - 1))
