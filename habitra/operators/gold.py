"""The gold table: feature tables joined by id, with a policy for missing values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The last row of each key in the order of ``seq``."""
    others = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*others), seq).alias("_r")).select(key, "_r.*")


def common_ids(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Ids that stand in every table."""
    return reduce(DataFrame.intersect, [t.select(key) for t in tables])


def combine(tables: Sequence[DataFrame], key: str = "gbifid") -> DataFrame:
    """Inner join of all tables on the id: all are dealt by the same key, so each is shuffled once."""
    return reduce(lambda a, b: a.join(b, key), tables)


def fill(df: DataFrame, how: str | float, columns: Sequence[str]) -> DataFrame:
    """NULL becomes a constant, or the column's mean or median."""
    if isinstance(how, (int, float)):
        return df.fillna(float(how), subset=list(columns))
    if how not in ("mean", "median"):
        raise ValueError(f"unknown fill {how!r}")
    stat = F.avg if how == "mean" else F.median
    stats = df.agg(*[stat(c).alias(f"_{c}") for c in columns])  # one row
    return df.crossJoin(F.broadcast(stats)).withColumns({c: F.coalesce(F.col(c), F.col(f"_{c}")) for c in columns}).drop(*[f"_{c}" for c in columns])


def gold(tables: Sequence[DataFrame], key: str = "gbifid", nans: str = "drop", fill_value: str | float = 0, renames: dict[str, str] | None = None, seq: str | None = None) -> DataFrame:
    """Tables joined on the id; rows with missing values dropped, or filled; columns renamed; with ``seq`` the last row of an id counts."""
    if seq:
        tables = [keep_last(t, key, seq).drop(seq) for t in tables]
    out = combine(tables, key)
    if nans == "drop":
        out = out.na.drop("any", subset=[c for c in out.columns if c != key])
    elif nans == "fill":
        out = fill(out, fill_value, [c for c, t in out.dtypes if c != key and t in ("double", "float", "int", "bigint")])
    return out.withColumnsRenamed(renames or {})


#: Rows of a sample for each range of ``numbered``.
RANGE_SAMPLE = 20


def _range_of(key: Column, bounds: Sequence[Column]) -> Column:
    """How many of the ascending bounds are at most the key, by halving."""

    def between(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key < bounds[mid], between(lo, mid)).otherwise(between(mid + 1, hi))

    return between(0, len(bounds))


def numbered(df: DataFrame, order: Sequence[str], out: str) -> DataFrame:
    """Rows numbered from 0 in an order, nulls first, by ranges: counts of each range, then ranks within, so no task sees all rows.

    The ranges' bounds are values of the table, fixed before both passes, so a
    row's range depends on the row alone.  They come from at most
    ``RANGE_SAMPLE`` rows a range, those with the least hashes.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = df.select(*order)
    sample: list[Row] = keys.orderBy(F.xxhash64(*order)).limit(RANGE_SAMPLE * n).collect()  # bounded by the session's partitions
    kinds = [f.dataType for f in keys.schema]
    local = spark.createDataFrame(sample, keys.schema).orderBy(*order).collect() if sample else []
    cuts = list(dict.fromkeys(tuple(r) for r in local[RANGE_SAMPLE::RANGE_SAMPLE]))
    literal = lambda r: F.struct(*[F.lit(v).cast(k).alias(c) for v, k, c in zip(r, kinds, order)])
    dealt = df.withColumn("_p", _range_of(F.struct(*[F.col(c) for c in order]), [literal(r) for r in cuts]))
    counts = dealt.groupBy("_p").agg(F.count("*").alias("_n"))  # one row for each range
    before = counts.select("_p", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))
    ranked = dealt.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return ranked.join(F.broadcast(before), "_p").withColumn(out, F.col("_r") + F.col("_b") - 1).drop("_p", "_r", "_b")
