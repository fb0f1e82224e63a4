"""Missing values and arithmetic: one missing marker, NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(df: DataFrame) -> DataFrame:
    """Every NaN of the float and double columns becomes NULL, which aggregates skip."""
    kinds = (T.FloatType, T.DoubleType)
    return df.withColumns({f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)) for f in df.schema if isinstance(f.dataType, kinds)})


def safe_div(a: Column, b: Column) -> Column:
    """a / b; NULL where b is zero."""
    return F.try_divide(a, b)


def half_even(value: Column, step: float) -> Column:
    """The nearest multiple of ``step``, halves to the even one."""
    return F.rint(value / F.lit(float(step))) * F.lit(float(step))
