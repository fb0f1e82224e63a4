"""Names and strings."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalise(text: Column, old: str = " ", new: str = "_") -> Column:
    """Trimmed, lower case, ``old`` replaced by ``new``."""
    return F.replace(F.lower(F.trim(text)), F.lit(old), F.lit(new))


def slug(text: Column, most: int | None = None) -> Column:
    """A file name's stem: spaces as underscores, lower case, cut to ``most`` characters."""
    out = F.lower(F.replace(text, F.lit(" "), F.lit("_")))
    return F.substring(out, 1, most) if most else out


def sanitise_columns(df: DataFrame) -> DataFrame:
    """Column names without signs other than letters, digits and underscores."""
    return df.toDF(*[re.sub(r"[^A-Za-z0-9_]+", "", c) for c in df.columns])
