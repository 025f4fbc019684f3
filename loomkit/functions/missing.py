"""Missing-value semantics: NULL everywhere, and NaN on float columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def is_float(dt: DataType) -> bool:
    return isinstance(dt, (DoubleType, FloatType))


def as_missing(col: Column, dt: DataType) -> Column:
    """NaN becomes NULL on float types, so counts treat it as missing."""
    if is_float(dt):
        return F.when(F.isnan(col), F.lit(None)).otherwise(col)
    return col
