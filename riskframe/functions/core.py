"""Null-safe column helpers shared by every operator.

Missing values follow the pandas conventions of the original analysis:
a comparison with a missing operand is False, a division by zero is missing,
row statistics skip missing cells.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                 T.FloatType, T.DoubleType, T.DecimalType)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(cond: Column, dtype: str = "tinyint") -> Column:
    """Boolean -> 0/1 where a missing comparison counts as False."""
    return F.coalesce(cond, F.lit(False)).cast(dtype)


def safe_div(num, den) -> Column:
    """num / den, missing when den is 0 or missing (pandas inf -> NaN)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def nan_to_null(c) -> Column:
    """NaN and +-inf become null; Spark treats NaN as a value otherwise."""
    x = _c(c).cast("double")
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def row_mean(cols: Sequence) -> Column:
    """Mean of the non-null cells of a row, null if all are missing."""
    cs = [_c(c).cast("double") for c in cols]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cs[1:]), F.coalesce(cs[0], F.lit(0.0)))
    m = sum((c.isNotNull().cast("int") for c in cs[1:]), cs[0].isNotNull().cast("int"))
    return F.when(m > 0, total / m)


def row_std(cols: Sequence, ddof: int = 1) -> Column:
    """Sample std (ddof 1) over the non-null cells of a row, two-pass form."""
    cs = [_c(c).cast("double") for c in cols]
    mean = row_mean(cs)
    m = sum((c.isNotNull().cast("int") for c in cs[1:]), cs[0].isNotNull().cast("int"))
    sq = sum((F.coalesce((c - mean) * (c - mean), F.lit(0.0)) for c in cs[1:]),
             F.coalesce((cs[0] - mean) * (cs[0] - mean), F.lit(0.0)))
    return F.when(m > ddof, F.sqrt(sq / (m - ddof)))


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES) and not isinstance(dt, T.BooleanType)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric_type(f.dataType) and f.name not in ex]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    ex = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.StringType) and f.name not in ex]
