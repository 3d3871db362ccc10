"""Imputation (E1, E2, E4-E7) as fit/transform pairs.

``fit_*`` returns {column: value} -- one number or label per column, found
by distributed aggregates (exact median from the rank primitive; the mode
from a value-count aggregate, never a per-column value map in one task).
``apply_fill`` is a narrow ``coalesce`` projection. Fit on train, apply to
train and test (Q7); ``fit_df=None`` fits on the frame itself.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import nan_to_null, numeric_columns, string_columns
from riskframe.operators import ranks

AT_ONCE = 12  # columns of an aggregate: the JVM compiles no method of many more


def _columns_with_missing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    found = [df.agg(F.array(*[F.count_if(F.col(c).isNull()) for c in columns[s:s + AT_ONCE]]).alias("n")).withColumn("s", F.lit(s))
             for s in range(0, len(columns), AT_ONCE)]
    if not found:
        return []
    missing = {r["s"] + i: n for r in reduce(DataFrame.unionByName, found).collect() for i, n in enumerate(r["n"])}
    return [c for i, c in enumerate(columns) if missing[i] > 0]


def modes(df: DataFrame, columns: Sequence[str], value_type: str = "double") -> dict:
    """Most frequent value per column; ties -> smallest (sorted first)."""
    vc = ranks.to_long(df, columns, value_type=value_type).groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("n"))
    top = vc.groupBy("variable").agg(F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("m"))
    return {r["variable"]: r["m"] for r in top.collect()}


def fit_numeric(df: DataFrame, columns: Sequence[str], strategy: str = "median",
                fill_value: float | None = None) -> dict:
    """E1 fit: mean / median / most_frequent / constant (constant without a
    value is 0, as the original imputer)."""
    cols = list(columns)
    if not cols:
        return {}
    if strategy == "mean":
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(cols)]).first()
        return {c: row[f"v{i}"] for i, c in enumerate(cols)}
    if strategy == "median":
        q = ranks.quantile_map(df, cols, [0.5])
        return {c: q.get((c, 0.5)) for c in cols}
    if strategy == "most_frequent":
        return modes(df, cols)
    if strategy == "constant":
        return {c: (0.0 if fill_value is None else fill_value) for c in cols}
    raise ValueError(f"unknown strategy {strategy}")


def fit_categorical(df: DataFrame, columns: Sequence[str], strategy: str = "most_frequent",
                    fill_value: str = "Unknown") -> dict:
    """E2 fit: the mode (first in sort order among ties) or a constant."""
    cols = list(columns)
    if strategy == "most_frequent":
        return modes(df, cols, value_type="string")
    return {c: fill_value for c in cols}


def apply_fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """E1/E2/E6 transform: coalesce each column with its fitted value."""
    m = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None and c in df.columns}
    return df.withColumns(m) if m else df


def impute_numeric(df: DataFrame, columns: Sequence[str], strategy: str = "median",
                   fill_value: float | None = None, fit_df: DataFrame | None = None) -> DataFrame:
    """Only columns that have missing values are touched."""
    cols = _columns_with_missing(df, [c for c in columns if c in df.columns])
    return apply_fill(df, fit_numeric(fit_df if fit_df is not None else df, cols, strategy, fill_value))


def impute_categorical(df: DataFrame, columns: Sequence[str], strategy: str = "most_frequent",
                       fill_value: str = "Unknown", fit_df: DataFrame | None = None) -> DataFrame:
    """E2."""
    cols = _columns_with_missing(df, [c for c in columns if c in df.columns])
    return apply_fill(df, fit_categorical(fit_df if fit_df is not None else df, cols, strategy, fill_value))


def missing_indicators(df: DataFrame, columns: Sequence[str] | None = None,
                       threshold: float = 0.01) -> DataFrame:
    """``<col>_missing`` 0/1 for listed columns with any null, or (auto)
    for columns whose missing share is >= threshold. One aggregate."""
    cand = list(columns) if columns is not None else list(df.columns)
    row = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cand)]).first()
    n = row["_n"] or 1
    if columns is None:
        pick = [c for i, c in enumerate(cand) if row[f"m{i}"] / n >= threshold and row[f"m{i}"] > 0]
    else:
        pick = [c for i, c in enumerate(cand) if row[f"m{i}"] > 0]
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in pick}) if pick else df


def blank_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """E5: whitespace-only strings become null (all string columns)."""
    cols = list(columns or string_columns(df))
    return df.withColumns({c: F.when(F.col(c).rlike(r"(?U)^\s*$"), None).otherwise(F.col(c)) for c in cols})


def fill_constant(df: DataFrame, column: str, value) -> DataFrame:
    """E.g. unknown region label."""
    return df.fillna({column: value})


def inf_to_null_median_fill(df: DataFrame, columns: Sequence[str] | None = None,
                            exclude: Sequence[str] = (), fit_df: DataFrame | None = None) -> DataFrame:
    """+-inf and NaN -> null on doubles, then every numeric column with
    missing values gets its exact median."""
    cols = list(columns or numeric_columns(df, exclude))
    dbl = [f.name for f in df.schema.fields if f.name in cols and f.dataType.simpleString() in ("double", "float")]
    if dbl:
        df = df.withColumns({c: nan_to_null(c) for c in dbl})
        fit_df = fit_df.withColumns({c: nan_to_null(c) for c in dbl}) if fit_df is not None else None
    return impute_numeric(df, cols, "median", fit_df=fit_df)
