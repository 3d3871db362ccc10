"""Schema, cleaning and outlier operators.

Fitted statistics (quartiles, percentiles) are a few numbers per column:
they are computed by the distributed rank primitive, collected once and
applied as literals, so applying them is a narrow projection.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.core import numeric_columns, string_columns
from riskframe.operators import ranks

# ---------------------------------------------------------------- schema (B)


def standard_name(name: str) -> str:
    """Lower-case words (letters and digits of any script) joined by one '_'."""
    return "_".join(re.findall(r"[^\W_]+", name.lower()))


def standardize_column_names(df: DataFrame) -> DataFrame:
    """B1. Raises when two columns map to the same name."""
    new = [standard_name(c) for c in df.columns]
    if len(set(new)) != len(new):
        raise ValueError(f"column names collide after standardisation: {new}")
    return df.toDF(*new)


def convert_dtypes(df: DataFrame, date_columns: Sequence[str] = (),
                   category_columns: Sequence[str] = (), date_format: str | None = None) -> DataFrame:
    """Lenient date parse (bad -> null) and category -> string; absent
    columns are ignored."""
    present = set(df.columns)
    m = {}
    for c in date_columns:
        if c in present:
            src = F.col(c).cast("string")
            m[c] = (F.try_to_timestamp(src, F.lit(date_format)) if date_format
                    else F.try_to_timestamp(src))
    for c in category_columns:
        if c in present:
            m[c] = F.col(c).cast("string")
    return df.withColumns(m) if m else df


def parse_dates_strict(df: DataFrame, columns: Sequence[str], date_format: str | None = None) -> DataFrame:
    """Strict parse; a bad value fails the job (ANSI ``to_timestamp``)."""
    return df.withColumns({c: (F.to_timestamp(F.col(c), date_format) if date_format
                               else F.to_timestamp(F.col(c))) for c in columns})


def narrow_types(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Declared casts (e.g. tinyint flags), absent columns skipped."""
    m = {c: F.col(c).cast(t) for c, t in casts.items() if c in df.columns}
    return df.withColumns(m) if m else df


def select_by_type(df: DataFrame, kind: str = "numeric", exclude: Sequence[str] = ()) -> DataFrame:
    """Numeric or string columns minus an exclusion list."""
    cols = numeric_columns(df, exclude) if kind == "numeric" else string_columns(df, exclude)
    return df.select(*cols)


def sparse_columns(df: DataFrame, max_missing_share: float = 0.5,
                   columns: Sequence[str] | None = None) -> DataFrame:
    """B7 report: (column, missing_share, dropped) from one null-count agg."""
    cols = list(columns or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.try_divide(F.col(f"m{i}"), F.col("__n")).alias("missing_share"))
        for i, c in enumerate(cols)])).alias("r")).select(
        "r.column", "r.missing_share", (F.col("r.missing_share") > max_missing_share).alias("dropped"))


def drop_sparse_columns(df: DataFrame, max_missing_share: float = 0.5) -> DataFrame:
    """Drop columns whose missing share is strictly above the limit."""
    rep = sparse_columns(df, max_missing_share).filter("dropped").select("column").collect()
    return df.drop(*[r[0] for r in rep])


def feature_projection(df: DataFrame, keep: Sequence[str], features: Sequence[str] | None = None,
                       exclude: Sequence[str] = ()) -> DataFrame:
    """ids/target + chosen features (default: all minus exclusions)."""
    feats = list(features) if features is not None else [
        c for c in df.columns if c not in set(keep) | set(exclude)]
    return df.select(*keep, *[c for c in feats if c not in keep])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """B9."""
    return df.withColumnsRenamed(dict(mapping))


def add_date_parts(df: DataFrame, date_col: str = "DATE_MONTH") -> DataFrame:
    """YEAR (smallint), MONTH (tinyint)."""
    return df.withColumns({"YEAR": F.year(date_col).cast("smallint"),
                           "MONTH": F.month(date_col).cast("tinyint")})


def schema_table(df: DataFrame) -> DataFrame:
    """(position, column, type) as a small table."""
    spark = df.sparkSession
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column string, type string, nullable boolean")


# -------------------------------------------------------------- filters (C)


def temporal_split(df: DataFrame, date_col: str, cutoff: str) -> tuple[DataFrame, DataFrame]:
    """``< cutoff`` train, ``>= cutoff`` test (prunes month partitions)."""
    cut = F.to_timestamp(F.lit(cutoff))
    return df.filter(F.col(date_col) < cut), df.filter(F.col(date_col) >= cut)


def class_filter(df: DataFrame, target: str, value) -> DataFrame:
    """C2."""
    return df.filter(F.col(target) == value)


def range_counts(df: DataFrame, column: str, lo=None, hi=None) -> DataFrame:
    """Strict counts below/above; missing never matches."""
    return df.agg(
        (F.count_if(F.col(column) < lo) if lo is not None else F.lit(0)).cast("long").alias("n_below"),
        (F.count_if(F.col(column) > hi) if hi is not None else F.lit(0)).cast("long").alias("n_above"))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """C4."""
    return df.dropna(subset=list(columns))


def is_blank(col: str):
    """Whitespace-only string predicate."""
    return F.col(col).rlike(r"(?U)^\s*$")


def min_group_size(df: DataFrame, group: Sequence[str], min_size: int = 5) -> DataFrame:
    """Keep rows of groups with at least ``min_size`` rows (agg + join on
    the group key; the group table is small after the partial aggregate)."""
    sizes = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_gs")).filter(F.col("_gs") >= min_size)
    return df.join(sizes.drop("_gs"), list(group), "left_semi")


# ------------------------------------------------------ duplicates


def remove_duplicates(df: DataFrame, subset: Sequence[str] | None = None, keep="first",
                      order_by: Sequence[str] | None = None) -> DataFrame:
    """Keep the first / last copy in ``order_by`` order, or no copy.

    Uses aggregates, not a window: ``min_by``/``max_by`` over the key is a
    partial aggregate, so a key holding a third of the table is combined on
    the map side instead of sorted in one task.
    """
    keys = list(subset or df.columns)
    if keep is False:
        others = [c for c in df.columns if c not in keys]
        agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                    *[F.first(c).alias(c) for c in others])
        return agg.filter(F.col("_n") == 1).select(*df.columns)
    if not order_by:
        if keep == "last":
            raise ValueError("keep='last' needs order_by: rows of a distributed table have no order of their own")
        return df.dropDuplicates(keys)
    others = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in others])
    ordk = F.struct(*[F.col(c) for c in order_by])
    pick = F.min_by(row, ordk) if keep == "first" else F.max_by(row, ordk)
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*").select(*df.columns)


# ---------------------------------------------------------- outliers


def iqr_bounds(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5) -> dict:
    """{column: (q1, q3, lower, upper)} with exact quartiles."""
    q = ranks.quantile_map(df, columns, [0.25, 0.75])
    out = {}
    for c in columns:
        q1, q3 = q.get((c, 0.25)), q.get((c, 0.75))
        if q1 is None:
            out[c] = (None, None, None, None)
            continue
        iqr = q3 - q1
        out[c] = (q1, q3, q1 - multiplier * iqr, q3 + multiplier * iqr)
    return out


def detect_outliers_iqr(df: DataFrame, column: str, multiplier: float = 1.5,
                        flag_col: str | None = None) -> DataFrame:
    """D3: adds a boolean ``<column>_outlier``: strictly outside the fences;
    missing values are not outliers."""
    _, _, lo, hi = iqr_bounds(df, [column], multiplier)[column]
    name = flag_col or f"{column}_outlier"
    if lo is None:
        return df.withColumn(name, F.lit(False))
    x = F.col(column)
    return df.withColumn(name, F.coalesce((x < lo) | (x > hi), F.lit(False)))


def outlier_report(df: DataFrame, columns: Sequence[str], multiplier: float = 1.5,
                   min_pct: float = 1.0) -> DataFrame:
    """Column, count, pct, lower_bound, upper_bound, min, max (rounded to
    2) for columns whose outlier share is above ``min_pct`` percent.
    One quantile pass + one conditional-count aggregate for all columns."""
    b = iqr_bounds(df, columns, multiplier)
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(columns):
        _, _, lo, hi = b[c]
        x = F.col(c)
        cond = (x < lo) | (x > hi) if lo is not None else F.lit(False)
        aggs += [F.count_if(cond).alias(f"o{i}"), F.min(x.cast("double")).alias(f"mn{i}"),
                 F.max(x.cast("double")).alias(f"mx{i}")]
    wide = df.agg(*aggs)
    rows = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"o{i}").cast("long").alias("count"),
                 (F.try_divide(F.col(f"o{i}"), F.col("__n")) * 100).alias("pct"),
                 F.lit(b[c][2]).cast("double").alias("lower_bound"),
                 F.lit(b[c][3]).cast("double").alias("upper_bound"),
                 F.col(f"mn{i}").alias("min"), F.col(f"mx{i}").alias("max"))
        for i, c in enumerate(columns)])).alias("r")).select("r.*")
    return rows.filter(F.col("pct") > min_pct).select(
        "column", "count", F.round("pct", 2).alias("pct"), F.round("lower_bound", 2).alias("lower_bound"),
        F.round("upper_bound", 2).alias("upper_bound"), F.round("min", 2).alias("min"),
        F.round("max", 2).alias("max")).orderBy(F.col("pct").desc(), "column")


def fit_caps(df: DataFrame, columns: Sequence[str], lower: float = 0.01,
             upper: float = 0.99) -> dict:
    """D5/D6 fit: {column: (p_lower, p_upper)} exact percentiles."""
    q = ranks.quantile_map(df, columns, [lower, upper])
    return {c: (q.get((c, round(lower, 12))), q.get((c, round(upper, 12)))) for c in columns}


def apply_caps(df: DataFrame, caps: Mapping[str, tuple]) -> DataFrame:
    """D5/D6 transform: clip to the fitted bounds; missing stays missing."""
    m = {}
    for c, (lo, hi) in caps.items():
        if lo is None:
            continue
        x = F.col(c)
        m[c] = F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))
    return df.withColumns(m) if m else df


def cap_outliers(df: DataFrame, column: str, lower_percentile: float = 0.01,
                 upper_percentile: float = 0.99) -> DataFrame:
    """Clip one column to its own percentiles."""
    return apply_caps(df, fit_caps(df, [column], lower_percentile, upper_percentile))


def winsorize(df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99,
              fit_df: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Clip every listed column; returns (clipped frame, report).

    Report: column, p_low, p_high, n_low, n_high (counts strictly beyond the
    bounds before clipping), in one aggregate. ``fit_df`` fits on another
    frame (train) and applies here (Q7 leak fix).
    """
    caps = fit_caps(fit_df if fit_df is not None else df, columns, lower, upper)
    aggs = []
    for i, c in enumerate(columns):
        lo, hi = caps[c]
        aggs += [F.count_if(F.col(c) < lo).alias(f"l{i}"), F.count_if(F.col(c) > hi).alias(f"h{i}")]
    wide = df.agg(*aggs)
    report = wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(caps[c][0]).cast("double").alias("p_low"),
                 F.lit(caps[c][1]).cast("double").alias("p_high"),
                 F.col(f"l{i}").cast("long").alias("n_low"), F.col(f"h{i}").cast("long").alias("n_high"))
        for i, c in enumerate(columns)])).alias("r")).select("r.*")
    return apply_caps(df, caps), report


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("annotations", "re", "F", "T")]
