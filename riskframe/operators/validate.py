"""Validation reports (D10-D13, D22, D24). Each is one aggregate job whose
result is a few (check, ...) rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHECK_SCHEMA = "check string, status string, detail string"


def validate_target(df: DataFrame, target: str = "TARGET", min_minority_pct: float = 10.0) -> DataFrame:
    """(check, status, detail) rows.

    missing column -> error; values outside {0, 1} -> error; nulls -> warning;
    minority share among non-null rows below ``min_minority_pct`` -> warning.
    """
    spark = df.sparkSession
    if target not in df.columns:
        return spark.createDataFrame([("target_present", "error", f"column {target} not found")],
                                     CHECK_SCHEMA)
    y = F.col(target)
    a = df.agg(F.count_if(y.isNotNull() & ~y.isin(0, 1)).alias("bad"),
               F.count_if(y.isNull()).alias("nulls"),
               F.count_if(y == 0).alias("n0"), F.count_if(y == 1).alias("n1"))
    minority = F.try_divide(F.least("n0", "n1") * 100.0, F.col("n0") + F.col("n1"))
    rows = F.array(
        F.struct(F.lit("binary_values").alias("check"),
                 F.when(F.col("bad") > 0, "error").otherwise("ok").alias("status"),
                 F.concat(F.lit("non-binary values: "), F.col("bad").cast("string")).alias("detail")),
        F.struct(F.lit("missing_target").alias("check"),
                 F.when(F.col("nulls") > 0, "warning").otherwise("ok").alias("status"),
                 F.concat(F.lit("missing: "), F.col("nulls").cast("string")).alias("detail")),
        F.struct(F.lit("class_balance").alias("check"),
                 F.when(minority < min_minority_pct, "warning").otherwise("ok").alias("status"),
                 F.concat(F.lit("minority %: "), F.format_number(minority, 1)).alias("detail")))
    return a.select(F.explode(rows).alias("r")).select("r.*")


def validate_numeric_ranges(df: DataFrame, rules: Mapping[str, tuple]) -> DataFrame:
    """Column, min, max, n_below_min, n_above_max, valid for every
    (min, max) rule (None = open side) in one aggregate. Absent columns are
    reported invalid."""
    present = [c for c in rules if c in df.columns]
    aggs = []
    for i, c in enumerate(present):
        lo, hi = rules[c]
        x = F.col(c)
        aggs += [F.min(x.cast("double")).alias(f"mn{i}"), F.max(x.cast("double")).alias(f"mx{i}"),
                 (F.count_if(x < lo) if lo is not None else F.lit(0)).cast("long").alias(f"b{i}"),
                 (F.count_if(x > hi) if hi is not None else F.lit(0)).cast("long").alias(f"a{i}")]
    items = [F.struct(F.lit(c).alias("column"), F.col(f"mn{i}").alias("min"), F.col(f"mx{i}").alias("max"),
                      F.col(f"b{i}").alias("n_below_min"), F.col(f"a{i}").alias("n_above_max"),
                      ((F.col(f"b{i}") + F.col(f"a{i}")) == 0).alias("valid"))
             for i, c in enumerate(present)]
    missing = [c for c in rules if c not in df.columns]
    items += [F.struct(F.lit(c).alias("column"), F.lit(None).cast("double").alias("min"),
                       F.lit(None).cast("double").alias("max"), F.lit(None).cast("long").alias("n_below_min"),
                       F.lit(None).cast("long").alias("n_above_max"), F.lit(False).alias("valid"))
              for c in missing]
    base = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("_n"))
    return base.select(F.explode(F.array(*items)).alias("r")).select("r.*")


def validate_no_leakage(df: DataFrame, date_col: str = "DATE_MONTH",
                        train_end_date: str | None = None) -> DataFrame:
    """Date range; with a cut, training rows past it make it invalid
    (the original accepted the cut but never used it)."""
    d = F.col(date_col)
    after = (F.count_if(d > F.to_timestamp(F.lit(train_end_date))) if train_end_date
             else F.lit(0)).cast("long")
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                  after.alias("n_after_cut")).withColumn("valid", F.col("n_after_cut") == 0)


def run_all_validations(df: DataFrame, target: str = "TARGET", date_col: str = "DATE_MONTH") -> DataFrame:
    """Shape, target checks and date range as (check, status, detail)
    rows, plus an ``all_valid`` row (no error anywhere)."""
    shape = df.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("shape").alias("check"), F.lit("ok").alias("status"),
        F.concat(F.col("n").cast("string"), F.lit(" x "), F.lit(str(len(df.columns)))).alias("detail"))
    tgt = validate_target(df, target)
    if date_col in df.columns:
        dates = validate_no_leakage(df, date_col).select(
            F.lit("date_range").alias("check"), F.lit("ok").alias("status"),
            F.concat(F.col("min_date").cast("string"), F.lit(" .. "),
                     F.col("max_date").cast("string")).alias("detail"))
    else:
        dates = df.sparkSession.createDataFrame(
            [("date_range", "error", f"column {date_col} not found")], CHECK_SCHEMA)
    allr = shape.unionByName(tgt).unionByName(dates)
    overall = allr.agg(F.bool_and(F.col("status") != "error").alias("ok")).select(
        F.lit("all_valid").alias("check"), F.when(F.col("ok"), "ok").otherwise("error").alias("status"),
        F.col("ok").cast("string").alias("detail"))
    return allr.unionByName(overall)


def before_after_summary(before: DataFrame, after: DataFrame, treated: Sequence[str] = ()) -> DataFrame:
    """Rows, columns, missing cells of each frame and the treated count."""
    def one(df, stage):
        return df.agg(F.count(F.lit(1)).alias("rows"),
                      sum((F.count_if(F.col(c).isNull()) for c in df.columns), F.lit(0)).alias("nulls")) \
            .select(F.lit(stage).alias("stage"), F.col("rows").cast("long").alias("rows"),
                    F.lit(len(df.columns)).cast("long").alias("columns"),
                    F.col("nulls").cast("long").alias("nulls"),
                    F.lit(len(treated)).cast("long").alias("columns_treated"))
    return one(before, "before").unionByName(one(after, "after"))
