"""Encoders and time aggregations declared by the original (K1-K4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_hot(columns: Sequence[str], drop_last: bool = False) -> Pipeline:
    """K1: StringIndexer (sorted codes, missing kept) + OneHotEncoder."""
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                         handleInvalid="keep") for c in columns]
    ohe = OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_ohe" for c in columns],
                        dropLast=drop_last, handleInvalid="keep")
    return Pipeline(stages=idx + [ohe])


def target_encoding_table(df: DataFrame, column: str, target: str, smoothing: float = 20.0) -> DataFrame:
    """K2 fit: (value, n, encoding) with encoding = (n * mean + m * prior) /
    (n + m). One partial aggregate; the prior is one number."""
    prior = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
    g = (df.filter(F.col(column).isNotNull())
         .groupBy(column).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(target).cast("double")).alias("_m")))
    return g.select(column, "n", ((F.col("n") * F.col("_m") + F.lit(smoothing * prior))
                                  / (F.col("n") + F.lit(smoothing))).alias("encoding"))


def target_encode(df: DataFrame, column: str, target: str, smoothing: float = 20.0,
                  fold_col: str | None = None, out: str | None = None) -> DataFrame:
    """K2 transform. With ``fold_col`` each row is encoded with statistics of
    the other folds only (out-of-fold), so a row never sees its own label.
    The encoding table is keyed by category value: a shuffle join, which
    AQE turns into a broadcast when the table is small at run time."""
    name = out or f"{column}_te"
    prior = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
    if fold_col is None:
        t = target_encoding_table(df, column, target, smoothing).select(column, F.col("encoding").alias(name))
        return df.join(t, column, "left").fillna({name: prior})
    y = F.col(target).cast("double")
    per = df.groupBy(column, fold_col).agg(F.count(F.lit(1)).alias("_nf"), F.sum(y).alias("_sf"))
    tot = per.groupBy(column).agg(F.sum("_nf").alias("_nt"), F.sum("_sf").alias("_st"))
    oof = per.join(tot, column).select(
        column, fold_col,
        ((F.col("_st") - F.col("_sf") + F.lit(smoothing * prior))
         / (F.col("_nt") - F.col("_nf") + F.lit(smoothing))).alias(name))
    return df.join(oof, [column, fold_col], "left").fillna({name: prior})


def ordinal_encode(df: DataFrame, column: str, order: Sequence[str], out: str | None = None) -> DataFrame:
    """K3: position in a declared order (0-based); unknown or missing -> null.
    The order is a parameter, so the literal map is bounded by it."""
    m = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
    return df.withColumn(out or f"{column}_ord", m[F.col(column)])


def time_aggregations(df: DataFrame, key: str, date_col: str, value: str, window: int = 3) -> DataFrame:
    """K4: per (key, month): count, amount, rolling ``window``-month amount
    and the running count. The base rows are first reduced to one row per
    (key, month), so each window partition holds at most one row per month
    of that key, whatever the key's share of the base rows."""
    m = df.groupBy(key, F.to_date(F.date_trunc("month", F.col(date_col))).alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(value).cast("double")).alias("amount"))
    w = Window.partitionBy(key).orderBy("month")
    return m.select(key, "month", "n", "amount",
                    F.sum("amount").over(w.rowsBetween(-(window - 1), 0)).alias(f"amount_{window}"),
                    F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("long").alias("n_cum"))
