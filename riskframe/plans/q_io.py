"""Registered queries: sources and sinks (A1, A3-A5) and type conversion
(B2-B4), as round trips through files written under the shared checkpoint
folder; each reads back what Spark wrote from the provided tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.operators import clean, profile, series
from riskframe.plans.q_profile import CATEGORICAL, NUMERIC, _missing_sql, _quality_sql
from riskframe.plans.registry import REGISTRY, register
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources import io
from riskframe.sources.fixtures import applications


def _scratch(spark, tag: str) -> str:
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/riskframe-{tag}-{uuid.uuid4().hex}"


TEXT_SCHEMA = T.StructType([
    T.StructField("CLIENT_ID", T.LongType()), T.StructField("DATE_MONTH", T.StringType()),
    T.StructField("TARGET", T.ByteType()), T.StructField("REGION", T.StringType())])


@register("a1_b2_csv_roundtrip_monthly", REGISTRY["d18_monthly_volume"].sql, ["taux_defaut"],
          "A1 B2 B3")
def a1_b2_csv_roundtrip_monthly(spark, sf):
    """Applications -> CSV text -> load_csv (declared schema, missing tokens)
    -> lenient date / category conversion -> monthly default rate."""
    path = _scratch(spark, "csv")
    (applications(spark, sf).select("CLIENT_ID", F.col("DATE_MONTH").cast("string").alias("DATE_MONTH"),
                                   "TARGET", "REGION")
     .write.mode("overwrite").option("header", True).csv(path))
    df = io.load_csv(spark, path, TEXT_SCHEMA)
    df = clean.convert_dtypes(df, date_columns=["DATE_MONTH"], category_columns=["REGION"])
    return series.monthly_volume(df)


@register("a2_a3_parquet_roundtrip_monthly", REGISTRY["d18_monthly_volume"].sql, ["taux_defaut"],
          "A2 A3 B4")
def a2_a3_parquet_roundtrip_monthly(spark, sf):
    """Applications with text dates -> Parquet by month -> load_parquet of two
    columns -> strict date parse -> monthly default rate."""
    path = _scratch(spark, "parquet")
    df = applications(spark, sf).select(F.col("DATE_MONTH").cast("string").alias("DATE_MONTH"), "TARGET", "REGION",
                                        F.to_date("DATE_MONTH").alias("_month"))
    io.save_parquet(df, path, partition_by=["_month"])
    back = io.load_parquet(spark, path, ["DATE_MONTH", "TARGET"])
    return series.monthly_volume(clean.parse_dates_strict(back, ["DATE_MONTH"]))


QUALITY_SCHEMA = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("dtype", T.StringType()),
    T.StructField("non_null", T.LongType()), T.StructField("null_count", T.LongType()),
    T.StructField("null_pct", T.DoubleType()), T.StructField("unique", T.LongType()),
    T.StructField("unique_pct", T.DoubleType()), T.StructField("min", T.DoubleType()),
    T.StructField("max", T.DoubleType()), T.StructField("mean", T.DoubleType()),
    T.StructField("std", T.DoubleType())])


@register("a4_quality_report_csv", _quality_sql(),
          ["null_pct", "unique_pct", "min", "max", "mean", "std"], "A4 A1 D7")
def a4_quality_report_csv(spark, sf):
    """The quality report written as a CSV report and read back."""
    path = _scratch(spark, "report-csv")
    rep = profile.quality_report(applications(spark, sf), ["CLIENT_ID", "CUSTOMER_ID", "TARGET"]
                                 + NUMERIC + CATEGORICAL)
    io.save_report_csv(rep, path)
    return io.load_csv(spark, path, QUALITY_SCHEMA)


@register("a5_missing_report_json", _missing_sql(), ["missing_pct"], "A5 D8")
def a5_missing_report_json(spark, sf):
    """The missing-value report written as JSON and read back."""
    path = _scratch(spark, "report-json")
    rep = profile.missing_report(applications(spark, sf), ["CLIENT_ID", "CUSTOMER_ID", "DATE_MONTH", "TARGET"]
                                 + NUMERIC + CATEGORICAL)
    io.save_report_json(rep, path)
    return spark.read.schema(rep.schema).json(path)
