"""The two end-to-end flows of the original, as library entry points.

``explore_and_clean``: overview, quality, duplicates and outlier reports,
then the cleaning step, written as Parquet (partitioned by origination
month) with the reports as CSV / JSON. ``features_and_model``: reads that
table back, derives the features (written once and read again), trains the
scaled + SMOTE + logistic model on the months before the cut, evaluates it on
the months after, builds the monthly series with trend and seasonality, and
saves metrics, importance and one bundle of fill values, scaler, feature order
and model.
All work is Spark jobs; the driver only carries report rows and names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.core import numeric_columns, string_columns
from riskframe.operators import clean, features, impute, model, profile, series, validate
from riskframe.sources import io


def explore_and_clean(df: DataFrame, out_dir: str, key: str = "CLIENT_ID", target: str = "TARGET",
                      date_col: str = "DATE_MONTH", region: str = "REGION",
                      flags: Sequence[str] = ("TARGET",)) -> dict:
    """Reports + cleaned table; returns {name: DataFrame} of what was written."""
    out_dir = out_dir.rstrip("/")
    reports = {
        "overview": profile.dataset_overview(df, target),
        "quality": profile.quality_report(df),
        "duplicates": profile.duplicate_report(df, key),
        "validations": validate.run_all_validations(df, target, date_col),
    }
    num = numeric_columns(df, [key, target])
    reports["outliers"] = clean.outlier_report(df, num)
    cleaned = impute.blank_to_null(df, string_columns(df))
    if region in cleaned.columns:
        cleaned = impute.fill_constant(cleaned, region, "INCONNU")
    cleaned = clean.narrow_types(cleaned, {c: "tinyint" for c in flags})
    cleaned = clean.add_date_parts(cleaned, date_col)
    io.save_parquet(cleaned.withColumn("_month", F.to_date(date_col)), f"{out_dir}/cleaned",
                    partition_by=["_month"])
    io.save_report_csv(reports["quality"], f"{out_dir}/reports/quality_csv")
    io.save_report_json(reports["overview"], f"{out_dir}/reports/overview_json")
    io.save_report_json(reports["outliers"], f"{out_dir}/reports/outliers_json")
    return reports


def features_and_model(spark: SparkSession, cleaned_path: str, out_dir: str, cutoff: str,
                       model_features: Sequence[str], key: str = "CLIENT_ID", target: str = "TARGET",
                       date_col: str = "DATE_MONTH") -> dict:
    """Features -> temporal split -> SMOTE logistic -> metrics, series, saves.

    ``model_features`` are raw or derived columns. Every fitted value comes from
    the months before the cut. ``out_dir/model`` scores rows with those columns:
    ``model.score(model.load_model(path), rows)``.
    """
    out_dir = out_dir.rstrip("/")
    raw = io.load_parquet(spark, cleaned_path).drop("_month")
    derived = features.engineer_features(raw, fill_exclude=(key, target), fit_df=clean.temporal_split(raw, date_col, cutoff)[0])
    io.save_parquet(derived, f"{out_dir}/features")
    df = io.load_parquet(spark, f"{out_dir}/features")
    tr, te = clean.temporal_split(df, date_col, cutoff)
    fill = impute.fit_numeric(tr, list(model_features), "median")
    tr, te = impute.apply_fill(tr, fill), impute.apply_fill(te, fill)
    st, lr = model.fit_logistic_smote(tr, model_features, target, key)
    scored = model.score_scaled(lr, st, te, model_features, target)
    metrics = model.classification_metrics(scored)
    has_attribute = "DEFAULTS_ORIGINATION" in raw.columns
    monthly = series.monthly_series(raw, date_col, target, "DEFAULTS_ORIGINATION") \
        if has_attribute else series.monthly_volume(raw, date_col, target)
    io.save_report_csv(monthly.orderBy("month"), f"{out_dir}/reports/monthly_csv")
    value = "defaults_origination" if has_attribute else "nb_defauts"
    trend, season = series.trend(monthly, value), series.seasonality(monthly, value).orderBy("month_of_year")
    importance = spark.createDataFrame(
        [(f, float(v), abs(float(v))) for f, v in zip(model_features, lr.coefficients.toArray())],
        "feature string, coefficient double, importance double")
    model.save_model(model.scaled_bundle(lr, st, model_features, fill), f"{out_dir}/model")
    io.save_report_json(metrics, f"{out_dir}/reports/metrics_json")
    io.save_report_csv(importance, f"{out_dir}/reports/importance_csv")
    io.save_report_json(trend, f"{out_dir}/reports/trend_json")
    io.save_report_csv(season, f"{out_dir}/reports/seasonality_csv")
    return {"metrics": metrics, "importance": importance, "monthly": monthly, "trend": trend, "seasonality": season,
            "scored": scored}
