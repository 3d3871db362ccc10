"""Monthly default series.

The base table is reduced to one row per month by a partial aggregate;
everything after that (row positions, windows over months, trend) runs on
that small table, so an unpartitioned window is over months, never rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def monthly_volume(df: DataFrame, date_col: str = "DATE_MONTH", target: str = "TARGET") -> DataFrame:
    """Month, nb_clients, nb_defauts, taux_defaut (percent)."""
    return df.groupBy(F.to_date(F.date_trunc("month", F.col(date_col))).alias("month")).agg(
        F.count(F.lit(1)).alias("nb_clients"),
        F.sum(F.col(target)).cast("long").alias("nb_defauts"),
        (F.avg(F.col(target).cast("double")) * 100).alias("taux_defaut"))


def monthly_series(df: DataFrame, date_col: str = "DATE_MONTH", target: str = "TARGET",
                   attribute: str = "DEFAULTS_ORIGINATION") -> DataFrame:
    """Month, nb_dossiers, nb_defauts, taux_defaut, defaults_origination.

    The per-month attribute is constant inside a month; ``min`` reads it
    deterministically (pandas takes the first row's value).
    """
    return df.groupBy(F.to_date(F.date_trunc("month", F.col(date_col))).alias("month")).agg(
        F.count(F.col(target)).alias("nb_dossiers"),
        F.sum(F.col(target)).cast("long").alias("nb_defauts"),
        (F.avg(F.col(target).cast("double")) * 100).alias("taux_defaut"),
        F.min(F.col(attribute)).alias("defaults_origination"))


def series_stats(monthly: DataFrame, value: str = "defaults_origination") -> DataFrame:
    """first/last month, months, mean, std (ddof 1), min, max, median."""
    v = F.col(value).cast("double")
    return monthly.agg(
        F.min("month").alias("first_month"), F.max("month").alias("last_month"),
        F.count(F.lit(1)).alias("n_months"), F.avg(v).alias("mean"),
        F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.median(v).alias("median"))


def with_month_index(monthly: DataFrame) -> DataFrame:
    """0-based position of each month (window over the monthly rows)."""
    return monthly.withColumn("month_num", F.row_number().over(Window.orderBy("month")) - 1)


def trend(monthly: DataFrame, value: str = "defaults_origination", threshold: float = 0.3) -> DataFrame:
    """Pearson r of month index and value; > t rising, < -t falling."""
    r = with_month_index(monthly).agg(
        F.corr(F.col("month_num").cast("double"), F.col(value).cast("double")).alias("correlation"))
    return r.select("correlation", F.when(F.col("correlation") > threshold, "rising")
                    .when(F.col("correlation") < -threshold, "falling")
                    .otherwise("stable").alias("trend"))


def seasonality(monthly: DataFrame, value: str = "defaults_origination") -> DataFrame:
    """Mean by month of year, the mean of those means, above-mean flag."""
    by_moy = monthly.groupBy(F.month("month").alias("month_of_year")).agg(
        F.avg(F.col(value).cast("double")).alias("mean_value"))
    overall = F.avg("mean_value").over(Window.partitionBy())  # <= 12 rows
    return by_moy.select("month_of_year", "mean_value", overall.alias("overall_mean"),
                         (F.col("mean_value") > overall).cast("tinyint").alias("above_mean"))


def top_months(season: DataFrame, k: int = 3) -> DataFrame:
    """The k months of year with the highest mean (tie -> earlier month)."""
    return season.orderBy(F.col("mean_value").desc(), F.col("month_of_year").asc()).limit(k)


def acf(df: DataFrame, series_key: Sequence[str], time_col: str, value: str,
        max_lag: int = 12) -> DataFrame:
    """Autocorrelation per series for lags 1..max_lag, many series at once.

    acf(k) = sum_t (x_t - m)(x_{t+k} - m) / sum_t (x_t - m)^2 over each
    series' own mean m (the standard estimator). ``lag`` windows are
    partitioned by series key, ordered by time: the input is one row per
    (series, period), already aggregated.
    """
    keys = list(series_key)
    w = Window.partitionBy(*keys).orderBy(time_col)
    wk = Window.partitionBy(*keys)
    x = df.withColumn("_d", F.col(value).cast("double") - F.avg(F.col(value).cast("double")).over(wk))
    lags = x.select(*keys, "_d", *[F.lag("_d", k).over(w).alias(f"_l{k}") for k in range(1, max_lag + 1)])
    agg = lags.groupBy(*keys).agg(
        F.sum(F.col("_d") * F.col("_d")).alias("_den"),
        *[F.sum(F.col("_d") * F.col(f"_l{k}")).alias(f"_n{k}") for k in range(1, max_lag + 1)])
    return agg.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(k).alias("lag"), F.try_divide(F.col(f"_n{k}"), F.col("_den")).alias("acf"))
        for k in range(1, max_lag + 1)])).alias("_a")).select(*keys, "_a.lag", "_a.acf")


def seasonal_trend_forecast(df: DataFrame, series_key: Sequence[str], time_col: str, value: str,
                            horizon: int = 3, holdout: int = 3) -> DataFrame:
    """Linear trend x month-of-year index forecast per series, with the
    hold-out errors (RMSE, MAE, MAPE) of the same model fitted without the
    last ``holdout`` periods.

    Per series: t = period index; trend fitted by ``regr_slope`` /
    ``regr_intercept``; seasonal index = mean(value / trend) by month of year.
    Output rows: (keys, kind, month, value) with kind in {forecast} plus one
    (keys, rmse, mae, mape) summary joined as columns.
    """
    keys = list(series_key)
    w = Window.partitionBy(*keys).orderBy("_m")
    base = df.select(*keys, F.col(time_col).alias("_m"), F.col(value).cast("double").alias("_y")) \
        .withColumn("_t", (F.row_number().over(w) - 1).cast("double")) \
        .withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))

    def fit(train: DataFrame) -> DataFrame:
        coef = train.groupBy(*keys).agg(F.regr_slope("_y", "_t").alias("_b"),
                                        F.regr_intercept("_y", "_t").alias("_a"),
                                        F.max("_t").alias("_tmax"), F.max("_m").alias("_mmax"))
        tr = train.join(coef, keys).withColumn("_fit", F.col("_a") + F.col("_b") * F.col("_t"))
        season = tr.groupBy(*keys, F.month("_m").alias("_moy")).agg(
            F.avg(F.try_divide(F.col("_y"), F.col("_fit"))).alias("_si"))
        return coef, season

    def predict(coef, season, steps: DataFrame) -> DataFrame:
        p = steps.join(coef, keys).withColumn("_trend", F.col("_a") + F.col("_b") * F.col("_t"))
        p = p.join(season, keys + ["_moy"], "left")
        return p.withColumn("_pred", F.col("_trend") * F.coalesce(F.col("_si"), F.lit(1.0)))

    # hold-out evaluation
    train = base.filter(F.col("_t") < F.col("_n") - holdout)
    test = base.filter(F.col("_t") >= F.col("_n") - holdout).withColumn("_moy", F.month("_m"))
    c1, s1 = fit(train)
    ev = predict(c1.drop("_tmax", "_mmax"), s1, test).groupBy(*keys).agg(
        F.sqrt(F.avg(F.pow(F.col("_y") - F.col("_pred"), 2))).alias("rmse"),
        F.avg(F.abs(F.col("_y") - F.col("_pred"))).alias("mae"),
        (F.avg(F.abs(F.try_divide(F.col("_y") - F.col("_pred"), F.col("_y")))) * 100).alias("mape"))
    # forecast from the full series
    c2, s2 = fit(base)
    steps = c2.select(*keys, F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("_h"),
                      "_tmax", "_mmax") \
        .withColumn("_t", F.col("_tmax") + F.col("_h")) \
        .withColumn("_m", F.add_months(F.col("_mmax"), F.col("_h"))) \
        .withColumn("_moy", F.month("_m")).select(*keys, "_h", "_t", "_m", "_moy")
    fc = predict(c2.drop("_tmax", "_mmax"), s2, steps)
    return fc.join(ev, keys, "left").select(
        *keys, F.col("_h").alias("step"), F.to_date("_m").alias("month"),
        F.col("_pred").alias("forecast"), "rmse", "mae", "mape")
