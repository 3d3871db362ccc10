"""Registered queries: profiling, time series (D-, J- families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import profile, series
from riskframe.plans.registry import register
from riskframe.sources.fixtures import applications, with_fixture

NUMERIC = ["LOAN_AMOUNT", "INCOME_MONTHLY", "N_ITEMS", "QTY_TOTAL", "PRICE_TOTAL",
           "AVG_DISCOUNT", "AVG_TAX", "AVG_DAYS_TO_SHIP"]
CATEGORICAL = ["STATUS", "PRIORITY", "SEGMENT", "NATION", "REGION"]


@register("d18_monthly_volume", with_fixture("""
SELECT CAST(DATE_MONTH AS DATE) AS month, count(*) AS nb_clients,
       CAST(sum(TARGET) AS BIGINT) AS nb_defauts, avg(TARGET) * 100 AS taux_defaut
FROM applications GROUP BY 1"""), ["taux_defaut"], "A2 B10 D18")
def d18_monthly_volume(spark, sf):
    """Default rate by origination month: the flagship query."""
    return series.monthly_volume(applications(spark, sf))


@register("s1_streaming_monthly_volume", with_fixture("""
SELECT CAST(DATE_MONTH AS DATE) AS month, count(*) AS nb_clients,
       CAST(sum(TARGET) AS BIGINT) AS nb_defauts, avg(TARGET) * 100 AS taux_defaut
FROM applications GROUP BY 1"""), ["taux_defaut"], "D18 J1 (incremental)")
def s1_streaming_monthly_volume(spark, sf):
    """D18 maintained by Structured Streaming over the application files."""
    from riskframe.sources.fixtures import materialized_path
    from riskframe.streaming import monthly_volume_stream, run_available
    path, schema = materialized_path(spark, sf)
    _, table = run_available(monthly_volume_stream(spark, path, schema))
    return spark.read.parquet(table)


@register("d19_default_rate_by_category", with_fixture("""
long AS (
  SELECT 'STATUS' AS variable, STATUS AS value, TARGET FROM applications
  UNION ALL SELECT 'PRIORITY', PRIORITY, TARGET FROM applications
  UNION ALL SELECT 'SEGMENT', SEGMENT, TARGET FROM applications
  UNION ALL SELECT 'NATION', NATION, TARGET FROM applications
  UNION ALL SELECT 'REGION', REGION, TARGET FROM applications)
SELECT variable, value, count(*) AS n, avg(TARGET) * 100 AS default_rate,
       (SELECT avg(TARGET) * 100 FROM applications) AS overall_rate
FROM long WHERE value IS NOT NULL GROUP BY variable, value"""),
    ["default_rate", "overall_rate"], "D19")
def d19_default_rate_by_category(spark, sf):
    return profile.default_rate_by_category(applications(spark, sf), CATEGORICAL)


@register("w3_sorted_default_rates", with_fixture("""
long AS (
  SELECT 'SEGMENT' AS variable, SEGMENT AS value, TARGET FROM applications
  UNION ALL SELECT 'NATION', NATION, TARGET FROM applications
  UNION ALL SELECT 'CUSTOMER_ID', CAST(CUSTOMER_ID AS VARCHAR), TARGET FROM applications),
r AS (SELECT variable, value, count(*) AS n, avg(TARGET) * 100 AS default_rate FROM long WHERE value IS NOT NULL GROUP BY ALL)
SELECT variable, value, n, default_rate, row_number() OVER (PARTITION BY variable ORDER BY default_rate DESC, value) AS position
FROM r"""), ["default_rate"], "W3 D19")
def w3_sorted_default_rates(spark, sf):
    """Default rates sorted within each variable, a row per customer among them."""
    from riskframe.operators.ranks import with_position
    df = profile.default_rate_by_category(applications(spark, sf), ["SEGMENT", "NATION", "CUSTOMER_ID"])
    return with_position(df.drop("overall_rate"), "default_rate", ["value"], ["variable"])


def _quality_sql():
    parts = []
    for c in ["CLIENT_ID", "CUSTOMER_ID", "TARGET"] + NUMERIC:
        t = {"CLIENT_ID": "bigint", "CUSTOMER_ID": "bigint", "TARGET": "tinyint",
             "N_ITEMS": "bigint"}.get(c, "double")
        parts.append(f"""SELECT '{c}' AS "column", '{t}' AS dtype, count({c}) AS non_null,
  count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100.0 / count(*), 2) AS null_pct,
  count(DISTINCT {c}) AS "unique", round(count(DISTINCT {c}) * 100.0 / count(*), 2) AS unique_pct,
  CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max",
  avg({c}) AS mean, stddev_samp({c}) AS std FROM applications""")
    for c in CATEGORICAL:
        parts.append(f"""SELECT '{c}', 'string', count({c}), count(*) - count({c}),
  round((count(*) - count({c})) * 100.0 / count(*), 2), count(DISTINCT {c}),
  round(count(DISTINCT {c}) * 100.0 / count(*), 2), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE),
  CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE) FROM applications""")
    return with_fixture("\nUNION ALL\n".join(parts))


@register("d7_quality_report", _quality_sql(),
          ["null_pct", "unique_pct", "min", "max", "mean", "std"], "D7 B6")
def d7_quality_report(spark, sf):
    df = applications(spark, sf)
    return profile.quality_report(df, ["CLIENT_ID", "CUSTOMER_ID", "TARGET"] + NUMERIC + CATEGORICAL)


def _missing_sql():
    cols = ["CLIENT_ID", "CUSTOMER_ID", "DATE_MONTH", "TARGET"] + NUMERIC + CATEGORICAL
    parts = [f"""SELECT '{c}' AS "column", count(*) - count({c}) AS missing_count,
  round((count(*) - count({c})) * 100.0 / count(*), 2) AS missing_pct FROM applications"""
             for c in cols]
    types = {"CLIENT_ID": "bigint", "CUSTOMER_ID": "bigint", "DATE_MONTH": "timestamp_ntz",
             "TARGET": "tinyint", "N_ITEMS": "bigint"}
    tmap = " ".join(f"WHEN '{c}' THEN '{types.get(c, 'string' if c in CATEGORICAL else 'double')}'"
                    for c in cols)
    return with_fixture(f"""m AS ({' UNION ALL '.join(parts)})
SELECT "column", missing_count, missing_pct, CASE "column" {tmap} END AS dtype
FROM m WHERE missing_count > 0""")


@register("d8_missing_report", _missing_sql(), ["missing_pct"], "D8 C6")
def d8_missing_report(spark, sf):
    df = applications(spark, sf)
    return profile.missing_report(df, ["CLIENT_ID", "CUSTOMER_ID", "DATE_MONTH", "TARGET"]
                                  + NUMERIC + CATEGORICAL)


@register("d9_blank_strings", """
WITH t AS (
  SELECT 'text' AS "column", CAST(count_if(regexp_matches(text, '^\\s*$')) AS BIGINT) AS n_blank,
         count(*) AS n FROM documents
  UNION ALL SELECT 'lang', CAST(count_if(regexp_matches(lang, '^\\s*$')) AS BIGINT), count(*) FROM documents
  UNION ALL SELECT 'source', CAST(count_if(regexp_matches(source, '^\\s*$')) AS BIGINT), count(*) FROM documents)
SELECT "column", n_blank, round(n_blank * 100.0 / n, 2) AS blank_pct FROM t WHERE n_blank > 0""",
          ["blank_pct"], "D9 C5")
def d9_blank_strings(spark, sf):
    from riskframe.sources.io import read_table
    return profile.blank_string_report(read_table(spark, sf, "documents"), ["text", "lang", "source"])


def _with_blanks(df):
    """Blank cells by key: two spaces, a no-break and an ideographic space, nothing."""
    k = F.col("CLIENT_ID")
    return df.withColumns({
        "REGION": F.when(k % 11 == 0, "  ").when(k % 13 == 0, "\u00a0\u3000").otherwise(F.col("REGION")),
        "SEGMENT": F.when(k % 17 == 0, "").otherwise(F.col("SEGMENT"))})


@register("d9_e5_blank_cells", with_fixture("""
c AS (SELECT count(*) AS n, count_if(CLIENT_ID % 11 = 0 OR CLIENT_ID % 13 = 0) AS r, count_if(CLIENT_ID % 17 = 0) AS s,
             count_if(CLIENT_ID % 11 = 0 OR CLIENT_ID % 13 = 0 OR REGION IS NULL) AS rn,
             count_if(CLIENT_ID % 17 = 0 OR SEGMENT IS NULL) AS sn FROM applications)
SELECT 'REGION' AS "column", CAST(r AS BIGINT) AS n_blank, round(r * 100.0 / n, 2) AS blank_pct, CAST(rn AS BIGINT) AS nulls_after FROM c WHERE r > 0
UNION ALL SELECT 'SEGMENT', CAST(s AS BIGINT), round(s * 100.0 / n, 2), CAST(sn AS BIGINT) FROM c WHERE s > 0"""),
          ["blank_pct"], "D9 C5 E5")
def d9_e5_blank_cells(spark, sf):
    """Blank cells found per column (D9), and the nulls there are once they are null (E5)."""
    from riskframe.operators import impute
    df = _with_blanks(applications(spark, sf).select("CLIENT_ID", "REGION", "SEGMENT"))
    filled = impute.blank_to_null(df, ["REGION", "SEGMENT"])
    after = filled.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in ("REGION", "SEGMENT")])
    after = after.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls_after")) for c in ("REGION", "SEGMENT")])).alias("r")).select("r.*")
    return profile.blank_string_report(df, ["REGION", "SEGMENT"]).join(F.broadcast(after), "column").orderBy(F.col("n_blank").desc(), "column")


@register("d2_duplicate_report", with_fixture("""
k AS (SELECT CUSTOMER_ID, DATE_MONTH, SEGMENT, count(*) AS c FROM applications
      GROUP BY ALL),
u AS (SELECT CUSTOMER_ID, count(*) AS c FROM applications GROUP BY CUSTOMER_ID)
SELECT 'n_rows' AS "check", CAST(sum(c) AS BIGINT) AS value FROM k
UNION ALL SELECT 'n_dup_full', CAST(sum(c - 1) AS BIGINT) FROM k
UNION ALL SELECT 'n_dup_key', CAST(sum(c - 1) AS BIGINT) FROM u
UNION ALL SELECT 'n_repeated_keys', CAST(count_if(c > 1) AS BIGINT) FROM u"""), [], "D2")
def d2_duplicate_report(spark, sf):
    """Duplicates over (customer, month, segment) rows and over the customer key."""
    df = applications(spark, sf).select("CUSTOMER_ID", "DATE_MONTH", "SEGMENT")
    return profile.duplicate_report(df, "CUSTOMER_ID")


@register("d14_overview", with_fixture("""
SELECT * FROM (VALUES ('n_columns', 26.0), ('n_numeric', 20.0), ('n_categorical', 5.0)) v(metric, value)
UNION ALL SELECT 'n_rows', CAST(count(*) AS DOUBLE) FROM applications
UNION ALL SELECT 'non_default', CAST(count_if(TARGET = 0) AS DOUBLE) FROM applications
UNION ALL SELECT 'default', CAST(count_if(TARGET = 1) AS DOUBLE) FROM applications
UNION ALL SELECT 'default_rate', count_if(TARGET = 1) * 100.0 / count(*) FROM applications
UNION ALL SELECT 'imbalance_ratio', count_if(TARGET = 0) * 1.0 / count_if(TARGET = 1) FROM applications
"""), ["value"], "D14 B11")
def d14_overview(spark, sf):
    return profile.dataset_overview(applications(spark, sf))


def _describe_sql():
    parts = [f"""SELECT '{c}' AS "column", count({c}) AS "count", avg({c}) AS mean,
  stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS "min",
  quantile_cont({c}, 0.25) AS p25, quantile_cont({c}, 0.5) AS p50,
  quantile_cont({c}, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS "max" FROM applications"""
             for c in NUMERIC]
    return with_fixture(" UNION ALL ".join(parts))


@register("d15_numeric_describe", _describe_sql(),
          ["mean", "std", "min", "p25", "p50", "p75", "max"], "D15 W1")
def d15_numeric_describe(spark, sf):
    return profile.numeric_describe(applications(spark, sf), NUMERIC)


@register("d16_categorical_describe", with_fixture("""
long AS (
  SELECT 'STATUS' AS v, STATUS AS x FROM applications
  UNION ALL SELECT 'PRIORITY', PRIORITY FROM applications
  UNION ALL SELECT 'SEGMENT', SEGMENT FROM applications
  UNION ALL SELECT 'NATION', NATION FROM applications
  UNION ALL SELECT 'REGION', REGION FROM applications),
vc AS (SELECT v, x, count(*) AS n FROM long WHERE x IS NOT NULL GROUP BY v, x)
SELECT v AS "column", CAST(sum(n) AS BIGINT) AS "count", count(*) AS "unique",
       arg_min(x, (-n, x)) AS top, max(n) AS freq
FROM vc GROUP BY v"""), [], "D16")
def d16_categorical_describe(spark, sf):
    return profile.categorical_describe(applications(spark, sf), CATEGORICAL)


@register("d17_top_values", with_fixture("""
long AS (
  SELECT 'PRIORITY' AS v, PRIORITY AS x FROM applications
  UNION ALL SELECT 'SEGMENT', SEGMENT FROM applications
  UNION ALL SELECT 'NATION', NATION FROM applications),
vc AS (SELECT v, x, count(*) AS n FROM long WHERE x IS NOT NULL GROUP BY v, x),
r AS (SELECT v, x, n, row_number() OVER (PARTITION BY v ORDER BY n DESC, x ASC) AS rk,
             count(*) OVER (PARTITION BY v) AS card FROM vc)
SELECT v AS "column", x AS value, n AS "count", rk AS "rank", card AS cardinality
FROM r WHERE rk <= 10"""), [], "D17 W4")
def d17_top_values(spark, sf):
    return profile.top_values(applications(spark, sf), ["PRIORITY", "SEGMENT", "NATION"], k=10)


@register("d25_class_shares", with_fixture("""
SELECT TARGET AS class, count(*) AS "count", count(*) * 100.0 / sum(count(*)) OVER () AS pct
FROM applications GROUP BY TARGET"""), ["pct"], "D25")
def d25_class_shares(spark, sf):
    return profile.class_shares(applications(spark, sf))


@register("d23_negative_audit", with_fixture("""
SELECT 'INCOME_MONTHLY' AS "column", CAST(count_if(INCOME_MONTHLY < 0) AS BIGINT) AS n_negative,
       min(INCOME_MONTHLY) AS "min" FROM applications
UNION ALL SELECT 'LOAN_AMOUNT', CAST(count_if(LOAN_AMOUNT < 0) AS BIGINT), min(LOAN_AMOUNT) FROM applications
UNION ALL SELECT 'AVG_DISCOUNT', CAST(count_if(AVG_DISCOUNT < 0) AS BIGINT), min(AVG_DISCOUNT) FROM applications"""),
          ["min"], "D23")
def d23_negative_audit(spark, sf):
    return profile.negative_audit(applications(spark, sf),
                                  ["INCOME_MONTHLY", "LOAN_AMOUNT", "AVG_DISCOUNT"])


_CORR = ["LOAN_AMOUNT", "INCOME_MONTHLY", "N_ITEMS", "PRICE_TOTAL", "AVG_DISCOUNT", "AVG_TAX"]


@register("d20_correlation_pairs", with_fixture(" UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}, {b}) AS r FROM applications"
    for i, a in enumerate(_CORR) for b in _CORR[i + 1:])), ["r"], "D20")
def d20_correlation_pairs(spark, sf):
    return profile.correlation_pairs(applications(spark, sf), _CORR)


@register("d20_correlation_with_target", with_fixture(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, corr({c}, TARGET) AS r FROM applications" for c in _CORR)),
    ["r"], "D20")
def d20_correlation_with_target(spark, sf):
    return profile.correlation_with_target(applications(spark, sf), _CORR)


@register("d21_histogram_by_class", with_fixture("""
b AS (SELECT CAST(TARGET AS VARCHAR) AS class, LOAN_AMOUNT AS x FROM applications WHERE LOAN_AMOUNT IS NOT NULL),
r AS (SELECT class, min(x) AS lo, max(x) AS hi FROM b GROUP BY class),
h AS (SELECT b.class, lo, hi,
        CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((x - lo) * 30 / (hi - lo)), 29) END AS INTEGER) AS bin
      FROM b JOIN r ON b.class = r.class),
g AS (SELECT class, lo, hi, CAST(unnest(range(CASE WHEN hi = lo THEN 1 ELSE 30 END)) AS INTEGER) AS bin FROM r)
SELECT g.class, g.bin, g.lo + g.bin * (g.hi - g.lo) / 30 AS "left", g.lo + (g.bin + 1) * (g.hi - g.lo) / 30 AS "right",
       count(h.bin) AS "count"
FROM g LEFT JOIN h ON g.class = h.class AND g.bin = h.bin GROUP BY g.class, g.bin, g.lo, g.hi"""), ["left", "right"], "D21 I11")
def d21_histogram_by_class(spark, sf):
    df = applications(spark, sf).withColumn("TARGET", F.col("TARGET").cast("string"))
    return profile.histogram(df, "LOAN_AMOUNT", bins=30, by="TARGET")


@register("j1_monthly_series", with_fixture("""
SELECT CAST(DATE_MONTH AS DATE) AS month, count(TARGET) AS nb_dossiers,
       CAST(sum(TARGET) AS BIGINT) AS nb_defauts, avg(TARGET) * 100 AS taux_defaut,
       min(DEFAULTS_ORIGINATION) AS defaults_origination
FROM applications GROUP BY 1"""), ["taux_defaut"], "J1")
def j1_monthly_series(spark, sf):
    return series.monthly_series(applications(spark, sf))


_MONTHLY_SQL = """m AS (SELECT CAST(DATE_MONTH AS DATE) AS month,
  min(DEFAULTS_ORIGINATION) AS d FROM applications GROUP BY 1)"""


@register("j2_series_stats", with_fixture(_MONTHLY_SQL + """
SELECT min(month) AS first_month, max(month) AS last_month, count(*) AS n_months,
       avg(d) AS mean, stddev_samp(d) AS std, CAST(min(d) AS DOUBLE) AS "min",
       CAST(max(d) AS DOUBLE) AS "max", quantile_cont(d, 0.5) AS median FROM m"""),
    ["mean", "std", "min", "max", "median"], "J2")
def j2_series_stats(spark, sf):
    return series.series_stats(series.monthly_series(applications(spark, sf)))


@register("j3_trend", with_fixture(_MONTHLY_SQL + """,
i AS (SELECT d, row_number() OVER (ORDER BY month) - 1 AS k FROM m)
SELECT corr(k, d) AS correlation,
       CASE WHEN corr(k, d) > 0.3 THEN 'rising' WHEN corr(k, d) < -0.3 THEN 'falling'
            ELSE 'stable' END AS trend FROM i"""), ["correlation"], "J3 W2")
def j3_trend(spark, sf):
    return series.trend(series.monthly_series(applications(spark, sf)))


@register("j4_seasonality", with_fixture(_MONTHLY_SQL + """,
s AS (SELECT CAST(month(month) AS INTEGER) AS month_of_year, avg(d) AS mean_value FROM m GROUP BY 1)
SELECT month_of_year, mean_value, avg(mean_value) OVER () AS overall_mean,
       CAST(CASE WHEN mean_value > avg(mean_value) OVER () THEN 1 ELSE 0 END AS TINYINT) AS above_mean
FROM s"""), ["mean_value", "overall_mean"], "J4")
def j4_seasonality(spark, sf):
    return series.seasonality(series.monthly_series(applications(spark, sf)))


@register("j5_top_months", with_fixture(_MONTHLY_SQL + """,
s AS (SELECT CAST(month(month) AS INTEGER) AS month_of_year, avg(d) AS mean_value FROM m GROUP BY 1)
SELECT month_of_year, mean_value, avg(mean_value) OVER () AS overall_mean,
       CAST(CASE WHEN mean_value > avg(mean_value) OVER () THEN 1 ELSE 0 END AS TINYINT) AS above_mean
FROM s ORDER BY mean_value DESC, month_of_year LIMIT 3"""), ["mean_value", "overall_mean"], "J5 W4")
def j5_top_months(spark, sf):
    return series.top_months(series.seasonality(series.monthly_series(applications(spark, sf))))


@register("k13_acf_by_segment", with_fixture("""
m AS (SELECT SEGMENT, CAST(DATE_MONTH AS DATE) AS month, CAST(sum(TARGET) AS DOUBLE) AS y
      FROM applications GROUP BY ALL),
d AS (SELECT SEGMENT, month, y - avg(y) OVER (PARTITION BY SEGMENT) AS x FROM m),
lags AS (SELECT SEGMENT, x, unnest(range(1, 13)) AS lag FROM d),
pairs AS (
  SELECT a.SEGMENT, l.lag, sum(a.x * b.x) AS num
  FROM (SELECT SEGMENT, month, x, row_number() OVER (PARTITION BY SEGMENT ORDER BY month) AS i FROM d) a
  JOIN (SELECT SEGMENT, month, x, row_number() OVER (PARTITION BY SEGMENT ORDER BY month) AS i FROM d) b
    ON a.SEGMENT = b.SEGMENT
  JOIN (SELECT unnest(range(1, 13)) AS lag) l ON b.i = a.i - l.lag
  GROUP BY a.SEGMENT, l.lag),
den AS (SELECT SEGMENT, sum(x * x) AS s FROM d GROUP BY SEGMENT),
grid AS (SELECT SEGMENT, unnest(range(1, 13)) AS lag FROM den)
SELECT g.SEGMENT, CAST(g.lag AS INTEGER) AS lag, coalesce(p.num, 0) / den.s AS acf
FROM grid g JOIN den ON g.SEGMENT = den.SEGMENT
LEFT JOIN pairs p ON p.SEGMENT = g.SEGMENT AND p.lag = g.lag"""), ["acf"], "K13")
def k13_acf_by_segment(spark, sf):
    """Autocorrelation of monthly defaults, one series per market segment."""
    m = applications(spark, sf).groupBy("SEGMENT", F.to_date("DATE_MONTH").alias("month")) \
        .agg(F.sum("TARGET").cast("double").alias("y"))
    return series.acf(m, ["SEGMENT"], "month", "y", max_lag=12)


@register("k14_forecast_by_segment", with_fixture("""
m AS (SELECT SEGMENT, CAST(DATE_MONTH AS DATE) AS mo, CAST(sum(TARGET) AS DOUBLE) AS y
      FROM applications GROUP BY ALL),
b AS (SELECT SEGMENT, mo, y, CAST(row_number() OVER (PARTITION BY SEGMENT ORDER BY mo) - 1 AS DOUBLE) AS t,
             count(*) OVER (PARTITION BY SEGMENT) AS n FROM m),
tr AS (SELECT * FROM b WHERE t < n - 3),
te AS (SELECT * FROM b WHERE t >= n - 3),
c1 AS (SELECT SEGMENT, regr_slope(y, t) AS sb, regr_intercept(y, t) AS sa FROM tr GROUP BY SEGMENT),
s1 AS (SELECT tr.SEGMENT, month(mo) AS moy,
              avg(CASE WHEN sa + sb * t = 0 THEN NULL ELSE y / (sa + sb * t) END) AS si
       FROM tr JOIN c1 USING (SEGMENT) GROUP BY ALL),
pr AS (SELECT te.SEGMENT, y, (sa + sb * t) * coalesce(si, 1.0) AS p
       FROM te JOIN c1 USING (SEGMENT) LEFT JOIN s1 ON s1.SEGMENT = te.SEGMENT AND s1.moy = month(te.mo)),
ev AS (SELECT SEGMENT, sqrt(avg(pow(y - p, 2))) AS rmse, avg(abs(y - p)) AS mae,
              avg(abs(CASE WHEN y = 0 THEN NULL ELSE (y - p) / y END)) * 100 AS mape FROM pr GROUP BY SEGMENT),
c2 AS (SELECT SEGMENT, regr_slope(y, t) AS sb, regr_intercept(y, t) AS sa, max(t) AS tmax, max(mo) AS mmax
       FROM b GROUP BY SEGMENT),
s2 AS (SELECT b.SEGMENT, month(mo) AS moy,
              avg(CASE WHEN sa + sb * t = 0 THEN NULL ELSE y / (sa + sb * t) END) AS si
       FROM b JOIN c2 USING (SEGMENT) GROUP BY ALL),
st AS (SELECT SEGMENT, h, tmax + h AS t, CAST(mmax + to_months(CAST(h AS INTEGER)) AS DATE) AS mo, sa, sb
       FROM c2, (SELECT unnest(range(1, 4)) AS h)),
fc AS (SELECT st.SEGMENT, CAST(h AS INTEGER) AS step, st.mo AS "month",
              (sa + sb * t) * coalesce(si, 1.0) AS forecast
       FROM st LEFT JOIN s2 ON s2.SEGMENT = st.SEGMENT AND s2.moy = month(st.mo))
SELECT fc.SEGMENT, step, "month", forecast, rmse, mae, mape FROM fc LEFT JOIN ev USING (SEGMENT)"""),
    ["forecast", "rmse", "mae", "mape"], "K14")
def k14_forecast_by_segment(spark, sf):
    """3-month seasonal x trend forecast of monthly defaults per segment."""
    m = applications(spark, sf).groupBy("SEGMENT", F.to_date("DATE_MONTH").alias("month")) \
        .agg(F.sum("TARGET").cast("double").alias("y"))
    return series.seasonal_trend_forecast(m, ["SEGMENT"], "month", "y", horizon=3, holdout=3)
