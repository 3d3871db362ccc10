"""Registered queries: schema, cleaning, validation, imputation, features
(B-, C-, D1/D3-D6/D10-D13/D22/D24, E-, F- families)."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean, features, impute, validate
from riskframe.plans.registry import register
from riskframe.sources.fixtures import TRAIN_CUTOFF, applications, credit_view, with_fixture

# ------------------------------------------------------------ SQL helpers


def sdiv(n: str, d: str) -> str:
    return f"(CASE WHEN ({d}) = 0 THEN NULL ELSE CAST({n} AS DOUBLE) / ({d}) END)"


def sflag(cond: str) -> str:
    return f"CAST(coalesce({cond}, false) AS TINYINT)"


def srow_mean(cols) -> str:
    m = " + ".join(f"CAST({x} IS NOT NULL AS INTEGER)" for x in cols)
    s = " + ".join(f"coalesce({x}, 0)" for x in cols)
    return f"(CASE WHEN ({m}) > 0 THEN ({s}) / ({m}) END)"


def srow_std(cols) -> str:
    m = " + ".join(f"CAST({x} IS NOT NULL AS INTEGER)" for x in cols)
    mean = srow_mean(cols)
    sq = " + ".join(f"coalesce(({x} - {mean}) * ({x} - {mean}), 0)" for x in cols)
    return f"(CASE WHEN ({m}) > 1 THEN sqrt(({sq}) / (({m}) - 1)) END)"


SAV = ["SAVINGS_BALANCE_M1", "SAVINGS_BALANCE_M2", "SAVINGS_BALANCE_M3"]
CHK = ["CHECKING_BALANCE_M1", "CHECKING_BALANCE_M2", "CHECKING_BALANCE_M3"]

# ----------------------------------------------------------------- schema


@register("b1_standardize_names", with_fixture("""
SELECT 'client_id' AS "column", count(CLIENT_ID) AS non_null FROM applications
UNION ALL SELECT 'avg_days_to_ship', count(AVG_DAYS_TO_SHIP) FROM applications
UNION ALL SELECT 'region', count(REGION) FROM applications"""), [], "B1")
def b1_standardize_names(spark, sf):
    """Counts under standardised names (upper-case fixture names lowered)."""
    df = clean.standardize_column_names(
        applications(spark, sf).select("CLIENT_ID", "AVG_DAYS_TO_SHIP", "REGION"))
    return df.agg(*[F.count(c).alias(c) for c in df.columns]).select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null")) for c in df.columns])).alias("r")
    ).select("r.*")


def _schema_sql():
    cols = [("CLIENT_ID", "bigint"), ("LOAN_AMOUNT", "double"), ("INCOME_MONTHLY", "double"),
            ("N_ITEMS", "bigint"), ("QTY_TOTAL", "double"), ("PRICE_TOTAL", "double"),
            ("AVG_DISCOUNT", "double"), ("AVG_TAX", "double"), ("PRICE_M1", "double"), ("PRICE_M2", "double"),
            ("PRICE_M3", "double"), ("QTY_M1", "double"), ("QTY_M2", "double"), ("QTY_M3", "double"),
            ("N_RETURNED", "bigint"), ("N_OPEN_LINES", "bigint"), ("AVG_DAYS_TO_SHIP", "double"),
            ("DEFAULTS_ORIGINATION", "bigint")]
    renamed = {"LOAN_AMOUNT": "loan", "INCOME_MONTHLY": "income"}
    parts = [f"SELECT {i} AS position, '{renamed.get(c, c)}' AS \"column\", '{t}' AS type, "
             f"count({c}) AS non_null FROM applications WHERE TARGET = 1" for i, (c, t) in enumerate(cols)]
    return with_fixture(" UNION ALL ".join(parts))


@register("b11_schema_defaulters", _schema_sql(), [], "B6 B8 B9 B11 C2")
def b11_schema_defaulters(spark, sf):
    """Numeric columns (ids kept, target/customer excluded), two renamed,
    defaulters only: schema table with each column's non-null count."""
    df = clean.class_filter(applications(spark, sf), "TARGET", 1)
    num = clean.select_by_type(df, "numeric", exclude=["CLIENT_ID", "CUSTOMER_ID", "TARGET"])
    df = clean.feature_projection(df, ["CLIENT_ID"], num.columns)
    df = clean.rename(df, {"LOAN_AMOUNT": "loan", "INCOME_MONTHLY": "income"})
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    cnt = counts.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("non_null")) for c in df.columns])).alias("r")
    ).select("r.*")
    # both sides have one row per column
    return clean.schema_table(df).drop("nullable").join(cnt, "column").select(
        F.col("position").cast("int").alias("position"), "column", "type", "non_null")


_SPARSE = ["N_ITEMS", "PRICE_M1", "PRICE_M2", "PRICE_M3", "QTY_M3", "REGION"]


@register("b7_sparse_columns", with_fixture(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (count(*) - count({c})) * 1.0 / count(*) AS missing_share, "
    f"(count(*) - count({c})) * 1.0 / count(*) > 0.5 AS dropped FROM applications" for c in _SPARSE)),
    ["missing_share"], "B7")
def b7_sparse_columns(spark, sf):
    return clean.sparse_columns(applications(spark, sf), 0.5, _SPARSE)


@register("b10_date_parts", with_fixture("""
SELECT CAST(year(DATE_MONTH) AS SMALLINT) AS "YEAR", CAST(month(DATE_MONTH) AS TINYINT) AS "MONTH",
       count(*) AS n FROM applications GROUP BY ALL"""), [], "B10 B5")
def b10_date_parts(spark, sf):
    return clean.add_date_parts(applications(spark, sf)).groupBy("YEAR", "MONTH").agg(
        F.count(F.lit(1)).alias("n"))


@register("c1_temporal_split", with_fixture(f"""
SELECT CASE WHEN DATE_MONTH < TIMESTAMP '{TRAIN_CUTOFF}' THEN 'train' ELSE 'test' END AS side,
       count(*) AS n, count(*) * 100.0 / sum(count(*)) OVER () AS share,
       avg(TARGET) * 100 AS default_rate
FROM applications GROUP BY 1"""), ["share", "default_rate"], "C1 G2")
def c1_temporal_split(spark, sf):
    from riskframe.operators.prepare import split_summary
    tr, te = clean.temporal_split(applications(spark, sf), "DATE_MONTH", TRAIN_CUTOFF)
    return split_summary(tr, te)


@register("c7_min_group_size", with_fixture("""
g AS (SELECT NATION, PRIORITY FROM applications GROUP BY ALL HAVING count(*) >= 120)
SELECT a.NATION, a.PRIORITY, count(*) AS n FROM applications a
JOIN g ON a.NATION = g.NATION AND a.PRIORITY = g.PRIORITY GROUP BY ALL"""), [], "C7 C2 C4")
def c7_min_group_size(spark, sf):
    df = clean.drop_missing(applications(spark, sf), ["NATION", "PRIORITY"])
    return clean.min_group_size(df, ["NATION", "PRIORITY"], 120).groupBy("NATION", "PRIORITY").agg(
        F.count(F.lit(1)).alias("n"))


# -------------------------------------------------------------- duplicates


@register("d1_remove_duplicates_first", with_fixture("""
r AS (SELECT CUSTOMER_ID, SEGMENT, CLIENT_ID, DATE_MONTH,
             row_number() OVER (PARTITION BY CUSTOMER_ID, SEGMENT ORDER BY DATE_MONTH, CLIENT_ID) AS k
      FROM applications)
SELECT CUSTOMER_ID, SEGMENT, CLIENT_ID, CAST(DATE_MONTH AS DATE) AS DATE_MONTH FROM r WHERE k = 1"""), [], "D1")
def d1_remove_duplicates_first(spark, sf):
    """First order of each customer (keep='first' in date order)."""
    df = applications(spark, sf).select("CUSTOMER_ID", "SEGMENT", "CLIENT_ID", "DATE_MONTH")
    out = clean.remove_duplicates(df, ["CUSTOMER_ID", "SEGMENT"], "first", ["DATE_MONTH", "CLIENT_ID"])
    return out.withColumn("DATE_MONTH", F.to_date("DATE_MONTH"))


@register("d1_remove_duplicates_none", with_fixture("""
SELECT CUSTOMER_ID, min(PRIORITY) AS PRIORITY FROM applications
GROUP BY CUSTOMER_ID HAVING count(*) = 1"""), [], "D1")
def d1_remove_duplicates_none(spark, sf):
    """keep=False: customers with exactly one order."""
    df = applications(spark, sf).select("CUSTOMER_ID", "PRIORITY")
    return clean.remove_duplicates(df, ["CUSTOMER_ID"], False)


# ---------------------------------------------------------------- outliers


@register("d3_iqr_outliers", with_fixture("""
q AS (SELECT quantile_cont(PRICE_TOTAL, 0.25) AS q1, quantile_cont(PRICE_TOTAL, 0.75) AS q3 FROM applications)
SELECT CLIENT_ID, PRICE_TOTAL FROM applications, q
WHERE PRICE_TOTAL < q1 - 1.5 * (q3 - q1) OR PRICE_TOTAL > q3 + 1.5 * (q3 - q1)"""),
    ["PRICE_TOTAL"], "D3")
def d3_iqr_outliers(spark, sf):
    df = clean.detect_outliers_iqr(applications(spark, sf).select("CLIENT_ID", "PRICE_TOTAL"), "PRICE_TOTAL")
    return df.filter("PRICE_TOTAL_outlier").select("CLIENT_ID", "PRICE_TOTAL")


_OUT = ["LOAN_AMOUNT", "INCOME_MONTHLY", "N_ITEMS", "QTY_TOTAL", "PRICE_TOTAL", "AVG_DISCOUNT",
        "AVG_TAX", "AVG_DAYS_TO_SHIP", "QTY_M1"]


def _outlier_sql():
    parts = []
    for c in _OUT:
        parts.append(f"""SELECT '{c}' AS "column", q1, q3, lo, hi,
  (SELECT count_if({c} < lo OR {c} > hi) FROM applications) AS cnt,
  (SELECT count(*) FROM applications) AS n,
  (SELECT min({c}) FROM applications) AS mn, (SELECT max({c}) FROM applications) AS mx
  FROM (SELECT q1, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
       (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM applications))""")
    return with_fixture("o AS (" + " UNION ALL ".join(parts) + """)
SELECT "column", CAST(cnt AS BIGINT) AS "count", round(cnt * 100.0 / n, 2) AS pct, round(lo, 2) AS lower_bound,
       round(hi, 2) AS upper_bound, round(CAST(mn AS DOUBLE), 2) AS "min", round(CAST(mx AS DOUBLE), 2) AS "max"
FROM o WHERE cnt * 100.0 / n > 1""")


@register("d4_outlier_report", _outlier_sql(), ["pct", "lower_bound", "upper_bound", "min", "max"], "D4")
def d4_outlier_report(spark, sf):
    return clean.outlier_report(applications(spark, sf), _OUT)


@register("d5_cap_outliers", with_fixture("""
q AS (SELECT quantile_cont(LOAN_AMOUNT, 0.01) AS lo, quantile_cont(LOAN_AMOUNT, 0.99) AS hi FROM applications)
SELECT CLIENT_ID, least(greatest(LOAN_AMOUNT, lo), hi) AS LOAN_AMOUNT FROM applications, q"""),
    ["LOAN_AMOUNT"], "D5")
def d5_cap_outliers(spark, sf):
    return clean.cap_outliers(applications(spark, sf).select("CLIENT_ID", "LOAN_AMOUNT"), "LOAN_AMOUNT")


_WIN = ["LOAN_AMOUNT", "INCOME_MONTHLY", "PRICE_TOTAL", "AVG_DAYS_TO_SHIP"]


@register("d6_winsorize_report", with_fixture(" UNION ALL ".join(f"""
SELECT '{c}' AS "column", lo AS p_low, hi AS p_high,
  (SELECT CAST(count_if({c} < lo) AS BIGINT) FROM applications) AS n_low,
  (SELECT CAST(count_if({c} > hi) AS BIGINT) FROM applications) AS n_high
FROM (SELECT quantile_cont({c}, 0.01) AS lo, quantile_cont({c}, 0.99) AS hi FROM applications)"""
    for c in _WIN)), ["p_low", "p_high"], "D6")
def d6_winsorize_report(spark, sf):
    _, report = clean.winsorize(applications(spark, sf), _WIN)
    return report


@register("d6_winsorized_rows", with_fixture("""
q AS (SELECT quantile_cont(INCOME_MONTHLY, 0.01) AS lo, quantile_cont(INCOME_MONTHLY, 0.99) AS hi
      FROM applications WHERE DATE_MONTH < TIMESTAMP '2000-07-01')
SELECT CLIENT_ID, least(greatest(INCOME_MONTHLY, lo), hi) AS INCOME_MONTHLY
FROM applications, q WHERE DATE_MONTH >= TIMESTAMP '2000-07-01'"""), ["INCOME_MONTHLY"], "D6 C1")
def d6_winsorized_rows(spark, sf):
    """Bounds fitted on the train months, applied to the test months."""
    apps = applications(spark, sf).select("CLIENT_ID", "DATE_MONTH", "INCOME_MONTHLY")
    tr, te = clean.temporal_split(apps, "DATE_MONTH", TRAIN_CUTOFF)
    out, _ = clean.winsorize(te, ["INCOME_MONTHLY"], fit_df=tr)
    return out.select("CLIENT_ID", "INCOME_MONTHLY")


# -------------------------------------------------------------- validation


@register("d10_d13_validations", with_fixture("""
a AS (SELECT count(*) AS n, count_if(TARGET IS NOT NULL AND TARGET NOT IN (0, 1)) AS bad,
             count_if(TARGET IS NULL) AS nulls, count_if(TARGET = 0) AS n0, count_if(TARGET = 1) AS n1,
             min(DATE_MONTH) AS dmin, max(DATE_MONTH) AS dmax FROM applications),
c AS (
  SELECT 'shape' AS "check", 'ok' AS status, CAST(n AS VARCHAR) || ' x 26' AS detail FROM a
  UNION ALL SELECT 'binary_values', CASE WHEN bad > 0 THEN 'error' ELSE 'ok' END,
                   'non-binary values: ' || CAST(bad AS VARCHAR) FROM a
  UNION ALL SELECT 'missing_target', CASE WHEN nulls > 0 THEN 'warning' ELSE 'ok' END,
                   'missing: ' || CAST(nulls AS VARCHAR) FROM a
  UNION ALL SELECT 'class_balance', CASE WHEN least(n0, n1) * 100.0 / (n0 + n1) < 10 THEN 'warning' ELSE 'ok' END,
                   'minority %: ' || printf('%.1f', least(n0, n1) * 100.0 / (n0 + n1)) FROM a
  UNION ALL SELECT 'date_range', 'ok', strftime(dmin, '%Y-%m-%d %H:%M:%S') || ' .. ' || strftime(dmax, '%Y-%m-%d %H:%M:%S') FROM a)
SELECT * FROM c
UNION ALL SELECT 'all_valid', CASE WHEN bool_and(status <> 'error') THEN 'ok' ELSE 'error' END,
                 CASE WHEN bool_and(status <> 'error') THEN 'true' ELSE 'false' END FROM c"""),
    [], "D10 D12 D13")
def d10_d13_validations(spark, sf):
    return validate.run_all_validations(applications(spark, sf))


_RULES = {"INCOME_MONTHLY": (0.0, None), "AVG_DISCOUNT": (0.0, 0.1), "N_ITEMS": (1, 7),
          "AVG_DAYS_TO_SHIP": (None, 60.0)}


def _rules_sql():
    parts = []
    for col, (lo, hi) in _RULES.items():
        below = f"count_if({col} < {lo})" if lo is not None else "0"
        above = f"count_if({col} > {hi})" if hi is not None else "0"
        parts.append(f"""SELECT '{col}' AS "column", CAST(min({col}) AS DOUBLE) AS "min",
  CAST(max({col}) AS DOUBLE) AS "max", CAST({below} AS BIGINT) AS n_below_min,
  CAST({above} AS BIGINT) AS n_above_max, ({below}) + ({above}) = 0 AS valid FROM applications""")
    return with_fixture(" UNION ALL ".join(parts))


@register("d11_d22_range_rules", _rules_sql(), ["min", "max"], "D11 D22 C3")
def d11_d22_range_rules(spark, sf):
    return validate.validate_numeric_ranges(applications(spark, sf), _RULES)


@register("d12_leakage_check", with_fixture("""
SELECT CAST(min(DATE_MONTH) AS DATE) AS min_date, CAST(max(DATE_MONTH) AS DATE) AS max_date,
       CAST(count_if(DATE_MONTH > TIMESTAMP '2000-06-30') AS BIGINT) AS n_after_cut,
       count_if(DATE_MONTH > TIMESTAMP '2000-06-30') = 0 AS valid
FROM applications WHERE DATE_MONTH < TIMESTAMP '2000-07-01'"""), [], "D12")
def d12_leakage_check(spark, sf):
    tr, _ = clean.temporal_split(applications(spark, sf), "DATE_MONTH", TRAIN_CUTOFF)
    out = validate.validate_no_leakage(tr, "DATE_MONTH", "2000-06-30")
    return out.withColumns({"min_date": F.to_date("min_date"), "max_date": F.to_date("max_date")})


# -------------------------------------------------------------- imputation

_IMP = ["N_ITEMS", "PRICE_M3", "AVG_DAYS_TO_SHIP"]


@register("e1_impute_numeric", with_fixture("""
s AS (SELECT avg(PRICE_M3) AS mean_p, quantile_cont(PRICE_M3, 0.5) AS med_p,
             quantile_cont(AVG_DAYS_TO_SHIP, 0.5) AS med_d FROM applications),
m AS (SELECT CAST(N_ITEMS AS DOUBLE) AS mode_n FROM applications WHERE N_ITEMS IS NOT NULL
      GROUP BY N_ITEMS ORDER BY count(*) DESC, N_ITEMS LIMIT 1)
SELECT CLIENT_ID, coalesce(PRICE_M3, mean_p) AS PRICE_M3_mean, coalesce(PRICE_M3, med_p) AS PRICE_M3_median,
       coalesce(AVG_DAYS_TO_SHIP, med_d) AS AVG_DAYS_TO_SHIP_median,
       coalesce(CAST(N_ITEMS AS DOUBLE), mode_n) AS N_ITEMS_mode,
       coalesce(PRICE_M3, 0.0) AS PRICE_M3_constant
FROM applications, s, m"""),
    ["PRICE_M3_mean", "PRICE_M3_median", "AVG_DAYS_TO_SHIP_median", "N_ITEMS_mode", "PRICE_M3_constant"], "E1")
def e1_impute_numeric(spark, sf):
    """The four E1 strategies on the same frame, fitted once each and
    applied in one projection."""
    df = applications(spark, sf).select("CLIENT_ID", *_IMP)
    mean = impute.fit_numeric(df, ["PRICE_M3"], "mean")
    median = impute.fit_numeric(df, ["PRICE_M3", "AVG_DAYS_TO_SHIP"], "median")
    mode = impute.fit_numeric(df, ["N_ITEMS"], "most_frequent")
    const = impute.fit_numeric(df, ["PRICE_M3"], "constant")
    return df.select(
        "CLIENT_ID",
        F.coalesce("PRICE_M3", F.lit(mean["PRICE_M3"])).alias("PRICE_M3_mean"),
        F.coalesce("PRICE_M3", F.lit(median["PRICE_M3"])).alias("PRICE_M3_median"),
        F.coalesce("AVG_DAYS_TO_SHIP", F.lit(median["AVG_DAYS_TO_SHIP"])).alias("AVG_DAYS_TO_SHIP_median"),
        F.coalesce(F.col("N_ITEMS").cast("double"), F.lit(mode["N_ITEMS"])).alias("N_ITEMS_mode"),
        F.coalesce("PRICE_M3", F.lit(const["PRICE_M3"])).alias("PRICE_M3_constant"))


@register("e2_impute_categorical", with_fixture("""
m AS (SELECT REGION AS mode_r FROM applications WHERE REGION IS NOT NULL
      GROUP BY REGION ORDER BY count(*) DESC, REGION LIMIT 1)
SELECT CLIENT_ID, coalesce(REGION, mode_r) AS REGION_mode, coalesce(REGION, 'Unknown') AS REGION_constant
FROM applications, m"""), [], "E2 E6")
def e2_impute_categorical(spark, sf):
    df = applications(spark, sf).select("CLIENT_ID", "REGION")
    a = impute.impute_categorical(df, ["REGION"], "most_frequent").withColumnRenamed("REGION", "REGION_mode")
    b = impute.fill_constant(df, "REGION", "Unknown").withColumnRenamed("REGION", "REGION_constant")
    return a.join(b, "CLIENT_ID")


@register("e4_missing_indicators", with_fixture("""
SELECT CASE WHEN REGION IS NULL THEN 1 ELSE 0 END AS REGION_missing,
       CASE WHEN PRICE_M3 IS NULL THEN 1 ELSE 0 END AS PRICE_M3_missing,
       CASE WHEN N_ITEMS IS NULL THEN 1 ELSE 0 END AS N_ITEMS_missing, count(*) AS n
FROM applications GROUP BY ALL"""), [], "E4")
def e4_missing_indicators(spark, sf):
    df = applications(spark, sf).select("CLIENT_ID", "REGION", "PRICE_M3", "N_ITEMS", "LOAN_AMOUNT")
    out = impute.missing_indicators(df, None, threshold=0.01)
    return out.groupBy(*[c for c in out.columns if c.endswith("_missing")]).agg(
        F.count(F.lit(1)).alias("n"))


@register("p1_preprocess", with_fixture("""
SELECT CLIENT_ID, CAST(TARGET AS TINYINT) AS TARGET,
       coalesce(CASE WHEN regexp_matches(REGION, '^\\s*$') THEN NULL ELSE REGION END, 'INCONNU') AS REGION,
       CAST(N_ITEMS AS INTEGER) AS N_ITEMS,
       CAST(year(DATE_MONTH) AS SMALLINT) AS "YEAR", CAST(month(DATE_MONTH) AS TINYINT) AS "MONTH",
       """ + sflag("CHECKING_BALANCE_M1 < 0 OR CHECKING_BALANCE_M2 < 0 OR CHECKING_BALANCE_M3 < 0") + """ AS HAS_NEGATIVE_BALANCE,
       SAVINGS_BALANCE_M1 - SAVINGS_BALANCE_M3 AS SAVINGS_TREND,
       CHECKING_BALANCE_M1 - CHECKING_BALANCE_M3 AS CHECKING_TREND
FROM credit"""), ["SAVINGS_TREND", "CHECKING_TREND"], "E5 E6 B5 B10 F1 F2 F3")
def p1_preprocess(spark, sf):
    """Exploration pipeline's cleaning step on the credit view."""
    df = credit_view(spark, sf)
    df = impute.blank_to_null(df, ["REGION"])
    df = impute.fill_constant(df, "REGION", "INCONNU")
    df = clean.narrow_types(df, {"TARGET": "tinyint", "N_ITEMS": "int"})
    df = clean.add_date_parts(df)
    df = features.balance_flags(df)
    return df.select("CLIENT_ID", "TARGET", "REGION", "N_ITEMS", "YEAR", "MONTH",
                     "HAS_NEGATIVE_BALANCE", "SAVINGS_TREND", "CHECKING_TREND")


@register("d24_before_after", with_fixture("""
SELECT 'before' AS stage, count(*) AS "rows", CAST(3 AS BIGINT) AS "columns",
       CAST(count_if(REGION IS NULL) + count_if(PRICE_M3 IS NULL) AS BIGINT) AS nulls,
       CAST(2 AS BIGINT) AS columns_treated
FROM applications
UNION ALL SELECT 'after', count(*), CAST(3 AS BIGINT), CAST(0 AS BIGINT), CAST(2 AS BIGINT) FROM applications"""), [], "D24")
def d24_before_after(spark, sf):
    df = applications(spark, sf).select("CLIENT_ID", "REGION", "PRICE_M3")
    after = impute.impute_numeric(impute.fill_constant(df, "REGION", "INCONNU"), ["PRICE_M3"], "median")
    return validate.before_after_summary(df, after, ["REGION", "PRICE_M3"]).select(
        "stage", "rows", "columns", "nulls", "columns_treated")


# ---------------------------------------------------------------- features

FIN_SQL = {
    "SAVINGS_TO_INCOME": sdiv("SAVINGS_BALANCE_M1", "INCOME_MONTHLY + 1"),
    "CHECKING_TO_INCOME": sdiv("CHECKING_BALANCE_M1", "INCOME_MONTHLY + 1"),
    "TOTAL_BALANCE_M1": "SAVINGS_BALANCE_M1 + CHECKING_BALANCE_M1",
    "TOTAL_BALANCE_M2": "SAVINGS_BALANCE_M2 + CHECKING_BALANCE_M2",
    "TOTAL_BALANCE_M3": "SAVINGS_BALANCE_M3 + CHECKING_BALANCE_M3",
    "AVG_TOTAL_BALANCE": "((SAVINGS_BALANCE_M1 + CHECKING_BALANCE_M1) + (SAVINGS_BALANCE_M2 + "
                         "CHECKING_BALANCE_M2) + (SAVINGS_BALANCE_M3 + CHECKING_BALANCE_M3)) / 3",
    "LOAN_TO_ANNUAL_INCOME": sdiv("LOAN_AMOUNT", "INCOME_MONTHLY * 12 + 1"),
    "REPAYMENT_CAPACITY": "INCOME_MONTHLY - EXPENSES_MONTHLY - MONTHLY_INSTALLMENT",
    "EXPENSE_RATIO": sdiv("EXPENSES_MONTHLY", "INCOME_MONTHLY + 1"),
    "FINANCIAL_MARGIN": "INCOME_MONTHLY - EXPENSES_MONTHLY",
    "FINANCIAL_STRESS": sflag("DTI_RATIO > 0.4 OR " + sdiv("EXPENSES_MONTHLY", "INCOME_MONTHLY + 1") + " > 0.7"),
}
BEH_SQL = {
    "TOTAL_TXN_30D": "CAST(POS_TXN_COUNT_30D + ATM_TXN_COUNT_30D + ONLINE_TXN_COUNT_30D AS DOUBLE)",
    "ONLINE_TXN_RATIO": sdiv("ONLINE_TXN_COUNT_30D",
                             "POS_TXN_COUNT_30D + ATM_TXN_COUNT_30D + ONLINE_TXN_COUNT_30D + 1"),
    "TOTAL_DIGITAL_LOGINS": "MOBILE_LOGINS_30D + WEB_LOGINS_30D",
    "MOBILE_PREFERENCE": sdiv("MOBILE_LOGINS_30D", "MOBILE_LOGINS_30D + WEB_LOGINS_30D + 1"),
    "DIGITAL_ENGAGEMENT": "MOBILE_LOGINS_30D + WEB_LOGINS_30D + ONLINE_TXN_COUNT_30D * 2",
    "IS_BRANCH_ACTIVE": sflag("BRANCH_VISITS_6M >= 2"),
    "WITHDRAWAL_DEPOSIT_RATIO": sdiv("LAST_WITHDRAWAL_AMOUNT", "LAST_DEPOSIT_AMOUNT + 1"),
}
STAB_SQL = {
    "SAVINGS_STABILITY": srow_std(SAV),
    "CHECKING_STABILITY": srow_std(CHK),
    "BALANCE_CV": sdiv(srow_std(SAV), f"abs({srow_mean(SAV)}) + 1"),
    "SAVINGS_TREND": "SAVINGS_BALANCE_M1 - SAVINGS_BALANCE_M3",
    "SAVINGS_TREND_RATIO": sdiv("SAVINGS_BALANCE_M1 - SAVINGS_BALANCE_M3", "abs(SAVINGS_BALANCE_M3) + 1"),
    "CHECKING_TREND": "CHECKING_BALANCE_M1 - CHECKING_BALANCE_M3",
    "CHECKING_TREND_RATIO": sdiv("CHECKING_BALANCE_M1 - CHECKING_BALANCE_M3", "abs(CHECKING_BALANCE_M3) + 1"),
    "EMPLOYMENT_STABILITY": sflag("SENIORITY_YEARS >= 2"),
    "RESIDENCE_STABILITY": sflag("RESIDENCE_SINCE_YEARS >= 2"),
}
RISK_SQL = {
    "RISK_SCORE_CUSTOM": "CAST(NUM_LATE_PAYMENTS_12M * 10 + HAS_PREVIOUS_DEFAULT * 20 + INQUIRIES_6M * 5 + "
                         "CAST(coalesce(UTILIZATION_RATE > 0.7, false) AS INTEGER) * 15 + "
                         "CAST(coalesce(DTI_RATIO > 0.5, false) AS INTEGER) * 10 AS BIGINT)",
    "CREDIT_SCORE_NORM": sdiv("CREDIT_SCORE - (SELECT min(CREDIT_SCORE) FROM credit)",
                              "(SELECT max(CREDIT_SCORE) - min(CREDIT_SCORE) FROM credit)"),
    "CREDIT_SCORE_CAT": "CASE WHEN CREDIT_SCORE > 0 AND CREDIT_SCORE <= 500 THEN 'very_poor' "
                        "WHEN CREDIT_SCORE > 500 AND CREDIT_SCORE <= 600 THEN 'poor' "
                        "WHEN CREDIT_SCORE > 600 AND CREDIT_SCORE <= 700 THEN 'fair' "
                        "WHEN CREDIT_SCORE > 700 AND CREDIT_SCORE <= 800 THEN 'good' "
                        "WHEN CREDIT_SCORE > 800 AND CREDIT_SCORE <= 1000 THEN 'excellent' END",
    "LOAN_UTILIZATION": sdiv("NUM_OPEN_LOANS", "TOTAL_CREDIT_LIMIT / 10000 + 1"),
    "HIGH_RISK_FLAG": sflag("NUM_LATE_PAYMENTS_12M >= 2 OR HAS_PREVIOUS_DEFAULT = 1 OR CREDIT_SCORE < 550 "
                            "OR DTI_RATIO > 0.6"),
    "IS_NEW_CLIENT": sflag("SENIORITY_YEARS < 1 AND NUM_OPEN_LOANS = 0"),
}
INTER_SQL = {
    "AGE_SENIORITY": "AGE * SENIORITY_YEARS",
    "INCOME_CREDIT_SCORE": "INCOME_MONTHLY * " + RISK_SQL["CREDIT_SCORE_NORM"],
    "DTI_UTILIZATION": "DTI_RATIO * UTILIZATION_RATE",
    "LOAN_INTEREST_COST": "LOAN_AMOUNT * INTEREST_RATE",
    "BALANCE_LOAN_TERM": sdiv(FIN_SQL["AVG_TOTAL_BALANCE"], "LOAN_TERM_MONTHS + 1"),
}


def _family_sql(exprs: dict) -> str:
    return with_fixture("SELECT CLIENT_ID, " + ", ".join(f"{v} AS {k}" for k, v in exprs.items())
                        + " FROM credit")


def _doubles(exprs: dict) -> list[str]:
    return [k for k, v in exprs.items() if "TINYINT" not in v and k not in (
        "TOTAL_TXN_30D", "RISK_SCORE_CUSTOM", "CREDIT_SCORE_CAT")]


@register("f_financial", _family_sql(FIN_SQL), _doubles(FIN_SQL), "F4-F14")
def f_financial(spark, sf):
    return features.financial_features(credit_view(spark, sf)).select("CLIENT_ID", *FIN_SQL)


@register("f_behavioural", _family_sql(BEH_SQL), _doubles(BEH_SQL) + ["TOTAL_TXN_30D"], "F15-F21")
def f_behavioural(spark, sf):
    out = features.behavioural_features(credit_view(spark, sf)).select("CLIENT_ID", *BEH_SQL)
    return out.withColumns({"TOTAL_TXN_30D": F.col("TOTAL_TXN_30D").cast("double"),
                            "DIGITAL_ENGAGEMENT": F.col("DIGITAL_ENGAGEMENT").cast("double"),
                            "TOTAL_DIGITAL_LOGINS": F.col("TOTAL_DIGITAL_LOGINS").cast("double")})


@register("f_stability", _family_sql(STAB_SQL), _doubles(STAB_SQL), "F22-F28")
def f_stability(spark, sf):
    return features.stability_features(credit_view(spark, sf)).select("CLIENT_ID", *STAB_SQL)


@register("f_risk", _family_sql(RISK_SQL), ["CREDIT_SCORE_NORM", "LOAN_UTILIZATION"], "F29-F34")
def f_risk(spark, sf):
    out = features.risk_features(credit_view(spark, sf)).select("CLIENT_ID", *RISK_SQL)
    return out.withColumn("RISK_SCORE_CUSTOM", F.col("RISK_SCORE_CUSTOM").cast("bigint"))


@register("f_interactions", _family_sql(INTER_SQL), list(INTER_SQL), "F35-F39")
def f_interactions(spark, sf):
    df = features.risk_features(features.financial_features(credit_view(spark, sf)))
    return features.interaction_features(df).select("CLIENT_ID", *INTER_SQL)


_F40_NUM = [k for k in list(FIN_SQL) + list(BEH_SQL) + list(STAB_SQL) + list(RISK_SQL) + list(INTER_SQL)
            if k != "CREDIT_SCORE_CAT"]
_F40_NUM = list(dict.fromkeys(_F40_NUM))


def _f40_sql() -> str:
    allx = {**FIN_SQL, **BEH_SQL, **STAB_SQL, **RISK_SQL, **INTER_SQL}
    cols = ", ".join(f"{v} AS {k}" for k, v in allx.items() if k != "CREDIT_SCORE_CAT")
    fill = ", ".join(f"CAST(coalesce({k}, (SELECT quantile_cont({k}, 0.5) FROM feats)) AS DOUBLE) AS {k}"
                     for k in _F40_NUM)
    return with_fixture(f"feats AS (SELECT CLIENT_ID, {cols} FROM credit) SELECT CLIENT_ID, {fill} FROM feats")


@register("f40_engineer_features", _f40_sql(), _F40_NUM, "F40 E7")
def f40_engineer_features(spark, sf):
    out = features.engineer_features(credit_view(spark, sf))
    return out.select("CLIENT_ID", *[F.col(k).cast("double").alias(k) for k in _F40_NUM])
