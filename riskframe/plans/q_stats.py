"""Registered queries: statistical selection (H1-H11) on the fixture."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import select, stats
from riskframe.plans.registry import REGISTRY, register
from riskframe.sources.fixtures import applications, with_fixture

QUANT = ["LOAN_AMOUNT", "INCOME_MONTHLY", "N_ITEMS", "PRICE_TOTAL", "AVG_DISCOUNT", "AVG_TAX",
         "AVG_DAYS_TO_SHIP", "QTY_M1"]
QUAL = ["STATUS", "PRIORITY", "SEGMENT", "NATION", "REGION"]


def _long_sql(cols, cast="DOUBLE", extra="TARGET AS y", alias="value"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS variable, CAST({c} AS {cast}) AS {alias}, {extra} FROM applications" for c in cols)


@register("h1_contingency", with_fixture("""
SELECT PRIORITY, SEGMENT, count(*) AS n FROM applications
WHERE PRIORITY IS NOT NULL AND SEGMENT IS NOT NULL GROUP BY ALL"""), [], "H1")
def h1_contingency(spark, sf):
    return stats.contingency(applications(spark, sf), "PRIORITY", "SEGMENT")


def _chi2_sql(pairs_cte: str, key: str, key_out: str | None = None, where: str = "r >= 2") -> str:
    return pairs_cte + f""",
cells AS (SELECT {key}, a, b, count(*) AS n FROM lng WHERE a IS NOT NULL AND b IS NOT NULL GROUP BY ALL),
rw AS (SELECT {key}, a, sum(n) AS rt FROM cells GROUP BY ALL),
cl AS (SELECT {key}, b, sum(n) AS ct FROM cells GROUP BY ALL),
sh AS (SELECT {key}, sum(n) AS nn, count(DISTINCT a) AS r, count(DISTINCT b) AS k FROM cells GROUP BY ALL),
grid AS (SELECT rw.{key}, rw.a, cl.b, rt, ct FROM rw JOIN cl USING ({key})),
e AS (SELECT g.{key}, CAST(coalesce(c.n, 0) AS DOUBLE) AS o, rt * ct * 1.0 / sh.nn AS ex, r, k, nn
      FROM grid g JOIN sh USING ({key}) LEFT JOIN cells c ON c.{key} = g.{key} AND c.a = g.a AND c.b = g.b),
chi AS (SELECT {key}, r, k, nn, sum(CASE WHEN r = 2 AND k = 2
                  THEN pow(abs(o - ex) - least(0.5, abs(o - ex)), 2) / ex
                  ELSE pow(o - ex, 2) / ex END) AS chi2 FROM e GROUP BY ALL)
SELECT {key_out or key}, r, k, CAST(nn AS BIGINT) AS n, chi2, CAST((r - 1) * (k - 1) AS BIGINT) AS dof,
       sqrt(greatest(0, chi2 / nn - (k - 1) * (r - 1) / (nn - 1.0))
            / (least(k - pow(k - 1, 2) / (nn - 1.0) - 1, r - pow(r - 1, 2) / (nn - 1.0) - 1) + 1e-10)) AS V
FROM chi WHERE {where}"""


_H3_LONG = "lng AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS variable, {c} AS a, CAST(TARGET AS VARCHAR) AS b FROM applications" for c in QUAL) + ")"


@register("h2_h3_chi2_vs_target", with_fixture(_chi2_sql(_H3_LONG, "variable")), ["chi2", "V"], "H2 H3")
def h2_h3_chi2_vs_target(spark, sf):
    return stats.chi2_vs_target(applications(spark, sf), QUAL, with_p=False)


_PAIR_COLS = ["PRIORITY", "SEGMENT", "NATION", "REGION"]
_H8_LONG = "lng AS (" + " UNION ALL ".join(
    f"SELECT '{a}|{b}' AS pair, {a} AS a, {b} AS b FROM applications"
    for i, a in enumerate(_PAIR_COLS) for b in _PAIR_COLS[i + 1:]) + ")"


@register("h8_cramers_v_pairs", with_fixture(_chi2_sql(
    _H8_LONG, "pair", "split_part(pair, '|', 1) AS var1, split_part(pair, '|', 2) AS var2",
    "r >= 2 AND k >= 2")), ["chi2", "V"], "H8 H1")
def h8_cramers_v_pairs(spark, sf):
    return stats.cramers_v_pairs(applications(spark, sf), _PAIR_COLS)


_SP = ["LOAN_AMOUNT", "INCOME_MONTHLY", "PRICE_TOTAL", "N_ITEMS", "CUSTOMER_ID"]


def _spearman_frame(spark, sf):
    return applications(spark, sf).select(
        "LOAN_AMOUNT", "INCOME_MONTHLY", F.coalesce("PRICE_TOTAL", F.lit(0.0)).alias("PRICE_TOTAL"),
        F.coalesce("N_ITEMS", F.lit(0)).alias("N_ITEMS"), "CUSTOMER_ID", "TARGET")


_SP_RANKS = with_fixture("""
base AS (SELECT LOAN_AMOUNT, INCOME_MONTHLY, coalesce(PRICE_TOTAL, 0.0) AS PRICE_TOTAL,
                coalesce(N_ITEMS, 0) AS N_ITEMS, CUSTOMER_ID, TARGET FROM applications),
rk AS (SELECT """ + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}_r"
    for c in _SP + ["TARGET"]) + " FROM base)")


@register("h4_h5_spearman", _SP_RANKS + " " + " UNION ALL ".join(
    [f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}_r, {b}_r) AS r FROM rk"
     for i, a in enumerate(_SP) for b in _SP[i + 1:]]
    + [f"SELECT '{c}', 'TARGET', corr({c}_r, TARGET_r) FROM rk" for c in _SP]), ["r"], "H4 H5 W1")
def h4_h5_spearman(spark, sf):
    return stats.spearman_pairs(_spearman_frame(spark, sf), _SP, target="TARGET")


@register("h6_spearman_pruning", _SP_RANKS + """,
pairs AS (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS var1, '{b}' AS var2, corr({a}_r, {b}_r) AS r FROM rk"
    for i, a in enumerate(_SP) for b in _SP[i + 1:]) + """),
st AS (""" + " UNION ALL ".join(f"SELECT '{c}' AS variable, abs(corr({c}_r, TARGET_r)) AS s FROM rk"
                               for c in _SP) + """)
SELECT var1, var2, r, s1.s AS s1, s2.s AS s2,
       CASE WHEN s1.s >= s2.s THEN var1 ELSE var2 END AS kept,
       CASE WHEN s1.s >= s2.s THEN var2 ELSE var1 END AS dropped
FROM pairs JOIN st s1 ON s1.variable = var1 JOIN st s2 ON s2.variable = var2
WHERE abs(r) > 0.8""", ["r", "s1", "s2"], "H6")
def h6_spearman_pruning(spark, sf):
    sp = stats.spearman_pairs(_spearman_frame(spark, sf), _SP, target="TARGET")
    strength = sp.filter(F.col("var2") == "TARGET").select(F.col("var1").alias("variable"),
                                                           F.abs("r").alias("s"))
    return stats.prune_redundant(sp.filter(F.col("var2") != "TARGET"), strength, _SP, 0.8)


@register("h7_mann_whitney", with_fixture("lng AS (" + _long_sql(QUANT) + """),
v AS (SELECT variable, value + 0.0 AS value, y FROM lng WHERE value IS NOT NULL AND y IS NOT NULL),
r AS (SELECT variable, y, value,
             rank() OVER (PARTITION BY variable ORDER BY value)
             + (count(*) OVER (PARTITION BY variable, value) - 1) / 2.0 AS ar FROM v),
t AS (SELECT variable, value, CAST(count(*) AS DOUBLE) AS t FROM v GROUP BY ALL),
ties AS (SELECT variable, sum(t * t * t - t) AS tt FROM t GROUP BY variable),
a AS (SELECT variable, count_if(y = 0) AS n0, count_if(y = 1) AS n1, CAST(count(*) AS DOUBLE) AS nn,
             sum(CASE WHEN y = 0 THEN ar END) AS r0,
             quantile_cont(value, 0.5) FILTER (WHERE y = 0) AS median_0,
             quantile_cont(value, 0.5) FILTER (WHERE y = 1) AS median_1 FROM r GROUP BY variable)
SELECT variable, CAST(n0 AS BIGINT) AS n0, CAST(n1 AS BIGINT) AS n1, r0 - n0 * (n0 + 1) / 2.0 AS U,
       (abs(r0 - n0 * (n0 + 1) / 2.0 - n0 * n1 / 2.0) - 0.5)
         / sqrt(n0 * n1 / 12.0 * ((nn + 1) - tt / (nn * (nn - 1)))) AS z,
       median_0, median_1
FROM a JOIN ties USING (variable) WHERE n0 >= 5 AND n1 >= 5"""), ["U", "z", "median_0", "median_1"], "H7 W1")
def h7_mann_whitney(spark, sf):
    return stats.mann_whitney(applications(spark, sf), QUANT, with_p=False)


_KQ, _KC = ["LOAN_AMOUNT", "AVG_DAYS_TO_SHIP", "QTY_M1"], ["PRIORITY", "NATION", "REGION"]


def _kruskal_sql():
    parts = []
    for q in _KQ:
        for c in _KC:
            parts.append(f"SELECT '{q}' AS var_quant, '{c}' AS var_qual, CAST({q} AS DOUBLE) + 0.0 AS x, "
                         f"{c} AS g FROM applications WHERE {q} IS NOT NULL AND {c} IS NOT NULL")
    return with_fixture("lng AS (" + " UNION ALL ".join(parts) + """),
ok AS (SELECT var_quant, var_qual, g FROM lng GROUP BY ALL HAVING count(*) >= 5),
v AS (SELECT l.* FROM lng l JOIN ok USING (var_quant, var_qual, g)),
r AS (SELECT var_quant, var_qual, g, x,
             rank() OVER (PARTITION BY var_quant, var_qual ORDER BY x)
             + (count(*) OVER (PARTITION BY var_quant, var_qual, x) - 1) / 2.0 AS ar FROM v),
gs AS (SELECT var_quant, var_qual, g, sum(ar) AS rg, count(*) AS ng FROM r GROUP BY ALL),
t AS (SELECT var_quant, var_qual, x, CAST(count(*) AS DOUBLE) AS t FROM v GROUP BY ALL),
tt AS (SELECT var_quant, var_qual, sum(t * t * t - t) AS tt, sum(t) AS nn FROM t GROUP BY ALL),
s AS (SELECT var_quant, var_qual, sum(rg * rg / ng) AS s, count(*) AS k FROM gs GROUP BY ALL)
SELECT var_quant, var_qual,
       (12.0 / (nn * (nn + 1)) * s - 3 * (nn + 1)) / (1 - tt / (nn * nn * nn - nn)) AS H,
       CAST(k - 1 AS BIGINT) AS dof, CAST(nn AS BIGINT) AS n
FROM s JOIN tt USING (var_quant, var_qual) WHERE k >= 2 AND 1 - tt / (nn * nn * nn - nn) > 0""")


@register("h9_kruskal_wallis", _kruskal_sql(), ["H"], "H9")
def h9_kruskal_wallis(spark, sf):
    return stats.kruskal_wallis(applications(spark, sf), _KQ, _KC, with_p=False)


# The engineered features the original always keeps.
FORCED_ENGINEERED = ["REPAYMENT_CAPACITY", "LOAN_TO_ANNUAL_INCOME", "TOTAL_TXN_30D",
                     "SAVINGS_TREND", "HIGH_RISK_FLAG", "DTI_UTILIZATION"]


@register("h10_h11_funnel_engineered", None, [], "F40 H3 H4-H11")
def h10_h11_funnel_engineered(spark, sf):
    """The original's selection run: the five steps over the engineered
    frame (F40 + E7), then the forced engineered features."""
    from riskframe.operators import features
    from riskframe.sources.fixtures import credit_view
    df = features.engineer_features(credit_view(spark, sf).drop("QTY_TOTAL"))
    quant = [c for c in features.ENGINEERED if c != "CREDIT_SCORE_CAT"]
    qual = ["STATUS", "PRIORITY", "SEGMENT", "NATION", "REGION", "CREDIT_SCORE_CAT"]
    return select.select_variables(df, quant, qual, "TARGET", FORCED_ENGINEERED).funnel


@register("h10_h11_selection_funnel", None, [], "H3 H6 H7 H8 H9 H10 H11")
def h10_h11_selection_funnel(spark, sf):
    """The five-step selection on the fixture; one row per (step, variable)."""
    res = select.select_variables(applications(spark, sf), QUANT, QUAL, target="TARGET",
                                  forced=["LOAN_AMOUNT", "AVG_DAYS_TO_SHIP"])
    return res.funnel


# ------------------------------------------------- the same tests with p-values

def _sum_sql(steps: str, log_term: str) -> str:
    """Sum of exp(log_term) over i in ``steps`` (0 for none)."""
    return f"coalesce(list_sum(list_transform({steps}, lambda i: exp({log_term}))), 0)"


def _erfc_sql(z: str) -> str:
    """erfc of z >= 0 by the series of positive terms of erf; below 1e-16 from 6 on."""
    x = f"greatest({z}, 1e-300)"
    terms = _sum_sql("range(0, 250)", f"2 * i * ln(2) + (2 * i + 1) * ln({x}) - lgamma(2 * i + 2) + lgamma(i + 1) - {x} * {x}")
    return f"CASE WHEN {z} >= 6 THEN 0.0 ELSE 1 - 2 / sqrt(pi()) * {terms} END"


def _chi2_p_sql(x: str, dof: str) -> str:
    """Upper tail of the chi-square law: a finite sum for whole degrees of freedom,
    after erfc where they are odd."""
    h = f"greatest({x} / 2, 1e-300)"
    even = _sum_sql(f"range(0, {dof} // 2)", f"i * ln({h}) - lgamma(i + 1) - {h}")
    odd = _sum_sql(f"range(1, ({dof} + 1) // 2)", f"(i - 0.5) * ln({h}) - lgamma(i + 0.5) - {h}")
    return f"CASE WHEN {dof} % 2 = 0 THEN {even} ELSE {_erfc_sql(f'sqrt({h})')} + {odd} END"


def _with_p(sql: str, p: str, more: str = "*") -> str:
    return f"SELECT {more} FROM (SELECT *, CAST({p} AS DOUBLE) AS p_value FROM ({sql}))"


@register("h3_chi2_selection", _with_p(REGISTRY["h2_h3_chi2_vs_target"].sql, _chi2_p_sql("chi2", "dof"),
                                       "*, p_value < 0.05 AND V > 0.05 AS discriminant"), ["chi2", "V", "p_value"], "H2 H3")
def h3_chi2_selection(spark, sf):
    """Chi-square, corrected V, p and the keep flag of every qualitative column."""
    return stats.chi2_vs_target(applications(spark, sf), QUAL)


@register("h8_cramers_v_p", _with_p(REGISTRY["h8_cramers_v_pairs"].sql, _chi2_p_sql("chi2", "dof")),
          [*REGISTRY["h8_cramers_v_pairs"].round_cols, "p_value"], "H8 H2")
def h8_cramers_v_p(spark, sf):
    """Association of every pair of qualitative columns with its p."""
    return stats.cramers_v_pairs(applications(spark, sf), _PAIR_COLS, with_p=True)


@register("h7_mann_whitney_effect", _with_p(
    REGISTRY["h7_mann_whitney"].sql, _erfc_sql("greatest(z, 0) / sqrt(2)"),
    "*, CASE WHEN z > 38 THEN 8.0 ELSE greatest(z, 0) END / sqrt(n0 + n1) AS effect_r, p_value < 0.05 AS significant"),
    ["U", "z", "median_0", "median_1", "p_value", "effect_r"], "H7")
def h7_mann_whitney_effect(spark, sf):
    """Mann-Whitney with p, effect size and the significance flag."""
    return stats.mann_whitney(applications(spark, sf), QUANT)


@register("h9_kruskal_wallis_p", _with_p(_kruskal_sql(), _chi2_p_sql("H", "dof")), ["H", "p_value"], "H9")
def h9_kruskal_wallis_p(spark, sf):
    """Kruskal-Wallis with p."""
    return stats.kruskal_wallis(applications(spark, sf), _KQ, _KC)
