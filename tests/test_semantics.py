"""Null/NaN semantics (one test per rule of SURVEY section 1) and model parity."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.functions.core import flag, nan_to_null, row_mean, row_std, safe_div
from riskframe.operators import impute, model, neighbours, prepare, profile


def test_flag_missing_comparison_is_false(spark):
    df = spark.createDataFrame([(None, 1.0), (0.5, None), (None, None)], "a double, b double")
    out = df.select(flag((F.col("a") > 0.4) | (F.col("b") > 0.7)).alias("f")).collect()
    assert [r["f"] for r in out] == [1, 1, 0]


def test_safe_div_zero_is_null(spark):
    r = spark.createDataFrame([(1.0, 0.0)], "a double, b double").select(safe_div("a", "b")).first()[0]
    assert r is None


def test_nan_and_inf_become_null(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(nan_to_null("x")).collect()] == [None, None, 1.0]


def test_row_std_skips_missing(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, 2.0)], "a double, b double, c double")
    out = df.select(row_std(["a", "b", "c"]).alias("s"), row_mean(["a", "b", "c"]).alias("m")).collect()
    assert out[0]["s"] == pytest.approx(np.std([1.0, 3.0], ddof=1))
    assert out[0]["m"] == 2.0 and out[1]["s"] is None


def test_mode_ties_to_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "c string")
    assert impute.fit_categorical(df, ["c"]) == {"c": "a"}


def test_median_imputation_exact(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (None,)], "x double")
    out = impute.impute_numeric(df, ["x"], "median").collect()
    assert sorted(r["x"] for r in out) == [1.0, 1.5, 2.0]


def test_constant_without_value_is_zero(spark):
    df = spark.createDataFrame([(1.0,), (None,)], "x double")
    assert sorted(r["x"] for r in impute.impute_numeric(df, ["x"], "constant").collect()) == [0.0, 1.0]


def test_group_key_missing_dropped(spark):
    df = spark.createDataFrame([("a", 1), (None, 0), ("a", 0)], "c string, TARGET int")
    out = profile.default_rate_by_category(df, ["c"]).collect()
    assert [(r["value"], r["n"]) for r in out] == [("a", 2)]


def test_empty_frame_profile(spark):
    df = spark.createDataFrame([], "x double, c string")
    rep = {r["column"]: r for r in profile.quality_report(df).collect()}
    assert rep["x"]["non_null"] == 0


def test_scaler_population_std(spark):
    df = spark.createDataFrame(pd.DataFrame({"x": [1.0, 2.0, 3.0, 4.0], "k": [5.0] * 4}))
    st = prepare.fit_standard_scaler(df, ["x", "k"])
    out = prepare.apply_standard_scaler(df, st).toPandas()
    assert out["x"].std(ddof=0) == pytest.approx(1.0)
    assert (out["k"] == 0).all()


def test_smote_balances_classes(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": np.arange(200), "v": list(rng.normal(size=(200, 3))),
                        "y": (np.arange(200) < 37).astype(int)})
    df = spark.createDataFrame(pdf, "id long, v array<double>, y int")
    out = neighbours.smote(df, "id", "v", "y", k=5)
    counts = {r["y"]: r["count"] for r in out.groupBy("y").count().collect()}
    assert counts == {0: 163, 1: 163}
    # synthetic points lie on segments between minority points: inside their bounding box
    mino = np.vstack(pdf.loc[pdf.y == 1, "v"].to_numpy())
    syn = np.vstack([r["v"] for r in out.filter("synthetic").collect()])
    assert (syn >= mino.min(0) - 1e-9).all() and (syn <= mino.max(0) + 1e-9).all()


def test_logistic_matches_newton_solve(spark):
    rng = np.random.default_rng(5)
    n = 400
    X = rng.normal(size=(n, 2))
    y = (rng.random(n) < 1 / (1 + np.exp(-(0.8 * X[:, 0] - 0.5 * X[:, 1] - 1)))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"a": X[:, 0], "b": X[:, 1], "TARGET": y, "id": np.arange(n)}))
    m = model.fit_logistic(df, ["a", "b"], "TARGET")
    coefs = {r["feature"]: r["coefficient"] for r in model.coefficients(m).collect()}
    # Newton solve of C * sum(w * loss) + |beta|^2 / 2, intercept unpenalised, on scaled X
    Z = (X - X.mean(0)) / X.std(0)
    A = np.hstack([Z, np.ones((n, 1))])
    w = np.where(y == 1, n / (2 * y.sum()), n / (2 * (n - y.sum())))
    beta = np.zeros(3)
    reg = np.diag([1.0, 1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-A @ beta))
        g = A.T @ (w * (p - y)) + reg @ beta
        H = (A * (w * p * (1 - p))[:, None]).T @ A + reg
        beta -= np.linalg.solve(H, g)
    assert coefs["a"] == pytest.approx(beta[0], abs=1e-4)
    assert coefs["b"] == pytest.approx(beta[1], abs=1e-4)


def test_quality_report_exact_and_approx_distinct(spark):
    df = spark.range(20000).select((F.col("id") % 5000).alias("k"), (F.col("id") % 7).cast("string").alias("s"))
    exact = {r["column"]: r["unique"] for r in profile.quality_report(df).collect()}
    assert exact == {"k": 5000, "s": 7}
    approx = {r["column"]: r["unique"] for r in profile.quality_report(df, approx_distinct=True).collect()}
    # HLL++ with Spark's default relative standard deviation of 5%: allow 3 sigma
    assert abs(approx["k"] - 5000) / 5000 < 0.15 and approx["s"] == 7
