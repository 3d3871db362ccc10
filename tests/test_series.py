"""Time-series operators against known answers."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from riskframe.operators import series


def _months(n):
    return [dt.date(2020 + (i // 12), i % 12 + 1, 1) for i in range(n)]


def test_forecast_continues_a_linear_series(spark):
    rows = [("a", m, 10.0 + 2.0 * i) for i, m in enumerate(_months(24))]
    rows += [("b", m, 50.0 - 1.0 * i) for i, m in enumerate(_months(24))]
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["k", "month", "y"]))
    out = series.seasonal_trend_forecast(df, ["k"], "month", "y", horizon=3, holdout=3).toPandas()
    a = out[out.k == "a"].sort_values("step")
    assert a["forecast"].tolist() == pytest.approx([58.0, 60.0, 62.0])
    assert a["month"].tolist() == [dt.date(2022, 1, 1), dt.date(2022, 2, 1), dt.date(2022, 3, 1)]
    assert a["rmse"].iloc[0] == pytest.approx(0.0, abs=1e-9)
    b = out[out.k == "b"].sort_values("step")
    assert b["forecast"].tolist() == pytest.approx([26.0, 25.0, 24.0])


def test_acf_matches_direct_formula(spark):
    rng = np.random.default_rng(12)
    y = np.cumsum(rng.normal(size=40))
    df = spark.createDataFrame(pd.DataFrame({"k": "s", "month": _months(40), "y": y}))
    got = {r["lag"]: r["acf"] for r in series.acf(df, ["k"], "month", "y", max_lag=5).collect()}
    d = y - y.mean()
    for lag in range(1, 6):
        assert got[lag] == pytest.approx((d[lag:] * d[:-lag]).sum() / (d * d).sum())


def test_trend_and_seasonality_labels(spark):
    m = _months(36)
    vals = [100 + 3 * i + (20 if d.month == 12 else 0) for i, d in enumerate(m)]
    monthly = spark.createDataFrame(pd.DataFrame({"month": m, "defaults_origination": vals}))
    assert series.trend(monthly).first()["trend"] == "rising"
    top = series.top_months(series.seasonality(monthly), 1).first()
    assert top["month_of_year"] == 12 and top["above_mean"] == 1
