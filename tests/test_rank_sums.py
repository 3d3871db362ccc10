"""Rank sums by ranges: one exchange, no written table, ties and groups as scipy's midranks."""

import numpy as np
import pytest
import pandas as pd

from riskframe.operators import ranks, stats


def _rows(spark, batch):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"variable": rng.choice(["a", "b", "c"], 3000, p=[.6, .399, .001]), "value": np.round(rng.normal(size=3000), 1),
                        "_g": rng.choice(["x", "y", "z"], 3000)})
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    return pdf, spark.createDataFrame(pdf, "variable string, value double, _g string")


def test_rank_sums_equal_midranks(spark):
    for batch in ("2", "50", "10000"):
        pdf, df = _rows(spark, batch)
        got = {(r["variable"], r["grp"]): r for r in ranks.rank_sums(df).collect()}
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        pdf["rank"] = pdf.groupby("variable")["value"].rank()
        exp = pdf.groupby(["variable", "_g"])["rank"].agg(["count", "sum"])
        t = pdf.groupby(["variable", "value"]).size().astype(float)
        ties = (t ** 3 - t).groupby("variable").sum()
        assert set(got) == set(exp.index)
        for (v, g), e in exp.iterrows():
            r = got[v, g]
            assert (r["n_g"], r["N"]) == (e["count"], (pdf.variable == v).sum())
            assert r["R_g"] == e["sum"] and r["T"] == ties[v]


def test_auc_needs_one_exchange_of_the_rows_and_no_table(spark):
    df = spark.createDataFrame([(0.1 * i, i % 2) for i in range(20)], "p double, label int")
    plan = stats.auc(df, "p", "label")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "Join" not in plan


def test_out_of_fold_auc_reads_its_input_once_for_fits_and_scores(spark):
    from pyspark.sql import functions as F

    from riskframe.operators import newton
    seen = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def fold(i):
        seen.add(1)
        return i % 2

    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"i": np.arange(200), "x": rng.normal(size=200)})
    pdf["y"] = (pdf.x + rng.normal(size=200) > 0).astype(int)
    df = spark.createDataFrame(pdf).withColumn("fold", fold("i"))
    got = newton.out_of_fold_auc(df, ["x"], "y", "fold", 2, (0.1, 1.0)).collect()
    assert sorted((r["C"], r["fold"]) for r in got) == [(0.1, 0), (0.1, 1), (1.0, 0), (1.0, 1)]
    for r in got:                     # one feature: the score keeps its order
        part = pdf[pdf.i % 2 == r["fold"]]
        a, b = part[part.y == 1].x.to_numpy(), part[part.y == 0].x.to_numpy()
        assert abs(r["auc"] - (a[:, None] > b[None, :]).mean()) < 1e-12
    assert seen.value <= 2 * len(pdf)  # the filter and the written column; each pass read it again before


def test_near_quantiles_are_near_and_exact_at_the_ends(spark):
    """Lists of 20 of each batch and of each 16 lists: places off by 1/40 a level at most; an empty column has none."""
    from riskframe.operators import ranks
    rng = np.random.default_rng(2)
    n = 4000
    x = np.round(rng.normal(size=n), 2)
    x[:900] = 5.0  # a heavy value
    x[900:950] = np.nan
    rows = [(float(v), float(rng.standard_cauchy()), None) for v in x]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(3)
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        probs = [0.0, 0.1, 0.5, 0.9, 1.0]
        got = ranks.near_quantiles(df, ["a", "b", "c"], probs, 20)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    assert [g[0] for g in got] == [n - 50, n, 0] and got[2][1] == []
    for (size, found), values in zip(got[:2], (x[~np.isnan(x)], np.array([r[1] for r in rows]))):
        assert (found[0], found[-1]) == (values.min(), values.max())
        for p, v in zip(probs, found):
            assert (values < v).mean() - 0.1 <= p <= (values <= v).mean() + 0.1


def test_exact_quantiles_scan_some_columns_at_a_time(spark, monkeypatch):
    """More columns than one scan takes, with gaps: as pandas, and without a full rank table."""
    from riskframe.operators import ranks
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame(np.round(rng.normal(size=(500, ranks.AT_ONCE + 3)), 1), columns=[f"x{i}" for i in range(ranks.AT_ONCE + 3)])
    pdf.iloc[::7, 2] = np.nan
    monkeypatch.setattr(ranks, "rank_table", None)
    got = {(r["variable"], r["q"]): r["value"] for r in ranks.exact_quantiles(spark.createDataFrame(pdf), list(pdf), [0.25, 0.5]).collect()}
    for c in pdf:
        for q in (0.25, 0.5):
            assert got[c, q] == pytest.approx(pdf[c].quantile(q))
