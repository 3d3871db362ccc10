"""Statistics: golden values from the original's stored reports, identities,
and brute-force comparisons on small fixtures."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskframe.functions.pvalues import chi2_sf, normal_two_sided
from riskframe.operators import model, ranks, stats


def mw_p(u, n0, n1, tie_sum=0.0):
    n = n0 + n1
    sigma = math.sqrt(n0 * n1 / 12.0 * ((n + 1) - tie_sum / (n * (n - 1))))
    return normal_two_sided((abs(u - n0 * n1 / 2.0) - 0.5) / sigma)


N0, N1 = 105820, 24180


def _binary_ties(zeros):
    ones = N0 + N1 - zeros
    return float(zeros ** 3 - zeros + ones ** 3 - ones)


@pytest.mark.parametrize("u,ties,expected", [
    (1280342707, 0.0, 0.8525006654710227),
    (1279058430, _binary_ties(12993), 0.9111020948863235),
    (1281468110, _binary_ties(19541), 0.518480538650434),
])
def test_mann_whitney_golden_p(u, ties, expected):
    assert mw_p(u, N0, N1, ties) == pytest.approx(expected, rel=1e-12)


def test_chi2_sf_known_values():
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(5.991464547107979, 2) == pytest.approx(0.05, rel=1e-9)
    assert chi2_sf(0.0, 3) == 1.0
    assert chi2_sf(100.0, 3) < 1e-20
    assert chi2_sf(float("inf"), 3) == 0.0 and chi2_sf(float("inf"), 1e9) == 0.0
    assert chi2_sf(3.0, float("inf")) == 1.0


def _rank(x):
    return pd.Series(x).rank(method="average").to_numpy()


def test_mann_whitney_matches_brute_force(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=400), 1)  # ties on purpose
    y = (rng.random(400) < 0.3).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    row = stats.mann_whitney(df, ["x"], "y").first()
    r = _rank(x)
    n0, n1 = (y == 0).sum(), (y == 1).sum()
    u0 = r[y == 0].sum() - n0 * (n0 + 1) / 2
    t = pd.Series(x).value_counts().to_numpy().astype(float)
    assert row["U"] == pytest.approx(u0)
    assert row["p_value"] == pytest.approx(mw_p(u0, n0, n1, (t ** 3 - t).sum()), rel=1e-9)
    assert row["median_0"] == pytest.approx(np.median(x[y == 0]))


def test_auc_identity(spark):
    rng = np.random.default_rng(1)
    s = np.round(rng.random(500), 2)
    y = (rng.random(500) < s).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"p1": s, "label": y}))
    a = stats.auc(df, "p1", "label").first()
    r = _rank(s)
    n1, n0 = y.sum(), (1 - y).sum()
    expected = (r[y == 1].sum() - n1 * (n1 + 1) / 2) / (n0 * n1)
    assert a["auc"] == pytest.approx(expected)
    assert a["gini"] == pytest.approx(2 * expected - 1)
    # AUC from the ROC table (trapezoids) equals the rank AUC
    roc = model.roc_points(df).orderBy("threshold", ascending=False).toPandas()
    fpr = np.concatenate([[0.0], roc["fpr"].to_numpy()])
    tpr = np.concatenate([[0.0], roc["tpr"].to_numpy()])
    assert np.trapezoid(tpr, fpr) == pytest.approx(expected)


def test_kruskal_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    g = rng.choice(list("abcd"), 300)
    x = np.round(rng.normal(size=300) + (g == "a"), 1)
    g[:3] = "z"  # a group smaller than 5: dropped before ranking
    df = spark.createDataFrame(pd.DataFrame({"x": x, "g": g}))
    row = stats.kruskal_wallis(df, ["x"], ["g"]).first()
    keep = g != "z"
    xs, gs = x[keep], g[keep]
    r = _rank(xs)
    n = len(xs)
    s = sum(r[gs == k].sum() ** 2 / (gs == k).sum() for k in set(gs))
    t = pd.Series(xs).value_counts().to_numpy().astype(float)
    h = (12 / (n * (n + 1)) * s - 3 * (n + 1)) / (1 - (t ** 3 - t).sum() / (n ** 3 - n))
    assert row["H"] == pytest.approx(h)
    assert row["dof"] == 3
    assert row["p_value"] == pytest.approx(chi2_sf(h, 3))


def test_cramers_v_yates_2x2(spark):
    rows = [("a", "0")] * 30 + [("a", "1")] * 10 + [("b", "0")] * 20 + [("b", "1")] * 25
    df = spark.createDataFrame(rows, "c string, y string")
    out = stats.chi2_vs_target(df, ["c"], "y").first()
    o = np.array([[30, 10], [20, 25]], dtype=float)
    e = o.sum(1)[:, None] * o.sum(0)[None, :] / o.sum()
    d = np.abs(o - e)
    chi2 = (((d - np.minimum(0.5, d)) ** 2) / e).sum()
    assert out["chi2"] == pytest.approx(chi2)
    n = o.sum()
    phi2c = max(0, chi2 / n - 1 / (n - 1))
    rc = kc = 2 - 1 / (n - 1)
    assert out["V"] == pytest.approx(math.sqrt(phi2c / (min(kc - 1, rc - 1) + 1e-10)))
    assert out["p_value"] == pytest.approx(chi2_sf(chi2, 1))


def test_quantiles_match_pandas_with_skew(spark):
    # one value holds a third of the rows
    vals = np.concatenate([np.full(3000, 7.0), np.arange(6000, dtype=float)])
    df = spark.createDataFrame(pd.DataFrame({"v": vals}))
    q = ranks.quantile_map(df, ["v"], [0.01, 0.25, 0.5, 0.9])
    for p in (0.01, 0.25, 0.5, 0.9):
        assert q[("v", p)] == pytest.approx(pd.Series(vals).quantile(p))


def test_spearman_equals_pearson_of_ranks(spark):
    rng = np.random.default_rng(3)
    a = np.round(rng.normal(size=300), 1)
    b = a + np.round(rng.normal(size=300), 1)
    df = spark.createDataFrame(pd.DataFrame({"a": a, "b": b, "t": (a > 0).astype(int)}))
    sp = {(r["var1"], r["var2"]): r["r"] for r in stats.spearman_pairs(df, ["a", "b"], "t").collect()}
    assert sp[("a", "b")] == pytest.approx(np.corrcoef(_rank(a), _rank(b))[0, 1])


def test_spearman_with_and_without_nulls_equals_pandas(spark):
    rng = np.random.default_rng(11)
    data = pd.DataFrame({f"c{i}": np.round(rng.normal(size=200), 1) for i in range(4)})
    data.loc[rng.random(200) < 0.3, "c1"] = np.nan
    data.loc[rng.random(200) < 0.2, "c3"] = np.nan
    data["k"] = 1.0
    data["t"] = (rng.random(200) < 0.3).astype(int)
    df = spark.createDataFrame(data)
    cols = ["c0", "c1", "c2", "c3", "k"]
    got = {(r["var1"], r["var2"]): r["r"] for r in stats.spearman_pairs(df, cols, "t").collect()}
    ranked = {(a, b): data[[a, b]].dropna().rank() for a, b in got}
    assert len(got) == 15
    for (a, b), x in ranked.items():
        exp = x[a].corr(x[b])
        assert got[a, b] is None if np.isnan(exp) else got[a, b] == pytest.approx(exp, abs=1e-12)



def test_spearman_of_complete_columns_joins_no_ranks_and_equals_pandas(spark, monkeypatch):
    """Ties, copies, skewed and constant columns; many slices and blocks, no join per column."""
    rng = np.random.default_rng(21)
    n = 4000
    data = pd.DataFrame({"a": rng.normal(size=n), "b": np.round(rng.normal(size=n), 2), "c": np.exp(3 * rng.normal(size=n)), "k": 1.0})
    data["d"] = np.where(rng.random(n) < 0.6, 0.5, data["a"] + rng.normal(size=n))
    data["e"] = -data["a"] * 1e-9
    data["t"] = (data["a"] > 1).astype(int)
    monkeypatch.setattr(stats.ranks, "attach_ranks", None)
    cols = ["a", "b", "c", "d", "e", "k"]
    got = {(r["var1"], r["var2"]): r["r"] for r in stats.spearman_pairs(spark.createDataFrame(data), cols, "t").collect()}
    ranked = data.rank()
    assert len(got) == 21
    for (a, b), x in got.items():
        assert x is None if "k" in (a, b) else x == pytest.approx(ranked[a].corr(ranked[b]), abs=1e-12)


def test_rank_sums_of_all_groupings_move_a_value_once(spark, monkeypatch):
    """Nulls, NaN, ties, a small group and a column of many groups against ranks
    of the complete rows; before, the rows were exploded for every pair."""
    rng = np.random.default_rng(5)
    n = 1500
    data = pd.DataFrame({"a": rng.normal(size=n), "b": np.round(rng.normal(size=n), 1)})
    data.loc[rng.random(n) < 0.2, "a"] = np.nan
    data["p"] = rng.choice(["x", "y", "z"], n)
    data.loc[:2, "p"] = "rare"
    data["q"] = np.where(rng.random(n) < 0.3, None, rng.choice(["u", "v"], n))
    df = spark.createDataFrame([tuple(None if x != x else x for x in r) for r in data.itertuples(index=False)], "a double, b double, p string, q string")
    monkeypatch.setattr(stats.ranks, "rank_sums", None)
    got = {(r["var_quant"], r["var_qual"]): r for r in stats.kruskal_wallis(df, ["a", "b"], ["p", "q"]).collect()}
    assert len(got) == 4
    for (x, g), r in got.items():
        part = data[[x, g]].dropna()
        part = part[part[g] != "rare"]
        rank = part[x].rank()
        t = part[x].value_counts()
        h = 12 / (len(part) * (len(part) + 1)) * (rank.groupby(part[g]).sum() ** 2 / part[g].value_counts()).sum() - 3 * (len(part) + 1)
        assert r["n"] == len(part) and r["dof"] == part[g].nunique() - 1
        assert r["H"] == pytest.approx(h / (1 - (t ** 3 - t).sum() / (len(part) ** 3 - len(part))), rel=1e-9)
    monkeypatch.undo()
    monkeypatch.setattr(stats, "MAX_GROUPS", 2)  # the long way, as for columns of very many groups
    long = {(r["var_quant"], r["var_qual"]): r["H"] for r in stats.kruskal_wallis(df, ["a", "b"], ["p", "q"]).collect()}
    assert long == {k: pytest.approx(r["H"], rel=1e-9) for k, r in got.items()}
