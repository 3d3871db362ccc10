"""Property tests on skewed inputs: one value/key holds a third of the rows."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.operators import clean, prepare, profile, ranks


def _skewed(seed, n=900):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(size=n) * 10, 0)
    v[: n // 3] = 3.0  # hot value
    v[rng.random(n) < 0.05] = np.nan
    return v


@settings(max_examples=4, deadline=None)
@given(st.integers(0, 10_000), st.lists(st.floats(0, 1), min_size=1, max_size=4))
def test_exact_quantiles_property(spark, seed, probs):
    v = _skewed(seed)
    df = spark.createDataFrame(pd.DataFrame({"v": v}))
    got = ranks.quantile_map(df, ["v"], probs)
    s = pd.Series(v)
    for p in probs:
        assert abs(got[("v", round(p, 12))] - s.quantile(p)) < 1e-9


@pytest.mark.parametrize("partitions", [None, 5])
def test_cumulative_matches_cumsum(spark, partitions):
    rng = np.random.default_rng(7)
    keys = np.where(rng.random(3000) < 0.34, "hot", rng.choice(list("abcdef"), 3000))
    vals = rng.integers(0, 500, 3000)
    pdf = pd.DataFrame({"k": keys, "value": vals}).groupby(["k", "value"]).size().rename("t").reset_index()
    df = spark.createDataFrame(pdf)
    got = ranks.cumulative(df, ("k",), "value", ("t",), partitions=partitions).toPandas().sort_values(["k", "value"])
    exp = pdf.sort_values(["k", "value"])
    exp = exp.assign(t_before=exp.groupby("k")["t"].cumsum() - exp["t"])
    assert got["t_before"].tolist() == exp["t_before"].tolist()


def test_remove_duplicates_hot_key(spark):
    rng = np.random.default_rng(8)
    n = 1200
    key = np.where(np.arange(n) < n // 3, 0, rng.integers(1, 50, n))
    pdf = pd.DataFrame({"key": key, "t": rng.permutation(n), "x": rng.normal(size=n)})
    df = spark.createDataFrame(pdf)
    first = clean.remove_duplicates(df, ["key"], "first", ["t"]).toPandas().sort_values("key")
    exp = pdf.sort_values("t").drop_duplicates("key", keep="first").sort_values("key")
    assert first["t"].tolist() == exp["t"].tolist()
    last = clean.remove_duplicates(df, ["key"], "last", ["t"]).toPandas().sort_values("key")
    exp = pdf.sort_values("t").drop_duplicates("key", keep="last").sort_values("key")
    assert last["t"].tolist() == exp["t"].tolist()


def test_top_values_hot_value(spark):
    rng = np.random.default_rng(9)
    c = np.where(rng.random(2000) < 0.34, "hot", rng.choice([f"v{i}" for i in range(40)], 2000))
    df = spark.createDataFrame(pd.DataFrame({"c": c}))
    got = profile.top_values(df, ["c"], k=5).orderBy("rank").toPandas()
    vc = pd.Series(c).value_counts()
    exp = sorted(vc.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    assert list(zip(got["value"], got["count"])) == exp
    assert (got["cardinality"] == vc.size).all()


def test_stratified_split_exact_sizes(spark):
    df = spark.range(5000).withColumn("y", (F.col("id") % 7 == 0).cast("int"))
    tr, te = prepare.stratified_split(df, "y", "id", 0.2, seed=3)
    n = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    t = {r["y"]: r["count"] for r in te.groupBy("y").count().collect()}
    assert t == {k: int(round(v * 0.2)) for k, v in n.items()}
    assert tr.count() + te.count() == 5000
    assert tr.join(te, "id").count() == 0


def test_cumulative_descending(spark):
    rng = np.random.default_rng(13)
    pdf = pd.DataFrame({"k": rng.choice(["a", "b"], 800), "value": rng.integers(0, 300, 800)})
    pdf = pdf.groupby(["k", "value"]).size().rename("t").reset_index()
    got = ranks.cumulative(spark.createDataFrame(pdf), ("k",), "value", ("t",), ascending=False).toPandas().set_index(["k", "value"])["t_before"]
    for (k, v), before in got.items():
        assert before == pdf[(pdf.k == k) & (pdf.value > v)]["t"].sum()
