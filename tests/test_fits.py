"""Batched Newton fits and cut points against brute force."""

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import cuts, model, newton, prepare


def digest(key, seed):
    return int(hashlib.md5(f"{'' if key is None else key}:{seed}".encode()).hexdigest()[:15], 16)


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(900, 3)) * [1.0, 40.0, 0.01] + [0.0, 500.0, 3.0]
    p = 1 / (1 + np.exp(-(x[:, 0] + (x[:, 1] - 500) / 60 - 1.5)))
    y = (rng.random(900) < p).astype(int)
    return [(i, int(y[i]), i % 4, *map(float, x[i])) for i in range(900)]


@pytest.fixture(scope="module")
def frame(spark, points):
    return spark.createDataFrame(points, "id long, y int, fold int, a double, b double, c double").cache()


def gradient(points, fit, cols):
    """Mean gradient of the penalised weighted loss by numpy alone."""
    rows = np.array([p[3:] for p in points if fit.problem.held_out is None or p[2] != fit.problem.held_out])
    y = np.array([p[1] for p in points if fit.problem.held_out is None or p[2] != fit.problem.held_out])
    z = (rows[:, cols] - rows[:, cols].mean(0)) / rows[:, cols].std(0)
    z = np.column_stack([np.ones(len(z)), z])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    g = z.T @ (w * (1 / (1 + np.exp(-z @ fit.beta)) - y))
    g[1:] += fit.beta[1:] / fit.problem.C
    return np.abs(g / w.sum()).max()


def test_every_problem_of_a_batch_is_at_its_optimum(frame, points):
    problems = [newton.Problem(("a", "b", "c"), C, f) for C in (0.01, 1.0, 100.0) for f in (None, 0, 3)]
    problems.append(newton.Problem(("c", "a"), 1.0, 2))
    fits = newton.fit_many(frame, problems, "y", "fold")
    for p, fit in zip(problems, fits):
        assert fit.converged and fit.gradient < 1e-9 and fit.step < 1e-8
        assert gradient(points, fit, ["abc".index(f) for f in p.features]) < 1e-9


def test_left_out_fold_equals_a_fit_without_its_rows(frame):
    one = newton.fit_many(frame, [newton.Problem(("a", "b"), 1.0, 1)], "y", "fold")[0]
    two = newton.fit_many(frame.where("fold <> 1"), [newton.Problem(("a", "b"))], "y")[0]
    assert np.allclose(one.beta, two.beta, atol=1e-8)
    assert np.allclose(one.mean, two.mean) and np.allclose(one.std, two.std)


def test_agrees_with_the_mllib_fit(frame):
    m = model.fit_logistic(frame, ["a", "b", "c"], "y")
    want = {r["feature"]: r["coefficient"] for r in model.coefficients(m).collect()}
    got = newton.fit_many(frame, [newton.Problem(("a", "b", "c"))], "y")[0]
    assert got.coef == pytest.approx(want, abs=1e-4)
    both = model.score(m, frame).select("p1", newton.probability(got).alias("p2"))
    assert both.agg(F.max(F.abs(F.col("p1") - F.col("p2")))).first()[0] < 1e-4


def test_gaps_constant_features_missing_class_and_empty_table(spark, frame):
    gap = frame.unionByName(spark.createDataFrame(
        [(1000, 1, 0, None, 1.0, 1.0), (1001, 0, 0, float("nan"), 1.0, 1.0), (1002, None, 0, 1.0, 1.0, 1.0),
         (1003, 1, None, 1.0, 1.0, 1.0)], frame.schema))
    plain = newton.fit_many(frame, [newton.Problem(("a", "b"))], "y", "fold")[0]
    assert np.allclose(newton.fit_many(gap, [newton.Problem(("a", "b"))], "y", "fold")[0].beta, plain.beta, atol=1e-8)
    flat = newton.fit_many(frame.withColumn("k", F.lit(7.0)), [newton.Problem(("a", "b", "k"))], "y")[0]
    assert flat.converged and abs(flat.coef["k"]) < 1e-9 and flat.coef["a"] == pytest.approx(plain.coef["a"], abs=1e-8)
    for rows in (frame.where("y = 1"), frame.where("false")):
        none = newton.fit_many(rows, [newton.Problem(("a",))], "y")[0]
        assert not none.converged and np.isnan(none.beta).all()


def test_separable_classes_still_converge(spark):
    rows = [(i, int(i >= 50), 0, float(i) ** 3, 0.0, 0.0) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, y int, fold int, a double, b double, c double")
    fit = newton.fit_many(df, [newton.Problem(("a",), 1e4)], "y")[0]
    assert fit.converged and gradient(rows, fit, [0]) < 1e-8


def test_out_of_fold_auc_equals_pairs(frame, points):
    got = {(r["C"], r["fold"]): r["auc"] for r in
           newton.out_of_fold_auc(frame, ["a", "b"], "y", "fold", 4, (0.1, 1.0)).collect()}
    assert len(got) == 8
    for (C, f), auc in got.items():
        fit = newton.fit_many(frame, [newton.Problem(("a", "b"), C, f)], "y", "fold")[0]
        rows = np.array([p[3:5] for p in points if p[2] == f])
        y = np.array([p[1] for p in points if p[2] == f])
        s = ((rows - fit.mean) / fit.std) @ fit.beta[1:]
        pos, neg = s[y == 1], s[y == 0]
        assert auc == pytest.approx((pos[:, None] > neg).mean() + (pos[:, None] == neg).mean() / 2, abs=1e-9)


def test_auc_counts_ties_half_and_needs_both_classes(spark):
    df = spark.createDataFrame([("v", 0.5, 1), ("v", 0.5, 0), ("v", 0.1, 0), ("w", 0.3, 1), ("v", None, 1)],
                               "variable string, value double, label int")
    assert {r["variable"]: r["auc"] for r in newton.grouped_auc(df).collect()} == {"v": 0.75, "w": None}


def test_elimination_drops_the_weakest_of_each_fit(frame):
    got = {r["feature"]: r["dropped_at"] for r in newton.eliminate(frame, ["c", "a", "b"], "y", 1).collect()}
    left, want = ["a", "b", "c"], {}
    while len(left) > 1:
        fit = newton.fit_many(frame, [newton.Problem(tuple(left))], "y")[0]
        worst = min(left, key=lambda f: (abs(fit.coef[f]), f))
        want[worst] = len(want) + 1
        left.remove(worst)
    assert got == want | {left[0]: None}
    assert model.recursive_elimination(frame, ["c", "a", "b"], "y", 1) == left


def test_cut_points_with_ties_null_group_and_a_hot_group(spark):
    rows = [(i, "hot") for i in range(500)] + [(i, "small") for i in range(7)] + [(i, None) for i in range(11)] \
        + [(3, "twin")] * 4 + [(None, "small")]
    df = spark.createDataFrame(rows, "id long, g string")
    want = {"hot": [0, 1, 250, 499, 500], "small": [2, 100], None: [5], "twin": [2]}
    got = cuts.cut_points(df, "g", cuts.hash_key("id", 9), want)
    for g, ps in want.items():
        keys = sorted(digest(i, 9) for i, h in rows if h == g)
        for p, c in zip(ps, got[g]):
            below = sum(k < c for k in keys)
            assert below == (0 if g == "twin" else min(p, len(keys)))


def test_folds_and_split_have_exact_sizes_and_the_stated_members(spark):
    rows = [(i, i % 10 == 0) for i in range(1003)]
    df = spark.createDataFrame(rows, "id long, y boolean")
    folds = {r["id"]: r["fold"] for r in model.fold_column(df, "y", "id", 5, seed=4).collect()}
    test = {r["id"] for r in prepare.stratified_split(df, "y", "id", 0.25, seed=4)[1].collect()}
    for cls in (True, False):
        order = sorted((i for i, y in rows if y == cls), key=lambda i: digest(i, 4))
        ends = [0, *cuts.deal_sizes(len(order), 5), len(order)]
        for f in range(5):
            assert all(folds[i] == f for i in order[ends[f]:ends[f + 1]])
        n = int(len(order) * 0.25 + 0.5)
        assert test & set(order) == set(order[:n])


def test_splits_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, y int")
    tr, te = prepare.stratified_split(df, "y", "id")
    assert tr.count() == te.count() == 0
    assert model.fold_column(df, "y", "id").columns == ["id", "y", "fold"]


def test_rows_are_not_shuffled_by_a_split(spark, frame):
    tr, _ = prepare.stratified_split(frame, "y", "id", 0.2)
    plan = tr._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_mann_whitney_of_equal_classes_has_p_one_and_no_effect(spark):
    from riskframe.operators import stats
    df = spark.createDataFrame([(float(i), y) for i in range(30) for y in (0, 1)], "x double, y int")
    row = stats.mann_whitney(df, ["x"], "y").first()
    assert row["z"] < 0 and row["p_value"] == 1.0 and row["effect_r"] == 0.0 and not row["significant"]


@pytest.mark.parametrize("x", [0.0, 0.3, 2.0, 9.5, 31.0, 80.0])
@pytest.mark.parametrize("dof", [1, 2, 3, 8, 25, 96])
def test_oracle_of_the_chi_square_tail_agrees_with_the_operator(x, dof):
    import duckdb

    from riskframe.functions.pvalues import chi2_sf
    from riskframe.plans.q_stats import _chi2_p_sql
    got = duckdb.sql(f"SELECT {_chi2_p_sql('x', 'd')} FROM (SELECT {x}::DOUBLE AS x, {dof}::BIGINT AS d)").fetchall()[0][0]
    assert got == pytest.approx(chi2_sf(x, dof), abs=1e-10)


def test_positions_with_ties_missing_values_and_groups(spark):
    from riskframe.operators.ranks import with_position
    nan = float("nan")
    rows = [("a", "p", 2.0), ("a", "q", 5.0), ("a", "r", 2.0), ("a", "s", None), ("a", "t", nan), ("b", "p", 1.0), ("b", "q", -0.0)]
    df = spark.createDataFrame(rows, "g string, name string, v double")
    down = {(r["g"], r["name"]): r["position"] for r in with_position(df, "v", ["name"], ["g"]).collect()}
    assert down == {("a", "q"): 1, ("a", "p"): 2, ("a", "r"): 3, ("a", "t"): 4, ("a", "s"): 5, ("b", "p"): 1, ("b", "q"): 2}
    up = {r["name"]: r["position"] for r in with_position(df.where("g = 'a'"), "v", ["name"], descending=False).collect()}
    assert up == {"p": 1, "r": 2, "q": 3, "t": 4, "s": 5}
    assert with_position(df.where("false"), "v", ["name"]).count() == 0
