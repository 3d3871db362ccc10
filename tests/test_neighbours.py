"""Exact neighbour search against brute force (ties on purpose)."""

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators.neighbours import _impute_kernel, knn


def _brute_impute(ids, mat, qsel, k):
    m = mat.shape[1]
    rows = []
    for gi in qsel:
        q = mat[gi]
        qp = ~np.isnan(q)
        for j in np.flatnonzero(~qp):
            hj = ~np.isnan(mat[:, j])
            dm = mat[hj]
            both = ~np.isnan(dm) & qp
            diff = np.where(both, dm - q, 0.0)
            with np.errstate(divide="ignore", invalid="ignore"):
                d2 = (diff * diff).sum(1) * (m / both.sum(1))
            ok = np.isfinite(d2)
            di, d2 = ids[hj][ok], d2[ok]
            rows += [(ids[gi], j, di[t]) for t in np.lexsort((di, d2))[:k]]
    return sorted(rows)


def test_impute_kernel_equals_brute_force():
    rng = np.random.default_rng(0)
    n, m, k = 2000, 5, 5
    mat = np.round(rng.normal(size=(n, m)), 1)
    mat[rng.random((n, m)) < 0.15] = np.nan
    ids = rng.permutation(n).astype(np.int64) * 7
    qsel = np.flatnonzero(np.isnan(mat).any(1))
    for window in (8, 64, 4096):
        res = _impute_kernel(ids[qsel], mat[qsel], ids, mat, k, m, window, 1 << 16)
        assert sorted(zip(res.qid, res.col, res.nid)) == _brute_impute(ids, mat, qsel, k)


def test_knn_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(size=(300, 4)), 1)
    pdf = pd.DataFrame({"id": np.arange(300), "v": list(v), "g": rng.integers(0, 3, 300)})
    df = spark.createDataFrame(pdf, "id long, v array<double>, g long")
    got = sorted((r["qid"], r["nid"]) for r in knn(df, df, "id", "v", k=3, same="g", cell_rows=70).collect())
    exp = []
    for i in range(300):
        d = ((v - v[i]) ** 2).sum(1)
        d[i] = np.inf
        d[pdf.g.to_numpy() != pdf.g[i]] = np.inf
        exp += [(i, j) for j in np.lexsort((np.arange(300), d))[:3]]
    assert got == sorted(exp)


def test_knn_impute_multi_block_equals_brute_force(spark):
    from riskframe.operators.neighbours import knn_impute
    rng = np.random.default_rng(2)
    n, m, k = 2500, 4, 3
    mat = np.round(rng.normal(size=(n, m)), 1)
    mat[rng.random((n, m)) < 0.2] = np.nan
    ids = np.arange(n, dtype=np.int64)
    cols = [f"c{j}" for j in range(m)]
    pdf = pd.DataFrame(mat, columns=cols).astype(object).where(~np.isnan(mat), None)
    pdf.insert(0, "id", ids)
    df = spark.createDataFrame(pdf, "id long, " + ", ".join(f"{c} double" for c in cols))
    # blocks of 1000 donors -> three blocks merged by the top-k
    got = knn_impute(df, "id", cols, k=k, cell_rows=1000, window=16).toPandas().set_index("id")
    means = np.nanmean(mat, axis=0)
    qsel = np.flatnonzero(np.isnan(mat).any(1))
    picks = {}
    for q, j, nid in _brute_impute(ids, mat, qsel, k):
        picks.setdefault((q, j), []).append(mat[nid, j])
    for q in qsel:
        for j in np.flatnonzero(np.isnan(mat[q])):
            exp = np.mean(picks[(q, j)]) if (q, j) in picks else means[j]
            assert got.loc[q, cols[j]] == pytest.approx(exp)


def _brute_knn(ids, v, g, queries, k):
    out = []
    for i in queries:
        e = np.sqrt(((v - v[i]) ** 2).sum(1))
        e[ids == ids[i]] = np.inf
        e[g != g[i]] = np.inf
        out += [(ids[i], ids[j], r) for r, j in enumerate(np.lexsort((ids, e))[:k], 1) if np.isfinite(e[j])]
    return sorted(out)


@pytest.mark.parametrize(("dim", "cell_rows", "per_pivot"), [(2, 60, 8), (2, 5000, 30), (6, 100, 16), (1, 40, 5)])
def test_metric_join_equals_brute_force(spark, dim, cell_rows, per_pivot):
    """Ties, copies beyond a block, a dense clump, far rows, small groups."""
    from riskframe.operators.pivots import metric_join
    rng = np.random.default_rng(dim)
    v = np.round(rng.normal(size=(900, dim)), 1)
    v[:250] = v[0]  # copies
    v[250:450] = v[250] + np.round(rng.normal(size=(200, dim)) * 1e-3, 4)
    v[-5:] = 1e4 * rng.normal(size=(5, dim))
    ids = rng.permutation(900) * 3
    g = np.where(np.arange(900) % 40 == 7, "b", np.where(np.arange(900) == 13, "c", "a"))
    df = spark.createDataFrame(pd.DataFrame({"_id": ids, "_v": list(v), "_g": g}), "_id long, _v array<double>, _g string").checkpoint()
    got = metric_join(df, df, 4, True, cell_rows, per_pivot=per_pivot).collect()
    assert sorted((r["qid"], r["nid"], r["rank"]) for r in got) == _brute_knn(ids, v, g, range(900), 4)


def test_metric_join_sees_few_cells_of_a_low_dimensional_table(spark):
    """Copies of a query stay near constant while donors grow tenfold."""
    from riskframe.operators import pivots
    rng = np.random.default_rng(4)
    seen = []
    for n in (2000, 20000):
        v = rng.random((n, 2))
        size = 128
        p = v[: n // size]
        cell = pivots._between(v, p)[0].argmin(1)
        to = np.sqrt(((v - p[cell]) ** 2).sum(1))
        cells, first = np.unique(np.sort(cell), return_index=True)
        o = np.argsort(cell, kind="stable")
        low, high = np.minimum.reduceat(to[o], first), np.maximum.reduceat(to[o], first)
        count = np.diff(np.r_[first, n])
        block = pivots.blocks_of(p, cells, count, 500)
        q = rng.integers(0, n, 200)
        bound = pivots.upper_bounds(q, v[q], p, np.arange(len(p)), cells, count, high, np.ones(len(cells), bool), 5, True)
        hit = pivots.lower_bounds(v[q], p, cells, low, high) <= bound[:, None]
        seen.append(np.mean([len(set(block[h])) for h in hit]))
    assert seen[1] < 1.5 * seen[0] < 9


def test_knn_leaves_out_what_is_no_vector(spark):
    rows = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, [float("nan"), 0.0]), (5, [None, 1.0]), (6, []), (7, [1.0]), (8, [2.0]), (9, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    assert sorted((r["qid"], r["nid"]) for r in knn(df, df, "id", "v", k=3).collect()) == [(1, 2), (2, 1), (7, 8), (8, 7)]
    assert knn(df.limit(0), df, "id", "v").count() == 0 and knn(df, df.limit(0), "id", "v").count() == 0


@pytest.mark.parametrize("dim", [3, 64])
def test_block_search_equals_brute_force_in_matrices_of_bounded_size(monkeypatch, dim):
    from riskframe.operators import pivots
    rng = np.random.default_rng(8)
    d, ids = np.round(rng.normal(size=(6000, dim)), 1), rng.permutation(6000).astype(np.int64)
    held, between = [], pivots._between
    exp = pivots.nearest(ids, d, ids, d, 4, True)
    monkeypatch.setattr(pivots, "_between", lambda a, b: (held.append(len(a) * len(b)), between(a, b))[1])
    got = pivots.search_block(ids, d, np.full(6000, np.inf), ids, d, 4, True)
    assert (got[0] == exp[0]).all() and np.allclose(got[1], exp[1], rtol=1e-12)
    assert max(held) <= pivots.MATRIX      # 6000 queries times all pivots of the group before
    if dim == 3:
        assert sum(held) < 6000 * 6000 / 5


def test_knn_impute_settles_queries_at_home_whatever_the_number_of_regions(spark, monkeypatch):
    """Copies beyond a region, infinite cells, rows without an id, queries that lack the
    columns of the cuts: brute force, and few queries that leave their region."""
    from riskframe.operators import neighbours
    rng = np.random.default_rng(6)
    n, m, k = 3000, 3, 3
    mat = np.round(rng.random((n, m)) * 100, 3)
    mat[rng.random(n) < 0.5, 2] = np.nan
    mat[:60, 0] = np.nan
    mat[:700:9] = np.nan
    mat[2000:2600, :2] = mat[2000, :2]  # copies but for the third column
    mat[2000:2600, 2] = np.where(np.arange(600) % 2, np.nan, 5.0)
    mat[2900:2903, 2] = np.inf
    ids = np.arange(n, dtype=np.int64)
    cols = [f"c{j}" for j in range(m)]
    pdf = pd.DataFrame(mat, columns=cols).astype(object).where(~np.isnan(mat), None)
    pdf.insert(0, "id", ids)
    pdf["id"] = pdf["id"].astype(object).where(ids != 2999, None)
    df = spark.createDataFrame(pdf, "id long, " + ", ".join(f"{c} double" for c in cols))
    kept = []
    monkeypatch.setattr(neighbours, "written", lambda d, tag: (kept.append(d.checkpoint()), kept[-1])[1])
    got = neighbours.knn_impute(df, "id", cols, k=k, cell_rows=100).toPandas()
    got = got[got.id.notna()].set_index("id")
    means = [pdf[c].astype(float).mean() for c in cols]
    picks = {}
    with np.errstate(invalid="ignore"):
        for q, j, nid in _brute_impute(ids, mat, np.flatnonzero(np.isnan(mat).any(1) & (ids != 2999)), k):
            picks.setdefault((q, j), []).append(mat[nid, j])
    for q, j in zip(*np.nonzero(np.isnan(mat[:2999]))):
        assert got.loc[q, cols[j]] == pytest.approx(np.mean(picks[q, j]) if (q, j) in picks else means[j])
    homes = kept[0]
    total, cells = homes.count(), homes.select(F.sum(F.size("_to"))).first()[0]
    assert total > 1200 and cells < 4 * total  # of more than 30 regions; before, every query was searched in each block


@pytest.mark.parametrize(("dim", "cell_rows"), [(2, 60), (2, 5000), (6, 100), (1, 40)])
def test_region_join_equals_brute_force(spark, dim, cell_rows):
    """Ties, copies beyond a block, a dense clump, far rows, small groups, rows that come twice."""
    from riskframe.operators.regions import region_join
    rng = np.random.default_rng(dim)
    v = np.round(rng.normal(size=(900, dim)), 1)
    v[:250] = v[0]
    v[250:450] = v[250] + np.round(rng.normal(size=(200, dim)) * 1e-3, 4)
    v[-5:] = 1e4 * rng.normal(size=(5, dim))
    ids = rng.permutation(900) * 3
    g = np.where(np.arange(900) % 40 == 7, "b", np.where(np.arange(900) == 13, "c", "a"))
    df = spark.createDataFrame(pd.DataFrame({"_id": ids, "_v": list(v), "_g": g}), "_id long, _v array<double>, _g string").checkpoint()
    got = region_join(df, df, 4, True, cell_rows, dim).collect()
    assert sorted((r["qid"], r["nid"], r["rank"]) for r in got) == _brute_knn(ids, v, g, range(900), 4)
    some = df.where("_id % 2 = 0 or _g = 'b'")  # queries whose region or group has no donors
    got = region_join(df, some, 4, True, cell_rows, dim).collect()
    own = {r["_id"] for r in some.select("_id").collect()}
    exp = []
    for i in range(900):
        e = np.sqrt(((v - v[i]) ** 2).sum(1))
        e[[x not in own or x == ids[i] for x in ids]] = np.inf
        e[g != g[i]] = np.inf
        exp += [(ids[i], ids[j], r) for r, j in enumerate(np.lexsort((ids, e))[:4], 1) if np.isfinite(e[j])]
    assert sorted((r["qid"], r["nid"], r["rank"]) for r in got) == sorted(exp)


def test_region_join_sends_a_query_to_few_regions_despite_a_heavy_tail(spark, monkeypatch):
    """A ratio with a few far values would draw all cuts of the widest coordinate."""
    from riskframe.operators import regions
    rng = np.random.default_rng(3)
    v = np.column_stack([rng.random((6000, 3)), 1 / rng.normal(size=6000)])
    df = spark.createDataFrame([(i, x.tolist(), "a") for i, x in enumerate(v)], "_id long, _v array<double>, _g string").checkpoint()
    kept = []
    monkeypatch.setattr(regions, "written", lambda d, tag: (kept.append(d.checkpoint()), kept[-1])[1])
    got = regions.region_join(df, df, 5, True, 200, 4).where("qid < 50").collect()
    assert sorted((r["qid"], r["nid"], r["rank"]) for r in got) == _brute_knn(np.arange(6000), v, np.repeat("a", 6000), range(50), 5)
    assert kept[0].select(F.avg(F.size("_to"))).first()[0] < 6  # of some 30 regions


def test_smote_fit_searches_the_neighbours_once(spark, monkeypatch):
    """The passes of the fit read written synthetic rows: no neighbour join in the frame that is fitted."""
    from riskframe.operators import model
    rng = np.random.default_rng(5)
    rows = [(i, int(i % 5 == 0), float(rng.normal() + i % 5), float(rng.normal())) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    seen, fit = [], model.LogisticRegression.fit
    monkeypatch.setattr(model.LogisticRegression, "fit", lambda self, d: (seen.append(d), fit(self, d))[1])
    model.fit_logistic_smote(df, ["a", "b"], "y", "id")
    assert "FlatMapCoGroups" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert {r["_label"]: r["count"] for r in seen[0].groupBy("_label").count().collect()} == {0.0: 240, 1.0: 240}
