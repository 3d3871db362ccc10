"""Many penalised logistic regressions in the scans of one.

A model is a ``Problem``: a feature subset, a penalty and the fold it leaves
out. ``fit_many`` fits all of them together by Newton's method: one pass over
the rows returns loss, gradient and Hessian of every problem that is still
open, as sums per task (a few hundred numbers a problem, whatever the number
of rows), added up by a grouped aggregate. The driver solves one small system
per problem. Folds x penalties x subsets cost the scans of the slowest fit.

The objective is that of ``model.fit_logistic``: C * sum(w * loss) + |b|^2 / 2
over features scaled by the training rows' mean and population deviation, no
penalty on the intercept, balanced class weights n / (2 n_class). Every fit
carries its certificate: the gradient of the weighted mean objective and the
Newton step at the very coefficients that are returned, both measured on all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.operators import ranks
from riskframe.session import written


@dataclass(frozen=True)
class Problem:
    """One model to fit: its features, C, and the fold whose rows it does not see."""
    features: tuple[str, ...]
    C: float = 1.0
    held_out: int | None = None


@dataclass
class Fit:
    """``intercept`` and ``coef`` act on (x - mean) / std. ``gradient`` is the
    largest component of the mean objective's gradient, ``step`` the largest of
    the Newton step. A problem whose rows lack a class has no optimum: its
    coefficients are NaN and ``converged`` is false."""
    problem: Problem
    mean: np.ndarray
    std: np.ndarray
    weight: tuple[float, float]
    beta: np.ndarray                 # intercept first
    gradient: float = float("nan")
    step: float = float("nan")
    iterations: int = 0
    converged: bool = False
    _base: tuple | None = field(default=None, repr=False)   # last accepted (loss, beta)

    @property
    def intercept(self) -> float:
        return float(self.beta[0])

    @property
    def coef(self) -> dict[str, float]:
        return {f: float(b) for f, b in zip(self.problem.features, self.beta[1:])}


def _moments(rows: DataFrame, features: Sequence[str]) -> list:
    """Per fold: class sizes, means and squared deviations (one aggregate)."""
    aggs = [F.count_if(F.col("_y") == 0).alias("n0"), F.count_if(F.col("_y") == 1).alias("n1")]
    for i in range(len(features)):
        aggs += [F.avg(f"_x{i}").alias(f"m{i}"), F.var_pop(f"_x{i}").alias(f"v{i}")]
    out = []
    for r in rows.groupBy("_fold").agg(*aggs).collect():        # a row per fold
        k = range(len(features))
        out.append((r["_fold"], r["n0"], r["n1"], np.array([r[f"m{i}"] for i in k]), np.array([r[f"v{i}"] for i in k])))
    return out


def _scaling(moments: list, held_out: int | None):
    """Class sizes, mean and population deviation over the folds but one."""
    parts = [m for m in moments if held_out is None or m[0] != held_out]
    n0, n1 = sum(m[1] for m in parts), sum(m[2] for m in parts)
    if n0 + n1 == 0:
        return 0, 0, None, None
    share = [(m[1] + m[2]) / (n0 + n1) for m in parts]
    mean = sum(s * m[3] for s, m in zip(share, parts))
    var = sum(s * (m[4] + (m[3] - mean) ** 2) for s, m in zip(share, parts))
    std = np.sqrt(var)
    return n0, n1, mean, np.where(std > 0, std, 1.0)


def _pass(rows: DataFrame, open_: dict[int, Fit], index: dict[str, int]) -> dict[int, np.ndarray]:
    """Loss, gradient and upper Hessian of each open problem, summed over all rows."""
    work = [(k, [index[f] for f in fit.problem.features], fit.mean, fit.std, fit.weight, fit.beta, fit.problem.held_out)
            for k, fit in open_.items()]
    names = [f"_x{i}" for i in range(len(index))]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {}
        for b in batches:
            x, y = b[names].to_numpy(dtype=float), b["_y"].to_numpy(dtype=float)
            fold = b["_fold"].to_numpy()
            for k, cols, mean, std, weight, beta, held in work:
                seen = slice(None) if held is None else fold != held
                z = np.column_stack([np.ones(len(y[seen])), (x[seen][:, cols] - mean) / std])
                eta, t = z @ beta, y[seen]
                w = np.where(t == 1, weight[1], weight[0])
                p = 0.5 * (1 + np.tanh(eta / 2))
                hess = (z * (w * p * (1 - p))[:, None]).T @ z
                part = np.concatenate([[np.sum(w * (np.logaddexp(0, eta) - t * eta))], z.T @ (w * (p - t)),
                                       hess[np.triu_indices(len(beta))]])
                total[k] = part + total[k] if k in total else part
        for k, v in total.items():
            yield pd.DataFrame({"k": k, "at": np.arange(len(v)), "v": v})

    out = rows.mapInPandas(sums, "k int, at int, v double").groupBy("k", "at").agg(F.sum("v").alias("v"))
    got: dict[int, dict] = {}
    for r in out.collect():                          # (d + 1)(d + 4) / 2 + 1 numbers a problem
        got.setdefault(r["k"], {})[r["at"]] = r["v"]
    return {k: np.array([v[i] for i in range(len(v))]) for k, v in got.items()}


def _advance(fit: Fit, sums: np.ndarray, tol: float) -> None:
    """One Newton step from ``fit.beta``, halved while the objective rises."""
    d = len(fit.beta)
    pen = np.full(d, 1.0 / fit.problem.C)
    pen[0] = 0.0
    loss = sums[0] + np.sum(pen * fit.beta ** 2) / 2
    grad = sums[1:d + 1] + pen * fit.beta
    hess = np.zeros((d, d))
    hess[np.triu_indices(d)] = sums[d + 1:]
    hess = hess + np.triu(hess, 1).T + np.diag(pen)
    fit.iterations += 1
    if fit._base is not None and not loss <= fit._base[0] + 1e-9 * abs(fit._base[0]):
        fit.beta = (fit.beta + fit._base[1]) / 2
        return
    step = np.linalg.lstsq(hess, grad, rcond=None)[0]
    fit.gradient, fit.step = float(np.max(np.abs(grad))), float(np.max(np.abs(step)))
    if fit.step <= tol * (1 + np.max(np.abs(fit.beta))):
        fit.converged = True
        return
    fit._base = (loss, fit.beta)
    fit.beta = fit.beta - step


def narrow(df: DataFrame, features: Sequence[str], target: str, fold: str | None = None) -> DataFrame:
    """The rows of a fit as one written table of plain numbers: class, fold and
    features. Rows with a missing class, fold or feature take no part."""
    cols = [F.col(target).cast("int").alias("_y"), (F.col(fold) if fold else F.lit(0)).cast("int").alias("_fold")]
    cols += [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    rows = df.select(*cols)
    ok = F.col("_y").isin(0, 1) & F.col("_fold").isNotNull()
    for i in range(len(features)):
        ok &= F.col(f"_x{i}").isNotNull() & ~F.isnan(f"_x{i}")
    return written(rows.filter(ok), "fit")


def fit_many(df: DataFrame, problems: Sequence[Problem], target: str, fold: str | None = None,
             balanced: bool = True, tol: float = 1e-9, max_iter: int = 100,
             start: Sequence[Fit | None] | None = None, rows: DataFrame | None = None) -> list[Fit]:
    """All ``problems`` fitted together; one ``Fit`` each, in order.

    ``fold`` names the column that ``held_out`` refers to. ``start`` gives
    earlier fits whose coefficients the search begins with, by feature name.
    ``rows`` is the result of ``narrow`` over all features of the problems, in
    first-seen order, for callers that fit several times. A fit ends when its
    Newton step is at most ``tol``; after ``max_iter`` passes ``converged`` stays false.
    """
    names = list(dict.fromkeys(f for p in problems for f in p.features))
    if rows is None:
        rows = narrow(df, names, target, fold)
    index = {f: i for i, f in enumerate(names)}
    moments = _moments(rows, names)
    fits = []
    for j, p in enumerate(problems):
        n0, n1, mean, std = _scaling(moments, p.held_out)
        cols = [index[f] for f in p.features]
        d = len(cols) + 1
        if not n0 or not n1:
            nan = np.full(d - 1, np.nan)
            fits.append(Fit(p, nan, nan, (np.nan, np.nan), np.full(d, np.nan)))
            continue
        n = n0 + n1
        weight = (n / (2 * n0), n / (2 * n1)) if balanced else (1.0, 1.0)
        fit = Fit(p, mean[cols], std[cols], weight, np.zeros(d))
        old = start[j] if start else None
        if old is not None and np.all(np.isfinite(old.beta)):
            fit.beta = np.array([old.intercept] + [old.coef.get(f, 0.0) for f in p.features])
        fits.append(fit)
    total = {j: f.weight[0] * m[0] + f.weight[1] * m[1] for j, f in enumerate(fits)
             for m in [_scaling(moments, f.problem.held_out)[:2]] if np.all(np.isfinite(f.beta))}
    for _ in range(max_iter):
        open_ = {j: fits[j] for j in total if not fits[j].converged}
        if not open_:
            break
        for j, sums in _pass(rows, open_, index).items():
            _advance(fits[j], sums, tol)
    for j, w in total.items():
        fits[j].gradient /= w
    return fits


def probability(fit: Fit) -> Column:
    """I2 as a plain expression over the unscaled features."""
    eta = F.lit(fit.intercept)
    for f, m, s in zip(fit.problem.features, fit.mean, fit.std):
        eta = eta + F.lit(fit.coef[f]) * (F.col(f).cast("double") - F.lit(float(m))) / F.lit(float(s))
    return 1 / (1 + F.exp(-eta))


def coefficient_table(spark, fit: Fit) -> DataFrame:
    """I10 with its certificate: feature, coefficient, importance, and whether
    gradient and Newton step at these coefficients are below 1e-6."""
    ok = bool(fit.converged and fit.gradient < 1e-6 and fit.step < 1e-6)
    rows = [(f, b, abs(b), ok) for f, b in fit.coef.items()]
    return spark.createDataFrame(rows, "feature string, coefficient double, importance double, certified boolean")


def grouped_auc(scores: DataFrame, variable: str = "variable", value: str = "value", label: str = "label") -> DataFrame:
    """Exact AUC per ``variable``, mid-ranks for ties: variable, auc (null where
    a class is absent). All variables share one cumulative count."""
    y = F.col(label).cast("int")
    g = scores.filter(F.col(value).isNotNull() & ~F.isnan(value)).groupBy(
        F.col(variable).alias("variable"), F.col(value).alias("value")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    cum = ranks.cumulative(g, ("variable",), "value", ("neg",))
    won = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    return cum.groupBy("variable").agg(F.try_divide(won, F.sum("pos").cast("double") * F.sum("neg")).alias("auc"))


def out_of_fold_auc(df: DataFrame, features: Sequence[str], target: str, fold: str, k: int,
                    penalties: Sequence[float] = (1.0,)) -> DataFrame:
    """C, fold, auc. Models of every (penalty, fold) are fitted
    together; each row is scored by the models that did not see it."""
    feats = tuple(features)
    problems = [Problem(feats, C, f) for C in penalties for f in range(k)]
    # the fold (md5 of the key) and the filled features are computed once, for the fits and the scores
    names = list(dict.fromkeys(feats))
    rows = narrow(df, names, target, fold)
    fits = fit_many(df, problems, target, fold, rows=rows)
    by = {(p.C, p.held_out): f for p, f in zip(problems, fits)}
    items = []
    for i, C in enumerate(penalties):
        p = None
        for f in range(k):
            hit, val = F.col("_fold") == f, probability(by[C, f])
            p = F.when(hit, val) if p is None else p.when(hit, val)
        items.append(F.struct(F.lit(i).alias("c"), p.alias("value")))
    long = rows.select("_y", "_fold", *[F.col(f"_x{i}").alias(f) for i, f in enumerate(names)]).select(
        F.col("_y").cast("string").alias("_g"), "_fold", F.explode(F.array(*items)).alias("s"))
    long = long.select(F.concat_ws(":", "s.c", "_fold").alias("variable"), "s.value", "_g").filter(F.col("value").isNotNull() & ~F.isnan("value"))
    n0, n1, r1 = [F.coalesce(F.sum(F.when(F.col("grp") == g, F.col(x))), F.lit(0)).cast("double") for g, x in (("0", "n_g"), ("1", "n_g"), ("1", "R_g"))]
    auc = ranks.rank_sums(long).groupBy("variable").agg(F.try_divide(r1 - n1 * (n1 + 1) / 2, n0 * n1).alias("auc"))
    at = F.split("variable", ":")
    return auc.select(F.element_at(F.array(*[F.lit(float(C)) for C in penalties]), at[0].cast("int") + 1).alias("C"), at[1].cast("int").alias("fold"), "auc")


def eliminate(df: DataFrame, features: Sequence[str], target: str, keep: int) -> DataFrame:
    """K7: the feature of smallest |coefficient| goes (ties: first name) until
    ``keep`` remain. feature, dropped_at (1 = first, null = kept), importance (the
    |coefficient| it went with, or has in the last fit). Rows with a gap in any
    feature take no part in any fit; each fit starts from the one before."""
    feats, out, last = list(features), [], None
    rows = narrow(df, feats, target)
    order = list(feats)
    while True:
        fit = fit_many(df, [Problem(tuple(feats))], target, start=[last], rows=_picked(rows, order, feats))[0]
        if len(feats) <= max(keep, 1):
            break
        worst = min(feats, key=lambda f: (abs(fit.coef[f]), f))
        out.append((worst, len(out) + 1, abs(fit.coef[worst])))
        feats.remove(worst)
        last = fit
    out += [(f, None, abs(fit.coef[f])) for f in feats]
    return df.sparkSession.createDataFrame(out, "feature string, dropped_at int, importance double")


def _picked(rows: DataFrame, order: Sequence[str], feats: Sequence[str]) -> DataFrame:
    return rows.select("_y", "_fold", *[F.col(f"_x{order.index(f)}").alias(f"_x{i}") for i, f in enumerate(feats)])
