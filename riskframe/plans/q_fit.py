"""Registered queries: fits and splits that another engine can repeat (G3, G8,
I1, I2, I5, I10, K7, K12).

The oracle of a fit is Newton's method in SQL: a recursive query sums gradient
and Hessian over the scaled rows, eliminates the small system column by column
and takes the step, a fixed number of times.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import model, newton, prepare
from riskframe.plans.q_clean import BEH_SQL, FIN_SQL, RISK_SQL
from riskframe.plans.q_model import _DRAW, _RANK_AUC, MODEL_CATS, MODEL_FEATURES, _model_frames
from riskframe.plans.registry import register
from riskframe.sources.fixtures import TRAIN_CUTOFF, applications, with_fixture

_KEY = _DRAW.format("CLIENT_ID, 42")
_SHAPES = FIN_SQL | BEH_SQL | RISK_SQL


def _recursive(tail: str) -> str:
    return with_fixture(tail).replace("WITH ", "WITH RECURSIVE ", 1)


def _train_sql(cats=()) -> str:
    """CTEs raw, med, tr (train rows: CLIENT_ID, y, f1..) and te (test rows)."""
    fs = [f"CAST({_SHAPES.get(c, c)} AS DOUBLE)" for c in MODEL_FEATURES]
    n = len(fs)
    pick = [f"coalesce(f{i}, m{i}) AS f{i}" for i in range(1, n + 1)]
    codes = [f"CAST(dense_rank() OVER (ORDER BY coalesce({c}, 'INCONNU')) - 1 AS DOUBLE) AS f{n + 1 + i}"
             for i, c in enumerate(cats)]
    late = f"DATE_MONTH >= TIMESTAMP '{TRAIN_CUTOFF}'"
    body = ", ".join(pick + [f"f{n + 1 + i}" for i in range(len(cats))])
    return f"""raw AS (SELECT CLIENT_ID, {late} AS late, CAST(TARGET AS INTEGER) AS y,
  {', '.join(f'{e} AS f{i}' for i, e in enumerate(fs, 1))}{''.join(', ' + c for c in codes)} FROM credit),
med AS (SELECT {', '.join(f'quantile_cont(f{i}, 0.5) AS m{i}' for i in range(1, n + 1))} FROM raw WHERE NOT late),
al AS (SELECT CLIENT_ID, late, y, {body} FROM raw, med),
te AS (SELECT * FROM al WHERE late)"""


def _newton_sql(d: int, problems: str, folds: str, steps: int, drop_every: int = 0, keep: int = 0) -> str:
    """CTEs tr, prob, sc and it: ``it`` holds the coefficients b0..bd of problem k
    after i steps. ``problems`` are VALUES of (k, C, held); ``folds`` the fold
    expression of a train row. With ``drop_every`` the active feature of least
    |b| goes after so many steps (flags a1..ad, its |b| in dm) until ``keep`` remain."""
    js = range(1, d + 1)
    every = range(d + 1)
    h = {(r, s): f"h{r}_{s}" for r in every for s in every if r <= s}
    x = lambda j: "1.0" if j == 0 else f"x{j}"                                      # noqa: E731
    state = [f"b{j}" for j in every] + [f"a{j}" for j in js]
    eta = " + ".join(["b0"] + [f"b{j} * x{j}" for j in js])
    q = f"SELECT it.*, lam, y, w, {', '.join(f'x{j}' for j in js)}, 1 / (1 + exp(-({eta}))) AS p FROM it JOIN z ON it.k = z.k WHERE i < {steps}"
    sums = [f"sum(w * (p - y) * {x(j)})" + (f" + lam * b{j}" if j else "") + f" AS r{j}" for j in every]
    sums += [f"sum(w * p * (1 - p) * {x(r)} * {x(s)})"
             + (f" + lam + CASE WHEN a{r} = 0 THEN 1e30 ELSE 0 END" if r == s and r else "") + f" AS {n}"
             for (r, s), n in h.items()]
    q = f"SELECT k, i, {', '.join(state)}, {', '.join(sums)} FROM ({q}) GROUP BY k, i, lam, {', '.join(state)}"
    for c in range(d):                                   # eliminate column c below the diagonal
        cols = [f"r{j}" if j <= c else f"r{j} - h{c}_{j} / h{c}_{c} * r{c} AS r{j}" for j in every]
        cols += [n if r <= c else f"{n} - h{c}_{r} * h{c}_{s} / h{c}_{c} AS {n}" for (r, s), n in h.items()]
        q = f"SELECT k, i, {', '.join(state)}, {', '.join(cols)} FROM ({q})"
    for c in reversed(every):                            # back substitution, last unknown first
        known = "".join(f" - h{c}_{j} * s{j}" for j in range(c + 1, d + 1))
        q = f"SELECT *, (r{c}{known}) / h{c}_{c} AS s{c} FROM ({q})"
    new = ", ".join([f"b{j} - s{j} AS b{j}" for j in every] + [f"a{j}" for j in js])
    q = f"SELECT k, i + 1 AS i, {new} FROM ({q})"
    least = f"least({', '.join(f'CASE WHEN a{j} = 1 THEN abs(b{j}) ELSE 1e300 END' for j in js)})"
    now = f"i % {drop_every} = 0 AND {' + '.join(f'a{j}' for j in js)} > {keep}" if drop_every else "false"
    gone = {j: f"go AND a{j} = 1 AND abs(b{j}) = dm" for j in js}
    q = (f"SELECT k, i, b0, {', '.join(f'CASE WHEN {gone[j]} THEN 0 ELSE b{j} END AS b{j}' for j in js)}, "
         f"{', '.join(f'CASE WHEN {gone[j]} THEN 0 ELSE a{j} END AS a{j}' for j in js)}, dm "
         f"FROM (SELECT *, {now} AS go, {least} AS dm FROM ({q}))")
    zero = ", ".join(["CAST(0 AS DOUBLE)"] * (d + 1) + ["1"] * d + ["CAST(0 AS DOUBLE)"])
    return f"""tr AS MATERIALIZED (SELECT *, {folds} AS fold FROM al WHERE NOT late),
prob(k, C, held) AS (VALUES {problems}),
sc AS (SELECT k, C, held, count(*) / (2.0 * count_if(y = 0)) AS w0, count(*) / (2.0 * count_if(y = 1)) AS w1,
  {', '.join(f'avg(f{j}) AS m{j}, coalesce(nullif(stddev_pop(f{j}), 0), 1) AS d{j}' for j in js)}
  FROM tr JOIN prob ON fold <> held GROUP BY k, C, held),
z AS MATERIALIZED (SELECT k, 1.0 / C AS lam, y, CASE WHEN y = 1 THEN w1 ELSE w0 END AS w,
  {', '.join(f'(f{j} - m{j}) / d{j} AS x{j}' for j in js)} FROM tr JOIN sc ON fold <> held),
it({', '.join(['k', 'i'] + state + ['dm'])}) AS (SELECT k, 0, {zero} FROM prob UNION ALL {q})"""


_ALL = MODEL_FEATURES + MODEL_CATS
_ONE = "(0, 1.0, -1)"
_STEPS = 15


def _encoded(df):
    return prepare.label_encode(df, MODEL_CATS)


@register("i1_certified_coefficients", _recursive(_train_sql(MODEL_CATS) + ", " + _newton_sql(len(_ALL), _ONE, "0", _STEPS) + """
""" + "\nUNION ALL ".join(
    f"SELECT '{f}' AS feature, b{j} AS coefficient, abs(b{j}) AS importance, true AS certified FROM it WHERE i = {_STEPS}"
    for j, f in enumerate(_ALL, 1))), ["coefficient", "importance"], "I1 I10 G1 G4 G7 G8")
def i1_certified_coefficients(spark, sf):
    """The penalised fit over numeric and label-encoded features, with the
    certificate that gradient and Newton step vanish at its coefficients."""
    tr, te = _model_frames(spark, sf)
    codes = _encoded(tr.select(*tr.columns).unionByName(te)).where(F.col("DATE_MONTH") < F.lit(TRAIN_CUTOFF).cast("timestamp"))
    fit = newton.fit_many(codes, [newton.Problem(tuple(_ALL))], "TARGET")[0]
    return newton.coefficient_table(spark, fit)


_D = len(MODEL_FEATURES)
_METRICS = """sc2 AS (SELECT y, p AS s, CAST(p >= 0.5 AS INTEGER) AS pr FROM scored),
c AS (SELECT count_if(y = 1 AND pr = 1) * 1.0 AS tp, count_if(y = 0 AND pr = 1) * 1.0 AS fp,
             count_if(y = 1 AND pr = 0) * 1.0 AS fn, count_if(y = 0 AND pr = 0) * 1.0 AS tn FROM sc2),
""" + _RANK_AUC.replace("FROM sc)", "FROM sc2)") + """
SELECT 'accuracy' AS metric, (tp + tn) / (tp + tn + fp + fn) AS value FROM c
UNION ALL SELECT 'precision', tp / nullif(tp + fp, 0) FROM c
UNION ALL SELECT 'recall', tp / nullif(tp + fn, 0) FROM c
UNION ALL SELECT 'f1', 2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
                       / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0) FROM c
UNION ALL SELECT 'auc', auc FROM au"""


def _score_sql(rows: str, extra: str = "y") -> str:
    """CTE scored: probability p of the ``rows`` under the last step of their problem."""
    eta = " + ".join(["b0"] + [f"b{j} * (f{j} - m{j}) / d{j}" for j in range(1, _D + 1)])
    return f"scored AS (SELECT {extra}, 1 / (1 + exp(-({eta}))) AS p FROM {rows} WHERE i = {_STEPS})"


@register("i2_certified_scores", _recursive(_train_sql() + ", " + _newton_sql(_D, _ONE, "0", _STEPS) + ",\n"
          + _score_sql("te, sc JOIN it ON sc.k = it.k") + ",\n" + _METRICS), ["value"], "I2 I3")
def i2_certified_scores(spark, sf):
    """The test months scored by the certified fit of the train months."""
    tr, te = _model_frames(spark, sf)
    fit = newton.fit_many(tr, [newton.Problem(tuple(MODEL_FEATURES))], "TARGET")[0]
    scored = te.select(F.col("TARGET").cast("int").alias("label"), newton.probability(fit).alias("p1"))
    return model.classification_metrics(scored.withColumn("pred", (F.col("p1") >= 0.5).cast("int")))


def _fold_auc_sql(k: int, grid) -> str:
    """Oracle CTEs up to cv(C, fold, auc)."""
    folds = f"ntile({k}) OVER (PARTITION BY y ORDER BY {_KEY}) - 1"
    problems = ", ".join(f"({g * k + f}, {C}, {f})" for g, C in enumerate(grid) for f in range(k))
    return (_train_sql() + ", " + _newton_sql(_D, problems, folds, _STEPS) + ",\n"
            + _score_sql("tr JOIN sc ON fold = held JOIN it ON sc.k = it.k", "C, fold, y") + """,
rk AS (SELECT C, fold, y, rank() OVER (PARTITION BY C, fold ORDER BY p) + (count(*) OVER (PARTITION BY C, fold, p) - 1) / 2.0 AS ar
       FROM scored),
cv AS (SELECT C, CAST(fold AS INTEGER) AS fold, (sum(CASE WHEN y = 1 THEN ar END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
              / (count_if(y = 1) * 1.0 * count_if(y = 0)) AS auc FROM rk GROUP BY C, fold)
""")


@register("i5_cross_validated_auc", _recursive(_fold_auc_sql(5, (1.0,)) + """SELECT fold, auc FROM cv
UNION ALL SELECT -1, avg(auc) FROM cv UNION ALL SELECT -2, 2 * stddev_pop(auc) FROM cv"""), ["auc"], "I5")
def i5_cross_validated_auc(spark, sf):
    """AUC of every fold, their mean (-1) and two population deviations (-2)."""
    tr, _ = _model_frames(spark, sf)
    return model.cross_validated_auc(tr, MODEL_FEATURES, "TARGET", "CLIENT_ID", k=5)


_GRID = (0.01, 1.0, 100.0)


@register("k12_grid_search", _recursive(_fold_auc_sql(3, _GRID)
          + "SELECT CAST(C AS DOUBLE) AS C, avg(auc) AS cv_auc FROM cv GROUP BY C"), ["C", "cv_auc"], "K12")
def k12_grid_search(spark, sf):
    """C grid x 3-fold stratified CV AUC; one row per candidate."""
    tr, _ = _model_frames(spark, sf)
    folded = model.fold_column(tr, "TARGET", "CLIENT_ID", 3)
    out = newton.out_of_fold_auc(folded, MODEL_FEATURES, "TARGET", "fold", 3, _GRID)
    return out.groupBy("C").agg(F.avg("auc").alias("cv_auc"))


_KEEP = 3
_ROUNDS = _D - _KEEP


@register("k7_recursive_elimination", _recursive(
    _train_sql() + ", " + _newton_sql(_D, _ONE, "0", (_ROUNDS + 1) * _STEPS, _STEPS, _KEEP) + "\n" + "\nUNION ALL ".join(
        f"""SELECT '{f}' AS feature, CAST((min(CASE WHEN a{j} = 0 THEN i END)) // {_STEPS} AS INTEGER) AS dropped_at,
       coalesce(arg_min(dm, i) FILTER (a{j} = 0), max(CASE WHEN i = {(_ROUNDS + 1) * _STEPS} THEN abs(b{j}) END)) AS importance FROM it"""
        for j, f in enumerate(MODEL_FEATURES, 1))), ["importance"], "K7")
def k7_recursive_elimination(spark, sf):
    """Every feature with the round it was dropped in (null: one of the three kept)."""
    tr, _ = _model_frames(spark, sf)
    return newton.eliminate(tr, MODEL_FEATURES, "TARGET", keep=_KEEP)


@register("g3_split_rows", with_fixture(f"""
r AS (SELECT CLIENT_ID, TARGET, row_number() OVER (PARTITION BY TARGET ORDER BY {_KEY}) - 1 AS pos,
             count(*) OVER (PARTITION BY TARGET) AS n FROM applications)
SELECT CLIENT_ID, CASE WHEN pos < round(n * 0.2) THEN 'test' ELSE 'train' END AS side FROM r"""), [], "G3")
def g3_split_rows(spark, sf):
    """Which side every row falls on."""
    df = applications(spark, sf).select("CLIENT_ID", F.col("TARGET").cast("int").alias("TARGET"))
    tr, te = prepare.stratified_split(df, "TARGET", "CLIENT_ID", 0.2, seed=42)
    return tr.select("CLIENT_ID", F.lit("train").alias("side")).unionByName(te.select("CLIENT_ID", F.lit("test").alias("side")))


@register("i5_fold_rows", with_fixture(f"""
SELECT CLIENT_ID, CAST(ntile(5) OVER (PARTITION BY TARGET ORDER BY {_KEY}) - 1 AS INTEGER) AS fold FROM applications"""), [], "I5")
def i5_fold_rows(spark, sf):
    """The fold of every row."""
    df = applications(spark, sf).select("CLIENT_ID", F.col("TARGET").cast("int").alias("TARGET"))
    return model.fold_column(df, "TARGET", "CLIENT_ID", 5).select("CLIENT_ID", "fold")
