"""Registered queries: preparation, model, evaluation, neighbours, declared
items (G-, I-, K-, E3, A-families)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskframe.operators import clean, features, model, neighbours, prepare, profile
from riskframe.plans.registry import register
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.fixtures import TRAIN_CUTOFF, applications, credit_view, with_fixture
from riskframe.sources.io import read_table

# A transparent score for evaluation queries: higher order value, higher risk.
SCORE_SQL = "LOAN_AMOUNT / (LOAN_AMOUNT + 150000.0)"


def _scored(spark, sf):
    return applications(spark, sf).select(
        "CLIENT_ID", (F.col("LOAN_AMOUNT") / (F.col("LOAN_AMOUNT") + 150000.0)).alias("p1"),
        F.col("TARGET").cast("int").alias("label")).withColumn("pred", (F.col("p1") >= 0.5).cast("int"))


_SC_CTE = f"""sc AS (SELECT CLIENT_ID, {SCORE_SQL} AS s, CAST(TARGET AS INTEGER) AS y,
                 CAST({SCORE_SQL} >= 0.5 AS INTEGER) AS p FROM applications)"""
_RANK_AUC = """rk AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2.0 AS ar FROM sc),
au AS (SELECT (sum(CASE WHEN y = 1 THEN ar END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
              / (count_if(y = 1) * 1.0 * count_if(y = 0)) AS auc FROM rk)"""


@register("i3_classification_metrics", with_fixture(_SC_CTE + ",\n" + _RANK_AUC + """,
c AS (SELECT count_if(y = 1 AND p = 1) * 1.0 AS tp, count_if(y = 0 AND p = 1) * 1.0 AS fp,
             count_if(y = 1 AND p = 0) * 1.0 AS fn, count_if(y = 0 AND p = 0) * 1.0 AS tn FROM sc)
SELECT 'accuracy' AS metric, (tp + tn) / (tp + tn + fp + fn) AS value FROM c
UNION ALL SELECT 'precision', tp / nullif(tp + fp, 0) FROM c
UNION ALL SELECT 'recall', tp / nullif(tp + fn, 0) FROM c
UNION ALL SELECT 'f1', 2 * (tp / nullif(tp + fp, 0)) * (tp / nullif(tp + fn, 0))
                       / nullif(tp / nullif(tp + fp, 0) + tp / nullif(tp + fn, 0), 0) FROM c
UNION ALL SELECT 'auc', auc FROM au"""), ["value"], "I3 I2 W1")
def i3_classification_metrics(spark, sf):
    return model.classification_metrics(_scored(spark, sf))


@register("i4_classification_report", with_fixture(_SC_CTE + """,
c AS (SELECT count_if(y = 0 AND p = 0) * 1.0 AS c00, count_if(y = 0 AND p = 1) * 1.0 AS c01,
             count_if(y = 1 AND p = 0) * 1.0 AS c10, count_if(y = 1 AND p = 1) * 1.0 AS c11 FROM sc),
k AS (SELECT '0' AS class, c00 / nullif(c00 + c10, 0) AS pr, c00 / nullif(c00 + c01, 0) AS rc, c00 + c01 AS sup FROM c
      UNION ALL SELECT '1', c11 / nullif(c01 + c11, 0), c11 / nullif(c10 + c11, 0), c10 + c11 FROM c),
kf AS (SELECT class, pr, rc, 2 * pr * rc / nullif(pr + rc, 0) AS f1, sup FROM k)
SELECT class, pr AS "precision", rc AS recall, f1, CAST(sup AS BIGINT) AS support FROM kf
UNION ALL SELECT 'macro avg', avg(pr), avg(rc), avg(f1), CAST(sum(sup) AS BIGINT) FROM kf
UNION ALL SELECT 'weighted avg', sum(pr * sup) / sum(sup), sum(rc * sup) / sum(sup), sum(f1 * sup) / sum(sup),
                 CAST(sum(sup) AS BIGINT) FROM kf"""), ["precision", "recall", "f1"], "I4")
def i4_classification_report(spark, sf):
    return model.classification_report(_scored(spark, sf))


@register("i8_confusion_matrix", with_fixture(_SC_CTE + """
SELECT y AS label, p AS prediction, count(*) AS "count" FROM sc GROUP BY ALL"""), [], "I8")
def i8_confusion_matrix(spark, sf):
    return model.confusion_matrix(_scored(spark, sf))


_CURVE = _SC_CTE + """,
g AS (SELECT s, count_if(y = 1) AS pos, count_if(y = 0) AS neg FROM sc GROUP BY s),
cu AS (SELECT s, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp,
              sum(pos) OVER () AS pp, sum(neg) OVER () AS nn FROM g)"""


@register("i7_roc_points", with_fixture(_CURVE + """
SELECT s AS threshold, fp * 1.0 / nn AS fpr, tp * 1.0 / pp AS tpr FROM cu
UNION ALL SELECT CAST('Infinity' AS DOUBLE), 0.0, 0.0"""),
    ["threshold", "fpr", "tpr"], "I7")
def i7_roc_points(spark, sf):
    return model.roc_points(_scored(spark, sf))


@register("i9_pr_points", with_fixture(_CURVE + """
SELECT s AS threshold, tp * 1.0 / (tp + fp) AS "precision", tp * 1.0 / pp AS recall FROM cu
UNION ALL SELECT NULL, 1.0, 0.0"""),
    ["threshold", "precision", "recall"], "I9")
def i9_pr_points(spark, sf):
    return model.pr_points(_scored(spark, sf))


@register("k11_ks_statistic", with_fixture(_CURVE + """
SELECT max(abs(tp * 1.0 / pp - fp * 1.0 / nn)) AS ks FROM cu"""), ["ks"], "K11")
def k11_ks_statistic(spark, sf):
    return model.ks_statistic(_scored(spark, sf))


@register("k10_lift_table", with_fixture(_SC_CTE + """,
o AS (SELECT s, y, row_number() OVER (ORDER BY s DESC, CLIENT_ID DESC) - 1 AS pos, count(*) OVER () AS n,
             sum(y) OVER () AS pp FROM sc),
d AS (SELECT CAST(floor(pos * 10 / n) + 1 AS INTEGER) AS decile, s, y, n AS nt, pp FROM o),
a AS (SELECT decile, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, min(s) AS min_score,
             max(s) AS max_score, min(nt) AS nt, min(pp) AS pp FROM d GROUP BY decile)
SELECT decile, n, positives, positives * 1.0 / n AS rate, positives * 1.0 / n / (pp * 1.0 / nt) AS lift,
       sum(positives) OVER (ORDER BY decile) * 1.0 / pp AS cum_capture, min_score, max_score FROM a"""),
    ["rate", "lift", "cum_capture", "min_score", "max_score"], "K10")
def k10_lift_table(spark, sf):
    return model.lift_table(_scored(spark, sf), tiebreak="CLIENT_ID")


@register("i11_score_histogram", with_fixture(_SC_CTE + """,
r AS (SELECT CAST(y AS VARCHAR) AS class, min(s) AS lo, max(s) AS hi FROM sc GROUP BY 1),
h AS (SELECT r.class, lo, hi,
        CAST(CASE WHEN hi = lo THEN 0 ELSE least(floor((s - lo) * 50 / (hi - lo)), 49) END AS INTEGER) AS bin
      FROM sc JOIN r ON CAST(sc.y AS VARCHAR) = r.class),
g AS (SELECT class, lo, hi, CAST(unnest(range(CASE WHEN hi = lo THEN 1 ELSE 50 END)) AS INTEGER) AS bin FROM r)
SELECT g.class, g.bin, g.lo + g.bin * (g.hi - g.lo) / 50 AS "left", g.lo + (g.bin + 1) * (g.hi - g.lo) / 50 AS "right",
       count(h.bin) AS "count"
FROM g LEFT JOIN h ON g.class = h.class AND g.bin = h.bin GROUP BY g.class, g.bin, g.lo, g.hi"""), ["left", "right"], "I11 D21")
def i11_score_histogram(spark, sf):
    s = _scored(spark, sf).withColumn("label", F.col("label").cast("string"))
    return profile.histogram(s, "p1", bins=50, by="label")


# ------------------------------------------------------------ preparation

@register("g1_label_encoding", with_fixture("""
d AS (SELECT DISTINCT REGION FROM applications WHERE REGION IS NOT NULL),
c AS (SELECT REGION, CAST(row_number() OVER (ORDER BY REGION) - 1 AS DOUBLE) AS code FROM d),
m AS (SELECT count(*) AS k FROM d)
SELECT a.REGION, coalesce(c.code, CAST(m.k AS DOUBLE)) AS REGION_code, count(*) AS n
FROM applications a LEFT JOIN c ON a.REGION = c.REGION, m GROUP BY ALL"""), [], "G1")
def g1_label_encoding(spark, sf):
    df = applications(spark, sf).select("REGION")
    enc = prepare.label_encode(df.withColumn("REGION_code", F.col("REGION")), ["REGION_code"])
    return enc.groupBy("REGION", "REGION_code").agg(F.count(F.lit(1)).alias("n"))


@register("g3_stratified_split", with_fixture("""
c AS (SELECT TARGET, count(*) AS n FROM applications GROUP BY TARGET)
SELECT CAST(TARGET AS INTEGER) AS TARGET, 'test' AS side, CAST(round(n * 0.2) AS BIGINT) AS n FROM c
UNION ALL SELECT CAST(TARGET AS INTEGER), 'train', CAST(n - round(n * 0.2) AS BIGINT) FROM c"""), [], "G3")
def g3_stratified_split(spark, sf):
    df = applications(spark, sf).select("CLIENT_ID", F.col("TARGET").cast("int").alias("TARGET"))
    tr, te = prepare.stratified_split(df, "TARGET", "CLIENT_ID", 0.2, seed=42)
    return (tr.withColumn("side", F.lit("train")).unionByName(te.withColumn("side", F.lit("test")))
            .groupBy("TARGET", "side").agg(F.count(F.lit(1)).alias("n")))


@register("g4_standard_scaler", with_fixture(f"""
s AS (SELECT avg(LOAN_AMOUNT) AS m1, stddev_pop(LOAN_AMOUNT) AS s1, avg(INCOME_MONTHLY) AS m2,
             stddev_pop(INCOME_MONTHLY) AS s2 FROM applications WHERE DATE_MONTH < TIMESTAMP '{TRAIN_CUTOFF}')
SELECT CLIENT_ID, (LOAN_AMOUNT - m1) / s1 AS LOAN_AMOUNT, (INCOME_MONTHLY - m2) / s2 AS INCOME_MONTHLY
FROM applications, s WHERE DATE_MONTH >= TIMESTAMP '{TRAIN_CUTOFF}'"""), ["LOAN_AMOUNT", "INCOME_MONTHLY"], "G4 C1")
def g4_standard_scaler(spark, sf):
    """Scaler fitted on the train months, applied to the test months."""
    df = applications(spark, sf).select("CLIENT_ID", "DATE_MONTH", "LOAN_AMOUNT", "INCOME_MONTHLY")
    tr, te = clean.temporal_split(df, "DATE_MONTH", TRAIN_CUTOFF)
    st = prepare.fit_standard_scaler(tr, ["LOAN_AMOUNT", "INCOME_MONTHLY"])
    return prepare.apply_standard_scaler(te, st).select("CLIENT_ID", "LOAN_AMOUNT", "INCOME_MONTHLY")


@register("g7_class_weights", with_fixture("""
c AS (SELECT TARGET, count(*) AS n FROM applications GROUP BY TARGET)
SELECT CAST(TARGET AS INTEGER) AS TARGET, (SELECT sum(n) FROM c) * 1.0 / (2 * n) AS weight, n FROM c"""),
    ["weight"], "G7")
def g7_class_weights(spark, sf):
    df = prepare.class_weights(applications(spark, sf).select(F.col("TARGET").cast("int").alias("TARGET")),
                               "TARGET")
    return df.groupBy("TARGET", "weight").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ model

MODEL_FEATURES = ["LOAN_AMOUNT", "INCOME_MONTHLY", "N_ITEMS", "AVG_DISCOUNT", "AVG_TAX", "AVG_DAYS_TO_SHIP",
                  "PRICE_M1", "LOAN_TO_ANNUAL_INCOME", "TOTAL_TXN_30D", "HIGH_RISK_FLAG", "RISK_SCORE_CUSTOM"]
MODEL_CATS = ["PRIORITY", "SEGMENT", "REGION"]


def _model_frames(spark, sf):
    """Engineered credit view (QTY_TOTAL excluded: it defines the target),
    median-filled with statistics of the train months only."""
    df = credit_view(spark, sf)
    df = features.risk_features(features.behavioural_features(features.financial_features(df)))
    df = df.fillna({"REGION": "INCONNU"})
    tr, te = clean.temporal_split(df, "DATE_MONTH", TRAIN_CUTOFF)
    from riskframe.operators import impute
    fill = impute.fit_numeric(tr, MODEL_FEATURES, "median")
    return impute.apply_fill(tr, fill), impute.apply_fill(te, fill)


@register("i1_logistic_coefficients", None, [], "I1 G1 G4 G7 G8 I10")
def i1_logistic_coefficients(spark, sf):
    tr, _ = _model_frames(spark, sf)
    m = model.fit_logistic(tr, MODEL_FEATURES + MODEL_CATS, "TARGET", MODEL_CATS)
    return model.top_importance(model.coefficients(m), 15)


@register("i2_i6_model_evaluation", None, [], "I2 I3 I6 I12")
def i2_i6_model_evaluation(spark, sf):
    """Train on the train months, score both sides: metrics, Gini, bands."""
    tr, te = _model_frames(spark, sf)
    m = model.fit_logistic(tr, MODEL_FEATURES + MODEL_CATS, "TARGET", MODEL_CATS)
    s_te = model.score(m, te).withColumn("label", F.col("TARGET").cast("int"))
    s_tr = model.score(m, tr).withColumn("label", F.col("TARGET").cast("int"))
    met = {r["metric"]: r["value"] for r in model.classification_metrics(s_te).collect()}
    auc_tr = model.classification_metrics(s_tr).filter("metric = 'auc'").first()["value"]
    g = model.gini_report(auc_tr, met["auc"])
    met.update({k: v for k, v in g.items() if isinstance(v, float)})
    rec = model.metric_record(met, spark)
    return rec.withColumn("note", F.lit(f"overfit={g['overfit']} quality={g['quality']}")).drop("recorded_at")


@register("i1_g5_smote_logistic", None, [], "G4 G5 G7 I1 I2 I3")
def i1_g5_smote_logistic(spark, sf):
    """The original's training flow: scale (fit on train) -> SMOTE the
    training vectors -> L2 logistic regression -> metrics on the test months,
    plus the class sizes seen by the fit."""
    tr, te = _model_frames(spark, sf)
    st, lr = model.fit_logistic_smote(tr, MODEL_FEATURES, "TARGET", "CLIENT_ID")
    scored = model.score_scaled(lr, st, te, MODEL_FEATURES, "TARGET")
    return model.classification_metrics(scored)


@register("i5_fold_sizes", with_fixture("""
c AS (SELECT CAST(TARGET AS INTEGER) AS TARGET, count(*) AS n FROM applications GROUP BY TARGET),
f AS (SELECT TARGET, n, CAST(unnest(range(5)) AS INTEGER) AS fold FROM c)
SELECT TARGET, fold, CAST((n - fold + 4) // 5 AS BIGINT) AS n FROM f WHERE n > fold"""), [], "I5")
def i5_fold_sizes(spark, sf):
    """Rows per class and fold: positions in a class are dealt in turn."""
    df = applications(spark, sf).select("CLIENT_ID", F.col("TARGET").cast("int").alias("TARGET"))
    return model.fold_column(df, "TARGET", "CLIENT_ID", 5).groupBy("TARGET", "fold").agg(F.count(F.lit(1)).alias("n"))


@register("i6_i12_gini_record", with_fixture(f"""
sc AS (SELECT DATE_MONTH >= TIMESTAMP '{TRAIN_CUTOFF}' AS late, {SCORE_SQL} AS s, CAST(TARGET AS INTEGER) AS y FROM applications),
rk AS (SELECT late, y, rank() OVER (PARTITION BY late ORDER BY s) + (count(*) OVER (PARTITION BY late, s) - 1) / 2.0 AS ar FROM sc),
au AS (SELECT late, (sum(CASE WHEN y = 1 THEN ar END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0)
              / (count_if(y = 1) * 1.0 * count_if(y = 0)) AS auc FROM rk GROUP BY late),
g AS (SELECT 2 * max(CASE WHEN NOT late THEN auc END) - 1 AS a, 2 * max(CASE WHEN late THEN auc END) - 1 AS b FROM au),
n AS (SELECT a, b, a - b AS d, CASE WHEN a - b > 0.15 THEN 'strong' WHEN a - b > 0.05 THEN 'mild' ELSE 'none' END AS overfit,
             CASE WHEN b >= 0.6 THEN 'good' WHEN b >= 0.4 THEN 'acceptable' ELSE 'weak' END AS quality FROM g)
SELECT 'gini_train' AS metric, a AS value, overfit, quality, true AS recorded FROM n
UNION ALL SELECT 'gini_test', b, overfit, quality, true FROM n
UNION ALL SELECT 'gap', d, overfit, quality, true FROM n"""), ["value"], "I6 I12")
def i6_i12_gini_record(spark, sf):
    """Gini on both sides of the cut for the fixed score, gap, bands and record."""
    from riskframe.operators import stats
    df = applications(spark, sf).select("DATE_MONTH", F.col("TARGET").cast("int").alias("label"), F.expr(SCORE_SQL).alias("p1"))
    tr, te = clean.temporal_split(df, "DATE_MONTH", TRAIN_CUTOFF)
    g = model.gini_report(*[stats.auc(side, "p1", "label").first()["auc"] for side in (tr, te)])
    return model.metric_record(g, spark).select(
        "metric", "value", F.lit(g["overfit"]).alias("overfit"), F.lit(g["quality"]).alias("quality"),
        F.col("recorded_at").isNotNull().alias("recorded"))


@register("a6_model_roundtrip", with_fixture(f"""
SELECT count(*) AS n, CASE WHEN count(*) > 0 THEN CAST(0 AS DOUBLE) END AS max_abs_diff
FROM applications WHERE DATE_MONTH >= TIMESTAMP '{TRAIN_CUTOFF}'"""), ["max_abs_diff"], "A6 A3")
def a6_model_roundtrip(spark, sf):
    """Save the whole pipeline, load it back, score again: identical."""
    tr, te = _model_frames(spark, sf)
    m = model.fit_logistic(tr, MODEL_FEATURES + MODEL_CATS, "TARGET", MODEL_CATS)
    path = ensure_checkpoint_dir(spark).rstrip("/") + f"/riskframe-model-{uuid.uuid4().hex}"
    model.save_model(m, path)
    m2 = model.load_model(path)
    a = model.score(m, te).select("CLIENT_ID", F.col("p1").alias("p_saved"))
    b = model.score(m2, te).select("CLIENT_ID", F.col("p1").alias("p_loaded"))
    return a.join(b, "CLIENT_ID").agg(F.count(F.lit(1)).alias("n"),
                                     F.max(F.abs(F.col("p_saved") - F.col("p_loaded"))).alias("max_abs_diff"))


@register("k8_k9_tree_models", None, [], "K8 K9 K6")
def k8_k9_tree_models(spark, sf):
    """Decision tree, random forest and boosted trees: test AUC of each and
    the forest's importance-based selection."""
    tr, te = _model_frames(spark, sf)
    rows = []
    for kind, params in (("decision_tree", {"maxDepth": 5}), ("random_forest", {"numTrees": 30, "maxDepth": 6}),
                         ("gbt", {"maxIter": 20, "maxDepth": 4})):
        m = model.fit_tree_model(tr, MODEL_FEATURES, "TARGET", kind, **params)
        s = model.score(m, te).withColumn("label", F.col("TARGET").cast("int"))
        rows.append((kind, model.classification_metrics(s).filter("metric = 'auc'").first()["value"]))
    out = spark.createDataFrame(rows, "model string, auc double")
    return out


@register("k6_importance_selection", None, [], "K6")
def k6_importance_selection(spark, sf):
    tr, _ = _model_frames(spark, sf)
    m = model.fit_tree_model(tr, MODEL_FEATURES, "TARGET", "random_forest", numTrees=30, maxDepth=6)
    return model.importance_selection(m, MODEL_FEATURES, 0.01)


# ------------------------------------------------------------- encoders (K1-K4)

_ONE_HOT = ["SEGMENT", "REGION"]


@register("k1_one_hot", with_fixture(",\n".join(f"""
d{i} AS (SELECT {c} AS value, row_number() OVER (ORDER BY {c}) - 1 AS slot
         FROM (SELECT DISTINCT {c} FROM applications WHERE {c} IS NOT NULL))""" for i, c in enumerate(_ONE_HOT)) + "\n" + "\nUNION ALL ".join(f"""
SELECT '{c}' AS "column", a.{c} AS value, CAST(coalesce(d{i}.slot, (SELECT count(*) FROM d{i})) AS INTEGER) AS slot,
       1 AS slots_set, count(*) AS n
FROM applications a LEFT JOIN d{i} ON a.{c} = d{i}.value GROUP BY ALL""" for i, c in enumerate(_ONE_HOT))), [], "K1")
def k1_one_hot(spark, sf):
    """One-hot vectors of two columns, one of them with missing cells: the slot
    that each value sets, how many slots are set, and the rows that have it."""
    from pyspark.ml.functions import vector_to_array

    from riskframe.operators.encoders import one_hot
    df = applications(spark, sf).select(*_ONE_HOT)
    out = one_hot(_ONE_HOT).fit(df).transform(df)
    cells = out.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value"), vector_to_array(f"{c}_ohe").alias("x"))
        for c in _ONE_HOT])).alias("r")).select("r.*")
    slot = (F.array_position("x", F.lit(1.0)) - 1).cast("int").alias("slot")
    return (cells.groupBy("column", "value", slot, F.size(F.filter("x", lambda v: v != 0)).alias("slots_set"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("k2_target_encoding", with_fixture("""
g AS (SELECT NATION, count(*) AS n, avg(TARGET) AS m FROM applications WHERE NATION IS NOT NULL GROUP BY NATION),
p AS (SELECT avg(TARGET) AS pm FROM applications)
SELECT NATION, n, (n * m + 20 * pm) / (n + 20) AS encoding FROM g, p"""), ["encoding"], "K2")
def k2_target_encoding(spark, sf):
    from riskframe.operators.encoders import target_encoding_table
    return target_encoding_table(applications(spark, sf), "NATION", "TARGET", smoothing=20.0)


@register("k2_target_encoding_out_of_fold", with_fixture("""
b AS (SELECT NATION, CAST(CLIENT_ID % 5 AS INTEGER) AS fold, TARGET AS y FROM applications),
p AS (SELECT avg(y) AS pm FROM b),
f AS (SELECT NATION, fold, count(*) AS nf, sum(y) AS sf FROM b GROUP BY ALL),
t AS (SELECT NATION, sum(nf) AS nt, sum(sf) AS st FROM f GROUP BY NATION)
SELECT f.NATION, f.fold, CASE WHEN f.NATION IS NULL THEN pm ELSE (st - sf + 20 * pm) / (nt - nf + 20) END AS NATION_te,
       CAST(nf AS BIGINT) AS n
FROM f JOIN t ON f.NATION IS NOT DISTINCT FROM t.NATION, p"""), ["NATION_te"], "K2")
def k2_target_encoding_out_of_fold(spark, sf):
    """Rows encoded from the other folds only; one row per value and fold."""
    from riskframe.operators.encoders import target_encode
    df = applications(spark, sf).select("NATION", "TARGET", (F.col("CLIENT_ID") % 5).cast("int").alias("fold"))
    return (target_encode(df, "NATION", "TARGET", smoothing=20.0, fold_col="fold")
            .groupBy("NATION", "fold", "NATION_te").agg(F.count(F.lit(1)).alias("n")))


@register("k3_ordinal_encoding", with_fixture("""
SELECT PRIORITY, CAST(CAST(substr(PRIORITY, 1, 1) AS INTEGER) - 1 AS INTEGER) AS PRIORITY_ord, count(*) AS n
FROM applications GROUP BY ALL"""), [], "K3")
def k3_ordinal_encoding(spark, sf):
    from riskframe.operators.encoders import ordinal_encode
    order = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    df = ordinal_encode(applications(spark, sf).select("PRIORITY"), "PRIORITY", order)
    return df.groupBy("PRIORITY", "PRIORITY_ord").agg(F.count(F.lit(1)).alias("n"))


@register("k4_time_aggregations", with_fixture("""
m AS (SELECT CUSTOMER_ID, CAST(DATE_MONTH AS DATE) AS month, count(*) AS n, sum(LOAN_AMOUNT) AS amount
      FROM applications GROUP BY ALL)
SELECT CUSTOMER_ID, month, n, amount,
       sum(amount) OVER (PARTITION BY CUSTOMER_ID ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS amount_3,
       CAST(sum(n) OVER (PARTITION BY CUSTOMER_ID ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS n_cum
FROM m"""), ["amount", "amount_3"], "K4")
def k4_time_aggregations(spark, sf):
    from riskframe.operators.encoders import time_aggregations
    return time_aggregations(applications(spark, sf), "CUSTOMER_ID", "DATE_MONTH", "LOAN_AMOUNT")


# -------------------------------------------------------------- neighbours

@register("g6_knn_embeddings", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT a.vec_id AS qid, b.vec_id AS nid, list_distance(a.v, b.v) AS dist
      FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id),
r AS (SELECT qid, nid, dist, row_number() OVER (PARTITION BY qid ORDER BY dist, nid) AS rank FROM d)
SELECT qid, nid, dist, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""", ["dist"], "G6")
def g6_knn_embeddings(spark, sf):
    """5 nearest neighbours of every embedding within its label."""
    e = read_table(spark, sf, "embeddings")
    return neighbours.knn(e, e, "vec_id", "embedding", k=5, same="label").select(
        "qid", "nid", "dist", F.col("rank").cast("int").alias("rank"))


@register("g5_smote_class_counts", """
WITH c AS (SELECT CASE WHEN label = 0 THEN 1 ELSE 0 END AS y, count(*) AS n FROM embeddings GROUP BY 1)
SELECT y, (SELECT max(n) FROM c) AS n FROM c""", [], "G5")
def g5_smote_class_counts(spark, sf):
    """SMOTE on 'label = 0' vs the rest: both classes end at the majority size."""
    e = read_table(spark, sf, "embeddings").withColumn("y", (F.col("label") == 0).cast("int"))
    out = neighbours.smote(e, "vec_id", "embedding", "y", k=5, seed=42)
    return out.groupBy("y").agg(F.count(F.lit(1)).alias("n"))


@register("g5_smote_rows", None, [], "G5")
def g5_smote_rows(spark, sf):
    e = read_table(spark, sf, "embeddings").withColumn("y", (F.col("label") == 0).cast("int"))
    return neighbours.smote(e, "vec_id", "embedding", "y", k=5, seed=42)


_SPACE = ["LOAN_AMOUNT / 1000.0", "INCOME_MONTHLY / 100.0", "N_ITEMS * 1.0", "AVG_DAYS_TO_SHIP * 1.0", "PRICE_M1 / 1000.0"]
_SPACE_SQL = f"""x AS (SELECT * FROM (SELECT CLIENT_ID AS id, CAST(TARGET AS INTEGER) AS y, {', '.join(f'{e} AS x{i}' for i, e in enumerate(_SPACE))}
                  FROM applications) q WHERE {' AND '.join(f'x{i} IS NOT NULL' for i in range(len(_SPACE)))}),
cl AS (SELECT y, count(*) AS n FROM x GROUP BY y),
t AS (SELECT y AS minor, n AS n_min, (SELECT max(n) FROM cl) - n AS deficit FROM cl ORDER BY n, y LIMIT 1),
m AS (SELECT x.* FROM x JOIN t ON x.y = t.minor),
nn AS (SELECT * FROM (SELECT a.id AS qid, b.id AS nid, sqrt({' + '.join(f'(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})' for i in range(len(_SPACE)))}) AS dist,
              row_number() OVER (PARTITION BY a.id ORDER BY sqrt({' + '.join(f'(a.x{i} - b.x{i}) * (a.x{i} - b.x{i})' for i in range(len(_SPACE)))}), b.id) AS rank
       FROM m a JOIN m b ON a.id <> b.id) q WHERE rank <= 5)"""


def _space(spark, sf):
    """Applicants as points of five features, in units of comparable size."""
    df = applications(spark, sf).select(F.col("CLIENT_ID").alias("id"), F.col("TARGET").cast("int").alias("y"),
                                        F.array(*[F.expr(e).cast("double") for e in _SPACE]).alias("v"))
    return df.where(F.forall("v", lambda c: c.isNotNull()))


@register("g6_knn_applicants", with_fixture(_SPACE_SQL + """
SELECT qid, nid, dist, CAST(rank AS INTEGER) AS rank FROM nn"""), ["dist"], "G6")
def g6_knn_applicants(spark, sf):
    """5 nearest neighbours of every row of the smaller class, within the class."""
    df = _space(spark, sf)
    minor = df.groupBy("y").count().orderBy("count", "y").first()["y"]
    rows = df.where(F.col("y") == minor)
    return neighbours.knn(rows, rows, "id", "v", k=5).select("qid", "nid", "dist", F.col("rank").cast("int").alias("rank"))


_DRAW = "CAST('0x' || substr(md5(concat_ws(':', {})), 1, 15) AS BIGINT)"


@register("g5_smote_applicants", with_fixture(_SPACE_SQL + f""",
pos AS (SELECT m.*, row_number() OVER (ORDER BY {_DRAW.format("id, 42")}) - 1 AS pos FROM m),
cp AS (SELECT pos.*, t.deficit // t.n_min AS q, t.deficit // t.n_min + CASE WHEN pos < t.deficit % t.n_min THEN 1 ELSE 0 END AS c FROM pos, t),
j AS (SELECT *, unnest(range(1, c + 1)) AS j FROM cp),
dr AS (SELECT *, {_DRAW.format("id, j, 42")} % 5 + 1 AS nr, ({_DRAW.format("id, j, 43")} % 1073741824) / 1073741824.0 AS u FROM j)
SELECT id, y, false AS synthetic, {', '.join(f'x{i}' for i in range(len(_SPACE)))} FROM x
UNION ALL
SELECT -(dr.pos * (dr.q + 1) + dr.j), dr.y, true, {', '.join(f'dr.x{i} + dr.u * (b.x{i} - dr.x{i})' for i in range(len(_SPACE)))}
FROM dr JOIN nn ON nn.qid = dr.id AND nn.rank = dr.nr JOIN m b ON b.id = nn.nid"""), [f"x{i}" for i in range(len(_SPACE))], "G5 G6")
def g5_smote_applicants(spark, sf):
    """All rows of SMOTE over the applicants' features, original and synthetic."""
    out = neighbours.smote(_space(spark, sf), "id", "v", "y", k=5, seed=42)
    return out.select("id", "y", "synthetic", *[F.col("v")[i].alias(f"x{i}") for i in range(len(_SPACE))])


_E3 = ["LOAN_AMOUNT", "INCOME_MONTHLY", "PRICE_M1", "PRICE_M2", "PRICE_M3"]


def _e3_sql():
    cols = ", ".join(_E3)
    present = " + ".join(f"CAST(a.{c} IS NOT NULL AND b.{c} IS NOT NULL AS INTEGER)" for c in _E3)
    sq = " + ".join(f"coalesce((a.{c} - b.{c}) * (a.{c} - b.{c}), 0)" for c in _E3)
    unions = " UNION ALL ".join(
        f"SELECT qid, '{c}' AS col, b_{c} AS val, dist, nid FROM d WHERE a_{c} IS NULL AND b_{c} IS NOT NULL"
        for c in _E3)
    sel_b = ", ".join(f"b.{c} AS b_{c}, a.{c} AS a_{c}" for c in _E3)
    fills = ", ".join(
        f"coalesce(x.{c}, (SELECT avg(val) FROM top WHERE top.qid = x.CLIENT_ID AND col = '{c}'), "
        f"(SELECT avg({c}) FROM x)) AS {c}" for c in _E3)
    return with_fixture(f"""x AS (SELECT CLIENT_ID, {cols} FROM applications),
q AS (SELECT * FROM x WHERE {' OR '.join(f'{c} IS NULL' for c in _E3)}),
d AS (SELECT a.CLIENT_ID AS qid, b.CLIENT_ID AS nid, {sel_b},
             sqrt({len(_E3)} * 1.0 / ({present}) * ({sq})) AS dist
      FROM q a JOIN x b ON a.CLIENT_ID <> b.CLIENT_ID WHERE ({present}) > 0),
c AS ({unions}),
top AS (SELECT qid, col, val FROM (SELECT *, row_number() OVER (PARTITION BY qid, col ORDER BY dist, nid) AS r
        FROM c) WHERE r <= 5)
SELECT x.CLIENT_ID, {fills} FROM x""")


@register("e3_knn_impute", _e3_sql(), _E3, "E3")
def e3_knn_impute(spark, sf):
    df = applications(spark, sf).select("CLIENT_ID", *_E3)
    return neighbours.knn_impute(df, "CLIENT_ID", _E3, k=5)
