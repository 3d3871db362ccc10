"""Scoring model and evaluation.

The fitted state is one ``PipelineModel``: label encoders (StringIndexer),
the population-std scaler as a ``SQLTransformer`` holding its fitted
constants, the ``VectorAssembler`` and the classifier -- saved and loaded
as one unit. Training is MLlib (distributed L-BFGS / tree learners);
evaluation uses the exact rank primitive, not binned curves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.operators import cuts, newton, prepare, ranks, stats
from riskframe.session import written


def scaler_stage(stats_: dict, fill: dict | None = None) -> SQLTransformer:
    """G4 as a persistable stage: (x - mean) / std with fitted constants, after
    the fitted ``fill`` value of the column, if it has one."""
    exprs = []
    for c, (mu, sd) in stats_.items():
        sd = sd if sd not in (None, 0.0) else 1.0
        x = f"CAST(`{c}` AS DOUBLE)"
        if fill and fill.get(c) is not None:
            x = f"coalesce({x}, {float(fill[c])!r}D)"
        exprs.append(f"({x} - ({mu!r})) / ({sd!r}) AS `{c}__z`")
    return SQLTransformer(statement="SELECT *, " + ", ".join(exprs) + " FROM __THIS__")


def fit_logistic(train: DataFrame, features: Sequence[str], target: str = "TARGET",
                 categorical: Sequence[str] = (), C: float = 1.0, balanced: bool = True,
                 max_iter: int = 1000, weight_col: str | None = None) -> PipelineModel:
    """L2 logistic regression, C = 1, balanced class weights, L-BFGS.

    The sklearn objective C * sum(w * loss) + |b|^2 / 2 equals MLlib's
    mean-loss objective with regParam = 1 / (C * sum(w)) and no internal
    standardisation (the scaler stage already did it).
    """
    cats = list(categorical)
    nums = [f for f in features if f not in cats]
    enc = prepare.label_encoder(cats)
    enc_model = Pipeline(stages=enc).fit(train) if enc else None
    encoded = enc_model.transform(train) if enc_model else train
    scale_cols = nums + [f"{c}_idx" for c in cats]
    sc = scaler_stage(prepare.fit_standard_scaler(encoded, scale_cols))
    asm = prepare.assembler([f"{c}__z" for c in scale_cols])
    label = SQLTransformer(statement=f"SELECT *, CAST(`{target}` AS DOUBLE) AS _label FROM __THIS__")
    stages = ([enc_model] if enc_model else []) + [sc, asm, label]
    fit_df = PipelineModel(stages=stages).transform(train)
    wcol = weight_col
    if wcol is None and balanced:
        fit_df, wcol = prepare.class_weights(fit_df, target, "_w"), "_w"
    sum_w = fit_df.agg(F.sum(F.col(wcol)) if wcol else F.count(F.lit(1))).first()[0]
    lr = LogisticRegression(featuresCol="features", labelCol="_label", weightCol=wcol,
                            regParam=1.0 / (C * sum_w), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter, tol=1e-10, family="binomial")
    return PipelineModel(stages=stages + [lr.fit(fit_df)])


def fit_tree_model(train: DataFrame, features: Sequence[str], target: str = "TARGET",
                   kind: str = "random_forest", seed: int = 42, **params) -> PipelineModel:
    """K8/K9: decision tree, random forest or gradient-boosted trees."""
    asm = prepare.assembler(list(features))
    label = SQLTransformer(statement=f"SELECT *, CAST(`{target}` AS DOUBLE) AS _label FROM __THIS__")
    cls = {"decision_tree": DecisionTreeClassifier, "random_forest": RandomForestClassifier,
           "gbt": GBTClassifier}[kind]
    est = cls(featuresCol="features", labelCol="_label", seed=seed, **params)
    return Pipeline(stages=[asm, label, est]).fit(train)


def score(model: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Probability of class 1 and the 0/1 decision at ``threshold``."""
    out = model.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    return out.withColumn("p1", p).withColumn("pred", (F.col("p1") >= threshold).cast("int"))


def coefficients(model: PipelineModel) -> DataFrame:
    """Feature, coefficient, importance (|coefficient|)."""
    lr = model.stages[-1]
    asm = [s for s in model.stages if s.__class__.__name__ == "VectorAssembler"][0]
    names = [c[:-3] if c.endswith("__z") else c for c in asm.getInputCols()]
    rows = [(n, float(v), abs(float(v))) for n, v in zip(names, lr.coefficients.toArray())]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, coefficient double, importance double")


def top_importance(coefs: DataFrame, k: int = 15) -> DataFrame:
    """Top-k by |coefficient| (tie -> name)."""
    return coefs.orderBy(F.col("importance").desc(), F.col("feature")).limit(k)


# ------------------------------------------------------------- evaluation

def classification_metrics(scored: DataFrame, label: str = "label", pred: str = "pred",
                           score_col: str = "p1") -> DataFrame:
    """Accuracy, precision, recall, f1 (positive class 1) and exact AUC,
    as (metric, value) rows. Counts in one aggregate."""
    y, p = F.col(label).cast("int"), F.col(pred).cast("int")
    c = scored.agg(F.count_if((y == 1) & (p == 1)).alias("tp"), F.count_if((y == 0) & (p == 1)).alias("fp"),
                   F.count_if((y == 1) & (p == 0)).alias("fn"), F.count_if((y == 0) & (p == 0)).alias("tn"))
    tp, fp, fn, tn = [F.col(x).cast("double") for x in ("tp", "fp", "fn", "tn")]
    prec = F.try_divide(tp, tp + fp)
    rec = F.try_divide(tp, tp + fn)
    a = stats.auc(scored, score_col, label)
    m = c.select((tp + tn) / (tp + tn + fp + fn), prec, rec, F.try_divide(2 * prec * rec, prec + rec)) \
        .toDF("accuracy", "precision", "recall", "f1")
    aucv = a.first()  # one number, inlined below
    return m.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), F.col(k).alias("value")) for k in m.columns]
        + [F.struct(F.lit("auc").alias("metric"), F.lit(aucv["auc"]).cast("double").alias("value"))]
    )).alias("r")).select("r.*")


def confusion_matrix(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """I8: (label, prediction, count)."""
    return scored.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("count"))


def classification_report(scored: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """I4: per class precision/recall/f1/support, macro and weighted avg."""
    cm = confusion_matrix(scored, label, pred)
    per = cm.groupBy().agg(*[F.sum(F.when((F.col("label") == a) & (F.col("prediction") == b), F.col("count"))
                                   .otherwise(0)).alias(f"c{a}{b}") for a in (0, 1) for b in (0, 1)])
    rows = []
    for k in (0, 1):
        tpk = F.col(f"c{k}{k}").cast("double")
        predk = (F.col(f"c0{k}") + F.col(f"c1{k}")).cast("double")
        truek = (F.col(f"c{k}0") + F.col(f"c{k}1")).cast("double")
        pr, rc = F.try_divide(tpk, predk), F.try_divide(tpk, truek)
        rows.append((str(k), pr, rc, F.try_divide(2 * pr * rc, pr + rc), truek))
    tot = rows[0][4] + rows[1][4]
    macro = [(rows[0][i] + rows[1][i]) / 2 for i in (1, 2, 3)]
    weighted = [(rows[0][i] * rows[0][4] + rows[1][i] * rows[1][4]) / tot for i in (1, 2, 3)]
    structs = [F.struct(F.lit(n).alias("class"), a.alias("precision"), b.alias("recall"), c.alias("f1"),
                        s.cast("long").alias("support")) for n, a, b, c, s in rows]
    structs.append(F.struct(F.lit("macro avg").alias("class"), macro[0].alias("precision"),
                            macro[1].alias("recall"), macro[2].alias("f1"), tot.cast("long").alias("support")))
    structs.append(F.struct(F.lit("weighted avg").alias("class"), weighted[0].alias("precision"),
                            weighted[1].alias("recall"), weighted[2].alias("f1"), tot.cast("long").alias("support")))
    return per.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def curve_table(scored: DataFrame, score_col: str = "p1", label: str = "label") -> DataFrame:
    """I7/I9 base: per distinct score (descending) the cumulative positives
    and negatives at or above it, plus totals. Cumulative sums come from
    the distributed range-partitioned primitive."""
    y = F.col(label).cast("int")
    g = scored.groupBy(F.lit("s").alias("variable"), F.col(score_col).cast("double").alias("value")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    cum = ranks.cumulative(g, ("variable",), "value", ("pos", "neg"), ascending=False)
    tot = cum.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()  # from the checkpointed counts
    return cum.select(F.col("value").alias("threshold"),
                      (F.col("pos_before") + F.col("pos")).alias("tp"),
                      (F.col("neg_before") + F.col("neg")).alias("fp"),
                      F.lit(tot["P"]).alias("P"), F.lit(tot["N"]).alias("N"))


def roc_points(scored: DataFrame, score_col: str = "p1", label: str = "label") -> DataFrame:
    """Threshold, fpr, tpr (every distinct score), from the (0, 0) point at
    an infinite threshold on. Rates of an absent class are null."""
    t = curve_table(scored, score_col, label)
    pts = t.select("threshold", F.try_divide(F.col("fp").cast("double"), F.col("N")).alias("fpr"),
                   F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("tpr"))
    start = scored.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def pr_points(scored: DataFrame, score_col: str = "p1", label: str = "label") -> DataFrame:
    """Threshold, precision, recall, and the end point (precision 1, recall 0)
    that has no threshold."""
    t = curve_table(scored, score_col, label)
    pts = t.select("threshold", F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fp")).alias("precision"),
                   F.try_divide(F.col("tp").cast("double"), F.col("P")).alias("recall"))
    end = scored.sparkSession.createDataFrame([(None, 1.0, 0.0)], "threshold double, precision double, recall double")
    return pts.unionByName(end)


def ks_statistic(scored: DataFrame, score_col: str = "p1", label: str = "label") -> DataFrame:
    """Max over thresholds of |TPR - FPR|."""
    t = curve_table(scored, score_col, label)
    return t.agg(F.max(F.abs(F.try_divide(F.col("tp").cast("double"), F.col("P"))
                             - F.try_divide(F.col("fp").cast("double"), F.col("N")))).alias("ks"))


def lift_table(scored: DataFrame, score_col: str = "p1", label: str = "label", bins: int = 10,
               tiebreak: str | None = None) -> DataFrame:
    """Deciles by descending score (row position from the cumulative
    primitive; ties broken by ``tiebreak`` descending, else a row hash),
    with rate, lift and cumulative capture of positives."""
    y = F.col(label).cast("int")
    tb = F.col(tiebreak).cast("long") if tiebreak else F.xxhash64(*[F.col(c) for c in scored.columns])
    base = scored.select(F.col(score_col).cast("double").alias("_s"), y.alias("_y"), tb.alias("_h"))
    keyed = base.withColumn("value", F.struct(F.col("_s"), F.col("_h"))).withColumn("variable", F.lit("s")) \
        .withColumn("_one", F.lit(1))
    pos = ranks.cumulative(keyed, ("variable",), "value", ("_one",), ascending=False)
    tot = base.agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("p")).first()
    n, p = tot["n"], tot["p"]
    dec = pos.withColumn("decile", (F.floor(F.col("_one_before") * bins / n) + 1).cast("int"))
    agg = dec.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("positives"),
                                    F.min("_s").alias("min_score"), F.max("_s").alias("max_score"))
    w = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # <= bins rows
    return agg.select("decile", "n", F.col("positives").cast("long").alias("positives"),
                      (F.col("positives") / F.col("n")).alias("rate"),
                      (F.col("positives") / F.col("n") / F.lit(p / n)).alias("lift"),
                      (F.sum("positives").over(w) / F.lit(p)).alias("cum_capture"),
                      "min_score", "max_score")


def gini_report(auc_train: float, auc_test: float) -> dict:
    """Gini train/test, the gap and the quality bands."""
    g_tr, g_te = 2 * auc_train - 1, 2 * auc_test - 1
    gap = g_tr - g_te
    over = "strong" if gap > 0.15 else ("mild" if gap > 0.05 else "none")
    quality = "good" if g_te >= 0.60 else ("acceptable" if g_te >= 0.40 else "weak")
    return {"gini_train": g_tr, "gini_test": g_te, "gap": gap, "overfit": over, "quality": quality}


def fold_column(df: DataFrame, target: str, key: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Stratified folds. Each class, ordered by 60 bits of md5(key, seed), is
    cut into k runs of equal size (the larger first) at the k - 1 keys that
    ``cuts.cut_points`` finds; rows are not moved. Rows of one key share a fold."""
    draw = cuts.hash_key(key, seed)
    ends = cuts.cut_points(df, target, draw, {c: cuts.deal_sizes(n, k) for c, n in cuts.class_sizes(df, target).items()})
    return df.withColumn(out, cuts.side_of(target, draw, ends).cast("int"))


def cross_validated_auc(df: DataFrame, features: Sequence[str], target: str, key: str, k: int = 5,
                        categorical: Sequence[str] = (), seed: int = 42) -> DataFrame:
    """Fold, auc; plus mean (-1) and 2 x population std (-2) rows. The k models
    are fitted together (``newton.fit_many``), each scaled and weighted by its own
    training rows. Categorical columns get their label codes from all of ``df``."""
    folded = fold_column(df, target, key, k, seed)
    if categorical:
        folded = prepare.label_encode(folded, list(categorical))
    feats = list(features) + [c for c in categorical if c not in features]
    rows = newton.out_of_fold_auc(folded, feats, target, "fold", k).select("fold", "auc").collect()   # k rows
    out = df.sparkSession.createDataFrame(rows, "fold int, auc double")
    return out.unionByName(out.agg(F.lit(-1).alias("fold"), F.avg("auc").alias("auc"))).unionByName(
        out.agg(F.lit(-2).alias("fold"), (F.stddev_pop("auc") * 2).alias("auc")))


def metric_record(metrics: dict, spark) -> DataFrame:
    """One row per named metric with a UTC timestamp."""
    rows = [(k, float(v)) for k, v in metrics.items() if isinstance(v, (int, float))]
    return spark.createDataFrame(rows, "metric string, value double").withColumn(
        "recorded_at", F.current_timestamp())


def save_model(model: PipelineModel, path: str) -> None:
    """The whole bundle (encoders, scaler, assembler, model) as one."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """A6."""
    return PipelineModel.load(path)


def recursive_elimination(train: DataFrame, features: Sequence[str], target: str, keep: int) -> list[str]:
    """K7: the ``keep`` features left when the smallest |coefficient| goes, round by
    round (``newton.eliminate`` also tells the rounds)."""
    left = newton.eliminate(train, features, target, keep).filter("dropped_at IS NULL")
    return [r["feature"] for r in left.collect()]


def importance_selection(model: PipelineModel, features: Sequence[str], threshold: float = 0.01) -> DataFrame:
    """K6: tree feature importances; keep those above ``threshold``."""
    imp = model.stages[-1].featureImportances.toArray()
    rows = [(f, float(v), bool(v > threshold)) for f, v in zip(features, imp)]
    return SparkSession.getActiveSession().createDataFrame(rows, "feature string, importance double, kept boolean")


def fit_logistic_smote(train: DataFrame, features: Sequence[str], target: str, key: str,
                       k: int = 5, seed: int = 42, C: float = 1.0, max_iter: int = 1000):
    """I1 after G4 and G5, as the original trains: scaler fitted on train,
    SMOTE on the scaled training vectors, then L2 logistic regression whose
    balanced weights are all 1 once the classes are equal (regParam uses the
    resampled weight sum). Returns (scaler stats, fitted LogisticRegressionModel)."""
    from pyspark.ml.functions import array_to_vector

    from riskframe.operators.neighbours import smote
    st = prepare.fit_standard_scaler(train, features)
    scaled = prepare.apply_standard_scaler(train, st).select(
        key, F.col(target).cast("int").alias(target), F.array(*[F.col(f) for f in features]).alias("_x"))
    bal = smote(scaled, key, "_x", target, k=k, seed=seed)
    # read again by every pass of the fit: the neighbours are searched once; real rows are a narrow scan of ``train``
    made = written(bal.where("synthetic").select("_x", target), "smote")
    bal = bal.where(~F.col("synthetic")).select("_x", target).unionByName(made)
    fit_df = prepare.class_weights(bal, target, "_w").select(
        array_to_vector("_x").alias("features"), F.col(target).cast("double").alias("_label"), "_w")
    sum_w = fit_df.agg(F.sum("_w")).first()[0]
    lr = LogisticRegression(featuresCol="features", labelCol="_label", weightCol="_w",
                            regParam=1.0 / (C * sum_w), elasticNetParam=0.0, standardization=False,
                            maxIter=max_iter, tol=1e-10, family="binomial")
    return st, lr.fit(fit_df)


def scaled_bundle(lr_model, stats_: dict, features: Sequence[str], fill: dict | None = None) -> PipelineModel:
    """A6 for ``fit_logistic_smote``: fill values, scaler, feature order and model
    as one ``PipelineModel``, which ``score`` applies to rows with ``features``."""
    return PipelineModel(stages=[scaler_stage({f: stats_[f] for f in features}, fill),
                                 prepare.assembler([f"{f}__z" for f in features]), lr_model])


def score_scaled(lr_model, stats_: dict, df: DataFrame, features: Sequence[str], target: str,
                 threshold: float = 0.5) -> DataFrame:
    """I2 for ``fit_logistic_smote``: same scaler, p1, pred, label."""
    from pyspark.ml.functions import array_to_vector
    x = prepare.apply_standard_scaler(df, stats_).select(
        F.col(target).cast("int").alias("label"),
        array_to_vector(F.array(*[F.col(f) for f in features])).alias("features"))
    out = lr_model.transform(x)
    p = vector_to_array(F.col("probability"))[1]
    return out.withColumn("p1", p).withColumn("pred", (F.col("p1") >= threshold).cast("int"))
