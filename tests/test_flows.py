"""The two end-to-end flows on the smallest tables."""

from riskframe.plans.flows import explore_and_clean, features_and_model
from riskframe.session import ensure_checkpoint_dir
from riskframe.sources.fixtures import TRAIN_CUTOFF, credit_view

SF = "/root/testdata/sf0.001"


def test_flows_end_to_end(spark):
    import uuid
    out = ensure_checkpoint_dir(spark).rstrip("/") + f"/flows-{uuid.uuid4().hex}"
    df = credit_view(spark, SF).drop("QTY_TOTAL")
    reports = explore_and_clean(df, out)
    assert {r["check"] for r in reports["validations"].collect()} >= {"shape", "all_valid"}
    feats = ["LOAN_AMOUNT", "INCOME_MONTHLY", "N_ITEMS", "AVG_DISCOUNT", "AVG_DAYS_TO_SHIP", "LOAN_TO_ANNUAL_INCOME"]
    res = features_and_model(spark, f"{out}/cleaned", out, TRAIN_CUTOFF, feats)
    m = {r["metric"]: r["value"] for r in res["metrics"].collect()}
    assert 0.5 < m["auc"] <= 1.0
    assert spark.read.parquet(f"{out}/cleaned").count() == df.count()
    assert res["trend"].count() == 1 and 1 <= res["seasonality"].count() <= 12
    # the saved bundle alone scores the derived rows as the fit did, missing cells included
    from pyspark.sql import functions as F

    from riskframe.operators import clean, model
    rows = clean.temporal_split(spark.read.parquet(f"{out}/features"), "DATE_MONTH", TRAIN_CUTOFF)[1]
    bundle = model.load_model(f"{out}/model")
    mine = sorted(r[0] for r in model.score(bundle, rows).select("p1").collect())
    theirs = sorted(r[0] for r in res["scored"].select("p1").collect())
    assert len(mine) == len(theirs) and max(abs(a - b) for a, b in zip(mine, theirs)) < 1e-12
    gap = model.score(bundle, rows.withColumn("INCOME_MONTHLY", F.lit(None).cast("double")))
    assert gap.where("p1 IS NULL").count() == 0


def test_engineered_selection_funnel(spark):
    import __spark_entry__ as entry
    from riskframe.plans.q_stats import FORCED_ENGINEERED
    rows = entry.queries()["h10_h11_funnel_engineered"](spark, SF).collect()
    final = {r["variable"] for r in rows if r["decision"] == "final"}
    assert set(FORCED_ENGINEERED) <= final
    assert {r["step"] for r in rows} >= {1, 2, 3, 7}
