"""The applications view: lines are dealt as rows, not as buffers, and months are summed from the written rows."""

import datetime as dt

from pyspark.sql import functions as F

from riskframe.sources import fixtures


def _tables(spark, folder):
    day = dt.datetime(2000, 3, 5)
    put = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    put([(1, 1, "O", 10.0, day, "1-URGENT"), (2, 1, "F", 20.0, day, "5-LOW"), (3, 9, "F", 5.0, None, "5-LOW")],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string", "orders")
    put([(1, 0, 7.0, "AUTO"), (9, 0, 8.0, "AUTO")], "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string", "customer")
    put([(0, "FRANCE", 0)], "n_nationkey int, n_name string, n_regionkey int", "nation")
    put([(0, "EUROPE")], "r_regionkey int, r_name string", "region")
    put([(1, 1, 100.0, 3.0, 0.1, 0.2, "R", "O", day), (1, 2, 60.0, 4.0, 0.3, 0.0, None, "F", None), (2, 1, 1.0, 2.0, 0.0, 0.0, "N", None, day)],
        "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp", "lineitem")


def test_lines_are_aggregated_behind_the_exchange(spark, tmp_path):
    _tables(spark, str(tmp_path))
    plan = fixtures._lineitem_per_order(spark.read.parquet(f"{tmp_path}/lineitem.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in plan.split("Exchange hashpartitioning")[0]
    assert "Aggregate" not in plan.split("Exchange hashpartitioning")[1]


def test_materialized_rows_equal_the_lazy_view(spark, tmp_path):
    _tables(spark, str(tmp_path))
    got = fixtures.applications(spark, str(tmp_path))
    lazy = fixtures.applications(spark, str(tmp_path), materialize=False)
    assert got.columns == lazy.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, lazy.collect()))
    rows = {r["CLIENT_ID"]: r for r in got.collect()}
    assert set(rows) == {1, 2}                       # an order without a date has no month
    assert (rows[1]["TARGET"], rows[2]["TARGET"], rows[2]["DEFAULTS_ORIGINATION"]) == (1, 0, 1)
    assert (rows[1]["N_RETURNED"], rows[1]["N_OPEN_LINES"], rows[1]["AVG_DAYS_TO_SHIP"]) == (1, 1, 0.0)
    files = spark.read.parquet(fixtures.materialized_path(spark, str(tmp_path))[0])
    assert "DEFAULTS_ORIGINATION" not in files.columns   # the joins ran once, without the per-month sum
    assert files.agg(F.count("*")).first()[0] == 2
