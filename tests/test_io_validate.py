"""Readers (missing tokens, lenient casts) and validation edge cases."""

import os
import tempfile

from pyspark.sql import types as T

from riskframe.operators import validate
from riskframe.sources import io


def test_load_csv_missing_tokens_and_lenient_casts(spark):
    d = tempfile.mkdtemp(prefix="riskframe-csv-")
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("id,x,region\n1,1.5,North\n2,NA,  \n3,oops,NULL\n4,n/a,South\n")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("x", T.DoubleType()),
                           T.StructField("region", T.StringType())])
    rows = {r["id"]: r for r in io.load_csv(spark, d, schema).collect()}
    assert rows[1]["x"] == 1.5 and rows[1]["region"] == "North"
    assert rows[2]["x"] is None and rows[2]["region"] == "  "   # NA; a blank is text
    assert rows[3]["x"] is None and rows[3]["region"] is None   # bad number, NULL token
    assert rows[4]["x"] is None and rows[4]["region"] == "South"


def test_validate_target_branches(spark):
    missing = validate.validate_target(spark.createDataFrame([(1,)], "x int"), "TARGET").collect()
    assert [(r["check"], r["status"]) for r in missing] == [("target_present", "error")]
    df = spark.createDataFrame([(0,)] * 95 + [(1,)] * 4 + [(2,)] + [(None,)], "TARGET int")
    st = {r["check"]: r["status"] for r in validate.validate_target(df).collect()}
    assert st == {"binary_values": "error", "missing_target": "warning", "class_balance": "warning"}
    all_rows = {r["check"]: r["status"] for r in validate.run_all_validations(df, "TARGET", "nope").collect()}
    assert all_rows["all_valid"] == "error" and all_rows["date_range"] == "error"
