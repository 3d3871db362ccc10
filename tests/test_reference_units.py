"""The original project's unit tests, with exact assertions."""

import pandas as pd
from pyspark.sql import functions as F

from riskframe.operators import clean


def test_remove_duplicates(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1, 1, 2, 3], "b": ["x", "x", "y", "z"]}))
    assert clean.remove_duplicates(df).count() == 3
    assert clean.remove_duplicates(df, keep=False).count() == 2


def test_remove_duplicates_first_last(spark):
    df = spark.createDataFrame([(1, "x", 1), (1, "x", 2), (2, "y", 3)], "a long, b string, t long")
    first = {r["a"]: r["t"] for r in clean.remove_duplicates(df, ["a"], "first", ["t"]).collect()}
    last = {r["a"]: r["t"] for r in clean.remove_duplicates(df, ["a"], "last", ["t"]).collect()}
    assert first == {1: 1, 2: 3} and last == {1: 2, 2: 3}


def test_standardize_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Column Name", "Another-Column", "  Spaces  "])
    assert clean.standardize_column_names(df).columns == ["column_name", "another_column", "spaces"]


def test_detect_outliers_iqr(spark):
    df = spark.createDataFrame(pd.DataFrame({"values": [1.0, 2, 3, 4, 5, 100]}))
    q1, q3, lo, hi = clean.iqr_bounds(df, ["values"])["values"]
    assert (q1, q3) == (2.25, 4.75)
    flagged = clean.detect_outliers_iqr(df, "values").filter("values_outlier").collect()
    assert [r["values"] for r in flagged] == [100.0]


def test_cap_is_idempotent(spark):
    df = spark.range(1000).select((F.col("id") * 1.5).alias("x"))
    caps = clean.fit_caps(df, ["x"])
    once = clean.apply_caps(df, caps)
    twice = clean.apply_caps(once, caps)
    assert once.exceptAll(twice).count() == 0
