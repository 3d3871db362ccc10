"""Cases that went wrong once."""

import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.functions.pvalues import chi2_sf
from riskframe.operators import clean, features, impute, neighbours, profile, select
from riskframe.sources import io


def test_chi2_converges_at_any_size():
    assert chi2_sf(1e8 - 2 / 3, 1e8) == pytest.approx(0.5, abs=1e-6)
    assert chi2_sf(1e9, 1e9) == pytest.approx(0.5 - 1 / (3 * np.sqrt(np.pi * 1e9)), abs=1e-6)
    low, high = chi2_sf(2.0005e5, 1.9999e5), chi2_sf(2.0005e5, 2.0001e5)  # both sides of the switch
    assert low == pytest.approx(chi2_sf(2.0005e5 - 1e-9, 1.9999e5), abs=1e-9) and abs(low - high) < 0.02
    assert chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)


def test_unicode_blanks(spark):
    df = spark.createDataFrame([("\u00a0",), ("\u3000 ",), ("x",), ("",)], "s string")
    assert df.where(clean.is_blank("s")).count() == 3
    assert impute.blank_to_null(df).where("s is null").count() == 3
    assert profile.blank_string_report(df).first()["n_blank"] == 3


def test_keep_last_needs_an_order(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError):
        clean.remove_duplicates(df, ["k"], keep="last")
    assert clean.remove_duplicates(df, ["k"], keep="last", order_by=["v"]).first()["v"] == "b"


def test_nan_is_missing_at_the_source(spark, tmp_path):
    spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, y int").write.parquet(str(tmp_path / "t.parquet"))
    for df in (io.load_parquet(spark, str(tmp_path / "t.parquet")), io.read_table(spark, str(tmp_path), "t")):
        assert df.where("x is null").count() == 1 and df.agg(F.avg("x")).first()[0] == 2.0


def test_smote_balances_a_tiny_minority(spark):
    rows = [(i, [float(i), 1.0], 1) for i in range(3)] + [(10 + i, [float(i), 0.0], 0) for i in range(37)]
    out = neighbours.smote(spark.createDataFrame(rows, "id bigint, v array<double>, y int"), "id", "v", "y", k=5)
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 37, 1: 37}


def test_standard_names():
    assert [clean.standard_name(s) for s in ("Column Name", "  Spaces  ", "Another-Column", "__a  b__", "\u00c9t\u00e9 (%)")] == [
        "column_name", "spaces", "another_column", "a_b", "\u00e9t\u00e9"]


def test_missing_p_value_is_not_significant():
    assert select._p({"p_value": None}) == 1.0 and select._p({"p_value": float("nan")}) == 1.0


def test_task_functions_need_no_source_tree(tmp_path):
    """A p-value job from a foreign folder, with workers that cannot import the package."""
    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from riskframe.session import get_spark\n"
        "from riskframe.functions import pvalues\n"
        "s = get_spark('local[2]')\n"
        "print('P', s.range(1).select(pvalues.chi2_p_udf((s.range(1).id + 3.84).cast('double'), (s.range(1).id + 1).cast('double'))).first()[0])\n"
    ) % str(__import__("pathlib").Path(__file__).resolve().parents[1])
    code = code.replace("s.range(1).id + 3.84", "__import__('pyspark.sql.functions', fromlist=['x']).col('id') + 3.84").replace(
        "s.range(1).id + 1", "__import__('pyspark.sql.functions', fromlist=['x']).col('id') + 1")
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0 and abs(float(done.stdout.split("P ")[1]) - 0.05) < 1e-3, done.stderr[-500:]
