"""Plan checks: no cartesian products or nested-loop joins in any
oracle-checked query, column pruning and filter pushdown at the scan."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from riskframe.operators import clean
from riskframe.sources.fixtures import applications

SF = "/root/testdata/sf0.001"
NAMES = sorted(entry.oracle_sql())


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", NAMES)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_flagship_prunes_columns_and_aggregates_partially(spark):
    plan = _plan(entry.queries()["d18_monthly_volume"](spark, SF))
    schema = [ln for ln in plan.splitlines() if ln.startswith("ReadSchema")][0]
    assert "DATE_MONTH" in schema and "TARGET" in schema and "LOAN_AMOUNT" not in schema
    assert plan.count("HashAggregate") >= 2  # partial before the exchange, final after


def test_temporal_split_pushes_filter_to_scan(spark):
    _, te = clean.temporal_split(applications(spark, SF).select("DATE_MONTH", "TARGET"), "DATE_MONTH", "2000-07-01")
    plan = _plan(te)
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")][0]
    assert "DATE_MONTH" in pushed
