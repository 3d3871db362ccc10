"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""

import os

import pytest

import __spark_entry__ as entry
from tests.oracle_check import duck, rows_of

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SQL = entry.oracle_sql()
# Spark simpleString -> DuckDB type name
TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT",
         "smallint": "SMALLINT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
         "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    srows = [tuple(r) for r in sdf.collect()]
    rel = con.sql(SQL[name])
    dcols, dtypes = rel.columns, [str(t) for t in rel.types]
    drows = rel.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    stypes = {f.name: TYPES.get(f.dataType.simpleString()) for f in sdf.schema.fields}
    assert stypes == dict(zip(dcols, dtypes))
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_entry_runs(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert out.columns == ["month", "nb_clients", "nb_defauts", "taux_defaut"]
