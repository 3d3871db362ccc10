"""Run every registered query in Spark and its oracle in DuckDB; compare.

Mirrors the driver's gate: row count, column names and types, and an
order-insensitive comparison of the values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

# Spark simpleString -> DuckDB type name
TYPES = {"double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "tinyint": "TINYINT",
         "smallint": "SMALLINT", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
         "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP"}

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 5)
    if hasattr(v, "item"):
        return _norm(v.item())
    if hasattr(v, "isoformat"):
        return str(v)[:19]
    return v


def rows_of(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def check(spark, sf_dir: str, names=None, verbose=True):
    import __spark_entry__ as entry
    qs = entry.queries()
    sqls = entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or qs:
        t0 = time.time()
        sdf = qs[name](spark, sf_dir)
        srows = [tuple(r) for r in sdf.collect()]
        scols = sdf.columns
        t1 = time.time()
        if name not in sqls:
            results[name] = ("rows-only", len(srows), t1 - t0)
            if verbose:
                print(f"{name:40s} rows-only n={len(srows)} {t1 - t0:.1f}s", flush=True)
            continue
        rel = con.sql(sqls[name])
        dcols, dtypes = rel.columns, [str(t) for t in rel.types]
        drows = rel.fetchall()
        stypes = {f.name: TYPES.get(f.dataType.simpleString()) for f in sdf.schema.fields}
        ok_cols = sorted(scols) == sorted(dcols) and stypes == dict(zip(dcols, dtypes))
        ok_n = len(srows) == len(drows)
        ok_v = ok_cols and ok_n and rows_of(scols, srows) == rows_of(dcols, drows)
        status = "OK" if ok_v else "MISMATCH"
        results[name] = (status, len(srows), t1 - t0)
        if verbose:
            print(f"{name:40s} {status} n={len(srows)}/{len(drows)} cols={ok_cols} {t1 - t0:.1f}s",
                  flush=True)
            if not ok_v:
                if not ok_cols:
                    print("   spark:", sorted(scols), "\n   duck: ", sorted(dcols))
                else:
                    a, b = rows_of(scols, srows), rows_of(dcols, drows)
                    diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                    print("   first diffs:", diff)
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from riskframe.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    res = check(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v[0] == "MISMATCH"]
    print("mismatches:", bad)
