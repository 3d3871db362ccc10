"""Registry of named queries: a Spark callable plus, where SQL can say the
same thing, an independent DuckDB oracle over the provided tables.

Floating outputs are rounded to ``DIGITS`` on both sides so that summation
order does not decide the comparison.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 6


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    round_cols: Sequence[str] = field(default_factory=tuple)
    operators: str = ""


REGISTRY: dict[str, Query] = {}


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    # "+ 0.0" folds -0.0 into 0.0 (IEEE), identically in the oracle
    return df.select(*[
        (F.round(F.col(f.name), digits) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def register(name: str, sql: str | None = None, round_cols: Sequence[str] = (),
             operators: str = ""):
    """Decorator: ``round_cols`` are the DOUBLE outputs of the oracle."""
    def deco(fn):
        def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        wrapped.__name__ = fn.__name__
        wrapped.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, wrapped, sql, tuple(round_cols), operators)
        return wrapped
    return deco


def oracle_text(q: Query) -> str | None:
    if q.sql is None:
        return None
    if not q.round_cols:
        return q.sql
    rep = ", ".join(f"round(\"{c}\", {DIGITS}) + 0.0 AS \"{c}\"" for c in q.round_cols)
    return f"SELECT * REPLACE ({rep}) FROM ({q.sql}) AS _q"
