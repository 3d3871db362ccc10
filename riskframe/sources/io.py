"""Readers and writers (A1-A5). Model persistence (A6) lives in operators.model."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The tokens pandas' CSV reader treats as missing by default.
DEFAULT_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table: ``{sf_dir}/{name}.parquet``."""
    return nan_free(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def nan_free(df: DataFrame) -> DataFrame:
    """NaN is a missing value from here on."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats}) if floats else df


def load_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A2: typed columnar read; ``columns`` prunes the scan."""
    df = nan_free(spark.read.parquet(path))
    return df.select(*columns) if columns else df


def load_csv(spark: SparkSession, path: str, schema: T.StructType,
             na_tokens: Iterable[str] = DEFAULT_NA_TOKENS, sep: str = ",") -> DataFrame:
    """A1: header CSV with a declared schema and pandas-style missing tokens.

    Cells are read as text, the missing tokens become null, then each column
    is cast leniently to its declared type (a bad cell becomes null instead
    of failing the job). No schema inference pass over the data.
    """
    text_schema = T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])
    raw = (spark.read.schema(text_schema).option("header", True).option("sep", sep)
           .option("nullValue", None).option("emptyValue", "").csv(path))
    tokens = list(na_tokens)
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        c = F.when(c.isin(tokens) | c.isNull(), None).otherwise(c)  # a blank cell is text, not missing
        if not isinstance(f.dataType, T.StringType):
            c = F.trim(c).try_cast(f.dataType)
        out.append(c.alias(f.name))
    return raw.select(*out)


def save_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None,
                 mode: str = "overwrite") -> None:
    """A3: overwrite, no index; partitioning by month enables pruning on read.

    Rows are rebalanced by the partition columns first: few files per value,
    and adaptive execution splits a value that holds much of the table.
    """
    if partition_by:
        w = df.hint("rebalance", *partition_by).write.mode(mode).partitionBy(*partition_by)
    else:
        w = df.write.mode(mode)
    w.parquet(path)


def save_report_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A4: a report table as header CSV (reports are small; one file)."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def save_report_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A5: a report table as JSON lines."""
    df.coalesce(1).write.mode(mode).json(path)
