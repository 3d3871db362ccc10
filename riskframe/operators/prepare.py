"""Preparation for modelling (G1-G4, G7, G8, C1 summary).

Splits are deterministic functions of a row key and a seed (md5), so
the same rows land on the same side whatever the partitioning or retries.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators import cuts


def split_summary(train: DataFrame, test: DataFrame, target: str = "TARGET") -> DataFrame:
    """Side, n, share (%), default_rate (%) -- two aggregates, unioned."""
    def one(df, side):
        return df.agg(F.count(F.lit(1)).alias("n"), (F.avg(F.col(target).cast("double")) * 100)
                      .alias("default_rate")).withColumn("side", F.lit(side))
    both = one(train, "train").unionByName(one(test, "test"))
    total = F.sum("n").over(Window.partitionBy())  # over the two summary rows
    return both.select("side", "n", (F.col("n") * 100.0 / total).alias("share"), "default_rate")


def label_encoder(columns: Sequence[str]) -> list[StringIndexer]:
    """G1: codes in sorted value order; missing gets its own (last) code."""
    return [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetAsc",
                          handleInvalid="keep") for c in columns]


def label_encode(df: DataFrame, columns: Sequence[str], fit_df: DataFrame | None = None) -> DataFrame:
    """G1 applied: replaces each column by its code (double)."""
    from pyspark.ml import Pipeline
    model = Pipeline(stages=label_encoder(columns)).fit(fit_df if fit_df is not None else df)
    out = model.transform(df)
    for c in columns:
        out = out.drop(c).withColumnRenamed(f"{c}_idx", c)
    return out.select(*df.columns)


def stratified_split(df: DataFrame, target: str, key: str, test_size: float = 0.2,
                     seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Exact stratified split.

    Within each class rows are ordered by 60 bits of md5(key, seed); the first
    round(test_size * n_class) go to test. Only the key at which the test side
    ends is looked for (``cuts.cut_points``); no row is moved. Rows that
    share a key stay on one side. A null class is a class of its own.
    """
    draw = cuts.hash_key(key, seed)
    sizes = cuts.class_sizes(df, target)
    ends = cuts.cut_points(df, target, draw, {c: [math.floor(n * test_size + 0.5)] for c, n in sizes.items()})
    side = cuts.side_of(target, draw, ends)
    return df.filter(side == 1), df.filter(side == 0)


def fit_standard_scaler(df: DataFrame, columns: Sequence[str]) -> dict:
    """G4 fit: {column: (mean, population std)} in one aggregate."""
    row = df.agg(*[x for i, c in enumerate(columns) for x in (
        F.avg(F.col(c).cast("double")).alias(f"m{i}"),
        F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}"))]).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}


def apply_standard_scaler(df: DataFrame, stats: dict) -> DataFrame:
    """G4 transform: (x - mean) / std; a constant column (std 0) becomes 0."""
    m = {}
    for c, (mu, sd) in stats.items():
        sd = sd if sd not in (None, 0.0) else 1.0
        m[c] = (F.col(c).cast("double") - F.lit(mu)) / F.lit(sd)
    return df.withColumns(m)


def class_weights(df: DataFrame, target: str = "TARGET", out: str = "weight") -> DataFrame:
    """Balanced weights n / (2 * n_class) as a column (two numbers)."""
    counts = {r[0]: r[1] for r in df.groupBy(target).count().collect()}
    n = sum(counts.values())
    k = len(counts)
    w = None
    for cls, nc in counts.items():
        expr = F.lit(n / (k * nc))
        w = F.when(F.col(target) == cls, expr) if w is None else w.when(F.col(target) == cls, expr)
    return df.withColumn(out, w)


def assembler(columns: Sequence[str], out: str = "features") -> VectorAssembler:
    """Ordered feature vector; a missing value is an error."""
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error")
