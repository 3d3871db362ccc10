"""Profiling and quality reports.

Each report is one multi-column aggregate over the base table (one scan),
then a reshape of the single result row into one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.core import numeric_columns, string_columns
from riskframe.operators import ranks


def _rows_from_wide(wide: DataFrame, names: Sequence[str], fields: dict) -> DataFrame:
    """Turn the one-row result of a multi-column agg into one row per column.

    ``fields`` maps output field -> format string of the wide column, e.g.
    {"null_count": "{}__nulls"}; a None format yields a null field.
    """
    structs = []
    for name in names:
        parts = [F.lit(name).alias("column")]
        for out, fmt in fields.items():
            parts.append((F.col(fmt.format(name)) if fmt else F.lit(None)).alias(out))
        structs.append(F.struct(*parts))
    return wide.select(F.explode(F.array(*structs)).alias("_r")).select("_r.*")


def quality_report(df: DataFrame, columns: Sequence[str] | None = None,
                   approx_distinct: bool = False) -> DataFrame:
    """Column, dtype, non_null, null_count, null_pct, unique, unique_pct,
    min, max, mean, std (numeric only; std is ddof 1). One aggregate job.

    ``approx_distinct`` swaps the exact distinct count (explode + map-side distinct)
    for HyperLogLog++ sketches: one pass, no blow-up, 5% relative standard
    deviation (Spark's default).
    """
    cols = list(columns or df.columns)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    num = set(numeric_columns(df.select(*cols)))
    aggs = [F.count(F.lit(1)).alias("__n")]
    for c in cols:
        x = F.col(c)
        aggs.append(F.count(x).alias(f"{c}__nn"))
        if approx_distinct:
            aggs.append(F.approx_count_distinct(x).alias(f"{c}__u"))
        if c in num:
            d = x.cast("double")
            aggs += [F.min(d).alias(f"{c}__min"), F.max(d).alias(f"{c}__max"),
                     F.avg(d).alias(f"{c}__mean"), F.stddev_samp(d).alias(f"{c}__std")]
        else:
            aggs += [F.lit(None).cast("double").alias(f"{c}__{s}") for s in ("min", "max", "mean", "std")]
    wide = df.select(*cols).agg(*aggs)
    fields = {"non_null": "{}__nn", "min": "{}__min", "max": "{}__max",
              "mean": "{}__mean", "std": "{}__std", "n": "__n"}
    if approx_distinct:
        fields["unique"] = "{}__u"
    long = _rows_from_wide(wide, cols, fields)
    if not approx_distinct:
        long = long.join(distinct_counts(df, cols), "column", "left").fillna({"unique": 0})
    dtypes = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c].simpleString()))])
    return long.select(
        "column",
        dtypes[F.col("column")].alias("dtype"),
        F.col("non_null").cast("long").alias("non_null"),
        (F.col("n") - F.col("non_null")).cast("long").alias("null_count"),
        F.round(F.try_divide(F.col("n") - F.col("non_null"), F.col("n")) * 100, 2).alias("null_pct"),
        F.col("unique").cast("long").alias("unique"),
        F.round(F.try_divide(F.col("unique"), F.col("n")) * 100, 2).alias("unique_pct"),
        "min", "max", "mean", "std")


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct non-null values per column: (column, unique).

    One explode to (column, value) and two aggregates. The first dedups on
    the map side, so low-cardinality columns shrink before the shuffle --
    instead of one Expand copy of every row per distinct aggregate.
    Floats: -0.0 folds into 0.0 and NaN is not a value, as in pandas.
    """
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    items = []
    for c in columns:
        x = F.col(c)
        if types[c].simpleString() in ("double", "float"):
            x = F.when(F.isnan(x), None).otherwise(x + F.lit(0.0))
        items.append(F.struct(F.lit(c).alias("column"), x.cast("string").alias("value")))
    long = df.select(F.explode(F.array(*items)).alias("kv")).select("kv.*").filter(F.col("value").isNotNull())
    return long.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("unique"))


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns with missing values: column, missing_count, missing_pct, dtype."""
    cols = list(columns or df.columns)
    types = dict((f.name, f.dataType.simpleString()) for f in df.schema.fields)
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).isNull()).alias(f"{c}__m") for c in cols])
    long = _rows_from_wide(wide, cols, {"missing_count": "{}__m", "n": "__n"})
    dtypes = F.create_map(*[x for c in cols for x in (F.lit(c), F.lit(types[c]))])
    return (long.filter(F.col("missing_count") > 0)
            .select("column", F.col("missing_count").cast("long").alias("missing_count"),
                    F.round(F.try_divide(F.col("missing_count"), F.col("n")) * 100, 2).alias("missing_pct"),
                    dtypes[F.col("column")].alias("dtype"))
            .orderBy(F.col("missing_count").desc(), "column"))


def blank_string_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Whitespace-only strings per string column (only columns with any)."""
    cols = list(columns or string_columns(df))
    wide = df.agg(F.count(F.lit(1)).alias("__n"),
                  *[F.count_if(F.col(c).rlike(r"(?U)^\s*$")).alias(f"{c}__b") for c in cols])
    long = _rows_from_wide(wide, cols, {"n_blank": "{}__b", "n": "__n"})
    return (long.filter(F.col("n_blank") > 0)
            .select("column", F.col("n_blank").cast("long").alias("n_blank"),
                    F.round(F.try_divide(F.col("n_blank"), F.col("n")) * 100, 2).alias("blank_pct"))
            .orderBy(F.col("n_blank").desc(), "column"))


def duplicate_report(df: DataFrame, key: str) -> DataFrame:
    """n_rows, full-row duplicate count, key duplicate count, repeated keys.

    Each count is an aggregate over a groupBy (partial aggregation on the map
    side), never a collect of the rows.
    """
    full = (df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
            .agg(F.sum("_c").alias("n_rows"), F.sum(F.col("_c") - 1).alias("n_dup_full")))
    by_key = (df.groupBy(key).agg(F.count(F.lit(1)).alias("_c"))
              .agg(F.sum(F.col("_c") - 1).alias("n_dup_key"),
                   F.count_if(F.col("_c") > 1).alias("n_repeated_keys")))
    rows = full.select(F.explode(F.array(
        F.struct(F.lit("n_rows").alias("check"), F.col("n_rows").cast("long").alias("value")),
        F.struct(F.lit("n_dup_full").alias("check"), F.col("n_dup_full").cast("long").alias("value")),
    )).alias("r")).select("r.*")
    rows2 = by_key.select(F.explode(F.array(
        F.struct(F.lit("n_dup_key").alias("check"), F.col("n_dup_key").cast("long").alias("value")),
        F.struct(F.lit("n_repeated_keys").alias("check"),
                 F.col("n_repeated_keys").cast("long").alias("value")),
    )).alias("r")).select("r.*")
    return rows.unionByName(rows2)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def dataset_overview(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Shape, type counts, class counts, default rate, imbalance ratio.

    (metric, value) rows; the data part is one aggregate.
    """
    n_num = len(numeric_columns(df))
    n_str = len(string_columns(df))
    agg = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count_if(F.col(target) == 0).alias("n0"),
                 F.count_if(F.col(target) == 1).alias("n1"))
    m = [("n_rows", F.col("n")), ("n_columns", F.lit(len(df.columns))),
         ("n_numeric", F.lit(n_num)), ("n_categorical", F.lit(n_str)),
         ("non_default", F.col("n0")), ("default", F.col("n1")),
         ("default_rate", F.try_divide(F.col("n1"), F.col("n0") + F.col("n1")) * 100),
         ("imbalance_ratio", F.try_divide(F.col("n0").cast("double"), F.col("n1")))]
    return agg.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("metric"), v.cast("double").alias("value")) for k, v in m
    ])).alias("r")).select("r.*")


def numeric_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, std, min, 25%, 50%, 75%, max per numeric column.

    Quartiles are exact (linear interpolation) from the distributed rank
    table, not ``summary()``'s approximate percentiles.
    """
    cols = list(columns or numeric_columns(df))
    moments = df.agg(*[x for c in cols for x in (
        F.count(F.col(c)).alias(f"{c}__n"), F.avg(F.col(c).cast("double")).alias(f"{c}__mean"),
        F.stddev_samp(F.col(c).cast("double")).alias(f"{c}__std"),
        F.min(F.col(c).cast("double")).alias(f"{c}__min"),
        F.max(F.col(c).cast("double")).alias(f"{c}__max"))])
    long = _rows_from_wide(moments, cols, {"count": "{}__n", "mean": "{}__mean", "std": "{}__std",
                                           "min": "{}__min", "max": "{}__max"})
    q = (ranks.exact_quantiles(df, cols, [0.25, 0.5, 0.75])
         .groupBy(F.col("variable").alias("column"))
         .agg(*[F.max(F.when(F.col("q") == p, F.col("value"))).alias(n)
                for p, n in ((0.25, "p25"), (0.5, "p50"), (0.75, "p75"))]))
    # q has one row per column: bounded by the column list.
    return long.join(F.broadcast(q), "column", "left").select(
        "column", F.col("count").cast("long").alias("count"), "mean", "std", "min",
        "p25", "p50", "p75", "max")


def _string_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return ranks.to_long(df, cols, value_type="string")


def categorical_describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, unique, top (most frequent; ties -> smallest), freq.

    Two aggregates; ``min_by`` picks the top value without a window, so a
    high-cardinality column never lands in one task.
    """
    cols = list(columns or string_columns(df))
    vc = _string_long(df, cols).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    return vc.groupBy(F.col("variable").alias("column")).agg(
        F.sum("n").cast("long").alias("count"),
        F.count(F.lit(1)).cast("long").alias("unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").cast("long").alias("freq"))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence, k: int,
                    salt_buckets: int = 64, tiebreak: Sequence[str] = ()) -> DataFrame:
    """Exact top-k rows per group in two rounds.

    Round 1 ranks inside (group, hash-salt) slices, so one huge group is
    spread over ``salt_buckets`` tasks; only k candidates per slice survive.
    Round 2 ranks the k x buckets candidates of each group.
    """
    order = list(order)
    keys = list(tiebreak) or [c for c in df.columns if c not in group]
    salted = df.withColumn("_salt", F.abs(F.xxhash64(*[F.col(c) for c in keys])) % salt_buckets)
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    cand = salted.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k)
    w2 = Window.partitionBy(*group).orderBy(*order)
    return (cand.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= k)
            .drop("_salt", "_r"))


def top_values(df: DataFrame, columns: Sequence[str] | None = None, k: int = 10) -> DataFrame:
    """The k most frequent values of each categorical column, plus its
    cardinality. Ties are broken by value so the result is deterministic."""
    cols = list(columns or string_columns(df))
    vc = _string_long(df, cols).groupBy("variable", "value").agg(F.count(F.lit(1)).alias("n"))
    card = vc.groupBy("variable").agg(F.count(F.lit(1)).alias("cardinality"))
    top = top_k_per_group(vc, ["variable"], [F.col("n").desc(), F.col("value").asc()], k,
                          tiebreak=["value"])
    # card: one row per column, bounded by the column list.
    return top.join(F.broadcast(card), "variable").select(
        F.col("variable").alias("column"), "value", F.col("n").cast("long").alias("count"),
        F.col("rank").cast("long").alias("rank"), F.col("cardinality").cast("long").alias("cardinality"))


def default_rate_by_category(df: DataFrame, columns: Sequence[str], target: str = "TARGET") -> DataFrame:
    """Mean target x 100 per value of each column, with the global mean.

    One unpivot + one groupBy (partial aggregation); missing keys dropped as
    in a pandas groupby. The global rate is a column of the same aggregate's
    input, computed with a grand-total grouping set instead of a join.
    """
    long = ranks.to_long(df, columns, [F.col(target).cast("double").alias("_y")],
                         value_type="string")
    per = long.groupBy("variable", "value").agg(
        F.count(F.lit(1)).alias("n"), (F.avg("_y") * 100).alias("default_rate"))
    # The global rate is one number: fetched once and inlined as a literal.
    overall = df.agg(F.avg(F.col(target).cast("double"))).first()[0]
    return per.select("variable", "value", F.col("n").cast("long").alias("n"), "default_rate",
                      (F.lit(overall) * 100).cast("double").alias("overall_rate"))


def class_shares(df: DataFrame, target: str = "TARGET") -> DataFrame:
    """Count and percentage per class."""
    per = df.groupBy(F.col(target).alias("class")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy()  # over the per-class rows only (2 rows)
    return per.select("class", F.col("count").cast("long").alias("count"),
                      (F.col("count") / F.sum("count").over(w) * 100).alias("pct"))


def negative_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count of negative values and minimum per column."""
    wide = df.agg(*[x for c in columns for x in (
        F.count_if(F.col(c) < 0).alias(f"{c}__neg"), F.min(F.col(c).cast("double")).alias(f"{c}__min"))])
    long = _rows_from_wide(wide, columns, {"n_negative": "{}__neg", "min": "{}__min"})
    return long.select("column", F.col("n_negative").cast("long").alias("n_negative"), "min")


def correlation_pairs(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for every pair, pairwise-complete (as pandas .corr)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"p{i}")
                    for i, (a, b) in enumerate(pairs)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(f"p{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)])).alias("x")).select("x.*")


def correlation_with_target(df: DataFrame, columns: Sequence[str], target: str = "TARGET") -> DataFrame:
    """R of each column with the target."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"c{i}")
                    for i, c in enumerate(columns)])
    return wide.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"c{i}").alias("r"))
        for i, c in enumerate(columns)])).alias("x")).select("x.*")


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width histogram; with ``by`` each class uses its own range.

    Edges come from a min/max aggregate (one row per class, bounded by the
    class count); the last bin is closed; a zero-width range is one bin; a bin
    without rows is there with count 0.
    """
    x = F.col(column).cast("double")
    keys = [F.col(by).alias("class")] if by else [F.lit(None).cast("string").alias("class")]
    base = df.select(*keys, x.alias("x")).filter(F.col("x").isNotNull() & ~F.isnan("x"))
    rng = base.groupBy(F.col("class").alias("_class")).agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    w = (F.col("hi") - F.col("lo")) / bins
    b = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col("x") - F.col("lo")) * bins / (F.col("hi") - F.col("lo"))),
                F.lit(bins - 1)))
    counted = (base.join(F.broadcast(rng), F.col("class").eqNullSafe(F.col("_class")))
               .select("_class", b.cast("int").alias("bin"))
               .groupBy(F.col("_class").alias("_c"), F.col("bin").alias("_b")).agg(F.count(F.lit(1)).alias("_n")))
    last = F.when(F.col("hi") == F.col("lo"), F.lit(0)).otherwise(F.lit(bins - 1))
    grid = rng.withColumn("bin", F.explode(F.sequence(F.lit(0), last)))
    full = (grid.join(counted, F.col("_class").eqNullSafe(F.col("_c")) & (F.col("bin") == F.col("_b")), "left")
            .withColumn("class", F.col("_class")).withColumn("count", F.coalesce("_n", F.lit(0))))
    return full.select("class", "bin",
                          (F.col("lo") + F.col("bin") * w).alias("left"),
                          (F.col("lo") + (F.col("bin") + 1) * w).alias("right"),
                          F.col("count").cast("long").alias("count"))
