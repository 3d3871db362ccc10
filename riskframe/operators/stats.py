"""Statistical variable selection (H1-H11) and rank-based model metrics.

All tests reduce the base rows to grouped counts first -- (variable, value,
group, n) -- and compute statistics on those; pairwise work is a long
(pair, ...) group-by, never a Python loop over columns or a cross join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.pvalues import chi2_p_udf, normal_p_udf
from riskframe.operators import ranks
from riskframe.session import written

MAX_GROUPS = 1000  # groups of a column whose rank sums are taken on codes


# ------------------------------------------------------------------ rank sums

def rank_sums(df: DataFrame, cols: Sequence[str], group: str | F.Column,
              value_type: str = "double") -> DataFrame:
    """(variable, grp, n_g, R_g, N, T) with mid-ranks over the rows whose
    value and group are both present; T = sum(t^3 - t) over tied values."""
    g = F.col(group) if isinstance(group, str) else group
    long = ranks.to_long(df, cols, [g.cast("string").alias("_g")], value_type)
    return ranks.rank_sums(long.filter(F.col("_g").isNotNull()))


def mann_whitney(df: DataFrame, cols: Sequence[str], target: str = "TARGET",
                 min_size: int = 5, with_p: bool = True) -> DataFrame:
    """H7: two-sided Mann-Whitney U per variable (tie- and continuity-
    corrected normal approximation).

    variable, n0, n1, U (of class 0), z, median_0, median_1, [p_value,
    effect_r, significant]. Variables with fewer than ``min_size`` rows in a
    class are skipped. Effect r = max(z, 0) / sqrt(N) (8 / sqrt(N) when p
    underflows to 0, as the original).

    Rank sums come from ``ranks.group_rank_sums``, the medians from the exact
    quantiles of each class.
    """
    y = F.col(target).cast("int")
    rows = df.select(*cols, F.when(y.isin(0, 1), y).alias("_y"))
    sums = ranks.group_rank_sums(rows, cols, ["_y"])
    p = sums.groupBy("variable", "N", "T").agg(*[F.coalesce(F.sum(F.when(F.col("grp") == g, F.col(c))), F.lit(0)).alias(x)
                                                 for g, c, x in (("0", "n_g", "n0"), ("1", "n_g", "n1"), ("0", "R_g", "R0"))])
    p = p.filter((F.col("n0") >= min_size) & (F.col("n1") >= min_size))
    n0, n1, N = F.col("n0").cast("double"), F.col("n1").cast("double"), F.col("N").cast("double")
    u0 = F.col("R0") - n0 * (n0 + 1) / 2
    mu = n0 * n1 / 2
    sigma = F.sqrt(n0 * n1 / 12 * ((N + 1) - F.col("T") / (N * (N - 1))))
    z = F.try_divide(F.abs(u0 - mu) - 0.5, sigma)
    out = p.select("variable", F.col("n0").cast("long").alias("n0"), F.col("n1").cast("long").alias("n1"),
                   u0.alias("U"), z.alias("z"), F.col("N"))
    med = None
    for k in ("0", "1"):
        q = ranks.exact_quantiles(rows.where(F.col("_y") == int(k)), cols, [0.5]).select("variable", F.col("value").alias(f"median_{k}"))
        med = q if med is None else med.join(q, "variable", "full")
    # med: one row per variable.
    out = out.join(F.broadcast(med), "variable", "left")
    if with_p:
        # the continuity correction takes a U next to its mean below zero: p is 1 there, the effect 0
        above = F.when(F.col("z") < 0, F.lit(0.0)).otherwise(F.col("z"))
        out = out.withColumn("p_value", normal_p_udf(above))
        out = out.withColumn("effect_r", F.when(F.col("p_value") == 0, F.lit(8.0))
                             .otherwise(above) / F.sqrt(F.col("N").cast("double")))
        out = out.withColumn("significant", F.col("p_value") < 0.05)
    return out.drop("N")


def auc(scored: DataFrame, score: str = "probability", label: str = "label") -> DataFrame:
    """I3 AUC (exact, mid-ranks for ties) and Gini = 2 AUC - 1.
    One class only -> null."""
    rs = rank_sums(scored, [score], F.col(label).cast("int"))
    a = rs.groupBy("variable").agg(
        F.sum(F.when(F.col("grp") == "0", F.col("n_g"))).alias("n0"),
        F.sum(F.when(F.col("grp") == "1", F.col("n_g"))).alias("n1"),
        F.sum(F.when(F.col("grp") == "1", F.col("R_g"))).alias("R1"))
    n0, n1 = F.col("n0").cast("double"), F.col("n1").cast("double")
    val = F.try_divide(F.col("R1") - n1 * (n1 + 1) / 2, n0 * n1)
    return a.select(val.alias("auc"), (val * 2 - 1).alias("gini"))


def _pair_rank_sums(df: DataFrame, quant: Sequence[str], qual: Sequence[str], min_group: int) -> DataFrame:
    """As ``ranks.group_rank_sums`` for columns of any number of groups: one long
    frame keyed by the pair."""
    items = [F.struct(F.lit(f"{q}\u0001{c}").alias("variable"), F.col(q).cast("double").alias("value"),
                      F.col(c).cast("string").alias("_g"))
             for q in quant for c in qual]
    long = (df.select(F.explode(F.array(*items)).alias("kv")).select("kv.*")
            .filter(F.col("value").isNotNull() & ~F.isnan("value") & F.col("_g").isNotNull())
            .withColumn("value", F.col("value") + F.lit(0.0)))
    sizes = long.groupBy("variable", "_g").agg(F.count(F.lit(1)).alias("_s"))
    keep = sizes.filter(F.col("_s") >= min_group).select("variable", "_g")
    rs = ranks.rank_sums(long.join(keep, ["variable", "_g"], "left_semi"))
    parts = F.split("variable", "\u0001")
    return rs.select(parts[0].alias("variable"), parts[1].alias("grouping"), "grp", "n_g", "R_g", "N", "T")


def kruskal_wallis(df: DataFrame, quant: Sequence[str], qual: Sequence[str], min_group: int = 5,
                   with_p: bool = True) -> DataFrame:
    """H9: Kruskal-Wallis H for every (quantitative, qualitative) pair.

    Groups with fewer than ``min_group`` non-null rows are dropped before ranking (as the
    original); a value moves once for all pairs it is in (``ranks.group_rank_sums``),
    and once a pair with a column of more than ``MAX_GROUPS`` groups. Pairs with
    < 2 groups or with all values tied are skipped.
    var_quant, var_qual, H, dof, n, [p_value].
    """
    few = [c for c in qual if df.select(c).distinct().limit(MAX_GROUPS + 1).count() <= MAX_GROUPS]
    rs = ranks.group_rank_sums(df, quant, few, min_group) if few else None
    if len(few) < len(qual):
        wide = _pair_rank_sums(df, quant, [c for c in qual if c not in few], min_group)
        rs = wide if rs is None else rs.unionByName(wide)
    h = rs.groupBy("variable", "grouping", "N", "T").agg(
        F.sum(F.col("R_g") * F.col("R_g") / F.col("n_g")).alias("S"), F.count(F.lit(1)).alias("k"))
    N = F.col("N").cast("double")
    num = 12.0 / (N * (N + 1)) * F.col("S") - 3 * (N + 1)
    den = 1 - F.col("T") / (F.pow(N, 3) - N)
    out = h.filter((F.col("k") >= 2) & (den > 0)).select(
        F.col("variable").alias("var_quant"), F.col("grouping").alias("var_qual"), (num / den).alias("H"),
        (F.col("k") - 1).cast("long").alias("dof"), F.col("N").cast("long").alias("n"))
    if with_p:
        out = out.withColumn("p_value", chi2_p_udf(F.col("H"), F.col("dof").cast("double")))
    return out


# ---------------------------------------------------------- chi-square / V

def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """H1: long contingency table (a, b, n), missing on either side dropped."""
    return (df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).alias("n")))


def cramers_v_long(cells: DataFrame, key: Sequence[str] = ("pair",), with_p: bool = True) -> DataFrame:
    """H2 over many tables at once. ``cells``: (key..., a, b, n) with n > 0.

    chi2 = sum over observed cells of O^2/E - n (zero cells add nothing to
    that form), except 2 x 2 tables, which get Yates' correction on the
    completed 4-cell grid. V is bias-corrected with the +1e-10 guard.
    Output: key..., r, k, n, chi2, dof, V, [p_value].
    """
    key = list(key)
    cells = written(cells, "cells")  # read by each of the joins below
    row = cells.groupBy(*key, "a").agg(F.sum("n").alias("_row"))
    col = cells.groupBy(*key, "b").agg(F.sum("n").alias("_col"))
    shape = cells.groupBy(*key).agg(F.sum("n").alias("_n"), F.countDistinct("a").alias("r"),
                                    F.countDistinct("b").alias("k"))
    # Complete the grid only for 2 x 2 tables (4 cells per key): the value
    # sets are collected only for keys already known to have 2 x 2 values.
    two = shape.filter((F.col("r") == 2) & (F.col("k") == 2)).select(*key)
    cells2 = cells.join(two, key, "left_semi")
    sets = cells2.groupBy(*key).agg(F.collect_set("a").alias("_as"), F.collect_set("b").alias("_bs"))
    grid = (sets.select(*key, F.explode("_as").alias("a"), "_bs")
            .select(*key, "a", F.explode("_bs").alias("b")))
    full = (grid.join(cells2, key + ["a", "b"], "left").fillna({"n": 0}).withColumn("_yates", F.lit(True))
            .unionByName(cells.join(two, key, "left_anti").withColumn("_yates", F.lit(False))))
    e = (full.join(row, key + ["a"]).join(col, key + ["b"]).join(shape, key)
         .withColumn("E", F.col("_row") * F.col("_col") / F.col("_n")))
    diff = F.abs(F.col("n") - F.col("E"))
    yates_term = F.pow(diff - F.least(F.lit(0.5), diff), 2) / F.col("E")
    plain_term = F.col("n") * F.col("n") / F.col("E")
    chi = e.groupBy(*key, "r", "k", "_n").agg(
        F.sum(F.when(F.col("_yates"), yates_term).otherwise(plain_term)).alias("_s"),
        F.first("_yates").alias("_y"))
    chi2 = F.when(F.col("_y"), F.col("_s")).otherwise(F.col("_s") - F.col("_n"))
    r, k = F.col("r").cast("double"), F.col("k").cast("double")
    out = chi.select(*key, "r", "k", F.col("_n").cast("long").alias("n"), chi2.alias("chi2"),
                     ((F.col("r") - 1) * (F.col("k") - 1)).cast("long").alias("dof"))
    # Bias-corrected V: association beyond what independence gives on average,
    # over the smaller dimension less its own bias; d is a dimension less one.
    free = F.nullif(F.col("n").cast("double") - 1, F.lit(0.0))
    excess = F.col("chi2") / (free + 1) - F.col("dof") / free
    smaller = F.least(*[d * (1 - d / free) for d in (r - 1, k - 1)])
    out = out.withColumn("V", F.sqrt(F.greatest(excess, F.lit(0.0)) / (smaller + 1e-10)))
    if with_p:
        out = out.withColumn("p_value", chi2_p_udf(F.col("chi2"), F.col("dof").cast("double")))
    return out


def chi2_vs_target(df: DataFrame, cols: Sequence[str], target: str = "TARGET", with_p: bool = True,
                   p_max: float = 0.05, v_min: float = 0.05) -> DataFrame:
    """H3: every qualitative column against the target in one pass.
    Columns with fewer than 2 categories are skipped."""
    long = ranks.to_long(df, cols, [F.col(target).cast("string").alias("b")], value_type="string")
    cells = (long.filter(F.col("b").isNotNull()).groupBy("variable", F.col("value").alias("a"), "b")
             .agg(F.count(F.lit(1)).alias("n")))
    out = cramers_v_long(cells, ["variable"], with_p).filter(F.col("r") >= 2)
    if with_p:
        out = out.withColumn("discriminant", (F.col("p_value") < p_max) & (F.col("V") > v_min))
    return out


def pair_cells(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(var1, var2, a, b, n) for every column pair in order: one explode of
    the pairs + one partial aggregate (categoricals: few distinct cells)."""
    pairs = [(x, y) for i, x in enumerate(cols) for y in cols[i + 1:]]
    items = [F.struct(F.lit(x).alias("var1"), F.lit(y).alias("var2"), F.col(x).cast("string").alias("a"),
                      F.col(y).cast("string").alias("b")) for x, y in pairs]
    long = df.select(F.explode(F.array(*items)).alias("p")).select("p.*")
    return (long.filter(F.col("a").isNotNull() & F.col("b").isNotNull())
            .groupBy("var1", "var2", "a", "b").agg(F.count(F.lit(1)).alias("n")))


def cramers_v_pairs(df: DataFrame, cols: Sequence[str], with_p: bool = False) -> DataFrame:
    """H8 input: V between every pair of qualitative columns."""
    out = cramers_v_long(pair_cells(df, cols), ["var1", "var2"], with_p)
    return out.filter((F.col("r") >= 2) & (F.col("k") >= 2))


# ------------------------------------------------------------- Spearman

def _spearman_matrix(data: DataFrame, cols: Sequence[str], pairs) -> list[tuple]:
    """Pearson of the mid-ranks of complete columns from their Gramian
    (``ranks.rank_products``); a constant column gives null."""
    g = ranks.rank_products(data, cols)
    pos = {c: i for i, c in enumerate(cols)}
    out = []
    for a, b in pairs:
        i, j = pos[a], pos[b]
        size = math.sqrt(g[i, i]) * math.sqrt(g[j, j])
        out.append((a, b, float(g[i, j] / size) if size > 0 else None))
    return out


def _spearman_reranked(df: DataFrame, pairs) -> DataFrame:
    """Pairs with nulls: both columns ranked over the rows that have both,
    from counts per (pair, value, value); deviations from the mean rank."""
    items = [F.struct(F.lit(i).alias("pair"), F.col(a).cast("double").alias("a"), F.col(b).cast("double").alias("b"))
             for i, (a, b) in enumerate(pairs)]
    ranks.ensure_checkpoint_dir(df.sparkSession)
    cells = (df.select(F.explode(F.array(*items)).alias("kv")).select("kv.*")
             .filter(F.col("a").isNotNull() & F.col("b").isNotNull() & ~F.isnan("a") & ~F.isnan("b"))
             .groupBy("pair", (F.col("a") + F.lit(0.0)).alias("a"), (F.col("b") + F.lit(0.0)).alias("b"))
             .agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True))
    sides = F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("value")) for s in ("a", "b")])
    tot = (cells.select("pair", "n", F.explode(sides).alias("v")).groupBy("pair", "v.side", "v.value")
           .agg(F.sum("n").alias("t")))
    cum = ranks.cumulative(tot, ("pair", "side"), "value", ("t",))
    rank = F.col("t_before") + (F.col("t") + 1) / 2.0
    out = cells
    for s in ("a", "b"):
        out = out.join(cum.filter(F.col("side") == s).select("pair", F.col("value").alias(s), rank.alias(f"r_{s}")),
                       ["pair", s])
    # size and the joined totals: one row per pair
    size = cells.groupBy("pair").agg(F.sum("n").alias("size"))
    da, db = [F.col(f"r_{s}") - (F.col("size") + 1) / 2.0 for s in ("a", "b")]
    r = (out.join(F.broadcast(size), "pair").groupBy("pair").agg(
        F.sum(F.col("n") * da * db).alias("ab"), F.sum(F.col("n") * da * da).alias("aa"),
        F.sum(F.col("n") * db * db).alias("bb"))
        .select("pair", F.try_divide(F.col("ab"), F.sqrt(F.col("aa")) * F.sqrt(F.col("bb"))).alias("r")))
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, var1 string, var2 string")
    return names.join(r, "pair", "left").select("var1", "var2", "r")


def spearman_pairs(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """H4/H5: Spearman r for every pair (Pearson on mid-ranks), over the rows
    that have both values; with ``target`` also each column against it
    (var2 = target). Columns without nulls are ranked once; pairs with nulls
    are ranked anew on their complete rows."""
    allc = list(cols) + ([target] if target else [])
    data = df.select(*allc)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    if target:
        pairs += [(c, target) for c in cols]
    x = {c: F.col(c).cast("double") for c in allc}
    lacking = data.agg(*[F.count_if(x[c].isNull() | F.isnan(x[c])).alias(c) for c in allc]).first()
    full = [c for c in allc if not lacking[c]]
    whole = [(a, b) for a, b in pairs if a in full and b in full]
    rest = [p for p in pairs if p not in whole]
    out = None
    if whole:
        found = _spearman_matrix(data, full, whole)
        out = df.sparkSession.createDataFrame(found, "var1 string, var2 string, r double")
    if rest or out is None:
        part = _spearman_reranked(data, rest) if rest else df.sparkSession.createDataFrame(
            [], "var1 string, var2 string, r double")
        out = part if out is None else out.unionByName(part)
    return out


def prune_redundant(pairs: DataFrame, strength: DataFrame, order: Sequence[str], threshold: float,
                    value: str = "r") -> DataFrame:
    """H6/H8 rule: for each pair (in column order) with |value| > threshold
    keep the column stronger on the target (tie -> the first), drop the
    other. No early exit: an already dropped column may still drop others.

    ``strength``: (variable, s). Returns var1, var2, value, s1, s2, kept, dropped.
    """
    pos = {c: i for i, c in enumerate(order)}
    pm = F.create_map(*[x for c, i in pos.items() for x in (F.lit(c), F.lit(i))])
    s1 = strength.select(F.col("variable").alias("var1"), F.col("s").alias("s1"))
    s2 = strength.select(F.col("variable").alias("var2"), F.col("s").alias("s2"))
    # strength: one row per variable (bounded by the column list).
    p = (pairs.filter(F.abs(F.col(value)) > threshold)
         .withColumn("_first", pm[F.col("var1")] < pm[F.col("var2")])
         .select(F.when(F.col("_first"), F.col("var1")).otherwise(F.col("var2")).alias("var1"),
                 F.when(F.col("_first"), F.col("var2")).otherwise(F.col("var1")).alias("var2"), value)
         .join(F.broadcast(s1), "var1", "left").join(F.broadcast(s2), "var2", "left")
         .fillna({"s1": 0.0, "s2": 0.0}))
    keep_first = F.col("s1") >= F.col("s2")
    return p.select("var1", "var2", value, "s1", "s2",
                    F.when(keep_first, F.col("var1")).otherwise(F.col("var2")).alias("kept"),
                    F.when(keep_first, F.col("var2")).otherwise(F.col("var1")).alias("dropped"))
