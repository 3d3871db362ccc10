"""Five-step statistical variable selection.

Each step is a distributed test whose result is one row per variable (or
pair); only those short lists of names come back to the driver, as the
barrier between steps. The data never leave the cluster.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import stats

FUNNEL_SCHEMA = "step int, variable string, decision string, reason string"


@dataclass
class Selection:
    step1: DataFrame
    step2: DataFrame
    step3: DataFrame
    step4: DataFrame | None
    step5: DataFrame | None
    final: list[str]
    funnel: DataFrame


def _p(row) -> float:
    """The p-value of a test row; a constant column has none and is not significant."""
    p = row["p_value"]
    return 1.0 if p is None or p != p else p


def select_variables(df: DataFrame, quant: Sequence[str], qual: Sequence[str], target: str = "TARGET",
                     forced: Sequence[str] = (), p_max: float = 0.05, v_min: float = 0.05,
                     r_max: float = 0.80, v_inter_max: float = 0.70) -> Selection:
    spark = df.sparkSession
    names, df = df.columns, df.select(*dict.fromkeys([*quant, *qual, target])).persist()
    rows = []
    # 1. chi-square + V of each qualitative variable against the target
    s1 = stats.chi2_vs_target(df, qual, target, True, p_max, v_min).persist()
    r1 = s1.select("variable", "V", "p_value", "discriminant").collect()
    v_target = {r["variable"]: r["V"] for r in r1}
    qual_ok = [c for c in qual if any(r["variable"] == c and r["discriminant"] for r in r1)]
    for r in r1:
        rows.append((1, r["variable"], "keep" if r["discriminant"] else "drop",
                     f"p={r['p_value']:.3g} V={r['V']:.4f}"))
    # 2. Spearman redundancy among quantitative variables
    sp = stats.spearman_pairs(df, quant, target).persist()
    strength = sp.filter(F.col("var2") == target).select(F.col("var1").alias("variable"),
                                                         F.abs("r").alias("s"))
    s2 = stats.prune_redundant(sp.filter(F.col("var2") != target), strength, quant, r_max).persist()
    dropped2 = sorted({r["dropped"] for r in s2.select("dropped").collect()})
    for c in dropped2:
        rows.append((2, c, "drop", f"|spearman| > {r_max} with a stronger variable"))
    # 3. Mann-Whitney on the survivors
    remain = [c for c in quant if c not in dropped2]
    s3 = stats.mann_whitney(df, remain, target).persist() if remain else None
    p3 = {r["variable"]: _p(r) for r in s3.select("variable", "p_value").collect()} if s3 is not None else {}
    quant_ok = [c for c in remain if p3.get(c, 1.0) < p_max]
    for c, p in p3.items():
        rows.append((3, c, "keep" if p < p_max else "drop", f"p={p:.3g}"))
    # 4. V between the kept qualitative variables
    s4, dropped4 = None, []
    if len(qual_ok) >= 2:
        pv = stats.cramers_v_pairs(df, qual_ok)
        strength4 = spark.createDataFrame([(k, float(v)) for k, v in v_target.items()], "variable string, s double")
        s4 = stats.prune_redundant(pv, strength4, qual_ok, v_inter_max, value="V").persist()
        dropped4 = sorted({r["dropped"] for r in s4.select("dropped").collect()})
        for c in dropped4:
            rows.append((4, c, "drop", f"V > {v_inter_max} with a stronger variable"))
    qual_final = [c for c in qual_ok if c not in dropped4]
    # 5. Kruskal-Wallis links (report only)
    s5 = stats.kruskal_wallis(df, quant_ok, qual_final) if quant_ok and qual_final else None
    if s5 is not None:
        for r in s5.select("var_quant", "var_qual", "p_value").collect():
            rows.append((5, f"{r['var_quant']}x{r['var_qual']}", "link" if _p(r) < p_max else "none", f"p={_p(r):.3g}"))
    final = quant_ok + qual_final
    for f in forced:
        if f not in final and f in names:
            final.append(f)
            rows.append((6, f, "forced", "engineered feature kept by rule"))
    for f in final:
        rows.append((7, f, "final", "selected"))
    funnel = spark.createDataFrame(rows, FUNNEL_SCHEMA)
    return Selection(s1, s2, s3, s4, s5, final, funnel)
