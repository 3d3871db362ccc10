"""Cut points of a keyed order without ranking rows (below G3 and the folds of I5).

A split of exact size needs only the few key values at which one side ends,
not the position of every row. ``cut_points`` finds them by counting: the
60-bit keys are counted by their first 15 bits, each wanted position falls
into one such bucket, and only the rows of those buckets (about one in
32,768 per cut) are counted further, by the next 15 bits, until the key
itself is known. Base rows are scanned twice and neither shuffled nor sorted
nor written; applying the cuts is a narrow projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.neighbours import keyed_draw
from riskframe.session import ensure_checkpoint_dir

DIGIT = 15               # bits counted in one pass
BITS = 4 * DIGIT


def hash_key(key: str, seed: int) -> Column:
    """60 bits of md5('<key>:<seed>') as a long: the same in every engine, so the
    rows of a side can be checked. A null key counts as an empty one."""
    return keyed_draw(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(str(seed)))


def _digit(level: int) -> Column:
    return F.shiftright(F.col("_h"), BITS - DIGIT * (level + 1))


def cut_points(df: DataFrame, group: str, key: Column, positions: Mapping) -> dict:
    """For every group value and each of its wanted positions p the key below
    which exactly p rows of the group lie.

    ``positions`` maps a group value (None for nulls) to ascending positions;
    one entry per class, so the result and the plan are small. Position 0 gives
    the cut 0, the group's size or more gives 2**60. Rows of one key stay
    together: where they straddle a position all of them lie above the cut.
    """
    # (group, cut number) -> [prefix found so far, rows below it, wanted position]
    open_ = {(g, i): [0, 0, p] for g, ps in positions.items() for i, p in enumerate(ps) if p > 0}
    found = {(g, i): 0 for g, ps in positions.items() for i, p in enumerate(ps) if p <= 0}
    rows = df.select(F.col(group).alias("_g"), key.alias("_h"))
    ensure_checkpoint_dir(df.sparkSession)
    for level in range(BITS // DIGIT):
        if not open_:
            break
        prefix = F.shiftright(_digit(level), DIGIT)
        counts = rows.groupBy("_g", prefix.alias("_p"), _digit(level).alias("_d")).count()
        # at most 2**15 counts of one (group, prefix) share a window
        w = Window.partitionBy("_g", "_p").orderBy("_d")
        counts = counts.withColumn("_upto", F.sum("count").over(w))
        wanted = None
        for (g, i), (pre, below, p) in open_.items():
            hit = (F.col("_g").eqNullSafe(F.lit(g)) & (F.col("_p") == pre)
                   & (F.col("_upto") > p - below) & (F.col("_upto") - F.col("count") <= p - below))
            wanted = hit if wanted is None else wanted | hit
        cells = counts.filter(wanted).collect()      # a cell per cut
        nxt = {}
        for (g, i), (pre, below, p) in open_.items():
            cell = [r for r in cells if r["_g"] == g and r["_p"] == pre
                    and r["_upto"] - r["count"] <= p - below < r["_upto"]]
            if not cell:                             # fewer rows than the position
                found[g, i] = 1 << BITS
                continue
            nxt[g, i] = [cell[0]["_d"], below + cell[0]["_upto"] - cell[0]["count"], p]
        open_ = nxt
        if level == 0 and open_:
            keep = None
            for (g, i), (pre, _, _) in open_.items():
                one = F.col("_g").eqNullSafe(F.lit(g)) & (_digit(0) == pre)
                keep = one if keep is None else keep | one
            rows = rows.filter(keep).checkpoint()    # the buckets of the cuts only
    found |= {gi: state[0] for gi, state in open_.items()}
    return {g: [found[g, i] for i in range(len(ps))] for g, ps in positions.items()}


def side_of(group: str, key: Column, cuts: Mapping) -> Column:
    """Number of cuts of the row's group at or below its key: 0 before the first."""
    out = None
    for g, cs in cuts.items():
        n = sum(((key >= F.lit(c)).cast("int") for c in cs), F.lit(0))
        hit = F.col(group).eqNullSafe(F.lit(g))
        out = F.when(hit, n) if out is None else out.when(hit, n)
    return F.lit(0) if out is None else out


def class_sizes(df: DataFrame, group: str) -> dict:
    """{group value: rows}, one entry per class."""
    return {r[0]: r[1] for r in df.groupBy(group).count().collect()}


def deal_sizes(n: int, k: int) -> Sequence[int]:
    """Ends of the first k - 1 of k parts of n rows, the larger parts first."""
    ends, at = [], 0
    for part in range(k - 1):
        at += (n - part + k - 1) // k
        ends.append(at)
    return ends
