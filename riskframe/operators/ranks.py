"""Average ranks, cumulative counts and exact quantiles at scale.

The one primitive behind medians, quartiles, Spearman, Mann-Whitney,
Kruskal-Wallis, AUC, ROC/PR curves, KS and lift.

Plan (no task ever holds a whole variable):

1. ``long``: rows exploded to (variable, value[, group]) and pre-aggregated to
   counts per distinct value -- the map-side combine collapses low-cardinality
   columns (a binary flag becomes two rows per input partition).
2. The distinct-value table is range-partitioned on (variable, value) and
   checkpointed to the reliable checkpoint folder: range bounds are sampled,
   so a recomputed partition must not get a different id.
3. Per (partition, variable) totals -- at most P + V rows -- get prefix
   offsets with a small window and are broadcast back (bounded by the
   partition count and the number of variables, both parameters).
4. A cumulative sum inside each (partition, variable) slice finishes the
   global cumulative count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import partial, reduce
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir, written

AT_ONCE = 12  # columns that a scan turns into Arrow together


def to_long(df: DataFrame, cols: Sequence[str], extra: Sequence[str | Column] = (),
            value_type: str = "double") -> DataFrame:
    """Wide -> long (variable, value, *extra); nulls and NaN dropped.

    ``value + 0.0`` folds -0.0 into 0.0 so ties group as in pandas.
    """
    items = [F.struct(F.lit(c).alias("variable"), F.col(c).cast(value_type).alias("value"))
             for c in cols]
    extra_cols = [F.col(e) if isinstance(e, str) else e for e in extra]
    out = df.select(F.explode(F.array(*items)).alias("_kv"), *extra_cols)
    out = out.select(F.col("_kv.variable").alias("variable"), F.col("_kv.value").alias("value"),
                     *[c for c in out.columns if c != "_kv"])
    out = out.filter(F.col("value").isNotNull())
    if value_type == "double":
        out = out.filter(~F.isnan("value")).withColumn("value", F.col("value") + F.lit(0.0))
    return out


def cumulative(counts: DataFrame, key: Sequence[str] = ("variable",), order: str = "value",
               sums: Sequence[str] = ("t",), ascending: bool = True,
               partitions: int | None = None) -> DataFrame:
    """Add ``<s>_before`` = sum of ``s`` over rows of the same key strictly
    before this row in ``order``. ``counts`` must have one row per (key, order).

    One plan for every size: rows are range-partitioned on (key, order) and
    checkpointed once, so no task ever holds a whole key.
    """
    key = list(key)
    ord_col = F.col(order).asc() if ascending else F.col(order).desc()
    ensure_checkpoint_dir(counts.sparkSession)
    # Without an explicit count AQE sizes the range shuffle (coalescing
    # adjacent ranges keeps them contiguous); ids are frozen by the checkpoint.
    by = [F.col(k) for k in key] + [ord_col]
    ranged = ((counts.repartitionByRange(partitions, *by) if partitions else counts.repartitionByRange(*by))
              .withColumn("_pid", F.spark_partition_id())
              .checkpoint(eager=True))
    part_tot = ranged.groupBy("_pid", *key).agg(*[F.sum(s).alias(f"_pt_{s}") for s in sums])
    w_off = Window.partitionBy(*key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = part_tot.select(
        "_pid", *key,
        *[F.coalesce(F.sum(f"_pt_{s}").over(w_off), F.lit(0)).alias(f"_off_{s}") for s in sums])
    # offsets: at most (partitions + variables) rows -> bounded broadcast.
    joined = ranged.join(F.broadcast(offsets), ["_pid", *key])
    w_loc = (Window.partitionBy("_pid", *key).orderBy(ord_col)
             .rowsBetween(Window.unboundedPreceding, -1))
    return joined.select(
        *[c for c in ranged.columns if c != "_pid"],
        *[(F.col(f"_off_{s}") + F.coalesce(F.sum(s).over(w_loc), F.lit(0))).alias(f"{s}_before")
          for s in sums])


def rank_sums(long: DataFrame) -> DataFrame:
    """(variable, grp, n_g, R_g, N, T) of (variable, value, _g) rows: sizes and
    mid-rank sums of the groups, rows and sum(t^3 - t) over ties of the variable.

    One exchange: rows are dealt in ranges of (variable, value), so a tie lies in
    one task, and a task returns a row per variable and group with the rank sum
    within its range. R_g is linear in what lies before the range: the sum of the
    tasks' own rank sums plus each one's rows times the rows before it.
    """
    counts = (long.select("variable", "value", "_g").repartitionByRange("variable", "value")
              .groupBy("variable", "value", "_g").agg(F.count(F.lit(1)).alias("n"))
              .sortWithinPartitions("variable", "value").withColumn("pid", F.spark_partition_id()))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, seen, total, pid = None, {}, {}, 0
        empty = pd.DataFrame({"variable": [], "value": [], "_g": [], "n": [], "pid": []})
        for batch in chain(batches, [None]):
            rows = empty if batch is None else batch.to_pandas()
            if held is not None:
                rows = pd.concat([held, rows], ignore_index=True) if len(rows) else held
            held = None
            if not len(rows):
                continue
            pid = int(rows["pid"].iloc[0])
            var, x = rows["variable"].to_numpy(), rows["value"].to_numpy()
            new = np.r_[True, (var[1:] != var[:-1]) | (x[1:] != x[:-1])]
            if batch is not None:                       # the last tie may go on in the next batch
                cut = int(np.flatnonzero(new)[-1])
                rows, held, var, new = rows[:cut], rows[cut:], var[:cut], new[:cut]
                if not cut:
                    continue
            n, tie = rows["n"].to_numpy(dtype=float), np.cumsum(new) - 1
            t = np.bincount(tie, weights=n)
            start = np.flatnonzero(new)
            upto = np.cumsum(t) - t
            edges = np.flatnonzero(np.r_[True, var[start][1:] != var[start][:-1], True])
            for a, b in zip(edges[:-1], edges[1:]):
                v = var[start[a]]
                before = upto[a:b] - upto[a] + seen.get(v, 0.0)
                own = slice(start[a], start[b] if b < len(start) else len(rows))
                part = pd.DataFrame({"g": rows["_g"].to_numpy()[own], "n": n[own], "r": n[own] * (before + (t[a:b] + 1) / 2)[tie[own] - a]})
                for g, r in part.groupby("g").sum().iterrows():
                    old = total.get((v, g), (0.0, 0.0, 0.0))
                    total[v, g] = (old[0] + r["n"], old[1] + r["r"], old[2])
                g = part["g"].iloc[0]
                total[v, g] = (*total[v, g][:2], total[v, g][2] + float((t[a:b] ** 3 - t[a:b]).sum()))
                seen[v] = seen.get(v, 0.0) + float(t[a:b].sum())
        if total:
            cols = [[k[0] for k in total], [pid] * len(total), [k[1] for k in total], [int(v[0]) for v in total.values()],
                    [v[1] for v in total.values()], [v[2] for v in total.values()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.float64(), pa.float64()))],
                                             names=["variable", "pid", "grp", "n", "r", "t"])

    parts = counts.mapInArrow(summed, "variable string, pid int, grp string, n long, r double, t double")
    # a row per range, variable and group: at most (ranges + variables) x groups
    earlier = Window.partitionBy("variable").orderBy("pid").rangeBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_off", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    sums = parts.groupBy("variable", "grp").agg(F.sum("n").alias("n_g"), F.sum(F.col("r") + F.col("_off") * F.col("n")).alias("R_g"), F.sum("t").alias("_t"))
    whole = Window.partitionBy("variable")
    return sums.select("variable", "grp", "n_g", "R_g", F.sum("n_g").over(whole).alias("N"), F.sum("_t").over(whole).alias("T"))


def _thinned(chunks: list[tuple[np.ndarray, float]], points: int) -> tuple[np.ndarray, float]:
    """Weighted values put together to ``points`` values of equal weight."""
    v, w = np.concatenate([c for c, _ in chunks]), np.concatenate([np.full(len(c), x) for c, x in chunks])
    o = np.argsort(v, kind="stable")
    upto = np.cumsum(w[o])
    at = np.searchsorted(upto, (np.arange(points) + 0.5) * (upto[-1] / points))
    return v[o][np.minimum(at, len(v) - 1)], upto[-1] / points


def _portions(names: Sequence[str]) -> list[tuple[int, Sequence[str]]]:
    """The columns by ``AT_ONCE`` with the number of their first: Java methods of wider scans are too long to be compiled."""
    return [(s, names[s:s + AT_ONCE]) for s in range(0, len(names), AT_ONCE)]


def near_quantiles(data: DataFrame, names: Sequence[str], probs: Sequence[float], points: int = 2000) -> list[tuple[int, list[float]]]:
    """Of every double column the number of values and, near each of ``probs``, a value
    (null and NaN left out); exact at 0 and 1. A task sorts a batch at a time and keeps
    ``points`` values of it, and of each 16 such lists ``points`` again: the place of
    a value is off by 1 / (2 points) of the rows a level, whatever the number of rows."""
    names, probs = list(names), [float(p) for p in probs]
    sql = "v int, x array<double>, w double, n long, low double, high double"
    schema = pa.schema([("v", pa.int32()), ("x", pa.list_(pa.float64())), ("w", pa.float64()), ("n", pa.int64()), ("low", pa.float64()), ("high", pa.float64())])

    def kept(batches: Iterator[pa.RecordBatch], first: int, width: int) -> Iterator[pa.RecordBatch]:
        levels: list[list[list]] = [[[]] for _ in range(width)]
        n, low, high = [0] * width, [np.inf] * width, [-np.inf] * width
        for b in batches:
            for i in range(width):
                x = b.column(i).to_numpy(zero_copy_only=False).astype(float)
                x = np.sort(x[~np.isnan(x)])
                if not len(x):
                    continue
                n[i], low[i], high[i] = n[i] + len(x), min(low[i], x[0]), max(high[i], x[-1])
                few = len(x) <= points
                levels[i][0].append((x, 1.0) if few else (x[((np.arange(points) + 0.5) * (len(x) / points)).astype(int)], len(x) / points))
                for j, own in enumerate(levels[i]):
                    if len(own) == 16:
                        if j + 1 == len(levels[i]):
                            levels[i].append([])
                        levels[i][j + 1].append(_thinned(own, points))
                        own.clear()
        for i, own in enumerate(levels):
            for c, (x, w) in enumerate(chunk for level in own for chunk in level):
                yield pa.RecordBatch.from_arrays([pa.array([a], t) for a, t in zip((first + i, x, w, 0 if c else n[i], low[i], high[i]), schema.types)], schema=schema)

    def merged(t: pa.Table) -> pa.Table:
        lists = t.column("x").combine_chunks()
        v, w = lists.flatten().to_numpy(), np.repeat(t.column("w").to_numpy(), lists.value_lengths().to_numpy())
        o = np.argsort(v, kind="stable")
        upto = np.cumsum(w[o])
        low, high = t.column("low").to_numpy().min(), t.column("high").to_numpy().max()
        near = v[o][np.minimum(np.searchsorted(upto, np.array(probs) * upto[-1]), len(v) - 1)]
        near = [low if p <= 0 else high if p >= 1 else float(x) for p, x in zip(probs, near)]
        return pa.table({"v": t.column("v").slice(0, 1), "n": pa.array([int(t.column("n").to_numpy().sum())]), "q": pa.array([near], pa.list_(pa.float64()))})

    scans = [data.select(*own).mapInArrow(partial(kept, first=s, width=len(own)), sql) for s, own in _portions(names)]
    found = reduce(DataFrame.unionByName, scans).groupBy("v").applyInArrow(merged, "v int, n long, q array<double>").collect()  # a row per column
    out: list[tuple[int, list[float]]] = [(0, [])] * len(names)
    for r in found:
        out[r["v"]] = (r["n"], r["q"])
    return out


def _cuts(data: DataFrame, names: Sequence[str], n: int, rows: int) -> list[np.ndarray]:
    """Quantiles of every column, one for about every ``rows`` of ``n`` rows."""
    slices = max(64, min(2000, n // rows))
    probs = [i / slices for i in range(slices + 1)]
    return [np.unique(np.array(q, float)) for _, q in near_quantiles(data, names, probs, max(2000, 4 * slices))]


def _coded(b: pa.RecordBatch, names: Sequence[str], cuts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Values and their slices: odd on a cut, even between two, -1 for none."""
    mat = np.column_stack([b.column(x).to_numpy(zero_copy_only=False).astype(float) for x in names])
    code = np.full(mat.shape, -1, np.int16)
    for i, cut in enumerate(cuts):
        if len(cut):
            at = np.searchsorted(cut, mat[:, i])
            code[:, i] = np.where(np.isnan(mat[:, i]), -1, 2 * at + (cut[np.minimum(at, len(cut) - 1)] == mat[:, i]))
    return mat, code


def group_rank_sums(df: DataFrame, cols: Sequence[str], groups: Sequence[str], least: int = 1, rows: int = 50_000) -> DataFrame:
    """(variable, grouping, grp, n_g, R_g, N, T) for every column and grouping (a text
    column of few values): sizes and mid-rank sums of the groups with at least
    ``least`` rows that have the value, ranked over the rows of these groups.

    As in ``rank_products`` a value on a cut is ranked by counts alone; what lies between two cuts is sent to its slice
    once for all groupings, and a slice returns a row per group. Groups times slices pass the driver.
    """
    spark, cols, groups = df.sparkSession, list(cols), list(groups)
    names, marks = [f"_c{i}" for i in range(len(cols))], [f"_g{i}" for i in range(len(groups))]
    x = [F.col(c).cast("double") for c in cols]
    data = df.select(*[F.when(~F.isnan(v), v + F.lit(0.0)).alias(c) for v, c in zip(x, names)],
                     *[F.col(g).cast("string").alias(c) for g, c in zip(groups, marks)])
    cuts = _cuts(data, names, data.count(), rows)
    words, kept = [], []  # of each grouping its groups; which of them count for a column
    for g in marks:
        sizes = data.where(F.col(g).isNotNull()).groupBy(g).agg(*[F.count(c).alias(c) for c in names]).orderBy(g).collect()
        words.append([r[g] for r in sizes])
        kept.append(np.array([[r[c] >= max(1, least) for r in sizes] + [False] for c in names], bool))

    def marked(b: pa.RecordBatch) -> np.ndarray:
        """(rows, groupings): the number of the row's group; the last for none."""
        out = [pc.index_in(b.column(g), value_set=pa.array(w, pa.string())).fill_null(len(w)) for g, w in zip(marks, words)]
        return np.column_stack([o.to_numpy(zero_copy_only=False) for o in out]).astype(np.int16)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(cols), len(groups), widest), np.int64)
        for b in batches:
            code, group = _coded(b, names, cuts)[1], marked(b)
            for i in range(len(cols)):
                for j in range(len(groups)):
                    total[i, j] += np.bincount(code[(code[:, i] >= 0) & kept[j][i][group[:, j]], i], minlength=widest)
        v, g, c = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(a.astype(np.int32)) for a in (v, g, c)] + [pa.array(total[v, g, c])], names=["v", "g", "c", "n"])

    widest = 2 * max(len(c) for c in cuts) + 1
    size = np.zeros((len(cols), len(groups), widest))  # columns x groupings x slices
    for r in data.mapInArrow(counted, "v int, g int, c int, n long").groupBy("v", "g", "c").agg(F.sum("n").alias("n")).collect():
        size[r["v"], r["g"], r["c"]] = r["n"]
    before = np.cumsum(size, axis=2) - size
    middle = before + (size + 1) / 2

    def sums_of(parts) -> pa.RecordBatch:
        """Rows of (column, grouping, group numbers, ranks) put together by group."""
        out = [[], [], [], [], []]
        for i, j, group, rank in parts:
            n = np.bincount(group, minlength=len(words[j]) + 1)
            r = np.bincount(group, weights=rank, minlength=len(n))
            at = np.flatnonzero(n)
            for o, a in zip(out, (np.full(len(at), i), np.full(len(at), j), at, n[at], r[at])):
                o.append(a)
        types = (np.int32, np.int32, np.int32, np.int64, np.float64)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(o).astype(t) if o else np.zeros(0, t)) for o, t in zip(out, types)], names=["v", "g", "grp", "n", "r"])

    def on_cuts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, group = _coded(b, names, cuts)[1], marked(b)
            parts = []
            for i in range(len(cols)):
                for j in range(len(groups)):
                    own = np.flatnonzero((code[:, i] % 2 == 1) & (code[:, i] > 0) & kept[j][i][group[:, j]])
                    parts.append((i, j, group[own, j], middle[i, j][code[own, i]]))
            yield sums_of(parts)

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            (mat, code), group = _coded(b, names, cuts), marked(b)
            for i in range(len(cols)):
                own = np.flatnonzero((code[:, i] >= 0) & (code[:, i] % 2 == 0))
                if not len(own):
                    continue
                own = own[np.argsort(code[own, i], kind="stable")]
                c, first = np.unique(code[own, i], return_index=True)
                ends = np.r_[first, len(own)].astype(np.int32)
                packed = [group[own[s:e]].tobytes() for s, e in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(c), i, np.int32)), pa.array(c.astype(np.int32)),
                                                  pa.ListArray.from_arrays(pa.array(ends), pa.array(mat[own, i])), pa.array(packed, pa.binary())], names=["v", "c", "x", "groups"])

    def ranked(t: pa.Table) -> pa.Table:
        i, c = t.column("v")[0].as_py(), t.column("c")[0].as_py()
        values = t.column("x").combine_chunks().flatten().to_numpy()
        group = np.concatenate([np.frombuffer(p, np.int16) for p in t.column("groups").to_pylist()]).reshape(-1, len(groups))
        tie = np.unique(values, return_inverse=True)[1].ravel()
        parts, tied = [], {}
        for j in range(len(groups)):
            own = kept[j][i][group[:, j]]
            count = np.bincount(tie[own], minlength=tie.max() + 1).astype(float)
            rank = before[i, j, c] + np.cumsum(count) - count + (count + 1) / 2
            parts.append((i, j, group[own, j], rank[tie[own]]))
            tied[j] = float((count ** 3 - count).sum())
        out = sums_of(parts)
        # the ties of the slice on the first row of each grouping
        g = out.column("g").to_numpy()
        t3 = np.where(np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool), [tied[x] for x in g], 0.0)
        return pa.Table.from_batches([out]).append_column("t", pa.array(t3, pa.float64()))

    schema = "v int, g int, grp int, n long, r double"
    moved = data.mapInArrow(between, "v int, c int, x array<double>, groups binary").groupBy("v", "c").applyInArrow(ranked, schema + ", t double")
    still = data.mapInArrow(on_cuts, schema).withColumn("t", F.lit(0.0))
    found = still.unionByName(moved).groupBy("v", "g", "grp").agg(F.sum("n").alias("n"), F.sum("r").alias("r"), F.sum("t").alias("t")).collect()
    odd = size[:, :, 1::2]
    ties = (odd ** 3 - odd).sum(2)
    for r in found:
        ties[r["v"], r["g"]] += r["t"]
    total = size.sum(2)
    out = [(cols[r["v"]], groups[r["g"]], words[r["g"]][r["grp"]], r["n"], r["r"], int(total[r["v"], r["g"]]), float(ties[r["v"], r["g"]])) for r in found]
    return spark.createDataFrame(out, "variable string, grouping string, grp string, n_g long, R_g double, N long, T double")


def rank_products(df: DataFrame, cols: Sequence[str], rows: int = 50_000) -> np.ndarray:
    """Sums over the rows of the products of every two columns' mid-ranks, each less
    its mean. All columns are complete (no null or NaN).

    Quantiles (some for every ``rows`` rows) cut each column. A value on a cut is ranked by counts of the
    slices alone, so columns of few values and values that many rows share move nothing. What lies between two
    cuts goes to its slice, which is sorted in one task, and its ranks go back to the block of rows they
    come from; a block returns its sums. One exchange each way, whatever the number of columns.
    """
    spark = df.sparkSession
    cols = list(cols)
    m, names = len(cols), [f"_c{i}" for i in range(len(cols))]
    data = written(df.select(F.monotonically_increasing_id().alias("_row"),
                             *[(F.col(c).cast("double") + F.lit(0.0)).alias(x) for c, x in zip(cols, names)]), "ranked")
    n = data.count()
    cuts = _cuts(data, names, n, rows)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [np.zeros(2 * len(cut) + 1, np.int64) for cut in cuts]
        for b in batches:
            code = _coded(b, names, cuts)[1]
            for i, t in enumerate(total):
                t += np.bincount(code[:, i], minlength=len(t))
        v, c = (np.concatenate(x) for x in zip(*[(np.full(len(t), i, np.int32), np.arange(len(t), dtype=np.int32)) for i, t in enumerate(total)]))
        yield pa.RecordBatch.from_arrays([pa.array(v), pa.array(c), pa.array(np.concatenate(total))], names=["v", "c", "n"])

    size = [np.zeros(2 * len(cut) + 1, np.int64) for cut in cuts]  # columns x slices numbers
    for r in data.mapInArrow(counted, "v int, c int, n long").groupBy("v", "c").agg(F.sum("n").alias("n")).collect():
        size[r["v"]][r["c"]] = r["n"]
    before = [np.cumsum(t) - t for t in size]
    middle = [b + (t + 1) / 2 for b, t in zip(before, size)]

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The values between cuts, in lists by column, slice and block."""
        for b in batches:
            mat, code = _coded(b, names, cuts)
            row = b.column("_row").to_numpy()
            for i in range(m):
                own = np.flatnonzero(code[:, i] % 2 == 0)
                if not len(own):
                    continue
                own = own[np.lexsort((row[own] >> 16, code[own, i]))]
                block, c = row[own] >> 16, code[own, i]
                first = np.flatnonzero(np.r_[True, (c[1:] != c[:-1]) | (block[1:] != block[:-1])])
                ends = pa.array(np.r_[first, len(own)].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(first), i, np.int32)), pa.array(c[first].astype(np.int32)), pa.array(block[first]),
                     pa.ListArray.from_arrays(ends, pa.array((row[own] & 0xFFFF).astype(np.int32))),
                     pa.ListArray.from_arrays(ends, pa.array(mat[own, i]))], names=["v", "c", "block", "pos", "x"])

    ranked_schema = pa.schema([("block", pa.int64()), ("v", pa.int32()), ("pos", pa.list_(pa.int32())), ("x", pa.list_(pa.float64()))])

    def ranked(t: pa.Table) -> pa.Table:
        v, c = t.column("v")[0].as_py(), t.column("c")[0].as_py()
        lists = t.column("x").combine_chunks()
        x = lists.flatten().to_numpy()
        _, tie, count = np.unique(x, return_inverse=True, return_counts=True)
        rank = before[v][c] + (np.cumsum(count) - count + (count + 1) / 2)[tie.ravel()]
        ends = pa.array(np.r_[0, np.cumsum(lists.value_lengths().to_numpy())].astype(np.int32))
        return pa.table([t.column("block"), t.column("v"), t.column("pos"), pa.ListArray.from_arrays(ends, pa.array(rank))], schema=ranked_schema)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            code, row = _coded(b, names, cuts)[1], b.column("_row").to_numpy()
            for block in np.unique(row >> 16):
                own = row >> 16 == block
                yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([(row[own] & 0xFFFF).astype(np.int32)], pa.list_(pa.int32())),
                                                  pa.array([code[own].tobytes()], pa.binary())], names=["block", "pos", "codes"])

    def products(left: pa.Table, right: pa.Table) -> pa.Table:
        pos = np.concatenate([np.asarray(p) for p in left.column("pos").to_pylist()])
        code = np.concatenate([np.frombuffer(x, np.int16) for x in left.column("codes").to_pylist()]).reshape(-1, m)
        at = np.zeros(1 << 16, np.int64)
        at[pos] = np.arange(len(pos))
        mat = np.column_stack([middle[i][code[:, i]] for i in range(m)])
        for v, p, x in zip(right.column("v").to_pylist(), right.column("pos").combine_chunks(), right.column("x").combine_chunks()):
            mat[at[p.values.to_numpy()], v] = x.values.to_numpy()
        mat -= (n + 1) / 2
        return pa.table({"g": pa.array([(mat.T @ mat).ravel()], pa.list_(pa.float64()))})

    cells = data.mapInArrow(between, "v int, c int, block long, pos array<int>, x array<double>")
    back = cells.groupBy("v", "c").applyInArrow(ranked, "block long, v int, pos array<int>, x array<double>")
    own = data.mapInArrow(codes, "block long, pos array<int>, codes binary")
    sums = own.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(products, "g array<double>")
    out = np.zeros(m * m)  # the square of the number of columns
    for r in sums.select(F.posexplode("g").alias("i", "g")).groupBy("i").agg(F.sum("g").alias("g")).collect():
        out[r["i"]] = r["g"]
    return out.reshape(m, m)


def with_position(report: DataFrame, by: str, tie: Sequence[str], within: Sequence[str] = (), descending: bool = True,
                  out: str = "position") -> DataFrame:
    """W3 as data: ``report`` with its row's place (from 1) when sorted by the number
    ``by``, ties by the columns ``tie`` ascending, missing values last (NaN before
    null), inside each group of ``within``. Rows that ``tie`` does not tell apart
    share a place. Distributed: a report with a row per customer needs no single task."""
    x = F.col(by).cast("double")
    x = F.when(F.isnan(x), x).otherwise(-x if descending else x)
    order = F.struct(x.isNull().alias("_gap"), x.alias("_x"), *[F.col(t) for t in tie])
    keyed = report.select("*", order.alias("_order"), F.lit(1).alias("_one"), F.lit(0).alias("_all"))
    pos = cumulative(keyed, tuple(within) or ("_all",), "_order", ("_one",))
    return pos.select(*report.columns, (F.col("_one_before") + 1).cast("long").alias(out))


def rank_table(df: DataFrame, cols: Sequence[str], label: str | None = None,
               partitions: int | None = None) -> DataFrame:
    """(variable, value, t, [n1], t_before, avg_rank) over the non-null values.

    ``avg_rank`` is the mid-rank of tied values (1-based), as scipy's
    ``rankdata``/pandas ``rank(method='average')``. With ``label``, n1 counts
    rows whose label is 1 (the positive class).
    """
    extra = [F.col(label).cast("double").alias("_y")] if label else []
    long = to_long(df, cols, extra)
    if label:
        long = long.filter(F.col("_y").isNotNull())
    aggs = [F.count(F.lit(1)).alias("t")]
    if label:
        aggs.append(F.sum(F.when(F.col("_y") == 1, 1).otherwise(0)).cast("long").alias("n1"))
    counts = long.groupBy("variable", "value").agg(*aggs)
    cum = cumulative(counts, ("variable",), "value", ("t",), partitions=partitions)
    return cum.withColumn("avg_rank", F.col("t_before") + (F.col("t") + 1) / 2.0)


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    partitions: int | None = None, accuracy: int = 2000) -> DataFrame:
    """(variable, q, value): linear interpolation between order statistics,
    as pandas ``quantile`` / SQL ``percentile_cont``. Nulls and NaN skipped.

    Fast exact path, two scans and no sort of the full column:
      1. ``near_quantiles`` brackets each target rank (memory is bounded by
         ``accuracy``, whatever the row count);
      2. one scan counts the rows below each bracket, and only the
         values inside the brackets (a ~1/accuracy slice) are ranked.
    Each bracket is verified to contain both order statistics it must
    interpolate; a column failing that check (or an exotic distribution)
    falls back to the full distributed rank table. Results are exact either way.
    """
    cols = list(cols)
    probs = [float(q) for q in probs]
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "variable string, q double, value double")
    delta = 4.0 / accuracy
    names = [f"_c{i}" for i in range(len(cols))]
    data = df.select(*[F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double") + F.lit(0.0)).alias(x) for c, x in zip(cols, names)])
    lo_p = [max(0.0, q - delta) for q in probs]
    hi_p = [min(1.0, q + delta) for q in probs]
    brackets = []  # (variable, q, lo, hi, n)
    for c, (n, b) in zip(cols, near_quantiles(data, names, lo_p + hi_p, accuracy)):
        if not n:
            continue
        for j, q in enumerate(probs):
            brackets.append((c, q, float(b[j]), float(b[len(probs) + j]), int(n)))
    if not brackets:
        return spark.createDataFrame([], "variable string, q double, value double")
    found_at = [(k, cols.index(c), lo, hi) for k, (c, _, lo, hi, _) in enumerate(brackets)]

    def bracketed(batches: Iterator[pa.RecordBatch], first: int, width: int) -> Iterator[pa.RecordBatch]:
        """The bracketed values with their counts; without a value the rows strictly below."""
        below = np.zeros(len(found_at), np.int64)
        for b in batches:
            mat: dict[int, np.ndarray] = {}
            for k, at, lo, hi in found_at:
                i = at - first
                if not 0 <= i < width:
                    continue
                if i not in mat:
                    mat[i] = b.column(i).to_numpy(zero_copy_only=False).astype(float)
                below[k] += np.count_nonzero(mat[i] < lo)
                v, t = np.unique(mat[i][(mat[i] >= lo) & (mat[i] <= hi)], return_counts=True)
                if len(v):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), k, np.int32)), pa.array(v), pa.array(t.astype(np.int64))], names=["_k", "value", "t"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(below), dtype=np.int32)), pa.nulls(len(below), pa.float64()), pa.array(below)], names=["_k", "value", "t"])

    # only in-bracket values are emitted: ~1/accuracy of the rows per target
    scans = [data.select(*own).mapInArrow(partial(bracketed, first=s, width=len(own)), "_k int, value double, t long") for s, own in _portions(names)]
    counts = written(reduce(DataFrame.unionByName, scans).groupBy("_k", "value").agg(F.sum("t").alias("t")), "brackets")
    below = {r["_k"]: r["t"] for r in counts.where(F.col("value").isNull()).collect()}  # a row per column and probability
    counts = counts.where(F.col("value").isNotNull())
    tab = []
    for k, (c, q, lo, hi, n) in enumerate(brackets):
        h = q * (n - 1)
        tab.append((k, c, q, float(h), int(math.floor(h)), int(math.ceil(h)), int(below.get(k, 0))))
    meta = spark.createDataFrame(tab, "_k int, variable string, q double, h double, i_lo long, i_hi long, c_lo long")
    # meta: one row per (column, probability) -- bounded by the arguments.
    cum = cumulative(counts, ("_k",), "value", ("t",), partitions=partitions).join(F.broadcast(meta), "_k")
    pos = F.col("c_lo") + F.col("t_before")
    picked = cum.groupBy("_k", "variable", "q", "h", "i_lo", "i_hi", "c_lo").agg(
        F.sum("t").alias("n_in"),
        F.max(F.when((F.col("i_lo") >= pos) & (F.col("i_lo") < pos + F.col("t")), F.col("value"))).alias("v_lo"),
        F.max(F.when((F.col("i_hi") >= pos) & (F.col("i_hi") < pos + F.col("t")), F.col("value"))).alias("v_hi"))
    res = picked.select("variable", "q", (F.col("v_lo") + (F.col("v_hi") - F.col("v_lo"))
                                          * (F.col("h") - F.col("i_lo"))).alias("value"),
                        (F.col("v_lo").isNotNull() & F.col("v_hi").isNotNull()).alias("_ok")).collect()
    good = {(r["variable"], r["q"]): r["value"] for r in res if r["_ok"]}
    missing = sorted({c for (c, q, *_r) in brackets if (c, q) not in good})
    rows = [(c, q, v) for (c, q), v in good.items() if c not in missing]
    out = spark.createDataFrame(rows, "variable string, q double, value double")
    if missing:
        out = out.unionByName(quantiles_from_ranks(rank_table(df, missing, partitions=partitions), probs))
    return out


def quantiles_from_ranks(ranks: DataFrame, probs: Sequence[float]) -> DataFrame:
    n = ranks.groupBy("variable").agg(F.sum("t").alias("_n"))
    qs = F.array(*[F.lit(float(q)) for q in probs])
    targets = (n.select("variable", "_n", F.explode(qs).alias("q"))
               .withColumn("_h", F.col("q") * (F.col("_n") - 1))
               .withColumn("_lo", F.floor("_h"))
               .withColumn("_frac", F.col("_h") - F.col("_lo"))
               .withColumn("_hi", F.ceil("_h")))
    idx = targets.select("variable", "q", "_frac",
                         F.explode(F.array(
                             F.struct(F.lit(0).alias("which"), F.col("_lo").alias("idx")),
                             F.struct(F.lit(1).alias("which"), F.col("_hi").alias("idx")))).alias("_w"))
    idx = idx.select(F.col("variable").alias("_tvar"), "q", "_frac", "_w.which", "_w.idx")
    hit = ranks.select("variable", "value", "t", "t_before").join(
        F.broadcast(idx),
        (F.col("variable") == F.col("_tvar")) & (F.col("idx") >= F.col("t_before"))
        & (F.col("idx") < F.col("t_before") + F.col("t")),
    ).select("variable", "q", "_frac", "which", "value")
    agg = hit.groupBy("variable", "q").agg(
        F.max(F.when(F.col("which") == 0, F.col("value"))).alias("_v0"),
        F.max(F.when(F.col("which") == 1, F.col("value"))).alias("_v1"),
        F.first("_frac").alias("_frac"))
    return agg.select("variable", "q",
                      (F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_frac")).alias("value"))


def quantile_map(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict:
    """{(variable, q): value} collected: V x Q numbers, used to build literals."""
    rows = exact_quantiles(df, cols, probs).collect()
    return {(r["variable"], round(r["q"], 12)): r["value"] for r in rows}


def attach_ranks(df: DataFrame, cols: Sequence[str], suffix: str = "_rank",
                 broadcast_max_rows: int = 2_000_000) -> DataFrame:
    """Row-level average ranks (W1) for ``cols``: one equi-join per column on
    its value.

    The distinct-value count of every column comes from one grouped count of
    the rank table; the smallest rank tables are broadcast as long as all of
    them together have at most ``broadcast_max_rows`` rows, for the others the
    planner shuffles (AQE's skew handling splits a hot value on the row side).
    """
    ranks = rank_table(df, cols).select("variable", "value", "avg_rank")
    sizes = {r["variable"]: r["n"] for r in ranks.groupBy("variable").agg(F.count(F.lit(1)).alias("n")).collect()}
    small, held = set(), 0
    for c in sorted(cols, key=lambda c: (sizes.get(c, 0), c)):
        held += sizes.get(c, 0)
        if held <= broadcast_max_rows:
            small.add(c)
    out = df
    for c in cols:
        r = ranks.filter(F.col("variable") == c).select(
            F.col("value").alias(f"_v_{c}"), F.col("avg_rank").alias(f"{c}{suffix}"))
        if c in small:
            r = F.broadcast(r)
        key = F.col(c).cast("double") + F.lit(0.0)
        out = out.join(r, key == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
    return out
