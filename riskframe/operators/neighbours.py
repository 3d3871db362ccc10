"""Exact k nearest neighbours (G6), SMOTE (G5) and KNN imputation.

G6 and G5 run on the pivot-partitioned join of ``pivots``. E3's distance is no
metric (it skips what is missing), so its plan is another: donors are cut into
regions along the columns that are least often missing, a query is searched in
its own region, by pattern of missing columns, and then only in the regions that
can hold a nearer donor. Each side is shuffled once per search, no pair row is
materialised, and a query that its own region settles returns its values
only; disk grows with the table.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.pivots import leaves_of, metric_join, numbers
from riskframe.operators.ranks import cumulative
from riskframe.operators.regions import NARROW, region_join
from riskframe.session import ensure_checkpoint_dir, written

SAMPLE = 20_000  # rows from which the cuts of E3's regions are taken


def knn(queries: DataFrame, donors: DataFrame, id_col: str, vec_col: str, k: int = 5,
        same: str | None = None, exclude_self: bool = True, cell_rows: int = 20000) -> DataFrame:
    """(qid, nid, dist, rank) -- the k nearest donors of each query by
    Euclidean distance, optionally only donors with the same ``same`` value
    (SMOTE: same class; null equals null), excluding the query itself.

    Equal distances go to the smaller id. Rows whose vector is null, empty or
    holds null or non-finite components take no part, and vectors of different
    lengths are no neighbours. The plan is ``regions.region_join`` for vectors of
    few components, ``pivots.metric_join`` for others.
    """
    group = F.to_json(F.struct(F.col(same).alias("g"), F.size("_v").alias("n"))) if same else F.size("_v").cast("string")
    ensure_checkpoint_dir(queries.sparkSession)

    def side(df: DataFrame) -> DataFrame:  # read several times: cut the lineage first
        rows = df.withColumn("_v", F.col(vec_col).cast("array<double>")).select(F.col(id_col).cast("long").alias("_id"), "_v", group.alias("_g"))
        finite = F.forall("_v", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
        return rows.filter((F.size("_v") > 0) & finite).checkpoint(eager=True)

    d_rows = side(donors)
    q_rows = d_rows if queries is donors else side(queries)
    widest = d_rows.agg(F.max(F.size("_v"))).first()[0] or 1
    if widest <= NARROW:
        return region_join(q_rows, d_rows, k, exclude_self, cell_rows, widest)
    return metric_join(q_rows, d_rows, k, exclude_self, cell_rows)


def keyed_draw(*parts) -> Column:
    """A long of 0 to 2^60 - 1: the first 15 hex digits of md5 of the parts,
    as text, joined by colons."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 15), 16, 10).cast("long")


def smote(train: DataFrame, id_col: str, vec_col: str, target: str, k: int = 5, seed: int = 42,
          cell_rows: int = 20000) -> DataFrame:
    """Grow the minority class to the majority size.

    new = x + u * (neighbour - x), neighbour one of the k nearest minority
    rows. Each minority row makes q or q + 1 copies (q, r = divmod(deficit,
    n_minority); the r extra copies go to the rows first in hash order);
    order, neighbour choice and u come from md5 of id, copy and seed
    (``keyed_draw``), so the result does not depend on partitioning or retries
    and another engine can repeat it. Output: id (negative for
    synthetic rows), vector, target, synthetic flag.
    """
    counts = {r[0]: r[1] for r in train.groupBy(target).count().collect()}
    minor, n_min = min(counts.items(), key=lambda kv: (kv[1], kv[0]))
    n_maj = max(counts.values())
    deficit = n_maj - n_min
    base = train.select(F.col(id_col).alias("_id"), F.col(vec_col).cast("array<double>").alias("_v"),
                        F.col(target).alias("_y"))
    if deficit <= 0:
        return base.withColumn("synthetic", F.lit(False))
    mino = base.filter(F.col("_y") == minor)
    if n_min < 2:
        raise ValueError("SMOTE needs two minority rows at least")
    near = min(k, n_min - 1)  # neighbours that exist
    q, r = divmod(deficit, n_min)
    pos = cumulative(mino.withColumn("_h", keyed_draw("_id", F.lit(seed))).withColumn("variable", F.lit(1))
                     .withColumn("_one", F.lit(1)), ("variable",), "_h", ("_one",))
    # synthetic ids count down from -1 by position and copy
    copies = pos.withColumn("_c", F.lit(q) + (F.col("_one_before") < r).cast("int")).filter(F.col("_c") > 0)
    nn = knn(mino, mino, "_id", "_v", k=near, cell_rows=cell_rows).select(
        F.col("qid").alias("_id"), F.col("rank").alias("_nr"), F.col("nid"))
    draws = copies.select("_id", "_v", "_one_before", F.explode(F.sequence(F.lit(1), F.col("_c"))).alias("_j")) \
        .withColumn("_nr", (F.pmod(keyed_draw("_id", "_j", F.lit(seed)), F.lit(near)) + 1).cast("int")) \
        .withColumn("_u", F.pmod(keyed_draw("_id", "_j", F.lit(seed + 1)), F.lit(1 << 30)) / float(1 << 30))
    nbr_v = mino.select(F.col("_id").alias("nid"), F.col("_v").alias("_nv"))
    syn = (draws.join(nn, ["_id", "_nr"]).join(nbr_v, "nid")
           .select((-(F.col("_one_before") * (q + 1) + F.col("_j"))).alias("_id"),
                   F.zip_with("_v", "_nv", lambda a, b: a + F.col("_u") * (b - a)).alias("_v"),
                   F.lit(minor).alias("_y")))
    return (base.withColumn("synthetic", F.lit(False))
            .unionByName(syn.withColumn("synthetic", F.lit(True)))
            .select(F.col("_id").alias(id_col), F.col("_v").alias(vec_col), F.col("_y").alias(target),
                    "synthetic"))


def _smallest(d2: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the ``k`` smallest of each row, ties to the smaller id."""
    n = d2.shape[1]
    cc = min(k + 8, n)
    idx = np.argpartition(d2, cc - 1, axis=1)[:, :cc]
    near = np.take_along_axis(d2, idx, 1)
    order = np.lexsort((ids[idx], near), axis=1)[:, :min(k, cc)]
    out = np.take_along_axis(idx, order, 1)
    kth = np.take_along_axis(near, order, 1)[:, -1]
    tied = np.flatnonzero((cc < n) & (kth >= near.max(1)) & np.isfinite(kth))  # ties may go on outside
    if len(tied):
        out[tied] = np.lexsort((np.broadcast_to(ids, (len(tied), n)), d2[tied]), axis=1)[:, :out.shape[1]]
    return out


def _nearest_squares(q_mat, bound, ids, mat, k, window, batch_elems):
    """(squared distances, donor numbers) of the k donors nearest to each query,
    ties to the smaller id; donors beyond ``bound`` (squared) may be missing.

    Donors are halved to leaves of at most ``window`` rows with a bounding box. A query
    searches the leaf on its side of every cut, then those whose box is not beyond
    the k-th distance it has. No matrix has more than about ``batch_elems`` numbers."""
    order, first, q_order, home = leaves_of(mat, q_mat, window)
    last = np.r_[first[1:], len(ids)]
    ids, mat = ids[order], mat[order]
    low, high = np.minimum.reduceat(mat, first), np.maximum.reduceat(mat, first)
    best, at, bound = np.full((len(q_mat), k), np.inf), np.zeros((len(q_mat), k), np.int64), bound * (1 + 1e-12)

    def visit(rows: np.ndarray, c: int) -> None:
        own = slice(first[c], last[c])
        d2 = np.zeros((len(rows), last[c] - first[c]))
        for x in range(mat.shape[1]):
            diff = q_mat[rows, x][:, None] - mat[None, own, x]
            d2 += diff * diff
        near = d2.min(1) <= bound[rows]
        rows, d2 = rows[near], d2[near]
        if not len(rows):
            return
        new = _smallest(d2, ids[own], k)
        both, both_at = np.hstack([best[rows], np.take_along_axis(d2, new, 1)]), np.hstack([at[rows], new + first[c]])
        o = np.lexsort((ids[both_at], both), axis=1)[:, :k]
        best[rows], at[rows] = np.take_along_axis(both, o, 1), np.take_along_axis(both_at, o, 1)
        bound[rows] = np.minimum(bound[rows], best[rows, -1])

    step = max(1, min(1024, batch_elems // max(len(first), min(window, len(ids)))))
    for s in range(0, len(q_order), step):
        rows, own = q_order[s:s + step], home[s:s + step]
        for c in np.unique(own):
            visit(rows[own == c], c)
        if len(first) == 1:
            continue
        box = np.zeros((len(rows), len(first)))
        for x in range(mat.shape[1]):
            v = q_mat[rows, x][:, None]
            box += np.maximum(np.maximum(low[None, :, x] - v, v - high[None, :, x]), 0) ** 2
        box *= 1 - 1e-12
        box[np.arange(len(rows)), own] = np.inf
        for c in np.flatnonzero((box <= bound[rows][:, None]).any(0)):
            hit = rows[(box[:, c] <= bound[rows]) & np.isfinite(box[:, c])]
            if len(hit):
                visit(hit, c)
    return best, order[at]


def _impute_best(q_mat, ids, mat, k, window, batch_elems, limit=None):
    """(squares, donor numbers), both (queries, columns, k): the nearest donors that
    have the column, for every missing cell of every query; infinite where there are
    fewer. What is beyond ``limit`` (queries x columns, squared) may be missing.

    Rows are taken by their pattern: which columns are missing, finite or infinite.
    Within a pair of patterns the shared columns are the same for all, so the
    missing-aware distance is Euclidean there but for a factor. Infinite components
    are shared with nothing: equal ones cancel out, others make the distance infinite.
    """
    n, m = q_mat.shape
    best, at = np.full((n, m, k), np.inf), np.zeros((n, m, k), np.int64)
    limit = np.full((n, m), np.inf) if limit is None else limit

    def patterns(a: np.ndarray):
        state = np.where(np.isnan(a), 0, np.where(np.isfinite(a), 1, np.where(a > 0, 2, 3))).astype(np.int8)
        kinds, of = np.unique(state, axis=0, return_inverse=True)
        return [(kind, np.flatnonzero(of.ravel() == i)) for i, kind in enumerate(kinds)]

    donors = patterns(mat)
    for have, rows in patterns(q_mat):
        pairs = []
        for other, own in donors:
            both = (have == 1) & (other == 1)
            needed = np.flatnonzero((have == 0) & (other != 0))
            if both.any() and len(needed) and not ((have != 0) & (other != 0) & (have != other)).any():
                pairs.append((int(both.sum()), np.flatnonzero(both), needed, own))
        for shared, cols, needed, own in sorted(pairs, key=lambda p: p[0]):
            bound = np.max([np.minimum(best[rows, j, -1], limit[rows, j]) for j in needed], axis=0)
            weight = m / shared
            d2, which = _nearest_squares(q_mat[np.ix_(rows, cols)], bound / weight, ids[own], mat[np.ix_(own, cols)], k, window, batch_elems)
            d2, which = d2 * weight, own[which]
            for j in needed:
                both, both_at = np.hstack([best[rows, j], d2]), np.hstack([at[rows, j], which])
                o = np.lexsort((ids[both_at], both), axis=1)[:, :k]
                best[rows, j], at[rows, j] = np.take_along_axis(both, o, 1), np.take_along_axis(both_at, o, 1)
    return best, at


def _impute_kernel(q_ids, q_mat, ids, mat, k, m, window, batch_elems, limit=None):
    """Exact candidates (qid, col, nid, dist, val) of the queries among one
    block of donors, for every missing cell of every query (``_impute_best``).
    ``dist`` is the root of the squares by which candidates are ordered."""
    best, at = _impute_best(q_mat, ids, mat, k, window, batch_elems, limit)
    row, col, r = np.nonzero(np.isfinite(best))
    if not len(row):
        return None
    nid = at[row, col, r]
    return pd.DataFrame({"qid": q_ids[row], "col": col.astype(np.int32), "nid": ids[nid], "dist": np.sqrt(best[row, col, r]),
                         "val": mat[nid, col], "d2": best[row, col, r]})


def _region_tree(sample: np.ndarray, scale: float, rows: float, first: Sequence[int]):
    """Cuts of space into regions of about ``rows`` rows, from a sample of which a
    row stands for ``scale``: nested (column, cut, below, from the cut on, without
    the column), a number for a region. The columns ``first`` are cut as long as a row
    has them, widest first. The sample decides how even the regions are, nothing else."""
    number = count()

    def grow(at: np.ndarray, left: tuple):
        if len(at) * scale > rows:
            for own in ([c for c in left if c in first], [c for c in left if c not in first]):
                values = {c: at[np.isfinite(at[:, c]), c] for c in own}
                spread = {c: float(np.ptp(v)) for c, v in values.items() if len(v) and np.ptp(v) > 0}
                if not spread:
                    continue
                c = max(spread, key=spread.get)
                cut = np.median(values[c])
                if not (values[c] < cut).any():
                    cut = values[c][values[c] > cut].min()
                v = at[:, c]
                return c, float(cut), grow(at[v < cut], left), grow(at[v >= cut], left), grow(at[np.isnan(v)], tuple(x for x in left if x != c))
        return next(number)

    return grow(sample, tuple(range(sample.shape[1])))


def _region_of(tree, mat: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(mat), np.int32), [(tree, np.arange(len(mat)))]
    while todo:
        node, rows = todo.pop()
        if not isinstance(node, tuple):
            out[rows] = node
            continue
        c, cut, *parts = node
        v = mat[rows, c]
        for part, own in zip(parts, (v < cut, v >= cut, np.isnan(v))):
            if own.any():
                todo.append((part, rows[own]))
    return out


def _anchor(mat: np.ndarray, order: Sequence[int]) -> np.ndarray:
    """Number of the first two columns in ``order`` that a row has; -1 for none."""
    m = len(order)
    have = ~np.isnan(mat[:, list(order)])
    one = have.argmax(1)
    rest = have & (np.arange(m)[None, :] != one[:, None])
    return np.where(have.any(1), one * m + np.where(rest.any(1), rest.argmax(1), one), -1)


def _beyond_home(q_mat, kth, low, high, always, ever, batch: int = 2000):
    """(row, region) pairs that may hold a donor not beyond the k-th square of a
    column the row lacks. A donor of a region has all columns of ``always`` and at
    most those of ``ever``; the weight columns / shared is least for the latter."""
    m, out = q_mat.shape[1], [np.zeros((0, 2), np.int64)]
    for s in range(0, len(q_mat), batch):
        q, limit = q_mat[s:s + batch], kth[s:s + batch]
        have = ~np.isnan(q)
        shared = have.astype(np.int64) @ ever.T.astype(np.int64)
        gap, bound = np.zeros(shared.shape), np.full(shared.shape, -np.inf)
        for c in range(m):
            x = q[:, c][:, None]
            both = have[:, c][:, None] & always[None, :, c]
            off = np.maximum(np.maximum(low[None, :, c] - x, x - high[None, :, c]), 0.0)
            gap += np.where(both, off * off, 0.0)
            bound = np.maximum(bound, np.where(~have[:, c][:, None] & ever[None, :, c], limit[:, c][:, None], -np.inf))
        at = np.argwhere((shared > 0) & (gap * (m / np.maximum(shared, 1)) * (1 - 1e-9) <= bound))
        out.append(at + [s, 0])
    return np.concatenate(out)


def knn_impute(df: DataFrame, id_col: str, columns: Sequence[str], k: int = 5,
               cell_rows: int = 200_000, window: int = 128, batch_elems: int = 2 << 20) -> DataFrame:
    """Fill each missing cell with the mean of that column over the k
    nearest rows that have it, under the missing-aware Euclidean distance
    sqrt(n_cols / n_shared * sum over shared columns (a - b)^2). No usable
    donor -> the column mean. Only rows with a missing cell are queries.

    Space is cut into regions of at most about ``cell_rows`` donors along the columns
    that are least often missing (``_region_tree``). A query is searched among the
    donors of its own region (``_impute_best``); its k-th distances there say which
    other regions can hold nearer donors, few of them or none, and only a query
    that has such regions is sent on and returns candidates. Queries that lack
    the columns of the cuts have a tree of their own, with a copy of
    the donors, where that is less than sending them to every region. The result equals brute force.
    """
    cols = list(columns)
    m = len(cols)
    names = [f"_c{j}" for j in range(m)]
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # Read several times: cut the lineage first.
    base = df.select(F.col(id_col).cast("long").alias("_id"),
                     *[F.col(c).cast("double").alias(n) for c, n in zip(cols, names)]).checkpoint(eager=True)
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in cols]).first()
    absent = [F.col(n).isNull() | F.isnan(n) for n in names]
    found = base.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(x).alias(n) for x, n in zip(absent, names)]).first()
    n, order = found["n"], sorted(range(m), key=lambda j: found[names[j]])
    spread = 4 * spark.sparkContext.defaultParallelism
    rows = min(cell_rows, max(5000, n // 64))
    lacking = F.exists(F.array(*names), lambda x: x.isNull()) & F.col("_id").isNotNull()
    # rows of one id fill each other's cells from their candidates taken together
    several = base.groupBy("_id").agg(F.count(F.lit(1)).alias("_n")).where((F.col("_n") > 1) & F.col("_id").isNotNull())
    several = several.select("_id", F.lit(True).alias("_several"))
    queries = base.where(lacking)
    queries = queries.withColumn("_several", F.lit(False)) if several.isEmpty() else (
        queries.join(several, "_id", "left").withColumn("_several", F.coalesce("_several", F.lit(False))))

    def matrix(t) -> np.ndarray:
        return np.column_stack([numbers(t, c).astype(np.float64) for c in names])

    def ids_of(t) -> np.ndarray:  # rows without an id come last among equals
        return t.column("_id").combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kind, size = np.unique(_anchor(matrix(pa.Table.from_batches([b])), order), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(size.astype(np.int64))], names=["kind", "n"])

    # at most columns^2 / 2 kinds
    kinds = {r["kind"]: r["n"] for r in queries.select(*names).mapInArrow(anchors, "kind int, n long").groupBy("kind").agg(F.sum("n").alias("n")).collect()
             if r["kind"] >= 0}
    main = max(kinds, key=lambda x: (kinds[x], -x), default=0)
    own_tree = [main] + [x for x in sorted(kinds) if x != main and kinds[x] * n > rows * n]
    sample = base.select(*names).orderBy(F.xxhash64("_id", *names)).limit(SAMPLE).toArrow()
    points = matrix(sample) if sample.num_rows else np.zeros((0, m))
    trees = [_region_tree(points, n / max(1, len(points)), rows, [order[x // m], order[x % m]]) for x in own_tree]
    tree_of = {x: t for t, x in enumerate(own_tree)}
    place = [("_t", pa.int32()), ("_b", pa.int32())]
    values = [("_id", pa.int64()), *[(c, pa.float64()) for c in names]]
    values_sql = "_id long, " + ", ".join(f"{c} double" for c in names)

    def donors_dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mat = matrix(pa.Table.from_batches([b]))
            for t, tree in enumerate(trees):
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(len(mat), t, np.int32)), pa.array(_region_of(tree, mat))],
                                                 names=[*b.schema.names, "_t", "_b"])

    def queries_dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            mat = matrix(pa.Table.from_batches([b]))
            kind = _anchor(mat, order)
            tree = np.array([tree_of.get(x, 0) for x in kind], np.int32)
            region = np.zeros(len(mat), np.int32)
            for t in np.unique(tree):
                region[tree == t] = _region_of(trees[t], mat[tree == t])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tree), pa.array(region)], names=[*b.schema.names, "_t", "_b"]) \
                .filter(pa.array(kind >= 0))  # a row with nothing shares no column

    donors = base.mapInArrow(donors_dealt, f"{values_sql}, _t int, _b int")
    asked = queries.select("_id", *names, "_several").mapInArrow(queries_dealt, f"{values_sql}, _several boolean, _t int, _b int")

    def measured(d: DataFrame) -> list:  # a row per region
        def finite(c):
            return F.when(F.abs(c) < float("inf"), F.col(c))
        return d.groupBy("_t", "_b").agg(F.count(F.lit(1)).alias("n"), *[x for c in names for x in (
            F.min(finite(c)).alias(f"low{c}"), F.max(finite(c)).alias(f"high{c}"), F.count(finite(c)).alias(f"n{c}"),
            F.count_if(F.col(c).isNotNull() & ~F.isnan(c)).alias(f"e{c}"))]).orderBy("_t", "_b").collect()

    regions = measured(donors)
    large = [(r["_t"], r["_b"]) for r in regions if r["n"] > 4 * rows]
    if large:  # of donors with equal values only the k smallest ids can be among the k nearest of anything
        marked = F.broadcast(spark.createDataFrame(large, "_t int, _b int"))
        equal = Window.partitionBy("_t", "_b", *names).orderBy(F.col("_id").asc_nulls_last())
        few = (donors.join(marked, ["_t", "_b"]).withColumn("_r", F.row_number().over(equal)).where(F.col("_r") <= k)
               .select("_id", *names, "_t", "_b").checkpoint(eager=True))
        donors = donors.join(marked, ["_t", "_b"], "left_anti").select("_id", *names, "_t", "_b").unionByName(few)
        regions = measured(donors)
    parts = {(r["_t"], r["_b"]): -(-r["n"] // (2 * rows)) for r in regions}
    # a region that cannot be cut is dealt to several parts with the same bounds
    cells = [(r, s) for r in regions for s in range(parts[r["_t"], r["_b"]])]
    cell_tree = np.array([r["_t"] for r, _ in cells], np.int32)
    cell_key = np.array([(r["_b"], s) for r, s in cells], np.int32).reshape(-1, 2)
    low, high = (np.array([[np.nan if r[f"{x}{c}"] is None else r[f"{x}{c}"] for c in names] for r, _ in cells], float).reshape(-1, m) for x in ("low", "high"))
    always = np.array([[r[f"n{c}"] == r["n"] for c in names] for r, _ in cells], bool).reshape(-1, m)
    ever = np.array([[r[f"e{c}"] > 0 for c in names] for r, _ in cells], bool).reshape(-1, m)
    split = [(*key, x) for key, x in parts.items() if x > 1]
    if split:
        number = F.broadcast(spark.createDataFrame(split, "_t int, _b int, _parts long"))
        part = F.pmod(F.xxhash64("_id"), F.coalesce("_parts", F.lit(1))).cast("int")
        donors, asked = (x.join(number, ["_t", "_b"], "left").withColumn("_s", part).drop("_parts") for x in (donors, asked))
    else:
        donors, asked = donors.withColumn("_s", F.lit(0)), asked.withColumn("_s", F.lit(0))
    key = ["_t", "_b", "_s"]
    tasks = max(spread, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def searched(visits: DataFrame, search, schema: str) -> DataFrame:
        shares = visits.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / rows).alias("_k"))
        shares = F.broadcast(shares)  # a row per region
        left = visits.join(shares, key).withColumn("_p", F.pmod(F.xxhash64("_id"), F.col("_k"))).drop("_k").repartition(tasks, *key, "_p")
        right = donors.join(shares, key).withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))).drop("_k").repartition(tasks, *key, "_p")
        return left.groupBy(*key, "_p").cogroup(right.groupBy(*key, "_p")).applyInArrow(search, schema)

    home_schema = pa.schema([*values, ("_t", pa.int32()), ("_to", pa.list_(pa.int32())), ("_kth", pa.list_(pa.float64())),
                             ("_d2", pa.list_(pa.float64())), ("_nid", pa.list_(pa.int64())), ("_val", pa.list_(pa.float64())),
                             *[(f"_f{j}", pa.float64()) for j in range(m)]])
    home_sql = (f"{values_sql}, _t int, _to array<int>, _kth array<double>, _d2 array<double>, _nid array<long>, _val array<double>, "
                + ", ".join(f"_f{j} double" for j in range(m)))

    def at_home(q: pa.Table, d: pa.Table) -> pa.Table:
        """A settled query with its values only; another with candidates and the cells it has to see."""
        if not q.num_rows:
            return home_schema.empty_table()
        ids, q_mat, d_ids, mat = ids_of(q), matrix(q), ids_of(d), matrix(d)
        tree, here = q.column("_t")[0].as_py(), [q.column(x)[0].as_py() for x in ("_b", "_s")]
        if d.num_rows:
            best, at = _impute_best(q_mat, d_ids, mat, k, window, batch_elems)
            nid, val = d_ids[at], np.stack([mat[at[:, j], j] for j in range(m)], 1)
        else:
            best, nid, val = np.full((len(ids), m, k), np.inf), np.zeros((len(ids), m, k), np.int64), np.zeros((len(ids), m, k))
        others = np.flatnonzero((cell_tree == tree) & (cell_key != here).any(1))
        to = _beyond_home(q_mat, best[:, :, -1], low[others], high[others], always[others], ever[others])
        open_ = numbers(q, "_several").astype(bool)
        open_[to[:, 0]] = True
        ok = np.isfinite(best)
        with np.errstate(invalid="ignore"):
            fill = np.where(ok, val, 0.0).sum(2) / ok.sum(2)

        def listed(a: np.ndarray, width: int) -> pa.Array:  # a list for every open query
            ends = np.cumsum(np.r_[0, np.where(open_, width, 0)]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(ends), pa.array(a[open_].ravel()), mask=pa.array(~open_))

        ends = np.r_[0, np.cumsum(np.bincount(to[:, 0], minlength=len(ids)))].astype(np.int32)
        fills = [pa.array(fill[:, j], mask=open_ | ~ok[:, j, 0]) for j in range(m)]
        own = [pa.array(q_mat[:, j], mask=~open_ | np.isnan(q_mat[:, j])) for j in range(m)]
        return pa.table([pa.array(ids), *own, q.column("_t"), pa.ListArray.from_arrays(pa.array(ends), pa.array(others[to[:, 1]].astype(np.int32)), mask=pa.array(~open_)),
                         listed(best[:, :, -1], m), listed(best, m * k), listed(nid, m * k), listed(val, m * k), *fills], schema=home_schema)

    schema = "qid long, col int, nid long, d2 double, val double"
    none = pa.schema([("qid", pa.int64()), ("col", pa.int32()), ("nid", pa.int64()), ("d2", pa.float64()), ("val", pa.float64())]).empty_table()

    def elsewhere(q: pa.Table, d: pa.Table) -> pa.Table:
        if not q.num_rows or not d.num_rows:
            return none
        got = _impute_kernel(ids_of(q), matrix(q), ids_of(d), matrix(d), k, m, window, batch_elems, numbers(q, "_kth"))
        return none if got is None else pa.Table.from_pandas(got[["qid", "col", "nid", "d2", "val"]], none.schema, preserve_index=False)

    homes = written(searched(asked, at_home, home_sql), "impute")
    left = homes.where(F.col("_to").isNotNull())
    cell = spark.createDataFrame([(i, int(b), int(s)) for i, (b, s) in enumerate(cell_key)], "_to int, _b int, _s int")
    visits = left.select("_id", *names, "_t", "_kth", F.explode("_to").alias("_to")).join(F.broadcast(cell), "_to").drop("_to")
    near = left.select(F.col("_id").alias("qid"), F.posexplode(F.arrays_zip("_d2", "_nid", "_val")).alias("at", "x")).select(
        "qid", F.floor(F.col("at") / k).cast("int").alias("col"), F.col("x._nid").alias("nid"), F.col("x._d2").alias("d2"), F.col("x._val").alias("val"))
    cands = near.where(F.col("d2") < float("inf")).unionByName(searched(visits, elsewhere, schema))
    w = Window.partitionBy("qid", "col").orderBy("d2", "nid")  # k rows and what other regions have within the bound
    late = (cands.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= k)
            .groupBy("qid").pivot("col", list(range(m))).agg(F.avg("val")))
    fill = homes.where(F.col("_to").isNull()).select("_id", *[f"_f{j}" for j in range(m)]).unionByName(
        late.select(F.col("qid").alias("_id"), *[F.col(f"`{j}`").alias(f"_f{j}") for j in range(m)]))
    out = df.join(fill.withColumnRenamed("_id", id_col), id_col, "left")
    return out.select(*[
        F.coalesce(F.col(c).cast("double"), F.col(f"_f{cols.index(c)}"), F.lit(means[c])).alias(c)
        if c in cols else F.col(c) for c in df.columns])
