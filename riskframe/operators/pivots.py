"""Pivot-partitioned exact nearest-neighbour join (the plan below G5 and G6).

Up to ``MAX_PIVOTS`` donors, first in hash order, are the pivots; every donor
belongs to the cell of its nearest one, within its group. Cells of a group are
put together to blocks of about ``cell_rows`` donors by halving their pivots
along the widest coordinate, so that a block is a compact region; a cell that
is larger than a block by itself is dealt to several.

A query is searched in the block of its nearest cell first, under a bound from
the pivots (donors themselves) and the cells' counts and radii; its k-th distance
there bounds the rest. It then goes only to the blocks that have a cell whose
lower bound (ring around the pivot, and the half-space between two pivots) is not
above that. In a block's task donors are halved to leaves with a bounding box; a
query sees its own leaf and those whose box is not beyond its bound. A last top-k
per query merges its blocks. Blocks grow with the table (``MAX_BLOCKS``) as far as
``HELD`` allows, so that copies of queries do not grow with its square.

Of donors with equal vectors only the ``k + 1`` smallest ids can be among the
k nearest of anything, so a group of copies, however large, is cut to that
first. Both sides are shuffled once per visit: a query is copied to the blocks
it has to see and never to more than there are blocks; donors are copied only
where the queries of a block fill several tasks. How many blocks a query sees
depends on the data's dimension: few for tables of some features, all for
evenly spread vectors of many components, where no bound can exclude anything.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

MAX_PIVOTS = 1024
PER_PIVOT = 128  # donors of a cell, as far as MAX_PIVOTS allows
ROUTED = 5_000  # queries routed together
MAX_BLOCKS = 64  # blocks of more than cell_rows donors, as far as HELD allows
HELD = 32 << 20  # bytes of vectors of one side in a task
MATRIX = 2 << 20  # numbers of a (queries, leaves) matrix
LEAST_QUERIES = 64  # rows of a query portion that is cut smaller to give every core a share
EPS = 1e-13  # relative error of squared distances from a matrix product, with room


def numbers(table: pa.Table, name: str) -> np.ndarray:
    """A column as numpy array; vectors as matrix (null components: NaN)."""
    col = table.column(name).combine_chunks()
    if pa.types.is_list(col.type):
        flat = col.flatten().to_numpy(zero_copy_only=False)
        return flat.astype(np.float64).reshape(len(col), -1)
    return col.to_numpy(zero_copy_only=False)


def _between(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by a matrix product, and how far they may be off."""
    a_sq, b_sq = (a * a).sum(1)[:, None], (b * b).sum(1)[None, :]
    return np.maximum(a_sq + b_sq - 2.0 * a @ b.T, 0.0), EPS * (a_sq + b_sq) * a.shape[1] + 1e-300


def nearest(q_ids, q_mat, d_ids, d_mat, k: int, exclude_self: bool, batch: int = 512):
    """(ids, distances) of the k donors nearest to each query, nearest first,
    ties to the smaller id; rows with fewer end in infinity."""
    ids, dist = np.zeros((len(q_ids), k), np.int64), np.full((len(q_ids), k), np.inf)
    cc = min(k + 8, len(d_ids))
    keep = min(k, cc)
    for s in range(0, len(q_ids), batch):
        qm, qi = q_mat[s:s + batch], q_ids[s:s + batch]
        d2, off = _between(qm, d_mat)
        if exclude_self:
            d2[qi[:, None] == d_ids[None, :]] = np.inf
        # pre-selection by the matrix product, exact distances for what it selects
        idx = np.argpartition(d2, cc - 1, axis=1)[:, :cc]
        chosen = np.take_along_axis(d2, idx, 1)
        exact = np.sqrt(((qm[:, None, :] - d_mat[idx]) ** 2).sum(-1))
        exact[np.isinf(chosen)] = np.inf
        near = d_ids[idx]
        order = np.lexsort((near, exact), axis=1)[:, :keep]
        best, best_ids = np.take_along_axis(exact, order, 1), np.take_along_axis(near, order, 1)
        # exact unless a donor that was not selected could tie or beat the k-th
        unsure = (cc < len(d_ids)) & ~(best[:, -1] ** 2 < chosen.max(1) - 2 * off.max(1))
        for r in np.flatnonzero(unsure):
            e = np.sqrt(((d_mat - qm[r]) ** 2).sum(1))
            if exclude_self:
                e[d_ids == qi[r]] = np.inf
            o = np.lexsort((d_ids, e))[:keep]
            best[r], best_ids[r] = e[o], d_ids[o]
        ids[s:s + batch, :keep], dist[s:s + batch, :keep] = best_ids, best
    return ids, dist


def lower_bounds(q_mat: np.ndarray, pivots: np.ndarray, cells: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """(queries, cells): no donor of a cell is nearer to the query than this.

    ``low`` and ``high`` bound the distances of a cell's donors to its pivot;
    donors are nearer to their own pivot than to any other.
    """
    d2, off = _between(q_mat, pivots)
    near, far = np.sqrt(np.maximum(d2 - off, 0)), np.sqrt(d2 + off)
    ring = np.maximum(near[:, cells] - high, low - far[:, cells])
    own = d2.argmin(1)
    gap = np.sqrt(_between(pivots, pivots)[0])[own][:, cells]
    slack = 4 * off.max()
    with np.errstate(divide="ignore", invalid="ignore"):
        half = (d2[:, cells] - d2[np.arange(len(own)), own][:, None] - slack) / (2 * gap)
    half = np.where(gap > 1e-6 * np.sqrt((pivots * pivots).sum(1).max(initial=0)), half * (1 - 1e-9), 0.0)
    return np.maximum(np.maximum(ring * (1 - 1e-9), half), 0.0)


def upper_bounds(q_ids, q_mat, pivots, pivot_ids, cells, size, high, own_pivot, k: int, exclude_self: bool) -> np.ndarray:
    """A distance within which every query has k donors; infinite if there are fewer."""
    d2, off = _between(q_mat, pivots[cells])
    far = np.sqrt(d2 + off) * (1 + 1e-9)
    reach = far + high
    order = np.argsort(reach, axis=1, kind="stable")
    enough = np.cumsum(size[order], axis=1) >= k + exclude_self
    out = np.where(enough.any(1), np.take_along_axis(np.take_along_axis(reach, order, 1), enough.argmax(1)[:, None], 1)[:, 0], np.inf)
    if own_pivot.sum() >= k:
        at = far[:, own_pivot]
        if exclude_self:
            at = np.where(q_ids[:, None] == pivot_ids[cells[own_pivot]][None, :], np.inf, at)
        out = np.minimum(out, np.partition(at, k - 1, axis=1)[:, k - 1])
    return out


def blocks_of(pivots: np.ndarray, cells: np.ndarray, size: np.ndarray, cell_rows: int) -> np.ndarray:
    """Block number of every cell; larger cells have a block of their own."""
    block, todo, n = np.zeros(len(cells), np.int64), [np.arange(len(cells))], 0
    while todo:
        own = todo.pop()
        if size[own].sum() <= cell_rows or len(own) == 1:
            block[own], n = n, n + 1
            continue
        at = pivots[cells[own]]
        own = own[np.argsort(at[:, np.ptp(at, axis=0).argmax()], kind="stable")]
        half = int(np.searchsorted(np.cumsum(size[own]), size[own].sum() / 2))
        half = min(max(half, 1), len(own) - 1)
        todo += [own[:half], own[half:]]
    return block


def by_spread(mat: np.ndarray) -> np.ndarray:
    """Coordinates by their mean distance from the median, widest first, as some 256
    of the rows have it; a few far rows count for little."""
    some = mat[::max(1, len(mat) // 256)]
    return np.argsort(-np.abs(some - np.median(some, axis=0)).mean(0), kind="stable")


def leaves_of(d_mat: np.ndarray, q_mat: np.ndarray, rows: int):
    """Donors halved along their widest coordinate down to leaves of at most
    ``rows``: donor order, starts of the leaves, queries in the order of the
    leaf whose side of every cut they are on, and that leaf."""
    todo, d_out, q_out = [(np.arange(len(d_mat)), np.arange(len(q_mat)))], [], []
    while todo:
        d, q = todo.pop()
        if len(d) <= rows:
            d_out.append(d)
            q_out.append(q)
            continue
        at = d_mat[d]
        axis, half = by_spread(at)[0], len(d) // 2
        o = np.argpartition(at[:, axis], half)
        below = q_mat[q, axis] < at[o[half], axis]
        todo += [(d[o[half:]], q[~below]), (d[o[:half]], q[below])]
    first = np.cumsum([0] + [len(d) for d in d_out[:-1]])
    return np.concatenate(d_out), first, np.concatenate(q_out), np.repeat(np.arange(len(q_out)), [len(q) for q in q_out])


def search_block(q_ids, q_mat, bound, d_ids, d_mat, k: int, exclude_self: bool):
    """(ids, distances) of the k best donors of a block for each query, as ``nearest``
    gives them; donors beyond ``bound`` may be missing. A query searches its own
    leaf, then the leaves whose box is not beyond the k-th distance it has. Memory
    is bounded by ``MATRIX`` numbers a matrix, whatever the number of queries."""
    dim = d_mat.shape[1]
    order, first, q_order, home = leaves_of(d_mat, q_mat, 128 if dim <= 8 else 512 if dim <= 16 else 2048)
    last = np.r_[first[1:], len(d_ids)]
    d_ids, d_mat = d_ids[order], d_mat[order]
    low, high = np.minimum.reduceat(d_mat, first), np.maximum.reduceat(d_mat, first)
    ids, dist, bound = np.zeros((len(q_ids), k), np.int64), np.full((len(q_ids), k), np.inf), bound.copy()

    def visit(rows: np.ndarray, c: int) -> None:
        own = slice(first[c], last[c])
        d2, off = _between(q_mat[rows], d_mat[own])
        at, col = np.nonzero((d2 - off) * (1 - 1e-9) <= (bound[rows] ** 2)[:, None])
        if exclude_self:
            other = q_ids[rows][at] != d_ids[own][col]
            at, col = at[other], col[other]
        if not len(at):
            return
        if len(at) > 8 * k * len(rows):  # a bound that excludes little
            rows = rows[np.unique(at)]
            new_ids, new = nearest(q_ids[rows], q_mat[rows], d_ids[own], d_mat[own], k, exclude_self)
            both, both_ids = np.hstack([dist[rows], new]), np.hstack([ids[rows], new_ids])
            o = np.lexsort((both_ids, both), axis=1)[:, :k]
            dist[rows], ids[rows] = np.take_along_axis(both, o, 1), np.take_along_axis(both_ids, o, 1)
        else:
            exact = np.sqrt(((q_mat[rows[at]] - d_mat[own][col]) ** 2).sum(-1))
            hit, at = np.unique(at, return_inverse=True)
            rows = rows[hit]
            # a row's k so far and what is new, sorted; its first k stay
            of, both, both_ids = np.r_[np.repeat(np.arange(len(rows)), k), at], np.r_[dist[rows].ravel(), exact], np.r_[ids[rows].ravel(), d_ids[own][col]]
            o = np.lexsort((both_ids, both, of))
            size = k + np.bincount(at, minlength=len(rows))
            keep = o[((np.cumsum(size) - size)[:, None] + np.arange(k)).ravel()]
            dist[rows], ids[rows] = both[keep].reshape(-1, k), both_ids[keep].reshape(-1, k)
        bound[rows] = np.minimum(bound[rows], dist[rows, -1] * (1 + 1e-9))

    step = max(16, min(1024, MATRIX // len(first)))
    for s in range(0, len(q_order), step):
        rows, own = q_order[s:s + step], home[s:s + step]
        for c in np.unique(own):
            visit(rows[own == c], c)
        box = np.zeros((len(rows), len(first)))
        for j in range(dim):
            x = q_mat[rows, j][:, None]
            box += np.maximum(np.maximum(low[None, :, j] - x, x - high[None, :, j]), 0) ** 2
        box = np.sqrt(box) * (1 - 1e-9)
        box[np.arange(len(rows)), own] = np.inf
        seen = np.flatnonzero((box <= bound[rows][:, None]).any(0))
        for c in seen[np.argsort(np.where(np.isinf(box[:, seen]), 0, box[:, seen]).sum(0), kind="stable")]:  # the nearest first
            at = rows[(box[:, c] <= bound[rows]) & np.isfinite(box[:, c])]
            if len(at):
                visit(at, c)
    return ids, dist


def metric_join(queries: DataFrame, donors: DataFrame, k: int, exclude_self: bool, cell_rows: int,
                max_pivots: int = MAX_PIVOTS, per_pivot: int = PER_PIVOT) -> DataFrame:
    """(qid, nid, dist, rank) of two (_id, _v, _g) tables with finite vectors
    of one length per group. Both are read several times: cut their lineage."""
    spark = donors.sparkSession
    ensure_checkpoint_dir(spark)
    spread = 4 * spark.sparkContext.defaultParallelism
    n = donors.count()
    # at most max_pivots rows reach the driver and the tasks; of equal vectors one is enough
    picked = donors.orderBy(F.xxhash64("_id"), "_id").limit(min(max_pivots, max(1, n // per_pivot))).collect()
    by_size: dict[int, list] = {}
    for r in {(r["_g"], tuple(r["_v"])): r for r in reversed(picked)}.values():
        by_size.setdefault(len(r["_v"]), []).append(r)
    same_vector = Window.partitionBy("_g", "_v").orderBy("_id")
    donors = donors.withColumn("_r", F.row_number().over(same_vector)).where(F.col("_r") <= k + 1)
    # pivots of another length than a vector's do not count; a length without pivots has one cell around the origin
    held = {s: (np.array([r["_v"] for r in rows], float), np.array([r["_id"] for r in rows]), [r["_g"] for r in rows]) for s, rows in by_size.items()}

    def pivots_for(size: int):
        return held.get(size) or (np.zeros((1, size)), np.array([-1]), [None])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                for s in range(0, own.num_rows, 2000):
                    part = own.slice(s, 2000)
                    mat, pivots = numbers(pa.Table.from_batches([part]), "_v"), pivots_for(int(size))[0]
                    cell = _between(mat, pivots)[0].argmin(1)
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell.astype(np.int32)), pa.array(np.sqrt(((mat - pivots[cell]) ** 2).sum(1)))],
                                                     names=[*part.schema.names, "_c", "_pd"])

    donors = donors.select("_id", "_v", "_g").mapInArrow(assign, "_id long, _v array<double>, _g string, _c int, _pd double").checkpoint(eager=True)
    stats = donors.groupBy("_g", "_c").agg(F.count(F.lit(1)).alias("_n"), F.min("_pd").alias("_low"), F.max("_pd").alias("_high"), F.first(F.size("_v")).alias("_dim"))

    def rows_of(dim: int, want: int) -> int:
        return max(1, min(want, max(cell_rows, HELD // (8 * (dim + 4)))))

    def plan_blocks(t: pa.Table) -> pa.Table:
        """Cells of a group (at most as many as pivots) with their blocks."""
        cells, size = numbers(t, "_c"), numbers(t, "_n")
        dim = int(t.column("_dim")[0].as_py())
        most = rows_of(dim, max(cell_rows, n // MAX_BLOCKS))
        block = blocks_of(pivots_for(dim)[0], cells, size, most)
        parts = np.maximum(1, -(-size // most))
        return t.append_column("_b", pa.array(block)).append_column("_parts", pa.array(parts))

    stats = stats.groupBy("_g").applyInArrow(plan_blocks, "_g string, _c int, _n long, _low double, _high double, _dim int, _b long, _parts long").checkpoint(eager=True)
    wide = stats.select("_g", "_c", "_b", "_parts")
    donors = donors.join(wide, ["_g", "_c"]).withColumn("_s", F.pmod(F.xxhash64("_id"), F.col("_parts"))).drop("_parts")

    point = [("_id", pa.int64()), ("_v", pa.list_(pa.float64())), ("_g", pa.string()), ("_b", pa.int64()), ("_s", pa.int64()), ("_bound", pa.float64())]
    point_sql = "_id long, _v array<double>, _g string, _b long, _s long, _bound double"

    def parts_of(q: pa.Table, cells: pa.Table):
        """1000 queries at a time with their pivots and the numbers of their group's cells."""
        for s in range(0, q.num_rows if cells.num_rows else 0, 1000):
            part = q.slice(s, 1000)
            mat = numbers(part, "_v")
            yield part, mat, pivots_for(mat.shape[1]), [numbers(cells, x) for x in ("_c", "_low", "_high", "_n", "_b", "_parts")]

    def settle(q: pa.Table, cells: pa.Table) -> pa.Table:
        """Each query with the block of its nearest cell and a first bound."""
        out = [pa.schema(point).empty_table()]
        for part, mat, (pivots, pivot_ids, groups), (c, low, high, size, block, parts) in parts_of(q, cells):
            ids = numbers(part, "_id")
            own_pivot = np.array([groups[i] is not None and groups[i] == cells.column("_g")[0].as_py() for i in c])
            bound = upper_bounds(ids, mat, pivots, pivot_ids, c, size, high, own_pivot, k, exclude_self)
            at = _between(mat, pivots[c])[0].argmin(1)
            out.append(pa.table([*(part.column(x) for x in ("_id", "_v", "_g")), pa.array(block[at]), pa.array(ids % parts[at]), pa.array(bound)], schema=pa.schema(point)))
        return pa.concat_tables(out)

    def route(q: pa.Table, cells: pa.Table) -> pa.Table:
        """The other blocks that a query has to see, with its bound."""
        out = [pa.schema(point).empty_table()]
        for part, mat, (pivots, _, _), (c, low, high, size, block, parts) in parts_of(q, cells):
            bound = numbers(part, "_bound")
            at = np.argwhere(lower_bounds(mat, pivots, c, low, high) <= bound[:, None])
            pairs = np.unique(np.stack([at[:, 0], block[at[:, 1]], parts[at[:, 1]]], 1), axis=0)
            times = pairs[:, 2]
            row, blk = np.repeat(pairs[:, 0], times), np.repeat(pairs[:, 1], times)
            sub = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            new = (blk != numbers(part, "_b")[row]) | (sub != numbers(part, "_s")[row])
            row, blk, sub = row[new], blk[new], sub[new]
            got = part.take(pa.array(row))
            out.append(pa.table([got.column("_id"), got.column("_v"), got.column("_g"), pa.array(blk), pa.array(sub), pa.array(bound[row])], schema=pa.schema(point)))
        return pa.concat_tables(out)

    portions = queries.groupBy("_g").agg(F.ceil(F.count(F.lit(1)) / ROUTED).alias("_k"))
    seen = stats.join(portions, "_g").withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))).drop("_k")

    def sent(rows: DataFrame, where) -> DataFrame:
        asked = rows.join(portions, "_g").withColumn("_p", F.pmod(F.xxhash64("_id"), F.col("_k"))).drop("_k")
        return asked.groupBy("_g", "_p").cogroup(seen.groupBy("_g", "_p")).applyInArrow(where, point_sql).checkpoint(eager=True)

    tasks = max(spread, int(spark.conf.get("spark.sql.shuffle.partitions")))
    key = ["_g", "_b", "_s"]
    widest = max(held, default=1)

    def searched(visits: DataFrame, search, schema: str) -> DataFrame:
        share = rows_of(widest, max(LEAST_QUERIES, -(-visits.count() // spread)))
        shares = visits.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / share).alias("_k"))
        left = visits.join(shares, key).withColumn("_p", F.pmod(F.xxhash64("_id"), F.col("_k"))).drop("_k").repartition(tasks, *key, "_p")
        right = donors.join(shares, key).withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))).drop("_k").repartition(tasks, *key, "_p")
        return left.groupBy(*key, "_p").cogroup(right.groupBy(*key, "_p")).applyInArrow(search, schema)

    def best(q: pa.Table, d: pa.Table):
        ids, dist = np.zeros((q.num_rows, k), np.int64), np.full((q.num_rows, k), np.inf)
        if q.num_rows and d.num_rows:
            ids, dist = search_block(numbers(q, "_id"), numbers(q, "_v"), numbers(q, "_bound"), numbers(d, "_id"), numbers(d, "_v"), k, exclude_self)
        return ids, dist

    def at_home(q: pa.Table, d: pa.Table) -> pa.Table:
        ids, dist = best(q, d)
        bound = np.minimum(numbers(q, "_bound"), dist[:, -1] * (1 + 1e-9)) if q.num_rows else np.zeros(0)
        lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, ids.size + 1, k, dtype=np.int32)), pa.array(x.ravel())) for x in (ids, dist)]
        return pa.table([*(q.column(x) for x in ("_id", "_v", "_g", "_b", "_s")), pa.array(bound), *lists],
                        schema=pa.schema([*point, ("_nids", pa.list_(pa.int64())), ("_dists", pa.list_(pa.float64()))]))

    def elsewhere(q: pa.Table, d: pa.Table) -> pa.Table:
        ids, dist = best(q, d)
        ok = (np.isfinite(dist) & (dist <= numbers(q, "_bound")[:, None])).ravel() if q.num_rows else np.zeros(0, bool)
        return pa.table({"qid": np.repeat(numbers(q, "_id"), k)[ok] if q.num_rows else np.zeros(0, np.int64), "nid": ids.ravel()[ok], "dist": dist.ravel()[ok]})

    homes = searched(sent(queries.select("_id", "_v", "_g"), settle), at_home, f"{point_sql}, _nids array<long>, _dists array<double>").checkpoint(eager=True)
    others = searched(sent(homes.drop("_nids", "_dists"), route), elsewhere, "qid long, nid long, dist double")
    near = homes.select(F.col("_id").alias("qid"), F.explode(F.arrays_zip("_nids", "_dists")).alias("n")).select("qid", F.col("n._nids").alias("nid"), F.col("n._dists").alias("dist"))
    found = near.where(F.col("dist") < float("inf")).unionByName(others)
    last = Window.partitionBy("qid").orderBy("dist", "nid")  # k rows and what other blocks have within the bound
    return found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
