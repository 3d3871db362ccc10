"""Exact nearest-neighbour join of narrow vectors by regions (below G5 and G6).

Vectors of few components, as the features of a table, are cut into regions of
some ten thousand donors by halving along the component of widest spread. The
cuts come from a bounded sample of donors; the regions' boxes from all of them.
A query is searched in its own region first, and the same task says which other
regions have a box within its k-th distance: only those it is sent to. Their
number is bounded (``REGIONS``) as far as a task can hold the donors, so that the
copies of a query, and with them disk, do not grow with the table.

Spread is the mean distance from the median: a heavy tail of a few rows, as
ratios have, draws no cuts that leave all other rows on one side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.operators.pivots import HELD, LEAST_QUERIES, by_spread, numbers, search_block
from riskframe.session import ensure_checkpoint_dir, written

NARROW = 16  # components up to which boxes keep queries away from regions
REGIONS = 16  # regions of more than cell_rows donors, as far as HELD allows
SAMPLE_ROWS = 128  # sampled donors of a region
SAMPLE = 20_000  # sampled donors in all
SMALL = 100_000  # rows of a table of regions that is broadcast


def region_tree(sample: np.ndarray, scale: float, rows: float):
    """Nested (component, cut, below, from the cut on) with a number for a region of
    about ``rows`` rows; a row of the sample stands for ``scale``."""
    number = iter(range(len(sample) + 1))

    def grow(own: np.ndarray):
        if len(own) * scale > 1.4 * rows:
            for axis in by_spread(sample[own]):
                v = sample[own, axis]
                cut = np.partition(v, len(v) // 2)[len(v) // 2]
                if not (v < cut).any():
                    if not (v > cut).any():
                        continue
                    cut = v[v > cut].min()
                return int(axis), float(cut), grow(own[v < cut]), grow(own[v >= cut])
        return next(number)

    return grow(np.arange(len(sample)))


def region_of(tree, mat: np.ndarray) -> np.ndarray:
    out, todo = np.zeros(len(mat), np.int32), [(tree, np.arange(len(mat)))]
    while todo:
        node, own = todo.pop()
        if not isinstance(node, tuple):
            out[own] = node
            continue
        axis, cut, below, above = node
        left = mat[own, axis] < cut
        todo += [(below, own[left]), (above, own[~left])]
    return out


def blocks_of_tree(tree, size: dict, rows: float) -> dict:
    """{region: block}: the regions with donors (``size``) of a group, put together from
    the leaves up as long as a block has at most ``rows`` donors."""
    block: dict = {}

    def leaves(node) -> list:
        return leaves(node[2]) + leaves(node[3]) if isinstance(node, tuple) else [node]

    todo = [tree]
    while todo:
        node = todo.pop()
        own = [x for x in leaves(node) if x in size]
        if not own:
            continue
        if isinstance(node, tuple) and sum(size[x] for x in own) > rows:
            todo += [node[3], node[2]]
            continue
        block |= dict.fromkeys(own, len(set(block.values())))
    return block


def region_join(queries: DataFrame, donors: DataFrame, k: int, exclude_self: bool, cell_rows: int, widest: int) -> DataFrame:
    """(qid, nid, dist, rank) of two (_id, _v, _g) tables with finite vectors of one
    length per group, at most ``widest``. Both are read several times: cut their lineage."""
    spark = donors.sparkSession
    ensure_checkpoint_dir(spark)
    spread = 4 * spark.sparkContext.defaultParallelism
    n = donors.count()
    rows = max(1, min(max(cell_rows, n // REGIONS), max(cell_rows, HELD // (8 * (widest + 4)))))
    picked = donors.orderBy(F.xxhash64("_id"), "_id").limit(min(SAMPLE, SAMPLE_ROWS * -(-n // rows))).collect() if n else []
    by_size: dict[int, list] = {}
    for r in picked:
        by_size.setdefault(len(r["_v"]), []).append(r["_v"])
    trees = {s: region_tree(np.array(v, float), n / len(picked), rows) for s, v in by_size.items()}

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for size in np.unique(sizes):
                own = batch.take(pa.array(np.flatnonzero(sizes == size)))
                region = region_of(trees.get(int(size), 0), numbers(pa.Table.from_batches([own]), "_v"))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(region)], names=[*own.schema.names, "_c"])

    def in_regions(df: DataFrame) -> DataFrame:
        return df.select("_id", "_v", "_g").mapInArrow(placed, "_id long, _v array<double>, _g string, _c int")

    # of equal vectors only the k + 1 smallest ids can be among the k nearest of anything
    same_vector = Window.partitionBy("_g", "_v").orderBy("_id")
    donors = in_regions(donors.withColumn("_r", F.row_number().over(same_vector)).where(F.col("_r") <= k + 1)).checkpoint(eager=True)
    stats = donors.withColumn("_dim", F.size("_v")).groupBy("_g", "_c").agg(
        F.count(F.lit(1)).alias("_n"), F.first("_dim").alias("_dim"),
        *[f(F.when(F.col("_dim") > j, F.get("_v", F.lit(j)))).alias(f"_{side}{j}") for j in range(widest) for side, f in (("low", F.min), ("high", F.max))])

    def plan_blocks(t: pa.Table) -> pa.Table:
        """The regions of a group with their block and its box."""
        region, size, dim = numbers(t, "_c"), numbers(t, "_n"), int(t.column("_dim")[0].as_py())
        of = blocks_of_tree(trees.get(dim, 0), dict(zip(region.tolist(), size.tolist())), rows)
        block = np.array([of[c] for c in region.tolist()], np.int64)
        total = np.bincount(block, weights=size)
        low, high = (np.column_stack([numbers(t, f"_{side}{j}") for j in range(dim)]).astype(float) for side in ("low", "high"))
        low, high = (np.array([f(side[block == b], axis=0) for b in range(len(total))]) for f, side in ((np.min, low), (np.max, high)))
        parts = np.maximum(1, -(-total // (2 * rows))).astype(np.int64)
        return pa.table({"_g": t.column("_g"), "_c": t.column("_c"), "_b": block, "_parts": parts[block],
                         "_low": pa.array([low[b] for b in block], pa.list_(pa.float64())), "_high": pa.array([high[b] for b in block], pa.list_(pa.float64()))})

    stats = stats.groupBy("_g").applyInArrow(plan_blocks, "_g string, _c int, _b long, _parts long, _low array<double>, _high array<double>").checkpoint(eager=True)
    small = F.broadcast if stats.limit(SMALL + 1).count() <= SMALL else (lambda df: df)  # a row per group and region
    wide = small(stats.select("_g", "_c", "_b", "_parts"))
    boxes = stats.dropDuplicates(["_g", "_b"]).groupBy("_g").agg(F.collect_list(F.struct("_b", "_parts", "_low", "_high")).alias("_boxes"))
    key = ["_g", "_b", "_s"]
    part = F.pmod(F.xxhash64("_id"), F.coalesce("_parts", F.lit(1)))
    donors = donors.join(wide, ["_g", "_c"]).select("_id", "_v", "_g", "_b", part.alias("_s"))
    # a query where its group has no donors goes to the group's first block
    asked = in_regions(queries).join(wide, ["_g", "_c"], "left").select("_id", "_v", "_g", F.coalesce("_b", F.lit(0)).alias("_b"), part.alias("_s"))
    tasks = max(spread, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def searched(visits: DataFrame, total: int, search, schema: str, more: DataFrame | None = None) -> DataFrame:
        share = max(1, min(max(LEAST_QUERIES, -(-total // spread)), 2 * rows))
        shares = small(visits.groupBy(*key).agg(F.ceil(F.count(F.lit(1)) / share).alias("_k")))
        left = visits.join(shares, key).withColumn("_p", F.pmod(F.xxhash64("_id"), F.col("_k"))).drop("_k").repartition(tasks, *key, "_p")
        right = donors if more is None else donors.withColumn("_boxes", F.lit(None).cast(more.schema["_boxes"].dataType))
        right = right.join(shares, key)
        if more is not None:
            right = right.unionByName(shares.join(small(more), "_g").select(F.lit(None).cast("long").alias("_id"), F.lit(None).cast("array<double>").alias("_v"), *key, "_boxes", "_k"))
        right = right.withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_k") - 1))).drop("_k").repartition(tasks, *key, "_p")
        return left.groupBy(*key, "_p").cogroup(right.groupBy(*key, "_p")).applyInArrow(search, schema)

    def best(q: pa.Table, d: pa.Table, bound: np.ndarray):
        if q.num_rows and d.num_rows:
            return search_block(numbers(q, "_id"), numbers(q, "_v"), bound, numbers(d, "_id"), numbers(d, "_v"), k, exclude_self)
        return np.zeros((q.num_rows, k), np.int64), np.full((q.num_rows, k), np.inf)

    home_schema = pa.schema([("_id", pa.int64()), ("_v", pa.list_(pa.float64())), ("_g", pa.string()), ("_bound", pa.float64()),
                             ("_nids", pa.list_(pa.int64())), ("_dists", pa.list_(pa.float64())), ("_to", pa.list_(pa.int64()))])

    def at_home(q: pa.Table, d: pa.Table) -> pa.Table:
        """A query's nearest in its own block, and the other blocks (block and part) that it has to see."""
        if not q.num_rows:
            return home_schema.empty_table()
        own = d.column("_boxes").is_valid()
        told, d = d.filter(own), d.filter(pc.invert(own))
        ids, dist = best(q, d, np.full(q.num_rows, np.inf))
        bound = dist[:, -1] * (1 + 1e-9)
        here, mat = tuple(q.column(x)[0].as_py() for x in ("_b", "_s")), numbers(q, "_v")
        row, to = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for box in told.column("_boxes")[0].as_py() if told.num_rows else []:
            gap = np.maximum(np.maximum(np.array(box["_low"]) - mat, mat - np.array(box["_high"])), 0)
            hit = np.flatnonzero(np.sqrt((gap * gap).sum(1)) * (1 - 1e-9) <= bound)
            for s in range(box["_parts"]):
                if (box["_b"], s) != here:
                    row.append(hit)
                    to.append(np.full(len(hit), box["_b"] << 20 | s))
        row, to = np.concatenate(row), np.concatenate(to)
        o = np.argsort(row, kind="stable")
        ends = np.r_[0, np.cumsum(np.bincount(row, minlength=len(ids)))].astype(np.int32)
        left = ends[1:] > ends[:-1]
        dim, starts = mat.shape[1], np.arange(0, ids.size + 1, k, dtype=np.int32)
        vec = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(np.where(left, dim, 0))].astype(np.int32)), pa.array(mat[left].ravel()), mask=pa.array(~left))
        return pa.table([q.column("_id"), vec, q.column("_g"), pa.array(bound), *[pa.ListArray.from_arrays(pa.array(starts), pa.array(x.ravel())) for x in (ids, dist)],
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(to[o]))], schema=home_schema)

    def elsewhere(q: pa.Table, d: pa.Table) -> pa.Table:
        bound = numbers(q, "_bound") if q.num_rows else np.zeros(0)
        ids, dist = best(q, d, bound)
        ok = (np.isfinite(dist) & (dist <= bound[:, None])).ravel()
        return pa.table({"qid": np.repeat(numbers(q, "_id"), k)[ok] if q.num_rows else np.zeros(0, np.int64), "nid": ids.ravel()[ok], "dist": dist.ravel()[ok]})

    homes = written(searched(asked, queries.count(), at_home, "_id long, _v array<double>, _g string, _bound double, _nids array<long>, _dists array<double>, _to array<long>", boxes), "near")
    visits = homes.where(F.size("_to") > 0).select("_id", "_v", "_g", "_bound", F.explode("_to").alias("_to")).select(
        "_id", "_v", "_g", "_bound", F.shiftright("_to", 20).alias("_b"), F.col("_to").bitwiseAND(F.lit((1 << 20) - 1)).alias("_s"))
    total = homes.agg(F.coalesce(F.sum(F.size("_to")), F.lit(0))).first()[0]
    others = searched(visits, total, elsewhere, "qid long, nid long, dist double")
    near = homes.select(F.col("_id").alias("qid"), F.explode(F.arrays_zip("_nids", "_dists")).alias("n")).select("qid", F.col("n._nids").alias("nid"), F.col("n._dists").alias("dist"))
    found = near.where(F.col("dist") < float("inf")).unionByName(others)
    last = Window.partitionBy("qid").orderBy("dist", "nid")  # k rows and what other regions have within the bound
    return found.withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
