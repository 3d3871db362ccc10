"""Nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample (``SAMPLE`` rows, by a keyed order of
the ids); every row is then routed to its leaf in each tree, so the index holds
all rows. A query walks all trees through one priority queue of margins and
takes the first ``visits`` leaves. Rows and queries meet per (tree, leaf); the
task computes exact distances of all its candidates and keeps the best ``k``
of a query. Leaves with many rows (one repeated vector may fill a leaf) are cut
into chunks that each see all queries of the leaf.

``visits`` is not a fixed cap: it is the least number of leaves that finds a
share ``RECALL`` of the true neighbours of up to ``AUDIT`` queries, which are
compared with all rows by brute force first.

Defined cases: vectors that are null, empty, zero, of another length than the
most frequent one, or that hold null or non-finite components take no part;
rows with the query's own id are no candidates; of repeated ids the nearest
vector counts as candidate and the least one as query; ties go to the smaller
id; with fewer candidates than ``k`` all are returned; empty tables give no
rows; other columns are ignored; rows without an id take no part.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import stored
from riskframe.llm.vectors import common_length, groups, matrix, packed, usable

SAMPLE = 16_384
TREES = 6
LEAF = 48  # sample rows in a leaf
AUDIT = 128
RECALL = 0.97
CHUNK = 20_000


def grow(sample: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(directions, thresholds, children) of one tree; a negative child -1 - i is leaf i."""
    directions, cuts, children = [], [], []
    leaves = 0

    def node(own: np.ndarray) -> int:
        nonlocal leaves
        if len(own) > LEAF:
            d = rng.standard_normal(sample.shape[1])
            d /= np.linalg.norm(d)
            p = sample[own] @ d
            cut = float(np.median(p))
            left = p <= cut
            if left.any() and not left.all():
                at = len(cuts)
                directions.append(d)
                cuts.append(cut)
                children.append((0, 0))
                children[at] = node(own[left]), node(own[~left])
                return at
        leaves += 1
        return -leaves

    root = node(np.arange(len(sample)))
    if root < 0:
        return np.zeros((0, sample.shape[1])), np.zeros(0), []
    return np.array(directions), np.array(cuts), children


def leaf_of(tree, x: np.ndarray) -> np.ndarray:
    directions, cuts, children = tree
    out = np.zeros(len(x), np.int64)
    if not children:
        return out
    side = (x @ directions.T) > cuts
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, own = todo.pop()
        if at < 0:
            out[own] = -1 - at
        elif len(own):
            s = side[own, at]
            todo += [(children[at][0], own[~s]), (children[at][1], own[s])]
    return out


def visit_order(forest, q: np.ndarray) -> Iterator[tuple[int, int]]:
    """(tree, leaf) in the order of the shared queue, nearest margins first."""
    margins = [d @ q - c if len(c) else None for d, c, _ in forest]
    queue = [(-np.inf, t, 0 if f[2] else -1) for t, f in enumerate(forest)]
    heapq.heapify(queue)
    while queue:
        bound, t, at = heapq.heappop(queue)
        while at >= 0:
            m = margins[t][at]
            left, right = forest[t][2][at]
            near, far = (right, left) if m > 0 else (left, right)
            heapq.heappush(queue, (max(bound, abs(m)), t, far))
            at = near
        yield t, -1 - at


def nearest(rows: np.ndarray, ids: np.ndarray, q: np.ndarray, q_ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, distance): the best ``k`` ids of ``rows`` for each query.

    Products choose the rows that can be among them; their distances are then
    computed from the differences. Of repeated ids the nearest row counts.
    """
    out_q, out_id, out_d = [], [], []
    norms = (rows * rows).sum(1)
    by_id = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.r_[True, ids[by_id][1:] != ids[by_id][:-1]]) if len(ids) else by_id
    for a in range(0, len(q), 64):
        own = q[a:a + 64]
        d2 = norms[None, :] + (own * own).sum(1)[:, None] - 2 * own @ rows.T
        d2[ids[None, :] == q_ids[a:a + 64, None]] = np.inf
        per_id = d2 if len(first) == len(ids) else np.minimum.reduceat(d2[:, by_id], first, axis=1)
        kth = np.partition(per_id, min(k, len(first)) - 1, axis=1)[:, min(k, len(first)) - 1]
        slack = 1e-9 * (norms.max() + (own * own).sum(1).max())
        i, j = np.nonzero((d2 <= kth[:, None] + slack) & np.isfinite(d2))
        d = np.sqrt(((rows[j] - own[i]) ** 2).sum(1))
        if len(first) < len(ids):
            order = np.lexsort((d, ids[j], i))
            i, j, d = i[order], j[order], d[order]
            new = np.r_[True, (i[1:] != i[:-1]) | (ids[j][1:] != ids[j][:-1])][:len(i)]
            i, j, d = i[new], j[new], d[new]
        order = np.lexsort((ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        best = rank < k
        out_q.append(i[best] + a)
        out_id.append(ids[j[best]])
        out_d.append(d[best])
    cat = np.concatenate
    return (cat(out_q), cat(out_id), cat(out_d)) if out_q else (np.zeros(0, int), np.zeros(0, int), np.zeros(0))


def ranked(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(rows: DataFrame, kind: type, queries: pa.Table, k: int) -> DataFrame:
    """Exact neighbours of a bounded set of packed queries (id, vec) among all packed rows."""
    held = rows.sparkSession.sparkContext.broadcast((queries.column("id").to_numpy(), matrix(queries.column("vec").combine_chunks(), kind)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q = held.value
        for batch in batches:
            if batch.num_rows:
                i, ids, d = nearest(matrix(batch.column(1), kind), batch.column(0).to_numpy(), q, q_ids, k)
                yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(ids), pa.array(d)], names=["query_id", "vec_id", "score"])

    return ranked(rows.select("id", "vec").mapInArrow(run, "query_id bigint, vec_id bigint, score double"), k)


def pick(rows: DataFrame, n: int, salt: int) -> pa.Table:
    """At most ``n`` rows by a keyed order of the ids."""
    return rows.select("id", "vec").orderBy(F.xxhash64("id", F.lit(salt)), "id", "vec").limit(n).toArrow()


def search(rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding", seed: int = 6) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) for every query."""
    spark = rows.sparkSession
    length = common_length(rows, vec_col)

    def clean(df: DataFrame) -> DataFrame:
        fits = usable(vec_col) & (F.size(vec_col) == length) & F.col(id_col).isNotNull()
        return df.where(fits).select(F.col(id_col).cast("bigint").alias("id"), F.col(vec_col).alias("vec"))

    base, kind = packed(clean(rows), "vec")
    base = stored(base)
    asked = stored(packed(clean(queries).groupBy("id").agg(F.min("vec").alias("vec")), "vec")[0])
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    if asked.isEmpty() or base.isEmpty():
        return empty
    sample = matrix(pick(base, SAMPLE, 1).column("vec").combine_chunks(), kind)
    rng = np.random.default_rng(seed)
    forest = [grow(sample, rng) for _ in range(TREES)]
    visits = audited_visits(base, kind, asked, forest, k)
    held = spark.sparkContext.broadcast((forest, visits))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, _ = held.value
        for batch in batches:
            x = matrix(batch.column(1), kind)
            for t, tree in enumerate(trees if len(x) else ()):
                n = len(x)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, t, np.int32)), pa.array(leaf_of(tree, x).astype(np.int32)), batch.column(0), batch.column(1)],
                                                 names=["tree", "leaf", "id", "vec"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees, m = held.value
        for batch in batches:
            x = matrix(batch.column(1), kind)
            at, tree, leaf = [], [], []
            for i, q in enumerate(x):
                for (t, where), _ in zip(visit_order(trees, q), range(m)):
                    at.append(i)
                    tree.append(t)
                    leaf.append(where)
            take = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(tree, pa.int32()), pa.array(leaf, pa.int32()), batch.column(0).take(take), batch.column(1).take(take)],
                                             names=["tree", "leaf", "id", "vec"])

    schema = "tree int, leaf int, id bigint, vec binary"
    indexed = base.select("id", "vec").mapInArrow(index, schema)
    large = (indexed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CHUNK)
             .select("tree", "leaf", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")))
    large = F.broadcast(stored(large))  # at most one row per leaf of the fitted trees
    one = F.coalesce("chunks", F.lit(1))
    left = indexed.join(large, ["tree", "leaf"], "left").select("tree", "leaf", F.pmod(F.xxhash64("id", "vec"), one).cast("int").alias("chunk"), F.lit(False).alias("q"), "id", "vec")
    right = (asked.repartition("id").select("id", "vec").mapInArrow(route, schema).join(large, ["tree", "leaf"], "left")
             .select("tree", "leaf", F.explode(F.sequence(F.lit(0), one - 1)).alias("chunk"), F.lit(True).alias("q"), "id", "vec"))
    keys = ["tree", "leaf", "chunk"]
    met = left.unionByName(right).repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, 3):
            is_q = g.column("q").to_numpy()
            if not is_q.any() or is_q.all():
                continue
            x, ids = matrix(g.column("vec").combine_chunks(), kind), g.column("id").to_numpy()
            q_ids = ids[is_q]
            i, found, d = nearest(x[~is_q], ids[~is_q], x[is_q], q_ids, k)
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[i]), pa.array(found), pa.array(d)], names=["query_id", "vec_id", "score"])

    return ranked(met.mapInArrow(compare, "query_id bigint, vec_id bigint, score double"), k)


def audited_visits(base: DataFrame, kind: type, asked: DataFrame, forest, k: int) -> int:
    """Leaves a query has to visit so that the audit finds ``RECALL`` of the true neighbours."""
    audit = pick(asked, AUDIT, 2)
    truth = brute_force(base, kind, audit, k).select("query_id", F.col("vec_id").alias("id"))
    near = truth.join(base, "id").toArrow()
    if not near.num_rows:
        return 1
    x = matrix(near.column("vec").combine_chunks(), kind)
    leaves = np.stack([leaf_of(t, x) for t in forest], axis=1)
    asked_by = near.column("query_id").to_numpy()
    q_ids, q = audit.column("id").to_numpy(), matrix(audit.column("vec").combine_chunks(), kind)
    needed = np.zeros(len(x))
    for i, v in zip(q_ids, q):
        own = np.flatnonzero(asked_by == i)
        if len(own):
            at = {place: n for n, place in enumerate(visit_order(forest, v), 1)}
            needed[own] = [min(at[t, int(leaf)] for t, leaf in enumerate(leaves[r])) for r in own]
    return int(np.quantile(needed, RECALL, method="higher"))
