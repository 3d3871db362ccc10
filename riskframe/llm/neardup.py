"""Embedding near-duplicates by NN-descent.

1. Equal vectors of a label are merged into one node with a weight.
2. First lists: nodes of a label meet by the signs of random projections, in
   groups of ``GROUP`` at most (larger buckets are dealt out at random), and
   keep their ``K`` nearest.
3. Rounds: around every node its list and up to ``K`` nodes that list it are
   compared with one another where one of the two entries is new; each keeps
   what is nearer than its last entry. Every pair at the threshold that is met
   on the way counts as a link, listed or not.
4. Audit: nodes are compared with all nodes by brute force, ``AUDIT`` at first
   and then blocks of double size, until ``PARTNERS`` true partners are known
   or ``AUDIT_MOST`` nodes are asked. Rounds go on, each with a fresh deal of
   step 2, until the share ``RECALL`` of the partners is linked; with fewer
   than ``PARTNERS`` known and not all nodes asked, the lists must have
   converged as well (at most the share ``DELTA`` of their entries new).
   Without any partner the recall is null.
5. A list that is all links (saturated) may miss partners that do not fit. The
   lists of linked nodes are enlarged to the whole component: its nodes are
   compared in blocks of ``BLOCK`` and the links of each are counted exactly.

Cosines come from the vectors' own components in double precision.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, link with nothing; vectors of
different length do not link; a null id is never smallest and has component
null; repeated rows are vectors each (equal ids link by their vectors); an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import components, portions, stored
from riskframe.llm.vectors import groups, matrix, packed, usable

K = 8
GROUP = 256
TABLES = 4
AUDIT = 512
AUDIT_MOST = 15 * AUDIT
PARTNERS = 500
DELTA = 0.001
RECALL = 0.99
BLOCK = 1024
MAX_ROUNDS = 12


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places of the pairs (a, b) that join two parts of 0..n-1."""
    label, out = np.arange(n), []
    todo = np.flatnonzero(label[a] != label[b])
    while len(todo):
        i = todo[0]
        out.append(int(i))
        x, y = label[a[i]], label[b[i]]
        label[label == max(x, y)] = min(x, y)
        todo = todo[label[a[todo]] != label[b[todo]]]
    return out


def compare(table: pa.Table, kind: type, threshold: float, all_new: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, bool]]:
    """(node, other, cosine, is link) of one group: better entries and connecting links."""
    ids = table.column("id").to_numpy()
    x = matrix(table.column("vec").combine_chunks(), kind)
    s = cosines(x, x)
    np.fill_diagonal(s, -2)
    if not all_new:
        new = table.column("fresh").to_numpy()
        s[~(new[:, None] | new[None, :])] = -2
    s[ids[:, None] == ids[None, :]] = -2
    out = []
    a, b = np.nonzero(np.triu(s >= threshold))
    if len(a):
        use = spanning(len(ids), a, b)
        out.append((ids[a[use]], ids[b[use]], s[a[use], b[use]], True))
    least = table.column("least").to_numpy()
    k = min(K, len(ids) - 1)
    if k > 0:
        top = np.argpartition(-s, k - 1, axis=1)[:, :k]
        rows = np.repeat(np.arange(len(ids)), k)
        top = top.ravel()
        good = s[rows, top] > np.maximum(least[rows], -1.5)
        out.append((ids[rows[good]], ids[top[good]], s[rows[good], top[good]], False))
    return out


def batches_of(found) -> Iterator[pa.RecordBatch]:
    for u, v, s, link in found:
        yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64()), pa.array(np.full(len(u), link))],
                                         names=["u", "v", "sim", "link"])


def compared(met: DataFrame, keys: list[str], kind: type, threshold: float, all_new: bool) -> DataFrame:
    """(u, v, sim, link) from all groups of ``met`` (keys..., id, vec, least, fresh)."""
    met = met.select(*keys, "id", "vec", "least", "fresh").repartition(*keys).sortWithinPartitions(*keys)
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for g in groups(batches, n):
            if g.num_rows > 1:
                part = compare(g, kind, threshold, all_new)
                held += part
                size += sum(len(p[0]) for p in part)
            if size > 50_000:
                yield from merged(held)
                held, size = [], 0
        yield from merged(held)

    def merged(parts):
        for link in (True, False):
            own = [p for p in parts if p[3] is link and len(p[0])]
            if own:
                yield from batches_of([(*(np.concatenate([p[i] for p in own]) for i in range(3)), link)])

    return met.mapInArrow(run, "u bigint, v bigint, sim double, link boolean")


def dealt(nodes: DataFrame, kind: type, first_table: int, n_tables: int, seed: int) -> DataFrame:
    """Nodes in groups of about GROUP: (label_no, tab, code, part, id, vec, least, fresh)."""
    bits = nodes.groupBy("label_no", "width").agg(F.count(F.lit(1)).alias("n"))
    bits = F.broadcast(bits.select("label_no", "width", F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / (GROUP / 4)))).cast("int").alias("bits")))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            widths, n_bits = batch.column(4).to_numpy(), batch.column(5).to_numpy()
            for t in range(first_table, first_table + n_tables):
                codes = np.zeros(batch.num_rows, np.int64)
                for w in np.unique(widths):
                    own = np.flatnonzero(widths == w)
                    if (t, w) not in planes:
                        planes[t, w] = np.random.default_rng([seed, t, int(w)]).standard_normal((int(w), 40))
                    bits = (matrix(batch.column(1).take(pa.array(own)), kind) @ planes[t, w]) > 0
                    use = np.minimum(n_bits[own], 40)
                    codes[own] = ((bits * (1 << np.arange(40))) * (np.arange(40) < use[:, None])).sum(1)
                yield pa.RecordBatch.from_arrays([*batch.columns[:4], batch.column(4), pa.array(np.full(batch.num_rows, t, np.int32)), pa.array(codes)],
                                                 names=["id", "vec", "label_no", "least", "width", "tab", "code"])

    coded = nodes.join(bits, ["label_no", "width"]).select("id", "vec", "label_no", "least", "width", "bits").mapInArrow(
        code, "id bigint, vec binary, label_no bigint, least double, width int, tab int, code bigint")
    keys = ["label_no", "width", "tab", "code"]
    sizes = coded.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > GROUP).select(*keys, F.ceil(F.col("n") / GROUP).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id", "tab", F.lit(seed)), F.coalesce("parts", F.lit(1))).cast("int").alias("part")
    return coded.join(sizes, keys, "left").select(*keys, part, "id", "vec", "least", F.lit(True).alias("fresh"))


def best(entries: DataFrame) -> DataFrame:
    """The K nearest of each node: (u, v, sim, fresh)."""
    one = entries.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    return one.withColumn("r", rank).where(F.col("r") <= K).drop("r")


def refine(nodes: DataFrame, lists: DataFrame, kind: type, threshold: float, turn: int) -> DataFrame:
    """One round: comparisons around every node that has a new entry nearby."""
    back = lists.select(F.col("v").alias("c"), F.col("u").alias("id"), "fresh")
    back = back.withColumn("r", F.row_number().over(Window.partitionBy("c").orderBy(F.desc("fresh"), F.xxhash64("id", F.lit(turn)), "id"))).where(F.col("r") <= K).drop("r")
    around = lists.select(F.col("u").alias("c"), F.col("v").alias("id"), "fresh").unionByName(back).groupBy("c", "id").agg(F.max("fresh").alias("fresh"))
    least = lists.groupBy("u").agg(F.when(F.count(F.lit(1)) >= K, F.min("sim")).otherwise(F.lit(-2.0)).alias("least"))
    side = nodes.select("id", "vec").join(least.select(F.col("u").alias("id"), "least"), "id")
    return compared(around.join(side, "id"), ["c"], kind, threshold, all_new=False)


def nn_descent(nodes: DataFrame, kind: type, threshold: float, seed: int) -> tuple[DataFrame, DataFrame, float | None]:
    """(lists, links, audited recall or null) over nodes (id, label_no, width, vec)."""
    start = nodes.withColumn("least", F.lit(-2.0))
    found = stored(compared(dealt(start, kind, 0, TABLES, seed), ["label_no", "width", "tab", "code", "part"], kind, threshold, all_new=True))
    lists = stored(best(found.where("not link").select("u", "v", "sim", F.lit(True).alias("fresh"))))
    links = found.where(F.col("sim") >= threshold).select("u", "v")
    truth, n_true, whole = audited(nodes, kind, threshold, seed)
    n_nodes = nodes.count()
    recall = None
    for turn in range(1, MAX_ROUNDS + 1):
        step = refine(nodes, lists, kind, threshold, turn)
        if turn > 1:
            least = lists.groupBy(F.col("u").alias("id")).agg(F.when(F.count(F.lit(1)) >= K, F.min("sim")).otherwise(F.lit(-2.0)).alias("least"))
            again = nodes.join(least, "id", "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
            step = step.unionByName(compared(dealt(again, kind, TABLES + turn, 1, seed), ["label_no", "width", "tab", "code", "part"], kind, threshold, all_new=True))
        step = stored(step)
        lists = stored(best(lists.select("u", "v", "sim", F.lit(False).alias("fresh")).unionByName(
            step.where("not link").select("u", "v", "sim", F.lit(True).alias("fresh")))))
        links = stored(links.unionByName(step.where(F.col("sim") >= threshold).select("u", "v")).distinct())
        converged = lists.where("fresh").count() <= DELTA * K * n_nodes
        if n_true:
            # a partner counts as found if it is linked, directly or (for enlarged lists) through the component
            comp = stored(components(links.select(F.col("u").alias("a"), F.col("v").alias("b"))))
            both = truth.join(comp.select(F.col("id").alias("u"), F.col("component").alias("cu")), "u", "left").join(
                comp.select(F.col("id").alias("v"), F.col("component").alias("cv")), "v", "left")
            recall = both.where("cu = cv").count() / n_true
        enough = (whole or n_true >= PARTNERS) and (turn > 1 or recall in (None, 1.0))
        if (recall is None or recall >= RECALL) and (enough or converged):
            break
    return lists, links, recall


def audited(nodes: DataFrame, kind: type, threshold: float, seed: int) -> tuple[DataFrame, int, bool]:
    """((u, v) true partners of the audited nodes, their number, whether all nodes were asked)."""
    order = nodes.select("id", "vec", "label_no").orderBy(F.xxhash64("id", F.lit(seed)), "id")
    truth, n_true, at, size = None, 0, 0, AUDIT
    while at < AUDIT_MOST and n_true < PARTNERS:
        size = min(size, AUDIT_MOST - at)
        block = order.offset(at).limit(size).toArrow()
        found = stored(partners(nodes, block, kind, threshold))
        truth = found if truth is None else truth.unionByName(found)
        n_true += found.count()
        if block.num_rows < size:
            return truth, n_true, True
        at, size = at + size, 2 * size
    return truth, n_true, False


def partners(nodes: DataFrame, asked: pa.Table, kind: type, threshold: float) -> DataFrame:
    """(u, v) links of a bounded set of nodes, by comparison with all nodes."""
    width = {}
    for i, v, g in zip(*(asked.column(c).to_pylist() for c in ("id", "vec", "label_no"))):
        width.setdefault((g, len(v)), ([], []))[0].append(i)
        width[g, len(v)][1].append(np.frombuffer(v, kind).astype(np.float64))
    held = nodes.sparkSession.sparkContext.broadcast({g: (np.array(i), np.stack(x)) for g, (i, x) in width.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, 1000):
            ids, labels = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            sizes = np.array([len(v) for v in batch.column(1).to_pylist()])
            for (g, w), (q_ids, q) in held.value.items():
                own = np.flatnonzero((labels == g) & (sizes == w))
                if len(own):
                    i, j = np.nonzero(cosines(q, matrix(batch.column(1).take(pa.array(own)), kind)) >= threshold)
                    u, v = q_ids[i], ids[own[j]]
                    yield pa.RecordBatch.from_arrays([pa.array(u[u != v], pa.int64()), pa.array(v[u != v], pa.int64())], names=["u", "v"])

    return nodes.select("id", "vec", "label_no").mapInArrow(run, "u bigint, v bigint")


def block_counts(members: DataFrame, kind: type, threshold: float) -> DataFrame:
    """(id, n): summed weight of all other members of the component at the threshold, by blocks."""
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    cut = members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    cut = cut.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cut = cut.select("component", F.least("own", "o").alias("i"), F.greatest("own", "o").alias("j"), "own", "id", "w", "vec")
    keys = ["component", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(batches, 3):
            ids, w, own = (g.column(c).to_numpy() for c in ("id", "w", "own"))
            i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
            x = matrix(g.column("vec").combine_chunks(), kind)
            a, b = own == i, own == j
            near = (cosines(x[a], x[b]) >= threshold) & (ids[a][:, None] != ids[b][None, :])
            parts = [(ids[a], near @ w[b])] + ([(ids[b], w[a] @ near)] if i != j else [])
            for who, n in parts:
                yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(n.astype(np.int64))], names=["id", "n"])

    met = cut.repartition(*keys).sortWithinPartitions(*keys)
    return met.mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))


def near_duplicates(rows: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", seed: int = 3) -> DataFrame:
    """One row per vector: ``id_col``, n_links, component_id, kept, audit_recall."""
    h = [F.xxhash64(vec_col), F.xxhash64(F.lit(1), vec_col)]
    fine = usable(vec_col) & F.col(label_col).isNotNull()
    base = stored(rows.select(F.col(id_col).alias("row_id"), F.col(label_col).alias("label"), F.when(fine, F.col(vec_col)).alias("vec"), *[F.when(fine, x).alias(f"h{i}") for i, x in enumerate(h)]))
    keys = ["label", "h0", "h1"]
    merged = base.where("vec is not null").groupBy(*keys).agg(F.count(F.lit(1)).alias("w"), F.min("row_id").alias("least_id"), F.first("vec").alias("vec"))
    labels = merged.select("label").distinct().withColumn("label_no", F.xxhash64("label"))
    node = merged.join(labels, "label").withColumn("id", F.xxhash64("label", "h0", "h1")).withColumn("width", F.size("vec"))
    node, kind = packed(node.select("id", "label_no", "width", "w", "least_id", "vec", *keys), "vec")
    node = stored(node)
    nodes = node.select("id", "label_no", "width", "vec")
    lists, links, recall = nn_descent(nodes, kind, threshold, seed)
    comp = stored(components(links.select(F.col("u").alias("a"), F.col("v").alias("b"))))
    near = block_counts(comp.join(node.select("id", "w", "vec"), "id"), kind, threshold)
    per = node.select("id", "w", "least_id", *keys).join(comp, "id", "left").join(near, "id", "left").withColumn("component", F.coalesce("component", "id"))
    top = per.groupBy("component").agg(F.min("least_id").alias("component_id"))
    per = per.join(top, "component").select(*keys, (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"), "component_id")
    linked = base.where("vec is not null").drop("vec").join(per, keys)
    alone = base.where("vec is null").select("row_id", F.lit(0).cast("bigint").alias("n_links"), F.col("row_id").alias("component_id"))
    out = linked.select("row_id", "n_links", "component_id").unionByName(alone)
    return out.select(F.col("row_id").alias(id_col), F.col("n_links").cast("bigint").alias("n_links"), "component_id",
                      F.coalesce(F.col("row_id") == F.col("component_id"), F.lit(False)).alias("kept"), F.lit(recall).cast("double").alias("audit_recall"))
