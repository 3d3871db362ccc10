"""SimHash near-duplicates through vantage-point trees over Hamming distance.

Fingerprints of ``max_bits`` differing bits or fewer agree but for
``max_bits // BLOCKS`` bits in one of BLOCKS stretches of the 64 bits. Each
stretch has a vantage-point tree: a node holds a code and a radius, codes
within the radius go inside, the others outside. The top of a tree is fitted
on a bounded sample of fingerprints (``SAMPLE``) and only deals out work: every
distinct fingerprint goes home to one leaf and, as a query, to each later leaf
that the triangle bound cannot exclude. A leaf's task goes on splitting by
vantage points in the same way and compares all 64 bits of what is left, so
the pairs are exact whatever the sample is. Leaves with many codes are cut into
chunks of homes and portions of queries, and a task gets one chunk with one
portion, so what it holds is bounded whatever the leaf's size.

Copies are merged before (one row per distinct fingerprint), and a task
returns a spanning forest of its pairs instead of all of them, so a group of
n near-copies gives at most n - 1 links per leaf.

Defined cases: null texts are empty; texts without words have fingerprint 0
and are linked like any other; repeated rows share their component; null ids
are kept, and the component id is the smallest non-null id (null if a
component has none); an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import components, portions, stored

SEED = 42
BLOCKS = 3
SAMPLE = 20_000
LEAF_HOMES = 512  # aimed at per leaf, as far as the sample can tell leaves apart
LEAF_SAMPLE = 16  # least sample codes in a node that is split
CHUNK_HOMES = 20_000
BRUTE = 1 << 16
CHUNK_SHINGLES = 100_000


def shingle_hashes(text: str | None, shingle: int) -> list[int]:
    """XXH64 of every run of ``shingle`` words (of all words, if there are fewer)."""
    words = (text or "").encode().lower().split()
    if len(words) <= shingle:
        return [xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else []
    line, begin, at = b" ".join(words), [], 0
    for w in words:
        begin.append(at)
        at += len(w) + 1
    ends = begin[shingle:] + [at]
    return [xxhash.xxh64_intdigest(line[a:b - 1], SEED) for a, b in zip(begin, ends)]


def fingerprints(texts: list[str | None], shingle: int) -> np.ndarray:
    """One uint64 per text: bits that are set in over half of its hashes."""
    out = np.zeros(len(texts), np.uint64)
    rows, hashes, sizes = [], [], []

    def flush():
        if not rows:
            return
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        n = np.array(sizes)
        ones = np.add.reduceat(bits, np.cumsum(n) - n, axis=0, dtype=np.int64)
        packed = np.packbits(2 * ones > n[:, None], axis=1, bitorder="little")
        out[rows] = np.ascontiguousarray(packed).view("<u8")[:, 0]
        rows.clear(), hashes.clear(), sizes.clear()

    for i, t in enumerate(texts):
        h = shingle_hashes(t, shingle)
        if h:
            rows.append(i)
            hashes.extend(h)
            sizes.append(len(h))
        if len(hashes) > CHUNK_SHINGLES:
            flush()
    flush()
    return out


def with_fingerprint(rows: DataFrame, shingle: int = 4) -> DataFrame:
    """(id, text hash, fp) of an (id, text) table; fp is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in portions(batches):
            fp = fingerprints(part.column(2).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(fp)], names=["id", "th", "fp"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.select("id", F.xxhash64("text").alias("th"), "text").mapInArrow(run, f"id {id_type}, th bigint, fp bigint")


def block_codes(fp: np.ndarray, block: int) -> np.ndarray:
    """The bits of stretch ``block``."""
    low, high = 64 * block // BLOCKS, 64 * (block + 1) // BLOCKS
    return (fp >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)


def build_tree(codes: np.ndarray, n_leaves: int, reach: int, rng: np.random.Generator) -> list[tuple]:
    """Nodes (vantage, radius, inside, outside); leaves are (None, leaf number).

    Of eight vantage codes the one with the least share of codes on both
    sides of its bound is taken, at the median distance.
    """
    nodes: list[tuple] = []
    leaf_size = max(LEAF_SAMPLE, len(codes) // max(n_leaves, 1))
    leaves = 0

    def grow(own: np.ndarray) -> int:
        nonlocal leaves
        at = len(nodes)
        nodes.append(())
        best = None
        if len(own) >= 2 * leaf_size:
            for v in rng.choice(own, 8):
                d = np.bitwise_count(own ^ v).astype(int)
                radius = int(np.median(d))
                if (d <= radius).all():
                    radius -= 1
                inside = (d <= radius).mean()
                if 0 < inside < 1:
                    cost = ((d > radius - reach) & (d <= radius + reach)).mean() + abs(inside - 0.5)
                    if best is None or cost < best[0]:
                        best = cost, v, radius, d
        if best is None:
            nodes[at] = None, leaves
            leaves += 1
        else:
            _, v, radius, d = best
            nodes[at] = int(v), radius, grow(own[d <= radius]), grow(own[d > radius])
        return at

    grow(codes)
    return nodes


def visits(nodes: list[tuple], codes: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of all leaves that can hold a code within ``reach``; reach 0 gives homes."""
    rows, leaves = [], []
    todo = [(0, np.arange(len(codes)))]
    while todo:
        at, own = todo.pop()
        if not len(own):
            continue
        if nodes[at][0] is None:
            rows.append(own)
            leaves.append(np.full(len(own), nodes[at][1]))
            continue
        v, radius, inside, outside = nodes[at]
        d = np.bitwise_count(codes[own] ^ np.uint64(v)).astype(int)
        todo += [(inside, own[d <= radius + reach]), (outside, own[d > radius - reach])]
    return (np.concatenate(rows), np.concatenate(leaves)) if rows else (np.zeros(0, int), np.zeros(0, int))


def close_pairs(homes: np.ndarray, queries: np.ndarray, block: int, reach: int, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (home, query) within ``max_bits``, by vantage points down to small rests."""
    todo = [(np.arange(len(homes)), np.arange(len(queries)))]
    h_codes, q_codes = block_codes(homes, block), block_codes(queries, block)
    while todo:
        h, q = todo.pop()
        if not len(h) or not len(q):
            continue
        split = False
        if len(h) * len(q) > BRUTE and len(h) > 64:
            v = h_codes[h[len(h) // 2]]
            dh, dq = np.bitwise_count(h_codes[h] ^ v).astype(int), np.bitwise_count(q_codes[q] ^ v).astype(int)
            radius = int(np.median(dh))
            if (dh <= radius).all():
                radius -= 1
            split = bool((dh <= radius).any())
        if split:
            todo += [(h[dh <= radius], q[dq <= radius + reach]), (h[dh > radius], q[dq > radius - reach])]
            continue
        step = max(1, (4 * BRUTE) // len(q))
        for k in range(0, len(h), step):
            own = h[k:k + step]
            a, b = np.nonzero(np.bitwise_count(homes[own][:, None] ^ queries[q][None, :]) <= max_bits)
            if len(a):
                yield own[a], q[b]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int]]:
    """Links that join two parts, out of all ``pairs`` over 0..n-1."""
    label = np.arange(n)
    for a, b in pairs:
        todo = label[a] != label[b]
        while todo.any():
            i = int(np.argmax(todo))
            x, y = label[a[i]], label[b[i]]
            yield int(a[i]), int(b[i])
            label[label == max(x, y)] = min(x, y)
            a, b = a[todo], b[todo]
            todo = label[a] != label[b]


def simhash_links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all near pairs."""
    spark = distinct.sparkSession
    reach = max_bits // BLOCKS
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("fp", F.lit(7)), "fp").limit(SAMPLE).toArrow().column("fp").to_numpy().view(np.uint64)
    rng = np.random.default_rng(SEED)
    trees = [build_tree(block_codes(sample, b), max(1, total // LEAF_HOMES), reach, rng) for b in range(BLOCKS)]
    held = spark.sparkContext.broadcast(trees)

    def arrivals(fp: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(tree, row, leaf, whether home) of all homes and queries."""
        for block, nodes in enumerate(held.value):
            codes = block_codes(fp, block)
            rows, leaves = visits(nodes, codes, 0)
            home = np.empty(len(fp), int)
            home[rows] = leaves
            rows, leaves = visits(nodes, codes, reach)
            use = leaves >= home[rows]
            yield block, rows[use], leaves[use], home[rows[use]] == leaves[use]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, _, leaves, own in arrivals(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)):
                leaf, at = np.unique(leaves, return_inverse=True)
                n = [pa.array(np.bincount(at, w, len(leaf)).astype(np.int64)) for w in (own, None)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaf), block, np.int32)), pa.array(leaf.astype(np.int32)), *n],
                                                 names=["tree", "leaf", "homes", "queries"])

    counts = distinct.select("fp").mapInArrow(count, "tree int, leaf int, homes bigint, queries bigint").groupBy("tree", "leaf").agg(
        F.sum("homes").alias("homes"), F.sum("queries").alias("queries"))
    large = {(r["tree"], r["leaf"]): (max(1, -(-r["homes"] // CHUNK_HOMES)), -(-r["queries"] // CHUNK_HOMES))
             for r in counts.where(F.col("queries") > CHUNK_HOMES).collect()}  # at most one in CHUNK_HOMES arrivals

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows_of(block, leaves, chunk, portion, home, fp):
            n = len(fp)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block, np.int32)), *(pa.array(x.astype(np.int32)) for x in (leaves, chunk, portion)),
                 pa.array(np.full(n, home)), pa.array(fp.view(np.int64))], names=["tree", "leaf", "chunk", "portion", "home", "fp"])

        def each(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Row numbers repeated ``n`` times, and the numbers 0 .. n - 1 of the repeats."""
            at = np.repeat(np.arange(len(n)), n)
            return at, np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)

        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            dealt = fp * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
            for block, rows, leaves, own in arrivals(fp):
                cuts = np.array([large.get((block, x), (1, 1)) for x in range(int(leaves.max(initial=0)) + 1)])[leaves]
                mine = (dealt[rows][:, None] % cuts.astype(np.uint64)).astype(int)
                at, chunk = each(cuts[:, 0])  # a query goes to every chunk of homes ...
                yield rows_of(block, leaves[at], chunk, mine[at, 1], False, fp[rows[at]])
                own = np.flatnonzero(own)
                at, portion = each(cuts[own, 1])  # ... and a home to every portion of queries
                at = own[at]
                yield rows_of(block, leaves[at], mine[at, 0], portion, True, fp[rows[at]])

    dealt = distinct.select("fp").mapInArrow(emit, "tree int, leaf int, chunk int, portion int, home boolean, fp bigint")

    def compare(group: pa.Table) -> pa.Table:
        block = group.column("tree")[0].as_py()
        fp = group.column("fp").to_numpy().view(np.uint64)
        home = group.column("home").to_numpy(zero_copy_only=False)
        codes, at = np.unique(fp, return_inverse=True)
        h, q = at[home], at[~home]
        pairs = ((h[a], q[b]) for a, b in close_pairs(codes[h], codes[q], block, reach, max_bits))
        ends = np.array(list(forest(len(codes), pairs)), np.int64).reshape(-1, 2)
        signed = codes.view(np.int64)
        return pa.table({"a": pa.array(signed[ends[:, 0]], pa.int64()), "b": pa.array(signed[ends[:, 1]], pa.int64())})

    return dealt.groupBy("tree", "leaf", "chunk", "portion").applyInArrow(compare, "a bigint, b bigint").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row per document: id, th (hash of the text), fp, group (smallest fingerprint reachable)."""
    rows = stored(with_fingerprint(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle))
    distinct = stored(rows.select("fp").distinct())
    linked = components(simhash_links(distinct, max_bits))
    out = rows.join(linked.select(F.col("id").alias("fp"), "component"), "fp", "left")
    return out.select("id", "th", "fp", F.coalesce("component", "fp").alias("group"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``id_col``, fingerprint (16 hex digits), component_id (smallest id reachable)."""
    rows = stored(simhash_groups(docs, id_col, text_col, shingle, max_bits))
    least = rows.groupBy("group").agg(F.min("id").alias("component_id"))
    return rows.join(least, "group").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each group: the one of the smallest id (a null id last)."""
    from pyspark.sql import Window

    from riskframe.llm.common import fresh

    rows = simhash_groups(docs, id_col, text_col, shingle, max_bits)
    first = rows.groupBy("group").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "th")).alias("w")).select(
        F.col("w.id").alias("w_id"), F.col("w.th").alias("w_th"))
    th, n = fresh(docs, "th", "n")
    kept = docs.withColumn(th, F.xxhash64(F.col(f"`{text_col}`")))
    kept = kept.join(first, (kept[th] == first["w_th"]) & kept[f"`{id_col}`"].eqNullSafe(first["w_id"]), "left_semi")
    kept = kept.withColumn(n, F.row_number().over(Window.partitionBy(th, F.col(f"`{id_col}`")).orderBy(th))).where(F.col(n) == 1)
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
