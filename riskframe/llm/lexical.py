"""Ranked lexical search by presence masks.

Every document is read once per block of items: its terms are counted, those of
the items' vocabulary are kept as numbers (the index rows), and N, L and the
document frequencies are grouped sums over these rows. Then tasks stream the
index rows in blocks of documents. Within a block every term has its list of
documents; for an item, the bits of its terms are set in the mask of each
document, and documents are grouped by equal masks. A mask's maximum score is
the sum, over its terms, of the weight times the block's greatest impact of
that term. Distinct masks are evaluated by descending maximum; an item is
finished with a block once ``k`` documents are held and the next maximum is
below the least of them (equal scores are still looked at, for the order by
id). What is held goes on to the task's next block, so later blocks start with
a high bar. A task hands on ``k`` rows per item; two ranked cuts finish.

All score arithmetic is in integers; see ``ORACLE`` for the formula.

Items come in blocks of ``items_at_once`` distinct (id, text) rows, each block
against all documents, so what tasks get (the items' terms) is bounded.

Defined cases: null texts have no terms and are in no count; repeated documents
are documents each; equal scores: smaller id first, null ids last, equal ids in
any order; items repeated with equal id and text are one item; rows that share
only the id are ranked each; items without terms, or with terms that no
document holds, have no rows; texts are whole, of any length; empty tables give
no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import give_back, portions
from riskframe.session import written

DOCS = 8192  # documents of a block
POSTINGS = 2_000_000
ITEMS = 1024
#: ASCII letters and digits in lower case and all bytes of other characters stay; all else is a blank.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 0x80 else 32 for c in range(256))


def terms_of(text: str) -> list[bytes]:
    return text.encode().translate(TERMS).split()


def index_rows(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """(id, n, terms, tfs) of every document with a term: n counts all terms,
    the arrays hold those of the vocabulary, by number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sizes, parts, ids, tfs, keep = [], [0], [], [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = terms_of(text)
                if words:
                    own = Counter(filter(vocabulary.__contains__, words))
                    keep.append(i)
                    sizes.append(len(words))
                    ids += [vocabulary[w] for w in own]
                    tfs += own.values()
                    parts.append(len(ids))
            at = pa.array(parts, pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(sizes, pa.int64()),
                                              pa.ListArray.from_arrays(at, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(at, pa.array(tfs, pa.int64()))],
                                             names=["id", "n", "terms", "tfs"])

    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where("text is not null")
    return texts.mapInArrow(run, f"id {kind}, n bigint, terms array<int>, tfs array<bigint>")


class Best:
    """The k highest (score, id) of an item so far."""

    def __init__(self, k: int) -> None:
        self.k, self.rows, self.bar = k, [], 0

    def add(self, scores: np.ndarray, ids: list) -> None:
        """Scores below the bar are passed over; at the bar the id decides."""
        at = np.flatnonzero(scores >= max(self.bar, 1))
        if len(at):
            rows = self.rows + [(int(scores[i]), ids[i]) for i in at]
            self.rows = sorted(rows, key=lambda r: (-r[0], r[1] is None, 0 if r[1] is None else r[1]))[: self.k]
            if len(self.rows) == self.k:
                self.bar = self.rows[-1][0]


class Block:
    """Postings by term of some thousand documents."""

    def __init__(self, rows: pa.Table, n_docs: int, total: int) -> None:
        self.ids = rows.column("id").to_pylist()
        # Python integers: 25 * n * N may pass 64 bits on the way
        m = np.array([75 + 25 * n * n_docs // total for n in rows.column("n").to_pylist()], np.int64)
        terms = rows.column("terms").combine_chunks()
        term, tf = terms.flatten().to_numpy(), rows.column("tfs").combine_chunks().flatten().to_numpy()
        doc = np.repeat(np.arange(len(self.ids)), np.diff(terms.offsets.to_numpy()))
        impact = 1_000_000_000 * tf // (1000 * tf + 12 * m[doc])
        order = np.argsort(term, kind="stable")
        self.doc, self.impact = doc[order], impact[order]
        self.term, first = np.unique(term[order], return_index=True)
        self.first = np.r_[first, len(order)]
        self.most = np.maximum.reduceat(self.impact, first) if len(first) else np.zeros(0, np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Documents of one item (its distinct terms and their weights)."""
        at = np.searchsorted(self.term, terms)
        here = np.flatnonzero((at < len(self.term)) & (self.term[np.minimum(at, len(self.term) - 1)] == terms)) if len(self.term) else []
        if not len(here):
            return
        at, weights = at[here], weights[here]
        lists = [slice(self.first[t], self.first[t + 1]) for t in at]
        masks = np.zeros((len(self.ids), -(-len(at) // 64)), np.uint64)
        for j, own in enumerate(lists):
            masks[self.doc[own], j // 64] |= np.uint64(1 << (j % 64))
        docs = np.flatnonzero(masks.any(axis=1))
        kinds, group = np.unique(masks[docs, 0] if masks.shape[1] == 1 else masks[docs], axis=0, return_inverse=True)
        kinds, group = kinds.reshape(len(kinds), -1), group.reshape(-1)
        top = np.zeros(len(kinds), np.int64)
        for j, t in enumerate(at):
            top += np.where((kinds[:, j // 64] >> np.uint64(j % 64)) & np.uint64(1), weights[j] * self.most[t], 0)
        order = np.argsort(-top, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        docs = docs[np.argsort(place[group], kind="stable")]  # documents by their mask's place
        ends = np.cumsum(np.bincount(group, minlength=len(kinds))[order])
        done, least = 0, 4 * best.k
        for begin in iter(lambda: int(np.searchsorted(ends, done, "right")), len(ends)):  # the next mask
            if top[order[begin]] < max(best.bar, 1):
                return
            last = min(int(np.searchsorted(ends, done + least)), len(ends) - 1)
            some = np.sort(docs[done:ends[last]])
            scores = np.zeros(len(some), np.int64)
            for j, own in enumerate(lists):
                mine = self.doc[own]
                p = np.minimum(np.searchsorted(mine, some), len(mine) - 1)
                scores += np.where(mine[p] == some, weights[j] * self.impact[own][p], 0)
            best.add(scores, [self.ids[i] for i in some])
            done, least = int(ends[last]), 2 * least


def search_block(docs: DataFrame, items: list, k: int, id_col: str, text_col: str, item_kind: str) -> DataFrame:
    """(item_id, item, score, id) of one block of items: the k best of each task."""
    counted = [Counter(terms_of(r["text"])) for r in items]
    vocabulary = {w: i for i, w in enumerate(dict.fromkeys(w for c in counted for w in c))}
    rows = written(index_rows(docs, vocabulary, id_col, text_col), "index")
    n_docs, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(vocabulary), np.int64)
    # at most one row per term of the block's items
    for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df")).collect():
        df[r["t"]] = r["df"]
    w = np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)
    plans = []
    for c in counted:
        number = np.array([vocabulary[x] for x in c], np.int64)
        weight = w[number] * np.array(list(c.values()), np.int64) * (df[number] > 0)
        order = np.argsort(number)
        plans.append((number[order][weight[order] > 0], weight[order][weight[order] > 0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in plans]

        def search(held: list[pa.RecordBatch]) -> None:
            block = Block(pa.Table.from_batches(held), n_docs, total)
            for (terms, weights), own in zip(plans, best, strict=True):
                block.search(terms, weights, own)

        held, size, kind = [], 0, None
        for batch in batches:
            kind = batch.schema.field(0).type
            for a in range(0, batch.num_rows, 1000):
                part = batch.slice(a, 1000)
                held.append(part)
                size += len(part.column(2).flatten())
                if sum(x.num_rows for x in held) >= DOCS or size >= POSTINGS:
                    search(held)
                    held, size = [], 0
        if held:
            search(held)
        found = [(i, *r) for i, own in enumerate(best) for r in own.rows]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in found], pa.int32()), pa.array([r[1] for r in found], pa.int64()), pa.array([r[2] for r in found], kind)],
                                             names=["item", "score", "id"])
        give_back()

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"item int, score bigint, id {kind}")
    names = docs.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(items)], f"item int, item_id {item_kind}")
    order = [F.desc("score"), F.asc_nulls_last("id")]
    few = found.withColumn("task", F.spark_partition_id() % 64)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item", "task").orderBy(*order))).where(F.col("rank") <= k)
    few = few.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)
    return few.join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias(id_col), "score")  # at most items_at_once names


def search_items(docs: DataFrame, items: DataFrame, k: int = 20, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", items_at_once: int = ITEMS) -> DataFrame:
    """(item_id, rank, ``id_col``, score): the k best documents of every item."""
    item_kind = items.schema[item_col].dataType.simpleString()
    items = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text_col}`").alias("text")).where("text is not null").distinct()
    n_blocks = max(1, -(-items.count() // items_at_once))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out = None
    for b in range(n_blocks):
        own = items.where(block == b).collect()  # about items_at_once rows
        part = search_block(docs, own, k, id_col, text_col, item_kind)
        out = part if out is None else out.unionByName(part)
    return out


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

#: The same in DuckDB over ``documents`` and ``benchmark``.
ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents),
size AS (SELECT r, doc_id, len(ts) AS n FROM d WHERE len(ts) > 0),
total AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS l FROM size),
item AS (SELECT row_number() OVER () AS i, item_id, ts FROM (SELECT DISTINCT item_id, {_TERMS} AS ts, text FROM benchmark)),
asked AS (SELECT i, term, count(*) AS times FROM (SELECT i, unnest(ts) AS term FROM item) GROUP BY i, term),
post AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM post GROUP BY term), total),
impact AS (
  SELECT r, doc_id, term, (1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // l)) AS s
  FROM post JOIN size USING (r), total),
scored AS (
  SELECT i, r, doc_id, sum(times * w * s)::BIGINT AS score
  FROM asked JOIN weight USING (term) JOIN impact USING (term) GROUP BY i, r, doc_id),
ranked AS (
  SELECT i, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
  FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked JOIN item USING (i) WHERE rank <= 20
"""
