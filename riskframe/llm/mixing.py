"""Mixing sources to target weights. DataFrame functions only.

Every source is a stream of words: documents in a keyed order, dealt over
buckets, so that a source of any size is laid out by many tasks. The streams
are packed into blocks of ``block_words``. A source gets as many slots as its
target needs; each slot falls into an output shard by a keyed draw, so the
counts of the sources in a shard are multinomial while each source's total
stays at its target. Slot j of a source of n blocks takes the block that the
source's permutation number j div n puts at place j mod n, so no block is used
a second time before all are used once. Slots and blocks are joined by index.

Defined cases: a null text has size 0; documents without words are taken 0
times; a null source is a source of its own, last in order; repeated rows are
documents each; null ids are kept; an empty table gives no rows; with no words
at all the targets are 0; other columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import fresh, stored, swap_or_not

WORD = "[^\\x20\\x09-\\x0D]+"
WORD_AND_GAP = "[^\\x20\\x09-\\x0D]+[\\x20\\x09-\\x0D]*"
BUCKET_ROWS = 4_000


def words_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(sized: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """One row per source: source, rank, rows, source_size, target.

    Targets are a water level: weight times one factor, but ``most`` times the
    source's size at most. Sources are ordered by how soon they are full; one
    is capped if the factor without all fuller ones would still exceed it.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), F.col("source"))) - 1
    per = per.withColumn("rank", rank)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("rank") % len(weights)).cast("int") + 1)
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(order), F.lit(0.0))
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(order), F.lit(0.0))
    per = per.withColumn("factor", left / open_weight)
    free = F.col("cap") / F.col("weight") >= F.col("factor")
    level = F.min_by(F.when(free, F.col("factor")), F.when(free, F.struct(F.col("cap") / F.col("weight"), F.col("rank")))).over(every)
    per = per.withColumn("level", F.coalesce(level, F.lit(float("inf"))))
    return per.select("source", "rank", "rows", "source_size", F.least("cap", F.col("weight") * F.col("level")).alias("target"))


def lay_out(sized: DataFrame, targets: DataFrame, seed: int) -> DataFrame:
    """Rows with (rank, bucket, begin): their place in the stream of their source.

    ``sized`` has source, size, tie (a keyed order) and whatever it carries.
    """
    n_buckets = F.ceil(F.col("rows") / BUCKET_ROWS).cast("bigint")
    side = targets.select(F.col("source").alias("s"), "rank", n_buckets.alias("n_buckets"))
    rows = sized.where("size > 0").join(F.broadcast(side), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("tie", F.lit(seed)), F.col("n_buckets"))).drop("n_buckets")
    line = Window.partitionBy("rank", "bucket").orderBy("tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("begin", F.coalesce(F.sum("size").over(line), F.lit(0)).cast("bigint"))


def block_plan(places: DataFrame, targets: DataFrame, block_words: int) -> tuple[DataFrame, DataFrame]:
    """(rank, bucket, first block) and (rank, number of blocks, number of slots)."""
    per = places.groupBy("rank", "bucket").agg(F.sum("size").alias("words"))
    per = per.withColumn("blocks", F.ceil(F.col("words") / block_words).cast("bigint"))
    before = Window.partitionBy("rank").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = stored(per.withColumn("first", F.coalesce(F.sum("blocks").over(before), F.lit(0)).cast("bigint")).select("rank", "bucket", "first", "blocks"))
    slots = first.groupBy("rank").agg(F.sum("blocks").alias("n")).join(F.broadcast(targets.where("source_size > 0")), "rank")
    return first.select("rank", "bucket", "first"), slots.select("rank", "n", F.round(F.col("target") * F.col("n") / F.col("source_size")).cast("bigint").alias("k"))


def draw_slots(slots: DataFrame, n_shards: int, seed: int, chunk: int = 65_536, task_chunks: int = 4) -> DataFrame:
    """One row per slot: rank, j, shard, block index.

    Slots are made from chunks of ``chunk`` numbers. The chunks are dealt to a
    counted number of tasks, about ``task_chunks`` each: they are few and
    narrow, and by their size alone adaptive execution would make one task of
    them. A slot depends on its source and number only, not on its task.
    """
    n_chunks = slots.agg(F.sum(F.ceil(F.col("k") / chunk))).first()[0] or 0
    spread = slots.select("rank", "n", "k", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("k") - 1) / chunk))).alias("c")).where("k > 0")
    spread = spread.repartition(max(1, -(-int(n_chunks) // task_chunks)), F.col("rank"), F.col("c"))
    last = F.least((F.col("c") + 1) * chunk, F.col("k")) - 1
    each = spread.select("rank", "n", F.explode(F.sequence(F.col("c") * chunk, last)).alias("j"))
    block = swap_or_not(F.col("j") % F.col("n"), F.col("n"), F.xxhash64(F.lit(seed), "rank", F.floor(F.col("j") / F.col("n"))), rounds=8)
    return each.select("rank", "j", F.pmod(F.xxhash64(F.lit(seed + 1), "rank", "j"), F.lit(n_shards)).cast("int").alias("shard"), block.alias("block"))


def pieces_of(places: DataFrame, first: DataFrame, block_words: int) -> DataFrame:
    """One row per (document, block): rank, bucket, begin, block, at (word in the document), words."""
    end = F.col("begin") + F.col("size")
    b = places.select("rank", "bucket", "begin", "size", F.explode(F.sequence(F.floor(F.col("begin") / block_words), F.floor((end - 1) / block_words))).alias("b"))
    lower = F.greatest(F.col("begin"), F.col("b") * block_words)
    return (b.join(first, ["rank", "bucket"])
            .select("rank", "bucket", "begin", (F.col("first") + F.col("b")).alias("block"), (lower - F.col("begin")).alias("at"),
                    (F.least(end, (F.col("b") + 1) * block_words) - lower).alias("words")))


def mix_sources(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights: Sequence[float] = (5, 2, 1),
                share: float = 1.5, most: float = 2.0, block_words: int = 64, n_shards: int = 16, seed: int = 4) -> dict[str, DataFrame]:
    """``taken``: one row per document; ``drawn``: the mix itself.

    ``taken``: id, size, source_size, target, taken (and source).
    ``drawn``: shard, rank, j, block and its pieces (bucket, begin, at, words).
    Slots are exploded from a few rows, which the size estimate does not see;
    the merge hint keeps them from being broadcast.
    """
    sized = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), words_of(F.col(text_col)).alias("size"),
                        F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("tie"))
    sized = stored(sized)
    targets = stored(source_targets(sized, weights, share, most))
    places = stored(lay_out(sized, targets, seed))
    first, slots = block_plan(places, targets, block_words)
    drawn = draw_slots(slots, n_shards, seed).hint("merge").join(pieces_of(places, first, block_words), ["rank", "block"])
    per = drawn.groupBy("rank", "bucket", "begin").agg(F.sum("words").alias("taken"))
    with_words = places.join(per, ["rank", "bucket", "begin"], "left").select("id", "rank", "size", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
    without = sized.where("size = 0").join(F.broadcast(targets.select(F.col("source").alias("s"), "rank")), F.col("source").eqNullSafe(F.col("s")))
    every = with_words.unionByName(without.select("id", "rank", "size", F.lit(0).cast("bigint").alias("taken")))
    taken = every.join(F.broadcast(targets.select("rank", "source", "source_size", "target")), "rank")
    return {"taken": taken.select(F.col("id").alias(id_col), "source", "size", F.col("source_size").cast("bigint").alias("source_size"), "target", "taken"),
            "drawn": drawn, "targets": targets}


def mixed_documents(docs: DataFrame, text_col: str = "text", source_col: str = "source", id_col: str = "doc_id", weights: Sequence[float] = (5, 2, 1),
                    share: float = 1.5, most: float = 2.0, block_words: int = 64, n_shards: int = 16, seed: int = 4) -> DataFrame:
    """``docs`` as the mix takes them: one row per use, its text the words taken.

    A document whose blocks are drawn twice gives two rows. A use of all words
    keeps the text unchanged; otherwise the drawn stretches follow one another
    with the white space that follows each word.
    """
    carried = fresh(docs, "row")[0]
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(carried), F.col(f"`{source_col}`").alias("source"),
                      words_of(F.col(f"`{text_col}`")).alias("size"), F.xxhash64(F.lit(seed), F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).alias("tie"))
    sized = stored(own.select("source", "size", "tie"))
    targets = stored(source_targets(sized, weights, share, most))
    places = stored(lay_out(sized, targets, seed))
    first, slots = block_plan(places, targets, block_words)
    drawn = draw_slots(slots, n_shards, seed).hint("merge").join(pieces_of(places, first, block_words), ["rank", "block"])
    uses = drawn.groupBy("rank", "bucket", "begin", "at", "words").agg(F.count(F.lit(1)).alias("n"))
    uses = uses.withColumn("use", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))))
    uses = uses.groupBy("rank", "bucket", "begin", "use").agg(F.sort_array(F.collect_list(F.struct("at", "words"))).alias("parts"), F.sum("words").alias("words"))
    full = lay_out(own, targets, seed).join(uses, ["rank", "bucket", "begin"])
    text = F.col(f"{carried}.`{text_col}`")
    words = F.regexp_extract_all(text, F.lit(WORD_AND_GAP), F.lit(0))
    some = F.array_join(F.flatten(F.transform("parts", lambda p: F.slice(F.col("all"), p["at"].cast("int") + 1, p["words"].cast("int")))), "")
    full = full.withColumn("all", F.when(F.col("words") < F.col("size"), words))
    new_text = F.when(F.col("words") >= F.col("size"), text).otherwise(some)
    return full.select(*[new_text.alias(c) if c == text_col else F.col(f"{carried}.`{c}`") for c in docs.columns])
