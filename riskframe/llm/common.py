"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import math
import random
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.session import ensure_checkpoint_dir

BROADCAST_ROWS = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def put_file(spark: SparkSession, data: bytes, tag: str) -> str:
    """Write a file to the shared folder and have Spark hand it to executors,
    also to those that start later; tasks find it by ``SparkFiles.get``."""
    name = f"{tag}-{uuid.uuid4().hex}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        for k in range(0, len(data), 1 << 22):
            out.write(bytearray(data[k:k + (1 << 22)]))
    finally:
        out.close()
    spark.sparkContext.addFile(path.toString())
    return name


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast for a narrow table of at most ``max_rows`` counted rows.

    Above that the same join runs as a shuffle join; the result is the same.
    """
    few = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if few else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` does not have yet."""
    have = {c.lower() for c in df.columns}
    out = []
    for name in names:
        new = f"__{name}"
        while new.lower() in have:
            new += "_"
        have.add(new.lower())
        out.append(new)
    return out


def portions(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Batches in portions of few rows, so that a task holds few texts as Python
    strings; at the end unused memory goes back to the system."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: workers live on and share an executor's limit."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix64(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over uint64 values (wrapping arithmetic)."""
    with np.errstate(over="ignore"):
        z = x.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & (2**64 - 1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def permute_index(x: np.ndarray, n: int, seed: int, rounds: int = 6) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1, evaluated at ``x`` only.

    A Feistel network over a grid of a x b >= n cells; values that fall outside
    0..n-1 walk on until they are inside, which keeps it a permutation.
    """
    if n <= 1:
        return np.zeros_like(x, dtype=np.int64)
    a = math.isqrt(n - 1) + 1
    b = -(-n // a)
    out = np.asarray(x, dtype=np.int64).copy()
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] // b, out[todo] % b
        for r in range(rounds):
            if r % 2 == 0:
                left = (left + (mix64(right, seed * 64 + r) % np.uint64(a)).astype(np.int64)) % a
            else:
                right = (right + (mix64(left, seed * 64 + r) % np.uint64(b)).astype(np.int64)) % b
        out[todo] = left * b + right
        todo = todo[out[todo] >= n]
    return out


def hypergeometric(rng: random.Random, good: int, bad: int, draws: int) -> int:
    """Exact hypergeometric draw by inversion outward from the mode.

    The cost is a few standard deviations, whatever the population is.
    """
    low, high = max(0, draws - bad), min(good, draws)
    if low >= high:
        return low
    total = good + bad
    mode = min(high, max(low, (draws + 1) * (good + 1) // (total + 2)))

    def log_choose(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    peak = math.exp(log_choose(good, mode) + log_choose(bad, draws - mode) - log_choose(total, draws))
    u = rng.random() - peak
    if u <= 0:
        return mode
    up = down = mode
    p_up = p_down = peak
    while up < high or down > low:
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            u -= p_up
            if u <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            u -= p_down
            if u <= 0:
                return down
        if p_up + p_down < 1e-300:
            break
    return mode


def swap_or_not(x: Column, n: Column, key: Column, rounds: int = 12) -> Column:
    """Pseudorandom permutation of 0..n-1 as a column (swap-or-not network).

    Each round reflects x about a keyed point or leaves it, by a keyed bit of
    the larger of both positions, so every round is a bijection on 0..n-1.
    """
    def step(v: Column, r: Column) -> Column:
        other = F.pmod(F.pmod(F.xxhash64(key, r), n) - v, n)
        top = F.greatest(v, other)
        return F.when(F.xxhash64(top, key, r, F.lit(1)).bitwiseAND(F.lit(1)) == 1, other).otherwise(v)

    return F.when(n <= 1, F.lit(0).cast("bigint")).otherwise(
        F.aggregate(F.sequence(F.lit(0), F.lit(rounds - 1)), x.cast("bigint"), step))


def components(edges: DataFrame) -> DataFrame:
    """Smallest id reachable over undirected ``edges`` (a, b): columns (id, component).

    Hooking and pointer jumping: every node looks at the grandparents of its
    neighbours, hooks itself and its parent to the smallest, and halves its
    path. The number of rounds is logarithmic in practice; each is a handful
    of grouped minima with map-side combine and two joins that adaptive
    execution may split. Ids must be non-null and comparable; no edge, no row.
    """
    both = stored(edges.select("a", "b").where("a <> b")
                  .select(F.explode(F.array(F.struct(F.col("a").alias("u"), F.col("b").alias("v")),
                                            F.struct(F.col("b").alias("u"), F.col("a").alias("v")))).alias("e"))
                  .select("e.u", "e.v").distinct())
    parent = stored(both.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("v"))
                    .select("id", F.least("id", "v").alias("f")))
    while True:
        grand = parent.join(parent.select(F.col("id").alias("f"), F.col("f").alias("g")), "f")
        grand = stored(grand.select("id", "f", "g"))
        seen = (both.join(grand.select(F.col("id").alias("v"), "g"), "v")
                .groupBy(F.col("u").alias("id")).agg(F.min("g").alias("m")))
        hooks = grand.join(seen, "id").select(
            F.explode(F.array(F.struct("id", F.least("g", "m").alias("f")),
                              F.struct(F.col("f").alias("id"), F.least("g", "m").alias("f")))).alias("h"))
        new = stored(hooks.select("h.id", "h.f").groupBy("id").agg(F.min("f").alias("f")))
        moved = new.join(parent.withColumnRenamed("f", "old"), "id").where("f <> old").limit(1).count()
        parent = new
        if not moved:
            return parent.select("id", F.col("f").alias("component"))
