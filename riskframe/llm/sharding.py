"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Rows get (partition, place) in the partition that reads them; this narrow
   table is stored, so that later steps see the same places after a lost task.
2. The driver counts rows per partition (one number each) and draws how many
   rows every partition sends to every shard: multivariate hypergeometric
   draws against the remaining shard sizes, exact for any row count.
3. Every partition permutes its places; the first rows go to shard 0, the next
   to shard 1, and so on by the drawn counts.
4. Inside a shard, arrivals are numbered by partition and permuted again; the
   permutation is evaluated per row, so no shard meets in one task.

Defined cases: null ids and texts are ordinary rows; repeated rows are shards'
rows each; an empty table gives no rows; other columns pass through and may
have any name; columns named shard or slot are replaced.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.common import fresh, hypergeometric, permute_index, stored

PLACE_BITS = 33  # of monotonically_increasing_id


def communication_matrix(counts: list[int], n_shards: int, seed: int) -> np.ndarray:
    """Rows from each partition to each shard; shard sizes differ by one at most."""
    rng = random.Random(seed)
    total = sum(counts)
    left = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    out = np.zeros((len(counts), n_shards), dtype=np.int64)
    for p, n in enumerate(counts):
        others = sum(left)
        for s in range(n_shards):
            others -= left[s]
            k = hypergeometric(rng, left[s], others, n)
            out[p, s] = k
            n -= k
        left = [a - int(b) for a, b in zip(left, out[p], strict=True)]
    return out


def shuffle_into_shards(rows: DataFrame, n_shards: int = 8, seed: int = 20, exchange: bool = True) -> DataFrame:
    """``rows`` with ``shard`` int and ``slot`` long (gapless from 0 in each shard).

    With ``exchange`` the rows are moved to tasks of neighbouring slots and
    sorted; a shard is spread over several tasks.
    """
    where, shard_col, slot_col = fresh(rows, "where", "shard", "slot")
    tagged = stored(rows.withColumn(where, F.monotonically_increasing_id()))
    per = (tagged.groupBy(F.shiftright(where, PLACE_BITS).alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect())
    ids, counts = [r["p"] for r in per], [r["n"] for r in per]
    sent = communication_matrix(counts, n_shards, seed)
    before = np.cumsum(sent, axis=0) - sent
    sizes = sent.sum(axis=0)
    held = rows.sparkSession.sparkContext.broadcast({p: (n, sent[i], before[i]) for i, (p, n) in enumerate(zip(ids, counts, strict=True))})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.asarray(batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False), dtype=np.int64)
            parts, places = at >> PLACE_BITS, at & ((1 << PLACE_BITS) - 1)
            shard, slot = np.zeros(len(at), np.int32), np.zeros(len(at), np.int64)
            for p in np.unique(parts):
                own = parts == p
                n, counts_to, offset = held.value[int(p)]
                rank = permute_index(places[own], n, seed * 1_000_003 + int(p))
                ends = np.cumsum(counts_to)
                to = np.searchsorted(ends, rank, side="right")
                shard[own] = to
                slot[own] = offset[to] + rank - (ends - counts_to)[to]
            for s in np.unique(shard):
                own = shard == s
                slot[own] = permute_index(slot[own], int(sizes[s]), seed * 7_000_003 + int(s))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(shard), pa.array(slot)],
                                             names=[*(f.name for f in batch.schema)][:-1] + [shard_col, slot_col])

    schema = T.StructType([*tagged.schema.fields[:-1], T.StructField(shard_col, T.IntegerType()), T.StructField(slot_col, T.LongType())])
    out = tagged.mapInArrow(deal, schema)
    if exchange:
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        chunk = max(1, -(-sum(counts) // max(tasks, n_shards)))
        out = out.repartition(tasks, F.col(shard_col), F.floor(F.col(slot_col) / chunk)).sortWithinPartitions(shard_col, slot_col)
    keep = [c for c in rows.columns if c not in ("shard", "slot")]
    return out.select(*[F.col(f"`{c}`") for c in keep], F.col(shard_col).alias("shard"), F.col(slot_col).alias("slot"))
