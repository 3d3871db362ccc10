"""Vectors in tasks: validity, packing into bytes, groups that cross batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def usable(vec: str) -> Column:
    """Not null, not empty, not all zero, and every component finite."""
    v = F.col(vec)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0), F.lit(False))


def common_length(rows: DataFrame, vec: str) -> int:
    """The most frequent length of the usable vectors (the smaller of ties); 0 if there is none."""
    top = rows.where(usable(vec)).groupBy(F.size(vec).alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    return top[0]["n"] if top else 0


def packed(rows: DataFrame, vec: str) -> tuple[DataFrame, type]:
    """``rows`` with ``vec`` as bytes of its own precision, and that numpy type."""
    kind = np.float32 if isinstance(rows.schema[vec].dataType.elementType, T.FloatType) else np.float64
    at = rows.columns.index(vec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 4000):
                part = batch.slice(k, 4000)
                cols = list(part.columns)
                flat = cols[at].flatten().to_numpy(zero_copy_only=False).astype(kind)
                ends = np.cumsum(pc.fill_null(pc.list_value_length(cols[at]), 0).to_numpy(zero_copy_only=False).astype(np.int64)) * flat.itemsize
                data = flat.tobytes()
                cols[at] = pa.array([data[a:b] for a, b in zip([0, *ends[:-1]], ends)], pa.binary())
                yield pa.RecordBatch.from_arrays(cols, names=part.schema.names)

    schema = T.StructType([T.StructField(f.name, T.BinaryType()) if f.name == vec else f for f in rows.schema.fields])
    return rows.mapInArrow(run, schema), kind


def matrix(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of packed vectors in double precision."""
    n = len(column)
    if not n:
        return np.zeros((0, 0))
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, -1).astype(np.float64)


def groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in their first ``n_keys`` columns, across batches."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        if rest is not None:
            table = pa.concat_tables([rest, table]).combine_chunks()
        new = np.zeros(table.num_rows, bool)
        for c in range(n_keys):
            k = table.column(c).to_numpy()
            new[1:] |= k[1:] != k[:-1]
        starts = np.r_[0, np.flatnonzero(new)]
        for a, b in zip(starts[:-1], starts[1:]):
            yield table.slice(a, b - a)
        rest = table.slice(starts[-1])
    if rest is not None and rest.num_rows:
        yield rest
