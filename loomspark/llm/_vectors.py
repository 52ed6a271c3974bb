"""Vector columns as packed bytes, for the vector operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def packed(df: DataFrame, id: str, vector: str, change: Callable[[np.ndarray], np.ndarray] | None = None, zero: bool = True) -> DataFrame:
    """(vec_id long, v binary of little-endian doubles, dim int, norm double) of the vectors that take part: not null, no
    component null or not finite, the id not null and, without ``zero``, some component not 0. ``change`` maps the components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, lists = batch.column(0), batch.column(1)
            cells, at = lists.values, lists.offsets.to_numpy()
            flat = cells.to_numpy(zero_copy_only=False).astype(np.float64)
            if cells.null_count:
                flat = np.where(cells.is_null().to_numpy(zero_copy_only=False), np.nan, flat)
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
            good = (bad[at[1:]] == bad[at[:-1]]) & lists.is_valid().to_numpy(zero_copy_only=False) & ids.is_valid().to_numpy(zero_copy_only=False)
            if change:
                flat = change(flat)
            rows = np.flatnonzero(good)
            parts = [flat[at[k] : at[k + 1]] for k in rows]
            norms = [float(np.sqrt(p @ p)) for p in parts]
            if not zero:
                kept = [k for k, p in enumerate(parts) if p.any()]
                rows, parts, norms = rows[kept], [parts[k] for k in kept], [norms[k] for k in kept]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows)).cast(pa.int64()), pa.array([p.astype("<f8").tobytes() for p in parts], pa.binary()), pa.array([len(p) for p in parts], pa.int32()), pa.array(norms, pa.float64())],
                ["vec_id", "v", "dim", "norm"],
            )

    kind = df.schema[vector].dataType
    own = df.select(F.col(id).cast("long").alias("vec_id"), F.col(vector).cast(T.ArrayType(T.DoubleType())) if not isinstance(kind.elementType, T.DoubleType) else F.col(vector))
    return own.mapInArrow(run, "vec_id long, v binary, dim int, norm double")


def matrix(cells: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Rows of doubles; shorter vectors are filled up with zeros."""
    parts = [np.frombuffer(b, "<f8") for b in cells.to_pylist()]
    out = np.zeros((len(parts), dim))
    for k, p in enumerate(parts):
        out[k, : len(p)] = p
    return out
