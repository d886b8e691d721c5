"""Vectors as numpy arrays, and the principal axes of all of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import mix


def usable(column: str) -> Column:
    """Neither null, empty or zero, nor with a null or non-finite component."""
    v = F.col(column)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0), F.lit(False))


# Components of a unit vector that agree so far are equal.
_DIRECTION_STEPS = 1e12


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Equally long vectors as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that tiny and huge ones survive squaring."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def directions(rows: np.ndarray) -> np.ndarray:
    """A 64-bit name of each usable row's direction: scaled copies share it."""
    steps = np.floor(unit(rows) * _DIRECTION_STEPS + 0.5).astype(np.int64).view(np.uint64)
    place = mix(np.arange(1, rows.shape[1] + 1).astype(np.uint64))
    return mix(mix(steps ^ place).sum(axis=1, dtype=np.uint64) ^ np.uint64(rows.shape[1])).view(np.int64)


def principal_axes(rows: DataFrame, vector: str, dim: str) -> dict[int, np.ndarray]:
    """Axes of each dimension's unit vectors, by falling second moment, as columns.

    One matrix of moments per dimension is summed over all rows, in two levels.
    """

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            for d in np.unique(dims).tolist():
                x = unit(matrix(batch.column(0).filter(pa.array(dims == d))))
                sums[d] = sums.get(d, 0) + x.T @ x
        yield _blobs(sums)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, data in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                sums[d] = sums.get(d, 0) + np.frombuffer(data).reshape(d, d)
        yield _blobs(sums)

    ddl = "dim int, data binary"
    parts = rows.select(vector, dim).mapInArrow(moments, ddl)
    salted = parts.repartition(F.col("dim"), F.pmod(F.xxhash64("data"), F.lit(16)))
    merged = salted.mapInArrow(merge, ddl).repartition("dim").mapInArrow(merge, ddl)
    out = {}
    for r in merged.collect():
        _, axes = np.linalg.eigh(np.frombuffer(r.data).reshape(r.dim, r.dim))
        out[r.dim] = axes[:, ::-1]
    return out


def _blobs(sums: dict[int, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(list(sums), pa.int32()),
            pa.array([v.tobytes() for v in sums.values()], pa.binary()),
        ],
        names=["dim", "data"],
    )
