"""Sharding by histogram sort.

Rows are ordered by (text hash, staged row number). The driver keeps one open bracket per wanted
boundary and asks all partitions, round by round, for exact bytes and rows between probe keys
inside the brackets. When a bracket holds few rows, those are read and the boundary is exact. Then
each row is told its shard and its place, and rows move once.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.shared import Broadcasted, staged

PROBES = 15
FEW_ROWS = 16
MOST_SEARCH_ROUNDS = 64
_LOW = 64  # bits of the row number below the hash in a key
_MASK = (1 << _LOW) - 1


@dataclass
class _Bracket:
    """Where a boundary may lie: a split before some key ``x`` with ``low < x <= high``.

    ``below`` counts bytes and rows with a key ``<= low``; ``inside`` those up to ``high``.
    """

    target: float
    low: int
    high: int
    below: tuple[int, int]
    inside: tuple[int, int]
    done: tuple[int, int, int] | None = None  # split key, bytes before it, rows before it
    probes: list[int] = field(default_factory=list)

    def spread(self, count: int) -> list[int]:
        """Probes inside the bracket, at row boundaries of a hash while more than one is inside."""
        low_hash, high_hash = self.low >> _LOW, self.high >> _LOW
        if high_hash - low_hash > 1:
            width = high_hash - low_hash
            hashes = {low_hash + width * (i + 1) // (count + 1) for i in range(count)}
            return sorted(h << _LOW | _MASK for h in hashes if low_hash < h < high_hash)
        step = self.high - self.low
        keys = {self.low + step * (i + 1) // (count + 1) for i in range(count)}
        return sorted(k for k in keys if self.low < k < self.high)


def _keys(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    high = batch.column(0).to_numpy().astype(np.int64).view(np.uint64)
    low = batch.column(1).to_numpy().astype(np.int64).view(np.uint64)
    return high, low, batch.column(2).to_numpy().astype(np.int64)


def _below(high: np.ndarray, low: np.ndarray, keys: list[int]) -> np.ndarray:
    """How many of the sorted ``keys`` are smaller than each row's key."""
    tops = np.array([k >> _LOW for k in keys], np.uint64)
    ends = np.array([k & _MASK for k in keys], np.uint64)
    out = np.searchsorted(tops, high, "left")
    tied = np.flatnonzero(np.searchsorted(tops, high, "right") > out)
    if len(tied):
        for value in np.unique(high[tied]):
            a, b = np.searchsorted(tops, value, "left"), np.searchsorted(tops, value, "right")
            rows = tied[high[tied] == value]
            out[rows] = a + np.searchsorted(ends[a:b], low[rows], "left")
    return out


def _histogram(keyed: DataFrame, probes: list[int]) -> dict[int, tuple]:
    """Exact bytes, rows, least and greatest hash of each gap between sorted probes."""
    sent = Broadcasted(keyed.sparkSession, probes)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = sent.value
        size = np.zeros(len(keys) + 1, np.int64)
        rows = np.zeros(len(keys) + 1, np.int64)
        for batch in batches:
            high, low, sizes = _keys(batch)
            gap = _below(high, low, keys)
            np.add.at(size, gap, sizes)
            rows += np.bincount(gap, minlength=len(rows))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(size[some]), pa.array(rows[some])],
            names=["gap", "bytes", "rows"],
        )

    parts = keyed.mapInArrow(count, "gap int, bytes long, rows long")
    sums = parts.groupBy("gap").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    return {r.gap: (r.bytes, r.rows) for r in sums.collect()}


def _rows_inside(keyed: DataFrame, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Keys and sizes of the few rows in half-open key ranges, in order."""
    bounds = sorted(k for r in ranges for k in r)
    # A range from before the first key has a bound below every row.
    before = sum(k < 0 for k in bounds)
    sent = Broadcasted(keyed.sparkSession, [k for k in bounds if k >= 0])

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, _ = _keys(batch)
            inside = (_below(high, low, sent.value) + before) % 2 == 1
            yield batch.filter(pa.array(inside))

    found = keyed.mapInArrow(pick, keyed.schema).collect()
    return sorted(((r[0] % 2**64) << _LOW | r[1] % 2**64, r[2]) for r in found)


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def find_splits(
    keyed: DataFrame, parts: int, tolerance: float
) -> list[tuple[int, int, int]]:
    """``parts - 1`` keys that cut ``keyed (hash, row, size)`` into runs of nearly equal bytes.

    Each comes with the exact bytes and rows at or below it. A boundary is taken between two hashes
    if one lies within ``tolerance`` of the mean run, and else inside the hash that straddles it.
    """
    total = keyed.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count("*")).first()
    size, rows = int(total[0]), int(total[1])
    if not rows or parts < 2:
        return []
    slack = tolerance * size / parts
    brackets = [
        _Bracket(size * (i + 1) / parts, -1, 2 ** (64 + _LOW) - 1, (0, 0), (size, rows))
        for i in range(parts - 1)
    ]
    for _ in range(MOST_SEARCH_ROUNDS):
        open_ = [b for b in brackets if b.done is None]
        for b in open_:
            for key, sums in (
                (b.low, b.below),
                (b.high, (b.below[0] + b.inside[0], b.below[1] + b.inside[1])),
            ):
                if abs(sums[0] - b.target) <= slack and b.done is None:
                    b.done = (key, *sums)
        wide = [b for b in open_ if b.done is None and b.inside[1] > FEW_ROWS]
        if not wide:
            break
        for b in wide:
            b.probes = b.spread(PROBES)
        points = sorted({p for b in wide for p in [b.low, *b.probes, b.high] if p >= 0})
        gaps = _histogram(keyed, points)
        below_bytes, below_rows = [0], [0]
        for g in range(len(points) + 1):
            got = gaps.get(g, (0, 0))
            below_bytes.append(below_bytes[-1] + got[0])
            below_rows.append(below_rows[-1] + got[1])
        at = {p: (below_bytes[i + 1], below_rows[i + 1]) for i, p in enumerate(points)}
        at[-1] = (0, 0)
        for b in wide:
            steps = [b.low, *b.probes, b.high]
            i = min(bisect_right([at[s][0] for s in steps], b.target), len(steps) - 1)
            low, high = steps[max(i - 1, 0)], steps[max(i, 1)]
            b.low, b.high, b.below = low, high, at[low]
            b.inside = (at[high][0] - at[low][0], at[high][1] - at[low][1])
    left = [b for b in brackets if b.done is None]
    found = _rows_inside(keyed, _merged([(b.low, b.high) for b in left])) if left else []
    names = [k for k, _ in found]
    for b in left:
        choices = [(b.low, *b.below)]
        for key, n in found[bisect_right(names, b.low) : bisect_right(names, b.high)]:
            choices.append((key, choices[-1][1] + n, choices[-1][2] + 1))
        whole = [
            c
            for c, after in zip(choices, [*choices[1:], None], strict=True)
            if (after is None or after[0] >> _LOW != c[0] >> _LOW)
            and abs(c[1] - b.target) <= slack
        ]
        b.done = min(whole or choices, key=lambda c: abs(c[1] - b.target))
    return [b.done for b in brackets]


def shard_rows(
    rows: DataFrame,
    order: str,
    size: str,
    shards: int,
    tolerance: float = 0.001,
    runs_per_shard: int | None = None,
) -> DataFrame:
    """``rows`` with ``shard`` (0 to ``shards - 1``) and ``slot`` (gapless from 0 in a shard).

    ``order`` is a column that equal rows share, ``size`` the bytes of a row (null: 0). Rows of one
    ``order`` value stay together unless they are too many to keep sizes near equal; null is a
    value like any other. An empty table gives an empty one. Repeated rows are rows of their own.
    Other columns are carried through; one named shard or slot is replaced. Rows move once, into
    ``runs_per_shard`` runs a shard (as many as make up the shuffle partitions, if None), so that
    no task holds a whole shard.
    """
    spark = rows.sparkSession
    inner = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_in"),
        F.xxhash64(F.col(order)).alias("_hash"),
        F.coalesce(F.col(size).cast("long"), F.lit(0)).alias("_size"),
    )
    kept = staged(inner.withColumn("_row", F.monotonically_increasing_id()), "sharded")
    keyed = kept.select(
        F.col("_hash").alias("hash"), F.col("_row").alias("row"), F.col("_size").alias("size")
    )
    if runs_per_shard is None:
        runs_per_shard = -(-int(spark.conf.get("spark.sql.shuffle.partitions")) // shards)
    splits = find_splits(keyed, shards * runs_per_shard, tolerance / runs_per_shard)
    before = [0, *[n for _, _, n in splits]]
    first = [n - before[r - r % runs_per_shard] for r, n in enumerate(before)]
    sent = Broadcasted(spark, [key for key, _, _ in splits])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            high, low, _ = _keys(batch.select([1, 3, 2]))
            run = _below(high, low, sent.value) if sent.value else np.zeros(len(high), np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(run, pa.int32())], names=[*batch.schema.names, "_run"]
            )

    schema = kept.select("*", F.lit(0).alias("_run")).schema
    runs = kept.mapInArrow(place, schema)
    # Hashes are compared without sign, as the boundaries are.
    unsigned = F.col("_hash").bitwiseXOR(F.lit(-(2**63)).cast("long"))
    in_run = W.partitionBy("_run").orderBy(unsigned, "_row")
    starts = F.element_at(F.lit(first), F.col("_run") + 1).cast("long")
    others = [c for c in rows.columns if c not in ("shard", "slot")]
    return runs.withColumn("_place", F.row_number().over(in_run)).select(
        *[F.col(f"_in.`{c}`").alias(c) for c in others],
        F.floor(F.col("_run") / runs_per_shard).cast("int").alias("shard"),
        (starts + F.col("_place") - 1).alias("slot"),
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """A Parquet folder per shard; rows are already dealt out, so nothing is moved again."""
    sharded.write.mode("errorifexists").partitionBy("shard").parquet(path)
