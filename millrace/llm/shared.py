"""What several operators need: staged tables, batches, groups, filters of fixed size, components."""

from __future__ import annotations

import atexit
import ctypes
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.words import mix
from millrace.sinks.files import delete_folder
from millrace.sinks.stage import new_folder, stage_table

_STAGED: list[tuple[SparkSession, str]] = []


def staged(table: DataFrame, label: str) -> DataFrame:
    """Write ``table`` below the cluster's shared folder and read it back.

    That cuts the lineage: a lost executor costs a re-read. The folder is removed when the driver
    ends, as the result may be read until then; ``forget`` removes it earlier.
    """
    spark = table.sparkSession
    path = new_folder(spark, label)
    if not _STAGED:
        atexit.register(forget_all)
    _STAGED.append((spark, path))
    back = stage_table(table, path)
    back._staged_path = path
    return back


def forget(*tables: DataFrame) -> None:
    """Remove staged tables that nothing will read again."""
    for table in tables:
        path = table._staged_path
        for entry in [e for e in _STAGED if e[1] == path]:
            _STAGED.remove(entry)
            delete_folder(entry[0], path)


def staged_so_far() -> int:
    return len(_STAGED)


def forget_since(count: int, kept: DataFrame) -> None:
    """Remove what was staged after ``staged_so_far`` gave ``count``, but for one table."""
    for spark, path in [e for e in _STAGED[count:] if e[1] != kept._staged_path]:
        _STAGED.remove((spark, path))
        delete_folder(spark, path)


def forget_all() -> None:
    while _STAGED:
        spark, path = _STAGED.pop()
        try:
            delete_folder(spark, path)
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter
            return


USUAL_BATCH = "10000"
SMALL_BATCH = "2000"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of fewer rows, if the session has Spark's default: texts make wide rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key) == USUAL_BATCH:
        spark.conf.set(key, SMALL_BATCH)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc(column: str) -> Column:
    """``crc32`` of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def text_key() -> Column:
    """A 64-bit name of a text; null and empty texts share one."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("")))


def carried(docs: DataFrame, carry: Iterable[str], *own: str) -> tuple[list[str], list[str], list[Column]]:
    """Columns to carry through a map beside ``text``: their names, the names they travel under, and
    what to select.

    Columns named like ``own`` give way. ``text`` travels once, under its own name.
    """
    names = [c for c in dict.fromkeys(carry) if c not in own]
    held = ["text" if c == "text" else f"_c{i}" for i, c in enumerate(names)]
    picked = [F.col(f"`{c}`").alias(h) for c, h in zip(names, held, strict=True) if h != "text"]
    return names, held, [*picked, F.col("text").cast("string").alias("text")]


def fields(ddl: str) -> list[T.StructField]:
    return T.StructType.fromDDL(ddl).fields


def release() -> None:
    """Give freed memory back to the system: workers live on between tasks, beside each other."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


# Numbers of mallopt's own: from which size on a block is mapped, and what may lie free at the end.
_MMAP_FROM, _TRIM_FROM = -3, -1


def keep_freed() -> None:
    """Let this process use freed memory again until ``release``, not fetch and clear it anew.

    Temporaries of some megabytes otherwise go back to the system one by one, and each page that
    comes back is cleared. Without glibc nothing changes.
    """
    tune = getattr(ctypes.CDLL(None), "mallopt", None)
    if tune is not None:
        tune(_MMAP_FROM, 32 << 20)
        tune(_TRIM_FROM, 256 << 20)


_THREAD_CALLS = ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads")
_single: list[bool] = []


def one_thread() -> None:
    """Let this process's matrix products use one thread: Spark already runs a task per core.

    Small products otherwise wake threads that wait busily, which doubles a task's CPU time.
    Without the usual library, or its list of loaded files, nothing changes.
    """
    if _single:
        return
    _single.append(True)
    try:
        with open("/proc/self/maps") as maps:
            loaded = {line.split()[-1] for line in maps if "openblas" in line}
    except OSError:
        return
    for path in loaded:
        library = ctypes.CDLL(path)
        for name in _THREAD_CALLS:
            if hasattr(library, name):
                getattr(library, name)(1)


def map_batches(
    rows: DataFrame,
    work: Callable[[pa.RecordBatch], Iterable[dict]],
    ddl: str,
    carry: Iterable[str] = (),
) -> DataFrame:
    """``work`` over each Arrow batch; it yields dicts of columns, ``_rows`` picks carried rows.

    Columns in ``carry`` go from input to output as they are. ``_rows`` is a slice or an index
    array of the input rows that the yielded rows belong to, in order.
    """
    carry = list(carry)
    schema = T.StructType([rows.schema[c] for c in carry] + fields(ddl))
    names = [f.name for f in fields(ddl)]
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            for out in work(batch):
                at = out.get("_rows", slice(0, batch.num_rows))
                held = []
                for c in carry:
                    column = batch.column(batch.schema.get_field_index(c))
                    if isinstance(at, slice):
                        held.append(column.slice(at.start, at.stop - at.start))
                    else:
                        held.append(column.take(pa.array(at)))
                made = [_column(out[n], target.field(n).type) for n in names]
                yield pa.RecordBatch.from_arrays(
                    [_column(a, f.type) for a, f in zip(held + made, target, strict=True)],
                    schema=target,
                )
        release()

    return rows.mapInArrow(run, schema)


def _column(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, kind)


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_groups(
    rows: DataFrame,
    key: str,
    work: Callable[[pa.Table], dict | None],
    ddl: str,
    partitions: int | None = None,
) -> DataFrame:
    """``work`` over all rows of each value of ``key``, many groups to a task.

    Rows are dealt out and sorted by ``key`` by Spark; a task holds one group at a time, so a
    caller bounds its groups. ``work`` returns a dict of columns, or None for no rows.
    """
    schema = T.StructType(fields(ddl))
    target = _arrow(schema)

    def flush(parts: list[pa.RecordBatch]) -> pa.RecordBatch | None:
        out = work(pa.Table.from_batches(parts))
        if out is None:
            return None
        return pa.RecordBatch.from_arrays(
            [_column(out[f.name], f.type) for f in target], schema=target
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[pa.RecordBatch] = []
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            bounds = [0, *cuts.tolist(), len(keys)]
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                if parts and keys[a] != held:
                    made = flush(parts)
                    parts = []
                    if made is not None:
                        yield made
                held = keys[a]
                parts.append(batch.slice(a, b - a))
        if parts:
            made = flush(parts)
            if made is not None:
                yield made
        parts = []
        release()

    dealt = rows.repartition(partitions, key) if partitions else rows.repartition(key)
    return dealt.sortWithinPartitions(key).mapInArrow(run, schema)


# A filter of fixed size: 2**26 bits are 8 MB, whatever the input. More keys make it let more rows
# through to the exact join behind it; no key is ever lost.
FILTER_BITS = 26


def _filter_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mixed = mix(keys.astype(np.uint64, copy=False))
    return mixed >> np.uint64(64 - bits), (mixed << np.uint64(bits)) >> np.uint64(64 - bits)


# Rows of a summed array, so that a row stays small.
_PIECES = 64


def sum_arrays(blobs: DataFrame, combine: str = "add") -> list[bytes]:
    """Combine rows ``(piece, data)`` of zipped int32 or bit arrays piece by piece.

    Two levels of merging, so that no task reads one piece from every task before. What reaches
    the driver is one array, whose size the caller fixed.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                values = np.frombuffer(zlib.decompress(data), np.uint8 if combine == "or" else np.int64)
                if piece not in held:
                    held[piece] = values.copy()
                elif combine == "or":
                    held[piece] |= values
                else:
                    held[piece] += values
        if held:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(list(held), pa.int32()),
                    pa.array([zlib.compress(v.tobytes(), 1) for v in held.values()], pa.binary()),
                ],
                names=["piece", "data"],
            )
        held = {}
        release()

    ddl = "piece int, data binary"
    salted = blobs.select("piece", "data").repartition(F.col("piece"), F.pmod(F.xxhash64("data"), F.lit(16)))
    merged = salted.mapInArrow(merge, ddl).repartition("piece").mapInArrow(merge, ddl)
    found = {r.piece: zlib.decompress(r.data) for r in merged.collect()}
    return [found.get(i, b"") for i in range(max(found, default=-1) + 1)]


def array_pieces(values: np.ndarray) -> dict[str, list]:
    """Columns ``piece`` and ``data`` of an array whose length is a multiple of 64."""
    parts = values.reshape(_PIECES, -1)
    return {
        "piece": list(range(_PIECES)),
        "data": [zlib.compress(p.tobytes(), 1) for p in parts],
    }


def key_filter(keys: DataFrame, column: str, bits: int = FILTER_BITS) -> np.ndarray:
    """A Bloom filter with two places per key, of fixed size, over a column of longs."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(1 << (bits - 3), np.uint8)
        any_row = False
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            if not len(values):
                continue
            any_row = True
            for p in _filter_places(values, bits):
                p = np.sort(p)
                byte, first = np.unique(p >> np.uint64(3), return_index=True)
                bit = np.uint8(128) >> (p & np.uint64(7)).astype(np.uint8)
                held[byte] |= np.bitwise_or.reduceat(bit, first)
        if any_row:
            made = array_pieces(held)
            yield pa.RecordBatch.from_arrays(
                [pa.array(made["piece"], pa.int32()), pa.array(made["data"], pa.binary())],
                names=["piece", "data"],
            )
        held = None
        release()

    blobs = keys.select(column).mapInArrow(build, "piece int, data binary")
    merged = b"".join(sum_arrays(blobs, "or"))
    if not merged:
        return np.zeros(1 << (bits - 3), np.uint8)
    return np.frombuffer(merged, np.uint8)


def in_filter(filter_bytes: np.ndarray, keys: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    """False means: certainly not among the keys."""
    out = np.ones(len(keys), bool)
    for p in _filter_places(keys, bits):
        out &= (filter_bytes[p >> np.uint64(3)] >> (np.uint64(7) - (p & np.uint64(7))).astype(np.uint8)) & 1 == 1
    return out


class Broadcasted:
    """A driver value of bounded size, sent once to each executor."""

    def __init__(self, spark: SparkSession, value):
        self._sent = spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self._sent.value

    def end(self) -> None:
        """Free it everywhere; what reads it must have been written or collected before."""
        self._sent.destroy()


MOST_ROUNDS = 60


def components(edges: DataFrame, rounds: int = MOST_ROUNDS) -> DataFrame:
    """``node, component`` for every node of ``edges (a, b)``: the smallest node it reaches.

    Alternating large and small stars. Minima are combined before the shuffle and joined back, so a
    node with very many neighbours is never gathered in a task. Each round is a written table.
    """
    links = staged(
        edges.filter("a != b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )

    def sign(table: DataFrame):
        return table.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    seen = sign(links)
    for _ in range(rounds):
        links_next = staged(_small_star(_large_star(links)), "links")
        now = sign(links_next)
        forget(links)
        links = links_next
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    nodes = links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.union(links.select("b", "b").distinct()).groupBy("node").agg(
        F.min("component").alias("component")
    )


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node moves to the node's smallest neighbour."""
    both = links.select("a", "b").union(links.select("b", "a")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    moved = both.filter("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return moved.filter("a != b").distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, move to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("m"))
    moved = links.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", "m")).filter("a != b").distinct()


def numbered(rows: DataFrame, group: list[str], spread: int = 64) -> DataFrame:
    """``rows`` (staged) with ``_number``: a gapless place from 0 within each group.

    A group is cut into ``spread`` slots of a per-row mix, each numbered in its own task, and slot
    counts give the offsets: groups times ``spread`` rows, whatever the groups hold.
    """
    from pyspark.sql import Window as W

    slotted = rows.withColumn("_slot", F.pmod(F.xxhash64("_row"), F.lit(spread)).cast("int"))
    counts = slotted.groupBy(*group, "_slot").agg(F.count("*").alias("_n"))
    before = W.partitionBy(*group).orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)],
        F.col("_slot").alias("_s"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
    )
    placed = slotted.withColumn(
        "_place", F.row_number().over(W.partitionBy(*group, "_slot").orderBy("_row"))
    )
    match = F.col("_s") == F.col("_slot")
    for i, c in enumerate(group):
        match = match & F.col(f"_g{i}").eqNullSafe(F.col(c))
    joined = placed.join(F.broadcast(offsets), match)
    return joined.withColumn("_number", F.col("_offset") + F.col("_place") - 1).drop(
        "_slot", "_s", "_offset", "_place", *[f"_g{i}" for i in range(len(group))]
    )


def meetings(
    nodes: DataFrame, node: str, group: str, weight: str, most_rows: int, most_weight: int
) -> DataFrame:
    """``node, meetings``: the bounded blocks in which each node meets those it may pair with.

    ``nodes`` also has an int column ``class``; only nodes of one group whose classes differ by at
    most one may pair. A group within both limits is one block. A larger one is cut into cells by
    class and hash, and every two cells that may hold a pair form a block. A meeting is
    ``(key, side, inner)``: the block, the node's cell, and whether pairs within a cell are the
    block's own; every pair of nodes is then met in exactly one block.
    """
    size = F.greatest(F.count("*") / most_rows, F.sum(weight) / most_weight)
    large = nodes.groupBy(group).agg(size.alias("size")).filter("size > 1").select(group)
    cells = (
        nodes.join(large, group)
        .groupBy(group, "class")
        .agg(F.ceil(2 * size).cast("int").alias("cells"))
    )
    wide = cells
    for name, shift in (("lower", 1), ("upper", -1)):
        other = cells.select(
            group, (F.col("class") + shift).alias("class"), F.col("cells").alias(name)
        )
        wide = wide.join(other, [group, "class"], "left")
    own = F.pmod(F.xxhash64(node), F.col("cells")).cast("int")
    placed = nodes.join(wide, [group, "class"], "left").withColumn("own", own)
    own, here = F.col("own"), F.col("class")

    def met(count, first, second, low, high):
        def one(j):
            key = F.xxhash64(F.col(group), first, second, low(j), high(j))
            return F.struct(
                key.alias("key"),
                F.xxhash64(here, own).alias("side"),
                ((first == second) & (low(j) == high(j))).alias("inner"),
            )

        none = F.array().cast("array<struct<key:bigint,side:bigint,inner:boolean>>")
        return F.when(
            count > 0, F.transform(F.sequence(F.lit(0), count - 1), one)
        ).otherwise(none)

    below, above = (F.coalesce(c, F.lit(0)) for c in ("lower", "upper"))
    cut = F.concat(
        met(F.col("cells"), here, here, lambda j: F.least(own, j), lambda j: F.greatest(own, j)),
        met(below, here - 1, here, lambda j: j, lambda j: own),
        met(above, here, here + 1, lambda j: own, lambda j: j),
    )
    whole = F.array(
        F.struct(
            F.xxhash64(group).alias("key"),
            F.lit(0).cast("bigint").alias("side"),
            F.lit(True).alias("inner"),
        )
    )
    return placed.select(
        node, F.when(F.col("cells").isNull(), whole).otherwise(cut).alias("meetings")
    )
