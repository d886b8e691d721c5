"""Data and log files."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from datetime import datetime
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import clock
from millrace.sinks.stage import stage_table


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def delete_folder(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return sorted(found.getPath().getName() for found in system.listStatus(target))


def create_file(spark: SparkSession, path: str, text: str = "") -> None:
    """A small file of the driver's, such as a marker; it must not exist."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_file(spark: SparkSession, path: str) -> str:
    """A small file of the driver's, whatever its name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def move(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; what is at ``target`` must be gone, its parent is made."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, target))
    system = old.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(new.getParent())
    if not system.rename(old, new):
        raise OSError(f"could not move {path} to {target}")


def dated_path(path: str, moment: datetime) -> str:
    """``path/yyyy/MM/dd``."""
    return f"{path.rstrip('/')}/{clock.day_folder(moment)}"


def dated_timed_path(path: str, moment: datetime) -> str:
    """``path/yyyy/MM/dd/HH-mm-ss``."""
    return f"{path.rstrip('/')}/{clock.day_time_folder(moment)}"


def sized(table: DataFrame, files: int | None) -> DataFrame:
    """``files`` output files, or as many as the plan has tasks.

    A number costs a shuffle but leaves everything before it parallel, where a coalesce to one
    would pull the whole scan into a single task.
    """
    return table if files is None else table.repartition(files)


def csv_delimiter(separator: str) -> str:
    """A separator as the CSV reader and writer want it: they read a backslash as an escape."""
    return separator.replace("\\", "\\\\")


_TASK_BITS = 33


def in_ordered_files(table: DataFrame, files: int, path: str) -> DataFrame:
    """An ordered result in ``files`` output files, in its order within and between them.

    Rows are numbered as the result's own last sort hands them out, and staged at ``path``: the
    statement runs once, with its usual tasks. Counts by task tell each row's rank and with it its
    file; files differ by one row at most. Rows that follow each other travel as one packed block,
    so the task that writes a file sorts some bytes a row, however wide the rows are.
    """
    place = "_place"
    while place in table.columns:
        place += "_"
    staged = stage_table(table.withColumn(place, F.monotonically_increasing_id()), path)
    # A number holds its task above 33 bits, and its row in the task below.
    by_task = staged.groupBy(F.shiftright(place, _TASK_BITS).alias("task")).count().toArrow().sort_by("task")
    tasks, many = (by_task.column(c).to_numpy() for c in ("task", "count"))
    before, total = np.cumsum(many) - many, int(many.sum())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number = batch.column(batch.schema.get_field_index(place)).to_numpy()
            rank = before[np.searchsorted(tasks, number >> _TASK_BITS)] + (number & (1 << _TASK_BITS) - 1)
            file = rank * files // max(total, 1)
            cuts = np.flatnonzero((np.diff(rank) != 1) | (np.diff(file) != 0)) + 1
            rows = batch.drop_columns([place])
            for a, b in pairwise([0, *cuts.tolist(), len(rank)] if len(rank) else []):
                block = pa.BufferOutputStream()
                with pa.ipc.new_stream(block, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(rows.slice(a, b - a))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file[a : a + 1], pa.int32()), pa.array(rank[a : a + 1]), pa.array([block.getvalue().to_pybytes()])],
                    names=["file", "rank", "block"],
                )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0):
                yield from pa.ipc.open_stream(block.as_buffer())

    packed = staged.mapInArrow(pack, "file int, rank long, block binary")
    dealt = packed.repartitionById(files, "file").sortWithinPartitions("rank")
    return dealt.select("block").mapInArrow(unpack, table.schema)


# Plan nodes that hand on their input's rows in its order.
_IN_ORDER = ("Project", "Filter", "GlobalLimit", "LocalLimit", "Offset", "SubqueryAlias")


def is_ordered(table: DataFrame) -> bool:
    """Whether the plan ends in a sort of all rows."""
    plan = table._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() in _IN_ORDER:
        plan = plan.children().apply(0)
    return plan.nodeName() == "Sort" and getattr(plan, "global")()


def write_data(table: DataFrame, path: str, separator: str) -> None:
    """Header CSV that replaces what is there. Empty text is written as nothing."""
    table.write.mode("overwrite").options(
        header=True, delimiter=csv_delimiter(separator), emptyValue=""
    ).csv(path)


def write_log(lines: DataFrame, path: str, files: int | None = None) -> None:
    """Text lines into a folder that must not exist yet.

    Rejects are few against the lines scanned, so without a file count they are rebalanced into
    files of a useful size, not one sliver per scan task.
    """
    sized_lines = lines.hint("rebalance") if files is None else sized(lines, files)
    sized_lines.write.mode("errorifexists").text(path)


# A null in a reject file; a text of this form gets one more backslash.
_NULL = r"\N"
_REJECT_FORMAT = {
    "header": True, "quoteAll": True, "escape": '"', "nullValue": _NULL, "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def write_rejects(table: DataFrame, path: str) -> None:
    """A table of texts as CSV with a header; commas, quotes, line ends, blanks, nulls come back."""
    texts = [
        F.when(F.col(f"`{c}`").rlike(r"^\\+N$"), F.concat(F.lit("\\"), F.col(f"`{c}`")))
        .otherwise(F.col(f"`{c}`"))
        .alias(c)
        for c in table.columns
    ]
    table.select(*texts).hint("rebalance").write.mode("errorifexists").options(**_REJECT_FORMAT).csv(path)


def read_rejects(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """What ``write_rejects`` wrote. A value may hold line ends, so a file is read by one task."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    read = spark.read.schema(schema).options(multiLine=True, **_REJECT_FORMAT).csv(path)
    return read.select(*[F.regexp_replace(f"`{c}`", r"^\\(\\+N)$", "$1").alias(c) for c in columns])


def write_small_log(lines: DataFrame, path: str) -> None:
    """A log of a few aggregated rows, such as a run record or a manifest, as one file.

    What fills the rows has ended at a shuffle before, so the coalesce only gathers results.
    """
    lines.coalesce(1).write.mode("errorifexists").text(path)
