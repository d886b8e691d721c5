"""Run counts, the run record and folder manifests."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.classify import ARITY, CONVERT, MARKED, OK, REQUIRED, STATUS
from millrace.operators.rejects import is_logged
from millrace.sources.raw import input_paths, input_roots, read_roots

# Fixed status code of a run record: in progress.
IN_PROGRESS = "2"

RUN_RECORD_COLUMNS = (
    "batch_id",
    "activity_id",
    "status",
    "start_ts",
    "end_ts",
    "records_read",
    "records_written",
    "records_rejected",
)
MANIFEST_COLUMNS = ("name", "record_count", "counted_at")


def line_count_columns(strict: bool = False, log_required: bool = False) -> list[Column]:
    """The counts of a classified table, as aggregates to compute or to observe."""
    status = F.col(STATUS)
    return [
        F.count("*").alias("records_read"),
        F.count_if(is_logged(strict, log_required)).alias("records_rejected"),
        F.count_if(status == OK).alias("accepted"),
        F.count_if(status == ARITY).alias("arity"),
        F.count_if(status == REQUIRED).alias("required"),
        F.count_if(status == CONVERT).alias("convert"),
        F.count_if(F.col(MARKED)).alias("marked"),
    ]


def line_counts(
    classified: DataFrame, strict: bool = False, log_required: bool = False
) -> DataFrame:
    """One row of exact counts over the classified table."""
    return classified.agg(*line_count_columns(strict, log_required))


def run_record(
    counts: DataFrame,
    batch_id: str,
    activity_id: str,
    start_time: str,
    end_time: str,
    status: str = IN_PROGRESS,
) -> DataFrame:
    """The eight fields of a run record for each row of counts."""
    return counts.select(
        F.lit(batch_id).alias("batch_id"),
        F.lit(activity_id).alias("activity_id"),
        F.lit(status).alias("status"),
        F.lit(start_time).alias("start_ts"),
        F.lit(end_time).alias("end_ts"),
        "records_read",
        "records_written",
        "records_rejected",
    )


def run_record_line(record: DataFrame) -> DataFrame:
    parts = [F.col(c).cast("string") for c in RUN_RECORD_COLUMNS]
    return record.select(F.concat_ws(",", *parts).alias("value"))


def folder_manifest(
    spark: SparkSession,
    folders: Mapping[str, str] | Sequence[tuple[str, str]],
    counted_at: str,
) -> DataFrame:
    """``name, record_count, counted_at`` per folder; each folder is counted where it lies.

    Pairs may repeat a name. A path may be a comma-separated list, as in a load; a file that it
    names twice counts once. One scan reads the files of all folders, each file once: lines are
    counted by file, and a file's count goes to every folder that holds it.
    """
    pairs = list(folders.items() if isinstance(folders, Mapping) else folders)
    held, paths = [], {}
    for place, (_, path) in enumerate(pairs):
        for root, nested in input_roots(spark, *input_paths(path)):
            held.append((place, root))
            paths[root] = nested
    by_file = read_roots(spark, paths).groupBy("file").agg(F.count("*").alias("lines"))
    parent = F.regexp_replace("file", "/[^/]*$", "")
    owners = spark.createDataFrame(held, "place int, root string")
    sums = (
        by_file.select("file", "lines", F.explode(F.array("file", parent)).alias("root"))
        .join(owners, "root")
        .select("place", "file", "lines")
        .distinct()
        .groupBy("place")
        .agg(F.sum("lines").alias("lines"))
    )
    names = spark.createDataFrame(
        [(place, name) for place, (name, _) in enumerate(pairs)], "place int, name string"
    )
    return names.join(sums, "place", "left").select(
        "name",
        F.coalesce("lines", F.lit(0)).alias("record_count"),
        F.lit(counted_at).alias("counted_at"),
    )


def manifest_lines(manifest: DataFrame) -> DataFrame:
    parts = [F.col(c).cast("string") for c in MANIFEST_COLUMNS]
    return manifest.select(F.concat_ws("|", *parts).alias("value"))
