"""Staged tables in the shared folder of the cluster.

A staged table cuts the lineage behind several consumers. It lies on shared storage, so a lost
executor costs a re-read of a file and never a second pass over the raw text.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# The folder of a local session that names none: one per process, gone when it ends.
_LOCAL: list[tempfile.TemporaryDirectory] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder the session names. Only a local session may go without."""
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_DIR, None) or context.getCheckpointDir()
    if named:
        return named
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder every executor can reach")
    if not _LOCAL:
        _LOCAL.append(tempfile.TemporaryDirectory(prefix="millrace-"))
    return f"file://{_LOCAL[0].name}"


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below the shared folder; nothing is created yet."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stage_table(table: DataFrame, path: str) -> DataFrame:
    table.write.mode("errorifexists").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)
