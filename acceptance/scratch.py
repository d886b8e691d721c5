"""Folders for what the queries write, removed when the process ends."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import SparkSession

from millrace.sinks import stage
from millrace.sinks.files import delete_folder

_BASES: dict[str, str] = {}


def new_folder(spark: SparkSession, label: str) -> str:
    """A path of its own below one folder per process and shared folder."""
    shared = stage.shared_folder(spark)
    if shared not in _BASES:
        _BASES[shared] = stage.new_folder(spark, "acceptance")
        atexit.register(_remove, spark, _BASES[shared])
    return f"{_BASES[shared]}/{label}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, path: str) -> None:
    # A session that ended has no file system to ask; its own cleaning is then the caller's.
    if spark.sparkContext._jsc is not None:
        delete_folder(spark, path)
