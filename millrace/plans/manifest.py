"""One manifest: line counts of several folders into one text file."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import SparkSession

from millrace.functions import clock
from millrace.operators.metrics import folder_manifest, manifest_lines
from millrace.sinks.files import write_small_log


def run_manifest(
    spark: SparkSession,
    folders: Mapping[str, str] | Sequence[tuple[str, str]],
    output_path: str,
    now: Callable[[], datetime] = datetime.now,
) -> None:
    """One line per named folder; pairs may name a folder twice, and each is counted."""
    manifest = folder_manifest(spark, folders, clock.stamp(now()))
    write_small_log(manifest_lines(manifest), output_path)
