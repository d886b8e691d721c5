"""What a line's origin decides: which of several records stays, and the system it came from."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.raw import ORIGIN, file_of, one_form

# Fixed name of the column that tells the source system.
SOURCE_SYSTEM = "lets_src_sys_nm"

FIRST = "first"
LAST = "last"


def keep_one(
    rows: DataFrame, key: Sequence[str] | str, which: str = FIRST, origin: str = ORIGIN
) -> DataFrame:
    """One row of each ``key``: the first or last by origin. The origin column goes.

    Every task keeps one row per key before rows move, so a key that most rows share costs one row
    per task and no group is gathered. Origins are distinct, so the answer does not depend on how
    many tasks read the files. Null keys are one key.
    """
    if which not in (FIRST, LAST):
        raise ValueError(f"keep {FIRST!r} or {LAST!r}, not {which!r}")
    keys = [key] if isinstance(key, str) else list(key)
    kept = [c for c in rows.columns if c != origin]
    choose = F.min_by if which == FIRST else F.max_by
    row = F.struct(*[F.col(f"`{c}`") for c in kept])
    chosen = rows.groupBy(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        choose(row, F.col(origin)).alias("_row")
    )
    return chosen.select(*[F.col(f"_row.`{c}`").alias(c) for c in kept])


def qualified(spark: SparkSession, path: str) -> str:
    """A folder or file as scans name it: with its scheme, escaped, without a slash at its end."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return one_form(system.makeQualified(target).toUri().toString())


def source_system(spark: SparkSession, systems: Mapping[str, str], path: Column) -> Column:
    """The system whose folder or file holds ``path``; of several the longest, of none null."""
    file = file_of(path)
    found = F.lit(None).cast("string")
    named = {qualified(spark, folder): name for folder, name in systems.items()}
    for folder in sorted(named, key=len):
        inside = (file == folder) | file.startswith(folder.rstrip("/") + "/")
        found = F.when(inside, F.lit(named[folder])).otherwise(found)
    return found
