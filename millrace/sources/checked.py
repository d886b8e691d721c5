"""Dimensions staged as they are read, with a check of their keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks.stage import new_folder, stage_table


@dataclass(frozen=True)
class FanOut:
    """Keys of a dimension that stand in more than one of its rows, and the rows beyond the first."""

    name: str
    keys: tuple[str, ...]
    doubled_keys: int
    extra_rows: int


def doubled_keys(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys`` and ``rows`` of each key that stands in several rows. Null keys join nothing."""
    there = F.lit(True)
    for k in keys:
        there = there & F.col(f"`{k}`").isNotNull()
    return (
        table.filter(there)
        .groupBy(*[F.col(f"`{k}`") for k in keys])
        .agg(F.count("*").alias("rows"))
        .filter("rows > 1")
    )


def staged_dimension(
    spark: SparkSession, table: DataFrame, name: str, keys: tuple[str, ...], folders: list[str]
) -> tuple[DataFrame, DataFrame]:
    """The dimension's projection as a staged table, and its doubled keys.

    The dimension's files are read once; statement and check read the staged copy, the check its
    key columns only. The new folder is added to ``folders``.
    """
    folders.append(new_folder(spark, f"dimension-{name}"))
    staged = stage_table(table, folders[-1])
    return staged, doubled_keys(staged, keys)


def fan_out(doubled: DataFrame, name: str, keys: tuple[str, ...]) -> FanOut:
    row = doubled.agg(F.count("*").alias("n"), F.sum(F.col("rows") - 1).alias("extra")).first()
    return FanOut(name, keys, row.n, row.extra or 0)
