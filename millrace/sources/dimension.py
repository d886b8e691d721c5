"""Dimension files: delimited text with a header, every column read as text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.sinks.files import csv_delimiter

# Dimension files keep this delimiter whatever separator the raw input has.
DIMENSION_DELIMITER = "|"


def read_dimension(
    spark: SparkSession, path: str, delimiter: str = DIMENSION_DELIMITER
) -> DataFrame:
    """All columns stay text, so the scan needs no inference pass; empty text reads as null."""
    return spark.read.options(header=True, delimiter=csv_delimiter(delimiter)).csv(path)


def project_dimension(
    spark: SparkSession, table: DataFrame, name: str, select_list: str
) -> DataFrame:
    """Register ``table`` as ``name``, then let its projection take over that name."""
    table.createOrReplaceTempView(name)
    projected = spark.sql(f"select {select_list} from {name}")
    projected.createOrReplaceTempView(name)
    return projected
