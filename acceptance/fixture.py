"""Raw lines, spec lines and dimensions derived from the given tables, whole tables each.

Damage depends on row values only, so a plain SQL statement can repeat it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.classify import classify, pinned
from millrace.operators.rejects import RunLabel
from millrace.sources.raw import split_fields
from millrace.sources.spec import JobSpec

RUN_MOMENT = datetime(2024, 1, 1)
RUN_TIME = "2024-01-01 00:00:00"
LABEL = RunLabel("B1", "A1", RUN_TIME)

MAIN_SPEC = JobSpec(
    columns=(
        ("ok", "IntegerType"),
        ("pk", "IntegerType"),
        ("sk", "IntegerType"),
        ("rf", "StringType"),
        ("ls", "StringType"),
    ),
    separator="|",
    view="src",
    query="select * from src",
    batch_id=LABEL.batch_id,
    activity_id=LABEL.activity_id,
    required=(3,),
)

NUMBER_SPEC = JobSpec(
    columns=(
        ("ok", "IntegerType"),
        ("disc", "FloatType"),
        ("price", "DoubleType"),
        ("note", "TextType"),
    ),
    separator="||",
    view="src",
    query="select * from src",
    batch_id=LABEL.batch_id,
    activity_id=LABEL.activity_id,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def _line_number_is(number: int) -> Column:
    return F.col("l_linenumber") == number


def main_lines(spark: SparkSession, sf_dir: str, *carry: str) -> DataFrame:
    """Lineitem as damaged lines of five fields: the main fixture."""
    supplier = (
        F.when(_line_number_is(3), "12.7").when(_line_number_is(4), "").otherwise(text("l_suppkey"))
    )
    flag = F.when(F.col("l_returnflag") == "R", "null").otherwise(F.col("l_returnflag"))
    status = F.when(~_line_number_is(2), F.col("l_linestatus"))
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            "|", text("l_orderkey"), text("l_partkey"), supplier, flag, status
        ).alias("value"),
        *carry,
    )


def marker_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main lines, where two line numbers also hold the marker word in accepted rows.

    Line number 5 has it inside a field with commas and an empty last field; line number 6 has
    it across two fields.
    """
    supplier = (
        F.when(_line_number_is(3), "1,2.7").when(_line_number_is(4), "").otherwise(text("l_suppkey"))
    )
    flag = (
        F.when(_line_number_is(5), F.concat(F.lit("a,NullException "), F.col("l_returnflag"), F.lit(",,")))
        .when(_line_number_is(6), F.concat(F.col("l_returnflag"), F.lit("Excep")))
        .when(F.col("l_returnflag") == "R", "null")
        .otherwise(F.col("l_returnflag"))
    )
    status = (
        F.when(_line_number_is(5), "")
        .when(_line_number_is(6), F.concat(F.lit("tion"), F.col("l_linestatus")))
        .when(~_line_number_is(2), F.col("l_linestatus"))
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws(
            "|", text("l_orderkey"), text("l_partkey"), supplier, flag, status
        ).alias("value")
    )


def number_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem as lines of an integer, a float, a double and a text, separated by two bars."""
    quantity = F.col("l_quantity").cast("decimal(18,2)").cast("string")
    discount = F.col("l_discount").cast("decimal(18,2)").cast("string")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    order = (
        F.when(_line_number_is(1), F.concat(F.lit("+"), text("l_orderkey")))
        .when(_line_number_is(2), F.concat(F.lit(" "), text("l_orderkey")))
        .otherwise(text("l_orderkey"))
    )
    disc = (
        F.when(_line_number_is(3), F.concat(discount, F.lit("f")))
        .when(_line_number_is(4), F.lit(" q "))
        .when(_line_number_is(5), F.concat(F.lit(" "), discount, F.lit("e1 ")))
        .otherwise(discount)
    )
    cost = (
        F.when(_line_number_is(6), F.concat(price, F.lit("."), quantity))
        .when((_line_number_is(7)) & (F.col("l_linestatus") == "O"), F.lit("  "))
        .when((_line_number_is(7)), F.lit("inf"))
        .otherwise(price)
    )
    return table(spark, sf_dir, "lineitem").select(
        F.concat_ws("||", order, disc, cost, F.col("l_returnflag")).alias("value")
    )


def spec_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as settings: a section per order status, a key per customer, last order wins."""
    section = (
        F.when(F.col("o_orderstatus") == "O", "MetaData")
        .when(F.col("o_orderstatus") == "F", " FactJoin ")
        .otherwise("Other")
    )
    type_name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "IntegerType")
        .when(F.col("o_orderpriority") == "2-HIGH", "FloatType]")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "DoubleType")
        .when(F.col("o_orderpriority") == "5-LOW", "StringType")
        .otherwise("DateType")
    )
    key = F.concat(F.lit(" c"), text("o_custkey"), F.lit(" "))
    extra = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("x"), text("o_orderkey")))
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("line_no"),
        F.concat_ws(":=", section, key, type_name, extra, F.lit("")).alias("line"),
    )


def classified_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pinned(classify(split_fields(main_lines(spark, sf_dir), "|"), MAIN_SPEC))


def classified_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pinned(classify(split_fields(marker_lines(spark, sf_dir), "|"), MAIN_SPEC))


def classified_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pinned(classify(split_fields(number_lines(spark, sf_dir), "||"), NUMBER_SPEC))


def as_text(source: DataFrame) -> DataFrame:
    """A table the way a dimension file gives it: every column text."""
    return source.select(*[text(name).alias(name) for name in source.columns])


def file_dimension(spark: SparkSession, sf_dir: str, name: str, columns: list[str]) -> DataFrame:
    return as_text(table(spark, sf_dir, name).select(*columns))
