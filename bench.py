"""Headline timings on one machine: one JSON line.

The driver's lineitem table is written once as raw delimited text, because text files are what
a load reads. Each headline runs warm, and the median of its runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance import fixture as fx
from acceptance import queries as registered
from acceptance import statements
from millrace import DIMENSION, FACT, Options, build_session, run_load
from millrace.operators.classify import accepted_rows, classify, pinned
from millrace.operators.integrate import integrate, stamp
from millrace.operators.metrics import folder_manifest, line_counts
from millrace.operators.rejects import reject_lines
from millrace.sinks.files import delete_folder, write_data
from millrace.session import job_session
from millrace.sinks.stage import new_folder
from millrace.sources.raw import join_fields, read_lines, split_fields
from millrace.sources.spec import Dimension

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 5
WIDE = 200


def drain(table: DataFrame) -> None:
    table.write.format("noop").mode("overwrite").save()


def prepare(spark: SparkSession) -> str:
    """Raw lines, dimension files, spec and manifest folders for the loads."""
    home = new_folder(spark, "bench")
    tasks = int(CPUS)
    fx.main_lines(spark, SF_DIR).repartition(tasks).write.text(f"{home}/raw")
    fx.number_lines(spark, SF_DIR).repartition(tasks).write.text(f"{home}/numbers")
    write_data(fx.table(spark, SF_DIR, "part").select(*registered.PART_COLUMNS), f"{home}/part", "|")
    write_data(
        fx.table(spark, SF_DIR, "supplier").select(*registered.SUPPLIER_COLUMNS),
        f"{home}/supplier",
        "|",
    )
    for name in ("customer", "orders", "events"):
        join_fields(fx.table(spark, SF_DIR, name)).write.text(f"{home}/{name}")
    spec = statements.spec_text(
        home,
        statements.FACT_JOIN,
        {
            "part_dim": ("part", registered.PART_SELECT),
            "supplier_dim": ("supplier", registered.SUPPLIER_SELECT),
        },
    )
    write_spec(spark, f"{home}/spec", spec)
    # A third of the lines with one key; a tenth of the lines with 200 fields each.
    fields = F.split("value", r"\|")
    hot = F.when(F.hash("value") % 3 == 0, F.lit("1")).otherwise(fields[1])
    fx.main_lines(spark, SF_DIR).filter(F.size(fields) == 5).select(
        F.concat_ws("|", fields[0], hot, fields[2], fields[3], fields[4]).alias("value")
    ).repartition(tasks).write.text(f"{home}/hot")
    number = F.col("l_orderkey").cast("string")
    fx.table(spark, SF_DIR, "lineitem").filter("l_orderkey % 10 = 0").select(
        F.concat_ws("|", *[number] * WIDE).alias("value")
    ).repartition(tasks).write.text(f"{home}/wide")
    write_spec(spark, f"{home}/wide_spec", wide_spec())
    write_spec(spark, f"{home}/flat_spec", statements.spec_text(home, statements.PROJECT, {}))
    return home


def wide_spec() -> str:
    """200 columns, of which the statement reads six."""
    kinds = ("IntegerType", "DoubleType", "StringType")
    query = "select c0, c1, c2, c50 from src where c99 >= 0 and c199 is not null"
    return "\n".join(
        [f"MetaData:=c{i}:={kinds[i % 3]}" for i in range(WIDE)]
        + ["Data:=Sep:=|", "Query:=Temp_Table:=src", f"Query:=Main_Query:={query}"]
        + ["DATAQUALITY:=BatchId:=B1", "DATAQUALITY:=ActivityId:=A1"]
    )


def write_spec(spark: SparkSession, path: str, spec: str) -> None:
    spark.range(0, 1, 1, 1).select(F.lit(spec).alias("value")).write.text(path)


def headlines(spark: SparkSession, home: str) -> dict[str, Callable[[], None]]:
    def classified() -> DataFrame:
        lines = read_lines(spark, f"{home}/raw")
        return pinned(classify(split_fields(lines, "|"), fx.MAIN_SPEC))

    def numbers() -> DataFrame:
        lines = read_lines(spark, f"{home}/numbers")
        return pinned(classify(split_fields(lines, "||"), fx.NUMBER_SPEC))

    def fact_join() -> DataFrame:
        spec = replace(fx.MAIN_SPEC, query=statements.FACT_JOIN, dimensions=dimensions)
        joined = integrate(spark, accepted_rows(classified(), spec), spec)
        return stamp(joined, fx.RUN_TIME, fx.LABEL.batch_id)

    def skewed_join() -> DataFrame:
        """A third of all lines share one key, and nothing is broadcast."""
        session = job_session(spark)
        for key in ("autoBroadcastJoinThreshold", "adaptive.autoBroadcastJoinThreshold"):
            session.conf.set(f"spark.sql.{key}", "-1")
        lines = pinned(classify(split_fields(read_lines(session, f"{home}/hot"), "|"), fx.MAIN_SPEC))
        query = (
            "select d.brand, count(*) as n from src s join part_dim d on s.pk = d.partkey "
            "group by d.brand"
        )
        spec = replace(fx.MAIN_SPEC, query=query, dimensions=dimensions[:1])
        return integrate(session, accepted_rows(lines, spec), spec)

    def load(preset, spec: str, options: Options, raw: str = "raw") -> None:
        out = new_folder(spark, "bench-out")
        paths = [f"{out}/{name}" for name in ("data", "error", "audit")]
        run_load(spark, preset, f"{home}/{spec}", f"{home}/{raw}", *paths, options=options)
        delete_folder(spark, out)

    dimensions = (
        Dimension("part_dim", f"{home}/part", registered.PART_SELECT),
        Dimension("supplier_dim", f"{home}/supplier", registered.SUPPLIER_SELECT),
    )
    folders = {name: f"{home}/{name}" for name in ("customer", "orders", "events")}
    return {
        "field_split": lambda: drain(split_fields(read_lines(spark, f"{home}/raw"), "|")),
        "classify": lambda: drain(classified()),
        "typed_convert": lambda: drain(accepted_rows(numbers(), fx.NUMBER_SPEC)),
        "fact_join": lambda: drain(fact_join()),
        "reject_log": lambda: drain(reject_lines(classified(), fx.LABEL)),
        "line_counts": lambda: drain(line_counts(classified())),
        "folder_manifest": lambda: drain(folder_manifest(spark, folders, fx.RUN_TIME)),
        "full_fact_load": lambda: load(FACT, "spec", Options()),
        "full_fact_load_rescan": lambda: load(FACT, "spec", Options(stage=False)),
        "full_dimension_load": lambda: load(DIMENSION, "flat_spec", Options()),
        "skewed_join": lambda: drain(skewed_join()),
        "wide_fact_load": lambda: load(FACT, "wide_spec", Options(), "wide"),
        "wide_fact_load_rescan": lambda: load(FACT, "wide_spec", Options(stage=False), "wide"),
    }


def main() -> None:
    settings = {
        "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
    }
    spark = build_session("millrace-bench", f"local[{CPUS}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    home = prepare(spark)
    seconds = {}
    for name, run in headlines(spark, home).items():
        run()
        times = []
        for _ in range(RUNS):
            begun = time.perf_counter()
            run()
            times.append(time.perf_counter() - begun)
        seconds[name] = round(statistics.median(times), 3)
    print(
        json.dumps(
            {
                "metric": "total_headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    delete_folder(spark, home)
    spark.stop()


if __name__ == "__main__":
    main()
