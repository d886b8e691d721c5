"""What the physical plans must and must not hold."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import replace

import pytest

from acceptance import fixture as fx
from acceptance import statements
from acceptance.queries import PART_SELECT, registered
from millrace.operators.classify import accepted_rows, classify, pinned
from millrace.operators.integrate import integrate
from millrace.sinks.files import write_data
from millrace.session import job_session
from millrace.sinks.stage import new_folder, stage_table
from millrace.sources.dimension import project_dimension, read_dimension
from millrace.sources.raw import read_lines, split_fields
from millrace.sources.spec import Dimension

SF_DIR = "/root/testdata/sf0.001"
QUERIES = registered()


def plan_of(table) -> str:
    return table._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert not re.search(r"Python|InPandas|Cartesian|BroadcastNestedLoop|ExternalRDD", plan)


@pytest.mark.parametrize("name", ["fact_join", "sql_semi_anti", "sql_window", "reject_log"])
def test_lines_are_split_once_per_pass(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    scans = plan.count("ReadSchema: struct<l_orderkey")
    assert scans == 1
    assert plan.count("split(value") == scans


def test_row_checks_do_not_shuffle(spark):
    for name in ("typed_convert", "reject_log", "audit_stamp", "sql_filter", "required_filter"):
        assert "Exchange" not in plan_of(QUERIES[name](spark, SF_DIR)), name


def test_dimensions_are_broadcast_only_below_the_threshold(spark):
    assert plan_of(QUERIES["fact_join"](spark, SF_DIR)).count("BroadcastHashJoin") == 2
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        plan = plan_of(QUERIES["fact_join"](spark, SF_DIR))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2


def test_dimension_scan_reads_only_projected_columns(spark):
    folder = new_folder(spark, "plan-dim")
    write_data(fx.table(spark, SF_DIR, "part"), folder, "|")
    dim = project_dimension(spark, read_dimension(spark, folder), "plan_dim", PART_SELECT)
    plan = dim.select("brand")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_brand:string>" in plan


def test_staged_lines_are_pruned_and_filtered_at_the_scan(spark):
    raw = new_folder(spark, "plan-raw")
    fx.main_lines(spark, SF_DIR).write.text(raw)
    lines = classify(split_fields(read_lines(spark, raw), "|"), fx.MAIN_SPEC)
    staged = stage_table(lines, new_folder(spark, "plan-staged"))
    accepted = accepted_rows(staged, fx.MAIN_SPEC)
    plan = plan_of(accepted.filter("ls = 'O'").select("pk"))
    assert "ReadSchema: struct<status:string,v1:int,v4:string>" in plan
    assert "EqualTo(status,ok)" in plan and "EqualTo(v4,O)" in plan


def test_each_rank_group_is_limited_before_the_shuffle(spark):
    plan = plan_of(QUERIES["sql_window"](spark, SF_DIR))
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_top_rows_come_from_per_task_heaps(spark):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["sql_topk"](spark, SF_DIR))


def test_statement_sees_views_of_its_own_run(spark):
    accepted = accepted_rows(fx.classified_main(spark, SF_DIR), fx.MAIN_SPEC)
    first = integrate(spark, accepted, fx.MAIN_SPEC)
    integrate(spark, accepted.limit(0), fx.MAIN_SPEC)
    assert first.count() > 0
    assert "src" in statements.FACT_JOIN


def test_hot_join_key_is_split(spark, home):
    """A third of all lines share one key, and the dimension is too large to broadcast."""
    spark.range(0, 60000, 1, 8).selectExpr(
        "concat(id, '|', if(id % 3 = 0, 7, id % 5000), '|1|A|O') as value"
    ).write.text(f"{home}/raw")
    spark.range(0, 5000, 1, 1).selectExpr("id as k", "concat('brand', id % 10) as brand").write.csv(
        f"{home}/dim", sep="|", header=True
    )
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    caller = spark.newSession()
    for key, value in settings.items():
        caller.conf.set(key, value)
    session = job_session(caller)
    assert session.conf.get("spark.sql.adaptive.forceOptimizeSkewedJoin") == "true"
    query = (
        "select d.brand, count(*) as n, sum(s.ok) as total from src s join dim d on s.pk = cast(d.k as int) "
        "group by d.brand"
    )
    spec = replace(
        fx.MAIN_SPEC, query=query, dimensions=(Dimension("dim", f"{home}/dim", "k, brand"),)
    )
    lines = split_fields(read_lines(session, f"{home}/raw"), "|")
    joined = integrate(session, accepted_rows(pinned(classify(lines, spec)), spec), spec)
    counts = {row.brand: row.n for row in joined.collect()}
    keys = [7 if i % 3 == 0 else i % 5000 for i in range(60000)]
    assert counts == Counter(f"brand{key % 10}" for key in keys)
    assert "skew=true" in plan_of(joined)
