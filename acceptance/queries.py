"""One query per operator. Each takes (spark, sf_dir) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from acceptance import fixture as fx
from acceptance import statements
from millrace.functions.convert import resolve_type_column
from millrace.operators import classify as checks
from millrace.operators import metrics, rejects
from millrace.operators.integrate import integrate, stamp
from millrace.operators.origin import SOURCE_SYSTEM
from millrace.plans.history import read_history
from millrace.plans.load import DIMENSION, FACT, LoadResult, Options, Preset, run_load
from millrace.plans.manifest import run_manifest
from millrace.sinks.files import (
    dated_path,
    dated_timed_path,
    read_rejects,
    write_data,
    write_log,
)
from millrace.sinks.stage import stage_table
from acceptance.scratch import new_folder
from millrace.sources.dimension import project_dimension, read_dimension
from millrace.sources.raw import (
    join_fields,
    read_lines,
    read_lines_with_origin,
    split_fields,
)
from millrace.sources.spec import lookup_setting, section_entries

Query = Callable[[SparkSession, str], DataFrame]

PART_COLUMNS = ["p_partkey", "p_name", "p_brand", "p_type"]
PART_SELECT = "cast(p_partkey as int) as partkey, p_brand as brand, upper(p_type) as kind"
SUPPLIER_COLUMNS = ["s_suppkey", "s_name", "s_nationkey"]
SUPPLIER_SELECT = "cast(s_suppkey as int) as suppkey, cast(s_nationkey as int) as nation"


def raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "raw")
    fx.main_lines(spark, sf_dir).write.text(folder)
    return read_lines(spark, folder)


def field_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = split_fields(fx.main_lines(spark, sf_dir), "|")
    return fields.select(
        F.size("fields").alias("n"), *[checks.field_at(i).alias(f"f{i}") for i in range(5)]
    )


def dim_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "dimension")
    part = fx.table(spark, sf_dir, "part").select(
        "p_partkey",
        "p_name",
        F.when(F.col("p_brand") == "Brand#1", "").otherwise(F.col("p_brand")).alias("p_brand"),
        "p_type",
    )
    write_data(part, folder, "|")
    return read_dimension(spark, folder)


def spec_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = section_entries(fx.spec_lines(spark, sf_dir), ("MetaData", "FactJoin"))
    return entries.select("section", "key", "first_line", "value", "extra", "bad_value", "bad_extra")


def spec_sections_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = section_entries(fx.spec_lines(spark, sf_dir), ("Data", "Fact", "x1"), "contains")
    return entries.select("section", "key", "first_line", "value", "extra")


def spec_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_setting(fx.spec_lines(spark, sf_dir), "METADATA").select("value")


def declared_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = section_entries(fx.spec_lines(spark, sf_dir), ("MetaData",))
    return entries.select(
        F.col("key").alias("name"),
        F.col("first_line").alias("place"),
        resolve_type_column(F.col("value")).alias("type_name"),
    )


def typed_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checks.accepted_rows(fx.classified_numbers(spark, sf_dir), fx.NUMBER_SPEC)
    return rows.withColumn("disc", F.col("disc").cast("double"))


def convert_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.failed_conversions(fx.classified_numbers(spark, sf_dir))


def line_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.classified_main(spark, sf_dir).groupBy("status").agg(F.count("*").alias("lines"))


def _joined(fields: DataFrame) -> DataFrame:
    return fields.select(F.concat_ws("|", "fields").alias("line"))


def arity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = split_fields(fx.main_lines(spark, sf_dir), "|")
    return _joined(checks.filter_arity(fields, fx.MAIN_SPEC.arity))


def arity_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = split_fields(fx.main_lines(spark, sf_dir), "|")
    return _joined(checks.filter_arity_mode(fields, fx.MAIN_SPEC.arity, mismatched=True))


def required_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = split_fields(fx.main_lines(spark, sf_dir), "|")
    return _joined(checks.filter_required(fields, fx.MAIN_SPEC))


def empty_key_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which the language or source stands in for a missing key."""
    docs = fx.table(spark, sf_dir, "documents").select(
        F.concat_ws(
            "|",
            F.when(F.col("lang") == "en", "").otherwise(fx.text("doc_id")),
            fx.text("n_chars"),
            F.col("source"),
        ).alias("value")
    )
    return _joined(checks.empty_key_rows(split_fields(docs, "|"), 3))


def dim_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = fx.file_dimension(spark, sf_dir, "part", PART_COLUMNS)
    return project_dimension(spark, part, "part_dim", PART_SELECT)


def _statement(sql: str) -> Query:
    """A statement over the accepted main lines and two projected dimensions."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        part = fx.file_dimension(spark, sf_dir, "part", PART_COLUMNS)
        supplier = fx.file_dimension(spark, sf_dir, "supplier", SUPPLIER_COLUMNS)
        project_dimension(spark, part, "part_dim", PART_SELECT)
        project_dimension(spark, supplier, "supplier_dim", SUPPLIER_SELECT)
        spec = replace(fx.MAIN_SPEC, query=sql)
        accepted = checks.accepted_rows(fx.classified_main(spark, sf_dir), spec)
        return integrate(spark, accepted, spec)

    return query


fact_join = _statement(statements.FACT_JOIN)


def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = checks.accepted_rows(fx.classified_main(spark, sf_dir), fx.MAIN_SPEC)
    named = rows.withColumnRenamed("ls", "LETS_ATV_FLG")
    return stamp(named, fx.RUN_TIME, fx.LABEL.batch_id).withColumnRenamed(
        "LETS_ATV_FLG", "lets_atv_flg"
    )


def integrated_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(fact_join(spark, sf_dir), fx.RUN_TIME, fx.LABEL.batch_id)


def reject_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.classified_main(spark, sf_dir)
    return rejects.reject_table(lines, fx.LABEL, rejects.is_arity_reject())


def reject_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.classified_main(spark, sf_dir)
    return rejects.reject_table(lines, fx.LABEL, rejects.is_convert_reject())


def reject_marker(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.classified_marker(spark, sf_dir)
    return rejects.reject_table(lines, fx.LABEL, rejects.is_marker_reject())


def reject_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rejects.reject_lines(fx.classified_marker(spark, sf_dir), fx.LABEL)
    return lines.withColumnRenamed("value", "line")


def reject_log_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = rejects.reject_lines(
        fx.classified_marker(spark, sf_dir), fx.LABEL, strict=True, log_required=True
    )
    return lines.withColumnRenamed("value", "line")


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a whole load, as one row."""
    counts = _load(spark, sf_dir, DIMENSION, fx.main_lines(spark, sf_dir), True).counts
    return spark.range(0, 1, 1, 1).select(
        *[F.lit(n).cast("bigint").alias(name) for name, n in counts.items()]
    )


def run_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def audit_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = metrics.run_record(_counts(spark, sf_dir), "B1", "A1", fx.RUN_TIME, fx.RUN_TIME)
    return metrics.run_record_line(record).withColumnRenamed("value", "line")


def folder_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    folders = {}
    for name in ("customer", "part", "supplier"):
        folders[name] = new_folder(spark, name)
        join_fields(fx.table(spark, sf_dir, name)).write.text(folders[name])
    return metrics.folder_manifest(spark, folders, fx.RUN_TIME)


def manifest_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = folder_manifest(spark, sf_dir)
    return metrics.manifest_lines(manifest).withColumnRenamed("value", "line")


def data_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = dated_path(new_folder(spark, "data"), fx.RUN_MOMENT)
    rows = checks.accepted_rows(fx.classified_marker(spark, sf_dir), fx.MAIN_SPEC)
    write_data(stamp(rows, fx.RUN_TIME, "B1"), folder, ";")
    return read_dimension(spark, folder, ";")


def log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = dated_timed_path(new_folder(spark, "log"), fx.RUN_MOMENT)
    write_log(rejects.reject_lines(fx.classified_marker(spark, sf_dir), fx.LABEL), folder)
    return read_lines(spark, folder).withColumnRenamed("value", "line")


def _load(
    spark: SparkSession,
    sf_dir: str,
    preset: Preset,
    lines: DataFrame | None,
    dims: bool,
    options: Options = Options(),
    raw: str | None = None,
    separator: str = "|",
    query: str = statements.PROJECT,
) -> LoadResult:
    """Write raw lines, spec and dimension files, run a whole load over them.

    ``query`` is the statement of a load without dimensions.
    """
    home = new_folder(spark, "load")
    if lines is not None:
        lines.write.text(f"{home}/raw")
    part = fx.table(spark, sf_dir, "part").select(*PART_COLUMNS)
    supplier = fx.table(spark, sf_dir, "supplier").select(*SUPPLIER_COLUMNS)
    write_data(part, f"{home}/part", "|")
    write_data(supplier, f"{home}/supplier", "|")
    spec = statements.spec_text(
        home,
        statements.FACT_JOIN if dims else query,
        {"part_dim": ("part", PART_SELECT), "supplier_dim": ("supplier", SUPPLIER_SELECT)}
        if dims
        else {},
    ).replace("Sep:=|", f"Sep:={separator}")
    spark.range(0, 1, 1, 1).select(F.lit(spec).alias("value")).write.text(f"{home}/spec")
    return run_load(
        spark,
        preset,
        f"{home}/spec",
        raw or f"{home}/raw",
        *[f"{home}/{name}" for name in ("out", "error", "audit")],
        options=options,
        now=lambda: fx.RUN_MOMENT,
    )


def fact_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = fx.main_lines(spark, sf_dir)
    return read_dimension(spark, _load(spark, sf_dir, FACT, lines, True).data_path)


def two_folder_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load over two folders at once, the lines dealt to them by their length."""
    home = new_folder(spark, "two")
    lines = fx.main_lines(spark, sf_dir)
    odd = F.length("value") % 2 == 1
    lines.filter(odd).write.text(f"{home}/odd")
    lines.filter(~odd).write.text(f"{home}/even")
    result = _load(spark, sf_dir, FACT, None, True, raw=f"{home}/odd, {home}/even")
    return read_dimension(spark, result.data_path)


def double_separator_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load whose fields, in and out, are separated by two characters."""
    lines = fx.main_lines(spark, sf_dir).select(
        F.replace("value", F.lit("|"), F.lit("||")).alias("value")
    )
    result = _load(spark, sf_dir, FACT, lines, True, separator="||")
    return read_dimension(spark, result.data_path, "||")


def manifest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole manifest run; one name stands for two folders."""
    home = new_folder(spark, "manifest")
    for name in ("customer", "part", "supplier"):
        join_fields(fx.table(spark, sf_dir, name)).write.text(f"{home}/{name}")
    pairs = [("dims", f"{home}/part"), ("dims", f"{home}/supplier"), ("all", f"{home}/*")]
    run_manifest(spark, pairs, f"{home}-out", lambda: fx.RUN_MOMENT)
    return read_lines(spark, f"{home}-out").withColumnRenamed("value", "line")


def fact_load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _load(spark, sf_dir, FACT, fx.main_lines(spark, sf_dir), True)
    return read_lines(spark, result.audit_path).withColumnRenamed("value", "line")


def fact_load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load that stages rejects only and reads the raw text twice."""
    lines = fx.marker_lines(spark, sf_dir)
    result = _load(spark, sf_dir, FACT, lines, True, Options(stage=False))
    return read_lines(spark, result.error_path).withColumnRenamed("value", "line")


def dimension_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _load(spark, sf_dir, DIMENSION, fx.main_lines(spark, sf_dir), False)
    return read_dimension(spark, result.data_path)


def dimension_load_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = _load(spark, sf_dir, DIMENSION, fx.marker_lines(spark, sf_dir), False)
    return read_lines(spark, result.error_path).withColumnRenamed("value", "line")


def _customer_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of the customers: some only in one, some changed, some delivered twice."""
    orders = fx.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.count("*").alias("every"), F.count_if(F.col("o_orderstatus") == "O").alias("open")
    )
    rows = fx.table(spark, sf_dir, "customer").join(
        orders, F.col("c_custkey") == F.col("o_custkey"), "left"
    )
    nation, segment = F.col("c_nationkey"), F.col("c_mktsegment")

    def lines(table: DataFrame, kind, count) -> DataFrame:
        texts = fx.text("c_custkey"), kind, F.coalesce(count, F.lit(0)).cast("string"), F.col("c_name")
        return table.select(F.concat_ws("|", *texts).alias("value"))

    first = lines(
        rows.filter(segment != "MACHINERY"),
        F.when(nation == 5, "NONE").otherwise(segment),
        F.col("open"),
    )
    here = rows.filter(nation != 3)
    kind = F.when(nation.isin(5, 6), "NONE").when(nation < 4, "NEW").otherwise(segment)
    again = lines(here.filter(nation == 9), F.lit("ZED"), F.coalesce("every", F.lit(0)) + 1000)
    return first, lines(here, kind, F.col("every")).union(again)


def scd2_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history after two loads of the customers; of two deliveries the larger count wins."""
    home = new_folder(spark, "history")
    for n, lines in enumerate(_customer_lines(spark, sf_dir), 1):
        lines.write.text(f"{home}/raw{n}")
        spec = statements.history_spec(f"B{n}")
        spark.range(0, 1, 1, 1).select(F.lit(spec).alias("value")).write.text(f"{home}/spec{n}")
        run_load(
            spark,
            FACT,
            f"{home}/spec{n}",
            f"{home}/raw{n}",
            f"{home}/out",
            f"{home}/error{n}",
            f"{home}/audit{n}",
            Options(history=True),
            lambda n=n: fx.RUN_MOMENT.replace(month=n),
        )
    return read_history(spark, f"{home}/out")


def _written_in_order(spark: SparkSession, sf_dir: str) -> str:
    """Main lines in files whose names and lines stand in the order of the orders."""
    folder = new_folder(spark, "sorted")
    lines = fx.main_lines(spark, sf_dir, "l_orderkey", "l_linenumber")
    ordered = lines.orderBy("l_orderkey", F.desc("l_linenumber"), "value")
    ordered.select("value").write.text(folder)
    return folder


def keep_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that keeps the first accepted line of each order."""
    folder = _written_in_order(spark, sf_dir)
    result = _load(spark, sf_dir, FACT, None, False, Options(keep="first"), folder)
    return read_dimension(spark, result.data_path)


def keep_one_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last accepted line of each order, from the raw text read twice."""
    folder = _written_in_order(spark, sf_dir)
    result = _load(spark, sf_dir, DIMENSION, None, False, Options(keep="last", stage=False), folder)
    return read_dimension(spark, result.data_path)


def source_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load over two folders, one in the other, and a third that no system claims."""
    home = new_folder(spark, "systems")
    lines = fx.main_lines(spark, sf_dir)
    size = F.length("value") % 3
    for n, folder in enumerate(("in", "in/late", "other")):
        lines.filter(size == n).write.text(f"{home}/{folder}")
    result = _load(
        spark,
        sf_dir,
        FACT,
        None,
        False,
        Options(systems={f"{home}/in": "SAP", f"{home}/in/late/": "CRM"}),
        f"{home}/in,{home}/in/late,{home}/other",
        query="select lets_src_sys_nm as system, count(*) as n, sum(cast(pk as bigint)) as spk "
        "from src group by lets_src_sys_nm",
    )
    return read_dimension(spark, result.data_path)


def reject_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejects of a load as CSV with their own columns."""
    lines = fx.marker_lines(spark, sf_dir).select(
        F.concat(F.when(F.col("value").contains("|1,2.7|"), '"a, \\').otherwise(""), "value").alias("value")
    )
    folder = new_folder(spark, "rejects")
    _load(spark, sf_dir, FACT, lines, False, Options(reject_table=folder, systems="SAP"))
    return read_rejects(spark, folder, [*rejects.REJECT_COLUMNS, SOURCE_SYSTEM])


def ordered_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An ordered result in four files, and whether each row stands after all those before it."""
    lines = fx.main_lines(spark, sf_dir)
    query = "select pk, ok, sk, ls from src order by pk desc, ok, sk, ls"
    result = _load(spark, sf_dir, FACT, lines, False, Options(data_files=4), query=query)
    found = read_lines_with_origin(spark, result.data_path).filter("value not like 'pk|%'")
    part = F.split("value", "[|]")
    rows = found.select(
        F.get(part, F.lit(0)).cast("int").alias("pk"),
        F.get(part, F.lit(1)).cast("int").alias("ok"),
        F.get(part, F.lit(2)).cast("int").alias("sk"),
        F.get(part, F.lit(3)).alias("ls"),
        F.regexp_extract("origin.file", r"part-(\d+)[^/]*$", 1).cast("int").alias("file"),
        "origin.block",
        "origin.line",
        F.shiftright("origin.line", 16).alias("stretch"),
    )
    # Neighbours are compared inside stretches of lines; of each stretch, the last line then meets
    # the next one's lines. There is one such line for up to 65,536.
    key = F.struct(-F.col("pk"), "ok", "sk", "ls")
    stretch = ("file", "block", "stretch")
    lines_of = W.partitionBy(*stretch).orderBy("line")
    linked = stage_table(
        rows.select(
            "pk", "ok", "sk", "ls", *stretch,
            F.lag(key).over(lines_of).alias("before"),
            F.lead("line").over(lines_of).isNull().alias("closes"),
        ),
        new_folder(spark, "linked"),
    )
    ended = F.lag(key).over(W.orderBy(*stretch)).alias("ended")
    placed = linked.join(linked.filter("closes").select(*stretch, ended), [*stretch])
    follows = F.coalesce(key >= F.col("before"), F.lit(True)) & F.coalesce(key >= F.col("ended"), F.lit(True))
    return placed.select("pk", "ok", "sk", "ls", follows.alias("in_order"))


def dimension_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The doubled keys of a load's two dimensions, by columns that are no keys of them."""
    folder = new_folder(spark, "doubled")
    options = Options(
        dimension_keys={"part_dim": ("brand", "kind"), "supplier_dim": ("nation",)}, doubled_keys=folder
    )
    _load(spark, sf_dir, FACT, fx.main_lines(spark, sf_dir), True, options)
    return read_rejects(spark, folder, ("dimension", "key", "rows"))


def registered() -> dict[str, Query]:
    operators = [
        raw_scan,
        field_split,
        dim_scan,
        spec_sections,
        spec_sections_contains,
        spec_lookup,
        declared_schema,
        typed_convert,
        convert_errors,
        line_status,
        arity_filter,
        arity_mismatch,
        required_filter,
        empty_key_probe,
        dim_project,
        audit_stamp,
        integrated_fact,
        reject_arity,
        reject_convert,
        reject_marker,
        reject_log,
        reject_log_strict,
        run_counts,
        audit_record,
        folder_manifest,
        manifest_log,
        data_sink,
        log_sink,
        fact_load,
        two_folder_load,
        double_separator_load,
        manifest_load,
        fact_load_audit,
        fact_load_errors,
        dimension_load,
        dimension_load_errors,
        scd2_merge,
        keep_one,
        keep_one_last,
        source_column,
        reject_csv,
        ordered_sink,
        dimension_fanout,
    ]
    queries = {query.__name__: query for query in operators}
    queries["fact_join"] = fact_join
    for name, sql in statements.ACCEPTANCE.items():
        queries[name] = _statement(sql)
    return queries
