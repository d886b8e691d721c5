"""Outputs of a load beyond its data: publishing, order, origins, rejects, dimensions, manifests."""

from __future__ import annotations

import glob
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace import DIMENSION, FACT, Options, read_history, run_load, versions
from millrace.__main__ import dimension_keys, main, source_systems
from millrace.operators.metrics import folder_manifest
from millrace.operators.origin import keep_one, source_system
from millrace.plans import load
from millrace.sinks import files, publish
from millrace.sources import checked
from millrace.sources.raw import read_lines_with_origin
from tests.test_load import HEADER, NOW, RAW, SPEC, STAMP, put, read, run


def listing(folder):
    """Every file below a folder but the checksums of the local file system, with its text."""
    found = {}
    for name in sorted(glob.glob(f"{folder}/**/*", recursive=True)):
        if os.path.isfile(name):
            with open(name, "rb") as part:
                found[os.path.relpath(name, folder)] = part.read()
    return found


def hidden(folder):
    return [n for n in os.listdir(folder) if n.startswith(("_journal", "_commit", "_pending"))]


WRITES = ("write_data", "write_log", "write_small_log", "write_rejects")


@pytest.mark.parametrize("broken", WRITES)
def test_a_failing_write_leaves_the_old_state_whole(spark, home, monkeypatch, broken):
    run(spark, home, FACT, raw=["7|1|old"])
    os.rename(f"{home}/error", f"{home}/error-old")
    os.rename(f"{home}/audit", f"{home}/audit-old")
    before = listing(f"{home}/out")
    with monkeypatch.context() as m:

        def fail(table, path, *rest):
            getattr(files, broken)(table, path, *rest)
            raise OSError("disk full")

        m.setattr(load, broken, fail)
        with pytest.raises(OSError, match="disk full"):
            run(spark, home, FACT, reject_table=f"{home}/rejects")
    assert listing(f"{home}/out") == before
    for name in ("error", "audit", "rejects"):
        assert not os.path.exists(f"{home}/{name}")
    assert hidden(home) == []
    run(spark, home, FACT, reject_table=f"{home}/rejects")
    assert listing(f"{home}/out") != before and len(read(f"{home}/error")) == 3


def killed(spark, home, monkeypatch, at):
    """A load whose driver is gone at some step: nothing cleans up."""

    class Killed(BaseException):
        pass

    def die(*args):
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(publish, "_forget", lambda *a: None)
        m.setattr(*at(die))
        with pytest.raises(Killed):
            run(spark, home, FACT)


def test_a_run_killed_before_its_commit_is_removed(spark, home, monkeypatch):
    run(spark, home, FACT, raw=["7|1|old"])
    os.rename(f"{home}/error", f"{home}/error-old")
    os.rename(f"{home}/audit", f"{home}/audit-old")
    before = listing(f"{home}/out")
    killed(spark, home, monkeypatch, lambda die: (load, "write_small_log", die))
    assert listing(f"{home}/out") == before and len(hidden(home)) >= 3
    publish.finish_earlier(spark, f"{home}/out")
    assert listing(f"{home}/out") == before and hidden(home) == []
    assert not os.path.exists(f"{home}/error")
    run(spark, home, FACT)
    assert len(read(f"{home}/out")) == 6


@pytest.mark.parametrize("moved", [0, 1, 2])
def test_a_run_killed_after_its_commit_is_finished(spark, home, monkeypatch, moved):
    run(spark, home, FACT, raw=["7|1|old"])
    os.rename(f"{home}/error", f"{home}/error-old")
    os.rename(f"{home}/audit", f"{home}/audit-old")
    done = []

    def at(die):
        def step(*args):
            if len(done) == moved:
                die()
            done.append(args)
            files.move(*args)

        return publish, "move", step

    killed(spark, home, monkeypatch, at)
    assert os.path.exists(f"{home}/error") == (moved == 2)
    publish.finish_earlier(spark, f"{home}/out")
    assert len(read(f"{home}/out")) == 6 and len(read(f"{home}/error")) == 3
    assert read(f"{home}/audit") == [f"B1,A1,2,{STAMP},{STAMP},7,5,3"]
    assert hidden(home) == []
    # The logs are there, so the same run again is refused, and data stays.
    with pytest.raises(FileExistsError):
        run(spark, home, FACT, raw=["7|1|new"])
    assert len(read(f"{home}/out")) == 6


def test_runs_to_other_places_are_left_alone(spark, home):
    with publish.published(spark, f"{home}/a", [f"{home}/a"]) as (written,):
        put(f"{written}/x", "1")
        publish.finish_earlier(spark, f"{home}/b")
        assert os.path.exists(f"{written}/x")
    assert listing(f"{home}/a") == {"x": b"1"}


# Order


def in_files(path):
    rows = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name) as part:
            rows.append([line.split("|")[0] for line in part.read().splitlines()[1:]])
    return rows


LONG = [f"{i * 7919 % 1000}|{i}|n{i % 5}" for i in range(1000)]


@pytest.mark.parametrize("files_wanted", [1, 3])
def test_ordered_result_in_a_number_of_files(spark, home, files_wanted):
    result = run(spark, home, FACT, query="select id from src order by price desc", raw=LONG, data_files=files_wanted)
    parts = in_files(result.data_path)
    assert len(parts) == files_wanted and all(parts)
    assert sum(parts, []) == [line.split("|")[0] for line in reversed(LONG)]
    assert result.counts["records_written"] == 1000


def test_ordered_and_limited_result(spark, home):
    result = run(spark, home, FACT, query="select id, name as _place from src order by id limit 7", raw=LONG, data_files=2)
    assert sum(in_files(result.data_path), []) == [str(i) for i in range(7)]
    assert read(result.data_path)[0].startswith("id|_place|")


@pytest.mark.parametrize("rows, many", [(0, 3), (2, 3), (50, 3), (3001, 4)])
def test_ordered_files_differ_by_a_row_at_most(spark, home, rows, many):
    """Nulls, wide text and rows of several tasks and blocks come back as they were, in order."""
    table = spark.range(0, rows, 1, 5).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("n"), F.concat(F.lit("é|\n"), "id").alias("t"), "id"
    )
    ordered = files.in_ordered_files(table.orderBy(F.desc("id")), many, f"{home}/staged")
    assert ordered.schema == table.schema
    parts = ordered.rdd.glom().collect()
    assert sum(parts, []) == list(reversed(table.collect()))
    assert len(list(filter(None, parts))) == min(rows, many)
    assert not rows or max(map(len, parts)) - min(map(len, parts)) <= 1


def test_a_file_of_an_ordered_result_is_not_sorted_row_by_row(spark, home):
    """What the writing task sorts are blocks: packed, thousands of rows each."""
    table = spark.range(0, 200_000, 1, 4).select("id", F.lit("x" * 100).alias("t"))
    ordered = files.in_ordered_files(table.orderBy("id"), 2, f"{home}/staged")
    plan = ordered._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Sort":
        plan = plan.children().apply(0)
    assert "block" in plan.output().toString() and "t#" not in plan.output().toString()
    assert ordered.agg(F.count("*"), F.max("id")).first() == (200_000, 199_999)


def test_what_counts_as_ordered(spark):
    rows = spark.range(10)
    assert files.is_ordered(rows.orderBy("id").withColumn("x", F.lit(1)))
    assert files.is_ordered(rows.withColumn("x", F.rand()).orderBy("x").select("id").limit(3))
    assert not files.is_ordered(rows.sortWithinPartitions("id"))
    assert not files.is_ordered(rows.orderBy("id").groupBy("id").count())
    assert not files.is_ordered(rows)


# Origins


def test_origins_sort_as_lines_stand(spark, home):
    """The same order, however the files are cut into tasks."""
    for f in range(3):
        put(f"{home}/in/{f} é%20.txt", "".join(f"{f}-{i:05d} {'x' * (i % 90)}\n" for i in range(3000)))
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (usual, "7000", "70000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            lines = read_lines_with_origin(spark, f"{home}/in")
            assert size == usual or lines.rdd.getNumPartitions() > 8
            ordered = [r.value for r in lines.orderBy("origin").collect()]
            assert ordered == sorted(ordered)
            key = F.substring("value", 7, 1)
            for which, want in (("first", min), ("last", max)):
                got = keep_one(lines.withColumn("k", key), "k", which).collect()
                groups = {}
                for line in ordered:
                    groups.setdefault(line[6], []).append(line)
                assert {r.k: r.value for r in got} == {k: want(v) for k, v in groups.items()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)


@pytest.mark.parametrize("staged", [True, False])
@pytest.mark.parametrize("keep, want", [("first", "new"), ("last", "newest")])
def test_load_keeps_one_record_of_each_first_field(spark, home, staged, keep, want):
    """Rejected lines never win, and the statement need not read the first field."""
    raw = ["1|x|bad", "1|1", "1|2|new", "2|1|b", "1|3|newer", "+1|4|newest", "1|x|bad"]
    result = run(spark, home, FACT, query="select name from src", raw=raw, keep=keep, stage=staged)
    assert sorted(x.split("|")[0] for x in read(result.data_path)) == sorted(["b", "name", want])
    assert result.counts["accepted"] == 4 and result.counts["records_written"] == 2
    assert result.counts["records_rejected"] == 3


def test_keep_one_of_hot_null_and_no_rows(spark):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 10 > 0, "hot").alias("a b"), F.col("id").alias("v"), F.struct("id").alias("origin")
    )
    got = keep_one(rows.repartition(7), "a b", "last")
    assert sorted(map(tuple, got.collect()), key=str) == [("hot", 4999), (None, 4990)]
    assert keep_one(rows.limit(0), "a b").count() == 0
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan
    with pytest.raises(ValueError, match="any"):
        keep_one(rows, "a b", "any")
    with pytest.raises(ValueError, match="any"):
        Options(keep="any")


def test_longest_folder_names_the_system(spark, home):
    given = {home: "top", f"{home}/a b/": "inner", f"{home}/a b/one.txt": "file", f"{home}/a": "short"}
    paths = ["a b/two.txt", "a b/one.txt", "a bc/x", "a/x", "x"]
    for p in paths:
        put(f"{home}/{p}", p + "\n")
    lines = spark.read.option("recursiveFileLookup", True).text(home)
    named = lines.select("value", source_system(spark, given, F.col("_metadata.file_path")).alias("s"))
    want = dict(zip(paths, ["inner", "file", "top", "short", "top"], strict=True))
    assert {r.value: r.s for r in named.collect()} == want
    none = lines.select(source_system(spark, {f"{home}/zz": "z"}, F.col("_metadata.file_path")).alias("s"))
    assert {r.s for r in none.collect()} == {None}


@pytest.mark.parametrize("staged", [True, False])
def test_source_systems_of_a_load(spark, home, staged):
    put(f"{home}/raw/in/l.txt", "8|1|late\n9|x|bad\n")
    result = run_load(
        spark, FACT, put(f"{home}/spec", SPEC.format(query="select * from src", sep="|")),
        f"{put(f'{home}/raw/r.txt', '1|1|ann' + chr(10))},{home}/raw/in", f"{home}/out", f"{home}/error", f"{home}/audit",
        Options(systems={f"{home}/raw/in": "CRM"}, reject_table=f"{home}/rejects", stage=staged), lambda: NOW,
    )
    data = read(result.data_path)
    assert {x.split("|" + STAMP)[0] for x in data if not x.startswith("id")} == {"1|1.0|ann|", "8|1.0|late|CRM"}
    rejects = files.read_rejects(spark, f"{home}/rejects", ["b", "a", "key", "at", "message", "system"]).collect()
    assert [(r.key, r.system) for r in rejects] == [("9", "CRM")]


def test_one_system_is_a_stamp(spark, home):
    run(spark, home, FACT, systems="SAP", reject_table=f"{home}/rejects")
    assert read(f"{home}/out")[0] == HEADER.replace("|lets_atv_flg", "|lets_src_sys_nm|lets_atv_flg")
    assert all(x.endswith("|SAP|Y") for x in read(f"{home}/out") if not x.startswith("id"))
    assert spark.read.option("header", True).csv(f"{home}/rejects").select("lets_src_sys_nm").distinct().count() == 1


def test_column_of_the_systems_name_is_refused(spark, home):
    with pytest.raises(ValueError, match="lets_src_sys_nm"):
        run(spark, home, FACT, systems={home: "x"}, extra="MetaData:=lets_src_sys_nm:=StringType\n")


# Rejects


def test_rejects_come_back_whole(spark, home):
    texts = ["a,b", 'q"', '"', '""', "l\nl", "l\r\nl", "\r", " blank ", "", None, "\\", "\\N", "\\\\N", "\\\\", "#", "é🙂", "\t", "'", "N"]
    rows = [(t, u, "x") for t in texts for u in (t, "a", None, "")]
    table = spark.createDataFrame(rows, "a string, b string, `c d` string").repartition(3)
    files.write_rejects(table, f"{home}/r")
    back = files.read_rejects(spark, f"{home}/r", table.columns)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(rows, key=str)
    files.write_rejects(table.limit(0), f"{home}/none")
    assert files.read_rejects(spark, f"{home}/none", table.columns).count() == 0


# Dimensions


def test_doubled_keys_of_a_dimension(spark, home):
    put(f"{home}/dim/d.csv", "key|label\n1|one\n1|uno\n4|four\n|no\n|none\n9|x\n9|y\n9|z\n")
    query = "select s.name, d.label from src s join dim d on s.id = d.k"
    extra = f"FactJoin:=dim:={home}/dim:=key as k, label\n"
    result = run(spark, home, FACT, query=query, extra=extra, dimension_keys={}, doubled_keys=f"{home}/doubled")
    assert result.counts["records_written"] == 5
    assert result.fan_outs == (checked.FanOut("dim", ("k",), 2, 3),)
    found = files.read_rejects(spark, f"{home}/doubled", ["dimension", "key", "rows"]).collect()
    assert sorted(map(tuple, found)) == [("dim", '{"k":"1"}', "2"), ("dim", '{"k":"9"}', "3")]


def test_checked_dimensions_are_read_once(spark, home, monkeypatch):
    put(f"{home}/dim/d.csv", "key|label\n1|one\n1|uno\n")
    plans = []

    def spy(table, *rest):
        plans.append(table._jdf.queryExecution().executedPlan().toString())
        files.write_data(table, *rest)

    staged = []
    monkeypatch.setattr(load, "write_data", spy)
    monkeypatch.setattr(checked, "stage_table", lambda t, p: staged.append(t) or files.stage_table(t, p))
    run(
        spark, home, FACT, query="select s.name, d.label from src s join dim d on s.id = d.k",
        extra=f"FactJoin:=dim:={home}/dim:=key as k, label\n", dimension_keys={"dim": ["k", "label"]},
    )
    assert len(staged) == 1
    assert "csv" not in plans[0].lower() and plans[0].count("Scan parquet") == 2


def test_keys_need_a_check(spark):
    with pytest.raises(ValueError, match="dimension_keys"):
        Options(doubled_keys="/x")


# Histories


def test_history_load(spark, home):
    extra = "SCD:=JoinID:=id\nSCD:=Columns:=price\n"
    times = iter([NOW, NOW, NOW + timedelta(days=1), NOW + timedelta(days=1)])
    for n, raw in enumerate((["1|1|a", "2|2|b", "x|1|bad"], ["1|9|a", "2|2|changed", "3|3|c"])):
        result = run_load(
            spark, FACT, put(f"{home}/spec{n}", SPEC.format(query="select * from src", sep="|") + extra),
            put(f"{home}/raw{n}", "\n".join(raw) + "\n"), f"{home}/out", f"{home}/error{n}", f"{home}/audit{n}",
            Options(history=True, systems="SAP"), lambda: next(times),
        )
    assert result.counts["records_written"] == 2 and result.counts["closed"] == 1
    assert versions(spark, f"{home}/out")[-1] == result.version == "20240306T060708000000"
    rows = read_history(spark, result.data_path)
    got = sorted((r.id, r.price, r.name, r.lets_atv_flg, r.lets_src_sys_nm) for r in rows.collect())
    assert got == [(1, 1.0, "a", "N", "SAP"), (1, 9.0, "a", "Y", "SAP"), (2, 2.0, "b", "Y", "SAP"), (3, 3.0, "c", "Y", "SAP")]
    assert read_history(spark, result.data_path, "20240305T060708000000").count() == 2
    assert hidden(home) == [] and hidden(f"{home}/out") == []


def test_failing_history_load_leaves_the_last_version(spark, home, monkeypatch):
    extra = "SCD:=JoinID:=id\n"
    run(spark, home, FACT, raw=["1|1|a"], extra=extra, history=True)
    with monkeypatch.context() as m:
        m.setattr(load, "write_small_log", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run_load(
                spark, FACT, f"{home}/spec/s.txt", f"{home}/raw", f"{home}/out", f"{home}/e2", f"{home}/a2",
                Options(history=True), lambda: NOW + timedelta(1),
            )
    assert len(versions(spark, f"{home}/out")) == 1 and not os.path.exists(f"{home}/e2")
    assert [r.lets_atv_flg for r in read_history(spark, f"{home}/out").collect()] == ["Y"]


def test_history_needs_its_settings(spark, home):
    with pytest.raises(ValueError, match="JoinID"):
        run(spark, home, FACT, history=True)
    with pytest.raises(ValueError, match="nothere"):
        run(spark, home, DIMENSION, history=True, extra="SCD:=JoinID:=nothere\n")


# Manifests


def counts_of(manifest):
    return sorted((r.name, r.record_count) for r in manifest.collect())


def test_manifest_reads_all_folders_in_one_scan(spark, home):
    for n in range(100):
        put(f"{home}/{n}/a.txt", "x\n" * n)
    manifest = folder_manifest(spark, {str(n): f"{home}/{n}" for n in range(100)}, STAMP)
    plan = manifest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    assert counts_of(manifest) == sorted((str(n), n) for n in range(100))


def test_manifest_of_overlapping_nested_and_empty_folders(spark, home):
    put(f"{home}/a/1.txt", "x\ny\n")
    put(f"{home}/a/2.txt", "z")
    put(f"{home}/a/in/3.txt", "1\n2\n3\n")
    put(f"{home}/p/k=1/j=2/4.txt", "1\n")
    put(f"{home}/p/k=2/5.txt", "1\n2\n")
    put(f"{home}/p/other/6.txt", "1\n")
    put(f"{home}/s [é]{{x}}%20/7.txt", "1\n")
    os.makedirs(f"{home}/empty")
    pairs = [
        ("a", f"{home}/a"), ("a", f"{home}/a/*.txt"), ("one", f"{home}/a/1.txt"), ("in", f"{home}/a/in/"),
        ("both", f"{home}/a,{home}/a/in,{home}/a/1.txt"), ("p", f"{home}/p"), ("k", f"{home}/p/k=1"),
        ("o", f"{home}/p/other"), ("e", f"{home}/empty"), ("e", f"{home}/empty"), ("s", f"{home}/s*"),
    ]
    want = [("a", 3), ("a", 3), ("one", 1 + 1), ("in", 3), ("both", 6), ("p", 3), ("k", 1), ("o", 1), ("e", 0), ("e", 0), ("s", 1)]
    assert counts_of(folder_manifest(spark, pairs, STAMP)) == sorted(want)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        folder_manifest(spark, {"x": f"{home}/nothing"}, STAMP)
    with pytest.raises(ValueError, match="no folder"):
        folder_manifest(spark, {}, STAMP)


# Command line


def test_further_options_of_the_command_line(spark, home, monkeypatch):
    monkeypatch.setattr("millrace.__main__.build_session", lambda name: spark)
    assert source_systems(["SAP"]) == "SAP" and source_systems([]) is None
    assert source_systems(["/a=b=SAP", "/c=CRM"]) == {"/a=b": "SAP", "/c": "CRM"}
    assert dimension_keys(["d=a, b", "e"]) == {"d": ["a", "b"], "e": []} and dimension_keys(None) is None
    with pytest.raises(SystemExit):
        source_systems(["SAP", "/a=b"])
    spec = put(f"{home}/spec/s.txt", SPEC.format(query="select id from src", sep="|") + "SCD:=JoinID:=id\n")
    put(f"{home}/raw/r.txt", "\n".join(RAW) + "\n")
    out = [f"{home}/{name}" for name in ("out", "error", "audit")]
    main(["fact", spec, f"{home}/raw", *out, "--keep", "last", "--system", "SAP", "--history", "--reject-table", f"{home}/rej"])
    assert read_history(spark, out[0]).count() == 4
    assert len(glob.glob(f"{home}/rej/part-*")) >= 1
    assert datetime.strptime(versions(spark, out[0])[0], "%Y%m%dT%H%M%S%f")
