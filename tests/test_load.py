"""Whole runs over files."""

from __future__ import annotations

import glob
import os
from datetime import datetime

import pytest

from millrace import DIMENSION, FACT, Options, run_dimension_load, run_fact_load, run_load, run_manifest
from millrace.__main__ import main, parse
from millrace import session
from millrace.functions import clock
from millrace.sinks import files, stage
from millrace.sources import dimension

NOW = datetime(2024, 3, 5, 6, 7, 8)
STAMP = "2024-03-05 06:07:08"
SPEC = """MetaData:=id:=IntegerType
MetaData:=price:=DoubleType
MetaData:=name:=StringType
Data:=Sep:={sep}
Query:=Temp_Table:=src
Query:=Main_Query:={query}
DATAQUALITY:=BatchId:=B1
DATAQUALITY:=ActivityId:=A1
NonNullable:=name:=2
ERRORSCHEMA:=Path:=/unused
AUDITSCHEMA:=Path:=/unused
"""
RAW = ["1|2.5|ann", "2|x|bob", "3|1", "4|1e1|", "5|3|null", "6|1|an Exception", "1|4|cy"]


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    return path


def read(path):
    lines = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name) as part:
            lines += part.read().splitlines()
    return lines


def run(spark, home, preset, query="select * from src", extra="", raw=RAW, sep="|", **options):
    return run_load(
        spark,
        preset,
        put(f"{home}/spec/s.txt", SPEC.format(query=query, sep=sep) + extra),
        os.path.dirname(put(f"{home}/raw/r.txt", "\n".join(raw) + "\n")),
        f"{home}/out",
        f"{home}/error",
        f"{home}/audit",
        Options(**options),
        lambda: NOW,
    )


HEADER = (
    "id|price|name|lets_ld_dt|lets_ld_upd_dt|lets_ld_bch_id|lets_ld_upd_ bch_id|"
    "lets_eff_strt_dt|lets_eff_end_dt|lets_atv_flg"
)
STAMPS = f"{STAMP}||B1||{STAMP}||Y"
ARITY = "The record doesnt have enough arguments or filled"
LOG = {
    f'B1,A1,2,{STAMP},Exception For input string: "x"',
    f"B1,A1,3,{STAMP},{ARITY}",
    f"B1,A1,6,{STAMP},an Exception",
}


@pytest.mark.parametrize("staged", [True, False])
def test_fact_load(spark, home, staged):
    result = run(spark, home, FACT, stage=staged)
    assert result.data_path == f"{home}/out"
    data = read(result.data_path)
    rows = ["1|2.5|ann", "4|10.0|", "5|3.0|null", "6|1.0|an Exception", "1|4.0|cy"]
    assert set(data) == {HEADER, *[f"{row}|{STAMPS}" for row in rows]}
    assert set(read(f"{home}/error")) == LOG
    assert read(f"{home}/audit") == [f"B1,A1,2,{STAMP},{STAMP},7,5,3"]
    assert result.counts == {
        "records_read": 7, "records_rejected": 3, "accepted": 5, "arity": 1,
        "required": 0, "convert": 1, "marked": 1, "records_written": 5,
    }


@pytest.mark.parametrize("staged", [True, False])
def test_dimension_load_drops_empty_required_silently(spark, home, staged):
    result = run(spark, home, DIMENSION, stage=staged)
    assert len([x for x in read(result.data_path) if x != HEADER]) == 3
    assert set(read(f"{home}/error")) == LOG
    assert read(f"{home}/audit") == [f"B1,A1,2,{STAMP},{STAMP},7,3,3"]


@pytest.mark.parametrize("staged", [True, False])
def test_log_options(spark, home, staged):
    result = run(
        spark, home, DIMENSION, strict=True, log_required=True, log_files=1, data_files=1, stage=staged
    )
    assert len(glob.glob(f"{result.data_path}/part-*")) == 1
    assert len(glob.glob(f"{home}/error/part-*")) == 1
    assert len(read(f"{home}/error")) == 4
    assert result.counts["records_rejected"] == 4


def test_star_join_with_dated_folder(spark, home):
    put(f"{home}/dim/d.csv", 'key|label|other\n1|"one|1"|x\n4||y\n9|nine|z\n')
    result = run(
        spark,
        home,
        FACT,
        query="select s.name, d.tag, s.price * d.k as total from src s join dim d on s.id = d.k",
        extra=f"FactJoin:=dim:={home}/dim:=key as k, upper(label) tag\n",
    )
    assert result.data_path == f"{home}/out/2024/03/05"
    rows = [x.split(f"|{STAMP}")[0] for x in read(result.data_path)]
    assert sorted(r for r in rows if not r.startswith("name")) == sorted(
        ['ann|"ONE|1"|2.5', "||40.0", 'cy|"ONE|1"|4.0']
    )
    assert result.counts["records_written"] == 3 and result.counts["accepted"] == 5


def test_statement_mixes_text_and_numbers_and_overflows_to_null(spark, home):
    ansi = spark.conf.get("spark.sql.ansi.enabled")
    result = run(
        spark,
        home,
        FACT,
        query="select name * 100 as a, id / 0 as b, '12.5' * 100 as c, cast('x' as int) as d from src where id = 1",
    )
    assert {x.split(f"|{STAMP}")[0] for x in read(result.data_path)[1:2]} == {"||1250.0|"}
    assert spark.conf.get("spark.sql.ansi.enabled") == ansi
    assert not spark.catalog.tableExists("src")


def test_written_counts_the_result_of_a_grouping(spark, home):
    result = run(spark, home, FACT, query="select id, count(*) n from src group by id")
    assert result.counts["records_written"] == 4


@pytest.mark.parametrize("staged", [True, False])
@pytest.mark.parametrize("query", ["select * from src where id > 99", "select id from src where 1 = 0"])
def test_empty_result(spark, home, query, staged):
    result = run(spark, home, FACT, query=query, stage=staged)
    assert result.counts["records_written"] == 0
    assert read(f"{home}/audit") == [f"B1,A1,2,{STAMP},{STAMP},7,0,3"]


@pytest.mark.parametrize("staged", [True, False])
def test_empty_input(spark, home, staged):
    put(f"{home}/raw/r.txt", "")
    result = run_fact_load(
        spark,
        put(f"{home}/spec.txt", SPEC.format(query="select * from src", sep="|")),
        f"{home}/raw",
        f"{home}/out",
        f"{home}/error",
        f"{home}/audit",
        Options(stage=staged),
    )
    assert result.counts["records_read"] == 0 and result.counts["records_written"] == 0
    assert read(f"{home}/error") == []


def test_rerun_stops_before_data_is_replaced(spark, home):
    result = run(spark, home, FACT)
    before = sorted(os.listdir(result.data_path))
    with pytest.raises(FileExistsError):
        run(spark, home, FACT)
    assert sorted(os.listdir(result.data_path)) == before


def test_data_is_overwritten(spark, home):
    put(f"{home}/out/old.csv", "old")
    run(spark, home, FACT)
    assert not os.path.exists(f"{home}/out/old.csv")


def test_staged_table_is_removed_also_after_a_failure(spark, home):
    folder = stage.shared_folder(spark).removeprefix("file:")
    before = glob.glob(f"{folder}/classified-*")
    run(spark, home, FACT)
    with pytest.raises(Exception, match="nowhere"):
        run_load(
            spark, FACT, f"{home}/spec/s.txt".replace("s.txt", ""), f"{home}/nowhere",
            f"{home}/o2", f"{home}/e2", f"{home}/a2",
        )
    assert glob.glob(f"{folder}/classified-*") == before


def test_dimension_preset_needs_log_paths(spark, home):
    text = SPEC.format(query="select * from src", sep="|").replace("ERRORSCHEMA", "OTHER")
    with pytest.raises(ValueError, match="ERRORSCHEMA"):
        run_dimension_load(spark, put(f"{home}/spec.txt", text), "r", "o", "e", "a")


def test_duplicate_stamp_column_is_replaced_in_place(spark, home):
    result = run(spark, home, FACT, query="select 'x' as LETS_ATV_FLG, id from src where id = 1")
    assert read(result.data_path)[0].startswith("lets_atv_flg|id|lets_ld_dt")
    assert read(result.data_path)[1].startswith("Y|1|")


def test_dimension_output_serves_as_dimension_input(spark, home):
    first = run(spark, home, DIMENSION)
    second = run(
        spark,
        f"{home}/second",
        FACT,
        query="select s.id, d.name from src s join dim d on s.id = d.id",
        extra=f"FactJoin:=dim:={first.data_path}:=id, name\n",
        raw=["1|0|q", "6|0|q"],
    )
    assert second.counts["records_written"] == 3


def test_manifest(spark, home):
    put(f"{home}/a/1.txt", "x\ny\n")
    put(f"{home}/a/2.txt", "z")
    put(f"{home}/b/1.txt", "q\r\nr\rs\n\n")
    run_manifest(spark, {"A": f"{home}/a/*", "B": f"{home}/b"}, f"{home}/m", lambda: NOW)
    assert sorted(read(f"{home}/m")) == [f"A|3|{STAMP}", f"B|4|{STAMP}"]
    assert len(glob.glob(f"{home}/m/part-*")) == 1


def test_dated_paths():
    assert files.dated_path("/o/", NOW) == "/o/2024/03/05"
    assert files.dated_timed_path("/o", NOW) == "/o/2024/03/05/06-07-08"


def test_log_folder_must_be_new(spark, home):
    lines = spark.createDataFrame([("a",)], "value string")
    files.write_log(lines, f"{home}/log")
    with pytest.raises(Exception, match="exist"):
        files.write_log(lines, f"{home}/log")
    with pytest.raises(Exception, match="exist"):
        files.write_small_log(lines, f"{home}/log")


class OtherSession:
    """A session's settings as far as the shared folder depends on them."""

    def __init__(self, named, set_on_context, master):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master, self.getCheckpointDir = master, lambda: set_on_context


def test_shared_folder_is_the_one_the_session_names(spark):
    assert stage.shared_folder(OtherSession("/a", "/b", "yarn")) == "/a"
    assert stage.shared_folder(OtherSession(None, "/b", "yarn")) == "/b"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        stage.shared_folder(OtherSession(None, None, "yarn"))
    assert stage.new_folder(spark, "x") != stage.new_folder(spark, "x")


def test_clock_formats():
    assert (clock.stamp(NOW), clock.day(NOW)) == (STAMP, "2024-03-05")
    assert clock.day_folder(NOW) == "2024/03/05"
    assert clock.day_time_folder(NOW) == "2024/03/05/06-07-08"


def test_command_line():
    args = parse(["fact", "s", "r", "o", "e", "a", "--log-files", "3", "--rescan"])
    assert (args.run, args.spec, args.audit, args.log_files, args.rescan) == ("fact", "s", "a", 3, True)
    assert parse(["manifest", "m", "A=/x", "B=/y"]).folders == ["A=/x", "B=/y"]


def test_shuffles_are_sized_by_the_table(spark):
    def first(rows, **limits):
        own = session.job_session(spark)
        session.fit_shuffles(own, spark.range(0, rows, 1, 4), **limits)
        return own.conf.get(session.FIRST_SHUFFLE_PARTITIONS)

    assert first(1000) == "8"
    assert first(10**12) == str(8 * 10**12 // session.BYTES_PER_SHUFFLE_PARTITION)
    assert first(10**15) == str(session.MOST_SHUFFLE_PARTITIONS)
    assert first(10**15, most=5000) == "5000"
    own = session.job_session(spark)
    own.conf.set(session.FIRST_SHUFFLE_PARTITIONS, "5")
    session.fit_shuffles(own, spark.range(0, 10**12, 1, 4))
    session.fit_scans(own)
    assert own.conf.get(session.FIRST_SHUFFLE_PARTITIONS) == "5"
    assert own.conf.get(session.SCAN_TASKS) == str(session.MOST_SCAN_TASKS)
    assert spark.conf.get(session.SCAN_TASKS, None) is None


def test_compressed_input_is_sized_by_what_it_holds(spark, home, monkeypatch):
    seen = []
    monkeypatch.setattr(
        "millrace.plans.load.fit_shuffles",
        lambda own, table, *limits: seen.append(
            int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        ),
    )
    rows = [f"{i}|{i * 7919 % 10007}.5|name{i * 104729 % 1000003}" for i in range(20000)]
    spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.option(
        "compression", "gzip"
    ).text(f"{home}/zipped")
    spec = put(f"{home}/spec/s.txt", SPEC.format(query="select * from src", sep="|"))
    paths = [f"{home}/{name}" for name in ("out", "error", "audit")]
    run_load(spark, FACT, spec, f"{home}/zipped", *paths)
    zipped = sum(os.path.getsize(f) for f in glob.glob(f"{home}/zipped/part-*"))
    assert seen[0] > zipped


@pytest.mark.parametrize("staged", [True, False])
@pytest.mark.parametrize(
    "query, extra",
    [
        ("select nothing from src", ""),
        ("select id frm src x y", ""),
        ("select s.id from src s join dim d on s.id = d.k", "FactJoin:=dim:=/nowhere/at/all:=k\n"),
    ],
)
def test_bad_statement_stops_before_data_is_touched(spark, home, monkeypatch, query, extra, staged):
    calls = []
    monkeypatch.setattr("millrace.plans.load.stage_table", lambda *a: calls.append(a))
    with pytest.raises(Exception):
        run(spark, home, FACT, query=query, extra=extra, stage=staged)
    assert not calls and not os.path.exists(f"{home}/out")


@pytest.mark.parametrize(
    "query, read",
    [
        ("select * from src", {0, 1, 2}),
        ("select id from src where price > 1", {0, 1}),
        ("select count(*) n from src", set()),
        ("select 1 as one", set()),
        ("select a.id from src a join src b on a.id = b.price", {0, 1}),
        ("select id from (select *, upper(name) u from src)", {0}),
        ("select id from src where price in (select id from src where name = 'x')", {0, 1, 2}),
        ("select (select max(price) from src) as top", {1}),
    ],
)
def test_only_columns_the_statement_reads_are_staged(spark, home, monkeypatch, query, read):
    seen = []

    def spy(table, path):
        seen.append({c for c in table.columns if c.startswith("v")})
        return stage.stage_table(table, path)

    monkeypatch.setattr("millrace.plans.load.stage_table", spy)
    staged = run(spark, home, FACT, query=query)
    assert seen == [{f"v{i}" for i in read}]
    rescan = run(spark, f"{home}/again", FACT, query=query, stage=False)
    assert sorted(read_all(staged)) == sorted(read_all(rescan))


def read_all(result):
    return read(result.data_path)


def test_wide_record_stages_six_columns(spark, home, monkeypatch):
    seen = []

    def spy(table, path):
        seen.append([c for c in table.columns if c.startswith("v")])
        return stage.stage_table(table, path)

    monkeypatch.setattr("millrace.plans.load.stage_table", spy)
    kinds = ["IntegerType", "DoubleType", "StringType"]
    columns = "".join(f"MetaData:=c{i}:={kinds[i % 3]}\n" for i in range(200))
    query = "select c0, c1, c2, c50 from src where c99 >= 0 and c199 is not null"
    body = SPEC.format(query=query, sep="|").split("\n", 3)[3]
    spec = put(f"{home}/spec/s.txt", columns + body)
    raw = os.path.dirname(put(f"{home}/raw/r.txt", "|".join(["7"] * 200) + "\n"))
    paths = [f"{home}/{name}" for name in ("out", "error", "audit")]
    assert run_load(spark, FACT, spec, raw, *paths).counts["records_written"] == 1
    assert seen == [["v0", "v1", "v2", "v50", "v99", "v199"]]


def test_several_input_paths(spark, home):
    put(f"{home}/a/1.txt", "1|2|x\n")
    put(f"{home}/b/1.txt", "2|2|y\n")
    put(f"{home}/c,d/1.txt", "3|2|z\n")
    spec = put(f"{home}/spec/s.txt", SPEC.format(query="select id from src", sep="|"))

    def count(raw, name):
        paths = [f"{home}/{name}/{kind}" for kind in ("out", "error", "audit")]
        return run_load(spark, FACT, spec, raw, *paths).counts["records_written"]

    assert count(f"{home}/a, {home}/b", "one") == 2
    assert count(f"{home}/{{a,b}}/*.txt", "two") == 2
    assert count([f"{home}/a", f"{home}/c,d"], "three") == 2


@pytest.mark.parametrize("sep", ["||", r"\t", "\\", r"\E", r"a\Eb", "#", r"\u", ";"])
def test_separators_come_back_from_written_data(spark, home, sep):
    real = "\t" if sep == r"\t" else sep
    raw = [real.join(["1", "2.5", "ann"]), real.join(["2", "x", "bob"]), real.join(["3", "1", ""])]
    result = run(spark, home, FACT, sep=sep, raw=raw)
    assert result.counts["records_written"] == 2 and result.counts["convert"] == 1
    back = dimension.read_dimension(spark, result.data_path, real)
    assert back.columns[:3] == ["id", "price", "name"]
    assert sorted(tuple(r)[:3] for r in back.collect()) == [("1", "2.5", "ann"), ("3", "1.0", None)]


def test_separator_the_writer_cannot_use_is_refused(spark, home):
    with pytest.raises(ValueError, match="separator"):
        run(spark, home, FACT, sep='"')
    assert not os.path.exists(f"{home}/out")


def test_manifest_counts_every_folder_of_a_repeated_name(spark, home, monkeypatch):
    put(f"{home}/a/1.txt", "x\ny\n")
    put(f"{home}/b/1.txt", "z\n")
    monkeypatch.setattr("millrace.__main__.build_session", lambda name: spark)
    main(["manifest", f"{home}/m", f"A={home}/a", f"A={home}/b", f"both={home}/a,{home}/b"])
    assert sorted(line.rsplit("|", 1)[0] for line in read(f"{home}/m")) == ["A|1", "A|2", "both|3"]
    with pytest.raises(SystemExit, match="NAME=FOLDER"):
        main(["manifest", f"{home}/m2", f"{home}/a"])


def test_loads_from_the_command_line(spark, home, monkeypatch):
    monkeypatch.setattr("millrace.__main__.build_session", lambda name: spark)
    spec = put(f"{home}/spec/s.txt", SPEC.format(query="select id from src", sep="|"))
    put(f"{home}/raw/r.txt", "\n".join(RAW) + "\n")
    for kind, written in (("fact", 5), ("dimension", 3)):
        out = [f"{home}/{kind}/{name}" for name in ("out", "error", "audit")]
        main([kind, spec, f"{home}/raw", *out])
        assert len(read(out[0])) == written + 1


def test_shared_folder_leaves_the_context_alone(spark):
    before = spark.sparkContext.getCheckpointDir()
    stage.shared_folder(spark)
    assert spark.sparkContext.getCheckpointDir() == before


def test_staged_load_reads_the_raw_text_once(spark, home, monkeypatch):
    """Raw text that changes after staging does not change any output."""

    def stage_then_spoil(table, path):
        staged = stage.stage_table(table, path)
        put(f"{home}/raw/r.txt", "9|9|spoiled\n" * 7)
        return staged

    monkeypatch.setattr("millrace.plans.load.stage_table", stage_then_spoil)
    result = run(spark, home, FACT)
    assert not any("spoiled" in line for line in read(result.data_path))
    assert set(read(f"{home}/error")) == LOG
    assert read(f"{home}/audit") == [f"B1,A1,2,{STAMP},{STAMP},7,5,3"]


@pytest.mark.parametrize(
    "query",
    [
        "select k, v from dim union all select id, name from src",
        "select id, name from src union all select k, v from dim",
        "select k, v from dim union select id, name from src",
        "select k from dim union all select name from src union all select id from src",
        "select * from dim union all select * from (select * from dim union all select id, name from src)",
    ],
)
def test_union_branches_are_staged_whole(spark, home, query):
    spark.createDataFrame([("k1", "v1"), ("1", "ann")], "k string, v string").write.option(
        "header", True
    ).csv(f"{home}/dim", sep="|")
    columns = "MetaData:=id:=StringType\nMetaData:=name:=StringType\n"
    body = SPEC.format(query=query, sep="|").split("\n", 3)[3]
    text = columns + body.replace("NonNullable:=name:=2\n", "") + f"FactJoin:=dim:={home}/dim:=k,v\n"
    spec = put(f"{home}/spec/s.txt", text)
    raw = os.path.dirname(put(f"{home}/raw/r.txt", "1|ann\n2|bob\n3|cy\n"))
    got = []
    for staged in (True, False):
        paths = [f"{home}/{staged}/{name}" for name in ("out", "error", "audit")]
        result = run_load(spark, FACT, spec, raw, *paths, Options(stage=staged), lambda: NOW)
        lines = [line for line in read(result.data_path) if STAMP in line]
        got.append(sorted(line.split(f"|{STAMP}")[0] for line in lines))
    assert got[0] == got[1]
    assert any("bob" in line for line in got[0])
