from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import classify as checks
from millrace.operators import metrics, rejects
from millrace.sources.raw import join_fields, read_lines, split_fields
from millrace.sources.spec import JobSpec

LABEL = rejects.RunLabel("B1", "A1", "2024-01-01 00:00:00")
ARITY = "The record doesnt have enough arguments or filled"


def make_spec(types, separator="|", required=()):
    return JobSpec(
        columns=tuple((f"c{i}", t) for i, t in enumerate(types)),
        separator=separator,
        view="src",
        query="select * from src",
        batch_id="B1",
        activity_id="A1",
        required=required,
    )


FOUR = make_spec(["IntegerType", "FloatType", "DoubleType", "StringType"])


def lines_of(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def classified(spark, lines, spec):
    return checks.classify(split_fields(lines_of(spark, lines), spec.separator), spec)


def log_of(spark, lines, spec, **options):
    table = rejects.reject_lines(classified(spark, lines, spec), LABEL, **options)
    return [row.value for row in table.collect()]


@pytest.mark.parametrize(
    ("line", "status", "message"),
    [
        ("1|1.5|2.5|a", "ok", None),
        ("+5|1|2|", "ok", None),
        ("1|1.5f|1d|x", "ok", None),
        ("1|NaN|-Infinity|x", "ok", None),
        ("1|nan|2|x", "convert", 'Exception For input string: "nan"'),
        (" 1|1|2|x", "convert", 'Exception For input string: " 1"'),
        ("1| q |2|x", "convert", 'Exception For input string: "q"'),
        ("1||2|x", "convert", "Exception empty String"),
        ("|1|2|x", "convert", 'Exception For input string: ""'),
        ("x|y|2|x", "convert", 'Exception For input string: "x"'),
        ("1|2|1.2.3|x", "convert", "Exception multiple points"),
        ("1|1|2", "arity", None),
        ("1|1|2|x|", "arity", None),
        ("", "arity", None),
        ("1|1|2|NullPointerException", "ok", "NullPointerException"),
    ],
)
def test_status_and_message(spark, line, status, message):
    for rows in (classified(spark, [line], FOUR), checks.pinned(classified(spark, [line], FOUR))):
        row = rows.first()
        assert (row.status, row.message) == (status, message)


def test_accepted_rows_are_typed(spark):
    rows = checks.accepted_rows(classified(spark, ["+5|1.5f|0x1p3|"], FOUR), FOUR)
    assert rows.schema == FOUR.schema
    assert tuple(rows.first()) == (5, 1.5, 8.0, "")


def test_odd_column_names(spark):
    spec = JobSpec((("status", "IntegerType"), ("a b.c", "StringType")), ",", "v", "", "B", "A")
    rows = checks.accepted_rows(checks.pinned(classified(spark, ["1,x"], spec)), spec)
    assert rows.columns == ["status", "a b.c"] and tuple(rows.first()) == (1, "x")


def test_required_fields(spark):
    spec = make_spec(["StringType"] * 3, required=(0, 2))
    lines = ["a|b|c", "|b|c", "a||c", "a|b|", "NULL|b|c", "a|b|Null", " |b|c", "a|null|c", "a|b"]
    status = [r.status for r in classified(spark, lines, spec).collect()]
    want = ["ok", "required", "ok", "required", "required", "required", "ok", "ok", "arity"]
    assert status == want
    fields = split_fields(lines_of(spark, lines), "|")
    kept = [r[0] for r in checks.filter_required(fields, spec).select(F.concat_ws("|", "fields")).collect()]
    assert kept == [line for line, s in zip(lines, want) if s == "ok"]


def test_required_comes_before_conversion(spark):
    spec = make_spec(["IntegerType", "StringType"], required=(1,))
    assert classified(spark, ["x|"], spec).first().status == "required"
    assert classified(spark, ["x|"], make_spec(["IntegerType", "StringType"])).first().status == "convert"


def test_arity_filters(spark):
    fields = split_fields(lines_of(spark, ["a|b", "a", "", "a|b|c", "|"]), "|")
    assert checks.filter_arity(fields, 2).count() == 2
    assert checks.filter_arity_mode(fields, 2, mismatched=True).count() == 3
    assert checks.filter_arity_mode(fields, 2, mismatched=False).count() == 2
    assert checks.empty_key_rows(fields, 2).count() == 1


@pytest.mark.parametrize("sep", ["|", ".", "^", "\\", "||", "\\E", "a\\Eb", ",", "\t", "]", "$", "§", "0", "é€"])
def test_separators_are_literal(spark, sep):
    line = sep.join(["x", "", "y", "", ""])
    assert split_fields(lines_of(spark, [line]), sep).first().fields == ["x", "", "y", "", ""]


def test_blank_line_has_one_empty_field(spark):
    assert split_fields(lines_of(spark, [""]), "|").first().fields == [""]


def test_line_ends(spark, home):
    with open(f"{home}/raw.txt", "wb") as out:
        out.write(b"a|1\nb|2\r\nc|3\rd|4\n\ne")
    values = [r.value for r in read_lines(spark, home).collect()]
    assert values == ["a|1", "b|2", "c|3", "d|4", "", "e"]


def test_join_fields(spark):
    table = spark.createDataFrame([(1, None, "x")], "a int, b string, `c d` string")
    assert join_fields(table).first().value == "1||x"


def test_log_lines(spark):
    lines = ["1,234|1|2|x", "a,b|1", "7|1|2|say,Exception,,", "1|1|2|x", "1|2|x,y|z"]
    assert log_of(spark, lines, FOUR) == [
        'B1,A1,1,2024-01-01 00:00:00,234"',
        f"B1,A1,a,b,2024-01-01 00:00:00,{ARITY}",
        "B1,A1,7,2024-01-01 00:00:00,Exception",
        'B1,A1,1,2024-01-01 00:00:00,y"',
    ]


def test_typed_rejects_keep_texts_in_full(spark):
    rows = classified(spark, ["1,234|1|2|x"], FOUR)
    table = rejects.reject_table(rows, LABEL, rejects.is_logged())
    assert table.columns == list(rejects.REJECT_COLUMNS)
    assert table.first().record_key == "1,234"
    assert table.first().message == 'Exception For input string: "1,234"'


def test_strict_and_required_logging(spark):
    spec = make_spec(["IntegerType", "StringType"], required=(1,))
    lines = ["1|an Exception", "2|", "3"]
    assert len(log_of(spark, lines, spec)) == 2
    assert len(log_of(spark, lines, spec, strict=True)) == 1
    assert len(log_of(spark, lines, spec, strict=True, log_required=True)) == 2
    assert "B1,A1,2,2024-01-01 00:00:00,A required field is empty" in log_of(
        spark, lines, spec, log_required=True
    )


def test_marker_across_fields_uses_converted_values(spark):
    spec = make_spec(["DoubleType", "StringType", "StringType"])
    assert log_of(spark, ["+1e10|Excep|tion", "1E|xception|x", "1|Exception|x", "2|exception|"], spec) == [
        "B1,A1,1.0E10,2024-01-01 00:00:00,tion",
        'B1,A1,1E,2024-01-01 00:00:00,Exception For input string: "1E"',
        "B1,A1,1.0,2024-01-01 00:00:00,x",
    ]


def test_spec_without_text_columns(spark):
    spec = make_spec(["IntegerType", "IntegerType"])
    counts = metrics.line_counts(classified(spark, ["1|2", "x|2"], spec)).first()
    assert (counts.accepted, counts.convert, counts.marked) == (1, 1, 0)


def slow_status(line, spec):
    """The same decision in plain Python, for integers and texts."""
    fields = line.split(spec.separator)
    if len(fields) != spec.arity:
        return "arity"
    if any(fields[i] == "" or fields[i].lower() == "null" for i in spec.required):
        return "required"
    for field, (_, type_name) in zip(fields, spec.columns):
        if type_name == "IntegerType":
            digits = field[1:] if field[:1] in ("+", "-") else field
            if not (digits.isascii() and digits.isdigit()) or not -(2**31) <= int(field) < 2**31:
                return "convert"
    return "ok"


@pytest.mark.parametrize("seed", range(3))
def test_random_lines(spark, seed):
    rng = random.Random(seed)
    types = [rng.choice(["IntegerType", "StringType"]) for _ in range(4)]
    spec = make_spec(types, required=tuple(rng.sample(range(4), 2)))
    pieces = ["1", "-7", "x", "", "null", "NULL", " ", "2147483648", "Exception", "a,b", "+0"]
    lines = ["|".join(rng.choices(pieces, k=rng.choice([4, 4, 4, 3, 5]))) for _ in range(500)]
    table = classified(spark, lines, spec)
    assert [r.status for r in table.collect()] == [slow_status(x, spec) for x in lines]
    counts = metrics.line_counts(table).first()
    parts = (counts.accepted, counts.arity, counts.required, counts.convert)
    assert sum(parts) == counts.records_read == 500
    assert counts.records_rejected == len(log_of(spark, lines, spec))


def test_main_fixture_counts(spark):
    from acceptance.fixture import classified_main

    counts = metrics.line_counts(classified_main(spark, "/root/testdata/sf0.01")).first()
    assert counts.records_read == 60000
    parts = (counts.accepted, counts.convert, counts.arity, counts.required)
    assert parts == (22956, 11308, 8583, 17153)
