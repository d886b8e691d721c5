from __future__ import annotations

import os

import pytest

from millrace.sources import spec as specs

BASE = """MetaData:=ok:=IntegerType
MetaData:=price:=DoubleType
Data:=Sep:=|
Query:=Temp_Table:=src
Query:=Main_Query:=select * from src
DATAQUALITY:=BatchId:=B1
DATAQUALITY:=ActivityId:=A1
"""


def write(home, text, name="spec.txt"):
    path = os.path.join(home, name)
    with open(path, "w", newline="") as out:
        out.write(text)
    return path


def load(spark, home, text, **options):
    return specs.load_spec(spark, write(home, text), **options)


def test_plain_spec(spark, home):
    spec = load(spark, home, BASE)
    assert spec.columns == (("ok", "IntegerType"), ("price", "DoubleType"))
    assert (spec.separator, spec.view, spec.query) == ("|", "src", "select * from src")
    assert (spec.batch_id, spec.activity_id) == ("B1", "A1")
    assert spec.dimensions == () and spec.required == () and spec.arity == 2


def test_duplicate_column_keeps_first_place_and_last_type(spark, home):
    spec = load(spark, home, BASE + "MetaData:=z:=FloatType\nMetaData:=ok:=StringType\n")
    assert spec.columns == (("ok", "StringType"), ("price", "DoubleType"), ("z", "FloatType"))


def test_tokens_are_trimmed_and_line_ends_do_not_matter(spark, home):
    text = BASE.replace("Data:=Sep:=|", "  Data :=\tSep\t:=  ;  ").replace("\n", "\r\n")
    assert load(spark, home, text + "\r\n\r\n").separator == ";"


def test_query_may_hold_the_mark_only_once_and_trailing_marks_vanish(spark, home):
    spec = load(spark, home, BASE.replace("select * from src", "select 1:=:="))
    assert spec.query == "select 1"


def test_sections_match_exactly_or_by_containing(spark, home):
    text = BASE + "Note about MetaData:=extra:=IntegerType\nFactJoin1:=dim:=/p:=a, b\n"
    assert load(spark, home, text).columns == load(spark, home, BASE).columns
    loose = load(spark, home, text, match="contains")
    assert ("extra", "IntegerType") in loose.columns
    assert loose.separator == "|"
    assert loose.dimensions == (specs.Dimension("dim", "/p", "a, b"),)


def test_dimensions_in_order(spark, home):
    spec = load(spark, home, BASE + "FactJoin:=b:=/b:=x as y\nFactJoin:=a:=/a:=upper(z) z\n")
    assert [d.name for d in spec.dimensions] == ["b", "a"]
    assert spec.dimensions[1].select_list == "upper(z) z"


def test_required_positions(spark, home):
    text = BASE + "NonNullable:=price:=1\nNonNullable:=ok:=0\n"
    assert load(spark, home, text).required == (1, 0)
    assert load(spark, home, text, use_required=False).required == ()


@pytest.mark.parametrize("position", ["2", "-1", "x"])
def test_bad_required_position(spark, home, position):
    text = BASE + f"NonNullable:=ok:={position}\n"
    with pytest.raises(ValueError, match="NonNullable"):
        load(spark, home, text)
    assert load(spark, home, text, use_required=False).required == ()


@pytest.mark.parametrize(
    ("gone", "named"),
    [
        ("Data:=Sep:=|", "Data:=Sep"),
        ("Query:=Temp_Table:=src", "Query:=Temp_Table"),
        ("Query:=Main_Query:=select * from src", "Query:=Main_Query"),
        ("DATAQUALITY:=BatchId:=B1", "DATAQUALITY:=BatchId"),
        ("DATAQUALITY:=ActivityId:=A1", "DATAQUALITY:=ActivityId"),
    ],
)
def test_missing_key_is_named(spark, home, gone, named):
    with pytest.raises(ValueError, match=named):
        load(spark, home, BASE.replace(gone + "\n", ""))


def test_missing_columns(spark, home):
    with pytest.raises(ValueError, match="MetaData"):
        load(spark, home, "".join(x for x in BASE.splitlines(True) if "MetaData" not in x))


def test_log_paths_on_demand(spark, home):
    load(spark, home, BASE)
    with pytest.raises(ValueError, match="ERRORSCHEMA:=Path"):
        load(spark, home, BASE, need_log_paths=True)
    text = BASE + "ERRORSCHEMA:=Path:=/e\nAUDITSCHEMA:=Path:=/a\nSCD:=Type2:=x\n"
    assert load(spark, home, text, need_log_paths=True).settings["SCD"] == {"Type2": "x"}


@pytest.mark.parametrize("line", ["SCD:=Type2", "SCD:=Type2:=", "SCD", "SCD:=:="])
def test_entry_without_value_names_its_line(spark, home, line):
    with pytest.raises(ValueError, match="line 8"):
        load(spark, home, BASE + line + "\n")


def test_dimension_without_select_list_names_its_line(spark, home):
    with pytest.raises(ValueError, match="line 9.*select list"):
        load(spark, home, BASE + "\nFactJoin:=d:=/p\n")


def test_tab_separator(spark, home):
    assert load(spark, home, BASE.replace(":=|", r":=\t")).separator == "\t"


def test_blank_separator_is_refused(spark, home):
    with pytest.raises(ValueError, match="Sep"):
        load(spark, home, BASE.replace(":=|", ":= "))


def test_unknown_match_mode(spark, home):
    with pytest.raises(ValueError, match="match"):
        load(spark, home, BASE, match="fuzzy")


def test_lookup(spark, home):
    path = write(home, "Name:= a :=b\nother:=x\nNAME:=c\nEmpty:=\n name:=d\n")
    assert specs.read_setting(spark, path, "name") == "c"
    assert specs.read_setting(spark, path, " name") == "d"
    assert specs.read_setting(spark, path, "nothing") == ""
    with pytest.raises(ValueError, match="line 4"):
        specs.read_setting(spark, path, "empty")
