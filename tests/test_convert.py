"""Conversion rules against the JVM's own parsers."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.errors.exceptions.captured import NumberFormatException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import convert

TEXTS = [
    "1", "+5", "-5", "007", "12.7", "1e3", "2147483647", "-2147483648", "2147483648", " 12 ", "12 ",
    "1\u0000", "", " ", "\t", "1d", "1.5f", "1.5F", "1D", "0x1p3", "0X1.8P-2d", "0x.8p1", "0x1.p1",
    "0x1", "0xp1", "NaN", "+NaN", "-NaN", "NaNd", "nan", "NAN", "inf", "-inf", "+inf", "Infinity",
    "-Infinity", "+Infinity", "infinity", "INF", "Infinityf", "1e999", "-1e999", "1e-999", ".5", "5.",
    ".", "+", "-", "+-1", "--1", "1.2.3", "..", ".1.", "-1..2", "1.2e3.4", "0.1.2", "00.0.0", "1e", "1e+",
    "e5", "1,234", "1_000", "١٢", "1٢", "-१", "１２", "\U0001d7ce", " q ", "x",
    "\x0b7\x1f", " 1", "1 ", "99999999999999999999", "3.4028236e38", "1e39", "0x1p-2000", "1 2",
    "\"1\"", "1f2", "1fd", "true", "null",
]


def jvm_parse(spark, kind, text):
    """(value, message) from java.lang."""
    lang = spark._jvm.java.lang
    parse = {
        "int": lang.Integer.parseInt,
        "float": lang.Float.parseFloat,
        "double": lang.Double.parseDouble,
    }
    try:
        return shown(kind, parse[kind](text)), None
    except NumberFormatException as error:
        return None, "Exception " + error._desc


def shown(kind, value):
    """A value as text, so that NaN compares; a float in its own precision."""
    return None if value is None else repr(np.float32(value) if kind == "float" else value)


TYPES = {"int": T.IntegerType(), "float": T.FloatType(), "double": T.DoubleType()}


def check(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind, data_type in TYPES.items():
        value = F.expr(convert.typed_value("t", data_type))
        rows = frame.select(
            "t",
            value.alias("v"),
            F.when(value.isNull(), convert.failure_reason(F.col("t"), data_type)).alias("m"),
        ).collect()
        for row in rows:
            ours = (shown(kind, row.v), row.m)
            assert ours == jvm_parse(spark, kind, row.t), (kind, row.t)


def test_listed_texts_match_the_jvm(spark):
    check(spark, TEXTS)


def test_random_texts_match_the_jvm(spark):
    rng = random.Random(7)
    letters = "0123456789" * 2 + "+-.eEdDfFxXpPNaInity \t٣"
    check(spark, ["".join(rng.choices(letters, k=rng.randint(0, 7))) for _ in range(400)])


def test_random_numbers_match_the_jvm(spark):
    rng = random.Random(8)
    texts = []
    for _ in range(200):
        body = f"{rng.randint(0, 10**rng.randint(1, 12))}"
        if rng.random() < 0.7:
            body += f".{rng.randint(0, 10**6)}"
        if rng.random() < 0.4:
            body += f"{rng.choice('eE')}{rng.randint(-60, 60)}"
        texts.append(rng.choice(["", " ", "+", "-"]) + body + rng.choice(["", "", "f", "D", " "]))
    check(spark, texts)


def test_text_converts_to_itself(spark):
    frame = spark.createDataFrame([("",), (" a ",)], "t string")
    value = F.expr(convert.typed_value("t", T.StringType()))
    assert [r[0] for r in frame.select(value).collect()] == ["", " a "]


@pytest.mark.parametrize(
    ("name", "expected"),
    [
        ("StringType", T.StringType()),
        ("IntegerType", T.IntegerType()),
        ("FloatType", T.FloatType()),
        ("DoubleType", T.DoubleType()),
        ("IntegerType]", T.IntegerType()),
        ("DateType", T.StringType()),
        ("integertype", T.StringType()),
    ],
)
def test_type_names(spark, name, expected):
    assert convert.resolve_type(name) == expected
    column = convert.resolve_type_column(F.lit(name))
    assert spark.range(1).select(column).first()[0] == expected.simpleString()


def test_declared_schema_keeps_order_and_allows_null():
    schema = convert.declared_schema([("b", "IntegerType"), ("a", "?")])
    assert [(f.name, f.dataType, f.nullable) for f in schema] == [
        ("b", T.IntegerType(), True),
        ("a", T.StringType(), True),
    ]
