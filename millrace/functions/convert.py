"""Declared types and the text-to-value rules, as column expressions.

A number converts when the JVM's own parser would take the text. Spark's cast is both wider
(it trims integers and knows ``inf``) and silent about the reason, so a pattern decides first
and the cast only ever sees text it accepts. That also keeps the cast off its slow path: a
failing ``try_cast`` raises and catches an exception per value.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.text import trimmed

# Fixed type names of a job spec. Every other name means text.
TYPE_NAMES: dict[str, T.DataType] = {
    "StringType": T.StringType(),
    "IntegerType": T.IntegerType(),
    "FloatType": T.FloatType(),
    "DoubleType": T.DoubleType(),
}

# Fixed wording of conversion failures.
FAILURE_PREFIX = "Exception "
BAD_INPUT = 'For input string: "'
EMPTY_INPUT = "empty String"
TWO_POINTS = "multiple points"

INTEGER_TEXT = r"\A[+-]?[0-9]+\z"
ANY_DIGITS_TEXT = r"\A[+-]?\p{Nd}+\z"

# The grammar in the public documentation of Double.valueOf.
_DECIMAL = r"(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_HEX = r"0[xX](?:[0-9a-fA-F]+\.?|[0-9a-fA-F]*\.[0-9a-fA-F]+)[pP][+-]?[0-9]+"
FLOATING_TEXT = (
    rf"\A[\x00-\x20]*[+-]?(?:NaN|Infinity|(?:{_DECIMAL}|{_HEX})[fFdD]?)[\x00-\x20]*\z"
)
TWO_POINTS_TEXT = r"\A[+-]?[0-9]*\.[0-9]*\."

# The integer parser takes every decimal digit of the basic plane, one char at a time.
_OTHER_DIGITS = "".join(
    chr(code)
    for code in range(0x80, 0x10000)
    if unicodedata.category(chr(code)) == "Nd"
)
_ASCII_DIGITS = "".join(str(unicodedata.digit(char)) for char in _OTHER_DIGITS)


def clean_type_name(name: str) -> str:
    return name.replace("]", "")


def resolve_type(name: str) -> T.DataType:
    """The declared type for a type name; unknown names are text."""
    return TYPE_NAMES.get(clean_type_name(name), T.StringType())


def resolve_type_column(name: Column) -> Column:
    """``resolve_type`` over a column of type names, giving SQL type names."""
    cleaned = F.replace(name, F.lit("]"), F.lit(""))
    result = None
    for known, data_type in TYPE_NAMES.items():
        sql_name = F.lit(data_type.simpleString())
        hit = cleaned == known
        result = F.when(hit, sql_name) if result is None else result.when(hit, sql_name)
    return result.otherwise(F.lit(T.StringType().simpleString()))


def declared_schema(columns: list[tuple[str, str]]) -> T.StructType:
    """Ordered ``(name, type name)`` pairs to a schema; every field may be null."""
    return T.StructType(
        [T.StructField(name, resolve_type(type_name), True) for name, type_name in columns]
    )


def typed_value(text: str, data_type: T.DataType) -> str:
    """SQL for the expression ``text`` as ``data_type``, or null where it does not convert.

    SQL text, because a wide spec has hundreds of these and each is one call to the JVM.
    """
    if isinstance(data_type, T.IntegerType):
        ascii_text = f"translate({text}, '{_OTHER_DIGITS}', '{_ASCII_DIGITS}')"
        return (
            f"case when {text} rlike r'{INTEGER_TEXT}' then try_cast({text} as int) "
            f"when {text} rlike r'{ANY_DIGITS_TEXT}' then try_cast({ascii_text} as int) end"
        )
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        name = data_type.simpleString()
        return f"if({text} rlike r'{FLOATING_TEXT}', try_cast({text} as {name}), null)"
    return text


def failure_reason(text: Column, data_type: T.DataType) -> Column:
    """Why ``text`` does not convert. Only meaningful where ``typed_value`` is null."""
    if isinstance(data_type, T.IntegerType):
        return F.concat(F.lit(FAILURE_PREFIX + BAD_INPUT), text, F.lit('"'))
    bare = trimmed(text)
    return (
        F.when(bare == "", F.lit(FAILURE_PREFIX + EMPTY_INPUT))
        .when(bare.rlike(TWO_POINTS_TEXT), F.lit(FAILURE_PREFIX + TWO_POINTS))
        .otherwise(F.concat(F.lit(FAILURE_PREFIX + BAD_INPUT), bare, F.lit('"')))
    )
