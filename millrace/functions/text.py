"""Small text expressions shared by the sources and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters at or below the blank, the set that ``String.trim`` removes on the JVM.
BLANKS = "".join(map(chr, range(0x21)))


#: Characters with a meaning of their own in a pattern.
PATTERN_SIGNS = ".$|()[{^?*+\\"


def trimmed(text: Column) -> Column:
    """Drop leading and trailing blanks and control characters."""
    return F.btrim(text, F.lit(BLANKS))


def literal_pattern(separator: str) -> str:
    """A Java pattern that matches ``separator`` as plain text, whatever it holds.

    One plain or backslashed character is what the JVM splits at without compiling a pattern
    for every line, which halves the cost of a split.
    """
    if not separator:
        raise ValueError("the field separator is empty")
    if len(separator) == 1 and separator < "\ud800":
        return "\\" + separator if separator in PATTERN_SIGNS else separator
    return r"\Q" + separator.replace(r"\E", r"\E\\E\Q") + r"\E"


def any_of(conditions: list[Column]) -> Column:
    """OR over a list of conditions; false for an empty list."""
    result = F.lit(False)
    for position, condition in enumerate(conditions):
        result = condition if position == 0 else result | condition
    return result
