"""Line checks: field count, required fields, typed conversion.

``classify`` gives every raw line one row and one status, so accepted rows, rejects and counts
all come from the same pass.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.convert import failure_reason, typed_value
from millrace.functions.text import any_of
from millrace.sources.raw import FIELDS
from millrace.sources.spec import JobSpec

OK = "ok"
ARITY = "arity"
REQUIRED = "required"
CONVERT = "convert"

# Fixed word that puts a row into the error log wherever it stands.
MARKER = "Exception"

STATUS = "status"
MARKED = "marked"
RECORD_KEY = "record_key"
MESSAGE = "message"


def field_at(position: int) -> Column:
    """One field; null, not an error, past the end."""
    return F.expr(f"get({FIELDS}, {position})")


def value_name(position: int) -> str:
    """Name of a typed column in the classified table, free of clashes with control columns."""
    return f"v{position}"


def arity_is(arity: int) -> Column:
    return F.size(FIELDS) == arity


def is_missing(position: int) -> Column:
    """Empty or the word null in any case. Blanks count as a value."""
    return (field_at(position) == "") | (F.lower(field_at(position)) == "null")


def filter_arity(fields: DataFrame, arity: int) -> DataFrame:
    return fields.filter(arity_is(arity))


def filter_arity_mode(fields: DataFrame, arity: int, mismatched: bool) -> DataFrame:
    """``mismatched`` keeps the lines of any other field count instead."""
    return fields.filter(~arity_is(arity) if mismatched else arity_is(arity))


def filter_required(fields: DataFrame, spec: JobSpec) -> DataFrame:
    """Right field count and every required field filled."""
    missing = any_of([is_missing(position) for position in spec.required])
    return fields.filter(arity_is(spec.arity) & ~missing)


def empty_key_rows(fields: DataFrame, arity: int) -> DataFrame:
    """Lines of the right field count whose first field is empty: a data-quality probe."""
    return fields.filter(arity_is(arity) & (field_at(0) == ""))


def _with_values(fields: DataFrame, spec: JobSpec, carry: Sequence[str]) -> DataFrame:
    values = [
        f"{typed_value(f'get({FIELDS}, {i})', column.dataType)} as {value_name(i)}"
        for i, column in enumerate(spec.schema)
    ]
    return fields.selectExpr(FIELDS, *values, *carry)


def _first_failure(spec: JobSpec) -> Column:
    """The position of the leftmost field that does not convert, else null."""
    places = [
        f"if({value_name(i)} is null, {i}, null)"
        for i, column in enumerate(spec.schema)
        if not isinstance(column.dataType, T.StringType)
    ]
    return F.expr(f"coalesce({', '.join(places)})" if places else "cast(null as int)")


def _failure_message(spec: JobSpec) -> Column:
    """The message for the field at ``failed_at``, written out once and not per column."""
    text = F.get(FIELDS, F.col("failed_at"))
    integers = [
        i for i, column in enumerate(spec.schema) if isinstance(column.dataType, T.IntegerType)
    ]
    return F.when(
        F.col("failed_at").isin(integers), failure_reason(text, T.IntegerType())
    ).otherwise(failure_reason(text, T.DoubleType()))


def _has_marker(spec: JobSpec) -> Column:
    """Whether the fields, joined without a gap, hold the marker word.

    A number that converted cannot supply any letter of it, so raw and typed text agree, and
    a spec without text columns needs no look at all.
    """
    if not any(isinstance(column.dataType, T.StringType) for column in spec.schema):
        return F.lit(False)
    return F.concat_ws("", FIELDS).contains(MARKER)


def _marker_text(spec: JobSpec) -> Column:
    """A marked row as text of its typed values, comma-joined, without commas at the end."""
    texts = ", ".join(f"cast({value_name(i)} as string)" for i in range(spec.arity))
    return F.regexp_replace(F.expr(f"concat_ws(',', {texts})"), ",+$", "")


def pinned(rows: DataFrame) -> DataFrame:
    """The same rows, with everything later kept above this point of the plan.

    Catalyst moves filters and semi joins below a plain projection and repeats its expressions
    there, so a status test would convert every field again, and a join key once more. It does
    not move them below ``inline`` over one struct per row.
    """
    columns = ", ".join("`" + name.replace("`", "``") + "`" for name in rows.columns)
    return rows.select(F.expr(f"inline(array(struct({columns})))"))


def classify(fields: DataFrame, spec: JobSpec, carry: Sequence[str] = ()) -> DataFrame:
    """Per line: ``status, marked, record_key, message`` and one typed column per field.

    Columns of ``fields`` in ``carry`` go along as they are.

    Typed columns only mean something in accepted rows. ``record_key`` and ``message`` are filled
    for rows a log may mention: the first field and the conversion message of a rejected line,
    or, for an accepted row that holds the marker word, the first and last comma-separated
    piece of its text.
    """
    missing = any_of([is_missing(position) for position in spec.required])
    values = [value_name(i) for i in range(spec.arity)]
    failed_at = _first_failure(spec)
    checked = _with_values(fields, spec, carry).select(
        FIELDS,
        F.when(~arity_is(spec.arity), ARITY)
        .when(missing, REQUIRED)
        .when(failed_at.isNotNull(), CONVERT)
        .otherwise(OK)
        .alias(STATUS),
        failed_at.alias("failed_at"),
        *values,
        *carry,
    )
    accepted = F.col(STATUS) == OK
    marked = accepted & _has_marker(spec)
    text = _marker_text(spec)
    return checked.select(
        STATUS,
        marked.alias(MARKED),
        F.when(~accepted, field_at(0))
        .when(marked, F.substring_index(text, ",", 1))
        .alias(RECORD_KEY),
        F.when(F.col(STATUS) == CONVERT, _failure_message(spec))
        .when(marked, F.substring_index(text, ",", -1))
        .alias(MESSAGE),
        *values,
        *carry,
    )


def accepted_rows(
    classified: DataFrame,
    spec: JobSpec,
    read: Collection[int] | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The declared table: accepted rows, declared names and types, then columns in ``carry``.

    ``read`` are the positions that ``classified`` still has; the others come as nulls.
    """
    columns = []
    for i, (name, _) in enumerate(spec.columns):
        there = read is None or i in read
        value = F.col(value_name(i)) if there else F.lit(None).cast(spec.schema[i].dataType)
        columns.append(value.alias(name))
    return classified.filter(F.col(STATUS) == OK).select(*columns, *carry)


def narrowed(
    classified: DataFrame, read: Collection[int], carry: Sequence[str] = ()
) -> DataFrame:
    """Control columns, the typed columns in ``read`` (null unless accepted) and ``carry``."""
    accepted = F.col(STATUS) == OK
    values = [F.when(accepted, F.col(value_name(i))).alias(value_name(i)) for i in sorted(read)]
    return classified.select(STATUS, MARKED, RECORD_KEY, MESSAGE, *values, *carry)


def failed_conversions(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col(STATUS) == CONVERT).select(RECORD_KEY, MESSAGE)
