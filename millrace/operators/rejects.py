"""Reject tables and the comma-joined error log."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.classify import (
    ARITY,
    CONVERT,
    MARKED,
    MESSAGE,
    RECORD_KEY,
    REQUIRED,
    STATUS,
)

# Fixed wording for a line of the wrong field count.
ARITY_MESSAGE = "The record doesnt have enough arguments or filled"
# Our own wording; such lines are only logged on request.
REQUIRED_MESSAGE = "A required field is empty"

REJECT_COLUMNS = ("batch_id", "activity_id", "record_key", "error_ts", "message")


@dataclass(frozen=True)
class RunLabel:
    """What every log row of a run repeats."""

    batch_id: str
    activity_id: str
    run_time: str


def is_arity_reject() -> Column:
    return F.col(STATUS) == ARITY


def is_convert_reject() -> Column:
    return F.col(STATUS) == CONVERT


def is_marker_reject() -> Column:
    return F.col(MARKED)


def is_logged(strict: bool = False, log_required: bool = False) -> Column:
    """Which classified rows the error log holds.

    By default: wrong field count, failed conversion, and accepted rows that hold the marker
    word. ``strict`` leaves those accepted rows out; ``log_required`` adds lines dropped for an
    empty required field.
    """
    logged = is_arity_reject() | is_convert_reject()
    if log_required:
        logged = logged | (F.col(STATUS) == REQUIRED)
    return logged if strict else logged | is_marker_reject()


def logged_rows(
    classified: DataFrame,
    strict: bool = False,
    log_required: bool = False,
    carry: Sequence[str] = (),
) -> DataFrame:
    """The classified rows the error log holds, without their typed values."""
    return classified.filter(is_logged(strict, log_required)).select(
        STATUS, MARKED, RECORD_KEY, MESSAGE, *carry
    )


def _message() -> Column:
    return (
        F.when(is_arity_reject(), F.lit(ARITY_MESSAGE))
        .when(F.col(STATUS) == REQUIRED, F.lit(REQUIRED_MESSAGE))
        .otherwise(F.col(MESSAGE))
    )


def reject_table(
    classified: DataFrame, label: RunLabel, condition: Column, carry: Sequence[str] = ()
) -> DataFrame:
    """Chosen classified rows as the five typed log columns, texts in full, then ``carry``.

    The kinds of reject exclude each other, so one filter over one pass gives their bag union.
    """
    return classified.filter(condition).select(
        F.lit(label.batch_id).alias("batch_id"),
        F.lit(label.activity_id).alias("activity_id"),
        F.col(RECORD_KEY),
        F.lit(label.run_time).alias("error_ts"),
        _message().alias("message"),
        *carry,
    )


def reject_lines(
    classified: DataFrame,
    label: RunLabel,
    strict: bool = False,
    log_required: bool = False,
) -> DataFrame:
    """The error log as text lines of five comma-joined parts, nothing escaped.

    A conversion reject shows its key only up to the first comma and its message only after the
    last one, as the log format has it; ``reject_table`` keeps both in full.
    """
    converted = is_convert_reject()
    key = F.col(RECORD_KEY)
    message = _message()
    return logged_rows(classified, strict, log_required).select(
        F.concat_ws(
            ",",
            F.lit(label.batch_id),
            F.lit(label.activity_id),
            F.when(converted, F.substring_index(key, ",", 1)).otherwise(key),
            F.lit(label.run_time),
            F.when(converted, F.substring_index(message, ",", -1)).otherwise(message),
        ).alias("value")
    )
