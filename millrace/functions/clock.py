"""The ways a run renders its own time."""

from __future__ import annotations

from datetime import datetime

# Fixed formats of the stamps and folder names.
STAMP = "%Y-%m-%d %H:%M:%S"
DAY = "%Y-%m-%d"
VERSION = "%Y%m%dT%H%M%S%f"
DAY_FOLDER = "%Y/%m/%d"
TIME_FOLDER = "%H-%M-%S"


def stamp(moment: datetime) -> str:
    return moment.strftime(STAMP)


def version(moment: datetime) -> str:
    """A name that sorts by time, to the microsecond."""
    return moment.strftime(VERSION)


def day(moment: datetime) -> str:
    return moment.strftime(DAY)


def day_folder(moment: datetime) -> str:
    return moment.strftime(DAY_FOLDER)


def day_time_folder(moment: datetime) -> str:
    return moment.strftime(f"{DAY_FOLDER}/{TIME_FOLDER}")
