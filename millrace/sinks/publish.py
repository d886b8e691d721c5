"""Several outputs published together.

Each output is first written beside its target. Then one marker commits the run, and the written
folders take their targets' places. A run that failed before the marker leaves targets as they
were, and the next run to the same place removes what it wrote; after the marker the next run
finishes the moves. A journal beside the first target names the moves.

One run at a time may write to a place, as with any overwrite. A move is a rename, which file
systems do at once; on an object store it copies.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import SparkSession

from millrace.sinks.files import create_file, delete_folder, move, names_in, path_exists, read_file

_JOURNAL = "_journal-"
_COMMIT = "_commit-"


def _split(path: str) -> tuple[str, str]:
    head, _, name = path.rstrip("/").rpartition("/")
    return head or ("/" if path.startswith("/") else "."), name


def _beside(path: str, run: str) -> str:
    parent, name = _split(path)
    return f"{parent}/_pending-{run}-{name}"


def finish_earlier(spark: SparkSession, place: str) -> None:
    """Complete the committed runs at ``place``, and remove what others left there."""
    parent, name = _split(place)
    for found in names_in(spark, parent):
        if found.startswith(f"{_JOURNAL}{name}-"):
            run = found.removeprefix(f"{_JOURNAL}{name}-")
            moves = json.loads(read_file(spark, f"{parent}/{found}"))
            if path_exists(spark, f"{parent}/{_COMMIT}{name}-{run}"):
                _move_all(spark, moves)
            _forget(spark, parent, name, run, moves)


def _move_all(spark: SparkSession, moves: Sequence[Sequence[str]]) -> None:
    """Put written folders in their targets' places; what was moved before is not there any more."""
    for written, target in moves:
        if path_exists(spark, written):
            delete_folder(spark, target)
            move(spark, written, target)


def _forget(spark: SparkSession, parent: str, name: str, run: str, moves) -> None:
    for written, _ in moves:
        delete_folder(spark, written)
    # The commit goes first: a journal without one only asks for cleaning.
    delete_folder(spark, f"{parent}/{_COMMIT}{name}-{run}")
    delete_folder(spark, f"{parent}/{_JOURNAL}{name}-{run}")


@contextmanager
def published(spark: SparkSession, place: str, targets: Sequence[str]) -> Iterator[list[str]]:
    """Folders to write in place of ``targets``; they are published when the block ends.

    ``place`` names the output whose runs belong together. If the block or the commit fails, the
    targets stay as they were.
    """
    finish_earlier(spark, place)
    parent, name = _split(place)
    run = uuid.uuid4().hex
    moves = [(_beside(t, run), t.rstrip("/")) for t in targets]
    create_file(spark, f"{parent}/{_JOURNAL}{name}-{run}", json.dumps(moves))
    try:
        yield [written for written, _ in moves]
        create_file(spark, f"{parent}/{_COMMIT}{name}-{run}")
    except BaseException:
        _forget(spark, parent, name, run, moves)
        raise
    _move_all(spark, moves)
    _forget(spark, parent, name, run, moves)
