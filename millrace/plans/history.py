"""A versioned history folder.

``load=<version>/state=open`` holds all open rows after a load, ``load=<version>/state=closed`` the
rows which that load closed. Closed rows are never written again: a load reads and writes open rows
only. A version counts once its marker ``_done-<version>`` is there; a run that failed leaves
no marker and its folder is removed by the next one.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.history import CHANGE, CLOSED, OPENED, merge_latest, one_per_key
from millrace.operators.integrate import stamp
from millrace.sinks.files import create_file, delete_folder, names_in, read_file
from millrace.sinks.stage import new_folder, stage_table

_LOAD, _MARK = "load=", "_done-"
_SCHEMA = "schema.json"
OPEN = "open"


@dataclass(frozen=True)
class HistoryRule:
    """How records of a history are told apart.

    ``tracked`` None means every column that is no key. ``order`` decides between several rows of
    a key in one batch. ``close_missing`` closes keys that a batch lacks.
    """

    keys: tuple[str, ...]
    tracked: tuple[str, ...] | None = None
    order: tuple[str, ...] = ()
    close_missing: bool = False

    @classmethod
    def from_settings(cls, settings: dict[str, str]) -> HistoryRule:
        """From a spec's SCD section: ``JoinID``, ``Columns``, ``Order``, commas between names."""

        def names(key: str) -> tuple[str, ...]:
            return tuple(n.strip() for n in settings.get(key, "").split(",") if n.strip())

        if not names("JoinID"):
            raise ValueError("spec has no SCD:=JoinID")
        return cls(names("JoinID"), names("Columns") or None, names("Order"))


def done_marker(path: str, version: str) -> str:
    return f"{path.rstrip('/')}/{_MARK}{version}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """Published versions, oldest first."""
    return sorted(n.removeprefix(_MARK) for n in names_in(spark, path) if n.startswith(_MARK))


def _drop_unpublished(spark: SparkSession, path: str) -> None:
    done = set(versions(spark, path))
    for name in names_in(spark, path):
        if name.startswith(_LOAD) and name.removeprefix(_LOAD) not in done:
            delete_folder(spark, f"{path}/{name}")


def _read(spark: SparkSession, paths: list[str], schema: T.StructType) -> DataFrame:
    if not paths:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])
    return spark.read.schema(schema).parquet(*paths)


def _parts(spark: SparkSession, path: str, loads: list[str], state: str) -> list[str]:
    """The folders that hold rows; a load may have closed nothing, or left nothing open."""
    return [
        f"{path}/{_LOAD}{v}/state={state}"
        for v in loads
        if f"state={state}" in names_in(spark, f"{path}/{_LOAD}{v}")
    ]


def read_history(spark: SparkSession, path: str, version: str | None = None) -> DataFrame:
    """All rows as of a version (the last one by default): open ones, and all closed so far."""
    done = versions(spark, path)
    if version is not None and version not in done:
        raise ValueError(f"history {path} has no version {version!r}")
    done = [v for v in done if version is None or v <= version]
    if not done:
        raise ValueError(f"history {path} has no version")
    parts = _parts(spark, path, done[-1:], OPEN) + _parts(spark, path, done, CLOSED)
    return _read(spark, parts, _schema(spark, path, done[-1]))


def _schema(spark: SparkSession, path: str, version: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(read_file(spark, f"{path}/{_LOAD}{version}/{_SCHEMA}")))


def write_version(
    session: SparkSession,
    path: str,
    batch: DataFrame,
    rule: HistoryRule,
    version: str,
    load_time: str,
    batch_id: str,
    system: str | None = None,
    marker: str | None = None,
) -> tuple[int, int]:
    """Merge a batch into the last version and publish the result; rows opened and closed.

    The batch must have the columns of the history. Nothing of the last version is touched.
    A ``marker`` is written in place of the version's own, for a caller that publishes by moving
    it there (``done_marker``).
    """
    _drop_unpublished(session, path)
    done = versions(session, path)
    if done and version <= done[-1]:
        raise ValueError(f"history {path} already has version {done[-1]!r}")
    tracked = rule.tracked or tuple(c for c in batch.columns if c not in rule.keys)
    schema = stamp(batch, load_time, batch_id, system).schema
    if done:
        before = _schema(session, path, done[-1])
        if [(f.name, f.dataType) for f in before] != [(f.name, f.dataType) for f in schema]:
            raise ValueError(f"history {path} has columns {before.simpleString()}")
    missing = [c for c in (*rule.keys, *tracked) if c not in batch.columns]
    if missing:
        raise ValueError(f"history {path}: the result has no column {missing}")
    current = _read(session, _parts(session, path, done[-1:], OPEN), schema)
    staged_path = new_folder(session, "latest")
    try:
        latest = stage_table(one_per_key(batch, rule.keys, rule.order), staged_path)
        merged = merge_latest(
            current, latest, rule.keys, tracked, load_time, batch_id, rule.close_missing, system
        )
        seen = Observation()
        rows = merged.observe(
            seen,
            F.count_if(F.col(CHANGE) == OPENED).alias(OPENED),
            F.count_if(F.col(CHANGE) == CLOSED).alias(CLOSED),
        )
        target = f"{path}/{_LOAD}{version}"
        state = F.when(F.col(CHANGE) == CLOSED, CLOSED).otherwise(OPEN).alias("state")
        rows.select(*schema.names, state).write.partitionBy("state").parquet(target)
        create_file(session, f"{target}/{_SCHEMA}", schema.json())
        create_file(session, marker or done_marker(path, version))
    finally:
        delete_folder(session, staged_path)
    return seen.get[OPENED], seen.get[CLOSED]
