"""Millrace: spec-driven loads of delimited raw text, on Spark DataFrames and SQL."""

from millrace.plans.history import HistoryRule, read_history, versions
from millrace.plans.load import (
    DIMENSION,
    FACT,
    LoadResult,
    Options,
    run_dimension_load,
    run_fact_load,
    run_load,
)
from millrace.plans.manifest import run_manifest
from millrace.session import build_session, job_session
from millrace.sources.spec import JobSpec, load_spec

__all__ = [
    "DIMENSION",
    "FACT",
    "HistoryRule",
    "JobSpec",
    "LoadResult",
    "Options",
    "build_session",
    "job_session",
    "load_spec",
    "read_history",
    "run_dimension_load",
    "run_fact_load",
    "run_load",
    "run_manifest",
    "versions",
]
