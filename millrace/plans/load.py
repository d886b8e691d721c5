"""One load: raw text in; data, error log and run record out."""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions import clock
from millrace.operators.classify import OK, STATUS, accepted_rows, classify, narrowed, pinned
from millrace.operators.integrate import columns_read, integrate, stamp
from millrace.operators.metrics import (
    IN_PROGRESS,
    line_count_columns,
    run_record,
    run_record_line,
)
from millrace.operators.origin import FIRST, LAST, SOURCE_SYSTEM, keep_one, source_system
from millrace.operators.rejects import (
    RunLabel,
    is_logged,
    logged_rows,
    reject_lines,
    reject_table,
)
from millrace.plans.history import HistoryRule, done_marker, write_version
from millrace.session import (
    BYTES_PER_SHUFFLE_PARTITION,
    MOST_SCAN_TASKS,
    MOST_SHUFFLE_PARTITIONS,
    fit_scans,
    fit_shuffles,
    job_session,
)
from millrace.sinks.files import (
    dated_path,
    delete_folder,
    in_ordered_files,
    is_ordered,
    path_exists,
    sized,
    write_data,
    write_log,
    write_rejects,
    write_small_log,
)
from millrace.sinks.publish import finish_earlier, published
from millrace.sinks.stage import new_folder, stage_table
from millrace.sources.checked import FanOut, fan_out, staged_dimension
from millrace.sources.dimension import project_dimension, read_dimension
from millrace.sources.raw import (
    ORIGIN,
    input_paths,
    read_lines,
    read_lines_with_origin,
    split_fields,
)
from millrace.sources.spec import SCD, JobSpec, load_spec


@dataclass(frozen=True)
class Preset:
    """What tells the two kinds of load apart."""

    check_required: bool
    need_log_paths: bool


FACT = Preset(check_required=False, need_log_paths=False)
DIMENSION = Preset(check_required=True, need_log_paths=True)


@dataclass(frozen=True)
class Options:
    """Choices a load leaves to its caller.

    ``data_files`` / ``log_files`` ask for a number of output files; a result that the statement
    orders is ordered over them. ``strict`` and ``log_required`` choose what the error log holds.
    ``match`` is how spec sections are told apart. ``stage=False`` stages the rejects only and
    reads the raw text a second time for the data, where there is no room for a staged copy of the
    columns the statement reads.

    ``keep`` (``first`` or ``last``) keeps one accepted record of each value of the first field,
    by its place in the input. ``systems`` names the source system: one for all rows, a stamp, or
    one for each folder, a column of the source view (the longest folder that holds the file
    counts). ``reject_table`` is a folder for the rejects as CSV with their own columns.

    ``history`` merges the result into the versioned history at the output path by the spec's SCD
    section; ``close_missing`` closes records that are not in the result.

    ``dimension_keys`` checks dimensions for doubled keys: their key columns by dimension name, the
    first projected column where none is named. ``doubled_keys`` is a folder for the keys found.

    ``most_scan_tasks`` bounds the tasks of the raw scan. Shuffles start with a partition for each
    ``shuffle_bytes`` of the staged table (of the raw text with ``stage=False``), at most
    ``most_shuffle_partitions``. A setting the caller's session already has goes first.
    """

    data_files: int | None = None
    log_files: int | None = None
    strict: bool = False
    log_required: bool = False
    match: str = "exact"
    run_status: str = IN_PROGRESS
    stage: bool = True
    keep: str | None = None
    systems: str | Mapping[str, str] | None = None
    reject_table: str | None = None
    history: bool = False
    close_missing: bool = False
    dimension_keys: Mapping[str, Sequence[str]] | None = None
    doubled_keys: str | None = None
    most_scan_tasks: int = MOST_SCAN_TASKS
    shuffle_bytes: int = BYTES_PER_SHUFFLE_PARTITION
    most_shuffle_partitions: int = MOST_SHUFFLE_PARTITIONS

    def __post_init__(self) -> None:
        if self.keep not in (None, FIRST, LAST):
            raise ValueError(f"keep {FIRST!r} or {LAST!r}, not {self.keep!r}")
        if self.doubled_keys and self.dimension_keys is None:
            raise ValueError("doubled_keys needs dimension_keys; {} checks first columns")

    @property
    def by_folder(self) -> bool:
        return self.systems is not None and not isinstance(self.systems, str)

    @property
    def log_choice(self) -> tuple[bool, bool]:
        return self.strict, self.log_required


@dataclass(frozen=True)
class LoadResult:
    """``version`` names the history's new version, ``fan_outs`` what dimensions were checked."""

    data_path: str
    error_path: str
    audit_path: str
    start_time: str
    end_time: str
    counts: dict[str, int]
    version: str | None = None
    fan_outs: tuple[FanOut, ...] = ()


def run_load(
    spark: SparkSession,
    preset: Preset,
    spec_path: str,
    raw_path: str | Sequence[str],
    output_path: str,
    error_path: str,
    audit_path: str,
    options: Options = Options(),
    now: Callable[[], datetime] = datetime.now,
) -> LoadResult:
    """Run a load and write its outputs.

    The statement is analysed first. By default the raw text is then read once: accepted rows, with
    the columns the statement reads, and rejects go to a staged table, counted in the same pass.
    ``raw_path`` may be a comma-separated list of files, folders and globs, or a sequence.

    Data, logs and further outputs are written beside their places and published together: a load
    that fails leaves all of them as they were.
    """
    session = job_session(spark)
    spec = load_spec(
        session, spec_path, options.match, preset.check_required, preset.need_log_paths
    )
    rule = _history_rule(spec, options)
    if options.by_folder and SOURCE_SYSTEM in spec.schema.names:
        raise ValueError(f"the spec has a column {SOURCE_SYSTEM} of its own")
    finish_earlier(session, output_path)
    logs = [error_path, audit_path, *filter(None, (options.reject_table, options.doubled_keys))]
    for log_path in logs:
        if path_exists(session, log_path):
            raise FileExistsError(f"log folder {log_path} exists; nothing was written")
    further = [SOURCE_SYSTEM] if options.by_folder else []
    read = {i for i in columns_read(session, spec, further) if i < spec.arity}

    started = now()
    start_time = clock.stamp(started)
    version = clock.version(started) if rule else None
    if rule:
        data_path, data_target = output_path, done_marker(output_path, version)
    else:
        data_path = dated_path(output_path, started) if spec.dimensions else output_path
        data_target = data_path
    folders = [new_folder(session, "classified")]
    try:
        accepted, logged, counts = _check_lines(session, spec, raw_path, read, options, folders[0])
        fan_outs, doubled = _check_dimensions(session, spec, options, folders)
        with published(session, output_path, [data_target, *logs]) as written:
            integrated = integrate(session, accepted, spec, options.dimension_keys is None)
            if rule:
                opened, closed = write_version(
                    session, output_path, integrated, rule, version, start_time, spec.batch_id,
                    _one_system(options), written[0],
                )
                counts |= {"records_written": opened, "closed": closed}
            else:
                counts["records_written"] = _write_integrated(
                    session, integrated, spec, written[0], start_time, options, folders
                )
            end_time = clock.stamp(now())
            label = RunLabel(spec.batch_id, spec.activity_id, start_time)
            write_log(reject_lines(logged, label, *options.log_choice), written[1], options.log_files)
            record = run_record(
                session.range(0, 1, 1, 1).select(
                    *[F.lit(n).alias(name) for name, n in counts.items()]
                ),
                spec.batch_id,
                spec.activity_id,
                start_time,
                end_time,
                options.run_status,
            )
            write_small_log(run_record_line(record), written[2])
            if options.reject_table:
                table = reject_table(logged, label, is_logged(*options.log_choice), further)
                if _one_system(options) is not None:
                    table = table.withColumn(SOURCE_SYSTEM, F.lit(_one_system(options)))
                write_rejects(table, written[3])
            if options.doubled_keys:
                write_rejects(doubled, written[-1])
    finally:
        for folder in folders:
            delete_folder(session, folder)
    return LoadResult(
        data_path, error_path, audit_path, start_time, end_time, counts, version, fan_outs
    )


def _history_rule(spec: JobSpec, options: Options) -> HistoryRule | None:
    if not options.history:
        return None
    rule = HistoryRule.from_settings(spec.settings[SCD])
    return replace(rule, close_missing=options.close_missing)


def _one_system(options: Options) -> str | None:
    return options.systems if isinstance(options.systems, str) else None


def _check_lines(
    session: SparkSession,
    spec: JobSpec,
    raw_path: str | Sequence[str],
    read: Collection[int],
    options: Options,
    staged_path: str,
) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Accepted rows, rows for the log, and counts of all lines."""
    fit_scans(session, options.most_scan_tasks)
    paths = input_paths(raw_path)
    if options.keep or options.by_folder:
        lines = read_lines_with_origin(session, *paths)
        file = F.col(f"{ORIGIN}.file")
        if options.by_folder:
            lines = lines.withColumn(SOURCE_SYSTEM, source_system(session, options.systems, file))
    else:
        lines = read_lines(session, *paths)
    further = [SOURCE_SYSTEM] if options.by_folder else []
    carry = [*([ORIGIN] if options.keep else []), *further]
    classified = classify(split_fields(lines, spec.separator, carry), spec, carry)
    if options.stage:
        wanted = (F.col(STATUS) == OK) | is_logged(*options.log_choice)
        # The first field tells records apart, whether the statement reads it or not.
        held = {0, *read} if options.keep else read
        staged, counts = _stage_counted(
            classified,
            lambda rows: narrowed(rows.filter(wanted), held, carry),
            staged_path,
            options.log_choice,
        )
        accepted, logged = accepted_rows(staged, spec, held, carry), staged
    else:
        logged, counts = _stage_counted(
            pinned(classified),
            lambda rows: logged_rows(rows, *options.log_choice, further),
            staged_path,
            options.log_choice,
        )
        accepted = accepted_rows(pinned(classified), spec, None, carry)
    fit_shuffles(
        session,
        staged if options.stage else lines,
        options.shuffle_bytes,
        options.most_shuffle_partitions,
    )
    if options.keep:
        accepted = keep_one(accepted, spec.schema.names[0], options.keep)
    return accepted, logged, counts


def _check_dimensions(
    session: SparkSession, spec: JobSpec, options: Options, folders: list[str]
) -> tuple[tuple[FanOut, ...], DataFrame | None]:
    """Stage every dimension, register it for the statement, and count its doubled keys."""
    if options.dimension_keys is None:
        return (), None
    found, tables = [], []
    for dim in spec.dimensions:
        table = project_dimension(session, read_dimension(session, dim.path), dim.name, dim.select_list)
        keys = tuple(options.dimension_keys.get(dim.name) or table.columns[:1])
        staged, doubled = staged_dimension(session, table, dim.name, keys, folders)
        staged.createOrReplaceTempView(dim.name)
        found.append(fan_out(doubled, dim.name, keys))
        key = F.to_json(F.struct(*[F.col(f"`{k}`") for k in keys]))
        tables.append(
            doubled.select(
                F.lit(dim.name).alias("dimension"),
                key.alias("key"),
                F.col("rows").cast("string").alias("rows"),
            )
        )
    none = session.createDataFrame([], "dimension string, key string, rows string")
    return tuple(found), reduce(DataFrame.unionByName, tables, none)


def _stage_counted(
    classified: DataFrame,
    keep: Callable[[DataFrame], DataFrame],
    path: str,
    log_choice: tuple[bool, bool],
) -> tuple[DataFrame, dict[str, int]]:
    """Stage what ``keep`` leaves and count all lines in the same pass.

    Scan, checks and write are one stage, the job's last, whose observed counts are exact.
    """
    observation = Observation()
    observed = classified.observe(observation, *line_count_columns(*log_choice))
    return stage_table(keep(observed), path), observation.get


def _write_integrated(
    session: SparkSession,
    integrated: DataFrame,
    spec: JobSpec,
    data_path: str,
    load_time: str,
    options: Options,
    folders: list[str],
) -> int:
    """Write the stamped result and return its row count.

    The count is observed right below the writer. That is the job's last stage, where Spark
    counts each task's result once however often the task ran, so no second run is needed.
    """
    stamped = stamp(integrated, load_time, spec.batch_id, _one_system(options))
    if options.data_files is not None and is_ordered(integrated):
        folders.append(new_folder(session, "ordered"))
        filed = in_ordered_files(stamped, options.data_files, folders[-1])
    else:
        filed = sized(stamped, options.data_files)
    observation = Observation()
    write_data(filed.observe(observation, F.count("*").alias("rows")), data_path, spec.separator)
    return observation.get["rows"]


def run_fact_load(spark: SparkSession, *args, **kwargs) -> LoadResult:
    """Field-count and conversion checks only; no field is required."""
    return run_load(spark, FACT, *args, **kwargs)


def run_dimension_load(spark: SparkSession, *args, **kwargs) -> LoadResult:
    """Also drops lines with an empty required field."""
    return run_load(spark, DIMENSION, *args, **kwargs)
