"""Sessions for loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# A spec's statement was written for SQL that mixes text and numbers and gives null for what it
# cannot compute, with the older date patterns.
STATEMENT_SETTINGS = {
    "spark.sql.ansi.enabled": "false",
    "spark.sql.legacy.timeParserPolicy": "LEGACY",
}


# Lets adaptive execution split a hot join key even where that adds a shuffle.
SKEW_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def job_session(spark: SparkSession) -> SparkSession:
    """A session of the same application with its own views and settings.

    It starts from the caller's settings, and nothing a load sets or registers leaks back.
    """
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if session.conf.isModifiable(key):
            session.conf.set(key, value)
    for key, value in STATEMENT_SETTINGS.items():
        session.conf.set(key, value)
    for key, value in SKEW_SETTINGS.items():
        if session.conf.get(key, None) is None:
            session.conf.set(key, value)
    return session


MOST_SCAN_TASKS = 100_000
MOST_SHUFFLE_PARTITIONS = 100_000
BYTES_PER_SHUFFLE_PARTITION = 256 * 1024**2

SCAN_TASKS = "spark.sql.files.maxPartitionNum"
FIRST_SHUFFLE_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def fit_scans(session: SparkSession, most_tasks: int = MOST_SCAN_TASKS) -> None:
    """Bound a load's scan tasks, where the caller left them open.

    A scan of 100 TB gets tasks of a gigabyte in place of 800,000 small ones, each of which would
    also leave a staged file.
    """
    if session.conf.get(SCAN_TASKS, None) is None:
        session.conf.set(SCAN_TASKS, str(most_tasks))


def fit_shuffles(
    session: SparkSession,
    table: DataFrame,
    bytes_per_partition: int = BYTES_PER_SHUFFLE_PARTITION,
    most: int = MOST_SHUFFLE_PARTITIONS,
) -> None:
    """Start shuffles with partitions by the size of ``table``, where the caller left that open.

    ``table`` is the staged one where there is one, so compressed raw text counts by what it holds.
    Adaptive execution merges what turns out small.
    """
    if session.conf.get(FIRST_SHUFFLE_PARTITIONS, None) is None:
        size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        wanted = min(size // bytes_per_partition, most)
        usual = int(session.conf.get("spark.sql.shuffle.partitions"))
        session.conf.set(FIRST_SHUFFLE_PARTITIONS, str(max(wanted, usual)))


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session for spark-submit and local runs; the cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = SKEW_SETTINGS | {
        # Records a call site per column expression, which doubles the time to build a plan.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in (defaults | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
