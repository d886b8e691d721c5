"""Job specs: ``section:=key:=value[:=extra]`` lines.

A spec is read as a table of lines and reduced with one grouping, the last value per key and
the place of its first line. The result is one row per setting, so it is small enough to
become a frozen ``JobSpec`` on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.convert import declared_schema
from millrace.functions.text import trimmed

# Fixed tokens of the spec format.
TOKEN_MARK = ":="
METADATA = "MetaData"
DATA = "Data"
QUERY = "Query"
FACT_JOIN = "FactJoin"
QUALITY = "DATAQUALITY"
NON_NULLABLE = "NonNullable"
ERROR_SCHEMA = "ERRORSCHEMA"
AUDIT_SCHEMA = "AUDITSCHEMA"
SCD = "SCD"
SEPARATOR_KEY = "Sep"
VIEW_KEY = "Temp_Table"
QUERY_KEY = "Main_Query"
BATCH_KEY = "BatchId"
ACTIVITY_KEY = "ActivityId"
PATH_KEY = "Path"

SECTIONS = (METADATA, DATA, QUERY, FACT_JOIN, QUALITY, ERROR_SCHEMA, AUDIT_SCHEMA, SCD)


@dataclass(frozen=True)
class Dimension:
    name: str
    path: str
    select_list: str


@dataclass(frozen=True)
class JobSpec:
    """Everything one load needs to know, checked."""

    columns: tuple[tuple[str, str], ...]
    separator: str
    view: str
    query: str
    batch_id: str
    activity_id: str
    dimensions: tuple[Dimension, ...] = ()
    required: tuple[int, ...] = ()
    settings: dict[str, dict[str, str]] = field(default_factory=dict, compare=False)

    def __post_init__(self) -> None:
        for position in self.required:
            if not 0 <= position < self.arity:
                raise ValueError(
                    f"{NON_NULLABLE} position {position} is outside the {self.arity} columns"
                )

    @property
    def arity(self) -> int:
        return len(self.columns)

    @property
    def schema(self) -> T.StructType:
        return declared_schema(list(self.columns))


def read_spec_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line_no, line)`` of a spec file or of a folder of them; ``line_no`` sorts."""
    pages = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), F.col("value")
    )
    lines = pages.select("file", F.posexplode(F.split("value", r"\r\n|\r|\n")))
    return lines.select(
        F.struct("file", F.col("pos").alias("line")).alias("line_no"),
        F.col("col").alias("line"),
    )


def _tokens(line: Column) -> Column:
    """Tokens of a line without the empty ones at its end."""
    return F.split(F.regexp_replace(line, f"(?:{TOKEN_MARK})+$", ""), TOKEN_MARK, -1)


def section_entries(
    lines: DataFrame,
    sections: tuple[str, ...],
    match: str = "exact",
) -> DataFrame:
    """One row per section and key of the chosen sections.

    ``value`` and ``extra`` (third and fourth token) come from the key's last line,
    ``first_line`` is where the key first stood, and ``bad_value`` / ``bad_extra`` name the
    first line of the key that lacks that token. ``match="contains"`` takes every line that
    holds the section name anywhere, so one line may serve several sections.
    """
    if match not in ("exact", "contains"):
        raise ValueError(f"unknown match mode {match!r}")
    tokens = _tokens(F.col("line"))
    if match == "exact":
        section = trimmed(F.get(tokens, F.lit(0)))
        picked = lines.withColumn("section", section).filter(
            F.col("section").isin(*sections)
        )
    else:
        names = F.array(*[F.lit(name) for name in sections])
        picked = lines.withColumn("section", F.explode(names)).filter(
            F.contains("line", "section")
        )
    parsed = picked.select(
        "section",
        "line_no",
        trimmed(F.get(tokens, F.lit(1))).alias("key"),
        trimmed(F.get(tokens, F.lit(2))).alias("value"),
        trimmed(F.get(tokens, F.lit(3))).alias("extra"),
    )
    return (
        parsed.groupBy("section", "key")
        .agg(
            F.min("line_no").alias("first_line"),
            F.max_by(F.struct("value", "extra"), "line_no").alias("last"),
            F.min(F.when(F.col("value").isNull(), F.col("line_no"))).alias("bad_value"),
            F.min(F.when(F.col("extra").isNull(), F.col("line_no"))).alias("bad_extra"),
        )
        .select(
            "section", "key", "first_line", "last.value", "last.extra", "bad_value", "bad_extra"
        )
    )


def lookup_setting(lines: DataFrame, name: str) -> DataFrame:
    """One row: the second token of the last line whose first token is ``name``.

    Case does not matter, nothing is trimmed, and no match gives empty text. ``bad_line`` names
    the first matching line without a second token.
    """
    tokens = _tokens(F.col("line"))
    hits = lines.filter(F.lower(F.get(tokens, F.lit(0))) == name.lower())
    value = F.get(tokens, F.lit(1))
    return hits.agg(
        F.coalesce(F.max_by(value, "line_no"), F.lit("")).alias("value"),
        F.min(F.when(value.isNull(), F.col("line_no"))).alias("bad_line"),
    )


# A separator that holds one of these would not come back from the written data.
UNWRITABLE = '"\r\n'


def read_setting(spark: SparkSession, path: str, name: str) -> str:
    row = lookup_setting(read_spec_lines(spark, path), name).first()
    if row.bad_line is not None:
        raise ValueError(f"spec line {row.bad_line.line + 1}: setting {name!r} has no value")
    return row.value


def load_spec(
    spark: SparkSession,
    path: str,
    match: str = "exact",
    use_required: bool = True,
    need_log_paths: bool = False,
) -> JobSpec:
    """Read and check a spec file in one Spark job.

    ``use_required=False`` leaves the required-field section unread; ``need_log_paths`` insists
    on the two log folder settings.
    """
    wanted = (*SECTIONS, NON_NULLABLE) if use_required else SECTIONS
    # A spec is a page of settings: one task reads it, without a shuffle.
    lines = read_spec_lines(spark, path).coalesce(1)
    rows = section_entries(lines, wanted, match).collect()
    rows.sort(key=lambda row: row.first_line)
    sections: dict[str, dict[str, str]] = {name: {} for name in wanted}
    extras: dict[str, str] = {}
    for row in rows:
        if row.bad_value is not None:
            raise ValueError(
                f"spec line {row.bad_value.line + 1}: section {row.section} "
                "needs a key and a value"
            )
        if row.section == FACT_JOIN:
            if row.bad_extra is not None:
                raise ValueError(
                    f"spec line {row.bad_extra.line + 1}: section {FACT_JOIN} "
                    "needs a path and a select list"
                )
            extras[row.key] = row.extra
        sections[row.section][row.key] = row.value

    def need(section: str, key: str) -> str:
        if key not in sections[section]:
            raise ValueError(f"spec has no {section}{TOKEN_MARK}{key}")
        return sections[section][key]

    if not sections[METADATA]:
        raise ValueError(f"spec has no {METADATA} columns")
    if need_log_paths:
        need(ERROR_SCHEMA, PATH_KEY)
        need(AUDIT_SCHEMA, PATH_KEY)
    separator = need(DATA, SEPARATOR_KEY)
    if not separator:
        raise ValueError(f"spec has an empty {DATA}{TOKEN_MARK}{SEPARATOR_KEY}")
    if any(c in separator for c in UNWRITABLE):
        raise ValueError(f"separator {separator!r}: the data writer needs its quote and line ends")
    positions = list(sections.get(NON_NULLABLE, {}).values())
    if not all(text.lstrip("+-").isdecimal() for text in positions):
        raise ValueError(f"{NON_NULLABLE} positions must be numbers: {positions}")
    return JobSpec(
        columns=tuple(sections[METADATA].items()),
        separator="\t" if separator == r"\t" else separator,
        view=need(QUERY, VIEW_KEY),
        query=need(QUERY, QUERY_KEY),
        batch_id=need(QUALITY, BATCH_KEY),
        activity_id=need(QUALITY, ACTIVITY_KEY),
        dimensions=tuple(
            Dimension(name, dim_path, extras[name])
            for name, dim_path in sections[FACT_JOIN].items()
        ),
        required=tuple(int(text) for text in positions),
        settings=sections,
    )
