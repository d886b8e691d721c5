"""Raw delimited text."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import literal_pattern

FIELDS = "fields"
ORIGIN = "origin"


def input_paths(paths: str | Sequence[str]) -> list[str]:
    """The files, folders and globs of a comma-separated list, or of a sequence as it is.

    A comma inside the braces of a glob does not separate.
    """
    if not isinstance(paths, str):
        return list(paths)
    return [p.strip() for p in re.findall(r"(?:\{[^}]*\}|[^,])+", paths) if p.strip()]


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines of a file, folder or glob as one ``value`` column; CR, LF and CRLF end a line."""
    return spark.read.text(list(paths))


def read_lines_with_origin(spark: SparkSession, *paths: str) -> DataFrame:
    """Lines as ``value``, each with its ``origin``: file, first byte of its block, place in it.

    A block's lines are read in order by one task, which numbers them upwards, so origins sort as
    the lines stand in the files, however many tasks read them.
    """
    origin = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return spark.read.text(list(paths)).select("value", origin.alias(ORIGIN))


# A local file's path may be given with an empty host.
_EMPTY_HOST = r"^([^:/]+):///"


def one_form(path: str) -> str:
    """An escaped path with its scheme, without an empty host or a slash at its end."""
    return re.sub(_EMPTY_HOST, r"\1:/", path).rstrip("/")


def file_of(path: Column) -> Column:
    """``_metadata.file_path`` in the same form."""
    return F.regexp_replace(path, _EMPTY_HOST, "$1:/")


def input_roots(spark: SparkSession, *paths: str) -> list[tuple[str, bool]]:
    """The files and folders that hold the lines of ``paths``, globs resolved, in ``one_form``.

    A folder's own files are read, and those of folders named ``key=value`` below it; the flag
    tells that there are some. Those are listed too, so every file lies in a listed folder.
    """
    found: dict[str, bool] = {}
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = target.getFileSystem(spark._jsc.hadoopConfiguration())
        matches = list(system.globStatus(target) or [])
        if not matches:
            # Raises as a scan of it would.
            spark.read.text(path)
        while matches:
            match = matches.pop()
            below = system.listStatus(match.getPath()) if match.isDirectory() else []
            nested = [f for f in below if f.isDirectory() and "=" in f.getPath().getName()]
            found[one_form(match.getPath().toUri().toString())] = bool(nested)
            matches += nested
    return list(found.items())


def read_roots(spark: SparkSession, roots: dict[str, bool]) -> DataFrame:
    """``value, file`` of the folders and files of ``input_roots``, each file read once.

    There is one scan, whatever the number of folders.

    Folders with ``key=value`` folders below them need a scan of their own, which also passes files
    in other folders below them; a caller keeps those of its roots.
    """

    def inside(path: str, folders: set[str]) -> bool:
        while "/" in path:
            path = path.rpartition("/")[0]
            if path in folders:
                return True
        return False

    deep = {r for r, nested in roots.items() if nested}
    top = sorted(r for r in deep if not inside(r, deep))
    flat = sorted(r for r in roots if r not in deep and not inside(r, deep))
    # A file beside others of a folder that is read anyway.
    flat = [r for r in flat if r.rpartition("/")[0] not in flat or _is_folder(spark, r)]
    lines = [spark.read.text([_unescaped(spark, r) for r in flat])] if flat else []
    if top:
        below = spark.read.option("recursiveFileLookup", True)
        lines.append(below.text([_unescaped(spark, r) for r in top]))
    if not lines:
        raise ValueError("no folder is given")
    file = file_of(F.col("_metadata.file_path")).alias("file")
    return reduce(DataFrame.unionByName, [t.select("value", file) for t in lines])


def _path(spark: SparkSession, escaped: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(escaped))


def _unescaped(spark: SparkSession, escaped: str) -> str:
    """As a reader wants it, the signs of a glob escaped."""
    return re.sub(r"([{}\[\]*?\\])", r"\\\1", _path(spark, escaped).toString())


def _is_folder(spark: SparkSession, escaped: str) -> bool:
    path = _path(spark, escaped)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory()


def split_fields(lines: DataFrame, separator: str, carry: Sequence[str] = ()) -> DataFrame:
    """Each line as a ``fields`` array. Trailing empty fields stay; a blank line has one.

    Columns in ``carry`` go along as they are.

    The one-element ``explode`` changes nothing in the rows. It keeps later filters above the
    split: pushed through a plain projection, they would repeat the split once per field they
    mention, for every line.
    """
    parts = F.split("value", literal_pattern(separator), -1)
    return lines.select(F.explode(F.array(parts)).alias(FIELDS), *carry)


def join_fields(table: DataFrame, separator: str = "|") -> DataFrame:
    """The reverse: a table's columns as delimited lines, nulls as empty fields."""
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in table.columns]
    return table.select(F.concat_ws(separator, *texts).alias("value"))
