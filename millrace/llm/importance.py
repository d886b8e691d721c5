"""Importance resampling towards a target distribution.

Texts are cut into words by an untrained pre-tokeniser; windows over its offset pairs are the
features, and the checksum of a feature's bytes is its bucket. Two histograms over all texts, the
corpus's and the target's, give every bucket a gain; a document weighs the sum of its gains, gets
Gumbel noise from its id, and the highest scores are drawn without replacement.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Broadcasted, array_pieces, forget, map_batches, staged, sum_arrays
from millrace.llm.words import slices

# What is a character of a word in lower-cased text, and the salt of the noise.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")
SALT = "2024"

LONGEST_RUN = 1
BUCKETS = 10_000
PERCENT = 10
LEAST_WORDS = 20

# A longer text is cut between words into stretches of about this many characters, since the
# pre-tokeniser returns a Python object for each word.
STRETCH = 200_000
# Buckets of features seen by a task are remembered for so many distinct ones.
REMEMBERED = 200_000
_PLACE_BITS = 33


def _splitter():
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), "removed", invert=True)


def ascii_lower(text: str) -> str:
    """A-Z become a-z; no other letter changes, and places stay."""
    return text.encode().lower().decode()


def words_with_offsets(text: str, split=None) -> Iterator[list[tuple[str, tuple[int, int]]]]:
    """The words of a text with their places in it, a bounded stretch of the text at a time."""
    split = split or _splitter()
    text, at = ascii_lower(text), 0
    while at < len(text):
        cut = BETWEEN.search(text, at + STRETCH) if len(text) - at > STRETCH else None
        to = cut.start() if cut else len(text)
        found = split.pre_tokenize_str(text[at:to])
        yield found if at == 0 else [(w, (a + at, b + at)) for w, (a, b) in found]
        at = to


class _Buckets(dict):
    """Feature to bucket; what was seen is kept, up to a bound."""

    def __init__(self, buckets: int):
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[feature] = crc32(feature.encode()) % self.buckets
        return found


def text_buckets(text: str, known: dict, split, longest_run: int) -> tuple[int, np.ndarray]:
    """The number of words, and the bucket of every run of 1 to ``longest_run`` words."""
    count, parts, tail = 0, [], []
    for found in words_with_offsets(text, split):
        count += len(found)
        words = [w for w, _ in found]
        parts.append(np.fromiter(map(known.__getitem__, words), np.int32, len(words)))
        if longest_run > 1:
            words = tail + words
            for width in range(2, longest_run + 1):
                # A window that ends before the new words was counted with the last stretch.
                first = range(max(0, len(tail) - width + 1), len(words) - width + 1)
                runs = (known[" ".join(words[i : i + width])] for i in first)
                parts.append(np.fromiter(runs, np.int32, len(first)))
            tail = words[-(longest_run - 1) :]
    return count, np.concatenate(parts) if parts else np.zeros(0, np.int32)


def features(
    docs: DataFrame, carry: list[str], longest_run: int = LONGEST_RUN, buckets: int = BUCKETS
) -> DataFrame:
    """``carry`` and, of each whole text, ``n_words`` and ``buckets`` (one entry per feature).

    Null and empty texts have no words. Rows are read one by one; repeated rows stay.
    """

    def work(batch):
        split, known = _splitter(), _Buckets(buckets)
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            counts, lists = [], []
            for text in texts.slice(a, b - a).to_pylist():
                n, found = text_buckets(text or "", known, split, longest_run)
                counts.append(n)
                lists.append(found)
            ends = pa.array(np.cumsum([0, *map(len, lists)]), pa.int32())
            yield {
                "_rows": slice(a, b),
                "n_words": counts,
                "buckets": pa.ListArray.from_arrays(ends, pa.array(np.concatenate(lists))),
            }

    rows = docs.select(
        *[F.col(f"`{c}`") for c in carry if c != "text"], F.col("text").cast("string").alias("text")
    )
    return map_batches(rows, work, "n_words long, buckets array<int>", carry)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """All entries of the lists, and where each list starts and ends among them."""
    ends = np.concatenate([[0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy())])
    return lists.flatten().to_numpy(), ends


def histogram(featured: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Features in each bucket over all rows; a task sends one array of ``buckets`` counts."""
    cells = -(-buckets // 64) * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(cells, np.int64)
        for batch in batches:
            sums += np.bincount(_flat(batch.column(0))[0], minlength=cells)
        made = array_pieces(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(made["piece"], pa.int32()), pa.array(made["data"], pa.binary())],
            names=["piece", "data"],
        )

    blobs = featured.select("buckets").mapInArrow(run, "piece int, data binary")
    summed = b"".join(sum_arrays(blobs)) or bytes(8 * cells)
    return np.frombuffer(summed, np.int64)[:buckets]


def bucket_gains(target: np.ndarray, source: np.ndarray) -> np.ndarray:
    """``floor(1000 ln)`` of each bucket's smoothed share in the target over that in the source."""
    held, wanted = int(source.sum()) + len(source), int(target.sum()) + len(target)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * held / ((s + 1) * wanted)))
            for t, s in zip(target.tolist(), source.tolist(), strict=True)
        ],
        np.int64,
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_column: str = "doc_id",
    longest_run: int = LONGEST_RUN,
    buckets: int = BUCKETS,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """Every row's id, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn).

    ``docs`` and ``target`` have a column ``text``; other columns, whatever their names, are not
    read. Null and empty texts have no features and weigh 0. A null id counts as the empty text in
    the noise and comes last among equal scores. Repeated rows are rows of their own: equal ones
    score alike and stand next to each other in the ranking. An empty ``docs`` gives no rows, an
    empty ``target`` a histogram of zeros. Very long texts are read in stretches.

    Texts are cut into words once: buckets are staged, and both the histogram and the weights come
    from the staged table. The ranking is one range exchange of narrow rows; ties carry the row's
    number as a last sort key, so that a group of equal rows is spread like any other.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(f"`{id_column}`").alias("_id"), "text")
    rows = features(named, ["_id"], longest_run, buckets)
    source = staged(rows.withColumn("_row", F.monotonically_increasing_id()), "features")
    gains = bucket_gains(
        histogram(features(target.select("text"), [], longest_run, buckets), buckets),
        histogram(source, buckets),
    )
    sent = Broadcasted(spark, gains)

    def work(batch):
        values, ends = _flat(batch.column(batch.schema.get_field_index("buckets")))
        sums = np.concatenate([[0], np.cumsum(sent.value[values])])
        weight = sums[ends[1:]] - sums[ends[:-1]]
        salts = batch.column(batch.schema.get_field_index("_salt")).to_pylist()
        noise = [math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))) for h in salts]
        yield {"n_features": np.diff(ends), "weight": weight, "score": weight + np.array(noise, np.int64)}

    salt = F.sha2(F.concat(F.lit(f"{SALT}:"), F.coalesce(F.col("_id").cast("string"), F.lit(""))), 256)
    salted = source.withColumn("_salt", F.conv(F.substring(salt, 1, 8), 16, 10).cast("long"))
    scored = map_batches(
        salted, work, "n_features long, weight long, score long", ["_id", "_row", "n_words"]
    )
    drawable = (F.col("n_words") >= least_words).alias("_drawable")
    ordered = scored.select("_id", "_row", "n_features", "weight", "score", drawable).orderBy(
        F.desc("_drawable"), F.desc("score"), F.col("_id").asc_nulls_last(), "_row"
    )
    placed = staged(ordered.withColumn("_at", F.monotonically_increasing_id()), "ranking")
    forget(source)
    return _ranked(placed, percent).withColumnRenamed("_id", id_column)


def _ranked(placed: DataFrame, percent: int) -> DataFrame:
    """Ranks from a sorted table whose ``_at`` holds each row's task and its place there.

    One row per sort task goes to the driver and back: as many as the session has shuffle
    partitions, whatever the table holds.
    """
    task = F.shiftright("_at", _PLACE_BITS)
    sizes = (
        placed.groupBy(task.alias("task"))
        .agg(F.count("*").alias("rows"), F.sum(F.col("_drawable").cast("long")).alias("drawable"))
        .orderBy("task")
        .collect()
    )
    before, offsets = 0, []
    for r in sizes:
        offsets.append((r.task, before))
        before += r.rows
    drawn = sum(r.drawable for r in sizes) * percent // 100
    starts = placed.sparkSession.createDataFrame(offsets, "_task long, _before long")
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1) + F.col("_before") + 1
    return placed.join(F.broadcast(starts), task == F.col("_task")).select(
        "_id",
        "n_features",
        "weight",
        "score",
        F.when(F.col("_drawable") & (place <= drawn), place).alias("rank"),
    )
