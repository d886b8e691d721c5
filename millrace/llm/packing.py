"""Packing by length buckets.

Texts become pieces of at most ``longest`` tokens. One exact histogram of piece lengths, over all
pieces, goes to the driver (at most ``longest`` rows); dynamic programming chooses the bucket
boundaries with the least padding; every bucket is then cut into batches of a token budget.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import map_batches, numbered, staged
from millrace.llm.words import slices, split_words

LONGEST = 2048
BUCKETS = 12
BUDGET = 65_536
BATCH_SLOTS = 256


def best_boundaries(counts: np.ndarray, buckets: int) -> list[int]:
    """Upper ends of at most ``buckets`` length ranges that make padding least.

    ``counts[n]`` pieces have n tokens. Each piece is padded to its range's upper end. Ties go to
    fewer ranges, then to smaller ends. No pieces give no ranges.
    """
    lengths = np.flatnonzero(counts)
    if not len(lengths):
        return []
    many = np.concatenate([[0.0], np.cumsum(counts[lengths].astype(np.float64))])
    m = len(lengths)
    # cost[j]: least padded tokens of the j shortest lengths; real tokens are the same throughout.
    cost = np.full(m + 1, np.inf)
    cost[0] = 0.0
    choice = []
    best = None
    for k in range(min(buckets, m)):
        now = np.full(m + 1, np.inf)
        came = np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            padded = cost[:j] + lengths[j - 1] * (many[j] - many[:j])
            came[j] = int(np.argmin(padded))
            now[j] = padded[came[j]]
        cost = now
        choice.append(came)
        if best is None or cost[m] < best[0]:
            best = (cost[m], k)
    ends, j = [], m
    for k in range(best[1], -1, -1):
        ends.append(int(lengths[j - 1]))
        j = int(choice[k][j])
    return ends[::-1]


def count_tokens(docs: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` and ``n_tokens``: the words of each whole text and one end (null: the end)."""

    def work(batch):
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            yield {"_rows": slice(a, b), "n_tokens": split_words(texts.slice(a, b - a)).counts + 1}

    return map_batches(docs.select(*dict.fromkeys([*carry, "text"])), work, "n_tokens long", carry)


def pack(
    lengths: DataFrame,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    budget: int = BUDGET,
) -> DataFrame:
    """Pieces of ``lengths (..., n_tokens)`` with their bucket, batch and place.

    Each row of n tokens becomes ``ceil(n / longest)`` pieces (none for null or less than 1);
    repeated rows are rows of their own. Adds ``piece``, ``first_token``, ``piece_tokens``,
    ``bucket`` (from 0), ``bucket_tokens`` (the padded length), ``batch`` (from 0 in a bucket) and
    ``batch_slot``. A batch holds at most ``budget // bucket_tokens`` pieces, and one at least.
    """
    own = ["piece", "first_token", "piece_tokens", "bucket", "bucket_tokens", "batch", "batch_slot"]
    spark = lengths.sparkSession
    carry = [c for c in lengths.columns if c not in own]
    n = F.col("n_tokens")
    pieces = (
        lengths.filter(n >= 1)
        .select(
            F.struct(*[F.col(f"`{c}`") for c in carry]).alias("_in"),
            n.cast("long").alias("_n"),
            F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / longest))).alias("piece"),
        )
        .withColumn("first_token", F.col("piece") * longest)
        .withColumn(
            "piece_tokens",
            F.least(F.lit(longest).cast("long"), F.col("_n") - F.col("first_token")),
        )
        .withColumn("_row", F.monotonically_increasing_id())
    )
    kept = staged(pieces, "pieces")
    counts = np.zeros(longest + 1, np.int64)
    for row in kept.groupBy("piece_tokens").count().collect():
        counts[row["piece_tokens"]] = row["count"]
    ends = best_boundaries(counts, buckets)
    upper = F.lit(ends or [longest])
    place = F.size(F.filter(upper, lambda e: e < F.col("piece_tokens")))
    bucketed = kept.withColumn("bucket", place).withColumn(
        "bucket_tokens", F.element_at(upper, F.col("bucket") + 1).cast("long")
    )
    numbers = numbered(bucketed, ["bucket"], max(BATCH_SLOTS, _partitions(spark)))
    room = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.col("bucket_tokens")))
    return numbers.select(
        *[F.col(f"_in.`{c}`").alias(c) for c in carry],
        "piece",
        "first_token",
        "piece_tokens",
        "bucket",
        "bucket_tokens",
        F.floor(F.col("_number") / room).alias("batch"),
        (F.col("_number") % room).alias("batch_slot"),
    )


def _partitions(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
