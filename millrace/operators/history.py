"""History of changing records: a batch is merged into what is open.

An open record has no end and the active flag. When a batch brings other tracked values for its
key, it is closed with the load's time and the new values are opened beside it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.integrate import stamp

INACTIVE = "N"

UPDATED = "lets_ld_upd_dt"
UPDATED_BY = "lets_ld_upd_ bch_id"
ENDED = "lets_eff_end_dt"
FLAG = "lets_atv_flg"

CHANGE = "change"
KEPT, CLOSED, OPENED = "kept", "closed", "opened"


def _signature(columns: Sequence[str]) -> Column:
    """128 bits of the values. Nulls count: a hash skips them, so each is followed by its flag."""
    values = [v for c in columns for v in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return F.struct(*[F.xxhash64(F.lit(seed), *values).alias(f"h{seed}") for seed in (0, 1)])


def _same_keys(keys: Sequence[str], left: str, right: str) -> Column:
    match = F.lit(True)
    for k in keys:
        match = match & F.col(f"{left}.`{k}`").eqNullSafe(F.col(f"{right}.`{k}`"))
    return match


def one_per_key(batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """A key delivered more than once gives one row: the greatest by ``order``.

    Columns outside ``order`` decide ties, in their own order, so that the row does not depend on
    the partitions. Rows are combined before they move: a key that most rows share stays small.
    """
    rest = [c for c in batch.columns if c not in order and c not in keys]
    rank = F.struct(*[F.col(f"`{c}`") for c in [*order, *rest]]) if order or rest else F.lit(0)
    row = F.struct(*[F.col(f"`{c}`") for c in batch.columns])
    chosen = batch.groupBy(*[F.col(f"`{k}`").alias(f"_key{i}") for i, k in enumerate(keys)]).agg(
        F.max_by(row, rank).alias("_row")
    )
    return chosen.select(*[F.col(f"_row.`{c}`").alias(c) for c in batch.columns])


def merge_history(
    open_rows: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_time: str,
    batch_id: str,
    order: Sequence[str] = (),
    close_missing: bool = False,
) -> DataFrame:
    """Open rows after a batch, and the rows that it closes; ``change`` tells kept from new ones.

    ``open_rows`` has the batch's columns and the load stamps; all its rows are open. Keys are
    compared with null equal to null, and so are tracked values.

    * unchanged key: the open row stays as it is;
    * another tracked value: the row is closed (end, update time and batch, flag) and the batch's
      row is opened; columns that are neither key nor tracked come with it;
    * new key: opened;
    * key not in the batch: stays, or with ``close_missing`` is closed;
    * key delivered twice: one row counts, see ``one_per_key``;
    * several open rows of one key (an earlier fault): each is judged on its own, and nothing is
      opened if one of them has the batch's values.

    Only keys and hashes of the batch meet the open rows, once; the rows to open meet narrow
    keys and hashes. A hot key has one row in the batch, so no join fans out.
    """
    missing = [c for c in [*keys, *tracked] if c not in batch.columns]
    if missing or not keys:
        raise ValueError(f"history keys {list(keys)} and columns {list(tracked)}: no such {missing}")
    latest = one_per_key(batch, keys, order)
    return merge_latest(open_rows, latest, keys, tracked, load_time, batch_id, close_missing)


def merge_latest(
    open_rows: DataFrame,
    latest: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str],
    load_time: str,
    batch_id: str,
    close_missing: bool = False,
    system: str | None = None,
) -> DataFrame:
    """``merge_history`` with a batch that has one row for each key. It is read twice."""
    given = list(latest.columns)
    latest = latest.withColumn("_new", _signature(tracked))
    old = open_rows.withColumn("_old", _signature(tracked))
    names = [F.col(f"`{k}`") for k in keys]

    met = old.alias("o").join(
        latest.select(*names, "_new").alias("n"), _same_keys(keys, "o", "n"), "left"
    )
    gone = F.lit(close_missing) & F.col("n._new").isNull()
    closes = gone | (F.col("n._new").isNotNull() & (F.col("n._new") != F.col("o._old")))
    closing = {
        UPDATED: F.lit(load_time), UPDATED_BY: F.lit(batch_id), ENDED: F.lit(load_time), FLAG: F.lit(INACTIVE),
    }
    after = met.select(
        *[
            (F.when(closes, closing[c]).otherwise(F.col(f"o.`{c}`")) if c in closing else F.col(f"o.`{c}`")).alias(c)
            for c in open_rows.columns
        ],
        F.when(closes, CLOSED).otherwise(KEPT).alias(CHANGE),
    )
    have = old.select(*names, "_old")
    opened = latest.alias("n").join(
        have.alias("o"), _same_keys(keys, "n", "o") & (F.col("n._new") == F.col("o._old")), "left_anti"
    )
    opened = stamp(opened.select(*[F.col(f"`{c}`") for c in given]), load_time, batch_id, system)
    return after.unionByName(
        opened.select(*[F.col(f"`{c}`") for c in open_rows.columns], F.lit(OPENED).alias(CHANGE))
    )
