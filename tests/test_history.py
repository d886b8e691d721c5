"""Histories: what a batch does to open records, and versions of a history folder."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators.history import CHANGE, merge_history, one_per_key
from millrace.operators.integrate import stamp
from millrace.plans import history
from millrace.plans.history import HistoryRule, read_history, versions, write_version

BATCH = "k string, v string, n int"


def table(spark, rows, ddl=BATCH):
    return spark.createDataFrame(rows, ddl)


def opened(spark, rows, when="t1", batch="B1"):
    return stamp(table(spark, rows), when, batch)


def merged(spark, old, new, **choices):
    out = merge_history(opened(spark, old), table(spark, new), ["k"], ["v"], "t2", "B2", **choices)
    return sorted(
        ((r.k, r.v, r.n, r.lets_eff_strt_dt, r.lets_eff_end_dt, r.lets_ld_upd_dt, r["lets_ld_upd_ bch_id"],
          r.lets_ld_bch_id, r.lets_atv_flg, r[CHANGE]) for r in out.collect()),
        key=str,
    )


KEPT = ("t1", "", "", "", "B1", "Y", "kept")
CLOSED = ("t1", "t2", "t2", "B2", "B1", "N", "closed")
OPENED = ("t2", "", "", "", "B2", "Y", "opened")


@pytest.mark.parametrize(
    "old, new, want",
    [
        ([("a", "x", 1)], [("a", "x", 2)], [("a", "x", 1, *KEPT)]),
        ([("a", "x", 1)], [("a", "y", 2)], [("a", "x", 1, *CLOSED), ("a", "y", 2, *OPENED)]),
        ([("a", "x", 1)], [("b", "x", 2)], [("a", "x", 1, *KEPT), ("b", "x", 2, *OPENED)]),
        ([], [("a", None, None)], [("a", None, None, *OPENED)]),
        ([("a", None, 1)], [("a", None, 2)], [("a", None, 1, *KEPT)]),
        ([("a", None, 1)], [("a", "", 2)], [("a", None, 1, *CLOSED), ("a", "", 2, *OPENED)]),
        ([("a", "x", 1)], [("a", None, 2)], [("a", "x", 1, *CLOSED), ("a", None, 2, *OPENED)]),
        ([(None, "x", 1)], [(None, "x", 2)], [(None, "x", 1, *KEPT)]),
        ([(None, "x", 1)], [(None, "y", 2)], [(None, "x", 1, *CLOSED), (None, "y", 2, *OPENED)]),
        ([("a", "x", 1)], [], [("a", "x", 1, *KEPT)]),
        ([], [], []),
        # Delivered twice: the same, and with the greater of the other columns.
        ([("a", "x", 1)], [("a", "x", 2), ("a", "x", 2)], [("a", "x", 1, *KEPT)]),
        ([], [("a", "x", 2), ("a", "y", 1)], [("a", "y", 1, *OPENED)]),
        # Two open rows of a key: each is judged.
        ([("a", "x", 1), ("a", "y", 2)], [("a", "y", 3)], [("a", "x", 1, *CLOSED), ("a", "y", 2, *KEPT)]),
        (
            [("a", "x", 1), ("a", "y", 2)],
            [("a", "z", 3)],
            [("a", "x", 1, *CLOSED), ("a", "y", 2, *CLOSED), ("a", "z", 3, *OPENED)],
        ),
    ],
)
def test_merge(spark, old, new, want):
    assert merged(spark, old, new) == sorted(want, key=str)


def test_missing_keys_are_closed_on_request(spark):
    got = merged(spark, [("a", "x", 1), ("b", "x", 1)], [("b", "x", 1)], close_missing=True)
    assert got == sorted([("a", "x", 1, *CLOSED), ("b", "x", 1, *KEPT)], key=str)


def test_order_decides_between_deliveries(spark):
    batch = table(spark, [("a", "x", 9), ("a", "z", 1), ("a", "y", 9)])
    assert [tuple(r) for r in one_per_key(batch, ["k"], ["n"]).collect()] == [("a", "y", 9)]
    assert [tuple(r) for r in one_per_key(batch, ["k"]).collect()] == [("a", "z", 1)]


def test_nulls_in_other_columns_are_other_values(spark):
    """A hash that skips nulls would take (x, null) and (null, x) for the same."""
    ddl = "k int, v string, w string"
    old = stamp(table(spark, [(1, "x", None)], ddl), "t1", "B1")
    got = merge_history(old, table(spark, [(1, None, "x")], ddl), ["k"], ["v", "w"], "t2", "B2")
    assert got.groupBy(CHANGE).count().count() == 2


@pytest.mark.parametrize("partitions", [1, 9])
def test_hot_key_is_combined_before_rows_move(spark, partitions):
    rng = random.Random(1)
    rows = [("hot", f"v{rng.randrange(50)}", i) for i in range(6000)] + [(f"k{i}", "v", i) for i in range(3000)]
    rng.shuffle(rows)
    batch = table(spark, rows).repartition(partitions)
    latest = one_per_key(batch, ["k"], ["n"])
    assert latest.count() == 3001
    assert latest.filter("k = 'hot'").first().n == 5999
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_unknown_columns_are_named(spark):
    with pytest.raises(ValueError, match="nothere"):
        merge_history(opened(spark, []), table(spark, []), ["k"], ["nothere"], "t", "B")
    with pytest.raises(ValueError, match="JoinID"):
        HistoryRule.from_settings({"Columns": "a"})
    assert HistoryRule.from_settings({"JoinID": "a, b", "Columns": " c,"}) == HistoryRule(("a", "b"), ("c",))


def brute(old, new, when):
    """Open and closed rows (k, v, started, ended) after a batch, by plain dictionaries."""
    out = []
    for k, v, started, ended in old:
        changed = not ended and k in new and new[k] != v
        out.append((k, v, started, when if changed else ended))
    have = {(k, v) for k, v, _, ended in old if not ended}
    return out + [(k, v, when, "") for k, v in new.items() if (k, v) not in have]


def test_versions_against_brute_force(spark, home):
    rng = random.Random(5)
    path, want, seen = f"{home}/h", [], {}
    for n in range(1, 5):
        batch = {rng.randrange(30): rng.choice(["a", "b", None]) for _ in range(20)}
        want = seen[f"v{n}"] = brute(want, batch, f"t{n}")
        rows = table(spark, [(k, v) for k, v in batch.items()], "k int, v string")
        counts = write_version(spark, path, rows, HistoryRule(("k",)), f"v{n}", f"t{n}", "B")
        assert counts == (sum(r[2] == f"t{n}" for r in want), sum(r[3] == f"t{n}" for r in want))
    assert versions(spark, path) == ["v1", "v2", "v3", "v4"]
    for version, rows in seen.items():
        got = read_history(spark, path, version).select("k", "v", "lets_eff_strt_dt", "lets_eff_end_dt")
        assert sorted(map(tuple, got.collect()), key=str) == sorted(rows, key=str)
    assert read_history(spark, path).count() == len(want)
    with pytest.raises(ValueError, match="v9"):
        read_history(spark, path, "v9")


def test_closed_rows_are_not_written_again(spark, home):
    for n, v in enumerate("abc", 1):
        write_version(spark, home, table(spark, [(1, v)], "k int, v string"), HistoryRule(("k",)), f"v{n}", f"t{n}", "B")
    for n, closed in ((1, 0), (2, 1), (3, 1)):
        folder = f"{home}/load=v{n}/state=closed"
        assert (spark.read.parquet(folder).count() if os.path.exists(folder) else 0) == closed


def test_failed_version_is_not_seen_and_goes(spark, home, monkeypatch):
    rule = HistoryRule(("k",))
    write_version(spark, home, table(spark, [(1, "a")], "k int, v string"), rule, "v1", "t1", "B")
    with monkeypatch.context() as m:
        m.setattr(history, "create_file", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            write_version(spark, home, table(spark, [(1, "b")], "k int, v string"), rule, "v2", "t2", "B")
    assert os.path.exists(f"{home}/load=v2")
    assert [r.v for r in read_history(spark, home).collect()] == ["a"]
    write_version(spark, home, table(spark, [(1, "c")], "k int, v string"), rule, "v3", "t3", "B")
    assert not os.path.exists(f"{home}/load=v2")
    assert sorted(r.v for r in read_history(spark, home).collect()) == ["a", "c"]


def test_versions_go_upwards_and_keep_their_columns(spark, home):
    rows = table(spark, [(1, "a")], "k int, v string")
    write_version(spark, home, rows, HistoryRule(("k",)), "v2", "t", "B")
    with pytest.raises(ValueError, match="v2"):
        write_version(spark, home, rows, HistoryRule(("k",)), "v1", "t", "B")
    with pytest.raises(ValueError, match="columns"):
        write_version(spark, home, rows.withColumn("x", F.lit(1)), HistoryRule(("k",)), "v3", "t", "B")
    with pytest.raises(ValueError, match="no version"):
        read_history(spark, f"{home}/none")
    empty = rows.limit(0)
    assert write_version(spark, home, empty, HistoryRule(("k",), close_missing=True), "v4", "t4", "B") == (0, 1)
    assert read_history(spark, home).count() == 1
    assert write_version(spark, home, empty, HistoryRule(("k",)), "v5", "t5", "B") == (0, 0)
    assert read_history(spark, home).count() == 1
