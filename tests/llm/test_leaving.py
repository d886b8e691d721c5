"""Documents that leave the n-gram join for want of partners."""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import ngram_join


def brute_shared(rows):
    """Distinct rows of lists of two documents or more, and of lists that are dealt out."""
    lists = defaultdict(dict)
    for token, part, tid, need in rows:
        lists[token, part][tid] = need
    return sorted(
        (token, part, tid, need, 1 if part >= 0 else min(own.values()))
        for (token, part), own in lists.items()
        if part >= 0 or len(own) > 1
        for tid, need in own.items()
    )


def brute_partners(rows):
    """Documents for which some k up to their need has k lists that ask for k or less."""
    least, need = defaultdict(list), {}
    for _, _, tid, own, low in rows:
        least[tid].append(low)
        need[tid] = own
    return {
        t for t, lows in least.items() if any(sum(x <= k for x in lows) >= k for k in range(1, need[t] + 1))
    }


@pytest.mark.parametrize("batch", ["3", "10000"])
def test_leaving_against_brute_force(spark, batch):
    rng = np.random.default_rng(4)
    needs = rng.integers(1, 4, 300).tolist()
    rows = []
    for tid in range(300):
        for token in rng.integers(0, 3000, 6).tolist():
            token = 7 if tid % 3 == 0 and token < 500 else token
            rows += [(token, tid % 3 if token == 7 else -1, tid, needs[tid])] * (1 + token % 2)
    given = spark.createDataFrame(rows, "token long, part int, tid long, need tinyint").repartition(3)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, batch)
    try:
        shared = ngram_join._shared_rows(given)
        found = sorted(map(tuple, shared.collect()))
        kept = {r.tid for r in ngram_join._with_partners(shared).collect()}
        assert ngram_join._shared_rows(given.limit(0)).count() == 0
    finally:
        spark.conf.set(key, usual)
    assert found == brute_shared(rows)
    assert kept == brute_partners(found)
    assert 0 < len(kept) < 300 and max(Counter(r[0] for r in found).values()) > 20


def test_a_longer_prefix_has_a_price():
    rule = ngram_join.PrefixRule(np.zeros(64, np.int32), 85)
    shingles = np.arange(1, 301, dtype=np.uint64)
    prefix, lists, need = rule.prefix(shingles)
    assert need == ngram_join.MOST_SHARED and len(prefix) == 300 - 255 + need and not lists.any()
    assert rule.prefix(shingles[:1])[2] == 1
