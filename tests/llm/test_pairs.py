"""Operators on pairs and repeats, against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import graph_search, ngram_join, substring_dedup, vector_dedup
from millrace.llm.queries import op3_lz_substrings, op4_graph_search, op6_ngram_join, op9_vector_dedup

SF_DIR = "/root/testdata/sf0.001"


def least(ids, links):
    """The smallest id that each id reaches."""
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def jaccard_links(texts, width, percent):
    sets = {i: shingles(t, width) for i, t in texts.items()}
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            union = len(sets[i]) + len(sets[j]) - both
            if union and 100 * both >= percent * union and sets[i] and sets[j]:
                yield i, j


def variants(seed, count):
    """Near and exact copies of a few texts, with ties around the threshold."""
    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(900)}" for _ in range(rng.choice([3, 12, 60]))] for _ in range(8)]
    texts = {}
    for i in range(count):
        words = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(50)}"
        texts[i] = " ".join(words)
    return texts


def test_jaccard_components_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = least(texts, jaccard_links(texts, 4, 85))
    got = op6_ngram_join(spark, SF_DIR).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(shingles(texts[r.doc_id], 4)) for r in got)


@pytest.mark.parametrize("small", [False, True])
def test_jaccard_components_of_hot_groups(spark, monkeypatch, small):
    """Small blocks cut the groups and long lists; results stay."""
    if small:
        monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 8)
        monkeypatch.setattr(ngram_join, "PREFIX_BLOCK_DOCS", 16)
        monkeypatch.setattr(ngram_join, "LIST_ROWS", 3)
    texts = variants(3, 160)
    want = least(texts, jaccard_links(texts, 4, 85))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = ngram_join.jaccard_components(docs, ["doc_id"]).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert sum(r.kept for r in got) == len(set(want.values()))


def test_jaccard_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30_000))
    rows = [
        (1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, "one two", "d"), (4, "one two", "d"),
        (None, "One\tTWO", "e"), (6, long, "f"), (5, long + " end", "g"), (None, None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    got = ngram_join.jaccard_components(docs, docs.columns).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id))
    assert by[1] == {(0, 1)} and by[2] == {(0, 2)} and by[3] == {(0, 3)}
    assert by[4] == {(1, 4)} and by[None] == {(1, 4), (0, None)}
    assert by[6] == {(29_997, 5)} and by[5] == {(29_998, 5)}
    assert sum(r.kept for r in got if r.n_shingles == 1) == 1
    assert ngram_join.jaccard_components(docs.limit(0), ["doc_id"]).count() == 0


def brute_cut(texts, window):
    words = {k: (t or "").encode().split() for k, t in texts.items()}
    seen = Counter(
        tuple(w[i : i + window]) for w in words.values() for i in range(len(w) - window + 1)
    )
    out = {}
    for k, w in words.items():
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[k] = (len(w), int(gone.sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_substrings_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = brute_cut({r.doc_id: r.text for r in docs.collect()}, 35)
    got = op3_lz_substrings(spark, SF_DIR).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


def brute_matches(phrases):
    """The longest match of each place, within its phrase, with any other place."""
    places = [(i, k) for i, p in enumerate(phrases) for k in range(len(p))]

    def shared(a, b):
        x, y = phrases[a[0]][a[1] :], phrases[b[0]][b[1] :]
        return next((n for n, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))

    return [max((shared(a, b) for b in places if b != a), default=0) for a in places]


@pytest.mark.parametrize("seed", range(6))
def test_longest_matches_and_parse(seed):
    rng = random.Random(seed)
    window = rng.choice([2, 4, 5])
    phrases = [[rng.randrange(1, 4) for _ in range(rng.randint(1, 14))] for _ in range(seed * 3)]
    phrases += [p[rng.randrange(len(p)) :] for p in phrases[:4]]
    lengths = np.array([len(p) for p in phrases], np.int64)
    flat = np.array([w for p in phrases for w in p], np.uint64)
    match = substring_dedup.longest_matches(flat, lengths)
    assert match.tolist() == brute_matches(phrases)
    want, begin = set(), 0
    for i, p in enumerate(phrases):
        for k in range(len(p) - window + 1):
            if match[begin + k] >= window:
                want |= {(i, k + j) for j in range(int(match[begin + k]))}
        begin += len(p)
    found = zip(*substring_dedup.parse(match, lengths, window))
    spans = [(int(i), int(a), int(b)) for i, a, b in found]
    assert all(b - a >= window for _, a, b in spans)
    assert {(i, k) for i, a, b in spans for k in range(a, b)} == want


def test_a_factor_end_inside_a_longer_match():
    # 1..6 occurs, then 3..9: the window behind the first factor belongs to a longer match.
    phrases = [[1, 2, 3, 4, 5, 6, 7, 8, 9], [1, 2, 3, 4, 5, 6, 0], [3, 4, 5, 6, 7, 8, 9]]
    lengths = np.array([len(p) for p in phrases])
    flat = np.array([w for p in phrases for w in p], np.uint64)
    match = substring_dedup.longest_matches(flat, lengths)
    phrase, first, end = substring_dedup.parse(match, lengths, 4)
    own = {(a, b) for i, a, b in zip(phrase.tolist(), first.tolist(), end.tolist()) if i == 0}
    assert (0, 6) in own and any(b == 9 for _, b in own)


@pytest.mark.parametrize("window, anchor, block", [(35, 8, 4000), (6, 3, 4000), (35, 8, 3), (6, 3, 2)])
def test_substrings_of_periodic_and_spliced_texts(spark, window, anchor, block):
    rng = random.Random(window)
    passages = [" ".join(f"p{rng.randrange(60)}" for _ in range(window + k)) for k in (0, 1, 9, -1)]
    texts = {0: "a b " * 40, 1: "b a " * 33, 2: None, 3: "", 4: "a b " * window}
    for i in range(5, 80):
        parts = [rng.choice(passages) if rng.random() < 0.4 else f"u{i}x{k}" for k in range(9)]
        texts[i] = "\t".join(parts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    got = substring_dedup.remove_repeats(
        docs, ["doc_id"], window, anchor, block_phrases=block
    ).collect()
    have = {
        r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest())
        for r in got
    }
    assert have == brute_cut(texts, window)
    assert all(sum(s["words"] for s in r.removed) == r.n_removed for r in got)


def test_substrings_odd_rows(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(None, text, "x"), (None, text, "x"), (7, "short é", None), (8, None, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    got = substring_dedup.remove_repeats(docs, docs.columns).collect()
    assert sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in got) == [
        (0, 40, 40), (0, 40, 40), (7, 2, 0), (8, 0, 0),
    ]
    assert substring_dedup.remove_repeats(docs.limit(0), ["doc_id"]).count() == 0


def vector_rows(count, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, 12))
    rows = []
    for i in range(count):
        v = centres[i % 6] + rng.standard_normal(12) * rng.choice([0.0, 0.05, 0.2, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("block", [4096, 10])
def test_vector_links(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(vector_dedup, "TILE", 7)
    rows = vector_rows(150)
    x = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    pairs = [
        (i, j) for i, _, a in rows for j, _, b in rows if i < j and a == b and x[i] @ x[j] >= 0.98
    ]
    many = Counter(i for p in pairs for i in p)
    want = least(list(x), pairs)
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_dedup.near_duplicates(vectors, ["vec_id"]).collect()
    assert {r.vec_id: r.component_id for r in got} == want
    assert {r.vec_id: r.n_links for r in got} == {i: many[i] for i in x}


def test_vector_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None),
        (4, None, 1), (5, [], 1), (6, [0.0, 0.0], 1), (7, [nan, 1.0], 1), (8, [inf, 1.0], 1),
        (9, [1.0, None], 1), (10, [1.0, 0.0, 0.0], 1), (None, [2.0, 0.0], 1), (11, [1e-200, 0.0], 1),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_dedup.near_duplicates(vectors, ["vec_id"]).collect()
    assert len(got) == len(rows)
    linked = {r.vec_id: (r.n_links, r.component_id) for r in got if r.n_links}
    assert linked == {1: (4, 1), 2: (4, 1), None: (4, 1), 11: (4, 1)}
    assert all(r.component_id == r.vec_id and r.kept for r in got if not r.n_links)
    assert vector_dedup.near_duplicates(vectors.limit(0), ["vec_id"]).count() == 0


def test_vector_query_runs(spark):
    assert op9_vector_dedup(spark, SF_DIR).count() == 500


def recall(spark, vectors, got, every):
    rows = [r for r in vectors.collect()]
    ids = np.array([r.vec_id for r in rows])
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    hits = total = 0
    for q in np.flatnonzero(ids % every == 0):
        score = x @ x[q]
        score[q] = -2
        best = np.lexsort((ids, -score))[:5]
        mine = found[ids[q]]
        assert sorted(mine) == [1, 2, 3, 4, 5]
        place = {v: i for i, v in enumerate(ids.tolist())}
        assert all(abs(score[place[v]] - s) < 1e-12 for v, s in mine.values())
        hits += len({v for v, _ in mine.values()} & set(ids[best].tolist()))
        total += 5
    return hits / total


def test_graph_recall(spark, monkeypatch):
    monkeypatch.setattr(graph_search, "SHARD_ROWS", 300)
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = op4_graph_search(spark, "/root/testdata/sf0.1").collect()
    assert recall(spark, vectors, got, 50) >= 0.9


def test_graph_odd_rows(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(9)] + [
        (20, None, 0), (21, [0.0, 0.0], 0), (22, [1.0, None], 0), (23, [0.0, 1.0], 0), (24, [1.0], 0),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    found = graph_search.nearest(vectors, F.col("vec_id").isin(0, 8, 20, 21, 23, 24)).collect()
    by = {}
    for r in sorted(found, key=lambda r: r["rank"]):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by == {0: [1, 2, 3, 4, 5], 8: [0, 1, 2, 3, 4], 23: [0, 1, 2, 3, 4]}
    assert graph_search.nearest(vectors.limit(0), F.lit(True)).count() == 0


def test_graph_ties_go_to_the_smallest_ids(spark):
    """Scaled copies have equal cosines with every query, however many there are."""
    rows = [(i, [float(i + 1), 0.0]) for i in range(60)]
    got = graph_search.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 50)
    assert [(r.vec_id, r.score) for r in got.orderBy("rank").collect()] == [(i, 1.0) for i in range(5)]


def test_graph_ranks_scaled_copies_as_brute_force(spark):
    rng = np.random.default_rng(6)
    bases = rng.standard_normal((7, 5)).astype(np.float32).astype(float)
    # Mirrored directions tie with a query on the axis between them.
    bases = np.concatenate([bases, bases[:3] * [1, -1, -1, -1, -1], [[1, 0, 0, 0, 0]]])
    rows = [(int(i), (bases[i % len(bases)] * rng.choice([0.1, 1, 3, 7e5, 1e-7])).tolist()) for i in rng.permutation(330)]
    rows += [(5, (bases[10] * 9).tolist()), (None, (bases[2] * 2).tolist())]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    got = {}
    for r in graph_search.nearest(table, F.col("vec_id") % 10 == 0).orderBy("rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 9)))
    x = np.array([v for _, v in rows])
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    for q, (query, _) in enumerate(rows):
        if query is not None and query % 10 == 0:
            near = sorted(
                (-round(float(x[q] @ x[j]), 9), i is None, i) for j, (i, _) in enumerate(rows) if j != q
            )[:5]
            assert got[query] == [(i, -s) for s, _, i in near]
