"""Resampling towards a target, lexical search and personal data, against brute force."""

from __future__ import annotations

import math
import random
import re
import time
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import importance, lexical_search, personal_data
from millrace.llm.queries import (
    op11_importance_resampling,
    op12_lexical_search,
    op13_personal_data,
)

SF_DIR = "/root/testdata/sf0.001"
EMPTY = "doc_id long, text string"


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


@pytest.fixture(scope="module")
def items(spark):
    rows = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()
    return {r.item_id: r.text or "" for r in rows}


# Resampling


def words_of(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").encode().lower().decode())


def brute_resample(docs, target, longest_run, buckets, percent, least_words):
    """``docs``: (id, text) rows; results as sorted tuples."""

    def runs(text):
        words = words_of(text)
        every = [words[i : i + n] for n in range(1, longest_run + 1) for i in range(len(words) - n + 1)]
        return [zlib.crc32(" ".join(w).encode()) % buckets for w in every]

    held, wanted = Counter(), Counter()
    for _, text in docs:
        held.update(runs(text))
    for text in target:
        wanted.update(runs(text))
    s, t = held.total(), wanted.total()
    rows = []
    for i, text in docs:
        found = runs(text)
        weight = sum(
            math.floor(1000 * math.log((wanted[b] + 1) * (s + buckets) / ((held[b] + 1) * (t + buckets))))
            for b in found
        )
        h = int(sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, len(words_of(text)) >= least_words))
    order = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = order[: len(order) * percent // 100]
    out = [(*r[:4], n) for n, r in enumerate(drawn, 1)]
    left = Counter(rows) - Counter(drawn)
    return sorted(out + [(*r[:4], None) for r in left.elements()], key=str)


def test_resampling_on_the_table(spark, texts, items):
    got = sorted(map(tuple, op11_importance_resampling(spark, SF_DIR).collect()), key=str)
    assert got == brute_resample(list(texts.items()), items.values(), 1, 10_000, 10, 20)


@pytest.mark.parametrize("stretch", [7, 200_000])
def test_resampling_by_longer_runs(spark, texts, items, monkeypatch, stretch):
    """Texts cut into many stretches give the same windows; words are cut nowhere."""
    monkeypatch.setattr(importance, "STRETCH", stretch)
    monkeypatch.setattr(importance, "REMEMBERED", 50)
    split, known = importance._splitter(), importance._Buckets(64)
    for text in [*list(texts.values())[:20], "", "A-b ÀÉ c", "x" * 50, " a" * 30 + " "]:
        n, found = importance.text_buckets(text, known, split, 3)
        words = words_of(text)
        runs = [words[i : i + k] for k in (1, 2, 3) for i in range(len(words) - k + 1)]
        assert n == len(words)
        assert Counter(found.tolist()) == Counter(zlib.crc32(" ".join(r).encode()) % 64 for r in runs)


def test_offsets_name_the_words(monkeypatch):
    monkeypatch.setattr(importance, "STRETCH", 10)
    text = "Ünï-Code 梦x🙂y, THE end_of 12.5 " * 9
    found = [pair for part in importance.words_with_offsets(text) for pair in part]
    assert [w for w, _ in found] == words_of(text)
    assert all(text.encode().lower().decode()[a:b] == w for w, (a, b) in found)


def test_resampling_odd_rows(spark):
    """Nulls, ties, a repeated row that holds most rows, a long text, columns named like ours."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["É", "梦"]
    docs = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([0, 3, 25])))) for i in range(60)]
    docs += [(7, "same words here again")] * 120
    docs += [(None, None), (None, "w1 " * 30), (500, ""), (501, "W2-w3 " * 40_000)]
    target = ["w1 w2 w3", "w4", None, "\x00"]
    rows = [(i, t, -1, "x", True) for i, t in docs]
    named = "doc_id long, text string, score long, _id string, _row boolean"
    given = spark.createDataFrame(rows, named).repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(given, wanted, longest_run=2, buckets=97, percent=50, least_words=4)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_resample(docs, target, 2, 97, 50, 4)
    none = importance.resample(given.limit(0), wanted)
    assert none.count() == 0 and none.columns == got.columns
    free = importance.resample(given, wanted.limit(0), percent=100, least_words=0)
    assert sorted(r["rank"] for r in free.collect()) == list(range(1, len(docs) + 1))


# Search


def test_search_on_the_table(spark, texts, items):
    got = {}
    for r in op12_lexical_search(spark, SF_DIR).orderBy("item_id", "rank").collect():
        got.setdefault(r.item_id, []).append((r.doc_id, r.score))
        assert r["rank"] == len(got[r.item_id])
    want = lexical_search.brute_force(texts, items)
    assert got == {i: best for i, best in want.items() if best}


@pytest.mark.parametrize("coordinates", [1, 16, 2048])
def test_bounds_are_never_below_scores(texts, items, coordinates):
    """Whatever the sketch's size, the best are found; a larger sketch rescores fewer."""
    docs = pa.array(list(texts.values()))
    block = lexical_search._Block.of(list(items), list(items.values()))
    found = lexical_search._entries(docs)
    n_docs = int(np.count_nonzero(found.lengths))
    held = np.array([np.count_nonzero(found.term == t) for t in block.terms])
    searcher = lexical_search._Searcher(
        block, lexical_search.term_weights(n_docs, held), n_docs, int(found.lengths.sum()), 5, coordinates
    )
    ids = np.array(list(texts))
    for a in range(0, len(ids), 40):
        searcher.add(docs.slice(a, 40), ids[a : a + 40])
    want = lexical_search.brute_force(texts, items, 5)
    for item, (score, best) in zip(block.ids, searcher.tops, strict=True):
        assert list(zip(best.tolist(), score.tolist(), strict=True)) == want[item]
    pairs = len(ids) * len(items)
    assert searcher.rescored < pairs * (0.5 if coordinates == 2048 else 1.01)


@pytest.mark.parametrize("small", [False, True])
def test_search_odd_rows(spark, monkeypatch, small):
    """Ties, repeated documents and items, nulls, long texts, clashing names, several blocks."""
    if small:
        monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", 2)
        monkeypatch.setattr(lexical_search, "LOOKUPS", 3)
        monkeypatch.setattr(lexical_search, "MERGES", 1)
    docs = [(i, f"alpha beta {'gamma ' * (i % 3)}") for i in range(60)]
    docs += [(100, None), (101, ""), (102, " -- "), (103, "Delta " * 30_000), (104, "ÀB àb É_é")]
    docs += [(200, "alpha epsilon")] * 5 + [(None, "alpha epsilon")]
    items = [
        (1, "alpha ALPHA gamma"), (2, None), (3, ""), (4, "delta zeta"), (5, "àb É"), (6, "epsilon " * 9),
        (6, "epsilon " * 9), (None, "beta"), (7, " ".join(f"t{i}" for i in range(30_000))),
    ]
    given = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, _query string")
    asked = spark.createDataFrame([(i, t, 9) for i, t in items], "item_id long, text string, rank int")
    got = lexical_search.search(given.repartition(7), asked).collect()
    names = {n: (i is None, i) for n, (i, _) in enumerate(docs)}
    brute = lexical_search.brute_force({(*names[n], n): t for n, (_, t) in enumerate(docs)}, dict(enumerate(t for _, t in items)))
    want = Counter()
    for n, best in brute.items():
        for rank, (d, score) in enumerate(best, 1):
            want[items[n][0], rank, d[1], score] += 1
    assert Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == want
    assert lexical_search.search(given.limit(0), asked).count() == 0
    assert lexical_search.search(given, asked.limit(0)).count() == 0


# Personal data


def plain_luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def brute_base(text):
    """The base patterns as they are stated, with backtracking."""
    out = []
    for order, (kind, pattern) in enumerate(
        (
            ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
            ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"),
            ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
        )
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and plain_luhn(digits))
                or (kind == "phone" and 10 <= len(digits) <= 15)
            ):
                out.append((m.start(), order, kind, f"{kind}:{m.start()}:{m.end()}"))
    return sorted(out)


def test_personal_data_on_the_table(spark):
    for sf in (SF_DIR, "/root/testdata/sf0.01"):
        given = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
        given = {r.doc_id: r.text or "" for r in given}
        for r in op13_personal_data(spark, sf).collect():
            want = brute_base(given[r.doc_id])
            kinds = Counter(w[2] for w in want)
            assert [kinds[k] for k in personal_data.BASE] == [r.n_email, r.n_ip, r.n_card, r.n_phone]
            assert r.base_sha256 == sha256(",".join(w[3] for w in want).encode()).hexdigest()
            assert {w[3] for w in want} <= set(r.spans.split(","))


def test_base_patterns_on_random_strings():
    """Strings made of the patterns' own characters, so that runs touch and fail in every way."""
    rng = random.Random(11)
    for alphabet in ("a1.@", "a@.-+", "0129. ", "12 -", "+1 ().-", "é@a.1+ 2-", "0123456789 -"):
        for _ in range(3000):
            text = "".join(rng.choices(alphabet, k=rng.randrange(1, 60)))
            got = [f"{k}:{a}:{b}" for a, b, k in personal_data.base_spans(text)]
            assert got == [w[3] for w in brute_base(text)], text


def test_checksums():
    rng = random.Random(2)
    for _ in range(500):
        digits = "".join(rng.choices("0123456789", k=rng.randrange(1, 30)))
        assert personal_data.luhn(digits) == plain_luhn(digits)
    assert personal_data.mod_97("GB82WEST12345698765432") and personal_data.mod_97("DE89370400440532013000")
    assert not personal_data.mod_97("GB82WEST12345698765423")


@pytest.mark.parametrize(
    "text, want",
    [
        ("IBAN: DE89 3704 0044 0532 0130 00.", [("iban", "DE89 3704 0044 0532 0130 00")]),
        ("ship GB82WEST12345698765432 now", [("iban", "GB82WEST12345698765432")]),
        ("GB82WEST12345698765423 has a wrong sum", []),
        ("XX82WEST12345698765432 no such country", []),
        ("4111111111111111 4012888888881881", [("pan", "4111111111111111"), ("pan", "4012888888881881")]),
        ("my ssn is 123-45-6789 ok", [("ssn", "123-45-6789")]),
        ("part 123-45-6789 ok", []),
        ("ssn 000-45-6789, 666-45-6789, 123-00-6789, 1123-45-6789", []),
        ("call (212) 555-0187 today", [("tel", "(212) 555-0187")]),
        ("order 212-555-0187 shipped", []),
        ("amex card 378282246310005", [("card", "378282246310005")]),
        ("visa 4222222222222", [("pan", "4222222222222")]),
        ("call +1 (212) 555-0187 or a.b+c@d-e.org", [("phone", "+1 (212) 555-0187"), ("email", "a.b+c@d-e.org")]),
        ("", []),
        ("no data, 12 or 13.5", []),
    ],
)
def test_further_spans(text, want):
    text = f"é🙂 {text}"
    assert [(k, text[a:b]) for a, b, k, _ in personal_data.all_spans(text)] == want


def test_words_nearby_move_scores():
    def sure(text):
        return personal_data.all_spans(text)[0][3]

    assert sure("card 4111111111111111") > sure("item 4111111111111111")
    assert sure("server 10.0.0.1") > sure("about 10.0.0.1") > sure("version 10.0.0.1")
    assert sure("card " + "x" * 60 + " 4111111111111111") == sure("item 4111111111111111")


def brute_overlaps(text):
    """Further spans by comparing every proposal with every span."""
    base, chains = personal_data._proposed(text)
    kept = []
    for a, b, k in sorted(personal_data._further(text, chains), key=lambda s: (s[0], personal_data.KINDS.index(s[2]))):
        if all(y <= a or b <= x for x, y, *_ in [*base, *kept]):
            if personal_data.score(text, a, b, k) >= personal_data.LEAST_SCORE:
                kept.append((a, b, k))
    return sorted([*base, *kept], key=lambda s: (s[0], personal_data.KINDS.index(s[2])))


def test_spans_never_overlap_what_stays():
    rng = random.Random(8)
    parts = ["4111111111111111", "123-45-6789", "(212) 555-0187", "212-555-0187", "DE89370400440532013000",
             "+1 212 555 0187", "1.2.3.4", "a@b.cd", "ssn", "call", "card", "-", " ", ".", "é"]
    for _ in range(800):
        text = rng.choice(["", " "]).join(rng.choices(parts, k=rng.randrange(1, 14)))
        assert [s[:3] for s in personal_data.all_spans(text)] == brute_overlaps(text), text


@pytest.mark.parametrize(
    "text",
    ["a" * 1_000_000, "1" * 1_000_000, "1 " * 500_000, "+" + "1 " * 500_000, "a@" * 500_000, "1." * 500_000,
     "a@b." * 200_000, "call 212-555-0187 " * 30_000, "4111111111111111 " * 30_000, "AB12" * 200_000],
)
def test_long_texts_take_linear_time(text):
    start = time.process_time()
    personal_data.all_spans(text)
    assert time.process_time() - start < 8


def test_personal_data_odd_rows(spark):
    rows = [
        (1, None, "a"), (2, "", "b"), (3, "a@b.cd", "c"), (3, "a@b.cd", "c"), (None, "é 4111111111111111!", None),
        (5, "x 10.0.0.1 10.0.0.2 +12125550187 " * 3000, "e"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string").repartition(3)
    got = personal_data.find_personal(docs, docs.columns, redact=True)
    assert got.columns == ["doc_id", "text", "spans", "redacted"]
    clean = {r.doc_id: r for r in got.collect()}
    assert clean[1].redacted is None and clean[1].spans == [] and clean[2].redacted == ""
    assert clean[3].redacted == "[EMAIL]" and clean[None].redacted == "é [CARD]!"
    assert len(clean[5].spans) == 9000
    assert got.filter("doc_id = 3").count() == 2
    assert personal_data.find_personal(docs.limit(0), ["doc_id"]).count() == 0
    base = F.size(F.filter("spans", lambda s: s["kind"] == "email"))
    assert got.agg(F.sum(base)).first()[0] == 2
