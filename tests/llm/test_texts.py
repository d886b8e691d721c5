"""Operators on single texts, packing, sharding and the pipeline."""

from __future__ import annotations

import math
import re
import subprocess
import sys
import time
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import (
    lm_scoring,
    packing,
    piece_sampling,
    secret_scan,
    sharding,
    toxicity,
)
from millrace.llm.queries import (
    op1_lm_scoring,
    op2_piece_sampling,
    op5_length_buckets,
    op7_secret_scan,
    op8_toxicity,
    op10_histogram_sort,
)
from millrace.llm.words import rolling, split_words

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    (1, None, "a"), (2, "", "b"), (3, " \x1c\x85 ", "c"), (4, "same text", "d"), (4, "same text", "d"),
    (None, "Ünïcode 梦 🙂 text", None), (6, "long " * 40_000, "e"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, score string").repartition(2)


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {r.doc_id: r.text or "" for r in rows}


def test_words_are_those_of_bytes():
    given = ["a  b\tc", "", None, " lead", "tail ", "x", "é y\x1cz \x85", "A\x0bB\x0cC"]
    words = split_words(pa.array(given).slice(0), lower=True)
    for i, text in enumerate(given):
        mine = [words.word(k) for k in range(words.first[i], words.first[i + 1])]
        assert mine == (text or "").encode().lower().split()
    again = split_words(pa.array(["zz b", "c b"]))
    assert again.hashes()[1] == again.hashes()[3] == words.hashes()[1]
    assert rolling(again.hashes(), 1)[1] == rolling(again.hashes(), 1)[3]


def test_lm_scores(spark, texts):
    got = {r.doc_id: r for r in op1_lm_scoring(spark, SF_DIR).collect()}
    tokens = {i: t.encode().lower().split() + [None] for i, t in texts.items()}
    out = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, ws in tokens.items() if not out[i] for w in ws)
    total, room = counts.total(), math.log10(counts.total() + 0.5 * (len(counts) + 1))
    for i, words in tokens.items():
        base = sum(math.log10(counts[w] + 0.5) - room for w in words)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (out[i], len(words), total)
        assert r.n_known == sum(w in counts for w in words)
        assert r.base_score == pytest.approx(base, rel=1e-9)


def test_lm_beats_the_counts_on_held_out_texts(spark):
    held = op1_lm_scoring(spark, "/root/testdata/sf0.1").filter("held_out")
    sums = held.agg(F.sum("score").alias("model"), F.sum("base_score").alias("base")).first()
    assert sums.model > 0.95 * sums.base


@pytest.mark.parametrize("wide", [0.3, 20.0])
def test_lm_gradient_is_that_of_the_loss(wide):
    """Ragged lanes, texts that start inside a window, and weights too large for a bare exp."""
    rng = np.random.default_rng(2)
    p = {k: (0.3 * rng.standard_normal(s)).astype(np.float32) for k, s in lm_scoring.Network.SHAPE.items()}
    p["to_class"] *= wide
    p["to_word"] *= wide
    net = lm_scoring.Network(p)
    assert lm_scoring._is_calm(p["to_class"], p["class_bias"]) == (wide < 1)
    texts = [rng.integers(0, lm_scoring.VOCABULARY + lm_scoring.SHAPES, n).astype(np.int16) for n in (9, 30, 4, 17)]
    grid, valid = lm_scoring._grid(sorted(texts, key=len, reverse=True))
    fresh = np.zeros(grid.shape, bool)
    fresh[0], fresh[5, 1] = True, True
    state = np.zeros((4, lm_scoring.HIDDEN), np.float32)
    g, _, n = net.gradient(grid, valid, fresh, state)
    assert n == 60 and not valid.all()

    def loss():
        before, _, _ = net.window(grid, state, fresh)
        return -net.log_probability(before[valid], grid[valid].astype(np.int64)).astype(float).sum()

    for k, slope in g.items():
        at = np.unravel_index(np.argsort(-np.abs(slope), axis=None)[:3], slope.shape)
        for place in zip(*at, strict=True):
            old, sides = p[k][place], []
            for move in (1e-3, -1e-3):
                p[k][place] = old + np.float32(move)
                sides.append(loss())
            p[k][place] = old
            assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(slope[place], rel=0.05, abs=0.05)


def test_workers_do_not_fetch_freed_memory_anew():
    """Temporaries of megabytes take the pages that earlier ones left."""
    code = """if True:
        import resource, sys
        import numpy as np
        from millrace.llm.shared import keep_freed
        keep_freed()
        def faults():
            for _ in range(20):
                held = [np.ones(700_000) for _ in range(5)]
                del held
            return resource.getrusage(resource.RUSAGE_SELF).ru_minflt
        before = faults()
        print(faults() - before)
    """
    found = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, check=True)
    # 20 rounds of 28 MB are 137,000 pages.
    assert int(found.stdout) < 20_000


def test_lm_is_a_distribution_and_state_is_carried():
    class Counts:
        frequent = np.arange(lm_scoring.VOCABULARY, 0, -1.0)
        shape_total = np.ones(lm_scoring.SHAPES)

    net = lm_scoring.Network.initial(Counts)
    state = np.random.default_rng(0).standard_normal((1, lm_scoring.HIDDEN)).astype(np.float32)
    ids = np.arange(lm_scoring.VOCABULARY + lm_scoring.SHAPES)
    logs = net.log_probability(np.repeat(state, len(ids), 0), ids)
    assert np.exp(logs.astype(float)).sum() == pytest.approx(1, abs=1e-4)
    text = np.random.default_rng(1).integers(0, 1000, 100).astype(np.int16)
    one = lm_scoring.score_batch(net, [text])[0]
    both = lm_scoring.score_batch(net, [text[:40], text, text[:1]])
    assert both[1] == pytest.approx(one, rel=1e-5)
    before, _, _ = net.window(text[:, None], np.zeros((1, lm_scoring.HIDDEN), np.float32))
    whole = net.log_probability(before[:, 0], text.astype(np.int64)).sum()
    assert one == pytest.approx(whole, rel=1e-5)


def test_lm_gradient_is_the_slope():
    class Counts:
        frequent = np.ones(lm_scoring.VOCABULARY)
        shape_total = np.ones(lm_scoring.SHAPES)

    net = lm_scoring.Network.initial(Counts)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 1056, (6, 3))
    valid = np.arange(6)[:, None] < np.array([6, 5, 2])
    fresh = np.zeros((6, 3), bool)
    fresh[0] = fresh[3, 0] = fresh[2, 1] = True
    zero = np.zeros((3, lm_scoring.HIDDEN))

    def loss():
        before, _, _ = net.window(ids, zero, fresh)
        return -net.log_probability(before[valid].astype(float), ids[valid]).sum()

    slopes, _, _ = net.gradient(ids, valid, fresh, zero)
    for name, place in (("again", (3, 40)), ("embed", (int(ids[0, 0]), 30)), ("to_class", (2, 5))):
        step = 1e-3
        net.p[name][place] += step
        up = loss()
        net.p[name][place] -= 2 * step
        slope = (up - loss()) / (2 * step)
        net.p[name][place] += step
        assert slopes[name][place] == pytest.approx(slope, rel=0.02, abs=2e-3)


def test_lm_lanes_hold_every_token_once(monkeypatch):
    monkeypatch.setattr(lm_scoring, "STRETCH", 50)
    rng = np.random.default_rng(4)
    texts = [rng.integers(0, 1000, n).astype(np.int16) for n in [1, 1, 3, 170, 50, 51, 9] * 9]
    grid, valid, fresh = lm_scoring._streams(texts)
    assert grid.shape[1] == 16 and not (fresh & ~valid).any()
    assert (np.diff(valid.sum(0)) <= 0).all() and valid.sum() == sum(map(len, texts))
    lanes = [grid[: valid[:, i].sum(), i] for i in range(grid.shape[1])]
    found = [
        part.tobytes()
        for i, lane in enumerate(lanes)
        for part in np.split(lane, np.flatnonzero(fresh[:, i])[1:])
    ]
    want = [x[k : k + 50].tobytes() for x in texts for k in range(0, len(x), 50)]
    assert Counter(found) == Counter(want)


def test_lm_trains_on_every_training_document(spark, monkeypatch, home):
    train = lm_scoring.train_on

    def spy(network, texts):
        seen = train(network, texts)
        with open(f"{home}/seen", "a") as out:
            out.write(f"{len(texts)} {seen}\n")
        return seen

    # Tasks take the spy along with the function that they run.
    monkeypatch.setattr(lm_scoring, "train_on", spy)
    docs = [(i, "one copied text" if i % 3 else f"own text {i}") for i in range(90)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    assert lm_scoring.score(table, ["doc_id"], F.col("doc_id") >= 60).count() == 90
    with open(f"{home}/seen") as lines:
        seen = [tuple(map(int, line.split())) for line in lines]
    assert (sum(n for n, _ in seen), sum(n for _, n in seen)) == (60, 240)


def test_lm_odd_rows(spark, odd):
    got = lm_scoring.score(odd, odd.columns, F.col("doc_id") == 4).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 2, 3, 3, 5, 40_001]
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    none = lm_scoring.score(odd, ["doc_id"], F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 for r in none)
    assert lm_scoring.score(odd.limit(0), ["doc_id"], F.lit(False)).count() == 0


def _lexicon(words):
    known = lm_scoring.Lexicon.__new__(lm_scoring.Lexicon)
    known.words = np.sort(np.array(words, np.uint64))
    known.counts = np.arange(len(words), dtype=np.float64)
    return known


@pytest.mark.parametrize("ends", [[], [0], [2**64 - 1], [0, 1, 2, 2**64 - 1]])
@pytest.mark.parametrize("many", [0, 1, 3000])
def test_lm_words_are_found(ends, many):
    own = np.random.default_rng(5).integers(0, 2**64, many, dtype=np.uint64)
    known = _lexicon(sorted({*own.tolist(), *ends}))
    near = np.concatenate([known.words, known.words + np.uint64(1), known.words - np.uint64(1)])
    asked = np.concatenate([near, np.array([0, 1, 3, 2**63, 2**64 - 2, 2**64 - 1], np.uint64)])
    at, there = known.find(asked)
    among = set(known.words.tolist())
    assert there.tolist() == [x in among for x in asked.tolist()]
    assert (known.words[at[there]] == asked[there]).all()


def test_lm_lookup_does_not_search():
    """A word is found from its first bits, at a fraction of a binary search's cost."""
    rng = np.random.default_rng(6)
    known = _lexicon(rng.integers(0, 2**64, 500_000, dtype=np.uint64))
    asked = rng.choice(known.words, 1_000_000)
    known.find(asked[:1])

    def seconds(work):
        best = math.inf
        for _ in range(3):
            began = time.process_time()
            work()
            best = min(best, time.process_time() - began)
        return best

    assert seconds(lambda: known.find(asked)) < 0.6 * seconds(lambda: np.searchsorted(known.words, asked))


def test_lm_shapes_are_those_of_spelling():
    given = [*("x" * n for n in (1, 4, 5, 8, 9, 13, 14, 99)), "9", "a.", "b,", "(", "é", "né1", "梦."]
    found = lm_scoring.word_shapes(split_words(pa.array([" ".join(given)])))
    for word, shape in zip((w.encode() for w in given), found, strict=True):
        last = word[-1:]
        kind = 3 if last.isdigit() else 1 if last in b".," else 0 if last.islower() or last >= b"\x80" else 2
        size = sum(len(word) >= n for n in (5, 9, 14))
        assert shape == 8 * kind + 4 * (max(word) >= 0x80) + size


@pytest.fixture(scope="module")
def pieces():
    return piece_sampling.Pieces.load()


def test_sampled_segmentations_follow_their_law(pieces):
    n = 6000
    seeds = piece_sampling.mix(np.arange(n).astype(np.uint64))
    found = piece_sampling._batch(["thnti orea"] * n, seeds, pieces, 2)
    first = Counter(tuple(r[0][1]) for r in found)
    second = Counter(tuple(r[1][1]) for r in found)
    p = {tuple(s[1]): math.exp(s[2]) for r in found for s in r}
    assert all(tuple(r[0][1]) != tuple(r[1][1]) for r in found)
    assert all(r[0][3] > r[1][3] and r[1][4] <= 0 for r in found)
    likely = sorted(p, key=p.get)[-4:]
    for k in likely:
        assert first[k] / n == pytest.approx(p[k], abs=0.03)
        after = sum(p[j] * p[k] / (1 - p[j]) for j in p if j != k)
        assert second[k] / n == pytest.approx(after, abs=0.03)


def test_runs_of_blanks_are_pieces(pieces, spark):
    wide = {t: i for i, t in enumerate(pieces.text) if t.strip(b" ") == b"" and len(t) > 1}
    assert sorted(map(len, wide)) == list(range(2, 17)) or len(wide) >= 14
    n = 4000
    seeds = piece_sampling.mix(np.arange(n).astype(np.uint64))
    found = piece_sampling._batch(["a   b"] * n, seeds, pieces, 1)
    p = {tuple(r[0][1]): math.exp(r[0][2]) for r in found}
    drawn = Counter(tuple(r[0][1]) for r in found)
    many = {k for k in p if any(i in wide.values() for i in k)}
    assert many and {pieces.decode(k) for k in p} == {"a   b"}
    assert sum(drawn[k] for k in many) / n == pytest.approx(sum(p[k] for k in many), abs=0.03)
    assert sum(p.values()) == pytest.approx(1, abs=0.03)
    rows = spark.createDataFrame([(1, "  two  and   three "), (2, " "), (3, "x" + " " * 40), (4, "")], "doc_id int, text string")
    got = piece_sampling.sample_segmentations(rows, ["doc_id", "text"])
    assert all(r.round_trip and r.decoded == r.text for r in piece_sampling.decode(got).collect())


def test_word_marks_of_a_text_are_spelled(spark):
    rows = [(1, "a▁b"), (2, "▁"), (3, "▁▁ ▁ a ▁")]
    table = spark.createDataFrame(rows, "doc_id int, text string")
    got = piece_sampling.sample_segmentations(table, ["doc_id", "text"])
    assert all(r.round_trip and r.decoded == r.text for r in piece_sampling.decode(got).collect())


def test_inclusion_of_long_texts_has_a_log(spark, pieces):
    """The chance of a short text agrees with how often it is drawn; that of a long one underflows."""
    n = 4000
    seeds = piece_sampling.mix(np.arange(n).astype(np.uint64))
    for log_p, limit in ((-1.0, 0.5), (-40.0, 3.0), (-0.1, 1e-9)):
        odds = math.exp(log_p) * limit
        assert piece_sampling.log_inclusion(log_p, limit) == pytest.approx(math.log(-math.expm1(-odds)), rel=1e-6)
    assert piece_sampling.log_inclusion(-5.0, math.inf) == 0.0
    found = piece_sampling._batch(["thnti"] * n, seeds, pieces, 2)
    # Horvitz-Thompson: probabilities over inclusion chances add up to one on average.
    sums = [sum(math.exp(s[2] - s[4]) for s in row) for row in found]
    assert np.mean(sums) == pytest.approx(1, abs=0.05)
    table = spark.createDataFrame([(1, "some words " * 2000)], "doc_id int, text string")
    rows = piece_sampling.sample_segmentations(table, ["doc_id"]).collect()
    assert all(r.inclusion == 0.0 and -1e6 < r.log_inclusion < -745 for r in rows)


def test_segmentations_round_trip(spark, odd, pieces):
    got = piece_sampling.sample_segmentations(odd, ["doc_id", "text"])
    rows = piece_sampling.decode(got, "ids").collect()
    assert all(r.decoded == (r.text or "") for r in rows)
    assert Counter(r.doc_id for r in rows) == {1: 1, 2: 1, 3: 2, 4: 4, None: 2, 6: 2}
    # The mark before the text and its first blank are one piece or two.
    spelled = sorted([pieces.text[i] for i in r["ids"]] for r in rows if r.doc_id == 3)
    rest = [b"\x1c", b"\xc2\x85", b" "]
    assert spelled == [[b" ", b" ", *rest], [b"  ", *rest]]
    twice = {tuple(r["ids"]) for r in rows if r.doc_id == 4}
    assert len(twice) == 2
    assert piece_sampling.sample_segmentations(odd.limit(0), ["doc_id"]).count() == 0


def test_segmentations_do_not_depend_on_partitions(spark, texts):
    one = {(r.doc_id, r["sample"]): r.ids_hash for r in op2_piece_sampling(spark, SF_DIR).collect()}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(7)
    again = piece_sampling.sample_segmentations(docs, ["doc_id"])
    rows = again.select("doc_id", "sample", F.xxhash64("ids").alias("h")).collect()
    assert {(r.doc_id, r["sample"]): r.h for r in rows} == one


def test_boundaries_are_optimal():
    rng = np.random.default_rng(5)
    for _ in range(20):
        counts = np.zeros(10, int)
        counts[1:] = rng.integers(0, 4, 9)
        lengths = np.flatnonzero(counts)
        if not len(lengths):
            continue

        def padded(ends):
            return sum(int(counts[n]) * min(e for e in ends if e >= n) for n in lengths)

        choices = [
            {int(lengths[-1]), *(int(x) for k, x in enumerate(lengths) if mask >> k & 1)}
            for mask in range(1 << len(lengths))
        ]
        best = min(padded(c) for c in choices if len(c) <= 3)
        assert padded(packing.best_boundaries(counts, 3)) == best
    assert packing.best_boundaries(np.zeros(4, int), 3) == []


def test_packing_keeps_every_token(spark, texts):
    rows = op5_length_buckets(spark, SF_DIR).collect()
    sums = Counter()
    batches = Counter()
    for r in rows:
        sums[r.doc_id] += r.piece_tokens
        batches[r.bucket, r.bucket_tokens, r.batch] += 1
        assert r.piece_tokens <= r.bucket_tokens
    assert sums == {i: len(t.encode().split()) + 1 for i, t in texts.items()}
    assert all(n <= max(1, packing.BUDGET // size) for (_, size, _), n in batches.items())
    slots = Counter((r.bucket, r.batch, r.batch_slot) for r in rows)
    assert max(slots.values()) == 1


def test_packing_odd_rows(spark):
    rows = [(1, None), (2, 0), (3, 1), (3, 1), (None, 5000), (4, 70_000)]
    lengths = spark.createDataFrame(rows, "batch long, n_tokens long")
    got = packing.pack(lengths, longest=100, buckets=4, budget=150).collect()
    assert sum(r.piece_tokens for r in got) == 75_002
    assert max(Counter((r.bucket, r.batch) for r in got if r.bucket_tokens == 100).values()) == 1
    assert packing.pack(lengths.limit(0)).count() == 0


def brute_secrets(text):
    out = []
    assign = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    for order, (kind, pattern, least) in enumerate(
        (("assign", assign, 8), ("access", "AKIA[A-Z0-9]+", 16), ("hex", "[0-9a-f]+", 32))
    ):
        for m in re.finditer(pattern, text, re.ASCII):
            if len(m[2] if kind == "assign" else m[0]) >= least:
                out.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}", kind))
    return sorted(out)


def test_secrets_on_the_table(spark, texts):
    for r in op7_secret_scan(spark, SF_DIR).collect():
        want = brute_secrets(texts[r.doc_id])
        kinds = Counter(w[3] for w in want)
        assert (r.n_assign, r.n_access, r.n_hex) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r.base_sha256 == sha256(",".join(w[2] for w in want).encode()).hexdigest()


def test_secrets_of_every_kind(spark):
    rng = np.random.default_rng(3)
    alphabet = list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789")
    keys = ["".join(rng.choice(alphabet, 40)) for _ in range(60)]
    words = " ".join(f"some_ordinary_name_{i % 7} configuration_of_things version" for i in range(400))
    rows = [(i, f"é {words[: 50 * i]} Secret: '{k}' end") for i, k in enumerate(keys[:50])]
    rows += [
        (100, f"é🙂 here {keys[55]} there"),
        (101, "the some_ordinary_name_3 configuration_of_things_2 version"),
        (102, 'API_KEY = "short" AKIAABCDEFGHIJKL AKIASHORT ' + "0f" * 16 + " " + "0f" * 15),
        (103, None),
        (104, "TOKEN:abcdefgh password=" + "ab12" * 10),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in secret_scan.find_secrets(docs, ["doc_id", "text"]).collect()}
    assert [(s.kind, s.first, s.end) for s in got[100].spans] == [("markov", 8, 48)]
    assert got[100].redacted == "é🙂 here [SECRET] there"
    assert got[101].spans == [] and got[101].redacted == got[101].text
    assert [s.kind for s in got[102].spans if s.kind != "markov"] == ["access", "hex"]
    assert got[103].spans == [] and got[103].redacted is None
    for i, r in got.items():
        base = [f"{s.kind}:{s.first}:{s.end}" for s in r.spans if s.kind != "markov"]
        assert base == [w[2] for w in brute_secrets(r.text or "")]
    assert secret_scan.find_secrets(docs.limit(0), ["doc_id"]).count() == 0


def brute_rise(steps):
    """The largest sum of consecutive steps, over every pair of ends."""
    return max((sum(steps[a:b]) for a in range(len(steps)) for b in range(a + 1, len(steps) + 1)), default=0.0)


def test_added_secrets_against_all_stretches():
    rng = np.random.default_rng(11)
    size = secret_scan.CLASSES
    ratio = np.zeros((size, size))
    ratio[1:, 1:] = rng.normal(-0.3, 4.0, (size - 1, size - 1))
    letters = list("abcXYZ019" * 3 + "_/=-+ .é🙂")
    found = 0
    for case in range(500):
        text = "".join(rng.choice(letters, int(rng.integers(0, 70))))
        if case % 3 == 0:
            text += " token=abcXYZ019 " + text
        base = secret_scan.base_spans(text)
        spans = secret_scan.model_spans(text, ratio, base)
        assert spans == sorted(spans) and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
        for m in re.finditer("[A-Za-z0-9+/_=-]+", text):
            codes = secret_scan.CODE[np.frombuffer(m[0].encode(), np.uint8)]
            steps = ratio[codes[:-1], codes[1:]].tolist()
            least = secret_scan.MARGIN + np.log(len(m[0]))
            own = [s for s in spans if m.start() <= s[0] and s[1] <= m.end()]
            if not any(b[0] < m.end() and m.start() < b[1] for b in base):
                assert bool(own) == (brute_rise(steps) >= least)
            for a, b, kind, value in own:
                assert kind == "markov" and value == text[a:b]
                assert brute_rise(steps[a - m.start() : b - m.start() - 1]) >= least - 1e-9
                assert not any(t[0] < b and a < t[1] for t in base)
                # No key loses its ends: a span does not stop inside a string of letters and digits.
                assert a == m.start() or not (text[a - 1].isalnum() and text[a].isalnum())
                assert b == m.end() or not (text[b - 1].isalnum() and text[b].isalnum())
                found += 1
        sure = secret_scan.suspects(pa.array(["", text, None]), ratio)
        assert not sure[0] and not sure[2] and (sure[1] or not spans and not base)
    assert found > 100


def test_stretches_of_a_long_run_stay_apart():
    rise, fall = [2.0] * 10, [-2.0] * 8
    assert secret_scan.stretches(rise + fall + rise, 12.0) == [(0, 10), (18, 28)]
    assert secret_scan.stretches(rise + [-2.0] * 30 + rise, 12.0) == [(0, 10), (40, 50)]
    assert secret_scan.stretches([1.0] * 11, 12.0) == [] == secret_scan.stretches([], 12.0)


def test_planted_keys_are_found_and_text_is_left(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    ratio = secret_scan.train(docs)
    rng = np.random.default_rng(5)
    alphabet = list(secret_scan.ALPHABET[:62])
    for letters, least in ((alphabet, 0.95), (alphabet[10:], 0.95), (alphabet[:16], 0.9)):
        for length in (10, 16, 31):
            keys = ["".join(rng.choice(letters, length)) for _ in range(200)]
            hits = [secret_scan.model_spans(f"the value {k} of it", ratio, []) for k in keys]
            assert np.mean([[s[:2] for s in h] == [(10, 10 + length)] for h in hits]) >= least
    sent = F.size(F.filter("spans", lambda s: s["kind"] == "markov"))
    found = secret_scan.find_secrets(docs, ["doc_id", "text"], ratio).agg(
        F.sum(sent).alias("spans"), F.sum(F.size(F.split("text", " "))).alias("words")
    ).first()
    assert found.spans <= found.words * 1e-4


def test_long_texts_of_many_secrets_take_linear_time():
    rng = np.random.default_rng(7)
    keys = ["".join(rng.choice(list(secret_scan.ALPHABET[:62]), 40)) for _ in range(30_000)]
    text = " ".join(f"token={k}" if i % 2 else f"the {k}" for i, k in enumerate(keys))
    size = secret_scan.CLASSES
    began = time.process_time()
    base = secret_scan.base_spans(text)
    spans = secret_scan.model_spans(text, np.full((size, size), 1.0), base)
    assert len(base) == len(spans) == 15_000 and time.process_time() - began < 20


def test_secrets_odd_rows(spark, odd):
    got = secret_scan.find_secrets(odd.withColumn("spans", F.lit(1)), ["doc_id", "spans"]).collect()
    assert len(got) == len(ODD) and not any(r.spans for r in got)


def test_toxicity_learns_and_decodes(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = op8_toxicity(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id"
    )
    rows = scored.filter("held_out").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits / sum(r.predicted for r in rows) > 0.9
    assert hits / sum(r.toxic for r in rows) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_disguised_words(spark, odd):
    words = ["stupid", "idiot", "clown", "worthless"]
    docs = [(i, f"plain words of text number {i} and {words[i % 4]}" if i % 3 == 0 else f"plain words of text number {i}") for i in range(240)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    labels = [(i, int(i % 3 == 0)) for i in range(240)] + [(None, 1), (5, None)]
    model = toxicity.train_model(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    decoder = toxicity.Decoder(model.characters)
    for given, want in (("1d10t", "idiot"), ("stuuupid", "stupid"), ("cl0wn", "clown"), ("w.o.r.t.h.l.e.s.s", "worthless")):
        assert decoder.decode(given) == want
    asked = ["plain 1d10t text", "a c l o w n of text", "w-o-r-t-h-l-e-s-s", "plain text 2nd", "", None]
    rows = spark.createDataFrame(list(enumerate(asked)), "doc_id int, text string")
    got = [r.predicted for r in toxicity.score_texts(rows, ["doc_id"], model).orderBy("doc_id").collect()]
    assert got == [1, 1, 1, 0, 0, 0]
    assert toxicity.score_texts(odd, odd.columns, model).count() == len(ODD)
    none = toxicity.train_model(odd.limit(0), spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r.score for r in toxicity.score_texts(odd, ["doc_id"], none).collect()} == {0.5}


def test_words_behind_signs_and_blanks(spark):
    bad = ["idiot", "stupid", "shit", "clown"]
    good = ["you are a good text about classic plain words", "it is his spot", "you own a closed shop"]
    docs = [(i, f"{good[i % 3]} {bad[i // 2 % 4]}" if i % 2 else good[i % 3]) for i in range(1200)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1200)], "doc_id long, toxic int")
    model = toxicity.train_model(table, labels)
    asked = ["a sh1+ text", "(1d10t)", "y o u i d i o t", "i d i o t  y o u", "an id iot", "st up id", "y o u 1 d i 0 t"]
    fine = ["y o u a r e", "it is his", "a good text!", "c l a s s i c"]
    rows = spark.createDataFrame(list(enumerate(asked + fine)), "doc_id int, text string")
    got = toxicity.score_texts(rows, ["doc_id"], model).orderBy("doc_id").collect()
    assert [r.predicted for r in got] == [1] * len(asked) + [0] * len(fine)


def test_rare_words_do_not_share_a_sure_feature(spark):
    docs = [(i, f"plain words {i} idiot" if i % 2 else f"plain words {i}") for i in range(1000)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1000)], "doc_id long, toxic int")
    model = toxicity.train_model(table, labels)
    letters = str.maketrans("0123456789", "abcdefghij")
    long = [" ".join(f"{n:02}{i:05}".translate(letters) for i in range(40_000)) for n in range(40)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate([*long, "an idiot"])], "doc_id int, text string")
    got = toxicity.score_texts(rows, ["doc_id"], model).orderBy("doc_id").collect()
    assert [r.predicted for r in got] == [0] * 40 + [1]
    assert got[-1].score >= toxicity.SINGLE_SURE


def check_shards(rows, shards, size):
    sums, slots = Counter(), {}
    for r in rows:
        sums[r.shard] += r["size"]
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(r["size"] for r in rows)
    mean = sum(sums.values()) / shards
    assert all(abs(sums[s] - mean) <= size * largest for s in range(shards))


def test_shards_of_the_table(spark, texts):
    rows = op10_histogram_sort(spark, SF_DIR).collect()
    assert Counter(r.doc_id for r in rows) == Counter(list(texts))
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
        assert r.law == "bytes" and r.grown_shard is None
    check_shards(rows, 40, 1.1)


def test_shards_cut_a_hot_group_and_keep_others_whole(spark):
    rows = [(i, 7 if i % 3 == 0 else i // 2, 10) for i in range(3000)] + [(None, None, None)]
    table = spark.createDataFrame(rows, "slot long, text long, size int").repartition(5)
    got = sharding.shard_rows(table.withColumnRenamed("slot", "id"), "text", "size", 8, 0.05)
    got = got.fillna({"size": 0}).collect()
    check_shards(got, 8, 60)
    of = {}
    for r in got:
        of.setdefault(r.text, set()).add(r.shard)
    assert len(of[7]) >= 2 and all(len(s) == 1 for t, s in of.items() if t != 7)
    assert sharding.shard_rows(table.limit(0), "text", "size", 8).count() == 0


def test_pipeline_stages(spark):
    from test_pairs import brute_cut, jaccard_links, least

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.staged(stage(spark, docs, SF_DIR), name)
        if name != "packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        kept[name] = (
            {r.doc_id: r.text for r in docs.collect()},
            out.collect(),
        )
        docs = out
    given, rows = kept["toxicity"]
    marks = {
        r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    }
    gone = (set(given) - {r.doc_id for r in rows}) & set(marks)
    assert gone and sum(marks[i] for i in gone) >= 0.8 * len(gone)
    given, rows = kept["ngram_join"]
    want = least(given, jaccard_links(given, 5, 80))
    assert {r.doc_id for r in rows} == set(want.values())
    given, rows = kept["substring_dedup"]
    want = brute_cut(given, 35)
    for r in rows:
        n, removed, digest = want[r.doc_id]
        assert (r.text == given[r.doc_id]) if not removed else sha256(r.text.encode()).hexdigest() == digest
        assert r.n_chars == len(r.text)
    given, rows = kept["secret_scan"]
    assert {r.doc_id for r in rows} == set(given)
    assert not any(brute_secrets(r.text) for r in rows)
    given, rows = kept["packing"]
    assert sum(r.piece_tokens for r in rows) == sum(len(t.encode().split()) + 1 for t in given.values())
