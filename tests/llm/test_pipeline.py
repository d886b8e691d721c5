"""The pipeline's stages on odd rows, empty tables and columns named like the operators' own."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import shared, toxicity

SF_DIR = "/root/testdata/sf0.001"

CLASHES = (
    "predicted string, score string, component_id string, kept string, n_shingles string, n_words string, "
    "n_removed string, kept_text string, removed string, spans string, redacted string, _new string, "
    "_c0 string, _user1 string, _tid string, _row string, _k1 string, Text2 string, n_chars int"
)
PASSAGE = " ".join(f"passage{i}" for i in range(60))
KEY = "AKIA" + "Q7ZX" * 5
ODD = [
    (1, None),
    (2, ""),
    (3, " \n "),
    (4, "exactly the same text twice over"),
    (4, "exactly the same text twice over"),
    (None, "exactly the same text twice over"),
    (None, "a text of its own é 梦 🙂"),
    (7, f"first {PASSAGE} one"),
    (8, f"second words here {PASSAGE} two other"),
    (9, f"the key is {KEY} as said"),
    (10, "long words " * 30_000),
    (11, "x" * 200_000),
]


@pytest.fixture(scope="module")
def odd(spark):
    names = [part.split()[0] for part in CLASHES.split(", ")]
    rows = [(i, t, *[f"{n}-{k}" for n in names[:-1]], 5) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHES}").repartition(3)


def key(row):
    return row["predicted"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_stages_leave_user_columns_alone(spark, odd, name, stage):
    got = stage(spark, odd, SF_DIR)
    assert got.schema == odd.schema or [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in odd.schema]
    before = {key(r): r for r in odd.collect()}
    after = {key(r): r for r in got.collect()}
    for k, r in after.items():
        for c in odd.columns:
            if c not in ("text", "n_chars"):
                assert r[c] == before[k][c], (name, c)
    texts = {k: r.text for k, r in after.items()}
    kept = {int(k.rpartition("-")[2]) for k in after}
    if name == "toxicity":
        assert kept == set(range(12)) and all(texts[k] == before[k].text for k in texts)
    elif name == "ngram_join":
        assert len(kept & {3, 4}) == 1 and 5 not in kept
        assert kept >= {0, 1, 2, 6, 9, 10, 11} and all(texts[k] == before[k].text for k in texts)
    elif name == "substring_dedup":
        assert kept == set(range(12))
        assert texts["predicted-7"] == "first one" and texts["predicted-8"] == "second words here two other"
        assert texts["predicted-10"] == "" and texts["predicted-0"] is None and texts["predicted-2"] == " \n "
        assert after["predicted-7"].n_chars == 9 and after["predicted-0"].n_chars is None
    else:
        assert kept == set(range(12)) and texts["predicted-9"] == "the key is [SECRET] as said"
        assert texts["predicted-0"] is None and texts["predicted-11"] == before["predicted-11"].text


def test_last_stage_packs_every_row(spark, odd):
    got = corpus_pipeline.pack_lengths(spark, odd, SF_DIR).collect()
    words = sum(len((t or "").split()) + 1 for _, t in ODD)
    assert sum(r.piece_tokens for r in got) == words


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_an_empty_table(spark, odd, name, stage):
    got = stage(spark, odd.limit(0), SF_DIR)
    assert got.count() == 0
    assert name == "packing" or got.columns == odd.columns


def test_run_leaves_one_staged_table(spark):
    before = shared.staged_so_far()
    got = corpus_pipeline.run(spark, SF_DIR)
    assert shared.staged_so_far() == before + 1 and got.count() > 0
    shared.forget(got)


# The decoder against all readings


def every_reading(decoder, token):
    """Score and text of each way to read a token, by plain recursion."""
    model = decoder.model

    def go(at, a, b, score, text):
        if at == len(token):
            yield score + model[a][b][0], text
            return
        options, again = toxicity.readings(token, at)
        for kind, letter, cost in options:
            if letter:
                yield from go(at + 1, b, kind, score - cost + model[a][b][kind], text + letter)
                if b == kind:
                    yield from go(at + 1, a, b, score - again, text)
            else:
                yield from go(at + 1, a, b, score - cost, text)

    return list(go(0, 0, 0, 0.0, ""))


def test_decoder_finds_the_best_of_all_readings():
    rng = random.Random(3)
    model = np.log(np.random.default_rng(1).dirichlet(np.full(toxicity.CLASSES, 0.3), (toxicity.CLASSES,) * 2) + 1e-9)
    decoder = toxicity.Decoder(model)
    tokens = ["".join(rng.choices("as1!30@$.-oil", k=rng.randrange(1, 9))) for _ in range(300)]
    for token in [*tokens, "a" * 8, "111!!!1", "é1é", ""]:
        every = every_reading(decoder, token)
        score, text = decoder.best(token)
        assert score == pytest.approx(max(s for s, _ in every))
        assert text in {t for s, t in every if s == pytest.approx(score)}
        assert decoder.decode(token) == text


def test_a_very_long_token_is_decoded_in_linear_time():
    import time

    decoder = toxicity.Decoder(np.full((toxicity.CLASSES,) * 3, -3.0))
    took = []
    for size in (20_000, 80_000):
        token = "".join(itertools.islice(itertools.cycle("ab1c0d$$$e"), size))
        start = time.process_time()
        assert decoder.best(token)[1]
        took.append(time.process_time() - start)
    assert took[1] < 10 * took[0] + 1


def test_filter_holds_every_key(spark):
    keys = spark.range(0, 300_000).select(F.xxhash64("id").alias("k"))
    held = shared.key_filter(keys, "k")
    own = np.array([r.k for r in keys.limit(1000).collect()])
    assert shared.in_filter(held, own).all()
    other = np.random.default_rng(0).integers(-(2**62), 2**62, 20_000)
    assert shared.in_filter(held, other).mean() < 0.01
    none = shared.key_filter(keys.limit(0), "k")
    assert not shared.in_filter(none, own).any()
