"""Toxicity: noisy-channel deobfuscation, then a linear score of the restored text.

Tokens that mix letters with digits or signs, repeat a letter, or spell a word letter by letter are
read as character lattices. Viterbi decoding under a character trigram model, counted over all
documents, restores the likeliest spelling. Words and word beginnings of text and restored tokens
are the features of a logistic model: candidates are counted over all labelled training rows, and
the weights are fitted on about ``FIT_ROWS`` of them at most. One sure word suffices by itself.
Chosen words are also looked for in neighbouring pieces of text that blanks cut apart.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import (
    Broadcasted,
    array_pieces,
    carried,
    forget,
    in_filter,
    key_filter,
    map_batches,
    release,
    staged,
    sum_arrays,
)
from millrace.llm.words import BLANK, LOWER, mix, powers, slices, spaced_bytes, split_words

PREFIXES = (4, 6)
# The classifier's weights are fitted on a sample of about so many labelled rows at most.
FIT_ROWS = 50_000
FIT_STEPS = 400
MOST_CHOSEN = 20_000
LEAST_TOXIC = 3
LEAST_RATIO = 3.0
PENALTY = 0.1
THRESHOLD = 0.3
# Doubt in a single feature: its share of toxic rows is held against so many clean ones.
SINGLE_DOUBT = 16.0
SINGLE_SURE = 0.95

LETTER = np.zeros(256, bool)
LETTER[ord("a") : ord("z") + 1] = True
LETTER[ord("A") : ord("Z") + 1] = True
LETTER[0x80:] = True
DIGIT = np.zeros(256, bool)
DIGIT[ord("0") : ord("9") + 1] = True
# Which letters a sign may stand for.
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c",
}
LEET_BYTE = np.zeros(256, bool)
LEET_BYTE[[ord(c) for c in LEET]] = True
ODD = np.zeros(256, bool)
ODD[0x21:0x7F] = True
ODD &= ~LETTER

# Character classes of the trigram model: 0 word end, 1-26 letters, 27 any other letter.
CLASSES = 28
CLASS = np.zeros(256, np.uint8)
CLASS[ord("a") : ord("z") + 1] = np.arange(1, 27)
CLASS[0xC0:] = 27
MODEL_CELLS = CLASSES**3

SPELLED = 4
LEET_COST = 0.5
DROP_COST = 12.0
SIGN_COST = 0.3
# A letter that repeats the one before: cheap to drop where three or more stand in a row.
REPEAT_COST = 1.0
DOUBLE_COST = 6.0
# Words cut by blanks: letters of a piece where there are three or more, bytes of a whole word, and
# by how much the cut reading may be likelier.
PIECE = 3
JOINED = 40
JOIN_DOUBT = 2.0


def _trigrams(texts: pa.Array) -> np.ndarray:
    data, _ = spaced_bytes(texts)
    data = LOWER[data]
    data = data[(data < 0x80) | (data >= 0xC0)]
    code = CLASS[data].astype(np.int64)
    before = np.concatenate([[0], code[:-1]])
    second = np.where(before > 0, np.concatenate([[0], before[:-1]]), 0)
    use = (code > 0) | (before > 0)
    cells = second[use] * CLASSES * CLASSES + before[use] * CLASSES + code[use]
    return np.bincount(cells, minlength=MODEL_CELLS)


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a character class after two others, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(MODEL_CELLS, np.int64)
        for batch in batches:
            for a, b in slices(batch.column(0)):
                sums += _trigrams(batch.column(0).slice(a, b - a))
        made = array_pieces(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(made["piece"], pa.int32()), pa.array(made["data"], pa.binary())],
            names=["piece", "data"],
        )

    blobs = docs.select("text").mapInArrow(run, "piece int, data binary")
    raw = b"".join(sum_arrays(blobs)) or bytes(8 * MODEL_CELLS)
    counts = np.frombuffer(raw, np.int64).reshape(CLASSES, CLASSES, CLASSES) + 0.1
    return np.log(counts / counts.sum(axis=2, keepdims=True))


def readings(token: str, at: int) -> tuple[list[tuple[int, str, float]], float]:
    """What a token's character may stand for: class, letter and cost of each; and what it costs to
    drop it as a repetition of the letter before."""
    c = token[at]
    again = REPEAT_COST if c * 3 in token[max(at - 2, 0) : at + 3] else DOUBLE_COST
    kind = 27 if ord(c) > 127 else int(CLASS[ord(c)])
    if kind:
        return [(kind, c, 0.0)], again
    if c in LEET:
        return [(ord(x) - 96, x, LEET_COST) for x in LEET[c]] + [(0, "", DROP_COST)], again
    return [(0, "", SIGN_COST)], again


class Decoder:
    """Viterbi over the spellings a token may stand for; exact, as every state is kept.

    A state is the last two letters, and each holds a chain of its letters, so a token takes time
    and memory in proportion to its length.
    """

    def __init__(self, model: np.ndarray):
        self.model = model.tolist()
        self.decode = lru_cache(100_000)(lambda token: self.best(token)[1])

    def best(self, token: str) -> tuple[float, str]:
        """The likeliest reading and its log score; of equal ones the first found."""
        model, worst = self.model, (-math.inf,)
        states: dict[tuple[int, int], tuple] = {(0, 0): (0.0, None)}
        for at in range(len(token)):
            options, again = readings(token, at)
            after: dict[tuple[int, int], tuple] = {}
            for (a, b), (score, chain) in states.items():
                for kind, letter, cost in options:
                    if letter and b == kind and score - again > after.get((a, b), worst)[0]:
                        after[a, b] = (score - again, chain)
                    key = (b, kind) if letter else (a, b)
                    value = score - cost + (model[a][b][kind] if letter else 0.0)
                    if value > after.get(key, worst)[0]:
                        after[key] = (value, (chain, letter) if letter else chain)
            states = after
        last = max(states, key=lambda s: states[s][0] + model[s[0]][s[1]][0])
        score, chain = states[last]
        letters = []
        while chain is not None:
            chain, letter = chain
            letters.append(letter)
        return score + model[last[0]][last[1]][0], "".join(reversed(letters))

    def split_score(self, letters: str, whole: tuple[int, int] | None = None) -> float:
        """Log probability of the likeliest words that ``letters`` fall into.

        With ``whole`` those letters are one of the words.
        """
        model = self.model
        codes = [27 if ord(c) > 127 else int(CLASS[ord(c)]) for c in letters]
        best = [0.0] + [-1e9] * len(codes)
        for start in range(len(codes)):
            a = b = 0
            score = best[start]
            for end in range(start + 1, len(codes) + 1):
                score += model[a][b][codes[end - 1]]
                a, b = b, codes[end - 1]
                if whole and end > whole[0] and start < whole[1] and (start, end) != whole:
                    continue
                best[end] = max(best[end], score + model[a][b][0])
        return best[-1]


def joined_words(texts: pa.Array, keys: np.ndarray, decoder: Decoder) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``keys`` that blanks cut in pieces, with the text each is in.

    Two pieces may be of any length, three and more of at most ``PIECE`` letters, ``JOINED`` bytes
    in all. Word ends of the character model decide whether the pieces, with the single letters
    around them, are likely to hold the word.
    """
    words = split_words(texts, lower=True, blank=~LETTER)
    n = len(words.start)
    if n < 2 or not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    data, owner, size = words.data, words.text_of_word, words.end - words.start
    values = (data.astype(np.uint64) + np.uint64(1)) * powers(len(data))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    raw = (sums[words.end] - sums[words.start]) * powers(len(data) + 1, True)[words.start]
    solid = np.concatenate([[0], np.cumsum(~BLANK[data])])
    near = np.zeros(n, bool)
    near[:-1] = (owner[1:] == owner[:-1]) & (solid[words.start[1:]] == solid[words.end[:-1]])
    short = size <= PIECE
    shift = powers(JOINED + 1)
    first, last = np.arange(n), np.arange(n)
    sum_, wide = raw, size
    rows, found = [], []
    while True:
        go = near[last] & (wide <= JOINED)
        go[go] &= wide[go] + size[last[go] + 1] <= JOINED
        first, last, sum_, wide = first[go], last[go] + 1, sum_[go], wide[go]
        if not len(first):
            break
        sum_ = sum_ + raw[last] * shift[wide]
        wide = wide + size[last]
        names = mix(sum_)
        for i in places(keys, np.arange(len(names)), names)[0].tolist():
            a, b = int(first[i]), int(last[i])
            x, y = a, b
            while size[a] == 1 and x and near[x - 1] and size[x - 1] == 1 and a - x < JOINED:
                x -= 1
            while size[b] == 1 and near[y] and size[y + 1] == 1 and y - b < JOINED:
                y += 1
            parts = [words.word(k).decode("utf-8", "replace") for k in range(x, y + 1)]
            start = sum(map(len, parts[: a - x]))
            whole = start, start + sum(map(len, parts[a - x : b - x + 1]))
            run = "".join(parts)
            if decoder.split_score(run, whole) >= decoder.split_score(run) - JOIN_DOUBT:
                rows.append(int(owner[a]))
                found.append("".join(parts[a - x : b - x + 1]))
        go = short[first] & short[last]
        first, last, sum_, wide = first[go], last[go], sum_[go], wide[go]
    at, feature = _features(pa.array(found, pa.large_string()))
    return np.array(rows, np.int64)[at], feature


def odd_tokens(texts: pa.Array) -> tuple[np.ndarray, list[str], list[int]]:
    """Tokens that may be disguised words, with the text each is in, and which are spelled runs."""
    words = split_words(texts, lower=True)
    if not len(words.start):
        return np.zeros(0, np.int64), [], []
    data = words.data
    useful = np.flatnonzero(LETTER[data] | LEET_BYTE[data])
    solid = np.flatnonzero(LETTER[data] | DIGIT[data])
    sound = np.append(solid, len(data))
    signs = np.append(-1, useful)
    useful, solid = np.append(useful, len(data)), np.append(-1, solid)
    start = useful[np.searchsorted(useful, words.start)]
    last = solid[np.searchsorted(solid, words.end) - 1]
    letters = np.concatenate([[0], np.cumsum(LETTER[data])])
    odd = np.concatenate([[0], np.cumsum(ODD[data])])
    end = np.maximum(last + 1, start)
    end = np.where(start < words.end, np.minimum(end, words.end), start)
    start = np.minimum(start, end)
    mixed = (letters[end] > letters[start]) & (odd[end] > odd[start]) & (end - start >= 3)
    same = (data[2:] == data[1:-1]) & (data[1:-1] == data[:-2]) & LETTER[data[2:]] & (data[2:] < 128)
    tripled = np.flatnonzero(same)
    at = np.searchsorted(words.start, tripled, "right") - 1
    mixed[at[(at >= 0) & (tripled + 2 < words.end[at])]] = True
    owner = words.text_of_word
    rows = owner[mixed].tolist()
    found = [
        data[a:b].tobytes().decode("utf-8", "replace")
        for a, b in zip(start[mixed].tolist(), end[mixed].tolist(), strict=True)
    ]
    # A sign at a token's edge may be a letter or stand beside the word: both are read.
    plain = np.clip(sound[np.searchsorted(sound, words.start)], start, end)
    full = np.maximum(signs[np.searchsorted(signs, words.end) - 1] + 1, start)
    for a, b, new in ((plain, end, plain > start), (start, full, full > end), (plain, full, (plain > start) & (full > end))):
        more = np.flatnonzero(new & (letters[b] > letters[a]) & (odd[b] > odd[a]) & (b - a >= 3))
        rows += owner[more].tolist()
        found += [
            data[x:y].tobytes().decode("utf-8", "replace")
            for x, y in zip(a[more].tolist(), b[more].tolist(), strict=True)
        ]
    runs = []
    single = (end - start == 1) & (words.end - words.start <= 3)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.view(np.int8), [0]])))
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        for text in np.unique(owner[a:b]).tolist():
            own = np.flatnonzero(owner[a:b] == text) + a
            if len(own) >= SPELLED:
                spelled = data[start[own]].tobytes().decode("utf-8", "replace")
                # A one-letter word may stand beside a spelled one.
                tries = [spelled, spelled[1:], spelled[:-1]] if len(spelled) > SPELLED else [spelled]
                runs.append(len(found))
                rows += [text] * len(tries)
                found += tries
    return np.array(rows, np.int64), found, runs


def _features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit hashes of words and word beginnings, with the text each is in."""
    words = split_words(texts, lower=True, blank=~LETTER)
    if not len(words.start):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    owner = words.text_of_word
    owners, out = [owner], [words.hashes()]
    for size in PREFIXES:
        long = words.end - words.start > size
        owners.append(owner[long])
        out.append(mix(words.hashes(size)[long] ^ np.uint64(size)))
    return np.concatenate(owners), np.concatenate(out)


def features(
    texts: pa.Array, decoder: Decoder, keys: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``(text, feature)`` pairs of texts and of their restored tokens, in order.

    With ``keys`` also those of them that blanks cut in pieces.
    """
    owner, feature = _features(texts)
    rows, tokens, runs = odd_tokens(texts)
    if len(rows):
        spelled = [decoder.decode(t) for t in tokens]
        at, more = _features(pa.array(spelled, pa.large_string()))
        owner, feature = np.concatenate([owner, rows[at]]), np.concatenate([feature, more])
    if keys is not None:
        at, more = joined_words(texts, keys, decoder)
        owner, feature = np.concatenate([owner, at]), np.concatenate([feature, more])
        if runs:
            apart = pa.array([" ".join(spelled[i]) for i in runs], pa.large_string())
            at, more = joined_words(apart, keys, decoder)
            owner = np.concatenate([owner, rows[runs][at]])
            feature = np.concatenate([feature, more])
    return _distinct(owner, feature)


def _distinct(owner: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((feature, owner))
    owner, feature = owner[order], feature[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (feature[1:] != feature[:-1])
    return owner[new], feature[new]


def places(keys: np.ndarray, row: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those pairs whose feature is one of the sorted ``keys``, as row and place in ``keys``."""
    if not len(keys):
        return row[:0], np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(keys, feature), len(keys) - 1)
    there = keys[at] == feature
    return row[there], at[there]


@dataclass
class Model:
    """All that scoring needs; its size does not depend on the input."""

    characters: np.ndarray
    keys: np.ndarray
    weights: np.ndarray
    bias: float
    single: np.ndarray

    def scores(self, row: np.ndarray, feature: np.ndarray, count: int) -> np.ndarray:
        """The larger of the logistic score and the surest single feature's share."""
        row, at = places(self.keys, row, feature)
        sums = np.bincount(row, self.weights[at], minlength=count) + self.bias
        out = 1 / (1 + np.exp(-np.clip(sums, -30, 30)))
        np.maximum.at(out, row, self.single[at])
        return out


def _feature_counts(train: DataFrame, characters: Broadcasted) -> DataFrame:
    """``feature, clean, toxic``: in how many labelled rows of each kind a feature is."""

    def work(batch):
        decoder = Decoder(characters.value)
        marks = batch.column(batch.schema.get_field_index("toxic")).to_numpy().astype(np.int64)
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            row, feature = features(texts.slice(a, b - a), decoder)
            names, at = np.unique(feature, return_inverse=True)
            many = np.bincount(at, minlength=len(names))
            bad = np.bincount(at, marks[a:b][row], minlength=len(names)).astype(np.int64)
            yield {"feature": names.view(np.int64), "clean": many - bad, "toxic": bad}

    rows = map_batches(
        train.select(F.col("toxic"), "text"), work, "feature long, clean long, toxic long"
    )
    return rows.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def choose_features(counts: DataFrame, clean: int, toxic: int) -> tuple[np.ndarray, np.ndarray]:
    """The features that speak most for toxic texts, sorted, and their (clean, toxic) counts."""
    rate = (F.col("toxic") / max(toxic, 1)) / ((F.col("clean") + 0.5) / (clean + 1))
    able = counts.filter((F.col("toxic") >= LEAST_TOXIC) & (rate >= LEAST_RATIO))
    weight = F.col("toxic") * F.log(rate)
    got = able.orderBy(weight.desc(), "feature").limit(MOST_CHOSEN).collect()
    keys = np.array([r.feature for r in got], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.array([(r.clean, r.toxic) for r in got], np.int64).reshape(-1, 2)[order]


def fit(rows: np.ndarray, columns: np.ndarray, toxic: np.ndarray, width: int) -> tuple[np.ndarray, float]:
    """Logistic regression with a quadratic penalty, by Adam over all given rows."""
    weights, bias = np.zeros(width), 0.0
    first, second = np.zeros(width + 1), np.zeros(width + 1)
    n = max(len(toxic), 1)
    for step in range(1, FIT_STEPS + 1):
        sums = bias + np.bincount(rows, weights[columns], minlength=len(toxic))
        error = 1 / (1 + np.exp(-np.clip(sums, -30, 30))) - toxic
        slope = np.bincount(columns, error[rows], minlength=width) + PENALTY * weights / 10
        slope = np.append(slope, error.sum()) / n
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope * slope
        move = 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-12)
        weights, bias = weights - move[:-1], bias - move[-1]
    return weights, float(bias)


def train_model(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id") -> Model:
    """Learn from ``labels (id, toxic)``, one label per id (the larger, if they differ).

    Null ids and null labels teach nothing, an id that repeats in ``docs`` teaches with each row.
    Without labels of both kinds, as with an empty table, the score is even and the model has no
    keys. Other columns are not read. Texts of labelled rows move once, to meet their labels, and are kept until the model
    is fitted.
    """
    spark = docs.sparkSession
    characters = character_model(docs)
    marks = (
        labels.filter(F.col("toxic").isNotNull() & F.col(id_column).isNotNull())
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .withColumn("_key", F.xxhash64("_id"))
    )
    wanted = Broadcasted(spark, key_filter(marks, "_key"))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(wanted.value, batch.column(0).to_numpy())))
        release()

    keyed = docs.filter(F.col(id_column).isNotNull()).select(
        F.xxhash64(id_column).alias("_key"),
        F.col(id_column).alias("_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    # Labels are the smaller side at any size: a table of ids and marks, one row for each.
    labelled = keyed.mapInArrow(pick, keyed.schema).join(marks.hint("shuffle_hash"), ["_key", "_id"])
    train = staged(labelled.select("_key", "toxic", "text"), "labelled")
    wanted.end()
    sent = Broadcasted(spark, characters)
    kinds = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    clean, toxic = kinds.get(0, 0), kinds.get(1, 0)
    if not clean or not toxic:
        forget(train)
        return Model(characters, np.zeros(0, np.uint64), np.zeros(0), 0.0, np.zeros(0))
    chosen, counts = choose_features(_feature_counts(train, sent), clean, toxic)
    keys = Broadcasted(spark, chosen)

    def held(batch):
        decoder = Decoder(sent.value)
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            row, feature = features(texts.slice(a, b - a), decoder, keys.value)
            row, at = places(keys.value, row, feature)
            at = at.astype(np.int32)
            bounds = np.searchsorted(row, np.arange(b - a + 1))
            yield {
                "_rows": slice(a, b),
                "at": [at[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)],
            }

    share = min(1.0, FIT_ROWS / (clean + toxic))
    sample = train.filter(F.pmod(F.xxhash64("_key"), F.lit(1 << 20)) < int(share * (1 << 20)))
    got = map_batches(sample.select("toxic", "text"), held, "at binary", ["toxic"]).collect()
    forget(train)
    sent.end()
    keys.end()
    columns = [np.frombuffer(r["at"], np.int32) for r in got]
    rows = np.repeat(np.arange(len(got)), [len(c) for c in columns])
    marked = np.array([r["toxic"] for r in got], float)
    flat = np.concatenate([*columns, np.zeros(0, np.int32)])
    weights, bias = fit(rows, flat, marked, len(chosen))
    share = counts[:, 1] / (counts.sum(axis=1) + SINGLE_DOUBT)
    return Model(characters, chosen, weights, bias, np.where(share >= SINGLE_SURE, share, 0.0))


def score_texts(docs: DataFrame, carry: list[str], model: Model) -> DataFrame:
    """``carry`` columns, ``score`` (0 to 1) and ``predicted`` of every document.

    Null and empty texts have no features and get the model's base score. Rows are judged one by
    one, by their text alone, so repeated rows score alike and an empty table gives no rows; a
    carried column named like one of ours gives way to it. Very long texts are read whole; a very
    long token is decoded in time linear in its length.
    """
    names, held, picked = carried(docs, carry, "score", "predicted")
    sent = Broadcasted(docs.sparkSession, model)

    def work(batch):
        decoder = Decoder(sent.value.characters)
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            row, feature = features(texts.slice(a, b - a), decoder, sent.value.keys)
            score = sent.value.scores(row, feature, b - a)
            yield {
                "_rows": slice(a, b),
                "score": score,
                "predicted": (score >= THRESHOLD).astype(np.int32),
            }

    made = map_batches(docs.select(*picked), work, "score double, predicted int", held)
    return made.select(
        *[F.col(h).alias(c) for h, c in zip(held, names, strict=True)], "score", "predicted"
    )
