"""Scoring by a gated recurrent language model with a class-factored output.

Word counts of the whole training part fix the vocabulary, the classes and a smoothed unigram
inside every class of rarer words. A small GRU, trained in numpy by truncated backpropagation,
predicts the class and, for frequent words, the word. Every training document is trained on once:
tasks train on their own documents, dealt row by row over ``ROUNDS`` rounds, and after each round
their weights are averaged. In training, texts lie one behind the other in lanes of like length; the
state starts anew with each text, and every ``STRETCH`` tokens of a longer one. Scoring carries the state over all windows of a whole document.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import (
    Broadcasted,
    array_pieces,
    keep_freed,
    map_batches,
    one_thread,
    release,
    staged,
    sum_arrays,
)
from millrace.llm.words import slices, split_words

VOCABULARY = 1024
IN_CLASS = 32
FREQUENT = VOCABULARY // IN_CLASS
SHAPES = 32
HIDDEN = 24
WINDOW = 32
LANES = 256
# A lane is to hold about so many windows, so that few texts still make many steps.
LANE_WINDOWS = 128
# Training: the longest stretch of a text with one state, and the tokens held at once.
STRETCH = 4096
HELD_TOKENS = 1 << 21
SCORE_LANES = 2048
# Rows whose outputs, and bytes of text whose temporaries, lie in a core's cache.
CACHED_ROWS = 4096
SLICE_BYTES = 200_000
ROUNDS = 2
RATE = 0.02
# Words looked up in tasks; counts of all others are joined. This bounds what is broadcast.
MOST_LOOKED_UP = 1 << 20
END = np.uint64(1)
END_SHAPE = 0
# Weights travel as fixed-point sums over tokens: 64 bits hold them for about 10^13 tokens.
_FIXED = float(1 << 16)


# What a word's last byte, and its length up to 14, add to its shape.
_BY_LAST = np.full(256, 16, np.int8)
_BY_LAST[[*range(97, 123), *range(0x80, 256)]] = 0
_BY_LAST[[44, 46]] = 8
_BY_LAST[48:58] = 24
_BY_SIZE = np.digitize(np.arange(15), [5, 9, 14]).astype(np.int8)


def word_shapes(words) -> np.ndarray:
    """A class from 0 to 31 of each word's spelling: last byte, length, other alphabets."""
    shapes = _BY_LAST[words.data[words.end - 1]]
    shapes += _BY_SIZE[np.minimum(words.end - words.start, 14)]
    wide = words.data >= 0x80
    if wide.any():
        sums = np.zeros(len(wide) + 1, np.int32)
        np.cumsum(wide, dtype=np.int32, out=sums[1:])
        shapes[sums[words.end] > sums[words.start]] += 4
    return shapes


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and shape of each token, and tokens per text: the words, then one end."""
    words = split_words(texts, lower=True)
    hashes, shapes = np.zeros(0, np.uint64), np.zeros(0, np.int8)
    if len(words.start):
        hashes, shapes = words.hashes(), word_shapes(words)
    at = words.first[1:]
    return np.insert(hashes, at, END), np.insert(shapes, at, END_SHAPE), words.counts + 1


def count_words(docs: DataFrame) -> DataFrame:
    """``w, shape, c``: how often each token occurs in all texts."""

    def work(batch):
        column = batch.column(0)
        parts = [tokens(column.slice(a, b - a))[:2] for a, b in slices(column, SLICE_BYTES)]
        # Equal words have equal shapes, so it does not matter whose shape stays.
        coded = pa.array(np.concatenate([p[0] for p in parts])).dictionary_encode()
        hashes, code = coded.dictionary.to_numpy(), coded.indices.to_numpy()
        shapes = np.empty(len(hashes), np.int8)
        shapes[code] = np.concatenate([p[1] for p in parts])
        yield {"w": hashes.view(np.int64), "shape": shapes, "n": np.bincount(code, minlength=len(hashes))}

    rows = map_batches(docs.select("text"), work, "w long, shape tinyint, n long")
    return rows.groupBy("w").agg(F.first("shape").alias("shape"), F.sum("n").alias("c"))


class Lexicon:
    """Counts of the training part, of bounded size."""

    def __init__(self, counts: DataFrame):
        total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
        self.total, self.distinct = int(total[0]), int(total[1])
        level = F.floor(F.log2("c") * 8).cast("int")
        levels = counts.groupBy(level.alias("level")).count().collect()
        kept, self.level = 0, 0
        for row in sorted(levels, key=lambda r: -r["level"]):
            kept += row["count"]
            if kept > MOST_LOOKED_UP:
                self.level = row["level"] + 1
                break
        self.is_rare = level < self.level
        got = counts.filter(~self.is_rare).select("w", "shape", "c").toArrow()
        w = got.column("w").to_numpy().view(np.uint64)
        shape, c = got.column("shape").to_numpy(), got.column("c").to_numpy()
        order = np.argsort(w)
        self.words, shape, self.counts = w[order], shape[order], c[order].astype(np.float64)
        rank = np.lexsort((self.words, -self.counts, self.words != END))[:VOCABULARY]
        self.place = np.full(len(self.words), -1, np.int16)
        self.place[rank] = np.arange(len(rank))
        self.frequent = self.counts[rank]
        by_shape = {
            r["shape"]: (r["c"], r["n"])
            for r in counts.groupBy("shape")
            .agg(F.sum("c").alias("c"), F.count("*").alias("n"))
            .collect()
        }
        sums = np.array([by_shape.get(s, (0, 0)) for s in range(SHAPES)], float)
        np.subtract.at(sums, shape[rank], np.stack([self.frequent, np.ones(len(rank))], 1))
        self.shape_total, self.shape_distinct = sums[:, 0], sums[:, 1]

    # Tasks derive what is cached below, so it is not sent.
    @cached_property
    def logs(self) -> np.ndarray:
        """The log of each looked-up word's smoothed count."""
        return np.log10(self.counts + 0.5)

    @cached_property
    def _closed(self) -> np.ndarray:
        """The words, and one that no hash lies behind."""
        return np.append(self.words, np.uint64(2**64 - 1))

    @cached_property
    def _begins(self) -> tuple[np.uint64, np.ndarray]:
        """Where the words of each first bits start: hashes lie evenly, so theirs is at most a few steps on."""
        bits = max(len(self.words).bit_length() + 1, 4)
        shift = np.uint64(64 - bits)
        many = np.bincount((self.words >> shift).astype(np.intp), minlength=1 << bits)
        return shift, (np.cumsum(many) - many).astype(np.int32)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each token among the words looked up, and whether it is there."""
        if not len(self.words):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        shift, begins = self._begins
        at = begins[(hashes >> shift).view(np.int64)].astype(np.int64)
        found = self._closed[at]
        behind = np.flatnonzero(found < hashes)
        while len(behind):
            at[behind] += 1
            found[behind] = self._closed[at[behind]]
            behind = behind[found[behind] < hashes[behind]]
        there = (found == hashes) & (at < len(self.words))
        return np.minimum(at, len(self.words) - 1), there

    def ids(self, hashes: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """Vocabulary place, or ``VOCABULARY`` plus shape."""
        return self.ids_at(*self.find(hashes), shapes)

    def ids_at(self, at: np.ndarray, there: np.ndarray, shapes: np.ndarray) -> np.ndarray:
        """The ids of tokens that :meth:`find` has been asked for."""
        place = self.place[at] if len(self.words) else np.full(len(at), -1, np.int16)
        return np.where(there & (place >= 0), place, VOCABULARY + shapes.astype(np.int16)).astype(np.int16)


def _is_calm(weights: np.ndarray, bias: np.ndarray) -> bool:
    """Whether no sum of states in [-1, 1] by these weights can leave what exp holds in float32."""
    return float(np.abs(weights).sum(axis=-2).max() + np.abs(bias).max()) < 60


def _exp(x: np.ndarray, calm: bool) -> np.ndarray:
    """The exp of each row up to a factor of its own, in place."""
    if not calm:
        x -= x.max(axis=1, keepdims=True)
    return np.exp(x, out=x)


def _softmax(x: np.ndarray, calm: bool) -> np.ndarray:
    """The softmax of each row, in place."""
    _exp(x, calm)
    x *= np.reciprocal(x @ np.ones(x.shape[1], x.dtype))[:, None]
    return x


def _chosen_log(x: np.ndarray, column: np.ndarray, calm: bool) -> np.ndarray:
    """The log of one column's softmax, row by row; ``x`` is used up."""
    if not calm:
        x -= x.max(axis=1, keepdims=True)
    out = x[np.arange(len(x)), column]
    return out - np.log(_exp(x, True) @ np.ones(x.shape[1], x.dtype))


def _by_gate(x: np.ndarray) -> np.ndarray:
    """Columns of the update gate, the reset gate and the candidate as three arrays in one."""
    return np.ascontiguousarray(x.reshape(len(x), 3, HIDDEN).transpose(1, 0, 2))


# What stands in the exp of each gate: 1 / (1 + exp(-x)) twice, and 2 / (1 + exp(-2x)) - 1.
_IN_EXP = np.array([-1, -1, -2], np.float32)[:, None, None]


class Network:
    """The GRU and its output layers; every parameter is one float32 array."""

    SHAPE = {
        "embed": (VOCABULARY + SHAPES, 3 * HIDDEN),
        "again": (HIDDEN, 3 * HIDDEN),
        "to_class": (HIDDEN, FREQUENT + SHAPES),
        "class_bias": (FREQUENT + SHAPES,),
        "to_word": (FREQUENT, HIDDEN, IN_CLASS),
        "word_bias": (FREQUENT, IN_CLASS),
    }

    def __init__(self, p: dict[str, np.ndarray]):
        self.p = p

    @classmethod
    def initial(cls, lexicon: Lexicon) -> Network:
        """Random recurrent weights; output biases that make it the unigram model."""
        rng = np.random.default_rng(0)
        p = {k: (0.1 * rng.standard_normal(s)).astype(np.float32) for k, s in cls.SHAPE.items()}
        frequent = np.zeros(VOCABULARY)
        frequent[: len(lexicon.frequent)] = lexicon.frequent
        grid = frequent.reshape(FREQUENT, IN_CLASS) + 1e-3
        p["word_bias"] = np.log(grid / grid.sum(1, keepdims=True)).astype(np.float32)
        sums = np.concatenate([grid.sum(1), np.maximum(lexicon.shape_total, 0) + 0.5])
        p["class_bias"] = np.log(sums / sums.sum()).astype(np.float32)
        p["to_class"] *= 0.1
        p["to_word"] *= 0.1
        return cls(p)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.p[k].ravel() for k in self.SHAPE])

    @classmethod
    def unflat(cls, values: np.ndarray) -> Network:
        p, at = {}, 0
        for k, shape in cls.SHAPE.items():
            n = int(np.prod(shape))
            p[k] = values[at : at + n].reshape(shape).astype(np.float32)
            at += n
        return cls(p)

    def window(self, ids: np.ndarray, state: np.ndarray, fresh: np.ndarray | None = None):
        """States before each step of ``ids (steps, lanes)``, and the last one.

        With ``fresh``, which tells where a text starts and its state with it, what backpropagation
        needs is kept as well: the gates, and what the reset gate is multiplied with.
        """
        steps, lanes = ids.shape
        embed = _by_gate(self.p["embed"]) * _IN_EXP
        again = _by_gate(self.p["again"]) * _IN_EXP
        named = ids.astype(np.intp)
        given = np.empty((lanes, HIDDEN), np.float32)
        before = np.empty((steps, lanes, HIDDEN), np.float32)
        kept = steps if fresh is not None else 1
        gates = np.empty((kept, 3, lanes, HIDDEN), np.float32)
        candidates = np.empty((kept, lanes, HIDDEN), np.float32)
        starts = fresh.any(axis=1) if fresh is not None else np.zeros(steps, bool)
        with np.errstate(over="ignore"):
            for t in range(steps):
                if starts[t]:
                    state = state.copy()
                    state[fresh[t]] = 0
                before[t] = state
                z, r, hidden = np.matmul(state, again, out=gates[t % kept])
                z += embed[0].take(named[t], axis=0, mode="clip", out=given)
                r += embed[1].take(named[t], axis=0, mode="clip", out=given)
                both = gates[t % kept, :2]
                np.exp(both, out=both)
                both += 1
                np.reciprocal(both, out=both)
                n = np.multiply(r, hidden, out=candidates[t % kept])
                n += embed[2].take(named[t], axis=0, mode="clip", out=given)
                np.exp(n, out=n)
                n += 1
                np.divide(2, n, out=n)
                n -= 1
                state = np.subtract(state, n)
                state *= z
                state += n
        return before, state, (gates, candidates)

    def log_probability(self, before: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Natural log of class, and of the word in it for the vocabulary, row by row."""
        p = self.p
        classes = np.where(ids < VOCABULARY, ids // IN_CLASS, FREQUENT + ids - VOCABULARY)
        out, calm = np.empty(len(ids), np.float32), _is_calm(p["to_class"], p["class_bias"])
        for a in range(0, len(ids), CACHED_ROWS):
            part = slice(a, a + CACHED_ROWS)
            x = before[part] @ p["to_class"]
            x += p["class_bias"]
            out[part] = _chosen_log(x, classes[part], calm)
        order, _, inner = self._inner(before, classes)
        calm = _is_calm(p["to_word"], p["word_bias"])
        out[order] += _chosen_log(inner, ids[order] % IN_CLASS, calm)
        return out

    def _inner(self, before: np.ndarray, classes: np.ndarray):
        """Rows of frequent words by class, where each class begins, and their words' outputs."""
        order = np.argsort(classes.astype(np.int8), kind="stable")
        bounds = np.searchsorted(classes[order], np.arange(FREQUENT + 1)).tolist()
        order = order[: bounds[-1]]
        rows = before.take(order, axis=0)
        inner = np.empty((len(order), IN_CLASS), np.float32)
        for k in range(FREQUENT):
            part = slice(bounds[k], bounds[k + 1])
            if part.start < part.stop:
                np.matmul(rows[part], self.p["to_word"][k], out=inner[part])
                inner[part] += self.p["word_bias"][k]
        return order, bounds, inner

    def gradient(self, ids: np.ndarray, valid: np.ndarray, fresh: np.ndarray, state: np.ndarray):
        """Gradients over one window by backpropagation inside it, and the state after it."""
        p, h = self.p, HIDDEN
        before, after, (gates, n) = self.window(ids, state, fresh)
        g = {k: np.zeros_like(v) for k, v in p.items()}
        whole = bool(valid.all())
        rows = before.reshape(-1, h) if whole else before[valid]
        flat = (ids.ravel() if whole else ids[valid]).astype(np.int64)
        classes = np.where(flat < VOCABULARY, flat // IN_CLASS, FREQUENT + flat - VOCABULARY)
        error = rows @ p["to_class"]
        error += p["class_bias"]
        _softmax(error, _is_calm(p["to_class"], p["class_bias"]))
        error[np.arange(len(flat)), classes] -= 1
        g["to_class"] = rows.T @ error
        g["class_bias"] = np.ones(len(error), np.float32) @ error
        back = error @ p["to_class"].T
        order, bounds, e = self._inner(rows, classes)
        _softmax(e, _is_calm(p["to_word"], p["word_bias"]))
        e[np.arange(len(order)), flat[order] % IN_CLASS] -= 1
        here, inner = rows.take(order, axis=0), np.empty((len(order), h), np.float32)
        for k in range(FREQUENT):
            own = slice(bounds[k], bounds[k + 1])
            if own.start < own.stop:
                g["to_word"][k] = here[own].T @ e[own]
                g["word_bias"][k] = np.ones(own.stop - own.start, np.float32) @ e[own]
                np.matmul(e[own], p["to_word"][k].T, out=inner[own])
        inner += back.take(order, axis=0)
        back[order] = inner
        if whole:
            outer = back.reshape(before.shape)
        else:
            outer = np.zeros_like(before)
            outer[valid] = back
        # What a step hands back is its flow times factors that no flow has a part in.
        z, r, hidden = gates[:, 0], gates[:, 1], gates[:, 2]
        by_z = before - n
        by_z *= z
        by_r = r - 1
        by_r *= np.float32(0.5)
        by_r *= hidden * r
        by_n = 1 - z
        by_z *= by_n
        squares = n * n
        by_n *= np.subtract(1, squares, out=squares)
        hiddens = np.empty((3, *n.shape), n.dtype)
        candidates = np.empty_like(n)
        again = np.ascontiguousarray(_by_gate(p["again"]).transpose(0, 2, 1))
        starts = fresh.any(axis=1)
        flow = np.zeros_like(state)
        for t in range(len(ids) - 1, -1, -1):
            d = flow if whole else np.where(valid[t][:, None], flow, np.float32(0))
            dn = np.multiply(d, by_n[t], out=candidates[t])
            dz, dr, dh = hiddens[:, t]
            np.multiply(d, by_z[t], out=dz)
            np.multiply(dn, by_r[t], out=dr)
            np.multiply(dn, r[t], out=dh)
            flow = d * z[t]
            flow += outer[t]
            for gate in np.matmul(hiddens[:, t], again):
                flow += gate
            if starts[t]:
                flow[fresh[t]] = 0
        known = before.reshape(-1, h).T
        g["again"] = np.concatenate([known @ gate.reshape(-1, h) for gate in hiddens], axis=1)
        named = ids.ravel()
        order = np.argsort(named, kind="stable")
        many = np.bincount(named)
        own = np.flatnonzero(many)
        begin = np.cumsum(many[own]) - many[own]
        inputs = [x.reshape(-1, h).take(order, axis=0) for x in (hiddens[0], hiddens[1], candidates)]
        g["embed"][own] = np.concatenate([np.add.reduceat(x, begin) for x in inputs], axis=1)
        return g, after, len(flat)


def _streams(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts, one behind the other, in lanes of like length, the longest lane first.

    Ids, which of them are there, and where a state starts: with each text, and with each stretch of
    a longer one, so that a long text is trained on beside others and not in a lane alone.
    """
    parts = [x[i : i + STRETCH] for x in texts for i in range(0, len(x), STRETCH)]
    parts = [parts[i] for i in np.random.default_rng(1).permutation(len(parts))]
    # Longer stretches go first, so that lanes come out even; a lane's own order is mixed again.
    wanted = sum(map(len, parts)) // (WINDOW * LANE_WINDOWS)
    loads = [(0, i) for i in range(min(LANES, max(wanted, 16), len(parts)))]
    own: list[list[int]] = [[] for _ in loads]
    for i in sorted(range(len(parts)), key=lambda i: -len(parts[i])):
        load, lane = loads[0]
        own[lane].append(i)
        heapq.heapreplace(loads, (load + len(parts[i]), lane))
    order = sorted(own, key=lambda lane: -sum(len(parts[i]) for i in lane))
    lanes = [[parts[i] for i in sorted(lane)] for lane in order]
    grid, valid = _grid([np.concatenate(lane) for lane in lanes])
    fresh = np.zeros(grid.shape, bool)
    for i, lane in enumerate(lanes):
        fresh[np.cumsum([0] + [len(x) for x in lane[:-1]]), i] = True
    return grid, valid, fresh


def train_on(network: Network, texts: list[np.ndarray]) -> int:
    """Adam over windows of all texts in lanes; returns the tokens seen."""
    flat, at = network.flat(), 0
    # The parameters become views of one vector, which Adam moves as a whole.
    for k in network.SHAPE:
        size = network.p[k].size
        network.p[k] = flat[at : at + size].reshape(network.p[k].shape)
        at += size
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    step = seen = 0
    grid, valid, fresh = _streams(texts)
    state = np.zeros((grid.shape[1], HIDDEN), np.float32)
    for t in range(0, len(grid), WINDOW):
        active = int(valid[t].sum())
        part = slice(t, t + WINDOW), slice(0, active)
        g, state, n = network.gradient(grid[part], valid[part], fresh[part], state[:active])
        step += 1
        seen += n
        slope = np.concatenate([g[k].ravel() for k in network.SHAPE])
        slope *= 8 / n
        np.clip(slope, -1, 1, out=slope)
        first *= 0.9
        first += 0.1 * slope
        slope *= slope
        second *= 0.99
        second += 0.01 * slope
        scale = np.sqrt(second / (1 - 0.99**step))
        scale += 1e-6
        flat -= (RATE / (1 - 0.9**step)) * first / scale
    return seen


def _grid(lanes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts, longest first, as columns of a padded grid."""
    lengths = np.array([len(x) for x in lanes])
    grid = np.zeros((lengths.max(), len(lanes)), np.int16)
    for i, x in enumerate(lanes):
        grid[: len(x), i] = x
    return grid, np.arange(len(grid))[:, None] < lengths


def score_batch(network: Network, texts: list[np.ndarray]) -> np.ndarray:
    """The sum of :meth:`Network.log_probability` over each whole text."""
    out = np.zeros(len(texts))
    order = np.array(sorted(range(len(texts)), key=lambda i: -len(texts[i])), np.int64)
    for base in range(0, len(order), SCORE_LANES):
        own = order[base : base + SCORE_LANES]
        lengths = np.array([len(texts[i]) for i in own])
        ids = np.concatenate([texts[i] for i in own])
        begin = np.cumsum(lengths) - lengths
        state = np.zeros((len(own), HIDDEN), np.float32)
        for t in range(0, int(lengths[0]), WINDOW):
            active = int((lengths > t).sum())
            steps = np.arange(t, min(t + WINDOW, int(lengths[0])))[:, None]
            grid = ids.take(begin[:active] + steps, mode="clip")
            before, state, _ = network.window(grid, state[:active])
            held = np.flatnonzero(steps < lengths[:active])
            logs = network.log_probability(
                before.reshape(-1, HIDDEN).take(held, axis=0), grid.ravel()[held].astype(np.int64)
            )
            out[own[:active]] += np.bincount(held % active, logs, minlength=active)
    return out


def _texts(column: pa.Array, lexicon: Lexicon) -> list[np.ndarray]:
    out = []
    for a, b in slices(column, SLICE_BYTES):
        hashes, shapes, counts = tokens(column.slice(a, b - a))
        out += np.split(lexicon.ids(hashes, shapes), np.cumsum(counts)[:-1])
    return out


def train_network(docs: DataFrame, lexicon: Broadcasted, first: Network) -> Network:
    """Rounds of training in every task and averaging, weighted by tokens.

    A task's rows are dealt to the rounds by their place, so copies of a text are in all of them
    and each row is trained on in exactly one. The weights therefore depend on how rows lie in
    tasks: more tasks see less each, and their average moves less far from the first weights.
    """
    spark = docs.sparkSession
    network = first
    texts = docs.select("text")
    size = len(network.flat()) + 1
    cells = -(-size // 64) * 64
    for turn in range(ROUNDS):
        sent = Broadcasted(spark, network.flat())

        def run(batches: Iterator[pa.RecordBatch], sent=sent, turn=turn) -> Iterator[pa.RecordBatch]:
            one_thread()
            keep_freed()
            own, seen, rows = Network.unflat(sent.value), 0, 0
            held, waiting = [], 0
            for batch in batches:
                place = np.arange(rows, rows + batch.num_rows)
                rows += batch.num_rows
                mine = batch.filter(pa.array(place % ROUNDS == turn))
                made = _texts(mine.column(0), lexicon.value) if mine.num_rows else []
                held += made
                waiting += sum(map(len, made))
                if waiting >= HELD_TOKENS:
                    seen += train_on(own, held)
                    held, waiting = [], 0
            if held:
                seen += train_on(own, held)
            held = []
            if seen:
                sums = np.zeros(cells, np.int64)
                sums[: size - 1] = np.rint(own.flat().astype(np.float64) * seen * _FIXED)
                sums[size - 1] = seen
                made = array_pieces(sums)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(made["piece"], pa.int32()), pa.array(made["data"], pa.binary())],
                    names=["piece", "data"],
                )
            release()

        raw = b"".join(sum_arrays(texts.mapInArrow(run, "piece int, data binary")))
        if not raw:
            break
        sums = np.frombuffer(raw, np.int64)
        network = Network.unflat(sums[: size - 1] / (sums[size - 1] * _FIXED))
    return network


def score(docs: DataFrame, carry: list[str], held_out: Column) -> DataFrame:
    """``carry`` columns and the scores of every document, learned where ``held_out`` is false.

    Adds ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``,
    both in log10. Null and empty texts are one end token. Without training documents the base
    score is 0 for every token and the network is untrained. A null ``held_out`` counts as false.
    Rows that repeat count, and are scored, each on its own; a carried column named like one of
    ours gives way to it. Very long texts are read window by window, with the state carried on.
    All but ``score`` are the same for any partitioning; ``score`` depends on it as the network's
    weights do.
    """
    spark = docs.sparkSession
    own = ("held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    names = [c for c in dict.fromkeys(carry) if c not in own]
    held = [f"_c{i}" for i in range(len(names))]
    rows = docs.select(
        *[F.col(f"`{c}`").alias(h) for c, h in zip(names, held, strict=True)],
        F.coalesce(held_out, F.lit(False)).alias("_out"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    training = rows.filter(~F.col("_out"))
    counts = staged(count_words(training), "counts")
    known = Lexicon(counts)
    is_rare = known.is_rare
    del known.is_rare
    lexicon = Broadcasted(spark, known)
    network = train_network(training, lexicon, Network.initial(known))
    sent = Broadcasted(spark, network.flat())

    def work(batch):
        one_thread()
        keep_freed()
        lex, net = lexicon.value, Network.unflat(sent.value)
        column = batch.column(batch.schema.get_field_index("text"))
        n = batch.num_rows
        sums = {k: np.zeros(n) for k in ("known", "base", "more")}
        total = np.zeros(n, np.int64)
        room = np.log10(lex.shape_total + 0.5 * (lex.shape_distinct + 1))
        ids: list[np.ndarray] = []
        rare: list[np.ndarray] = []
        for a, b in slices(column, SLICE_BYTES):
            hashes, shapes, lengths = tokens(column.slice(a, b - a))
            owner = np.repeat(np.arange(a, b), lengths)
            at, there = lex.find(hashes)
            own_ids = lex.ids_at(at, there, shapes)
            logs = np.zeros(len(hashes))
            if there.any():
                logs[there] = lex.logs[at[there]]
            outside = own_ids >= VOCABULARY
            total[a:b] = lengths
            sums["known"] += np.bincount(owner, there, minlength=n)
            sums["base"] += np.bincount(owner, logs, minlength=n)
            sums["more"] += np.bincount(
                owner[outside],
                logs[outside] - room[own_ids[outside] - VOCABULARY],
                minlength=n,
            )
            ids += np.split(own_ids, np.cumsum(lengths)[:-1])
            cut = np.searchsorted(owner[~there], np.arange(a + 1, b))
            rare += np.split(hashes[~there].view(np.int64), cut)
        yield {
            "n_tokens": total,
            "n_known": sums["known"].astype(np.int64),
            "base": sums["base"],
            "model": score_batch(net, ids) / np.log(10) + sums["more"],
            "rare": pa.array(rare, pa.list_(pa.int64())),
        }

    made = map_batches(
        rows,
        work,
        "n_tokens long, n_known long, base double, model double, rare array<bigint>",
        [*held, "_out"],
    )
    scored = staged(made.withColumn("_row", F.monotonically_increasing_id()), "scored")
    wanted = scored.select("_row", F.explode("rare").alias("w"))
    found = wanted.join(counts.filter(is_rare).select("w", "c"), "w", "left")
    rest = found.groupBy("_row").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rest"),
        F.count("c").alias("more"),
    )
    norm = float(np.log10(known.total + 0.5 * (known.distinct + 1)))
    extra = F.coalesce("rest", F.lit(0.0))
    return (
        scored.drop("rare")
        .join(rest, "_row", "left")
        .select(
            *[F.col(h).alias(c) for h, c in zip(held, names, strict=True)],
            F.col("_out").alias("held_out"),
            "n_tokens",
            (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
            F.lit(known.total).cast("long").alias("train_tokens"),
            (F.col("base") + extra - F.col("n_tokens") * norm).alias("base_score"),
            (F.col("model") + extra).alias("score"),
        )
    )
