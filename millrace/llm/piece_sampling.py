"""Distinct sampled segmentations over the piece lattice, by Gumbel top-k.

The lattice of a text falls apart before each run of word marks, so a text's segmentations are the products of
its words' ones; word lattices are built once per distinct word of a batch. A search region is a
set of whole paths with a perturbed value: the first arrival of a Poisson process whose rate is the
region's probability. The best region is opened first (A*), its best path leaves it, and what is
left splits in two regions with lower values. Random numbers depend on the row key and the place in
the text only, so results do not depend on batches, tasks or retries.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Broadcasted, keep_freed, map_batches
from millrace.llm.words import mix, powers, slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
SAMPLES = 2
# A piece of merge rank r weighs 1 / (r + OFFSET); a fallback byte counts as the last rank.
OFFSET = 3.0
# Words are shared within a slice of so many bytes of text, which bounds a task's memory.
SLICE = 600_000
# A word mark that stands in a text itself; blanks are what marks stand for elsewhere.
OWN_MARK = (1 << 21) - 1


@dataclass
class Pieces:
    """The piece vocabulary as a trie in a hash table; its size is that of the model file."""

    keys: np.ndarray
    nodes: np.ndarray
    spread: int
    piece: np.ndarray
    inner: np.ndarray
    weight: np.ndarray
    byte: np.ndarray
    text: list[bytes]

    @classmethod
    def load(cls, path: str = MODEL) -> Pieces:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        text, byte = [b""] * size, np.zeros(256, np.int64)
        weight = np.full(size, -math.log(size + OFFSET))
        children: dict[tuple[int, int], int] = {}
        piece = [-1]
        for i in range(size):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                byte[int(name[1:-1], 16)] = i
                text[i] = bytes([int(name[1:-1], 16)])
            elif not (model.is_control(i) or model.is_unknown(i) or MARK in name.lstrip(MARK)):
                text[i] = name.replace(MARK, " ").encode()
                weight[i] = -math.log(OFFSET - model.get_score(i))
                node = 0
                for c in name:
                    node = children.setdefault((node, ord(c)), len(piece))
                    if node == len(piece):
                        piece.append(-1)
                piece[node] = i
        keys = np.array([n << 21 | c for n, c in children], np.int64)
        nodes = np.array(list(children.values()), np.int64)
        inner = np.zeros(len(piece), bool)
        inner[keys >> 21] = True
        # At most a quarter of the slots is taken; a key goes to the first free one from its own on.
        bits = max(4, (4 * len(keys)).bit_length())
        slots, held = np.full(1 << bits, -1, np.int64), np.full(1 << bits, -1, np.int64)
        at, left = cls._slot(keys, 64 - bits), np.arange(len(keys))
        while len(left):
            free = left[slots[at[left]] < 0]
            slots[at[free]] = keys[free]
            own = free[slots[at[free]] == keys[free]]
            held[at[own]] = nodes[own]
            left = np.setdiff1d(left, own, assume_unique=True)
            at[left] = (at[left] + 1) & (len(slots) - 1)
        return cls(slots, held, 64 - bits, np.array(piece), inner, weight, byte, text)

    @staticmethod
    def _slot(key: np.ndarray, spread: int) -> np.ndarray:
        mixed = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(spread)).astype(np.int64)

    def step(self, node: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The child of each node by a character, or -1."""
        key = node << 21 | char
        at = self._slot(key, self.spread)
        found = self.keys[at]
        out = np.where(found == key, self.nodes[at], -1)
        left = np.flatnonzero((found != key) & (found >= 0))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            found = self.keys[at[left]]
            hit = found == key[left]
            out[left[hit]] = self.nodes[at[left[hit]]]
            left = left[~hit & (found >= 0)]
        return out

    def decode(self, ids) -> str:
        raw = b"".join([self.text[i] for i in ids])
        return raw[1:].decode("utf-8", "replace") if raw else ""

    def decode_to(self, texts: list[str], own: list[int], ids) -> list[bool]:
        """Whether each list of piece ids decodes to the text that ``own`` names."""
        wanted = [f" {t}".encode("utf-8", "replace") if t else b"" for t in texts]
        table = pa.array(self.text, pa.large_binary())
        ends = np.cumsum([len(x) for x in ids])
        flat = table.take(pa.array(np.concatenate([np.asarray(x, np.int64) for x in ids])))
        at = np.frombuffer(flat.buffers()[1], np.int64)[flat.offset :][np.append(0, ends)]
        raw = memoryview(flat.buffers()[2] or b"").cast("B")
        return [
            raw[a:b] == wanted[i] for i, a, b in zip(own, at[:-1].tolist(), at[1:].tolist(), strict=True)
        ]


@dataclass
class Lattices:
    """Edges of distinct words, sorted by source node; a word's nodes are consecutive.

    ``pieces`` of an edge is a start and end in ``ids``: one piece, or the bytes of a character.
    """

    first: np.ndarray
    start: np.ndarray
    target: np.ndarray
    ids: np.ndarray
    id_start: np.ndarray
    share: np.ndarray
    upto: np.ndarray
    last: np.ndarray


def build_lattices(chars: np.ndarray, bounds: np.ndarray, pieces: Pieces) -> Lattices:
    """The lattices of words ``chars[bounds[i]:bounds[i + 1]]``, each one node longer than it."""
    n = len(chars)
    end = np.repeat(bounds[1:], np.diff(bounds))
    found = []
    where, node, size = np.arange(n), np.zeros(n, np.int64), 0
    while len(where):
        node = pieces.step(node, chars.take(where + size))
        size += 1
        go = np.flatnonzero(node >= 0)
        where, node = where.take(go), node.take(go)
        name = pieces.piece.take(node)
        hit = np.flatnonzero(name >= 0)
        found.append((where.take(hit), size, name.take(hit)))
        go = np.flatnonzero(pieces.inner.take(node) & (end.take(where) > where + size))
        where, node = where.take(go), node.take(go)
    # A node has one edge of a size at most; what has none of one character gets its bytes.
    fan = np.zeros(n, np.int64)
    for source, _, _ in found:
        fan[source] += 1
    short = np.zeros(n, bool)
    for source, _, _ in found[:1]:
        short[source] = True
    spelled = np.flatnonzero(~short)
    raws = [
        MARK.encode() if c == OWN_MARK else chr(c).encode("utf-8", "replace")
        for c in chars[spelled].tolist()
    ]
    fan[spelled] += 1
    start = np.concatenate([[0], np.cumsum(fan)])
    # Longest first leaves each node's likeliest edge near the front.
    free = start[:-1].copy()
    target, name = np.empty(start[-1], np.int64), np.zeros(start[-1], np.int64)
    for where, size, names in reversed(found):
        at = free.take(where)
        target[at], name[at] = where + size, names
        free[where] = at + 1
    at = free[spelled]
    target[at] = spelled + 1
    source = np.repeat(np.arange(n), fan)
    weight = pieces.weight.take(name)
    many = np.ones(len(name), np.int64)
    many[at] = size = np.array([len(r) for r in raws], np.int64)
    weight[at] = size * pieces.weight[pieces.byte[0]]
    id_start = np.concatenate([[0], np.cumsum(many)])
    ids = np.repeat(name, many)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    ids[np.repeat(id_start[at], size) + inside] = pieces.byte[np.frombuffer(b"".join(raws), np.uint8)]
    last = target == end[source] if n else np.zeros(0, bool)
    # Log mass of all ways from a node to its word's end, by falling place in the word; place n
    # stands for every end.
    mass = np.zeros(n + 1)
    goal = np.where(last, n, target)
    left = end - np.arange(n)
    # Small numbers are sorted by their digits.
    narrow = left.astype(np.int16) if n and left.max() < 1 << 15 else left
    by_left = np.argsort(narrow, kind="stable")
    nodes_at = np.concatenate([[0], np.cumsum(np.bincount(left, minlength=1)[1:])])
    width = fan[by_left]
    begin = np.concatenate([[0], np.cumsum(width)])
    e = np.repeat(start[by_left] - begin[:-1], width) + np.arange(len(source))
    weight_of, goal_of = weight.take(e), goal.take(e)
    for a, b in zip(nodes_at[:-1].tolist(), nodes_at[1:].tolist(), strict=True):
        if a == b:
            continue
        part = slice(begin[a], begin[b])
        value = weight_of[part] + mass[goal_of[part]]
        offset = begin[a:b] - begin[a]
        top = np.maximum.reduceat(value, offset)
        value -= np.repeat(top, width[a:b])
        mass[by_left[a:b]] = top + np.log(np.add.reduceat(np.exp(value, out=value), offset))
    share = np.minimum(weight + mass[goal] - mass[source], 0.0)
    sums = np.concatenate([[0], np.cumsum(np.exp(share))])
    upto = source + np.minimum(sums[1:] - sums[start[source]], 1.0)
    # A node's last edge takes what rounding leaves.
    upto[start[1:] - 1] = np.arange(n) + 1.0
    return Lattices(bounds[:-1], start, target, ids, id_start, share, upto, last)


def _uniform(seed: np.ndarray, mixed: np.ndarray) -> np.ndarray:
    x = mix(seed + mixed)
    x >>= np.uint64(11)
    out = x.astype(np.float64)
    out += 0.5
    out *= 2.0**-53
    return out


def _walk(lat: Lattices, words: np.ndarray, seed: np.ndarray, place: np.ndarray, walk: int):
    """One sampled path through each word: its edges in order, and where each word's begin."""
    live = np.arange(len(words))
    node = lat.first.take(words)
    mixed = mix(place.astype(np.uint64) * np.uint64(1021) + np.uint64(walk + 1))
    lines, edges, step = [], [], 0
    while len(live):
        u = _uniform(seed + np.uint64(step * 2654435761), mixed)
        u += node
        e = lat.start.take(node)
        past = np.flatnonzero(lat.upto.take(e) < u)
        while len(past):
            next_one = e.take(past) + 1
            e[past] = next_one
            past = past.take(np.flatnonzero(lat.upto.take(next_one) < u.take(past)))
        lines.append(live)
        edges.append(e)
        go = np.flatnonzero(~lat.last.take(e))
        live, node, step = live.take(go), lat.target.take(e.take(go)), step + 1
        seed, mixed = seed.take(go), mixed.take(go)
    # Live words become fewer step by step: a word of s steps stands in the first s lists.
    steps = np.zeros(len(words), np.int64)
    for line in lines:
        steps[line] += 1
    begin = np.concatenate([[0], np.cumsum(steps)])
    out = np.empty(begin[-1], np.int64)
    for step, (line, edge) in enumerate(zip(lines, edges, strict=True)):
        out[begin.take(line) + step] = edge
    return out, begin


@dataclass(order=True)
class _Region:
    """Paths that agree with ``path`` before ``fork`` and leave it there or later.

    ``gone`` are subtrees ``(place, edge)`` taken out; ``arrival`` orders the search.
    """

    arrival: float
    tie: int
    path: np.ndarray = field(compare=False)
    word: np.ndarray = field(compare=False)
    fork: int = field(compare=False)
    gone: list[tuple[int, int, float]] = field(compare=False)
    leave: np.ndarray = field(compare=False)


def _leaving(lat: Lattices, path: np.ndarray, fork: int) -> np.ndarray:
    """The probability of leaving ``path`` first at each place from ``fork`` on."""
    share = lat.share[path]
    before = np.concatenate([[0.0], np.cumsum(share)[:-1]])
    leave = np.exp(before) * -np.expm1(share)
    leave[:fork] = 0
    return leave


def _sample(lat: Lattices, walks: list, seed: int, count: int) -> list[tuple]:
    """Up to ``count`` distinct paths of one text, best first, and the next arrival."""
    rng = np.random.default_rng(seed)
    edges, bounds = walks[0]
    word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    found, heap, tie = [], [], 0
    arrival = rng.exponential()

    def push(base: float, path, word, fork: int, gone: list, leave: np.ndarray) -> None:
        nonlocal tie
        rate = float(leave.sum())
        if rate > 1e-300:
            tie += 1
            heapq.heappush(heap, _Region(base + rng.exponential() / rate, tie, path, word, fork, gone, leave))

    found.append((arrival, edges))
    push(arrival, edges, word, 0, [], _leaving(lat, edges, 0))
    while heap and len(found) < count:
        region = heapq.heappop(heap)
        chances = np.cumsum(region.leave)
        d = int(np.searchsorted(chances, rng.random() * chances[-1], "right"))
        d = min(d, int(np.flatnonzero(region.leave)[-1]))
        old = int(region.path[d])
        node = int(np.searchsorted(lat.start, old, "right")) - 1
        out = [e for e in range(int(lat.start[node]), int(lat.start[node + 1])) if e != old]
        taken = {e for p, e, _ in region.gone if p == d}
        out = [e for e in out if e not in taken]
        odds = np.cumsum([math.exp(lat.share[e]) for e in out])
        e = out[min(int(np.searchsorted(odds, rng.random() * odds[-1], "right")), len(out) - 1)]
        tail = [e]
        while not lat.last[tail[-1]]:
            node = int(lat.target[tail[-1]])
            a, b = int(lat.start[node]), int(lat.start[node + 1])
            ways = np.cumsum(np.exp(lat.share[a:b]))
            tail.append(a + min(int(np.searchsorted(ways, rng.random() * ways[-1], "right")), b - a - 1))
        w = int(region.word[d])
        fresh, fresh_at = walks[len(found)]
        rest = fresh[fresh_at[w + 1] :]
        path = np.concatenate([region.path[:d], tail, rest]).astype(np.int64)
        words = np.concatenate(
            [region.word[:d], np.full(len(tail), w), np.repeat(np.arange(w + 1, len(fresh_at) - 1), np.diff(fresh_at[w + 1 :]))]
        )
        found.append((region.arrival, path))
        mass = math.exp(float(lat.share[region.path[:d]].sum() + lat.share[e]))
        leave = region.leave.copy()
        leave[d] = max(leave[d] - mass, 0.0)
        if len(out) == 1:
            leave[d] = 0.0
        push(region.arrival, region.path, region.word, region.fork, [*region.gone, (d, e, mass)], leave)
        push(region.arrival, path, words, d + 1, [], _leaving(lat, path, d + 1))
    return [*found, (heap[0].arrival if heap else math.inf, None)]


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all texts with their leading mark, word bounds, and words per text."""
    marked = [" " + t if t else "" for t in texts]
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = chars.astype(np.int64)
    blank = chars == 32
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in marked], dtype=np.int64)])
    # A run of blanks stays with the word behind it, for pieces of several blanks.
    begins = blank.copy()
    begins[1:] &= ~blank[:-1]
    begins[bounds[:-1][np.diff(bounds) > 0]] = True
    begin = np.flatnonzero(begins)
    first = np.searchsorted(begin, bounds)
    chars[chars == ord(MARK)] = OWN_MARK
    chars[blank] = ord(MARK)
    return chars, np.append(begin, len(chars)), first


def log_inclusion(log_p: float, limit: float) -> float:
    """Log of the chance that a path of probability ``exp(log_p)`` arrives before ``limit``.

    A long text's path has a chance too small for a double, but not too small for its log.
    """
    if math.isinf(limit):
        return 0.0
    log_odds = log_p + math.log(limit)
    return log_odds if log_odds < -30 else math.log(-math.expm1(-math.exp(log_odds)))


def _batch(texts: list[str], seeds: np.ndarray, pieces: Pieces, samples: int) -> list[list[tuple]]:
    chars, bounds, first = _words(texts)
    count = len(bounds) - 1
    if not count:
        return [[(0, [], 0.0, 0.0, 0.0)] for _ in texts]
    values = (chars.astype(np.uint64) + np.uint64(1)) * powers(len(chars))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    names = (sums[bounds[1:]] - sums[bounds[:-1]]) * powers(len(chars) + 1, True)[bounds[:-1]]
    which = pa.array(names).dictionary_encode().indices.to_numpy()
    one = np.empty(int(which.max()) + 1, np.int64)
    one[which[::-1]] = np.arange(len(which) - 1, -1, -1)
    size = bounds[one + 1] - bounds[one]
    starts = np.concatenate([[0], np.cumsum(size)])
    own = chars[np.repeat(bounds[one] - starts[:-1], size) + np.arange(starts[-1])]
    lat = build_lattices(own, starts, pieces)
    text = np.repeat(np.arange(len(texts)), np.diff(first))
    place = np.arange(count) - first[text]
    walks = [_walk(lat, which, seeds[text], place, w) for w in range(samples)]
    out, paths = [], []
    for i in range(len(texts)):
        a, b = first[i], first[i + 1]
        if a == b:
            out.append([(0, [], 0.0, 0.0, 0.0)])
            continue
        mine = [(e[at[a] : at[b]], at[a : b + 1] - at[a]) for e, at in walks]
        found = _sample(lat, mine, int(seeds[i]), samples)
        limit = found[-1][0]
        rows = []
        for rank, (arrival, path) in enumerate(found[:-1]):
            log_p = float(lat.share[path].sum())
            rows.append((rank, len(paths), log_p, -math.log(arrival), log_inclusion(log_p, limit)))
            paths.append(path)
        out.append(rows)
    ids = _ids(lat, paths)
    return [[(rank, ids[at] if at != [] else at, *rest) for rank, at, *rest in rows] for rows in out]


def _ids(lat: Lattices, paths: list[np.ndarray]) -> list[np.ndarray]:
    """The piece ids of each path."""
    path = np.concatenate(paths)
    begin = lat.id_start.take(path)
    many = lat.id_start.take(path + 1) - begin
    after = np.concatenate([[0], np.cumsum(many)])
    ids = lat.ids.take(np.repeat(begin - after[:-1], many) + np.arange(after[-1]))
    ends = np.cumsum([len(p) for p in paths])
    return np.split(ids, after[ends[:-1]])


def sample_segmentations(
    docs: DataFrame,
    carry: list[str],
    samples: int = SAMPLES,
    id_column: str = "doc_id",
    model: str = MODEL,
) -> DataFrame:
    """``carry`` columns and up to ``samples`` distinct segmentations of every whole text.

    Adds ``sample`` (from 0, best first), ``ids``, ``round_trip`` (whether they decode to the text),
    ``log_probability``, ``perturbed`` (its Gumbel value) and ``inclusion`` (the chance of being
    drawn before the first one left out, 0 where a double cannot hold it) with its
    ``log_inclusion``. Null and empty texts have one segmentation without pieces. A text with fewer
    segmentations has fewer rows. Equal ids and texts get equal samples, so repeated rows do.
    Characters outside the vocabulary, and a word mark of the text's own, become bytes. A very long
    text is one slice: its lattice takes some hundred bytes a character in one task. An empty
    table gives no rows. A carried column named like one of ours gives way to it.
    """
    own = ("sample", "ids", "round_trip", "log_probability", "perturbed", "inclusion", "log_inclusion")
    names = [c for c in dict.fromkeys(carry) if c not in own]
    held = [f"_c{i}" for i in range(len(names))]
    sent = Broadcasted(docs.sparkSession, Pieces.load(model))
    rows = docs.select(
        *[F.col(f"`{c}`").alias(h) for c, h in zip(names, held, strict=True)],
        F.xxhash64(F.col(id_column)).alias("_seed"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def work(batch):
        keep_freed()
        texts = batch.column(batch.schema.get_field_index("text"))
        seeds = batch.column(batch.schema.get_field_index("_seed")).to_numpy().view(np.uint64)
        for a, b in slices(texts, SLICE):
            given = texts.slice(a, b - a).to_pylist()
            found = _batch(given, seeds[a:b], sent.value, samples)
            flat = [(i, *row) for i, own_rows in enumerate(found, a) for row in own_rows]
            at, rank, ids, log_p, perturbed, included = zip(*flat, strict=True)
            lengths = [len(x) for x in ids]
            yield {
                "_rows": np.array(at),
                "sample": rank,
                "round_trip": sent.value.decode_to(given, [i - a for i in at], ids),
                "ids": pa.ListArray.from_arrays(
                    pa.array(np.cumsum([0, *lengths]), pa.int32()),
                    pa.array(np.concatenate([np.asarray(x, np.int32) for x in ids])),
                ),
                "log_probability": log_p,
                "perturbed": perturbed,
                "inclusion": np.exp(included),
                "log_inclusion": included,
            }

    made = map_batches(
        rows,
        work,
        "sample int, ids array<int>, round_trip boolean, log_probability double, perturbed double, "
        "inclusion double, log_inclusion double",
        held,
    )
    return made.select(*[F.col(h).alias(c) for h, c in zip(held, names, strict=True)], *own)


def decode(rows: DataFrame, ids: str = "ids", into: str = "decoded", model: str = MODEL) -> DataFrame:
    """``rows`` with the text of their piece ids; null ids give a null text."""
    sent = Broadcasted(rows.sparkSession, Pieces.load(model))

    def work(batch):
        lists = batch.column(batch.schema.get_field_index(ids)).to_pylist()
        yield {into: [None if x is None else sent.value.decode(x) for x in lists]}

    return map_batches(rows, work, f"{into} string", [c for c in rows.columns if c != into])
