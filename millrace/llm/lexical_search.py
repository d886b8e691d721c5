"""Ranked lexical search with hashed max-sketches.

A term's impact in a document depends on its count there and on the document's length alone. All
impacts of a document are folded into a fixed number of coordinates, each holding the largest of
the terms that hash there. Looking up a block of queries in the sketches of many documents is one
matrix product, and gives every document an upper bound of its score. Documents are then scored
exactly in descending order of their bounds, until no bound reaches the worst of the best so far.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.shared import Broadcasted, _arrow, _column, array_pieces, release, sum_arrays
from millrace.llm.words import slices, split_words

# Fixed value: bytes that end a term, those of [\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F].
BETWEEN = np.zeros(256, bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    BETWEEN[_a : _b + 1] = True

BEST = 20
COORDINATES = 2048
# A block of queries: about so many items and bytes of their texts.
BLOCK_ITEMS = 512
BLOCK_BYTES = 4_000_000
# Pairs of a document and a query term looked up at once.
LOOKUPS = 500_000
# Lists of a query are merged in so many groups before the last merge.
MERGES = 64
_LAST = np.iinfo(np.int64).max


@dataclass
class _Entries:
    """Distinct terms of some consecutive texts, by text: text, hash, occurrences."""

    text: np.ndarray
    term: np.ndarray
    count: np.ndarray
    lengths: np.ndarray


def _terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and text of every term, and the number of terms of each text."""
    words = split_words(texts, lower=True, blank=BETWEEN)
    return words.hashes(), words.text_of_word, words.counts


def _entries(texts: pa.Array) -> _Entries:
    hashes, owner, lengths = _terms(texts)
    names, place = np.unique(hashes, return_inverse=True)
    keys, count = np.unique(owner * max(len(names), 1) + place, return_counts=True)
    text, place = np.divmod(keys, max(len(names), 1))
    return _Entries(text, names[place], count, lengths)


@dataclass
class _Block:
    """Queries of a block: ``terms`` are the sorted hashes of all their terms."""

    ids: list
    terms: np.ndarray
    of_item: list[tuple[np.ndarray, np.ndarray]]  # places in ``terms`` and occurrences

    @classmethod
    def of(cls, ids: list, texts: list[str | None]) -> _Block:
        hashes, owner, lengths = _terms(pa.array(texts, pa.string()))
        terms, place = np.unique(hashes, return_inverse=True)
        ends = np.concatenate([[0], np.cumsum(lengths)])
        parts = [np.unique(place[a:b], return_counts=True) for a, b in zip(ends[:-1], ends[1:], strict=True)]
        return cls(ids, terms, parts)


def _found(terms: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which hashes are among the sorted ``terms``, and where."""
    if not len(terms):
        return np.zeros(len(hashes), bool), np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
    return terms[at] == hashes, at


def statistics(docs: DataFrame, terms: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Documents with a term, all their terms, and how many documents hold each of ``terms``.

    A task sends one array of as many counts as ``terms``, which a block of queries bounds.
    """
    sent = Broadcasted(docs.sparkSession, terms)
    cells = -(-(len(terms) + 2) // 64) * 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = sent.value
        sums = np.zeros(cells, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts):
                hashes, owner, lengths = _terms(texts.slice(a, b - a))
                here, at = _found(wanted, hashes)
                held = np.unique(owner[here] * max(len(wanted), 1) + at[here]) % max(len(wanted), 1)
                sums[2:] += np.bincount(held, minlength=cells - 2)
                sums[0] += np.count_nonzero(lengths)
                sums[1] += int(lengths.sum())
        made = array_pieces(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(made["piece"], pa.int32()), pa.array(made["data"], pa.binary())],
            names=["piece", "data"],
        )
        release()

    blobs = docs.select(F.col("text").cast("string")).mapInArrow(run, "piece int, data binary")
    sums = np.frombuffer(b"".join(sum_arrays(blobs)) or bytes(8 * cells), np.int64)
    return int(sums[0]), int(sums[1]), sums[2 : 2 + len(terms)]


def term_weights(n_docs: int, held: np.ndarray) -> np.ndarray:
    """``floor(1000 ln((2N+2)/(2df+1)))`` of each term."""
    return np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in held.tolist()], np.int64
    )


def impacts(count: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term adds for each unit of its weight, from its occurrences and the text's length."""
    norm = 100 - 25 + 25 * length * n_docs // max(n_terms, 1)
    return 1_000_000_000 * count // (1000 * count + 12 * norm)


def sketches(entries: _Entries, impact: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of coordinatewise maxima for each text."""
    out = np.zeros((len(entries.lengths), coordinates))
    place = (entries.term % np.uint64(coordinates)).astype(np.int64)
    np.maximum.at(out.reshape(-1), entries.text * coordinates + place, impact)
    return out


@dataclass
class _Searcher:
    """A block of queries with its weights; keeps the best of a task for each query."""

    block: _Block
    weights: np.ndarray
    n_docs: int
    n_terms: int
    best: int
    coordinates: int

    def __post_init__(self):
        # Coordinates that the block looks up, and each query's weight there.
        place = (self.block.terms % np.uint64(self.coordinates)).astype(np.int64)
        self.used, at = np.unique(place, return_inverse=True)
        self.lookup = np.zeros((len(self.used), len(self.block.ids)))
        self.pay = []
        for i, (terms, times) in enumerate(self.block.of_item):
            pay = self.weights[terms] * times
            np.add.at(self.lookup[:, i], at[terms], pay)
            self.pay.append(pay)
        self.tops = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in self.block.ids]
        # A score must reach this to enter the best; 1 while there is room.
        self.least = np.ones(len(self.block.ids), np.int64)
        self.rescored = 0

    def add(self, texts: pa.Array, ids: np.ndarray) -> None:
        found = _entries(texts)
        impact = impacts(found.count, found.lengths[found.text], self.n_docs, self.n_terms)
        sketch = sketches(found, impact, self.coordinates)
        # Sums are whole numbers; the margin covers those too large for a double to hold exactly.
        bounds = sketch[:, self.used] @ self.lookup * (1 + 1e-9)
        here, at = _found(self.block.terms, found.term)
        size = max(len(self.block.terms), 1)
        keys, impact = found.text[here] * size + at[here], impact[here]
        if not len(keys):
            return
        order = np.argsort(keys)
        keys, impact = keys[order], impact[order]
        for item in np.flatnonzero((bounds >= self.least).any(axis=0)).tolist():
            self._rescore(item, bounds[:, item], ids, keys, impact, size)

    def _rescore(self, item, bounds, ids, keys, impact, size) -> None:
        """Exact scores in descending order of bounds, until no bound reaches the worst kept."""
        terms, pay = self.block.of_item[item][0], self.pay[item]
        order = np.flatnonzero(bounds >= self.least[item])
        order = order[np.argsort(-bounds[order], kind="stable")]
        room = max(1, LOOKUPS // max(len(terms), 1))
        at, step = 0, self.best
        while at < len(order) and bounds[order[at]] >= self.least[item]:
            part = order[at : at + min(step, room)]
            at, step = at + len(part), 2 * step
            self.rescored += len(part)
            score = np.zeros(len(part), np.int64)
            for a in range(0, len(terms), LOOKUPS):
                some = terms[a : a + LOOKUPS]
                wanted = part[:, None] * size + some[None, :]
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                held = np.where(keys[place] == wanted, impact[place], 0)
                score += held @ pay[a : a + LOOKUPS]
            self._keep(item, score, ids[part])

    def _keep(self, item: int, score: np.ndarray, ids: np.ndarray) -> None:
        some = score >= self.least[item]
        if not some.any():
            return
        score = np.concatenate([self.tops[item][0], score[some]])
        ids = np.concatenate([self.tops[item][1], ids[some]])
        order = np.lexsort((ids, -score))[: self.best]
        self.tops[item] = score[order], ids[order]
        if len(order) == self.best:
            self.least[item] = score[order[-1]]


def search(
    docs: DataFrame,
    items: DataFrame,
    best: int = BEST,
    id_column: str = "doc_id",
    item_column: str = "item_id",
    coordinates: int = COORDINATES,
) -> DataFrame:
    """The ``best`` documents of positive score for each item: item id, ``rank``, id, ``score``.

    ``docs`` and ``items`` have a column ``text`` and an id (that of ``docs`` a whole number);
    other columns, whatever their names, are not read. Null and empty texts have no terms: such a
    document is never found, such an item finds nothing. Repeated documents are ranked each;
    repeated items are items of their own with equal results. Equal scores go by ascending id, a
    null id last. An empty table on either side gives no rows. Terms are named by 64-bit hashes.

    Statistics cover all documents. Items are searched in blocks, each of which reads the texts
    twice: for the statistics of its terms, and for its bounds and scores. Only the blocks, of
    bounded size but for a single very long item, are sent to the executors; a task returns
    ``best`` rows an item at most.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("_id"), F.col("text").cast("string"))
    wanted = items.select(F.col(f"`{item_column}`").alias("_item"), F.col("text").cast("string"))
    kind = wanted.schema["_item"].dataType
    size = wanted.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    blocks = max(1, -(-size[0] // BLOCK_ITEMS), -(-(size[1] or 0) // BLOCK_BYTES))
    share = F.pmod(F.xxhash64("_item", "text"), F.lit(blocks))
    out = spark.createDataFrame([], _result(kind))
    for i in range(blocks):
        rows = wanted.filter(share == i).collect() if blocks > 1 else wanted.collect()
        if rows:
            block = _Block.of([r["_item"] for r in rows], [r["text"] for r in rows])
            out = out.union(_search_block(texts, block, kind, best, coordinates))
    return out.select(
        F.col("_item").alias(item_column), "rank", F.col("_id").alias(id_column), "score"
    )


def _result(kind: T.DataType) -> T.StructType:
    return T.StructType(
        [T.StructField("_item", kind), *T.StructType.fromDDL("rank int, _id long, score long").fields]
    )


def _search_block(
    texts: DataFrame, block: _Block, kind: T.DataType, best: int, coordinates: int
) -> DataFrame:
    n_docs, n_terms, held = statistics(texts, block.terms)
    weights = term_weights(n_docs, held)
    sent = Broadcasted(texts.sparkSession, (block, weights))
    schema = T.StructType([T.StructField("_item", kind), *T.StructType.fromDDL("_query int, _id long, score long").fields])
    target = _arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, weights = sent.value
        searcher = _Searcher(held, weights, n_docs, n_terms, best, coordinates)
        for batch in batches:
            ids = batch.column(0).fill_null(_LAST).to_numpy(zero_copy_only=False)
            for a, b in slices(batch.column(1)):
                searcher.add(batch.column(1).slice(a, b - a), ids[a:b])
        for i, (score, ids) in enumerate(searcher.tops):
            if len(score):
                columns = (
                    [held.ids[i]] * len(score),
                    np.full(len(score), i),
                    pa.array(ids, mask=ids == _LAST),
                    score,
                )
                yield pa.RecordBatch.from_arrays(
                    [_column(c, f.type) for c, f in zip(columns, target, strict=True)], schema=target
                )
        release()

    found = texts.mapInArrow(run, schema)
    order = [F.desc("score"), F.col("_id").asc_nulls_last()]
    # The lists of a query come from all tasks: a group of tasks is merged first, then the groups.
    task = F.pmod(F.shiftright(F.monotonically_increasing_id(), 33), F.lit(MERGES))
    place = F.row_number().over(W.partitionBy("_query", "_group").orderBy(*order))
    merged = found.withColumn("_group", task).withColumn("_place", place).filter(F.col("_place") <= best)
    last = F.row_number().over(W.partitionBy("_query").orderBy(*order))
    return (
        merged.withColumn("rank", last).filter(F.col("rank") <= best).select("_item", "rank", "_id", "score")
    )


def brute_force(docs: dict, items: dict, best: int = BEST) -> dict:
    """Every document scored for every item by the formula; for tests and small sets."""
    import re

    pattern = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

    def terms(text):
        return pattern.findall((text or "").encode().lower().decode())

    counts = {d: Counter(terms(t)) for d, t in docs.items()}
    lengths = {d: c.total() for d, c in counts.items()}
    n_docs, n_terms = sum(n > 0 for n in lengths.values()), sum(lengths.values())
    held = Counter(t for c in counts.values() for t in c)
    out = {}
    for item, text in items.items():
        scores = []
        for d, count in counts.items():
            total = 0
            for t in terms(text):
                if count[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                    norm = 75 + 25 * lengths[d] * n_docs // n_terms
                    total += weight * (1_000_000_000 * count[t] // (1000 * count[t] + 12 * norm))
            if total > 0:
                scores.append((-total, d))
        out[item] = [(d, -s) for s, d in sorted(scores)[:best]]
    return out
