"""Substring dedup by relative Lempel-Ziv parsing against blocks of indexed text.

Every window of ``window`` words names one anchor: its least hash among short runs of words. Equal
windows name equal anchors at equal places, so the anchors, about one in fourteen words, index all
text. Consecutive windows with one anchor form a phrase: the words they cover, at most
``2 * window - anchor`` of them. A phrase whose words occur a second time is a duplicate as a whole,
and one copy of it stands for all.

The distinct phrases of the anchors that occur more than once are the reference. Its blocks are
hash partitions by anchor, each with a suffix order of its words. Every phrase is parsed greedily
against the block that holds all text with its anchor: the longest match with any other place is a
factor, the next factor starts behind it. Factors of at least ``window`` words become spans; the
windows across a factor's end are checked by the longest match of their own. A window that also
starts elsewhere lies in such a factor or crosses such an end, so nothing is missed.

An anchor with more distinct phrases than a block is meant to hold would make one block grow with
the input; the windows of its phrases are counted by a grouped exchange instead. Filters of fixed
size keep documents and anchors that cannot matter out of the shuffles; joins decide exactly.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import (
    Broadcasted,
    carried,
    forget,
    in_filter,
    key_filter,
    map_batches,
    map_groups,
    release,
    small_batches,
    staged,
)
from millrace.llm.words import mix, powers, rolling, slices, split_words

WINDOW = 35
ANCHOR = 8
# Phrases of a block of the reference, about; a phrase has 48 words in the mean, 62 at most.
BLOCK_PHRASES = 4000
# Rows of an Arrow batch of phrases.
_BATCH = 20_000


@dataclass
class Phrases:
    """Maximal runs of windows with one anchor; places count words of the text."""

    text: np.ndarray
    anchor: np.ndarray
    content: np.ndarray
    first: np.ndarray
    last: np.ndarray


def _least_places(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the leftmost least value of each run of ``width`` values."""
    least, place = values, np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        right = least[step:] < least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.where(right, least[step:], least[:-step])
        size += step
    return place


def phrases(hashes: np.ndarray, counts: np.ndarray, window: int, anchor: int) -> Phrases:
    """The phrases of consecutive texts given as word hashes and word counts."""
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return Phrases(none, none.view(np.uint64), none.view(np.uint64), none, none)
    owner = np.repeat(np.arange(len(counts)), counts)
    starts = np.concatenate([[0], np.cumsum(counts)[:-1]])
    runs = rolling(hashes, anchor)
    place = _least_places(runs, window - anchor + 1)
    inside = np.flatnonzero(owner[: len(place)] == owner[window - 1 :])
    if not len(inside):
        return Phrases(none, none.view(np.uint64), none.view(np.uint64), none, none)
    place = place[inside]
    fresh = np.empty(len(inside), bool)
    fresh[0] = True
    fresh[1:] = (place[1:] != place[:-1]) | (owner[inside[1:]] != owner[inside[:-1]])
    at = np.flatnonzero(fresh)
    first = inside[at]
    last = inside[np.append(at[1:], len(inside)) - 1]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(len(hashes)))])
    content = (sums[last + window] - sums[first]) * powers(len(hashes) + 1, True)[first]
    content = mix(content ^ mix((last - first).astype(np.uint64)))
    text = owner[first]
    return Phrases(text, runs[place[at]], content, first - starts[text], last - starts[text])


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = split_words(texts)
    return (words.hashes() if len(words.start) else np.zeros(0, np.uint64)), words.counts


def _anchor_counts(docs: DataFrame, window: int, anchor: int) -> DataFrame:
    def work(batch):
        texts = batch.column(0)
        for a, b in slices(texts):
            found = phrases(*_word_hashes(texts.slice(a, b - a)), window, anchor)
            values, many = np.unique(found.anchor, return_counts=True)
            yield {"anchor": values.view(np.int64), "n": many}

    rows = map_batches(docs.select("text"), work, "anchor long, n long")
    return rows.groupBy("anchor").agg(F.sum("n").alias("n"))


def _phrase_places(docs: DataFrame, shared: Broadcasted, window: int, anchor: int) -> DataFrame:
    """The phrases whose anchor may occur more than once."""

    def work(batch):
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            found = phrases(*_word_hashes(texts.slice(a, b - a)), window, anchor)
            keep = in_filter(shared.value, found.anchor)
            yield {
                "_rows": found.text[keep] + a,
                "anchor": found.anchor[keep].view(np.int64),
                "content": found.content[keep].view(np.int64),
                "first": found.first[keep],
                "last": found.last[keep],
            }

    return map_batches(
        docs, work, "anchor long, content long, first int, last int", ["_k1", "_k2"]
    )


def _filtered(docs: DataFrame, keys: Broadcasted) -> DataFrame:
    """Documents whose key may be in a filter."""
    at = docs.columns.index("_k1")

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(in_filter(keys.value, batch.column(at).to_numpy())))
        release()

    return docs.mapInArrow(pick, docs.schema)


def _ranges(batch: pa.RecordBatch, window: int):
    """``(owner, first, words in the range, word hashes, place of the first word)`` of the ranges in
    each slice of a batch with ``text`` and ``ranges``, and the ranges' third field."""
    texts = batch.column(batch.schema.get_field_index("text"))
    bounds, firsts, lasts, blocks = _lists(batch.column(batch.schema.get_field_index("ranges")), 3)
    for a, b in slices(texts):
        hashes, counts = _word_hashes(texts.slice(a, b - a))
        starts = np.concatenate([[0], np.cumsum(counts)])
        x, y = bounds[a], bounds[b]
        owner = np.repeat(np.arange(a, b), np.diff(bounds[a : b + 1]))
        first = firsts[x:y]
        yield owner, first, lasts[x:y] - first + window, hashes, starts[owner - a] + first, blocks[x:y]


def _steps(many: np.ndarray) -> np.ndarray:
    """0, 1, ... up to each count, one after the other."""
    return np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _phrase_rows(docs: DataFrame, window: int) -> DataFrame:
    """``block, words, _k1, _k2, first`` for the phrases in ``ranges``, words as 64-bit hashes."""

    def work(batch):
        for owner, first, many, hashes, begin, block in _ranges(batch, window):
            for x in range(0, len(owner), _BATCH):
                some = slice(x, x + _BATCH)
                size = many[some]
                flat = hashes[np.repeat(begin[some], size) + _steps(size)]
                ends = np.concatenate([[0], np.cumsum(size)]) * 8
                yield {
                    "_rows": owner[some],
                    "block": block[some],
                    "words": pa.Array.from_buffers(
                        pa.binary(),
                        len(size),
                        [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(flat)],
                    ),
                    "first": first[some],
                }

    return map_batches(docs, work, "block long, words binary, first int", ["_k1", "_k2"])


def _window_rows(docs: DataFrame, window: int) -> DataFrame:
    """``w, _k1, _k2, first`` for the windows in each document's ``ranges``."""

    def work(batch):
        for owner, first, size, hashes, begin, _ in _ranges(batch, window):
            many = size - window + 1
            step = _steps(many)
            yield {
                "_rows": np.repeat(owner, many),
                "w": rolling(hashes, window)[np.repeat(begin, many) + step].view(np.int64),
                "first": np.repeat(first, many) + step,
            }

    return map_batches(docs, work, "w long, first int", ["_k1", "_k2"])


def longest_matches(words: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many words from each place on, within its phrase, also start at some other place.

    ``words`` are the hashes of phrases of ``lengths``, one after the other. Places are ranked by
    their next 1, 2, 4, ... words; neighbours in the last order share the most, and the ranks of all
    levels tell how much.
    """
    count, total = len(lengths), len(words) + len(lengths)
    ends = np.cumsum(lengths)
    rank = np.unique(words, return_inverse=True)[1] + count
    # Each phrase ends in a sign of its own, so that no match leaves it.
    rank = np.insert(rank, ends, np.arange(count))
    levels, size = [rank], 1
    while size <= int(lengths.max(initial=0)) and size < total:
        behind = np.zeros(total, np.int64)
        behind[:-size] = rank[size:] + 1
        values, rank = np.unique(rank * (total + 1) + behind, return_inverse=True)
        if len(values) == total:
            break
        levels.append(rank)
        size *= 2
    order = np.argsort(rank, kind="stable")
    one, two = order[:-1], order[1:]
    same = np.zeros(len(one), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        # A place past the end is behind a sign, where nothing is equal any more.
        x, y = np.minimum(one + same, total - 1), np.minimum(two + same, total - 1)
        same += (levels[k][x] == levels[k][y]) * (1 << k) * (x != y)
    out = np.zeros(total, np.int64)
    out[one] = same
    out[two] = np.maximum(out[two], same)
    return np.delete(out, ends + np.arange(count))


def parse(
    match: np.ndarray, lengths: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Duplicate spans ``(phrase, first, end)`` of a greedy parse of all phrases side by side.

    ``match`` is what :func:`longest_matches` gives. A factor takes the longest match at its place,
    one word if there is none. Long factors are spans; so are the long matches of windows that start
    in a factor and end behind it.
    """
    begin = np.cumsum(lengths) - lengths
    windows = lengths - window + 1
    alive = np.flatnonzero(windows > 0)
    at = np.zeros(len(alive), np.int64)
    found = []
    while len(alive):
        size = match[begin[alive] + at]
        end = at + np.maximum(size, 1)
        whole = size >= window
        found.append((alive[whole], at[whole], end[whole]))
        low = np.where(whole, end - window, at) + 1
        many = np.maximum(np.minimum(end, windows[alive]) - low, 0)
        owner, step = np.repeat(alive, many), _steps(many)
        place = np.repeat(low, many) + step
        size = match[begin[owner] + place]
        # What the match of the window before reaches as well lies in that one's span.
        before = match[begin[owner] + place - 1]
        more = (size >= window) & ((step == 0) | (size >= before))
        found.append((owner[more], place[more], (place + size)[more]))
        left = end < windows[alive]
        alive, at = alive[left], end[left]
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _block_spans(rows: DataFrame, window: int) -> DataFrame:
    """``_k1, _k2, first, end`` of the duplicate spans that the parse against each block finds."""

    def work(block: pa.Table) -> dict | None:
        words = block.column("words").combine_chunks()
        lengths = np.array(pa.compute.binary_length(words)).astype(np.int64) // 8
        flat = np.frombuffer(b"".join(words.to_pylist()), np.uint64)
        phrase, first, end = parse(longest_matches(flat, lengths), lengths, window)
        if not len(phrase):
            return None
        base = block.column("first").to_numpy()[phrase]
        take = pa.array(phrase)
        return {
            "_k1": block.column("_k1").combine_chunks().take(take),
            "_k2": block.column("_k2").combine_chunks().take(take),
            "first": base + first,
            "end": base + end,
        }

    return map_groups(rows, "block", work, "_k1 long, _k2 int, first int, end int")


def _lists(column: pa.Array, width: int) -> tuple[np.ndarray, ...]:
    """List bounds and the fields of an array of lists of integers; null lists are empty."""
    lengths = np.array(column.value_lengths().fill_null(0))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    values = column.flatten()
    return bounds, *(np.array(values.field(i)).astype(np.int64) for i in range(width))


def _merged(first: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint runs that cover the same places, in order."""
    if not len(first):
        return []
    order = np.argsort(first, kind="stable")
    first, end = first[order], np.maximum.accumulate(end[order])
    fresh = np.flatnonzero(np.append(True, first[1:] > end[:-1]))
    return list(zip(first[fresh].tolist(), end[np.append(fresh[1:], len(end)) - 1].tolist()))


def _cut(docs: DataFrame, carry: list[str], but: Broadcasted | None = None) -> DataFrame:
    """Remove the words in ``spans`` and join the kept ones by a blank.

    ``but`` leaves out documents whose key may be in a filter.
    """

    def work(batch):
        if but is not None:
            keys = batch.column(batch.schema.get_field_index("_k1")).to_numpy()
            yield from _cut_rows(batch, np.flatnonzero(~in_filter(but.value, keys)))
        else:
            yield from _cut_rows(batch, None)

    def _cut_rows(batch, some):
        if some is not None:
            batch = batch.take(pa.array(some))
        column = batch.column(batch.schema.get_field_index("text"))
        bounds, firsts, ends = _lists(batch.column(batch.schema.get_field_index("spans")), 2)
        for a, b in slices(column):
            n_words, n_removed, kept, runs = [], [], [], []
            for i, text in enumerate(column.slice(a, b - a).to_pylist(), a):
                words = (text or "").encode().split()
                x, y = bounds[i], bounds[i + 1]
                left, at, own = [], 0, []
                for start, end in _merged(firsts[x:y], ends[x:y]):
                    left += words[at:start]
                    at = end
                    own.append({"first": start, "words": end - start})
                left += words[at:]
                n_words.append(len(words))
                n_removed.append(len(words) - len(left))
                kept.append(b" ".join(left).decode())
                runs.append(own)
            yield {
                "_rows": slice(a, b) if some is None else some[a:b],
                "n_words": n_words,
                "n_removed": n_removed,
                "kept_text": kept,
                "removed": runs,
            }

    ddl = (
        "n_words long, n_removed long, kept_text string, "
        "removed array<struct<first:int,words:int>>"
    )
    return map_batches(docs, work, ddl, carry)


def remove_repeats(
    docs: DataFrame,
    carry: list[str],
    window: int = WINDOW,
    anchor: int = ANCHOR,
    id_column: str = "doc_id",
    block_phrases: int = BLOCK_PHRASES,
) -> DataFrame:
    """``carry`` columns, ``n_words``, ``n_removed``, ``kept_text`` and ``removed`` word runs.

    A word goes if a window of ``window`` words of its document covers it whose word sequence also
    starts anywhere else, in the same document or another. Windows are judged on the input. Words
    are runs without ASCII white space, unchanged. A null text has no words; a text shorter than
    the window loses none; blanks between kept words become one space. Rows that repeat are
    occurrences of their own. Ids may be null or repeat. A carried column named like one of ours
    gives way to it. ``block_phrases`` bounds a block; it changes cost, never results.
    """
    spark = docs.sparkSession
    small_batches(spark)
    own = ("n_words", "n_removed", "kept_text", "removed")
    names, held, picked = carried(docs, carry, *own)
    key = F.col(id_column).cast("string"), F.col("text").cast("string")
    inner = docs.select(
        *picked,
        F.xxhash64(*key).alias("_k1"),
        F.hash(*key).alias("_k2"),
    )
    keyed = inner.select("text", "_k1", "_k2")

    repeated = _anchor_counts(inner, window, anchor).filter("n > 1")
    shared = Broadcasted(spark, key_filter(repeated, "anchor"))
    rows = staged(_phrase_places(keyed, shared, window, anchor), "phrases")
    shared.end()

    # Written, so that the joins below see plain tables and can split a hot anchor.
    place = F.struct("_k1", "_k2", "first")
    contents = staged(
        rows.groupBy("anchor", "content").agg(F.count("*").alias("n"), F.min(place).alias("one")),
        "contents",
    )
    anchors = staged(
        contents.groupBy("anchor").agg(F.count("*").alias("contents"), F.sum("n").alias("all")),
        "anchors",
    )
    several = anchors.filter("all > 1").select("anchor", "contents")
    status = staged(contents.join(several, "anchor"), "status")
    judged = staged(rows.join(status, ["anchor", "content"]), "judged")
    forget(rows, contents, anchors)

    whole = judged.filter("n > 1").select(
        "_k1", "_k2", "first", (F.col("last") + window).alias("end")
    )
    checked = judged.filter((F.col("contents") > 1) & ((F.col("n") == 1) | (place == F.col("one"))))
    sizes = status.filter("contents > 1").agg(
        F.sum((F.col("contents") <= block_phrases).cast("long")).alias("held"),
        F.sum((F.col("contents") > block_phrases).cast("long")).alias("beyond"),
    ).first()
    blocks = max(1, -(-(sizes["held"] or 0) // block_phrases))
    block = F.pmod(F.xxhash64("anchor"), F.lit(blocks))

    def texts_with(phrases: DataFrame, label: str) -> tuple[DataFrame, DataFrame, Broadcasted]:
        """Documents with the places of their phrases; the table and the filter they come by."""
        ranges = staged(
            phrases.groupBy("_k1", "_k2").agg(
                F.collect_set(F.struct("first", "last", block.alias("block"))).alias("ranges")
            ),
            label,
        )
        sent = Broadcasted(spark, key_filter(ranges, "_k1"))
        return _filtered(keyed, sent).join(ranges, ["_k1", "_k2"]), ranges, sent

    texts, ranges, sent = texts_with(checked.filter(F.col("contents") <= block_phrases), "ranges")
    parsed = staged(_block_spans(_phrase_rows(texts, window), window), "parsed")
    sent.end()
    forget(ranges)
    found, helpers = whole.union(parsed), [judged, status, parsed]
    if sizes["beyond"]:
        texts, ranges, sent = texts_with(checked.filter(F.col("contents") > block_phrases), "beyond")
        windows = staged(_window_rows(texts, window), "windows")
        sent.end()
        forget(ranges)
        twice = staged(
            windows.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").select("w"), "twice"
        )
        single = windows.join(twice, "w").select(
            "_k1", "_k2", "first", (F.col("first") + window).alias("end")
        )
        found, helpers = found.union(single), [*helpers, windows, twice]
    spans = staged(
        found.groupBy("_k1", "_k2").agg(F.collect_set(F.struct("first", "end")).alias("spans")),
        "spans",
    )
    forget(*helpers)

    hit = Broadcasted(spark, key_filter(spans, "_k1"))
    touched = _filtered(inner, hit).join(spans, ["_k1", "_k2"], "left")
    kind = spans.schema["spans"].dataType
    whole_texts = inner.withColumn("spans", F.lit(None).cast(kind))
    seen = list(dict.fromkeys([*held, "text", "spans"]))
    cut = _cut(touched.select(*seen), held).union(
        _cut(whole_texts.select("_k1", *seen), held, hit)
    )
    return cut.select(*[F.col(h).alias(c) for h, c in zip(held, names, strict=True)], *own)
