"""Secret scans: fixed patterns, and strings that look random to two Markov models.

The patterns label the training samples: what they match is a random string, every other run of
identifier characters is ordinary. Both first-order character models count all documents. A further
stretch of a run is a secret if its log-likelihood ratio, random against ordinary and summed over
its characters, reaches ``MARGIN`` plus the log of the run's length: of ordinary runs of n
characters, at most about n * exp(-threshold) hold such a stretch by chance. The ratio alone
decides: no length, digit or letter case is asked for.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import Broadcasted, array_pieces, carried, map_batches, sum_arrays
from millrace.llm.words import LOWER, slices, spaced_bytes

# The base patterns, in the order in which kinds are listed, and their least lengths.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "markov")
LEAST = {"assign": 8, "access": 16, "hex": 32}
HINTS = (b"password", b"passwd", b"secret", b"token", b"api_key", b"apikey")

# What the models read. Class 0 is any other character.
ALPHABET = "0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-"
CLASSES = len(ALPHABET) + 1
CODE = np.zeros(256, np.uint8)
for _i, _c in enumerate(ALPHABET):
    CODE[ord(_c)] = _i + 1
HEXDIGIT = np.zeros(256, bool)
HEXDIGIT[[ord(c) for c in "0123456789abcdef"]] = True

MARGIN = 12.0
SMOOTHING = 0.5
# Weight of what stands behind the pairs: even odds for random strings, as their samples may use
# few of the characters, and single-character odds for ordinary ones.
BACKED = 100.0
_RUN = re.compile("[A-Za-z0-9+/_=-]{2,}")
_STEM = re.compile("[A-Za-z0-9]*")
_CELLS = -(-2 * CLASSES * CLASSES // 64) * 64


def base_spans(text: str) -> list[tuple[int, int, str, str]]:
    """``(start, end, kind, value)`` of the patterns, leftmost and not overlapping per kind."""
    out = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST["assign"]:
            out.append((m.start(), m.end(), "assign", m[2]))
    for kind, pattern in (("access", ACCESS), ("hex", HEX)):
        for m in pattern.finditer(text):
            if m.end() - m.start() >= LEAST[kind]:
                out.append((m.start(), m.end(), kind, m[0]))
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def _runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def suspects(
    texts: pa.Array, ratio: np.ndarray | None = None, margin: float = MARGIN
) -> np.ndarray:
    """Texts that may hold a span of the patterns or, with ``ratio``, of the models.

    The others certainly hold none.
    """
    data, starts = spaced_bytes(texts)
    hit = np.zeros(len(texts), bool)

    def mark(places: np.ndarray) -> None:
        hit[np.searchsorted(starts, places, "right") - 1] = True

    low = LOWER[data].tobytes()
    for blob, hints in ((low, HINTS), (data.tobytes(), (b"AKIA",))):
        for hint in hints:
            at = blob.find(hint)
            while at >= 0:
                mark(np.array([at]))
                at = blob.find(hint, at + 1)
    first, last = _runs(HEXDIGIT[data])
    mark(first[last - first >= LEAST["hex"]])
    if ratio is not None:
        codes = CODE[data]
        first, last = _runs(codes > 0)
        # No stretch rises by more than the largest ratio a character.
        fit = (last - first - 1) * ratio.max() >= margin + np.log(last - first)
        first, last = first[fit], last[fit]
        if len(first):
            rise = best_rises(codes, first, last, ratio)
            mark(first[rise >= margin + np.log(last - first)])
    return hit


def best_rises(
    codes: np.ndarray, first: np.ndarray, last: np.ndarray, ratio: np.ndarray
) -> np.ndarray:
    """The largest sum of ratios over consecutive characters inside each run, 0 at least."""
    size = last - first
    begin = np.concatenate([[0], np.cumsum(size)])
    at = np.repeat(first - begin[:-1], size) + np.arange(begin[-1])
    steps = ratio.ravel()[codes[at - 1].astype(np.int64) * CLASSES + codes[at]]
    steps[begin[:-1]] = 0
    sums = np.cumsum(steps)
    # Sums of each run lie below all of the run before, so that one running minimum serves all.
    most = float(np.abs(ratio).max())
    sums -= np.repeat(sums[begin[:-1]] + 2 * most * begin[:-1], size)
    return np.maximum.reduceat(sums - np.minimum.accumulate(sums), begin[:-1])


def _pairs(codes: np.ndarray) -> np.ndarray:
    pairs = codes[:-1].astype(np.int64) * CLASSES + codes[1:]
    return np.bincount(pairs, minlength=CLASSES * CLASSES)


def _count(docs: DataFrame) -> DataFrame:
    """Character pairs of random samples and of all runs, summed over a task's texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(_CELLS, np.int64)
        half = CLASSES * CLASSES
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(texts):
                part = texts.slice(a, b - a)
                data, _ = spaced_bytes(part)
                sums[half : 2 * half] += _pairs(CODE[data])
                for i in np.flatnonzero(suspects(part)).tolist():
                    for _, _, _, value in base_spans(part[i].as_py() or ""):
                        raw = np.frombuffer(value.encode(), np.uint8)
                        sums[:half] += _pairs(CODE[raw])
        made = array_pieces(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(made["piece"], pa.int32()), pa.array(made["data"], pa.binary())],
            names=["piece", "data"],
        )

    return docs.select("text").mapInArrow(run, "piece int, data binary")


def train(docs: DataFrame) -> np.ndarray:
    """Log-likelihood ratio of each next character: random against ordinary.

    Without random samples their model is even.
    """
    sums = np.frombuffer(b"".join(sum_arrays(_count(docs))) or bytes(8 * _CELLS), np.int64)
    half = CLASSES * CLASSES
    random = sums[:half].reshape(CLASSES, CLASSES).astype(float)
    ordinary = np.maximum(sums[half : 2 * half].reshape(CLASSES, CLASSES) - random, 0)
    size = CLASSES - 1
    logs = []
    for counts, even in ((random, True), (ordinary, False)):
        known = counts[1:, 1:]
        single = known.sum(axis=0) + SMOOTHING
        behind = np.full(size, 1 / size) if even else single / single.sum()
        logs.append(
            np.log((known + BACKED * behind) / (known.sum(axis=1, keepdims=True) + BACKED))
        )
    out = np.zeros((CLASSES, CLASSES))
    out[1:, 1:] = logs[0] - logs[1]
    return out


def stretches(steps: list[float], least: float) -> list[tuple[int, int]]:
    """Disjoint stretches ``[a, b)`` of steps whose sums reach ``least``, each up to its peak.

    A stretch begins where the sum last left zero, and the next one is looked for once the sum is
    back there or ``least`` below the peak. One pass; a run has a stretch if and only if any of its
    stretches reaches ``least``.
    """
    out = []
    total = peak = 0.0
    begin = top = 0
    for i, step in enumerate(steps):
        total += step
        if total > peak:
            peak, top = total, i + 1
        if total <= 0 or (peak >= least and total <= peak - least):
            if peak >= least:
                out.append((begin, top))
            total = peak = 0.0
            begin = i + 1
    if peak >= least:
        out.append((begin, top))
    return out


def model_spans(
    text: str, ratio: np.ndarray, taken: list[tuple[int, int, str, str]], margin: float = MARGIN
) -> list[tuple[int, int, str, str]]:
    """Stretches of runs that are likelier random, and overlap no base span.

    A stretch is widened to whole strings of letters and digits, so that no key loses its ends;
    stretches that meet are one.
    """
    begins, ends = [t[0] for t in taken], []
    for t in taken:
        ends.append(max(t[1], ends[-1] if ends else 0))
    out = []
    most = ratio.max()
    for m in _RUN.finditer(text):
        least = margin + np.log(len(m[0]))
        if (len(m[0]) - 1) * most < least:
            continue
        codes = CODE[np.frombuffer(m[0].encode(), np.uint8)]
        if best_rises(codes, np.array([0]), np.array([len(codes)]), ratio)[0] < least:
            continue
        own = []
        flipped = m[0][::-1]
        for a, b in stretches(ratio[codes[:-1], codes[1:]].tolist(), least):
            # Step i is between characters i and i + 1.
            if own and own[-1][1] > a:
                a = own.pop()[0]
            else:
                a = min(a, len(codes) - _STEM.match(flipped, len(codes) - 1 - a).end())
            own.append((a, max(b + 1, _STEM.match(m[0], b).end())))
        for a, b in own:
            a, b = m.start() + a, m.start() + b
            before = bisect_left(begins, b)
            if not before or ends[before - 1] <= a:
                out.append((a, b, "markov", text[a:b]))
    return out


def find_secrets(
    docs: DataFrame, carry: list[str], ratio: np.ndarray | None = None, margin: float = MARGIN
) -> DataFrame:
    """``carry`` columns, ``spans`` and ``redacted`` for every document.

    ``spans`` holds ``kind, first, end`` in code points, end exclusive, by start and then by kind;
    base spans of different kinds may overlap, as each kind is read on its own. ``redacted`` is the
    text with each stretch of spans replaced by ``[SECRET]``, a null text as it is. Null and empty
    texts have no spans, and neither have the rows of an empty table. Rows are judged one by one, so
    repeated rows get equal results; a carried column named like one of ours gives way to it. Very
    long texts are read whole, in time linear in their length.
    """
    names, held, picked = carried(docs, carry, "spans", "redacted")
    ratio = train(docs) if ratio is None else ratio
    sent = Broadcasted(docs.sparkSession, ratio)

    def work(batch):
        texts = batch.column(batch.schema.get_field_index("text"))
        for a, b in slices(texts):
            part = texts.slice(a, b - a)
            spans: list[list[dict]] = [[] for _ in range(b - a)]
            redacted = part.to_pylist()
            for i in np.flatnonzero(suspects(part, sent.value, margin)).tolist():
                text = redacted[i] or ""
                found = base_spans(text)
                found = found + model_spans(text, sent.value, found, margin)
                found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
                spans[i] = [{"kind": k, "first": s, "end": e} for s, e, k, _ in found]
                redacted[i] = _redact(text, found)
            yield {"_rows": slice(a, b), "spans": spans, "redacted": redacted}

    made = map_batches(
        docs.select(*picked), work, "spans array<struct<kind:string,first:int,end:int>>, redacted string", held
    )
    return made.select(
        *[F.col(h).alias(c) for h, c in zip(held, names, strict=True)], "spans", "redacted"
    )


def _redact(text: str, spans: list[tuple[int, int, str, str]]) -> str:
    out, at = [], 0
    for start, end, _, _ in spans:
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ","
    )
