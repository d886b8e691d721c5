"""Words of whole texts as numpy arrays, without a Python step per word.

A word is ``[^\\x20\\x09-\\x0D]+`` over the UTF-8 bytes of a text; null texts have none. Hashes are
64 bits wide, equal for equal bytes, and independent of process, batch and position.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)

# Bytes worked on at once: the wide temporaries take about forty times as much memory.
SLICE_BYTES = 600_000


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every input bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out) if n else out


_CACHED: dict[tuple[int, str], np.ndarray] = {}


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """``base**i`` modulo 2**64 for ``i < n``, kept between calls."""
    key = (0, "inverse" if inverse else "base")
    have = _CACHED.get(key)
    if have is None or len(have) < n:
        have = _CACHED[key] = _powers(_INVERSE if inverse else _BASE, max(n, 1 << 16))
    return have[:n]


@dataclass
class Words:
    """The words of some consecutive texts.

    ``first[i]:first[i + 1]`` are text i's words; ``start`` and ``end`` are byte places in ``data``.
    """

    data: np.ndarray
    first: np.ndarray
    start: np.ndarray
    end: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, most: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word's bytes, or of its first ``most`` bytes."""
        values = self.data.astype(np.uint64)
        values += np.uint64(1)
        values *= powers(len(values))
        sums = np.empty(len(values) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(values, out=sums[1:])
        end = self.end if most is None else np.minimum(self.end, self.start + most)
        out = (sums[end] - sums[self.start]) * powers(len(values) + 1, True)[self.start]
        return mix(out)

    def word(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def split_words(texts: pa.Array, lower: bool = False, blank: np.ndarray = BLANK) -> Words:
    """The words of an Arrow string array; ``lower`` maps A-Z to a-z first.

    ``blank`` tells for each byte value whether it ends a word.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    if n == 0 or offsets[-1] == offsets[0]:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64), none, none)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    data = LOWER[data] if lower else data
    solid = ~blank[data]
    # A word starts at a solid byte after a blank one or at a text's first byte.
    before = np.empty(len(solid) + 1, bool)
    before[0], before[1:] = False, solid
    after = np.empty(len(solid) + 1, bool)
    after[:-1], after[-1] = solid, False
    edges = offsets[1:-1]
    begins = after[:-1] & ~before[:-1]
    ends = before[1:] & ~after[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    begins[inner] |= solid[inner]
    ends[inner - 1] |= solid[inner - 1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    return Words(data, first, start, end)


def slices(texts: pa.Array, size: int = SLICE_BYTES):
    """``(from, to)`` row ranges of about ``size`` bytes; a longer text gets a range of its own."""
    wide = texts.cast(pa.large_string())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    at = 0
    while at < len(texts):
        to = int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1
        to = min(max(to, at + 1), len(texts))
        yield at, to
        at = to


def spaced_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with one blank after each, and where each text starts."""
    wide = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset : wide.offset + len(wide) + 1]
    if not len(wide) or offsets[-1] == offsets[0]:
        return np.full(len(wide), 32, np.uint8), np.arange(len(wide) + 1)
    data = np.frombuffer(wide.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    out = np.insert(data, offsets[1:], 32)
    return out, offsets + np.arange(len(offsets))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` consecutive values, position by position."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.empty(len(hashes) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(hashes * powers(len(hashes)), out=sums[1:])
    return mix((sums[width:] - sums[:-width]) * powers(n, True))
