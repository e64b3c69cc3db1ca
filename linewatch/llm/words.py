"""Words of a text: as Spark expressions, and as hashes of whole Arrow batches.

A word is a longest run of the characters ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z became a-z:
digits, ASCII letters and everything beyond ASCII.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. ``lower`` says the same for pure ASCII, and far faster."""
    pure = F.octet_length(text) == F.char_length(text)
    return F.when(pure, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_array(text: Column) -> Column:
    """The words in order; null for null."""
    return F.array_remove(F.split(ascii_lower(text), BETWEEN_WORDS), "")


# One random number for each byte; upper case has the numbers of lower case.
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 2**64)
#: Bytes hashed at once, unless one text is longer.
SLICE = 1 << 18


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: dict[int, np.ndarray] = {}


def _powers_of(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, SLICE), base, np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def text_slices(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) for stretches of rows of some ``SLICE`` bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        last = int(np.searchsorted(offsets, offsets[row] + SLICE, "right")) - 1
        last = min(max(last, row + 1), len(texts))
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def hash_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all rows, and where each row's words begin and end."""
    n = len(data)
    inside = _IN_WORD[data]
    breaks = np.zeros(n + 1, bool)
    breaks[offsets] = True
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (breaks[:-1] | ~before))
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (breaks[1:] | ~after)) + 1
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers_of(_BASE, n), dtype=np.uint64, out=total[1:])
    hashes = (total[ends] - total[starts]) * _powers_of(_UNBASE, n)[starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)


_PLACE = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def hash_shingles(words: np.ndarray, bounds: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words, and the row of each. A row of fewer
    words, but not none, is one shingle."""
    if width > len(_PLACE):
        raise ValueError(f"shingles of at most {len(_PLACE)} words")
    counts = np.diff(bounds)
    made = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    rows = np.repeat(np.arange(len(made)), made)
    first = np.arange(made.sum()) - np.repeat(np.cumsum(made) - made, made) + bounds[:-1][rows]
    end = bounds[1:][rows]
    out = np.zeros(len(first), np.uint64)
    for k in range(width):
        at = first + k
        there = at < end
        out += np.where(there, words[np.minimum(at, max(len(words) - 1, 0))], np.uint64(k + 1)) * _PLACE[k]
    return mix(out), rows
