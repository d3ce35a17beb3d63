"""Words, n-grams and hashes of many texts at once, as numpy arrays over Arrow buffers.

A chunk is some consecutive texts of an Arrow column as one byte array and the offsets of the
texts in it. All functions here work on a whole chunk, so that no step is taken per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text in a chunk, unless a single text is longer.
CHUNK_BYTES = 1 << 19

_ODD = 0x9E3779B97F4A7C15
_ODD_INVERSE = pow(_ODD, -1, 1 << 64)
_BYTE_VALUES = np.random.RandomState(20240117).randint(0, 1 << 62, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEPS = np.random.RandomState(7).randint(0, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32  # A-Z only

#: Bytes of words between ASCII white space; the bytes of a character beyond ASCII belong to words.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[9, 10, 11, 12, 13, 32]] = False

#: Bytes of words of lower-cased text made of digits, a-z and everything beyond ASCII.
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[97:123] = WORD[128:] = True


def plain(column: pa.Array) -> pa.Array:
    """The column as Arrow strings, a null as an empty text."""
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, bytes, offsets) of runs of texts; nulls count as empty."""
    column = plain(column)
    if not len(column):
        return
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def characters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each UTF-8 character: its bytes as one number and its place; and the first character of each text."""
    starts = np.flatnonzero((data & 0xC0) != 0x80)
    lengths = np.diff(np.append(starts, len(data)))
    codes = data[starts].astype(np.uint64)
    for k in range(1, 4):
        longer = np.flatnonzero(lengths > k)
        codes[longer] = (codes[longer] << np.uint64(8)) | data[starts[longer] + k]
    return codes, starts, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _power_table(base: int, n: int, name: str) -> np.ndarray:
    if name not in _powers or len(_powers[name]) < n:
        table = np.full(max(n, CHUNK_BYTES), base, dtype=np.uint64)
        table[0] = 1
        _powers[name] = np.multiply.accumulate(table)
    return _powers[name][:n]


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and texts of the maximal runs of bytes with ``inside[byte]``."""
    mask = np.zeros(len(data) + 2, dtype=bool)
    mask[1:-1] = inside[data]
    starts, stops = mask[1:-1] & ~mask[:-2], mask[1:-1] & ~mask[2:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(data))]
    starts[edges] = mask[1:-1][edges]
    stops[edges - 1] = mask[1:-1][edges - 1]
    starts = np.flatnonzero(starts)
    return starts, np.flatnonzero(stops) + 1, np.searchsorted(offsets, starts, side="right") - 1


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever the span stands."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _power_table(_ODD, len(data), "up"), out=total[1:])
    back = _power_table(_ODD_INVERSE, len(data) + 1, "down")
    return mix((total[ends] - total[starts]) * back[starts])


def grams(words: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive word hashes, also of those that cross texts."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, np.uint64(k))
    for i in range(k):
        out += words[i : i + n] * _STEPS[i]
    return mix(out)


def words_of(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a chunk, A-Z lower-cased, and the first word of each text (and the end)."""
    data = LOWER[data]
    starts, ends, _ = spans(data, offsets, inside)
    return hashes(data, starts, ends), np.searchsorted(starts, offsets)
