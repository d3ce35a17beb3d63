"""Simple-8b: runs of small numbers in 64-bit words, packed and unpacked with numpy.

The upper four bits of a word select how many numbers share its lower 60 bits:

    selector   1  2  3  4  5  6  7  8  9 10 11 12 13 14
    numbers   60 30 20 15 12 10  8  7  6  5  4  3  2  1
    bits       1  2  3  4  5  6  7  8 10 12 15 20 30 60

Selector 15 stands for 120 zeros. Selector 0 is the escape: the next word is one number as it is,
for numbers of more than 60 bits. Numbers are cut into blocks of BLOCK; a block's words begin at
its own offset, so blocks pack and unpack side by side and can be read alone.
"""

from __future__ import annotations

import numpy as np

BLOCK = 1024
# Fixed values of the format: numbers in a word and bits of each, by selector.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 120])
BITS = np.array([64, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 0])
ESCAPE, ZEROS = 0, 15


#: Widths of the numbers below 65536, the usual token ids.
_SMALL = np.array([n.bit_length() for n in range(1 << 16)], dtype=np.uint8)


def bit_widths(values: np.ndarray) -> np.ndarray:
    """Bits that each number needs."""
    if values.max() < len(_SMALL):
        return _SMALL[values]
    widths = np.zeros(len(values), dtype=np.uint8)
    for shift in (32, 16, 8, 4, 2, 1):
        high = values >> np.uint64(shift)
        large = high > 0
        widths += large * np.uint8(shift)
        values = np.where(large, high, values)
    return widths + (values > 0)


def _selectors(widths: np.ndarray) -> np.ndarray:
    """The selector of a word that begins at each number: the one that packs most."""
    n = len(widths)
    best = np.where(widths > 60, ESCAPE, 14).astype(np.uint8)
    window, size = widths.copy(), 1
    # The largest width of the next `size` numbers, for growing sizes; past the end nothing fits.
    for selector in [*range(13, 0, -1), ZEROS]:
        count = int(COUNTS[selector])
        if count > n:
            break
        while size < count:
            step = min(size, count - size)
            window = np.maximum(window[: len(window) - step], window[step:])
            size += step
        fits = np.flatnonzero(window <= BITS[selector])
        if not len(fits):
            break  # more numbers of fewer bits can't fit either
        best[fits] = selector
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block and the end) of 64-bit unsigned numbers."""
    values = values.astype(np.uint64)
    n = len(values)
    blocks = -(-n // BLOCK)
    if not n:
        return np.empty(0, np.uint64), np.zeros(1, np.int64)
    widths = bit_widths(values)
    # A word may not cross into the next block: there, only what still fits counts.
    selector = _selectors(widths)
    end = np.minimum((np.arange(blocks) + 1) * BLOCK, n)
    at = np.arange(blocks) * BLOCK
    block = np.arange(blocks)
    order = np.array([ZEROS, *range(1, 15), ESCAPE])
    place = np.empty(16, np.int64)
    place[order] = np.arange(16)
    starts, owners, chosen = [], [], []
    while len(at):
        pick = selector[at].astype(np.int64)
        over = COUNTS[pick] > end - at
        while over.any():  # near a block's end: the next selector that packs fewer
            pick[over] = order[place[pick[over]] + 1]
            over = COUNTS[pick] > end - at
        starts.append(at)
        owners.append(block)
        chosen.append(pick)
        at = at + COUNTS[pick]
        go = at < end
        at, end, block = at[go], end[go], block[go]
    starts, owners, chosen = (np.concatenate(x) for x in (starts, owners, chosen))
    order = np.argsort(starts, kind="stable")
    starts, owners, chosen = starts[order], owners[order], chosen[order]
    slots = 1 + (chosen == ESCAPE)
    first = np.concatenate([[0], np.cumsum(slots)])
    words = np.zeros(first[-1], dtype=np.uint64)
    words[first[:-1]] = chosen.astype(np.uint64) << np.uint64(60)
    for selector in range(1, 15):
        mine = np.flatnonzero(chosen == selector)
        if len(mine):
            packed = np.zeros(len(mine), dtype=np.uint64)
            for i in range(COUNTS[selector]):
                packed |= values[starts[mine] + i] << np.uint64(i * BITS[selector])
            words[first[mine]] |= packed
    escaped = np.flatnonzero(chosen == ESCAPE)
    words[first[escaped] + 1] = values[starts[escaped]]
    offsets = np.concatenate([first[np.searchsorted(owners, np.arange(blocks))], first[-1:]])
    return words, offsets.astype(np.int64)


def unpack(words: np.ndarray, offsets: np.ndarray, n: int, first: int = 0, last: int | None = None) -> np.ndarray:
    """The numbers of the blocks ``first`` to ``last`` (exclusive; all if None) of ``n`` packed numbers.

    ``offsets`` says which words a block has. Blocks are placed by their own numbers, so all words of
    all of them are decoded at once, whatever lies before; no other block's words are touched. Words
    that do not fill their block exactly raise ValueError.
    """
    last = len(offsets) - 1 if last is None else last
    ends = np.minimum((np.arange(first, last) + 1) * BLOCK, n) - first * BLOCK
    if last <= first:
        return np.zeros(0, dtype=np.uint64)
    bounds = np.asarray(offsets[first : last + 1], dtype=np.int64)
    words, bounds = words[bounds[0] : bounds[-1]], bounds - bounds[0]
    selector = (words >> np.uint64(60)).astype(np.int64)
    # An escaped number has more than 60 bits, so it never looks like an escape itself.
    escapes = np.flatnonzero(selector == ESCAPE)
    count = COUNTS[selector]
    count[escapes + 1] = 0
    before = np.concatenate([[0], np.cumsum(count)])
    if not np.array_equal(before[bounds[1:]], ends):
        raise ValueError("packed words do not fill their blocks")
    block = np.repeat(np.arange(last - first), np.diff(bounds))
    at = block * BLOCK + (before[:-1] - before[bounds[:-1]][block])
    selector[escapes + 1] = ESCAPE
    out = np.zeros(ends[-1], dtype=np.uint64)
    for kind in range(1, 15):
        mine = np.flatnonzero(selector == kind)
        if len(mine):
            mask = np.uint64((1 << int(BITS[kind])) - 1)
            word, to = words[mine], at[mine]
            for i in range(COUNTS[kind]):
                out[to + i] = (word >> np.uint64(i * BITS[kind])) & mask
    out[at[escapes]] = words[escapes + 1]
    return out
