"""Word-aligned integer coding: a 4-bit selector and 60 bits of equally wide values per 64-bit word."""

from __future__ import annotations

import numpy as np

# Count and width of the values of a word, by selector.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
# The widest value of selector 15 marks an escape: the next word holds the value in all its 64 bits.
ESCAPE = (1 << 60) - 1


#: The narrowest width that holds a value, by its bit length; 255 for values that need an escape.
WIDTH_OF = np.array([min(w for w in WIDTHS if w >= b) for b in range(61)] + [255] * 4, np.uint8)


def _widths(values: np.ndarray) -> np.ndarray:
    """The narrowest width of each value, 255 for those that need an escape."""
    if values.max() < 1 << 53:
        return WIDTH_OF[np.frexp(values.astype(np.float64))[1]]
    high = WIDTH_OF[np.frexp((values >> np.uint64(32)).astype(np.float64))[1] + 32]
    widths = np.where(values >> np.uint64(32) != 0, high, WIDTH_OF[np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]])
    widths[values >= ESCAPE] = 255
    return widths


def _steps(bits: np.ndarray) -> np.ndarray:
    """Selector that packs most values, at each position; behind the end any value fits."""
    widest: dict[int, np.ndarray] = {1: bits}

    def over(count: int) -> np.ndarray:
        """Largest bit length of `count` values from each position on, from two overlapping shorter ranges."""
        if count not in widest:
            half = over((count + 1) // 2)
            moved = np.zeros_like(half)
            shift = count - (count + 1) // 2
            moved[:-shift or None] = half[shift:] if shift < len(half) else 0
            widest[count] = np.maximum(half, moved)
        return widest[count]

    narrowest = bits.min()
    selector = np.full(len(bits), 15, np.uint8)
    for s in range(14, -1, -1):
        if WIDTHS[s] >= narrowest:
            np.copyto(selector, np.uint8(s), where=over(COUNTS[s]) <= WIDTHS[s])
    return selector


def encode(values: np.ndarray) -> np.ndarray:
    """Words of up to 64-bit unsigned values; the reader must know their number."""
    values = np.ascontiguousarray(values, dtype=np.uint64)
    n = len(values)
    if not n:
        return np.zeros(0, np.uint64)
    bits = _widths(values)
    selectors = _steps(bits)
    step = np.array(COUNTS)[selectors].tolist()
    at, starts = 0, []
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts)
    chosen = selectors[starts]
    padded = np.append(values, np.zeros(max(COUNTS), np.uint64))
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in np.unique(chosen).tolist():
        if WIDTHS[s]:
            rows = np.flatnonzero(chosen == s)
            own = starts[rows]
            packed = words[rows]
            for k in range(COUNTS[s]):
                packed |= np.minimum(padded[own + k], np.uint64(ESCAPE)) << np.uint64(k * WIDTHS[s])
            words[rows] = packed
    escaped = np.flatnonzero(bits[starts] == 255)
    return np.insert(words, escaped + 1, values[starts[escaped]]) if len(escaped) else words


def decode(words: np.ndarray, n: int) -> np.ndarray:
    """The n values of the words, all words of a selector at once."""
    words = np.ascontiguousarray(words, dtype=np.uint64)
    if not n:
        return np.zeros(0, np.uint64)
    mark = np.uint64((15 << 60) | ESCAPE)
    escapes = words == mark
    if escapes.any():
        # A raw word may look like a mark itself; marks are those that no mark stands before.
        raw = np.zeros(len(words), bool)
        for k in np.flatnonzero(escapes).tolist():
            if not raw[k]:
                raw[k + 1] = True
        kept = words[~raw]
        values = words[raw]
        escapes = kept == mark
    else:
        kept, values = words, words[:0]
    selectors = (kept >> np.uint64(60)).astype(np.uint8)
    counts = np.array(COUNTS)[selectors]
    starts = np.cumsum(counts) - counts
    out = np.zeros(max(int(counts.sum()), n), np.uint64)
    for s in np.unique(selectors).tolist():
        if WIDTHS[s]:
            rows = np.flatnonzero(selectors == s)
            mask, own, packed = np.uint64((1 << WIDTHS[s]) - 1), starts[rows], kept[rows]
            for k in range(COUNTS[s]):
                out[own + k] = (packed >> np.uint64(k * WIDTHS[s])) & mask
    out[starts[escapes]] = values
    return out[:n]
