"""Banded alignment of word sequences: is their edit similarity, 1 - edits / words of the longer one, at least a threshold?"""

from __future__ import annotations

import numpy as np

# Cells of the diagonal matrix that may stand in memory; beyond it rows of the band are computed one by one.
MATRIX_CELLS = 8_000_000
FIRST_BAND = 8


def similarity(a: list, b: list, least: float) -> float:
    """Edit similarity of two sequences by the narrowest band that shows at least `least`, or 0 if no alignment does.

    Equal ends are cut off and a bound from the bags of words rejects most unlike pairs. A path inside a band is an
    alignment, so a narrow band can accept; only the band of the largest distance that matters can reject. The value is
    that of the alignment found (the true one is no smaller). Two empty sequences have 1.
    """
    longer = max(len(a), len(b))
    if not longer:
        return 1.0
    most = int(np.floor((1 - least) * longer + 1e-9))
    if abs(len(a) - len(b)) > most:
        return 0.0
    number: dict = {}
    x = np.fromiter((number.setdefault(w, len(number)) for w in a), np.int64, len(a))
    y = np.fromiter((number.setdefault(w, len(number)) for w in b), np.int64, len(b))
    shared = np.minimum(np.bincount(x, minlength=len(number)), np.bincount(y, minlength=len(number))).sum()
    bound = longer - int(shared)
    if bound > most:
        return 0.0
    x, y = _middle(x, y)
    band = abs(len(x) - len(y)) + FIRST_BAND
    while True:
        band = min(band, most)
        d = distance(x, y, band, most)
        if d is not None:
            return 1 - d / longer
        if band == most:
            return 0.0
        band *= 4


def _middle(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[:n] != y[:n])
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    n = min(len(x), len(y))
    differ = np.flatnonzero(x[len(x) - n :][::-1] != y[len(y) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    return x[: len(x) - tail], y[: len(y) - tail]


def distance(x: np.ndarray, y: np.ndarray, band: int, most: int) -> int | None:
    """Edits of the best alignment that stays on diagonals -band .. band, if at most `most`, else None."""
    if abs(len(x) - len(y)) > band:
        return None
    if not len(x) or not len(y):
        d = max(len(x), len(y))
        return d if d <= most else None
    if (2 * band + 1) * (len(x) + 2) <= MATRIX_CELLS:
        return _by_diagonals(x, y, band, most)
    return _by_rows(x, y, band, most)


def _by_diagonals(x: np.ndarray, y: np.ndarray, band: int, most: int) -> int | None:
    """Furthest place reached on each diagonal with 0, 1, 2, ... edits; `stop[k, i]` is the next mismatch from i on."""
    n, m = len(x), len(y)
    shift = np.arange(-band, band + 1)
    stop = np.empty((2 * band + 1, n + 2), np.int32)
    place = np.arange(n + 2, dtype=np.int32)
    for row, k in enumerate(range(-band, band + 1)):
        lo, hi = max(0, -k), max(0, -k, min(n, m - k))
        stop[row, :lo] = place[:lo]
        stop[row, hi:] = np.minimum(place[hi:], n)
        ahead = np.where(x[lo:hi] != y[lo + k : hi + k], place[lo:hi], np.int32(hi))
        stop[row, lo:hi] = np.minimum.accumulate(ahead[::-1])[::-1]
    rows, goal, none, limit = np.arange(2 * band + 1), m - n + band, -(2**30), np.minimum(n, m - shift)
    reach = np.full(2 * band + 3, none, np.int64)  # one more diagonal on each side
    reach[band + 1] = stop[band, 0]
    for d in range(most + 1):
        if d:
            inner = np.minimum(np.maximum(np.maximum(reach[1:-1] + 1, reach[2:] + 1), reach[:-2]), limit)
            live = inner >= 0
            inner[live] = stop[rows[live], inner[live]]
            inner[~live] = none
            reach[1:-1] = inner
        if reach[goal + 1] >= n:
            return d
    return None


def _by_rows(x: np.ndarray, y: np.ndarray, band: int, most: int) -> int | None:
    n, m, width, far = len(x), len(y), 2 * band + 1, 2**30
    step = np.arange(width)
    j = step - band
    row = np.where((j >= 0) & (j <= m), j, far)
    for i in range(1, n + 1):
        j = i + step - band
        inside = (j >= 1) & (j <= m)
        match = np.where(inside, y[np.clip(j - 1, 0, m - 1)] != x[i - 1], True)
        new = np.minimum(np.where(inside, row + match, far), np.append(row[1:], far) + 1)
        new[j == 0] = i
        new[(j < 0) | (j > m)] = far
        row = np.minimum.accumulate(new - step) + step
        row[(j < 0) | (j > m)] = far
        if row.min() > most:
            return None
    d = int(row[m - n + band])
    return d if d <= most else None
