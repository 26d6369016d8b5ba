"""Statistics of whole texts, computed for a batch of texts at once on its UTF-8 bytes.

Texts of a batch are joined by line feeds into one byte array; words, lines and windows are ranges of it. Equal lines and
equal five-word windows of a text are found by sorting 64-bit hashes and confirmed byte by byte; should two different ones
share a hash, the batch is hashed anew with other factors.
"""

from __future__ import annotations

import numpy as np

from custlens.llm.bpe import hash_tables

WINDOW = 5
BASE = ["n_bytes", "n_chars", "n_lines", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_bangs"]
MORE = ["n_digits", "n_stops", "n_not_ascii", "n_spaces", "n_short_words", "n_long_words", "sum_squares", "n_same_next", "n_distinct_words", "n_caps_words"]


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in chars]] = True
    return out


# White space, symbols.
BLANK = _table(" \t\n\x0b\x0c\r")
SYMBOL = _table("#*$%&|<>")
UPPER = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
DIGIT, STOP, BANG = _table("0123456789"), _table(".,;:!?"), _table("!")


class HashClash(Exception):
    pass


def measure(texts: list[str | None], more: bool = False) -> dict[str, np.ndarray]:
    """The `BASE` statistics of each text, and with `more` those of `MORE`; all are counts. A null text is empty."""
    if not texts:
        return {c: np.zeros(0, np.int64) for c in BASE + MORE}
    for seed in range(16):
        try:
            return _measure([t or "" for t in texts], more, seed)
        except HashClash:
            continue
    raise ArithmeticError("sixteen hash functions clashed on one batch")


def _measure(texts: list[str], more: bool, seed: int) -> dict[str, np.ndarray]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b""]), np.uint8)  # each text with a line feed behind it
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    end = np.cumsum(size + 1)
    edges = np.concatenate([[0], end])

    def per_text(flags: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return total[edges[1:]] - total[edges[:-1]]

    blank = BLANK[data]
    begins = (data & 0xC0) != 0x80
    out = {"n_bytes": size, "n_chars": per_text(begins) - 1, "word_chars": per_text(begins & ~blank), "n_symbols": per_text(SYMBOL[data])}
    out["n_upper"] = per_text(_upper(data))
    out["n_bangs"] = per_text(BANG[data])
    feeds = np.flatnonzero(data == 0x0A)
    out["n_lines"] = per_text(data == 0x0A)

    was_blank = np.concatenate([[True], blank[:-1]])
    lo = np.flatnonzero(~blank & was_blank)
    hi = np.flatnonzero(blank & ~was_blank)
    doc = np.searchsorted(end, lo, "right")
    n = len(texts)
    out["n_words"] = np.bincount(doc, minlength=n)

    table, powers, inverse = hash_tables(len(data), seed)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * powers[: len(data)])])
    code = lambda a, b: (prefix[b] - prefix[a]) * inverse[a]
    mix = lambda d: d.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)

    line_lo, line_hi = np.concatenate([[0], feeds[:-1] + 1]), feeds
    words_before = np.searchsorted(lo, np.concatenate([line_lo, [len(data)]]))
    full = np.diff(words_before) > 0
    line_lo, line_hi = line_lo[full], line_hi[full]
    line_doc = np.searchsorted(end, line_lo, "right")
    again, first = _repeats(code(line_lo, line_hi) + mix(line_doc))
    _same(data, line_lo[again], line_hi[again], line_lo[first], line_hi[first], line_doc[again] == line_doc[first])
    out["n_dup_lines"] = np.bincount(line_doc[again], minlength=n)

    word = code(lo, hi)
    out["n_repeat_words"] = np.zeros(n, np.int64)
    if len(word) >= WINDOW:
        m = len(word) - WINDOW + 1
        window = mix(doc[:m])
        for k in range(WINDOW):
            window = window * np.uint64(0x9FB21C651E98DF25) + word[k : m + k]
        inside = np.flatnonzero(doc[:m] == doc[WINDOW - 1 :])
        again, first = _repeats(window[inside])
        again, first = inside[again], inside[first]
        for k in range(WINDOW):
            _same(data, lo[again + k], hi[again + k], lo[first + k], hi[first + k], doc[again] == doc[first])
        covered = np.zeros(len(word) + 1, np.int64)
        marked = np.concatenate([again, np.unique(first)])
        np.add.at(covered, marked, 1)
        np.add.at(covered, marked + WINDOW, -1)
        out["n_repeat_words"] = np.bincount(doc, weights=np.cumsum(covered)[:-1] > 0, minlength=n).astype(np.int64)
    if more:
        length = hi - lo
        out["n_digits"], out["n_stops"] = per_text(DIGIT[data]), per_text(STOP[data])
        out["n_not_ascii"], out["n_spaces"] = per_text((data >= 0x80) & begins), per_text(blank) - 1
        summed = lambda w: np.bincount(doc, weights=w, minlength=n).astype(np.int64)
        out["n_short_words"], out["n_long_words"], out["sum_squares"] = summed(length <= 3), summed(length >= 12), summed(length**2)
        out["n_same_next"] = summed(np.concatenate([[False], (word[1:] == word[:-1]) & (doc[1:] == doc[:-1])]) if len(word) else length)
        again, _ = _repeats(word + mix(doc))  # a clash of hashes here only shifts a statistic by one
        out["n_distinct_words"] = out["n_words"] - np.bincount(doc[again], minlength=n)
        caps = np.concatenate([[0], np.cumsum(_upper(data))])
        out["n_caps_words"] = summed((caps[hi] - caps[lo] >= 2) & (2 * (caps[hi] - caps[lo]) > length))
    return out


def _upper(data: np.ndarray) -> np.ndarray:
    """Capitals of ASCII and of Latin-1."""
    lead = np.concatenate([[False], data[:-1] == 0xC3])
    return UPPER[data] | lead & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)


def _repeats(code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose code stood earlier, and for each the first place of that code."""
    order = np.argsort(code, kind="stable")
    ranked = code[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])[: len(code)]
    first = order[np.maximum.accumulate(np.where(fresh, np.arange(len(code)), 0))] if len(code) else order
    return order[~fresh], first[~fresh]


def _same(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, rep_lo: np.ndarray, rep_hi: np.ndarray, alike: np.ndarray) -> None:
    n = hi - lo
    if not alike.all() or (n != rep_hi - rep_lo).any():
        raise HashClash
    step = 4_000_000
    bounds = np.searchsorted(np.cumsum(n), np.arange(step, n.sum() + step, step)) + 1
    for a, b in zip([0, *bounds], bounds):
        part = n[a:b]
        at = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
        if (data[at + np.repeat(lo[a:b], part)] != data[at + np.repeat(rep_lo[a:b], part)]).any():
            raise HashClash
