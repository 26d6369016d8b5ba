"""Byte-pair encoding on ragged numpy arrays: vocabulary tables, pre-tokens of whole batches, and rank-synchronous merging.

A batch of texts is one flat array of code points with an end mark after each text (or at each special token). A class per
code point (letter, number, space, other; read once from the library's own splitter) gives the starts of all pre-tokens by
comparing neighbours, so nothing is done per word in Python. Equal pre-tokens are found by a hash and confirmed byte by byte.

`merge_ragged` applies, in every round and for every sequence, the lowest-rank pair of that sequence at all its places.
That equals merging one pair at a time because each token has exactly one merge that makes it (checked at load): no pair
that holds a new token can rank before the merge that made it.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
from tokenizers import Tokenizer

NO_RANK = np.iinfo(np.int32).max
LETTER, NUMBER, OTHER, SPACE, END, UNKNOWN = 0, 1, 2, 3, 4, 255
END_CODE = 0x110000
CHARS_AT_ONCE = 1_000_000
CACHED_WORDS = 250_000


@functools.cache
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in vocabulary files: itself if printable Latin-1, else the next free one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class Vocabulary:
    """Merge tables of one vocabulary file, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        letters = byte_letters()
        # the id of each byte, and from 256 on that of each byte as the last of a word
        self.symbols = np.array([ids[x] for x in letters] + [ids[x + self.suffix] for x in letters], np.int64)
        self.size = max(max(ids.values()), *self.special.values()) + 1
        texts = [""] * self.size
        for table in (ids, self.special):
            for token, i in table.items():
                texts[i] = token
        self.token_text = texts
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = np.array([ids[a + b] for a, b in pairs], np.int64)
        if len(np.unique(made)) != len(made):
            raise ValueError("two merges make the same token: lowest-rank pairs cannot be applied simultaneously")
        keys = np.array([ids[a] * self.size + ids[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks, self.made = keys[order], order.astype(np.int32), made
        self.joinable = self._joinable(ids)
        library = Tokenizer.from_file(path)
        self._split, self._normal = library.pre_tokenizer.pre_tokenize_str, library.normalizer and library.normalizer.normalize_str
        self.classes = np.full(END_CODE + 1 + len(self.special), UNKNOWN, np.uint8)
        self.classes[END_CODE:] = END
        self.differs = np.zeros(END_CODE + 1 + len(self.special), bool)
        self.seen: set[str] = set()
        self.known_words: dict[bytes, bytes] = {}

    def _joinable(self, ids: dict[str, int]) -> np.ndarray:
        """`[x, y]`: some token holds byte x directly before y; y + 256 is y as the last byte of a word. Every other pair is a certain cut."""
        code = {x: b for b, x in enumerate(byte_letters())}
        out = np.zeros((256, 512), bool)
        for token in ids:
            ends = bool(self.suffix) and token.endswith(self.suffix)
            codes = [code[c] for c in (token[: -len(self.suffix)] if ends else token)]
            if ends:
                codes[-1] += 256
            for x, y in zip(codes, codes[1:]):
                out[x, y] = True
        return out

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def class_of(self, codes: np.ndarray) -> np.ndarray:
        """Class of each code point. One met for the first time is shown to the library's splitter beside characters of known class."""
        out = self.classes[codes]
        if (out == UNKNOWN).any():
            for c in np.unique(codes[out == UNKNOWN]).tolist():
                joins = lambda left, right: len(self._split(left + chr(c) + right)) == 1  # noqa: E731, B023
                # in the vocabulary with word ends a number is a piece of its own and spaces vanish
                digit = joins("1", "") != bool(self.suffix)
                kind = LETTER if joins("a", "a") else OTHER if joins("!", "!") else NUMBER if digit else SPACE
                self.classes[c] = kind
            out = self.classes[codes]
        return out

    def normal(self, text: str) -> str:
        """The library's normal form. Python's own functions make it, but for texts with a character on which the two differ."""
        if not self._normal or text.isascii():
            return text.lower() if self._normal else text
        letters = set(text)
        for c in letters - self.seen:
            self.differs[ord(c)] = self._normal(f"a{c}b") != re.sub(r"\s", " ", _lower(unicodedata.normalize("NFC", f"a{c}b")))
            self.seen.add(c)
        if any(self.differs[ord(c)] for c in letters):
            return self._normal(text)
        return _lower(unicodedata.normalize("NFC", text))


def _lower(text: str) -> str:
    """Lower case character by character: a final sigma is not treated apart."""
    return text.replace("Σ", "σ").lower()


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


# The longest tables so far of the seeds used last: shorter ones are their beginnings.
_hash_tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
KEPT_TABLES = 2


def _new_tables(n: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    base = 0x9E3779B97F4A7C15 + 2 * seed
    steps = [np.full(n + 1, b, np.uint64) for b in (base, pow(base, -1, 2**64))]
    for x in steps:
        x[0] = 1
    powers, inverse = (np.cumprod(x, dtype=np.uint64) for x in steps)
    return np.random.default_rng(seed).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), powers, inverse


def hash_tables(n: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A random odd value per byte, and the powers of a base and of its inverse modulo 2^64: the tables of a range hash of n bytes."""
    size, kept = 1 << max(20, n.bit_length()), _hash_tables.pop(seed, None)
    while len(_hash_tables) >= KEPT_TABLES:
        del _hash_tables[next(iter(_hash_tables))]
    _hash_tables[seed] = kept if kept and len(kept[1]) > size else _new_tables(size, seed)
    return _hash_tables[seed]


@dataclass
class Words:
    """Pre-tokens of a batch. `word`: per pre-token the number of its distinct one; `doc`: per pre-token its text. Specials are numbered after the distinct ones."""

    distinct: list[bytes]
    word: np.ndarray
    doc: np.ndarray
    special_ids: np.ndarray


def _parts(voc: Vocabulary, text: str | None) -> Iterator[tuple[str, int]]:
    """Pieces between special tokens, each with the code that ends it."""
    if not text:
        yield "", END_CODE
        return
    pieces = voc.special_pattern.split(text)
    order = list(voc.special)
    for i in range(0, len(pieces), 2):
        yield voc.normal(pieces[i]), END_CODE if i + 1 == len(pieces) else END_CODE + 1 + order.index(pieces[i + 1])


def pre_tokens(voc: Vocabulary, texts: list[str | None]) -> Words:
    """All pre-tokens of a batch of texts. Null texts have none."""
    parts, ends, owner = [], [], []
    for d, text in enumerate(texts):
        for part, end in _parts(voc, text):
            parts.append(part)
            ends.append(end)
            owner.append(d)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    mark = np.cumsum(lengths + 1) - 1
    joined = "".join(parts)
    codes = np.empty(len(joined) + len(parts), np.uint32)
    inside = np.ones(len(codes), bool)
    inside[mark] = False
    codes[inside] = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    codes[mark] = ends
    kind = voc.class_of(codes)
    before = np.concatenate([[END], kind[:-1]])
    after = np.concatenate([kind[1:], [END]])
    start = kind != before
    if voc.suffix:
        start |= (kind == NUMBER) | (kind == SPACE)
    else:
        blank = codes == 0x20
        start &= ~np.concatenate([[False], blank[:-1]]) | (kind == SPACE) | (kind == END)
        start |= (kind == SPACE) & (after != SPACE) & (after != END)
    start |= kind == END
    apart = np.flatnonzero((codes == 0x27) & start & (after == LETTER) & (before != OTHER))
    if len(apart):
        padded = np.concatenate([codes, np.full(2, END_CODE, codes.dtype)])
        one, two = padded[apart + 1], padded[apart + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        start[apart[short | long] + 1] = False
        start[apart[short] + 2] = True
        start[apart[long] + 3] = True
    first = np.flatnonzero(start)
    doc = np.asarray(owner, np.int64)[np.searchsorted(mark, first)]
    if voc.suffix:
        keep = kind[first] != SPACE
    else:
        keep = np.ones(len(first), bool)
    keep &= codes[first] != END_CODE
    width = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
    width[mark] = 0
    byte_at = np.concatenate([[0], np.cumsum(width)])
    last = np.append(first[1:], len(codes))
    lo, hi = byte_at[first][keep], byte_at[last][keep]
    special = codes[first][keep].astype(np.int64) - END_CODE - 1
    doc = doc[keep]
    flat = joined.encode("utf-8", "surrogatepass")
    data = np.frombuffer(flat, np.uint8)
    special_ids = np.array(list(voc.special.values()), np.int64)
    plain = special < 0
    plo, phi = lo[plain], hi[plain]
    for seed in range(16):
        table, powers, inverse = hash_tables(len(data), seed)
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(table[data] * powers[: len(data)])])
        _, rep, back = np.unique((prefix[phi] - prefix[plo]) * inverse[plo], return_index=True, return_inverse=True)
        if _alike(data, plo, phi, plo[rep][back], phi[rep][back]):
            break
    else:
        raise ArithmeticError("sixteen hash functions clashed on one batch")
    distinct = [flat[a:b] for a, b in zip(plo[rep].tolist(), phi[rep].tolist())]
    word = np.empty(len(plain), np.int64)
    word[plain] = back
    word[~plain] = len(distinct) + special[~plain]
    return Words(distinct, word, doc, special_ids)


def _alike(data: np.ndarray, lo: np.ndarray, hi: np.ndarray, rep_lo: np.ndarray, rep_hi: np.ndarray) -> bool:
    """Whether pre-tokens that got the same hash have the same bytes."""
    n = hi - lo
    if (n != rep_hi - rep_lo).any():
        return False
    inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return bool((data[inside + np.repeat(lo, n)] == data[inside + np.repeat(rep_lo, n)]).all())


def first_symbols(voc: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte codes of all words, flat (256 more on the last byte if the vocabulary marks word ends), and where words start."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
    ends = np.cumsum(lengths)
    if voc.suffix:
        flat[ends - 1] += 256
    return flat, ends - lengths


def gather_ragged(flat: np.ndarray, begin: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Concatenation of `flat[b : b + c]` for all b, c."""
    out_start = np.cumsum(count) - count
    return flat[np.arange(count.sum()) + np.repeat(begin - out_start, count)]


def merge_ragged(voc: Vocabulary, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Apply all merges to every sequence of a flat array of token ids; `starts`: where sequences begin (none is empty).

    Returns the surviving ids, flat, and their number per sequence. Each round merges in every sequence that still changes;
    finished sequences leave the array, and only ranks beside a merge are looked up again.
    """
    n, symbols = len(starts), symbols.copy()
    if not n:
        return symbols, np.zeros(0, np.int64)
    lengths = np.diff(np.append(starts, len(symbols)))
    last = np.zeros(len(symbols), bool)
    last[starts + lengths - 1] = True
    rank = np.full(len(symbols), NO_RANK, np.int32)
    rank[:-1] = voc.ranks(symbols[:-1], symbols[1:])
    rank[last] = NO_RANK
    alive, done = np.arange(n), []
    while True:
        lowest = np.minimum.reduceat(rank, np.cumsum(lengths) - lengths)
        going = lowest < NO_RANK
        if not going.all():
            stay = np.repeat(~going, lengths)
            done.append((alive[~going], lengths[~going], symbols[stay]))
            if not going.any():
                break
            symbols, rank, last = symbols[~stay], rank[~stay], last[~stay]
            alive, lengths, lowest = alive[going], lengths[going], lowest[going]
        at = np.flatnonzero(rank == np.repeat(lowest, lengths))
        # a pair of equal symbols can overlap itself: of each run of chosen places every second one is merged
        fresh = np.concatenate([[True], np.diff(at) > 1])
        run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - run_start) % 2 == 0]
        symbols[at] = voc.made[rank[at]]
        last[at] = last[at + 1]
        keep = np.ones(len(symbols), bool)
        keep[at + 1] = False
        lengths = np.add.reduceat(keep.astype(np.int64), np.cumsum(lengths) - lengths)
        symbols, rank, last = symbols[keep], rank[keep], last[keep]
        moved = at - np.arange(len(at))
        look = np.concatenate([moved, moved[moved > 0] - 1])
        rank[look] = NO_RANK
        look = look[~last[look]]
        rank[look] = voc.ranks(symbols[look], symbols[look + 1])
    who, many, flat = (np.concatenate([d[i] for d in done]) for i in range(3))
    begin, order = np.cumsum(many) - many, np.argsort(who)
    return gather_ragged(flat, begin[order], many[order]), many[order]


def encode_words(voc: Vocabulary, words: list[bytes], encode: Callable[[Vocabulary, list[bytes]], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of each word as (flat, begin, count). `encode` is called for words that are not in the bounded store of this process."""
    store = voc.known_words
    fresh = [w for w in words if w not in store]
    if fresh:
        if len(store) > CACHED_WORDS:
            store.clear()
            fresh = words
        flat, count = encode(voc, fresh)
        raw, ends = flat.astype(np.int32).tobytes(), (4 * np.cumsum(count)).tolist()
        store.update(zip(fresh, [raw[a:b] for a, b in zip([0, *ends], ends)]))
    each = [store[w] for w in words]
    count = np.fromiter(map(len, each), np.int64, len(each)) // 4
    return np.frombuffer(b"".join(each), np.int32), np.cumsum(count) - count, count


def pieces_at_blanks(text: str, size: int = CHARS_AT_ONCE) -> list[str]:
    """A very long text cut before spaces that follow a letter or digit of ASCII: pre-tokens, and normal forms, never reach across such a place."""
    if len(text) <= size:
        return [text]
    out, lo = [], 0
    cut = re.compile("(?<=[A-Za-z0-9]) ")
    while len(text) - lo > size:
        m = cut.search(text, lo + size)
        if not m:
            break
        out.append(text[lo : m.start()])
        lo = m.start()
    return [*out, text[lo:]]


def batches_of_texts(texts: list[str | None], size: int = CHARS_AT_ONCE) -> Iterator[tuple[int, int]]:
    """Row ranges that hold about `size` characters, or one longer text."""
    lo, held = 0, 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > lo and held + n > size:
            yield lo, i
            lo, held = i, 0
        held += n
    if lo < len(texts):
        yield lo, len(texts)
