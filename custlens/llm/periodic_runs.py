"""Periodic runs of words: maximal stretches that repeat with a period at least four times, by scale-tiled search.

Words q apart are compared per period octave, D <= q < 2D for D = 1, 2, 4, ...: texts are exploded into tiles that begin
every D words, reach back D words and ahead 3D and a period, and so overlap. A run of a period of the octave is long enough
to hold the begin of a tile with 2D equal words ahead of it. Tiles whose first word recurs at a period are kept, and the
Z-functions at their begin (how far do the words ahead, and those behind, equal the words q further on) are taken there for
all tiles at once, by bisection on two hashes modulo primes; each tile is solved independently. The interval found in a tile
is a fragment of the interval where words q apart are equal; it is emitted only if the q words at the begin are no power of
a shorter word, since otherwise a shorter period covers the same run. A fragment's words are compared one by one, and a
batch with a false hash is hashed anew, so results are exact. Fragments are shuffled by (row, period) and stitched; what is
then long enough is a run.

A tile exists as a view of its batch, never as a copy, and tiles go through in pieces of `CELLS` comparisons, so memory
grows with the longest text only. Work is linear per octave. Texts without a fragment leave after the first pass; only the
others meet their runs in a join.

Defined cases: a null or blank text has no words and no runs. Rows are told apart by a number of their own, so repeated rows
and null ids are results each. Columns of the input named `n_words`, `runs` or `collapsed` are replaced; all others stay.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.llm.bpe import CHARS_AT_ONCE, batches_of_texts
from custlens.runtime import materialize, ship_package

WORD = re.compile("[^\x20\x09-\x0d]+")
# A run has at least REPEATS periods and LEAST_WORDS words.
REPEATS = 4
LEAST_WORDS = 6
CELLS = 1 << 20
# The two largest primes below 2³¹.
PRIMES = (2147483647, 2147483629)

FRAGMENTS = "array<struct<period: bigint, first: bigint, last: bigint>>"
RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"


class HashClash(Exception):
    pass


class _Hashes:
    """Is w[a : a + n] equal to w[b : b + n], for arrays of a, b and n? Never wrong on equal words."""

    def __init__(self, codes: np.ndarray, seed: int) -> None:
        rng = np.random.default_rng(seed)
        n = len(codes)
        self.sums, self.powers = [], []
        for p in PRIMES:
            base, turn, shift = (np.uint64(x) for x in rng.integers(2**20, p - 1, 3))
            power = np.ones(n + 1, np.uint64)
            done = 1
            while done <= n:  # doubling: the next powers are those so far, times base ** done
                step = power[done - 1] * base % np.uint64(p)
                upto = min(n + 1, 2 * done)
                power[done:upto] = power[: upto - done] * step % np.uint64(p)
                done *= 2
            mixed = codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            letter = ((mixed >> np.uint64(33)) * turn + shift) % np.uint64(p)
            # sums of n terms below 2³¹ stay below 2⁶³ for any text that fits in memory
            self.sums.append(np.concatenate([np.zeros(1, np.uint64), np.cumsum(letter * power[:n] % np.uint64(p))]))
            self.powers.append(power)

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """For b >= a."""
        same = np.ones(len(a), bool)
        for p, sums, power in zip(PRIMES, self.sums, self.powers):
            left = (sums[a + n] - sums[a]) % np.uint64(p) * power[b - a] % np.uint64(p)
            same &= left == (sums[b + n] - sums[b]) % np.uint64(p)
        return same


def _least_factors(most: int) -> np.ndarray:
    """The smallest prime factor of each number up to `most`."""
    out = np.arange(most + 1)
    for i in range(2, int(most**0.5) + 1):
        if out[i] == i:
            view = out[i * i :: i]
            view[view == np.arange(i * i, most + 1, i)] = i
    return out


def _powers_of_shorter(hashes: _Hashes, begin: np.ndarray, q: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Are the q words from `begin` on a shorter word, repeated?"""
    out, rest = np.zeros(len(q), bool), q.copy()
    while (rest > 1).any():
        factor = factors[rest]
        live = np.flatnonzero(rest > 1)
        shorter = q[live] // factor[live]
        out[live] |= hashes.equal(begin[live], begin[live] + shorter, q[live] - shorter)
        while ((rest % factor == 0) & (factor > 1)).any():
            rest = np.where((rest % factor == 0) & (factor > 1), rest // factor, rest)
    return out


def _reach(same, most: np.ndarray) -> np.ndarray:
    """The greatest n <= `most` with same(n), by bisection; same(0) holds, and same(n) implies all below."""
    low, high = np.zeros(len(most), np.int64), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        held = same(middle)
        low, high = np.where(held, middle, low), np.where(held, high, middle - 1)
    return low


def fragments(codes: np.ndarray, longest: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments (period, first, last) of intervals where codes a period apart are equal: codes[first : last] equals codes[first + period : last + period].

    Equal codes belong to one text, so that no interval leaves it; `longest` is the most words of a text.
    """
    n, found = len(codes), []
    if longest < LEAST_WORDS:
        return (np.zeros(0, np.int64),) * 3
    hashes = _Hashes(codes, seed)
    factors = _least_factors(max(2, longest // REPEATS))
    d = 1
    while REPEATS * d <= longest:
        rows = -(-n // d)
        padded = np.concatenate([codes, np.full(rows * d - n, -1, np.int64)]).reshape(rows, d)
        step = max(1, CELLS // d)
        for lo in range(0, rows - 1, step):
            hi = min(rows - 1, lo + step)
            # the begin of a tile against the words q = d .. 2d - 1 further on
            tile, ahead = np.nonzero(padded[lo:hi, :1] == padded[lo + 1 : hi + 1])
            begin, q = (tile + lo) * d, ahead + d
            room = n - begin - q
            live = (q <= longest // REPEATS) & (room >= 2 * d)
            begin, q, room = begin[live], q[live], room[live]
            live = hashes.equal(begin, begin + q, np.full(len(q), 2 * d))
            begin, q, room = begin[live], q[live], room[live]
            live = ~_powers_of_shorter(hashes, begin, q, factors)
            begin, q, room = begin[live], q[live], room[live]
            if not len(q):
                continue
            ahead = _reach(lambda k: hashes.equal(begin, begin + q, k), np.minimum(3 * d, room))  # noqa: B023
            behind = _reach(lambda k: hashes.equal(begin - k, begin + q - k, k), np.minimum(d, begin))  # noqa: B023
            found.append(_joined(q, begin - behind, begin + ahead))
        d *= 2
    if not found:
        return (np.zeros(0, np.int64),) * 3
    period, first, last = (np.concatenate(c) for c in zip(*found))
    _confirm(codes, period, first, last)
    return period, first, last


def _joined(period: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of one piece of tiles that overlap or touch, as one. Tiles of a period follow each other in steady steps, so ends rise with starts."""
    order = np.lexsort((first, period))
    period, first, last = period[order], first[order], last[order]
    fresh = np.concatenate([[True], (period[1:] != period[:-1]) | (first[1:] > last[:-1])])
    at = np.flatnonzero(fresh)
    return period[at], first[at], np.maximum.reduceat(last, at)


def _confirm(codes: np.ndarray, period: np.ndarray, first: np.ndarray, last: np.ndarray) -> None:
    """Compare the words of every fragment, `CELLS` or one fragment at a time."""
    ends = np.cumsum(last - first)
    bounds = np.unique(np.searchsorted(ends, np.arange(CELLS, ends[-1] + CELLS, CELLS), "right"))
    for a, b in zip([0, *bounds], [*bounds, len(first)]):
        size = last[a:b] - first[a:b]
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[a:b], size)
        if (codes[at] != codes[at + np.repeat(period[a:b], size)]).any():
            raise HashClash


def _coded(texts: list[list[str]]) -> np.ndarray:
    """A number for each word of all texts, equal only for equal words of one text."""
    number: dict[str, int] = {}
    flat = np.fromiter((number.setdefault(w, len(number)) for words in texts for w in words), np.int64)
    text = np.repeat(np.arange(len(texts)), [len(words) for words in texts])
    return flat * len(texts) + text


def fragments_of(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """Per text of a batch its fragments (period, first, last), in words of the text."""
    size = np.array([len(words) for words in texts], np.int64)
    codes = _coded(texts)
    for seed in range(16):
        try:
            period, first, last = fragments(codes, int(size.max(initial=0)), seed)
            break
        except HashClash:
            continue
    else:
        raise ArithmeticError("sixteen pairs of hash functions clashed on one batch")
    begin = np.cumsum(size) - size
    owner = np.searchsorted(begin + size, first, "right")
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for i, p, a, b in zip(owner.tolist(), period.tolist(), (first - begin[owner]).tolist(), (last - begin[owner]).tolist()):
        out[i].append((p, a, b))
    return out


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def _in_batches(df: DataFrame, text: str, fields: list[T.StructField], drop: set[str], compute, *more: str) -> DataFrame:
    """`df` without the columns of `drop`, with `fields` from compute(texts, *lists of more columns) over runs of rows of bounded size."""
    ship_package(df.sparkSession)
    kept = [c for c in df.columns if c.lower() not in drop]
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    asked = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("__text"), *[F.col(c).alias(f"__more{i}") for i, c in enumerate(more)])

    def run(batches):
        for batch in batches:
            texts, rest = batch.column(len(kept)).to_pylist(), [batch.column(len(kept) + 1 + i).to_pylist() for i in range(len(more))]
            for lo, hi in batches_of_texts(texts, CHARS_AT_ONCE):
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, *compute(texts[lo:hi], *[c[lo:hi] for c in rest])], names=[*kept, *[f.name for f in fields]])

    return asked.mapInArrow(run, schema)


def with_fragments(df: DataFrame, text: str) -> DataFrame:
    """`df` with `n_words`, `_fragments` and `collapsed`: the words joined by single spaces, if no fragment is among them, else null."""
    kind = pa.list_(pa.struct([("period", pa.int64()), ("first", pa.int64()), ("last", pa.int64())]))

    def compute(texts: list) -> list[pa.Array]:
        words = [words_of(t) for t in texts]
        found = fragments_of(words)
        plain = pa.array([None if f else " ".join(w) for w, f in zip(words, found)], pa.string())
        return [pa.array(list(map(len, words)), pa.int64()), pa.array([[dict(zip(("period", "first", "last"), x)) for x in f] for f in found], kind), plain]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("_fragments", T._parse_datatype_string(FRAGMENTS)), T.StructField("collapsed", T.StringType())]
    return _in_batches(df, text, fields, {"n_words", "runs", "collapsed", "_fragments"}, compute)


def stitch(found: DataFrame) -> DataFrame:
    """`_row`, `start`, `length`, `period` of the runs that the fragments (`_row`, `period`, `first`, `last`) make up."""
    place = Window.partitionBy("_row", "period").orderBy("first", "last")
    reached = F.max("last").over(place.rowsBetween(Window.unboundedPreceding, -1))
    parts = found.withColumn("_new", F.when(F.col("first") <= reached, 0).otherwise(1)).withColumn("_part", F.sum("_new").over(place))
    whole = parts.groupBy("_row", "period", "_part").agg(F.min("first").alias("start"), F.max("last").alias("_last"))
    length = F.col("_last") + F.col("period") - F.col("start")
    return whole.select("_row", "start", length.alias("length"), "period").where((F.col("length") >= LEAST_WORDS) & (F.col("length") >= REPEATS * F.col("period")))


def without_repeats(words: list[str], runs: list) -> list[str]:
    """The words in no run, or among the first period of every run that holds them."""
    change = np.zeros(len(words) + 1, np.int64)
    for r in runs:
        change[r["start"] + r["period"]] += 1
        change[r["start"] + r["length"]] -= 1
    return [w for w, c in zip(words, np.cumsum(change[:-1])) if not c]


def periodic_runs(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """`df`, without its text unless `keep_text`, with `n_words`, `runs` (`start`, `length`, `period`; by start, then period) and `collapsed`, the text without the repeats of its runs."""
    gone = {"n_words", "runs", "collapsed"} | (set() if keep_text else {text.lower()})
    kept = [c for c in df.columns if c.lower() not in gone]
    # the input goes along in one column, which no name can clash with
    asked = df.select(F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]).alias("_input"), F.col(f"`{text}`").cast("string").alias("_text"), F.monotonically_increasing_id().alias("_row"))
    first = materialize(with_fragments(asked, "_text").withColumn("_text", F.when(F.size("_fragments") > 0, F.col("_text"))))
    out = [*[F.col(f"_input.c{i}").alias(c) for i, c in enumerate(kept)], "n_words", "runs", "collapsed"]
    plain = first.where("size(_fragments) = 0").withColumn("runs", F.array().cast(RUNS)).select(*out)
    some = first.where("size(_fragments) > 0")
    runs = stitch(some.select("_row", F.inline("_fragments"))).groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("_runs"))
    ordered = F.transform("_runs", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    met = some.drop("_fragments", "collapsed").join(runs, "_row", "left").withColumn("runs", F.coalesce(ordered, F.array()).cast(RUNS)).drop("_runs")

    def collapse(texts: list, runs: list) -> list[pa.Array]:
        return [pa.array([" ".join(without_repeats(words_of(t), r)) for t, r in zip(texts, runs)], pa.string())]

    return plain.unionByName(_in_batches(met, "_text", [T.StructField("collapsed", T.StringType())], {"_text"}, collapse, "runs").select(*out))


def longest() -> Column:
    """The longest of `runs`: ties go to the smallest start, then period; null if there is none."""
    better = lambda a, r: (r["length"] > a["length"]) | a["length"].isNull()
    none = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    return F.aggregate("runs", none, lambda a, r: F.when(better(a, r), r).otherwise(a))


def planted(key: str = "doc_id", text: str = "text") -> Column:
    """The text with its end repeated periodically, for one text in ten by a hash of its id; words joined by single spaces."""
    h = F.crc32(F.col(key).cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        size = F.size(w).cast("long")
        a = F.pmod(g, size)
        p = F.lit(1) + F.floor((size - a) / (F.lit(3) + F.pmod(g, F.lit(8))))
        return F.transform(w, lambda x, i: F.when(i < a, x).otherwise(F.get(w, (a + F.pmod(i - a, p)).cast("int"))))

    return F.when((F.pmod(h, F.lit(10)) == 0) & (F.size(words) > 0), F.array_join(F.get(F.transform(F.array(words), repeated), F.lit(0)), " ")).otherwise(F.col(text))
