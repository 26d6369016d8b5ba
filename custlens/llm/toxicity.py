"""Toxic spans and document scores by a linear-chain conditional random field (Lafferty, McCallum and Pereira, 2001).

Chains are sentences: words up to a line's end or a full stop. A word has two states, clean or toxic; its features are its
letters, their first three and last three, hashed to `BUCKETS` weights. Labels are given per document, so words are labelled
first: toxic is a word of a toxic document whose letters stand in toxic documents far more often than in clean ones, by a
likelihood-ratio test over all buckets on *different* contexts (neighbour, word, neighbour) of all words of the labelled texts, so that copies of a text count
once. The field is then fitted on these labelled words by its exact gradient, expected minus observed counts by
forward-backward. Scoring runs forward-backward over every word of every text; words whose marginal is at least `MARGINAL`
make up the offending spans. The sum of a text's squared marginals (plain ones would add up to something in any long text)
and their maximum go through a logistic curve fitted on whole labelled texts, weighted back to all labels: the score.

With two states, forward and backward need one number each, the ratio of both states, so a batch is one recursion over
places for all chains at once. The fit sees at most `fit_rows` labelled texts, half of each label, and `fit_pieces` of their
sentences in pieces of up to `PIECE` words, toxic ones with a toxic word first; only this bounded sample and the counts per bucket go to the driver. Scoring covers all rows in one
narrow pass, and ships one array of weights.

Defined cases: null and texts without words have marginals of zero words and get the score of that. Null, contradicting or
absent labels do not count; of labelled rows with one id, the one whose text has the smallest hash counts. With labels of
one kind only, every score is that kind's smoothed share. Repeated rows are scored each. Columns of the input named
`n_words`, `mass`, `top`, `spans` or `score` are replaced; all others stay.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.llm.batches import add_columns
from custlens.llm.quality_rules import agreed_labels
from custlens.runtime import materialize, ship_package

TOKEN = re.compile("\n|[^\x20\x09-\x0d]+")
NOT_LETTER = re.compile(r"[\W\d_]+")
STOPS = ".!?"
BUCKETS = 1 << 18
FEATURES = 3
PIECE = 256
ACCEPT = 0.7
MARGINAL = 0.5
CACHED_WORDS = 500_000
# A bucket is toxic at this chance of an error over all buckets, if it is also that many times as frequent in toxic texts.
SEED_ERROR = 0.01
SEED_RATIO = 5.0
RIDGE = 2e-4
STEPS = 80

SPANS = "array<struct<start: bigint, end: bigint, marginal: double>>"


def _features(word: str) -> tuple[int, int, int]:
    letters = NOT_LETTER.sub("", word.casefold())
    return tuple(zlib.crc32(f"{kind}{part}".encode("utf-8", "surrogatepass")) % BUCKETS for kind, part in (("w", letters), ("a", letters[:3]), ("z", letters[-3:])))


class Encoder:
    """Words to features; remembers the words it met last."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[int, int, int]] = {}

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Features per word, texts' numbers per word, and lengths of the chains that the words make up in order."""
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        found = [TOKEN.findall(t or "") for t in texts]
        number: dict[str, int] = {"\n": 0}
        flat = np.fromiter((number.setdefault(w, len(number)) for words in found for w in words), np.int64)
        text = np.repeat(np.arange(len(texts)), [len(words) for words in found])
        distinct = list(number)
        for w in distinct:
            if w not in self.known:
                self.known[w] = _features(w)
        table = np.array([self.known[w] for w in distinct], np.int32)
        stops = np.array([w[-1] in STOPS for w in distinct])
        feed = flat == 0
        # a chain ends behind a stop, before a line feed and at the end of its text
        ends = np.ones(len(flat), bool)
        ends[:-1] = stops[flat[:-1]] | feed[1:] | (text[1:] != text[:-1])
        word = ~feed
        chain = np.cumsum(np.concatenate([[0], ends[:-1]]) if len(flat) else ends)[word]
        lengths = np.unique(chain, return_counts=True)[1] if word.any() else np.zeros(0, np.int64)
        return table[flat[word]], text[word], lengths


@dataclass
class Field:
    """Weights of the toxic state by bucket, and log potentials: `step[i, j]` from state i to j, `start` of a toxic first word."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    bias: float = 0.0
    start: float = 0.0
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    def emissions(self, features: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[features].sum(axis=1) + self.bias, -40, 40)

    def marginals(self, emissions: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chance of the toxic state per word, and expected numbers of the four steps."""
        order = np.argsort(-lengths, kind="stable")
        begin, size = (np.cumsum(lengths) - lengths)[order], lengths[order]
        lift, (t00, t01), (t10, t11) = np.exp(emissions), *np.exp(self.step)
        ahead, back = np.empty(len(emissions)), np.ones(len(emissions))
        pairs = np.zeros((2, 2))
        if not len(size):
            return ahead, pairs
        active = np.searchsorted(-size, -np.arange(size[0]), "left")  # chains longer than t
        ahead[begin] = np.exp(self.start) * lift[begin]
        for t in range(1, size[0]):
            at = begin[: active[t]] + t
            r = ahead[at - 1]
            ahead[at] = lift[at] * (t01 + r * t11) / (t00 + r * t10)
        for t in range(size[0] - 1, 0, -1):
            at = begin[: active[t]] + t
            r, s = ahead[at - 1], lift[at] * back[at]
            back[at - 1] = (t10 + t11 * s) / (t00 + t01 * s)
            both = np.array([[np.full(len(at), t00), t01 * s], [r * t10, r * t11 * s]])
            pairs += (both / both.sum(axis=(0, 1))).sum(axis=2)
        odds = ahead * back
        return odds / (1 + odds), pairs


def toxic_buckets(letters: np.ndarray, lengths: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Buckets of letters that mark toxic texts. `letters`: the first feature of all words; `toxic`: is a word's text toxic?"""
    if not len(letters):
        return np.zeros(0, np.int64)
    first = np.zeros(len(letters), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    before = np.where(first, -1, np.concatenate([[-1], letters[:-1]]))
    after = np.concatenate([np.where(first, -1, letters)[1:], [-1]])
    context = np.unique(np.column_stack([before, letters, after, toxic]), axis=0)
    return _marking(*(np.bincount(context[context[:, 3] == y, 1], minlength=BUCKETS) for y in (1, 0)))


def _marking(in_toxic: np.ndarray, in_clean: np.ndarray) -> np.ndarray:
    """Buckets that mark toxic texts, by their numbers of different contexts."""
    a, b = max(1, in_toxic.sum()), max(1, in_clean.sum())
    share, usual = in_toxic / np.maximum(in_toxic + in_clean, 1), a / (a + b)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = in_toxic * np.log(share / usual) + np.where(in_clean > 0, in_clean * np.log((1 - share) / (1 - usual)), 0.0)
    significant = (in_toxic > 0) & (gain > np.log(BUCKETS / SEED_ERROR))
    return np.flatnonzero(significant & (in_toxic / a >= SEED_RATIO * (in_clean + 0.5) / b))


def fit_field(features: np.ndarray, lengths: np.ndarray, states: np.ndarray, steps: int = STEPS) -> Field:
    """The field that makes the labelled `states` likeliest, by full gradients with steps of their own size for each weight (Adam)."""
    model, n = Field(), max(1, len(features))
    first = np.zeros(len(features), bool)
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    inner = np.flatnonzero(~first)
    seen = np.zeros((2, 2))
    np.add.at(seen, (states[inner - 1], states[inner]), 1)
    flat = features.ravel()
    moment, square = np.zeros(BUCKETS + 6), np.zeros(BUCKETS + 6)
    for t in range(1, steps + 1):
        chance, pairs = model.marginals(model.emissions(features), lengths)
        miss = states - chance
        slope = np.concatenate([np.bincount(flat, np.repeat(miss, FEATURES), BUCKETS), [miss.sum(), miss[first].sum()], (seen - pairs).ravel()])
        now = np.concatenate([model.weights, [model.bias, model.start], model.step.ravel()])
        slope = slope / n - RIDGE / n * now
        moment, square = 0.9 * moment + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        now += 0.3 * (moment / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.99**t)) + 1e-12)
        model = Field(now[:BUCKETS], float(now[BUCKETS]), float(now[BUCKETS + 1]), now[BUCKETS + 2 :].reshape(2, 2))
    return model


@dataclass
class Scorer:
    field: Field
    curve: np.ndarray

    def score(self) -> Column:
        """Of a text with `mass` and `top`."""
        a, b, c = (F.lit(float(x)) for x in self.curve)
        return 1 / (1 + F.exp(-(a + b * F.log1p("mass") + c * F.col("top"))))


def fit_curve(mass: np.ndarray, top: np.ndarray, toxic: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Logistic curve over a text's marginals, by Newton's method."""
    share = ((toxic * weight).sum() + 1) / (weight.sum() + 2)
    curve = np.array([np.log(share / (1 - share)), 0.0, 0.0])
    if not len(toxic) or toxic.min() == toxic.max():
        return curve
    x = np.column_stack([np.ones(len(mass)), np.log1p(mass), top])
    penalty = np.array([0.0, ridge, ridge]) * weight.sum()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ curve, -30, 30)))
        slope = x.T @ (weight * (toxic - p)) - penalty * curve
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty + 1e-9)
        move = np.linalg.solve(bend, slope)
        curve = curve + np.clip(move, -5, 5)
        if np.abs(move).max() < 1e-10:
            break
    return curve


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _draw(rows: DataFrame, order: Column, n: int, count: int) -> DataFrame:
    """The `n` of `count` rows that come first by the hash `order`; no task sends more than its part of them."""
    share = min(1.0, 1.5 * n / max(1, count))
    return rows.where(order < F.lit(int((2 * share - 1) * (2**63 - 1024)))).orderBy(order).limit(n) if share < 1 else rows


def _pieces(sample: DataFrame) -> DataFrame:
    """`_label`, `features` (of each word in turn) of the sentences of the sample, in pieces."""
    ship_package(sample.sparkSession)

    def run(batches):
        encode = Encoder()
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                features, _, lengths = encode([text])
                ends = np.cumsum(lengths)
                cuts = np.unique(np.concatenate([[0], ends, *[np.arange(a, b, PIECE) for a, b in zip(ends - lengths, ends) if b - a > PIECE]])).astype(np.int32)
                if len(features):
                    lists = pa.ListArray.from_arrays(pa.array(cuts * FEATURES), pa.array(features.ravel()))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(cuts) - 1, label, np.int32)), lists], names=["_label", "features"])

    return sample.select("_label", "_text").mapInArrow(run, "_label int, features array<int>")


LETTERS = "transform(sequence(0, size(features) div 3 - 1), i -> features[3 * i])"
CONTEXTS = "transform(letters, (w, i) -> struct(if(i > 0, letters[i - 1], -1) AS before, w, if(i < size(letters) - 1, letters[i + 1], -1) AS after))"


def _context_counts(pieces: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Different contexts of each bucket of letters in toxic and in clean pieces. One row per bucket goes to the driver."""
    each = pieces.select("_label", F.expr(LETTERS).alias("letters")).select("_label", F.explode(F.expr(CONTEXTS)).alias("c")).select("_label", "c.*").distinct()
    found = each.groupBy("w").agg(F.count_if(F.col("_label") == 1).alias("toxic"), F.count_if(F.col("_label") == 0).alias("clean")).toPandas()
    return tuple(np.bincount(found["w"].to_numpy(np.int64), found[c].to_numpy(float), BUCKETS) for c in ("toxic", "clean"))


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", value: str = "toxic", fit_rows: int = 8_000, fit_pieces: int = 40_000) -> Scorer:
    """Fitted on at most `fit_rows` labelled texts that are not held out, and `fit_pieces` pieces of their sentences."""
    learn = materialize(agreed_labels(labels.where(~held_out(key)), value, key))
    many = {r._label: r["count"] for r in learn.groupBy("_label").count().collect()}
    drawn = [_draw(learn.where(F.col("_label") == y), F.xxhash64("_id", F.lit(13)), fit_rows // 2, many.get(y, 0)) for y in (0, 1)]
    chosen = F.broadcast(materialize(drawn[0].unionByName(drawn[1])))  # fit_rows rows of two numbers
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{key}`").alias("_id"), whole.alias("_text")).join(chosen, "_id")
    one = rows.groupBy("_id", "_label").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("_one"))
    sample = materialize(one.select("_id", "_label", F.col("_one._text").alias("_text")))

    pieces = materialize(_pieces(sample))
    seeds = np.zeros(BUCKETS, bool)
    seeds[_marking(*_context_counts(pieces))] = True
    # pieces with a toxic word come first: a rare word would have too few in a plain draw
    seeded = F.arrays_overlap(F.expr(LETTERS), F.lit(np.flatnonzero(seeds).tolist()).cast("array<int>")) & (F.col("_label") == 1)
    pieces = pieces.withColumn("_seeded", seeded)
    of = {(r._label, r._seeded): r["count"] for r in pieces.groupBy("_label", "_seeded").count().collect()}
    hashed, parts = F.xxhash64("features", F.lit(17)), []
    for y, first, n in ((1, True, fit_pieces // 2), (1, False, fit_pieces // 2 - min(fit_pieces // 2, of.get((1, True), 0))), (0, False, fit_pieces // 2)):
        drawn = _draw(pieces.where((F.col("_label") == y) & (F.col("_seeded") == first)), hashed, n, of.get((y, first), 0))
        parts.append(drawn.orderBy(hashed).limit(n).select("_label", "features").toPandas())
    taken = pd.concat(parts)
    features = np.concatenate([np.zeros(0, np.int32), *taken["features"]]).reshape(-1, FEATURES)
    lengths = np.array([len(f) // FEATURES for f in taken["features"]], np.int64)
    toxic = np.repeat(taken["_label"].to_numpy(bool), lengths)
    model = fit_field(features, lengths, (toxic & seeds[features[:, 0]]).astype(np.int64))

    seen = with_marginals(sample, model, "_text").select("_label", "mass", "top").toPandas()
    y = seen["_label"].to_numpy(float)
    weight = np.where(y == 1, many.get(1, 0) / max(1, (y == 1).sum()), many.get(0, 0) / max(1, (y == 0).sum()))
    return Scorer(model, fit_curve(seen["mass"].to_numpy(), seen["top"].to_numpy(), y, weight))


def _spans(text: str, chance: np.ndarray, lengths: list[int]) -> list[dict]:
    """Runs of words of one chain with a marginal of at least `MARGINAL`, as places of characters, with their highest marginal."""
    out: list[dict] = []
    places = [m.span() for m in TOKEN.finditer(text) if m.group() != "\n"]
    first = np.zeros(len(places) + 1, bool)
    first[np.cumsum([0, *lengths])] = True
    last = -2
    for i in np.flatnonzero(chance >= MARGINAL).tolist():
        if i == last + 1 and not first[i]:
            out[-1] |= {"end": places[i][1], "marginal": max(out[-1]["marginal"], float(chance[i]))}
        else:
            out.append({"start": places[i][0], "end": places[i][1], "marginal": float(chance[i])})
        last = i
    return out


def with_marginals(df: DataFrame, model: Field, text: str = "text", keep_text: bool = False) -> DataFrame:
    """`df` with `n_words`, the sum `mass` of the squares and the maximum `top` of the words' toxic marginals, and the offending `spans`."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights
    encode = Encoder()
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("marginal", pa.float64())]))

    def compute(texts: list) -> list[pa.Array]:
        features, owner, lengths = encode(texts)
        field_ = shared.value
        chance, _ = field_.marginals(field_.emissions(features), lengths)
        n = len(texts)
        words, mass, top = np.bincount(owner, minlength=n), np.bincount(owner, chance * chance, n).astype(float), np.zeros(n)
        np.maximum.at(top, owner, chance)
        ends, chains, spans = np.cumsum(words), np.cumsum(lengths), []
        for i in range(n):
            if top[i] >= MARGINAL:
                lo, hi = ends[i] - words[i], ends[i]
                own = lengths[np.searchsorted(chains, lo, "right") : np.searchsorted(chains, hi, "left") + 1]
                spans.append(_spans(texts[i], chance[lo:hi], own.tolist()))
            else:
                spans.append([])
        return [pa.array(words, pa.int64()), pa.array(mass, pa.float64()), pa.array(top), pa.array(spans, kind)]

    fields = [T.StructField("n_words", T.LongType()), T.StructField("mass", T.DoubleType()), T.StructField("top", T.DoubleType()), T.StructField("spans", T._parse_datatype_string(SPANS))]
    return add_columns(df, text, fields, compute, keep_text=keep_text)


def with_score(df: DataFrame, model: Scorer, text: str = "text", keep_text: bool = False) -> DataFrame:
    """`with_marginals`, and the document's `score`."""
    return with_marginals(df, model.field, text, keep_text).withColumn("score", model.score())
