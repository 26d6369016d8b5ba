"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics come from one narrow pass over the texts (`text_stats`). Trees are grown level by level on binned features, by
sums of gradients per node, feature and bin, and are flattened into arrays in heap order (children of i: 2i + 1, 2i + 2), so
that a batch of rows goes through all trees by a few numpy takes. The fit uses a sample of labelled rows of at most
`fit_rows` (a share of all, those with the smallest hash of the id), which alone goes to the driver; scoring covers every row.

Defined cases: null and empty texts have all statistics 0 and get a score like others. Null, contradicting or absent labels
do not count. With labels of one kind only, every score is that kind's smoothed share. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.llm import text_stats
from custlens.llm.batches import add_columns
from custlens.llm.quality_rules import agreed_labels
from custlens.runtime import materialize, ship_package

COUNTS = text_stats.BASE + text_stats.MORE
# Features: counts on a log scale, and shares (count over count).
SCALES = ["n_words", "n_lines"]
SHARES = [
    ("word_chars", "n_words"), ("n_symbols", "word_chars"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"), ("n_upper", "word_chars"), ("n_bangs", "n_words"),
    ("n_digits", "word_chars"), ("n_stops", "n_words"), ("n_not_ascii", "n_chars"), ("n_spaces", "n_chars"), ("n_short_words", "n_words"), ("n_long_words", "n_words"),
    ("sum_squares", "n_words"), ("n_same_next", "n_words"), ("n_distinct_words", "n_words"), ("n_caps_words", "n_words"), ("n_words", "n_lines"),
]
ACCEPT = 0.7


def with_statistics(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    def compute(texts: list) -> list[pa.Array]:
        found = text_stats.measure(texts, more=True)
        return [pa.array(found[c], pa.int64()) for c in COUNTS]

    return add_columns(df, text, [T.StructField(c, T.LongType()) for c in COUNTS], compute, keep_text=keep_text)


def features(counts: pd.DataFrame) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        shares = [np.where(counts[b] > 0, counts[a] / np.maximum(counts[b], 1), 0.0) for a, b in SHARES]
    return np.column_stack([*[np.log1p(counts[c]) for c in SCALES], *shares])


@dataclass
class Trees:
    """All trees in heap order: `feature[t, i] < 0` never sends a row right; `value[t, leaf]` is added to the log odds."""

    start: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        depth = (self.feature.shape[1] + 1).bit_length() - 1
        rows, total = np.arange(len(x)), np.full(len(x), self.start)
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                f = feature[node]
                node = 2 * node + 1 + ((f >= 0) & (x[rows, f] > cut[node]))
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, ridge: float = 2.0, least_hessian: float = 2.0) -> Trees:
    """Boosted trees for the log loss. `x`: rows by features; `y`: 0 or 1."""
    n, k = x.shape
    inner, leaves = 2**depth - 1, 2**depth
    share = (y.sum() + 1) / (n + 2)
    model = Trees(float(np.log(share / (1 - share))), np.full((trees, inner), -1), np.zeros((trees, inner)), np.zeros((trees, leaves)))
    if n == 0 or y.min() == y.max():
        return model
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(k)]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])
    place = binned + np.arange(k) * bins
    total = np.full(n, model.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, bend = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            cell = ((node - first)[:, None] * (k * bins) + place).ravel()
            g, h = (np.bincount(cell, np.repeat(w, k), width * k * bins).reshape(width, k, bins).cumsum(axis=2) for w in (slope, bend))
            all_g, all_h = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
            gain[(h < least_hessian) | (all_h - h < least_hessian)] = 0.0
            best = gain.reshape(width, -1).argmax(axis=1)
            for i in range(width):
                j, b = divmod(int(best[i]), bins)
                if gain[i, j, b] > 1e-9 and b < len(cuts[j]):
                    model.feature[t, first + i], model.cut[t, first + i] = j, cuts[j][b]
            f = model.feature[t, node]
            node = 2 * node + 1 + ((f >= 0) & (x[np.arange(n), f] > model.cut[t, node]))
        leaf = node - inner
        model.value[t] = rate * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, bend, leaves) + ridge)
        total += model.value[t][leaf]
    return model


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_on(stats: DataFrame, labels: DataFrame, key: str = "doc_id", fit_rows: int = 20_000) -> Trees:
    """Trees fitted on at most `fit_rows` labelled rows that are not held out."""
    learn = agreed_labels(labels.where(~held_out(key)), key=key)
    known = materialize(stats.select(F.col(key).alias("_id"), *COUNTS).join(learn, "_id"))
    share = fit_rows / max(1, known.count())
    if share < 1:  # so that no partition sends more than its part of the sample
        known = known.where(F.xxhash64("_id", F.lit(3)) < F.lit(int((2 * share - 1) * 2**63)))
    sample = known.orderBy(F.xxhash64("_id", F.lit(3)), "_id", *COUNTS).limit(fit_rows).toPandas()
    return fit(features(sample), sample["_label"].to_numpy(float))


def with_score(stats: DataFrame, model: Trees, out: str = "score") -> DataFrame:
    ship_package(stats.sparkSession)

    @F.pandas_udf("double")
    def score(columns: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for each in columns:
            yield pd.Series(model.score(features(pd.DataFrame(dict(zip(COUNTS, each))))))

    return stats.withColumn(out, score(*COUNTS))
