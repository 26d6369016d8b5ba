"""Quality rules whose cutoffs are risk-controlled.

Each rule bounds one share of a text (symbols, repeated lines, repeated windows, capitals, exclamation marks, word length).
Per stratum (language) a ladder of stricter and stricter sets of cutoffs is read off the good labelled texts of one half of
the labels. On the other half, the sets of a stratum are tested in this order by the exact binomial test of "it rejects more
than `risk` of the good texts", until one is not rejected; those before it are certified. Testing in a fixed order that stops
there needs no correction over the steps; over the strata `confidence` is divided by their number (Bonferroni). Of the certified sets
the loosest is taken that rejects nearly as many bad texts as any. So with probability 1 - `confidence` no stratum rejects
more than `risk` of its good texts. A stratum without a certified set (too few labels) rejects nothing by these rules.

Statistics are one narrow pass over the texts, written once; counts of labels are partial aggregates; only the number of
strata goes to the driver. Defined cases: a null text has no words; null strata are one stratum; labels that are null or
contradict each other for one id do not count; rows with a null id have no label and are judged like others; repeated rows
are judged each.
"""

from __future__ import annotations

import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.llm import text_stats
from custlens.llm.batches import add_columns
from custlens.runtime import materialize, ship_package

# Base rules of the contract: fewer words are too few; more than this percentage of repeated words is too much.
LEAST_WORDS = 10
MOST_REPEATED = 20

# Steps of the ladder, loosest first: the share of good texts beyond a rule's cutoff, and how much further out the cutoff lies,
# as a part of its distance from the median. The highest values of one half are exceeded in the other, so it starts beyond them.
LADDER = ((0.0, 1.0), (0.0, 0.5), (0.0, 0.2), (0.0, 0.0), (0.0005, 0.0), (0.001, 0.0), (0.002, 0.0), (0.004, 0.0))

# Labels have errors of their own: a few in a hundred texts labelled good are plain junk, which any useful cutoff rejects, so a
# risk near that share can not be certified. The strictest step of the ladder rejects about 2 % of texts like the good ones.
RISK = 0.1

RULES: dict[str, tuple[str, str]] = {
    "symbols": ("n_symbols", "word_chars"),
    "same_lines": ("n_dup_lines", "n_lines"),
    "same_windows": ("n_repeat_words", "n_words"),
    "capitals": ("n_upper", "word_chars"),
    "bangs": ("n_bangs", "n_words"),
    "word_length": ("word_chars", "n_words"),
}


def share(rule: str) -> Column:
    over, under = RULES[rule]
    return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(F.lit(0.0))


def with_statistics(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    def compute(texts: list) -> list[pa.Array]:
        found = text_stats.measure(texts)
        return [pa.array(found[c], pa.int64()) for c in text_stats.BASE]

    return add_columns(df, text, [T.StructField(c, T.LongType()) for c in text_stats.BASE], compute, keep_text=keep_text)


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (F.lit(100) * F.col("n_repeat_words") > F.lit(MOST_REPEATED) * F.col("n_words"))


def at_most(rejected: int, good: int, risk: float) -> float:
    """P(X <= rejected) for X binomial with `good` draws of probability `risk`: the p-value of "more than `risk` is rejected"."""
    if rejected >= good * risk:
        return 1.0
    log = math.lgamma(good + 1) - math.lgamma(rejected + 1) - math.lgamma(good - rejected + 1) + rejected * math.log(risk) + (good - rejected) * math.log1p(-risk)
    term, total, k = math.exp(log), 0.0, rejected
    while k >= 0 and term > total * 1e-17:
        total += term
        term *= k / (good - k + 1) * (1 - risk) / risk
        k -= 1
    return min(1.0, total)


def agreed_labels(labels: DataFrame, value: str = "quality", key: str = "doc_id") -> DataFrame:
    """One label per id: ids that are null, unlabelled or labelled both ways have none."""
    known = labels.where(F.col(key).isNotNull() & F.col(value).isin(0, 1)).groupBy(F.col(key).alias("_id")).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"))
    return known.where("_lo = _hi").select("_id", F.col("_lo").cast("int").alias("_label"))


def fit_cutoffs(stats: DataFrame, labels: DataFrame, stratum: str = "lang", key: str = "doc_id", risk: float = RISK, confidence: float = 0.05) -> DataFrame:
    """Per stratum `_stratum` the chosen cutoffs, one column per rule; strata without a certified set are absent.

    `stats` must be cheap to read again (a written table). Base failures take no part: they go in any case.
    """
    ship_package(stats.sparkSession)
    labelled = stats.where(~base_failed()).select(F.col(key).alias("_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("_stratum"), *[share(r).alias(r) for r in RULES])
    labelled = materialize(labelled.join(agreed_labels(labels, key=key), "_id").withColumn("_fit", F.pmod(F.xxhash64("_id", F.lit(11)), F.lit(2)) == 0))
    good = labelled.where("_fit and _label = 1")
    points = [*[1 - q for q, _ in LADDER], 0.5]
    found = good.groupBy("_stratum").agg(*[F.percentile_approx(r, F.array(*map(F.lit, points)), F.lit(20_000)).alias(r) for r in RULES])
    out = F.element_at(F.array(*[F.lit(x) for _, x in LADDER]), F.col("_level") + 1)
    cut = {r: F.get(r, F.col("_level")) + out * (F.get(r, F.col("_level")) - F.get(r, F.lit(len(LADDER)))) for r in RULES}
    ladder = found.withColumn("_level", F.explode(F.sequence(F.lit(0), F.lit(len(LADDER) - 1))))
    ladder = materialize(ladder.select("_stratum", "_level", *[c.alias(f"cut_{r}") for r, c in cut.items()]))
    strata = max(1, ladder.select("_stratum").distinct().count())
    rejected = F.greatest(*[(F.col(r) > F.col(f"cut_{r}")).cast("int") for r in RULES])
    counted = (
        labelled.join(ladder, "_stratum")
        .groupBy("_stratum", "_level")
        .agg(
            F.count(F.when(~F.col("_fit") & (F.col("_label") == 1), 1)).alias("good"),
            F.sum(F.when(~F.col("_fit") & (F.col("_label") == 1), rejected).otherwise(0)).alias("lost"),
            F.sum(F.when(F.col("_label") == 0, rejected).otherwise(0)).alias("caught"),
        )
    )

    @F.pandas_udf("double")
    def p_value(lost: pd.Series, good: pd.Series) -> pd.Series:
        return pd.Series([at_most(int(a), int(b), risk) for a, b in zip(lost, good)])

    tested = counted.withColumn("_passed", p_value("lost", "good") <= confidence / strata)
    # the ladder has a fixed number of steps, and so has this window
    upto = Window.partitionBy("_stratum").orderBy("_level").rowsBetween(Window.unboundedPreceding, 0)
    certified = tested.withColumn("_all", F.min("_passed").over(upto)).where("_all")
    best = certified.groupBy("_stratum").agg(F.max("caught").alias("_most"))
    chosen = certified.join(best, "_stratum").where("caught >= 0.99 * _most").groupBy("_stratum").agg(F.min("_level").alias("_level"))
    return materialize(ladder.join(chosen, ["_stratum", "_level"]).drop("_level"))


def judge(stats: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """`stats` with `base_failed` and `kept`. `cutoffs` has a row per certified stratum; Spark broadcasts it if its measured size allows."""
    over = F.lit(False)
    for r in RULES:
        over = over | (share(r) > F.col(f"cut_{r}"))
    joined = stats.withColumn("_stratum", F.coalesce(F.col(stratum).cast("string"), F.lit(""))).join(cutoffs, "_stratum", "left")
    verdict = joined.withColumn("base_failed", base_failed())
    return verdict.withColumn("kept", ~F.col("base_failed") & ~F.coalesce(over, F.lit(False))).drop("_stratum", *[f"cut_{r}" for r in RULES])
