"""Evaluation of scored rows: columns `label` (0/1), `score` (probability or margin), `pred` (0/1)."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens import config
from custlens.functions.quantiles import exact_quantiles
from custlens.runtime import materialize

ROWS_PER_BUCKET = 500_000


def _per_score(scored: DataFrame) -> DataFrame:
    """Positives and negatives per distinct score: repeated scores cost one row."""
    label = F.col("label").cast("int")
    return scored.groupBy(F.col("score").cast("double").alias("score")).agg(
        F.sum(label).alias("pos"), F.sum(1 - label).alias("neg")
    )


def running_counts(scored: DataFrame, descending: bool) -> DataFrame:
    """(score, pos, neg, pos_upto, neg_upto) in score order.

    Distinct scores are written once and cut into score ranges of at most about `ROWS_PER_BUCKET`; each range
    has its own window and adds the totals of the ranges before it, one row per range.
    """
    per_score = materialize(_per_score(scored))
    buckets = 1 + math.ceil(per_score.count() / ROWS_PER_BUCKET)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = per_score.agg(F.percentile_approx("score", probs, 20 * buckets)).first()[0] or [0.0]
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    per_score = Bucketizer(splits=splits, inputCol="score", outputCol="bucket").transform(per_score)
    order = F.desc if descending else F.asc
    inside = Window.partitionBy("bucket").orderBy(order("score")).rowsBetween(Window.unboundedPreceding, 0)
    out = per_score.withColumns({f"{c}_upto": F.sum(c).over(inside) for c in ("pos", "neg")})
    earlier = Window.orderBy(order("bucket")).rowsBetween(Window.unboundedPreceding, -1)
    totals = per_score.groupBy("bucket").agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
    totals = totals.select("bucket", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("p", "q")])
    out = out.join(totals, "bucket")
    out = out.withColumns({"pos_upto": F.col("pos_upto") + F.col("p_before"), "neg_upto": F.col("neg_upto") + F.col("q_before")})
    return out.select("score", "pos", "neg", "pos_upto", "neg_upto")


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve; a tie between a positive and a negative counts half."""
    t = running_counts(scored, descending=False)
    below = F.col("neg_upto") - F.col("neg")
    pairs = F.sum(F.col("pos").cast("double") * (below + F.col("neg") / 2))
    return t.agg(F.try_divide(pairs, F.sum("pos").cast("double") * F.sum("neg")).alias("AUC"))


def roc_points(scored: DataFrame) -> DataFrame:
    """One point per distinct threshold, rates of rows at or above it. The curve starts at (0, 0) with no threshold."""
    t = running_counts(scored, descending=True)
    totals = t.agg(F.sum("pos").alias("p"), F.sum("neg").alias("q")).first()
    points = t.select(
        F.col("score").alias("threshold"),
        (F.col("neg_upto") / F.lit(totals["q"])).alias("fpr"),
        (F.col("pos_upto") / F.lit(totals["p"])).alias("tpr"),
    )
    start = scored.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return start.unionByName(points)


def _cells() -> dict:
    y, p = F.col("label") == 1, F.col("pred") == 1
    return {n: F.count(F.when(c, 1)).alias(n) for n, c in {"tp": y & p, "fp": ~y & p, "fn": y & ~p, "tn": ~y & ~p}.items()}


def classification_metrics(scored: DataFrame) -> DataFrame:
    """F1, precision (0 without predicted positives), recall and accuracy in one aggregate."""
    c = scored.agg(*_cells().values())
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))

    def ratio(a, b):
        return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))

    return c.select(
        ratio(2 * tp, 2 * tp + fp + fn).alias("F1"), ratio(tp, tp + fp).alias("Precision"),
        ratio(tp, tp + fn).alias("Recall"), ratio(tp + tn, tp + fp + fn + tn).alias("Accuracy"),
    )


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """All four (label, pred) cells, empty ones included."""
    cells = scored.agg(*_cells().values())
    rows = [F.struct(F.lit(y).alias("label"), F.lit(p).alias("pred"), F.col(n).alias("n")) for y, p, n in
            [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]]
    return cells.select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def metric_row(scored: DataFrame) -> dict[str, float]:
    """The five hold-out metrics as plain numbers."""
    row = classification_metrics(scored).first().asDict()
    return {"AUC": roc_auc(scored).first()["AUC"], **row}


def brier(scored: DataFrame) -> DataFrame:
    return scored.agg(F.avg((F.col("score") - F.col("label")) * (F.col("score") - F.col("label"))).alias("brier_score"))


def reliability_curve(scored: DataFrame, bins: int = config.CALIBRATION_BINS) -> DataFrame:
    """Mean score and observed share per quantile bin; a score on an edge belongs to the lower bin.

    Empty bins (from repeated quantiles) vanish and the rest are renumbered from 1.
    """
    edges = exact_quantiles(scored, {"score": [i / bins for i in range(1, bins)]})["score"]
    place = sum(((F.col("score") > F.lit(e)).cast("int") for e in edges if e is not None), F.lit(0))
    curve = scored.groupBy(place.alias("place")).agg(
        F.count("*").alias("n"), F.avg("score").alias("mean_predicted_prob"), F.avg("label").alias("fraction_positive")
    )
    order = Window.orderBy("place")  # at most `bins` rows
    return curve.select(F.row_number().over(order).alias("bin"), "n", "mean_predicted_prob", "fraction_positive")


def calibration_report(scored: DataFrame, model: str, bins: int = config.CALIBRATION_BINS) -> DataFrame:
    """Reliability curve with Brier score, expected calibration error and largest gap on each row."""
    curve = reliability_curve(scored, bins)
    everything = Window.partitionBy()
    gap = F.abs(F.col("mean_predicted_prob") - F.col("fraction_positive"))
    return curve.select(
        F.lit(model).alias("model"), "bin", "mean_predicted_prob", "fraction_positive",
        brier(scored).scalar().alias("brier_score"),
        (F.sum(gap * F.col("n")).over(everything) / F.sum("n").over(everything)).alias("ece"),
        F.max(gap).over(everything).alias("largest_gap"),
    )


def recalibrate(scored: DataFrame, fitted_on: DataFrame, bins: int = config.CALIBRATION_BINS) -> DataFrame:
    """Replace each score by the observed share of its quantile bin in `fitted_on`, made non-decreasing."""
    edges = exact_quantiles(fitted_on, {"score": [i / bins for i in range(1, bins)]})["score"]

    def place():
        return sum(((F.col("score") > F.lit(e)).cast("int") for e in edges if e is not None), F.lit(0))

    rows = fitted_on.groupBy(place().alias("place")).agg(F.count("*").alias("n"), F.sum("label").alias("pos")).orderBy("place").collect()
    pools: list[list] = []
    for r in rows:  # pool neighbours that decrease; at most `bins` rows
        pools.append([r["pos"], r["n"], [r["place"]]])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] > pools[-1][0] / pools[-1][1]:
            pos, n, places = pools.pop()
            pools[-1] = [pools[-1][0] + pos, pools[-1][1] + n, pools[-1][2] + places]
    level = F.lit(None).cast("double")
    for pos, n, places in reversed(pools):
        level = F.when(place() <= places[-1], F.lit(pos / n)).otherwise(level)
    last = pools[-1][0] / pools[-1][1] if pools else None
    return scored.withColumn("score", F.coalesce(level, F.lit(last)))
