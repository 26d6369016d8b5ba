"""Models that are plain aggregates, checkable in SQL: Gaussian naive Bayes, single-column scoring."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.operators.scoring import roc_auc


def gaussian_nb(train: DataFrame, columns: list[str], label: str = config.LABEL) -> dict:
    """Class priors, means and population variances; 1e-9 of the largest variance is added to each."""
    overall = train.agg(*[F.var_pop(c).alias(c) for c in columns]).first()
    smoothing = 1e-9 * max(overall[c] or 0.0 for c in columns)
    rows = train.groupBy(label).agg(
        F.count("*").alias("n"), *[F.avg(c).alias(f"m_{c}") for c in columns], *[F.var_pop(c).alias(f"v_{c}") for c in columns]
    ).collect()
    total = sum(r["n"] for r in rows)
    return {
        r[label]: {"log_prior": math.log(r["n"] / total), "mean": [r[f"m_{c}"] for c in columns], "var": [r[f"v_{c}"] + smoothing for c in columns]}
        for r in rows
    }


def gaussian_nb_scores(model: dict, df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    """P(label = 1) by log densities, in built-in expressions."""
    def log_density(fitted: dict):
        out = F.lit(fitted["log_prior"])
        for c, m, v in zip(columns, fitted["mean"], fitted["var"]):
            out = out - F.lit(0.5 * math.log(2 * math.pi * v)) - (F.col(c) - m) * (F.col(c) - m) / F.lit(2 * v)
        return out

    if 0 not in model or 1 not in model:
        return df.select(*keep, F.lit(1.0 if 1 in model else 0.0).alias("score"))
    return df.select(*keep, (F.lit(1.0) / (F.lit(1.0) + F.exp(log_density(model[0]) - log_density(model[1])))).alias("score"))


def leakage_probe(full_history: DataFrame, pre_cutoff: DataFrame, labels: DataFrame) -> DataFrame:
    """AUC of Recency alone, on features that saw the label window and on features that did not."""
    def probe(name: str, features: DataFrame) -> DataFrame:
        scored = features.join(labels, config.ID).select(F.col(config.LABEL).alias("label"), F.col("Recency").cast("double").alias("score"))
        return roc_auc(scored).select(F.lit(name).alias("basis"), "AUC")

    return probe("full_history", full_history).unionByName(probe("pre_cutoff", pre_cutoff))
