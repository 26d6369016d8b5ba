"""Anomaly scores: mean squared residual of a low-rank reconstruction of the standardised features."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.operators.cluster_metrics import squared_distance
from custlens.operators.encoding import standardize


def standardized_points(features: DataFrame, columns: list[str] = config.NUMERIC) -> DataFrame:
    """(CustomerID, x) with the numeric features scaled, not logged."""
    scaled = standardize(features.select(config.ID, *[F.col(c).cast("double").alias(c) for c in columns]), columns)
    return scaled.select(config.ID, F.array(*columns).alias("x"))


def _principal(points: DataFrame, k: int):
    return PCA(k=k, inputCol="v", outputCol="p").fit(points.select(array_to_vector("x").alias("v")))


def reconstruction_errors(features: DataFrame, k: int = 4, columns: list[str] = config.NUMERIC) -> DataFrame:
    """(CustomerID, reconstruction_error) with a bottleneck of k; k = 0 is the distance from the mean.

    The first k principal axes are the best linear bottleneck. Axes are a k x d matrix of literals, so
    scoring is one projection without a join or a Python worker.
    """
    points = standardized_points(features, columns)
    x = F.col("x")
    error = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    if k > 0:
        axes = np.asarray(_principal(points, k).pc.toArray())  # d x k
        codes = [F.aggregate(F.zip_with(x, F.lit([float(v) for v in axes[:, j]]), lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t) for j in range(k)]
        coded = points.withColumn("code", F.array(*codes))
        back = F.array(*[
            F.aggregate(F.zip_with("code", F.lit([float(v) for v in axes[i]]), lambda a, b: a * b), F.lit(0.0), lambda s, t: s + t)
            for i in range(len(columns))
        ])
        points, error = coded.withColumn("back", back), squared_distance("x", "back")
    return points.select(config.ID, (error / F.lit(len(columns))).alias("reconstruction_error"))


def loss_curve(features: DataFrame, columns: list[str] = config.NUMERIC) -> DataFrame:
    """Mean reconstruction error for each bottleneck size: the share of variance left, from one fit."""
    points = standardized_points(features, columns)
    ratios = [float(v) for v in _principal(points, len(columns)).explainedVariance]
    total = points.agg(F.avg(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))).first()[0] / len(columns)
    rows = [(k, total * max(0.0, 1.0 - sum(ratios[:k]))) for k in range(len(columns) + 1)]
    return features.sparkSession.createDataFrame(rows, "bottleneck int, loss double")


def pca_2d(matrix: DataFrame, columns: list[str] = config.RFM) -> DataFrame:
    """First two principal coordinates of an already centred matrix; each axis has its largest loading positive."""
    points = matrix.select(config.ID, F.array(*columns).alias("x"))
    model = _principal(points, 2)
    axes = model.pc.toArray()
    signs = [1.0 if axes[np.argmax(np.abs(axes[:, j])), j] >= 0 else -1.0 for j in range(2)]
    p = vector_to_array("p")
    placed = model.transform(points.withColumn("v", array_to_vector("x"))).select(config.ID, p.alias("p"))
    return placed.select(config.ID, *[(F.col("p")[j] * F.lit(signs[j])).alias(f"pc{j + 1}") for j in range(2)])
