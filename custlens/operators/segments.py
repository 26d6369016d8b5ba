"""Segmentation: k-means with restarts, size sweep, stability, hierarchical cut, and their comparison."""

from __future__ import annotations

from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.functions.quantiles import exact_quantiles
from custlens.operators import cluster_metrics, neighbours
from custlens.operators.dbscan import dbscan
from custlens.operators.hierarchy import ward
from custlens.runtime import materialize, ship_package

RESTARTS = 10
START_ROWS = 4096


def points_of(matrix: DataFrame, columns: list[str] = config.RFM) -> DataFrame:
    """(id, x) of a scaled matrix, as a stage table: every clustering reads it many times."""
    return materialize(cluster_metrics.as_points(matrix, columns, F.col(config.ID).alias("id")))


def _distinct(points: DataFrame) -> DataFrame:
    """Distinct points with their copies as weight, written: equal customers are clustered once."""
    return materialize(points.groupBy("x").agg(F.count("*").cast("double").alias("weight")))


def lloyd_sums(unique: DataFrame, centers: dict[int, np.ndarray]) -> DataFrame:
    """One Lloyd step of many models in one read of the points: per (model, cluster) the weight, the sum of points, and the weighted squared distances.

    `centers`: by model number, one row per cluster. Each task sends one row per model and cluster.
    """
    models = sorted(centers)

    def run(batches):
        sums = {m: (np.zeros(len(centers[m])), np.zeros_like(centers[m], float), np.zeros(len(centers[m]))) for m in models}
        for batch in batches:
            if not batch.num_rows:
                continue
            w = batch.column("weight").to_numpy(zero_copy_only=False)
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(w), -1)
            sides = [np.ascontiguousarray(v) for v in x.T]  # a coordinate at a time
            weighted = [w * v for v in sides]
            for m in models:
                own, least = np.zeros(len(w), np.int64), np.full(len(w), np.inf)
                for c, center in enumerate(centers[m]):
                    distance = np.zeros(len(w))
                    for v, at in zip(sides, center):
                        gap = v - at
                        gap *= gap
                        distance += gap
                    nearer = distance < least
                    own[nearer] = c
                    np.minimum(least, distance, out=least)
                n, total, cost = sums[m]
                n += np.bincount(own, w, len(n))
                cost += np.bincount(own, w * least, len(n))
                for j, v in enumerate(weighted):
                    total[:, j] += np.bincount(own, v, len(n))
        for m in models:
            n, total, cost = sums[m]
            yield pa.RecordBatch.from_pydict({"model": pa.array([m] * len(n), pa.int32()), "cluster": pa.array(np.arange(len(n)), pa.int32()), "n": n, "total": pa.array(list(total), pa.list_(pa.float64())), "cost": cost})

    parts = unique.select("x", "weight").mapInArrow(run, "model int, cluster int, n double, total array<double>, cost double")
    d = len(next(iter(centers.values()))[0])
    return parts.groupBy("model", "cluster").agg(F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("total")[j]) for j in range(d)]).alias("total"))


def _first_centers(sample: np.ndarray, weight: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ on a sample."""
    rng = np.random.default_rng(seed)
    out = [sample[rng.choice(len(sample), p=weight / weight.sum())]]
    while len(out) < min(k, len(sample)):
        nearest = np.min([((sample - c) ** 2).sum(axis=1) for c in out], axis=0) * weight
        out.append(sample[rng.choice(len(sample), p=nearest / nearest.sum())] if nearest.sum() > 0 else sample[len(out)])
    return np.array(out)


def fit_many(unique: DataFrame, wanted: Sequence[tuple[int, int]], steps: int = 100, tolerance: float = 1e-6, start_rows: int = START_ROWS) -> list[tuple[np.ndarray, float]]:
    """Centres and inertia of a k-means for each (k, seed) of `wanted`. All of them take each Lloyd step in one read of the points.

    Starts are k-means++ on at most `start_rows` points, those with the smallest hash; everything else sees all points. A model is
    done once no centre moves by more than `tolerance`. On the driver: the centres, and one row per model and cluster.
    """
    ship_package(unique.sparkSession)
    sample = unique.orderBy(F.xxhash64("x", F.lit(23)), "x").limit(start_rows).toPandas()
    x, weight = np.vstack(sample["x"]).astype(float), sample["weight"].to_numpy()
    centers = {i: _first_centers(x, weight, k, seed) for i, (k, seed) in enumerate(wanted)}
    cost, moving = {}, set(centers)
    for step in range(steps + 1):
        found: dict[int, list] = {i: [] for i in moving}
        for r in lloyd_sums(unique, {i: centers[i] for i in moving}).collect():
            found[r["model"]].append(r)
        for i, rows in found.items():
            cost[i] = sum(r["cost"] for r in rows)
            new = centers[i].copy()
            for r in rows:
                if r["n"] > 0:
                    new[r["cluster"]] = np.array(r["total"]) / r["n"]
            if ((new - centers[i]) ** 2).sum(axis=1).max() <= tolerance**2 or step == steps:
                moving.discard(i)  # its cost is that of the centres it keeps
            else:
                centers[i] = new
        if not moving:
            break
    return [(centers[i], cost[i]) for i in range(len(wanted))]


def _best_fits(unique: DataFrame, wanted: Sequence[tuple[int, int]], restarts: int) -> list[tuple[np.ndarray, float]]:
    """The best of `restarts` starts for each (k, seed), on distinct points with their weights."""
    every = [(k, s) for k, seed in wanted for s in range(seed, seed + restarts)]
    distinct = list(dict.fromkeys(every))
    fitted = dict(zip(distinct, fit_many(unique, distinct)))
    return [min((fitted[e] for e in every[i * restarts : (i + 1) * restarts]), key=lambda f: f[1]) for i in range(len(wanted))]


def _labelled(points: DataFrame, centers: np.ndarray, name: str = "id") -> DataFrame:
    """Points with their column `name`. Labels are ordered by the centre's first coordinate (Recency), largest first, so that they do not depend on the seed."""
    ordered = sorted(centers.tolist(), key=lambda c: [-v for v in c])
    gaps = [F.aggregate(F.zip_with("x", F.lit(c), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v) for c in ordered]
    return points.withColumn("_gaps", F.array(*gaps)).select(name, "x", (F.array_position("_gaps", F.array_min("_gaps")) - 1).cast("int").alias("cluster"))


def kmeans(points: DataFrame, k: int = 2, seed: int = config.SEED, restarts: int = RESTARTS) -> tuple[DataFrame, float]:
    """Labelled points (id, x, cluster) and inertia of the best of `restarts` starts."""
    ((centers, inertia),) = _best_fits(_distinct(points), [(k, seed)], restarts)
    return _labelled(points, centers), float(inertia)


def silhouette_of(labelled: DataFrame, measure: str = "squared") -> float | None:
    if measure not in ("squared", "euclidean"):
        raise ValueError("measure must be 'squared' or 'euclidean'")
    row = cluster_metrics.silhouette_squared(labelled) if measure == "squared" else neighbours.silhouette(labelled)
    return row.first()[0]


def _silhouette(points: DataFrame, unique: DataFrame, centers: np.ndarray, measure: str) -> float | None:
    """As `silhouette_of` the labelled points; the squared one is read off the distinct points and their weights."""
    if measure != "squared":
        return silhouette_of(_labelled(points, centers), measure)
    return cluster_metrics.silhouette_squared(_labelled(unique, centers, "weight"), "weight").first()[0]


def k_sweep(points: DataFrame, ks: Sequence[int] = range(2, 11), seed: int = config.SEED, restarts: int = RESTARTS, measure: str = "squared") -> DataFrame:
    """Inertia and silhouette per k. "squared" is linear in the rows; "euclidean" is the plain distance."""
    ks = list(ks)
    unique = _distinct(points)
    fitted = _best_fits(unique, [(k, seed) for k in ks], restarts)
    with ThreadPool(4) as pool:
        rows = pool.map(lambda f: (f[0], float(f[1][1]), _silhouette(points, unique, f[1][0], measure)), list(zip(ks, fitted)))
    return points.sparkSession.createDataFrame(rows, "k int, inertia double, silhouette double")


def best_k(sweep: DataFrame) -> int:
    return sweep.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).first()[0]


def stability(points: DataFrame, k: int = 2, seeds: Sequence[int] = range(10), restarts: int = RESTARTS, measure: str = "squared") -> DataFrame:
    """Silhouette, size variation and sorted sizes per seed; the row without a seed has the means over seeds and, in `silhouette_std`, the spread."""
    seeds = list(seeds)
    unique = _distinct(points)
    fitted = dict(zip(seeds, _best_fits(unique, [(k, s) for s in seeds], restarts)))

    def run(seed: int):
        labelled = _labelled(unique, fitted[seed][0], "weight")
        sizes = sorted((r["n"] for r in labelled.groupBy("cluster").agg(F.sum("weight").cast("bigint").alias("n")).collect()), reverse=True)
        sizes += [0] * (k - len(sizes))
        return seed, _silhouette(points, unique, fitted[seed][0], measure), float(np.std(sizes) / np.mean(sizes)), sizes

    with ThreadPool(4) as pool:
        rows = pool.map(run, seeds)
    sil, cv = [r[1] for r in rows], [r[2] for r in rows]
    out = [(*r, None) for r in rows] + [(None, float(np.mean(sil)), float(np.mean(cv)), None, float(np.std(sil)))]
    return points.sparkSession.createDataFrame(out, "seed int, silhouette double, size_cv double, cluster_sizes array<bigint>, silhouette_std double")


def eps_heuristic(points: DataFrame, k: int = 4, q: float = 0.92) -> float:
    """Quantile of the k-distance curve."""
    return exact_quantiles(materialize(neighbours.k_distance(points, k)), {"k_distance": [q]})["k_distance"][0]


def validation_table(points: DataFrame, k: int = 2, eps: float | None = None, min_samples: int = 5, seed: int = config.SEED, restarts: int = RESTARTS) -> tuple[DataFrame, dict[str, DataFrame]]:
    """One row of indices per algorithm, and the label tables (CustomerID, cluster) behind them."""
    eps = eps_heuristic(points) if eps is None else eps
    by_k, inertia = kmeans(points, k, seed, restarts)
    by_density = dbscan(points, eps, min_samples).join(points, "id").select("id", "x", "cluster")
    by_ward, _ = ward(points, k)
    tables = {"KMeans": materialize(by_k), "DBSCAN": materialize(by_density), "AGNES": materialize(by_ward)}
    notes = {"KMeans": f"inertia={inertia:.4f}", "DBSCAN": f"eps={eps:.4f}, min_samples={min_samples}", "AGNES": "linkage=ward"}

    def run(name: str) -> tuple:
        t = tables[name]
        n = t.filter("cluster <> -1").select("cluster").distinct().count()
        noise = t.filter("cluster = -1").count()
        indices = [None] * 4
        if n >= 2:
            copies = materialize(t.groupBy("x", "cluster").agg(F.count("*").cast("double").alias("weight")))
            indices = [neighbours.silhouette(t).first()[0], cluster_metrics.silhouette_squared(copies, "weight").first()[0],
                       cluster_metrics.davies_bouldin(t).first()[0], cluster_metrics.calinski_harabasz(t).first()[0]]
        return name, n, noise, *indices, notes[name]

    with ThreadPool(len(tables)) as pool:
        rows = pool.map(run, tables, 1)
    table = points.sparkSession.createDataFrame(
        rows, "Algorithm string, n_clusters int, n_noise bigint, silhouette double, silhouette_squared double, davies_bouldin double, calinski_harabasz double, notes string"
    )
    return table, {n: t.select(F.col("id").alias(config.ID), "cluster") for n, t in tables.items()}
