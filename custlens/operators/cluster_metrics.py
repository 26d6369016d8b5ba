"""Validation indices and profiles of a labelled clustering.

Input rows: an id, an integer `cluster` and an array<double> `x`. Cluster -1 is noise and is left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.runtime import materialize, ship_package

# Clusters up to which an expression goes over all of them for each row, and up to which they are one array in each task.
FEW_CLUSTERS = 64
ARRAY_CLUSTERS = 1 << 16
TILE_CELLS = 1 << 18


def as_points(df: DataFrame, columns: list[str], *keep: str) -> DataFrame:
    return df.select(*keep, F.array(*[F.col(c).cast("double") for c in columns]).alias("x"))


def squared_distance(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, t: s + t)


def _clustered(df: DataFrame) -> DataFrame:
    return df.filter("cluster <> -1")


def dimension(df: DataFrame) -> int:
    return df.select(F.size("x")).first()[0]


def _size(weight: str | None) -> Column:
    return F.sum(weight) if weight else F.count("*")


def _mean(value: Column, weight: str | None) -> Column:
    return F.sum(value * F.col(weight)) / F.sum(weight) if weight else F.avg(value)


def centroids(df: DataFrame, d: int | None = None, weight: str | None = None) -> DataFrame:
    """One row per cluster: size, centre and mean square norm; plain sums with map-side combine. `weight`: copies of each row."""
    d = d or dimension(df)
    means = [_mean(F.col("x")[i], weight) for i in range(d)]
    norm = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    return df.groupBy("cluster").agg(_size(weight).alias("n"), F.array(*means).alias("center"), _mean(norm, weight).alias("square"))


def _scattered(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Per cluster: size, centre, mean distance and mean squared distance to the centre."""
    to_center = squared_distance("x", "center")
    return df.join(materialize(centroids(df, weight=weight)), "cluster").groupBy("cluster").agg(
        _size(weight).alias("n"), F.first("center").alias("center"),
        _mean(F.sqrt(to_center), weight).alias("scatter"), _mean(to_center, weight).alias("spread"),
    )


def _all_clusters(c: DataFrame) -> Column:
    """The one-row-per-cluster table as an array, read by each cluster as a scalar subquery."""
    return c.agg(F.collect_list(F.struct("cluster", "n", "center", "scatter", "spread"))).scalar()


def _many(c: DataFrame) -> tuple[np.ndarray, ...] | None:
    """Names, sizes, centres, scatters and spreads where clusters are too many for an expression over all of them (as of a DBSCAN) and few enough for one array."""
    n = c.count()
    if not FEW_CLUSTERS < n <= ARRAY_CLUSTERS:
        return None
    ship_package(c.sparkSession)
    every = c.select("cluster", "n", "center", "scatter", "spread").orderBy("cluster").toPandas()
    return (every["cluster"].to_numpy(), every["n"].to_numpy(float), np.vstack(every["center"]), every["scatter"].to_numpy(), every["spread"].to_numpy())


def _tiles(x: np.ndarray, center: np.ndarray):
    """Squared distances of some rows at a time to all centres."""
    step = max(1, TILE_CELLS // len(center))
    for i in range(0, len(x), step):
        tile = np.zeros((len(x[i : i + step]), len(center)))
        for j in range(x.shape[1]):
            gap = x[i : i + step, j, None] - center[:, j]
            tile += gap * gap
        yield slice(i, i + step), tile


def davies_bouldin(df: DataFrame) -> DataFrame:
    """Mean over clusters of the worst (scatter + scatter) / centre distance."""
    c = materialize(_scattered(_clustered(df)))
    if every := _many(c):
        _, _, center, scatter, _ = every

        def worst(batches):
            for pdf in batches:
                for some, tile in _tiles(np.vstack(pdf["center"]), center) if len(pdf) else ():
                    distance = np.sqrt(tile)
                    ratio = np.divide(pdf["scatter"].to_numpy()[some, None] + scatter, distance, out=np.zeros_like(distance), where=distance > 0)  # 0 to itself
                    yield pd.DataFrame({"worst": ratio.max(axis=1)})

        dealt = c.select("center", "scatter").repartition(c.sparkSession.sparkContext.defaultParallelism)
        return dealt.mapInPandas(worst, "worst double").agg(F.avg("worst").alias("davies_bouldin"))
    others = F.filter("everyone", lambda o: o["cluster"] != F.col("cluster"))
    ratios = F.transform(
        others,
        lambda o: F.coalesce(
            F.try_divide(F.col("scatter") + o["scatter"], F.sqrt(squared_distance(F.col("center"), o["center"]))), F.lit(0.0)
        ),
    )
    return c.withColumn("everyone", _all_clusters(c)).select(F.array_max(ratios).alias("worst")).agg(F.avg("worst").alias("davies_bouldin"))


def calinski_harabasz(df: DataFrame) -> DataFrame:
    """Between over within sum of squares, each over its degrees of freedom; read from the per-cluster table."""
    parts = F.col("parts")
    one = _scattered(_clustered(df)).agg(
        F.sum("n").alias("N"), F.count("*").alias("K"), F.sum(F.col("n") * F.col("spread")).alias("within"),
        F.collect_list(F.struct("n", "center")).alias("parts"),
    )
    mean = F.transform(
        F.sequence(F.lit(0), F.size(parts[0]["center"]) - 1),
        lambda i: F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["n"] * F.get(p["center"], i)) / F.col("N"),
    )
    between = F.aggregate(parts, F.lit(0.0), lambda s, p: s + p["n"] * squared_distance(p["center"], F.col("mean")))
    # written, or the mean would be computed again for each cluster
    out = materialize(one.filter("K > 1").withColumn("mean", mean)).select("N", "K", between.alias("between"), "within")
    index = (F.col("between") / (F.col("K") - 1)) / (F.col("within") / (F.col("N") - F.col("K")))
    return out.agg(F.max(F.when(F.col("within") > 0, index).otherwise(1.0)).alias("calinski_harabasz"))


def silhouette_squared(df: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean silhouette under squared Euclidean distance, exact and linear in the rows.

    The mean squared distance from x to a cluster is |x - centre|^2 + spread, so each row needs only
    the per-cluster table. A cluster of one scores 0. `weight`: copies that each row stands for.
    """
    df = _clustered(df)
    c = materialize(_scattered(df, weight))
    if every := _many(c):
        names, n, center, _, spread = every

        def scores(batches):
            for pdf in batches:
                own, w = np.searchsorted(names, pdf["cluster"].to_numpy()), pdf["w"].to_numpy()
                for some, tile in _tiles(np.vstack(pdf["x"]).astype(float), center) if len(pdf) else ():
                    tile += spread
                    at, mine = np.arange(len(tile)), own[some]
                    size = n[mine]
                    a = tile[at, mine] * size / np.maximum(size - 1, 1)
                    tile[at, mine] = np.inf
                    b = tile.min(axis=1)
                    top = np.maximum(a, b)
                    score = np.where((size > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)
                    yield pd.DataFrame({"score": score, "w": w[some]})

        dealt = df.select("cluster", "x", (F.col(weight) if weight else F.lit(1)).cast("double").alias("w")).repartition(4 * df.sparkSession.sparkContext.defaultParallelism)
        return dealt.mapInPandas(scores, "score double, w double").agg(_mean(F.col("score"), "w").alias("silhouette_squared"))
    to = F.transform(
        "everyone",
        lambda o: F.struct(
            o["cluster"].alias("cluster"), o["n"].alias("n"),
            (squared_distance(F.col("x"), o["center"]) + o["spread"]).alias("mean"),
        ),
    )
    kept = [weight] if weight else []
    rows = df.withColumn("everyone", _all_clusters(c)).select("cluster", to.alias("to"), *kept)
    own = F.filter("to", lambda t: t["cluster"] == F.col("cluster"))[0]
    a = own["mean"] * own["n"] / (own["n"] - 1)
    b = F.array_min(F.transform(F.filter("to", lambda t: t["cluster"] != F.col("cluster")), lambda t: t["mean"]))
    rows = rows.select(own["n"].alias("n"), F.when(own["n"] > 1, a).alias("a"), b.alias("b"), *kept)
    score = F.when(F.col("n") > 1, F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))).otherwise(0.0)
    return rows.filter("b is not null").agg(_mean(score, weight).alias("silhouette_squared"))


def profile_clusters(features: DataFrame, segments: DataFrame) -> DataFrame:
    """Size, mean R/F/M (2 digits, half-even) and share in percent (1 digit) per cluster."""
    joined = features.join(segments.select(config.ID, "cluster"), config.ID)
    p = joined.groupBy("cluster").agg(F.count("*").alias("n_customers"), *[F.avg(c).alias(f"{c}_mean") for c in config.RFM])
    total = p.agg(F.sum("n_customers")).scalar()
    return p.select(
        "cluster", "n_customers", *[F.bround(f"{c}_mean", 2).alias(f"{c}_mean") for c in config.RFM],
        F.bround(F.col("n_customers") / total * 100, 1).alias("share_pct"),
    )
