"""Queries on segmentation, fitted models, attribution. Values come from fits, so most have no SQL; tests check their properties."""

from __future__ import annotations

import uuid
from datetime import datetime

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.operators import anomaly, attribution, cluster_metrics, dbscan, decisions, encoding, models, neighbours, rules, segments
from custlens.operators.scoring import calibration_report
from custlens.operators.smote import new_rows
from custlens.plans.lines import LABEL_SQL, MATRIX_SQL, feature_lines, full_features, labels, pre_features, split_frame, stored_frame
from custlens.plans.mining import described_rules, mined_rules
from custlens.plans.registry import register
from custlens.runtime import materialize, shared_folder
from custlens.sources import model_store, runlog
from custlens.sources.starschema import table


def rfm_points(spark, d, basis: str = "full_history", lines: DataFrame | None = None) -> DataFrame:
    """`pre_cutoff` keeps the label window out of the segments; `full_history` lets Recency see it."""
    features = full_features(spark, d, lines) if basis == "full_history" else pre_features(spark, d, lines)
    return segments.points_of(encoding.clustering_matrix(materialize(features)))


def labelled_vectors(spark, d) -> DataFrame:
    """Given vectors with given labels as clusters."""
    e = table(spark, d, "embeddings")
    return e.select(F.col("vec_id").alias("id"), F.col("label").cast("int").alias("cluster"), F.col("embedding").cast("array<double>").alias("x"))


VECTOR_SQL = "v AS (SELECT vec_id AS id, CAST(label AS INTEGER) AS cluster, CAST(embedding AS DOUBLE[]) AS x FROM embeddings)"
DISTANCE = "list_distance(a.x, b.x)"
SILHOUETTE_SQL = """
WITH {v}, pr AS (SELECT a.id, a.cluster AS own, b.cluster AS other, sum({dist}) AS s, count(*) AS n FROM v a, v b GROUP BY ALL),
ab AS (SELECT id, max(CASE WHEN own = other THEN n END) AS size, max(CASE WHEN own = other AND n > 1 THEN s / (n - 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM pr GROUP BY 1)
SELECT avg(CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0.0 END) AS {name} FROM ab"""


@register("silhouette_exact", SILHOUETTE_SQL.format(v=VECTOR_SQL, dist=DISTANCE, name="silhouette"), {"silhouette": 9})
def _(spark, d):
    return neighbours.silhouette(labelled_vectors(spark, d), rows=256)


@register("silhouette_squared", SILHOUETTE_SQL.format(v=VECTOR_SQL, dist=f"{DISTANCE} * {DISTANCE}", name="silhouette_squared"), {"silhouette_squared": 9})
def _(spark, d):
    return cluster_metrics.silhouette_squared(labelled_vectors(spark, d))


CENTER_SQL = VECTOR_SQL + """,
flat AS (SELECT id, cluster, unnest(x) AS val, generate_subscripts(x, 1) AS j FROM v),
cen AS (SELECT cluster, list(m ORDER BY j) AS center FROM (SELECT cluster, j, avg(val) AS m FROM flat GROUP BY ALL) GROUP BY 1),
grand AS (SELECT list(m ORDER BY j) AS center FROM (SELECT j, avg(val) AS m FROM flat GROUP BY ALL)),
sc AS (SELECT cluster, any_value(center) AS center, avg(list_distance(x, center)) AS scatter, sum(list_distance(x, center) * list_distance(x, center)) AS within, count(*) AS n
       FROM v JOIN cen USING (cluster) GROUP BY 1)"""


@register("davies_bouldin", f"""
WITH {CENTER_SQL} SELECT avg(w) AS davies_bouldin FROM (
  SELECT a.cluster, max((a.scatter + b.scatter) / list_distance(a.center, b.center)) AS w FROM sc a JOIN sc b ON a.cluster <> b.cluster GROUP BY 1)""", {"davies_bouldin": 9})
def _(spark, d):
    return cluster_metrics.davies_bouldin(labelled_vectors(spark, d))


@register("calinski_harabasz", f"""
WITH {CENTER_SQL} SELECT (sum(sc.n * list_distance(sc.center, grand.center) * list_distance(sc.center, grand.center)) / (count(*) - 1)) / (sum(within) / (sum(sc.n) - count(*))) AS calinski_harabasz
FROM sc, grand""", {"calinski_harabasz": 6})
def _(spark, d):
    return cluster_metrics.calinski_harabasz(labelled_vectors(spark, d))


POINT_SQL = MATRIX_SQL + """,
pt AS (SELECT "CustomerID" AS id, "Recency" AS a, "Frequency" AS b, "Monetary" AS c FROM matrix),
pd AS (SELECT p.id, q.id AS other, sqrt((p.a - q.a) * (p.a - q.a) + (p.b - q.b) * (p.b - q.b) + (p.c - q.c) * (p.c - q.c)) AS dist FROM pt p, pt q)"""


@register("k_distance", f"""
WITH {POINT_SQL} SELECT id, dist AS k_distance FROM (SELECT id, dist, row_number() OVER (PARTITION BY id ORDER BY dist) AS r FROM pd) WHERE r = 4""", {"k_distance": 8})
def _(spark, d):
    return neighbours.k_distance(rfm_points(spark, d), 4, rows=256)


@register("eps_heuristic", f"""
WITH {POINT_SQL} SELECT quantile_cont(dist, 0.92) AS eps FROM (SELECT id, dist, row_number() OVER (PARTITION BY id ORDER BY dist) AS r FROM pd) WHERE r = 4""", {"eps": 8})
def _(spark, d):
    eps = segments.eps_heuristic(rfm_points(spark, d), 4)
    return spark.createDataFrame([(eps,)], "eps double")


@register("dbscan_flags", f"""
WITH {POINT_SQL}, core AS (SELECT id FROM pd WHERE dist <= 0.35 GROUP BY 1 HAVING count(*) >= 5)
SELECT id, CAST(id IN (SELECT id FROM core) AS INTEGER) AS core,
  CAST(NOT EXISTS (SELECT 1 FROM pd WHERE pd.id = pt.id AND dist <= 0.35 AND other IN (SELECT id FROM core)) AS INTEGER) AS noise FROM pt""")
def _(spark, d):
    return dbscan.core_flags(rfm_points(spark, d), 0.35, 5)


@register("dbscan_segments")
def _(spark, d):
    points = rfm_points(spark, d)
    labels = dbscan.dbscan(points, segments.eps_heuristic(points), 5)
    return labels.select(F.col("id").alias("CustomerID"), "cluster")


@register("kmeans_segments")
def _(spark, d):
    labelled, _ = segments.kmeans(rfm_points(spark, d))
    return labelled.select(F.col("id").alias("CustomerID"), "cluster")


LLOYD_CENTERS = ((-1.0, -0.5, -0.5), (0.0, 0.5, 0.5), (1.5, 0.0, 0.0))


@register("lloyd_step", f"""
WITH {POINT_SQL}, c(m, k, a, b, c) AS (VALUES {", ".join(f"({m}, {k}, {', '.join(f'CAST({v * (m + 1)} AS DOUBLE)' for v in c)})" for m in range(2) for k, c in enumerate(LLOYD_CENTERS))}),
near AS (SELECT pt.*, m, k, (pt.a - c.a) * (pt.a - c.a) + (pt.b - c.b) * (pt.b - c.b) + (pt.c - c.c) * (pt.c - c.c) AS gap FROM pt, c QUALIFY row_number() OVER (PARTITION BY id, m ORDER BY gap, k) = 1)
SELECT CAST(m AS INTEGER) AS model, CAST(k AS INTEGER) AS cluster, CAST(count(*) AS DOUBLE) AS n, sum(gap) AS cost, sum(a) / count(*) AS x, sum(b) / count(*) AS y, sum(c) / count(*) AS z
FROM near GROUP BY ALL""", {"cost": 6, "x": 8, "y": 8, "z": 8})
def _(spark, d):
    """One Lloyd step of two models on all customers, from given centres."""
    unique = segments._distinct(rfm_points(spark, d))
    step = segments.lloyd_sums(unique, {m: (m + 1) * np.array(LLOYD_CENTERS) for m in range(2)}).where("n > 0")
    return step.select("model", "cluster", "n", "cost", *[(F.col("total")[j] / F.col("n")).alias(c) for j, c in enumerate("xyz")])


@register("k_sweep")
def _(spark, d):
    return segments.k_sweep(rfm_points(spark, d))


@register("cluster_stability")
def _(spark, d):
    return segments.stability(rfm_points(spark, d))


@register("ward_segments")
def _(spark, d):
    labelled, _ = segments.ward(rfm_points(spark, d))
    return labelled.select(F.col("id").alias("CustomerID"), "cluster")


@register("ward_merges")
def _(spark, d):
    _, merges = segments.ward(rfm_points(spark, d))
    return merges.orderBy(F.desc("step")).limit(30)


@register("clustering_validation")
def _(spark, d):
    return segments.validation_table(rfm_points(spark, d))[0]


@register("pca_2d")
def _(spark, d):
    return anomaly.pca_2d(materialize(encoding.clustering_matrix(full_features(spark, d))))


def _md5(seed: int, *parts: str) -> str:
    joined = " || '|' || ".join([f"'{seed}'", *parts])
    return f"CAST('0x' || substr(md5({joined}), 1, 15) AS BIGINT)"


@register("smote_sample", f"""
WITH {POINT_SQL},{LABEL_SQL}, lab AS (SELECT pt.*, churn FROM pt JOIN labelled ON "CustomerID" = id),
size AS (SELECT churn, count(*) AS n FROM lab GROUP BY 1), minority AS (SELECT churn, n FROM size ORDER BY n, churn LIMIT 1),
need AS (SELECT m.n, (SELECT max(n) FROM size) - m.n AS missing, m.churn FROM minority m),
few AS (SELECT lab.*, n, missing, row_number() OVER (ORDER BY {_md5(config.SEED, 'CAST(id AS VARCHAR)')}, id) AS turn FROM lab JOIN need USING (churn)),
copy AS (SELECT *, unnest(range(1, 1 + CAST(missing // n + CASE WHEN turn <= missing % n THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM few),
draw AS (SELECT *, {_md5(config.SEED, 'CAST(id AS VARCHAR)', 'CAST(copy AS VARCHAR)', "'neighbour'")} % least(5, n - 1) + 2 AS place,
  {_md5(config.SEED, 'CAST(id AS VARCHAR)', 'CAST(copy AS VARCHAR)', "'share'")} / CAST(1152921504606846976 AS DOUBLE) AS u FROM copy),
near AS (SELECT f.id, g.id AS neighbour, g.a AS ga, g.b AS gb, g.c AS gc,
  row_number() OVER (PARTITION BY f.id ORDER BY (f.a - g.a) * (f.a - g.a) + (f.b - g.b) * (f.b - g.b) + (f.c - g.c) * (f.c - g.c), g.id) AS place FROM few f, few g)
SELECT d.id AS "CustomerID", CAST(copy AS BIGINT) AS copy, neighbour, u, a + (ga - a) * u AS x, b + (gb - b) * u AS y, c + (gc - c) * u AS z
FROM draw d JOIN near ON near.id = d.id AND near.place = d.place""", {"u": 12, "x": 8, "y": 8, "z": 8})
def _(spark, d):
    """The rows that oversampling adds to the smaller class of churned and kept customers, on their scaled features."""
    known = labels(spark, d).select(F.col("CustomerID").alias("id"), F.col("churn").alias("label"))
    born = new_rows(materialize(rfm_points(spark, d).join(known, "id")))
    if born is None:
        return spark.createDataFrame([], "CustomerID bigint, copy bigint, neighbour bigint, u double, x double, y double, z double")
    return born.select(F.col("id").alias("CustomerID"), F.col("copy").cast("bigint"), "neighbour", "u", *[F.col("x")[j].alias(c) for j, c in enumerate("xyz")])


_searches: dict[tuple[str, str], tuple] = {}


def searched(spark, d) -> tuple[DataFrame, dict[str, models.FittedModel], DataFrame]:
    """The full search (all grids, five folds) of one folder, run once per application and shared by all queries that need it."""
    key = (spark.sparkContext.applicationId, d)
    if key not in _searches:
        _searches[key] = models.train_classical(stored_frame(spark, d), parallelism=6)
    return _searches[key]


def selected(spark, d) -> tuple[models.FittedModel, DataFrame]:
    """The family with the best cross-validated AUC (ties by name), and the split frame it was found on."""
    board, fitted, split = searched(spark, d)
    best = board.orderBy(F.desc("CV_AUC_mean"), "Model").first()["Model"]
    return fitted[best], split


@register("model_leaderboard")
def _(spark, d):
    return searched(spark, d)[0]


@register("baselines")
def _(spark, d):
    return models.baselines(split_frame(spark, d))


@register("ablation")
def _(spark, d):
    return models.ablation(split_frame(spark, d))


@register("mlp_comparison")
def _(spark, d):
    """The network beside the best classical model, both scored on the test part."""
    network, _ = models.train_network(stored_frame(spark, d))
    best, split = selected(spark, d)
    test = split.filter("not is_train")
    return models.comparison({best.name: materialize(best.scored(test)), "MLP": materialize(network.scored(test))})


def one_model(spark, d, name: str, params: dict):
    split = split_frame(spark, d)
    data = models.prepare(split.filter("is_train"))
    model = models.fit(name, params, data)
    data.release()
    return model, split


@register("svm_rff_scores")
def _(spark, d):
    model, split = one_model(spark, d, "SVM", {"C": 1.0})
    return model.scored(split.filter("not is_train")).select("CustomerID", "label", "score")


@register("churn_model_scores")
def _(spark, d):
    """Scores of a pipeline that was saved and loaded again."""
    model, _ = one_model(spark, d, "LogisticRegression", {"C": 0.1})
    folder = f"{shared_folder(spark)}/custlens/{uuid.uuid4().hex}"
    model_store.save_model(model.pipeline, folder, model.name)
    return decisions.score_customers(pre_features(spark, d), model_store.load_model(folder, model.name), model.name)


@register("model_metadata")
def _(spark, d):
    model, split = one_model(spark, d, "LogisticRegression", {"C": 0.1})
    facts = split.agg(F.count("*").alias("n_customers"), F.avg(config.LABEL).alias("churn_rate"), F.sum(F.col("is_train").cast("int")).alias("n_train"))
    fields = {**model.metadata(), **facts.first().asDict()}
    return runlog.metric_rows(spark, fields, "run-1", datetime(2001, 1, 1)).select("metric", "value")


@register("churn_by_fitted_segment")
def _(spark, d):
    """Churn per k-means segment on both bases: the full-history gap is inflated by what Recency has seen."""
    lines = feature_lines(spark, d)
    known, rates = materialize(labels(spark, d, lines)), []
    for basis in ("full_history", "pre_cutoff"):
        found, _ = segments.kmeans(rfm_points(spark, d, basis, lines))
        rate = decisions.churn_by_segment(known, found.select(F.col("id").alias(config.ID), "cluster"))
        rates.append(rate.select(F.lit(basis).alias("basis"), "cluster", "n_customers", "churn_rate"))
    return rates[0].unionByName(rates[1])


@register("decision_table_fitted")
def _(spark, d):
    """The decision table from fitted parts: scores of the model that cross-validation selects, pre-cutoff k-means segments, reconstruction errors, mined rules."""
    model, split = selected(spark, d)
    lines = feature_lines(spark, d)
    features, known = materialize(pre_features(spark, d, lines)), materialize(labels(spark, d, lines))
    found, _ = segments.kmeans(segments.points_of(encoding.clustering_matrix(features)))
    found = materialize(found.select(F.col("id").alias(config.ID), "cluster"))
    train = split.filter("is_train").select(config.ID)
    rates = decisions.churn_by_segment(known.join(train, config.ID, "left_semi"), found)
    errors = materialize(anomaly.reconstruction_errors(features, 4))
    named = described_rules(spark, d, lines)
    return decisions.decision_table(
        features, decisions.score_customers(features, model, model.name), known, found, rates, decisions.flag_anomalies(errors),
        named, "2001-01-01T00:00:00+00:00", train,
    )


@register("metric_snapshot")
def _(spark, d):
    """Headline numbers of one run as one row."""
    frame = stored_frame(spark, d)
    board, _, _ = searched(spark, d)
    best, split = selected(spark, d)
    network, _ = models.train_network(frame)
    test = split.filter("not is_train")
    scored = {best.name: materialize(best.scored(test)), "MLP": materialize(network.scored(test))}
    stable = segments.stability(rfm_points(spark, d, "pre_cutoff"))
    log = runlog.metric_rows(spark, {
        "seed": config.SEED, "n_customers_labelled": frame.count(), "churn_rate": frame.agg(F.avg(config.LABEL)).first()[0],
    }, "run-1", datetime(2001, 1, 1))
    return runlog.snapshot(
        log, board, models.baselines(split), models.comparison(scored),
        calibration_report(scored[best.name], best.name), stable, rules.prune(mined_rules(spark, d)),
    )


@register("forest_importance")
def _(spark, d):
    model, _ = one_model(spark, d, "RandomForest", {"trees": 200, "max_depth": 10, "min_leaf": 5})
    return models.forest_importance(model, spark)


@register("pca_anomalies")
def _(spark, d):
    errors = materialize(anomaly.reconstruction_errors(materialize(pre_features(spark, d)), 4))
    return decisions.flag_anomalies(errors).orderBy(F.desc("reconstruction_error"), config.ID)


@register("anomaly_loss_curve")
def _(spark, d):
    return anomaly.loss_curve(materialize(pre_features(spark, d)))


@register("shapley_attribution")
def _(spark, d):
    model, split = one_model(spark, d, "RandomForest", {"trees": 200, "max_depth": 10, "min_leaf": 5})
    return attribution.ranked(attribution.shapley_values(model, split.filter("not is_train"), split.filter("is_train")))


@register("shapley_network")
def _(spark, d):
    network, _ = models.train_network(stored_frame(spark, d))
    split = split_frame(spark, d)
    values = attribution.shapley_values(network, split.filter("not is_train"), split.filter("is_train"))
    return attribution.ranked(values)
