"""Queries on splits, simple scores, evaluation, decisions and quality checks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.operators import anomaly, decisions, encoding, neighbours, quality, scoring, simple_models, splits
from custlens.operators.cluster_metrics import as_points, profile_clusters
from custlens.operators.eda import churn_overview, profile_minmax
from custlens.plans.lines import (
    AUC_SQL, CLEAN_SQL, FRAME_SQL, FULL_SQL, LABEL_SQL, PRE_SQL, SEGMENT_SQL, SPLIT_SQL, feature_lines, frame, full_features,
    given_segments, labels, pre_features, split_frame, stored_frame,
)
from custlens.plans.mining import ALL_SQL, DESCRIBE_SQL, ORDER, described_rules, names_sql
from custlens.plans.registry import register
from custlens.runtime import materialize, shared_folder
from custlens.sources import runlog


@register("stratified_split", f'WITH {SPLIT_SQL} SELECT "CustomerID", churn, is_train FROM split')
def _(spark, d):
    return split_frame(spark, d).select("CustomerID", "churn", "is_train")


@register("three_way_split", f"""WITH {SPLIT_SQL} SELECT "CustomerID", churn,
  CASE WHEN r <= floor(0.64 * n + 1e-9) THEN 0 WHEN r <= floor(0.8 * n + 1e-9) THEN 1 ELSE 2 END AS part FROM ordered""")
def _(spark, d):
    return splits.train_valid_test(stored_frame(spark, d)).select("CustomerID", "churn", "part")


@register("fold_assignment", f"""WITH {SPLIT_SQL} SELECT "CustomerID", churn,
  CASE WHEN r <= floor(n / 5.0 + 1e-9) THEN 0 WHEN r <= floor(n * 2 / 5.0 + 1e-9) THEN 1 WHEN r <= floor(n * 3 / 5.0 + 1e-9) THEN 2
       WHEN r <= floor(n * 4 / 5.0 + 1e-9) THEN 3 ELSE 4 END AS fold FROM ordered""")
def _(spark, d):
    return splits.folds(stored_frame(spark, d)).select("CustomerID", "churn", "fold")


SCALED_SQL = SPLIT_SQL + """,
st AS (SELECT avg("Recency") mr, stddev_pop("Recency") sr, avg(ln(1 + "Frequency")) mf, stddev_pop(ln(1 + "Frequency")) sf,
  avg(ln(1 + "Monetary")) mm, stddev_pop(ln(1 + "Monetary")) sm FROM split WHERE is_train),
scaled AS (SELECT "CustomerID", churn, is_train, ("Recency" - mr) / sr AS a, (ln(1 + "Frequency") - mf) / sf AS b, (ln(1 + "Monetary") - mm) / sm AS c FROM split, st)"""


def scaled_split(spark, d) -> DataFrame:
    split = split_frame(spark, d)
    logged = encoding.log1p_columns(split).withColumn("Recency", F.col("Recency").cast("double"))
    return encoding.standardize(logged, config.RFM, encoding.scale_stats(logged.filter("is_train"), config.RFM))


@register("knn_scores", f"""
WITH {SCALED_SQL}, pairs AS (
  SELECT t."CustomerID", s.churn, row_number() OVER (PARTITION BY t."CustomerID" ORDER BY
    (t.a - s.a) * (t.a - s.a) + (t.b - s.b) * (t.b - s.b) + (t.c - s.c) * (t.c - s.c), s."CustomerID") AS r
  FROM scaled t JOIN scaled s ON s.is_train AND NOT t.is_train)
SELECT "CustomerID", avg(churn) AS score FROM pairs WHERE r <= 21 GROUP BY 1""", {"score": 9})
def _(spark, d):
    scaled = scaled_split(spark, d)
    points = as_points(scaled, config.RFM, F.col("CustomerID").alias("id"), F.col("churn").alias("label"), "is_train")
    scores = neighbours.knn_scores(points.filter("is_train"), points.filter("not is_train"), 21)
    return scores.select(F.col("id").alias("CustomerID"), "score")


@register("gaussian_nb_scores", f"""
WITH {SCALED_SQL}, ov AS (SELECT 1e-9 * greatest(var_pop(a), var_pop(b), var_pop(c)) AS eps FROM scaled WHERE is_train),
g AS (SELECT churn, ln(count(*) / sum(count(*)) OVER ()) AS prior, avg(a) ma, var_pop(a) + any_value(eps) va, avg(b) mb, var_pop(b) + any_value(eps) vb,
      avg(c) mc, var_pop(c) + any_value(eps) vc FROM scaled, ov WHERE is_train GROUP BY 1),
l AS (SELECT "CustomerID", g.churn AS k, prior - 0.5 * (ln(2 * pi() * va) + ln(2 * pi() * vb) + ln(2 * pi() * vc))
      - (a - ma) * (a - ma) / (2 * va) - (b - mb) * (b - mb) / (2 * vb) - (c - mc) * (c - mc) / (2 * vc) AS lp FROM scaled s, g WHERE NOT is_train)
SELECT "CustomerID", 1 / (1 + exp(max(CASE WHEN k = 0 THEN lp END) - max(CASE WHEN k = 1 THEN lp END))) AS score FROM l GROUP BY 1""", {"score": 9})
def _(spark, d):
    scaled = scaled_split(spark, d)
    model = simple_models.gaussian_nb(scaled.filter("is_train"), config.RFM)
    return simple_models.gaussian_nb_scores(model, scaled.filter("not is_train"), config.RFM, "CustomerID")


P_SQL = """1.0 / (1.0 + exp(-(0.2 + 0.006 * "Recency" - 0.12 * "Frequency" - 0.004 * avg_basket_size)))"""
SCORED_SQL = FRAME_SQL + f""",
scored AS (SELECT "CustomerID", churn AS label, {P_SQL} AS score, CAST({P_SQL} >= 0.5 AS INTEGER) AS pred FROM frame),
score9 AS (SELECT label, pred, round(score, 9) AS score FROM scored)"""


def scored_rows(spark, d) -> DataFrame:
    """Scorecard probabilities beside labels, written once; rounded so that ties are the same everywhere."""
    rows = frame(spark, d)
    scores = decisions.scorecard_scores(rows).drop("scored_model")
    joined = rows.select("CustomerID", F.col("churn").alias("label")).join(scores, "CustomerID")
    return materialize(joined.select("label", F.round("churn_probability", 9).alias("score"), F.col("churn_prediction").alias("pred")))


@register("auc_exact", f"WITH {SCORED_SQL} {AUC_SQL.format(scored='score9')}", {"AUC": 9})
def _(spark, d):
    return scoring.roc_auc(scored_rows(spark, d))


@register("auc_document_quality", f"""
WITH s AS (SELECT quality AS label, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)) {AUC_SQL.format(scored='s')}""", {"AUC": 9})
def _(spark, d):
    """AUC with many tied scores: text length against given quality labels."""
    marks, docs = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("labels", "documents"))
    rows = marks.join(docs.select("doc_id", "n_chars"), "doc_id")
    return scoring.roc_auc(rows.select(F.col("quality").alias("label"), F.col("n_chars").cast("double").alias("score")))


CELLS = """SELECT count(*) FILTER (label = 1 AND pred = 1) AS tp, count(*) FILTER (label = 0 AND pred = 1) AS fp,
  count(*) FILTER (label = 1 AND pred = 0) AS fn, count(*) FILTER (label = 0 AND pred = 0) AS tn FROM scored"""


@register("classification_metrics", f"""
WITH {SCORED_SQL}, c AS ({CELLS}) SELECT 2.0 * tp / (2 * tp + fp + fn) AS "F1", tp / (tp + fp) AS "Precision", tp / (tp + fn) AS "Recall",
  (tp + tn) / (tp + fp + fn + tn) AS "Accuracy" FROM c""", dict.fromkeys(["F1", "Precision", "Recall", "Accuracy"], 9))
def _(spark, d):
    return scoring.classification_metrics(scored_rows(spark, d))


@register("confusion_matrix", f"""
WITH {SCORED_SQL}, c AS ({CELLS}) SELECT 0 AS label, 0 AS pred, tn AS n FROM c UNION ALL SELECT 0, 1, fp FROM c UNION ALL SELECT 1, 0, fn FROM c UNION ALL SELECT 1, 1, tp FROM c""")
def _(spark, d):
    return scoring.confusion_matrix(scored_rows(spark, d))


@register("roc_points", f"""
WITH {SCORED_SQL}, g AS (SELECT score, sum(label) AS p, sum(1 - label) AS q FROM score9 GROUP BY 1)
SELECT score AS threshold, sum(q) OVER w / sum(q) OVER () AS fpr, sum(p) OVER w / sum(p) OVER () AS tpr FROM g
WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) UNION ALL SELECT NULL, 0.0, 0.0""", {"threshold": 9, "fpr": 9, "tpr": 9})
def _(spark, d):
    return scoring.roc_points(scored_rows(spark, d))


@register("brier", f"WITH {SCORED_SQL} SELECT avg((score - label) * (score - label)) AS brier_score FROM score9", {"brier_score": 9})
def _(spark, d):
    return scoring.brier(scored_rows(spark, d))


EDGE_SQL = ", ".join(f"quantile_cont(score, {i / 10}) AS e{i}" for i in range(1, 10))
PLACE_SQL = " + ".join(f"CAST(score > e{i} AS INTEGER)" for i in range(1, 10))
CURVE_SQL = f"""e AS (SELECT {EDGE_SQL} FROM score9),
curve AS (SELECT CAST(row_number() OVER (ORDER BY place) AS INTEGER) AS bin, n, mean_predicted_prob, fraction_positive FROM (
  SELECT {PLACE_SQL} AS place, count(*) AS n, avg(score) AS mean_predicted_prob, avg(label) AS fraction_positive FROM score9, e GROUP BY 1))"""


@register("reliability_curve", f"WITH {SCORED_SQL}, {CURVE_SQL} SELECT * FROM curve", {"mean_predicted_prob": 9, "fraction_positive": 9})
def _(spark, d):
    return scoring.reliability_curve(scored_rows(spark, d))


@register("calibration_report", f"""
WITH {SCORED_SQL}, {CURVE_SQL} SELECT 'scorecard' AS model, bin, mean_predicted_prob, fraction_positive,
  (SELECT avg((score - label) * (score - label)) FROM score9) AS brier_score,
  sum(abs(mean_predicted_prob - fraction_positive) * n) OVER () / sum(n) OVER () AS ece, max(abs(mean_predicted_prob - fraction_positive)) OVER () AS largest_gap
FROM curve""", dict.fromkeys(["mean_predicted_prob", "fraction_positive", "brier_score", "ece", "largest_gap"], 9))
def _(spark, d):
    return scoring.calibration_report(scored_rows(spark, d), "scorecard")


TIER = "CASE WHEN {p} >= 0.7 THEN 'High' WHEN {p} >= 0.4 THEN 'Medium' ELSE 'Low' END"


@register("scorecard_scores", f"""
WITH {PRE_SQL}, p AS (SELECT "CustomerID", {P_SQL} AS churn_probability FROM features)
SELECT *, CAST(churn_probability >= 0.5 AS INTEGER) AS churn_prediction, {TIER.format(p='churn_probability')} AS churn_risk_tier, 'scorecard' AS scored_model FROM p""", {"churn_probability": 9})
def _(spark, d):
    return decisions.scorecard_scores(pre_features(spark, d))


PROFILE_SQL = FULL_SQL + f",{SEGMENT_SQL}" + """, p AS (
  SELECT cluster, count(*) AS n_customers, round_even(avg("Recency"), 2) AS "Recency_mean", round_even(avg("Frequency"), 2) AS "Frequency_mean",
         round_even(avg("Monetary"), 2) AS "Monetary_mean" FROM full_features JOIN segments USING ("CustomerID") GROUP BY 1)"""
MEANS = {"Recency_mean": 2, "Frequency_mean": 2, "Monetary_mean": 2}


@register("cluster_profile", f"WITH {PROFILE_SQL} SELECT *, round_even(n_customers / sum(n_customers) OVER () * 100, 1) AS share_pct FROM p", MEANS)
def _(spark, d):
    return profile_clusters(full_features(spark, d), given_segments(spark, d))


@register("profile_minmax", f"WITH {PROFILE_SQL} SELECT cluster, " + ", ".join(
    f'("{c}" - min("{c}") OVER ()) / (max("{c}") OVER () - min("{c}") OVER ()) AS "{c}"' for c in MEANS) + " FROM p", dict.fromkeys(MEANS, 4))
def _(spark, d):
    return profile_minmax(profile_clusters(full_features(spark, d), given_segments(spark, d)))


RATES_SQL = f'{CLEAN_SQL},{LABEL_SQL},{SEGMENT_SQL}, rates AS (SELECT cluster, count(*) AS n_customers, avg(churn) AS churn_rate FROM labelled JOIN segments USING ("CustomerID") GROUP BY 1)'


@register("churn_by_segment", f"WITH {RATES_SQL} SELECT * FROM rates", {"churn_rate": 9})
def _(spark, d):
    return decisions.churn_by_segment(labels(spark, d), given_segments(spark, d))


@register("churn_gap", f"WITH {RATES_SQL} SELECT max(churn_rate) - min(churn_rate) AS churn_gap FROM rates", {"churn_gap": 9})
def _(spark, d):
    return decisions.churn_gap(decisions.churn_by_segment(labels(spark, d), given_segments(spark, d)))


@register("churn_overview", f"""WITH {RATES_SQL} SELECT cluster, n_customers, churn_rate FROM rates UNION ALL
SELECT NULL, count(*), avg(churn) FROM labelled JOIN segments USING ("CustomerID")""", {"churn_rate": 9})
def _(spark, d):
    return churn_overview(labels(spark, d), given_segments(spark, d))


@register("segment_synthesis", f"""
WITH {PRE_SQL},{LABEL_SQL},{SEGMENT_SQL} SELECT cluster, count(*) AS n_customers, avg(churn) AS churn_rate, avg("Recency") AS "Recency_mean",
  avg("Frequency") AS "Frequency_mean", avg("Monetary") AS "Monetary_mean"
FROM segments JOIN labelled USING ("CustomerID") LEFT JOIN features USING ("CustomerID") GROUP BY 1""",
          {"churn_rate": 9, "Recency_mean": 6, "Frequency_mean": 6, "Monetary_mean": 3})
def _(spark, d):
    lines = feature_lines(spark, d)
    return decisions.segment_synthesis(given_segments(spark, d), labels(spark, d, lines), pre_features(spark, d, lines))


ERROR_SQL = "(" + " + ".join(f'power(("{c}" - avg("{c}") OVER ()) / stddev_pop("{c}") OVER (), 2)' for c in config.NUMERIC) + ") / 6"
FLAG_SQL = PRE_SQL + f""",
err AS (SELECT "CustomerID", {ERROR_SQL} AS reconstruction_error FROM features),
flagged AS (SELECT * FROM err WHERE reconstruction_error >= (SELECT quantile_cont(reconstruction_error, 0.95) FROM err))"""


def far_customers(features: DataFrame) -> DataFrame:
    """Bottleneck 0: distance from the mean customer, an error that plain SQL can check."""
    return decisions.flag_anomalies(materialize(anomaly.reconstruction_errors(features, 0)))


@register("anomaly_flags", f"WITH {FLAG_SQL} SELECT * FROM flagged", {"reconstruction_error": 6})
def _(spark, d):
    return far_customers(materialize(pre_features(spark, d)))


@register("anomaly_share", f"""
WITH {FLAG_SQL},{SEGMENT_SQL} SELECT cluster, avg(CASE WHEN f."CustomerID" IS NULL THEN 0.0 ELSE 100.0 END) AS anomaly_pct
FROM segments s LEFT JOIN flagged f ON f."CustomerID" = s."CustomerID" GROUP BY 1""", {"anomaly_pct": 9})
def _(spark, d):
    return decisions.anomaly_share(given_segments(spark, d), far_customers(materialize(pre_features(spark, d))))


RUN = "2001-01-01T00:00:00+00:00"
DECISION_SQL = ALL_SQL + PRE_SQL[len(CLEAN_SQL):] + f",{LABEL_SQL},{SEGMENT_SQL}" + DESCRIBE_SQL + f""",
rates AS (SELECT cluster, avg(churn) AS churn_rate FROM labelled JOIN segments USING ("CustomerID") GROUP BY 1),
err AS (SELECT "CustomerID", {ERROR_SQL} AS reconstruction_error FROM features),
flagged AS (SELECT * FROM err WHERE reconstruction_error >= (SELECT quantile_cont(reconstruction_error, 0.95) FROM err)),
offer AS (SELECT {names_sql('consequents')} AS o FROM best ORDER BY {ORDER} LIMIT 1),
q AS (SELECT quantile_cont("Monetary", 0.25) AS q25, quantile_cont("Monetary", 0.75) AS q75, quantile_cont("Recency", 0.75) AS r75 FROM features),
d0 AS (
  SELECT f."CustomerID", '{RUN}' AS source_run_generated_at, "Recency", "Frequency", "Monetary", avg_basket_value, unique_products, "DominantCountry",
    {P_SQL} AS churn_probability, l.churn AS churn_label, s.cluster AS segment, coalesce(churn_rate, 0.0) AS segment_churn_rate,
    a."CustomerID" IS NOT NULL AS anomaly_flag, reconstruction_error AS anomaly_score,
    CASE WHEN "Monetary" >= q75 THEN 'High' WHEN "Monetary" < q25 THEN 'Low' ELSE 'Medium' END AS customer_value_tier, "Recency" >= r75 AS dormant
  FROM features f LEFT JOIN labelled l ON l."CustomerID" = f."CustomerID" LEFT JOIN segments s ON s."CustomerID" = f."CustomerID"
  LEFT JOIN rates r ON r.cluster = s.cluster LEFT JOIN flagged a ON a."CustomerID" = f."CustomerID", q),
d1 AS (SELECT *, CAST(churn_probability >= 0.5 AS INTEGER) AS churn_prediction, {TIER.format(p='churn_probability')} AS churn_risk_tier FROM d0),
d2 AS (
  SELECT *, CASE churn_risk_tier WHEN 'High' THEN 50 WHEN 'Medium' THEN 30 ELSE 0 END + CASE customer_value_tier WHEN 'High' THEN 25 WHEN 'Medium' THEN 10 ELSE 0 END
    + CASE WHEN segment_churn_rate >= 0.7 THEN 20 WHEN segment_churn_rate >= 0.4 THEN 10 ELSE 0 END + CASE WHEN anomaly_flag THEN 15 ELSE 0 END
    + CASE WHEN dormant THEN 10 ELSE 0 END AS priority_score,
    CASE WHEN churn_risk_tier = 'High' AND customer_value_tier = 'High' THEN 'Retain immediately' WHEN churn_risk_tier = 'High' THEN 'Win-back campaign'
      WHEN churn_risk_tier = 'Low' AND customer_value_tier = 'High' THEN 'VIP nurture / Cross-sell' WHEN anomaly_flag THEN 'Manual review'
      WHEN dormant THEN 'Reactivation campaign' ELSE 'Monitor / Standard nurture' END AS recommended_action FROM d1),
decided AS (
  SELECT * EXCLUDE (dormant), row_number() OVER (ORDER BY priority_score DESC, "Monetary" DESC, "CustomerID") AS priority_rank,
    CASE recommended_action WHEN 'Retain immediately' THEN 'High churn risk and high value' WHEN 'Win-back campaign' THEN 'High churn risk, lower value'
      WHEN 'VIP nurture / Cross-sell' THEN 'Low churn risk and high value' WHEN 'Manual review' THEN 'Anomalous behaviour, no stronger action'
      WHEN 'Reactivation campaign' THEN 'Dormant (top-quartile recency)' ELSE 'No urgent signal' END
    || CASE WHEN recommended_action = 'Reactivation campaign' AND segment_churn_rate >= 0.7 THEN '; in high-churn segment' ELSE '' END
    || CASE WHEN anomaly_flag AND recommended_action <> 'Manual review' THEN '; anomaly flagged' ELSE '' END AS action_reason,
    CASE WHEN churn_risk_tier = 'High' AND customer_value_tier = 'High' THEN 'High-touch voucher' WHEN churn_risk_tier = 'High' THEN 'Light discount'
      WHEN churn_risk_tier = 'Low' AND customer_value_tier = 'High' THEN 'Loyalty perk' ELSE 'None' END AS retention_offer_type,
    CASE WHEN recommended_action = 'VIP nurture / Cross-sell' THEN 'Yes' ELSE 'No' END AS cross_sell_signal,
    CASE WHEN recommended_action = 'VIP nurture / Cross-sell' THEN (SELECT o FROM offer) ELSE '' END AS next_best_offer FROM d2)"""
TABLE_DIGITS = {"Monetary": 4, "avg_basket_value": 4, "churn_probability": 9, "segment_churn_rate": 9, "anomaly_score": 6}


def decision_inputs(spark, d) -> dict[str, DataFrame]:
    """Stage tables of the decision flow, each written once."""
    lines = feature_lines(spark, d)
    features, known = materialize(pre_features(spark, d, lines)), materialize(labels(spark, d, lines))
    segments, named = given_segments(spark, d), described_rules(spark, d, lines)
    return {
        "features": features, "labels": known, "segments": segments, "scores": decisions.scorecard_scores(features),
        "segment_rates": decisions.churn_by_segment(known, segments), "anomalies": far_customers(features), "rules": named,
    }


def decision_rows(spark, d) -> DataFrame:
    return decisions.decision_table(**decision_inputs(spark, d), source_run=RUN)


@register("decision_table", f"WITH {DECISION_SQL} SELECT * FROM decided", TABLE_DIGITS)
def _(spark, d):
    return decision_rows(spark, d)


@register("top_priority", f"WITH {DECISION_SQL} SELECT * FROM decided WHERE priority_rank <= 25", TABLE_DIGITS)
def _(spark, d):
    return decisions.top_decisions(**decision_inputs(spark, d), source_run=RUN)


@register("decision_summary", f"""
WITH {DECISION_SQL} SELECT recommended_action, churn_risk_tier, customer_value_tier, segment, count(*) AS n_customers,
  round_even(count(*) / sum(count(*)) OVER (), 4) AS share_of_customers, round_even(avg("Monetary"), 2) AS avg_monetary,
  round_even(avg(churn_probability), 4) AS avg_churn_probability, CAST(sum(CAST(anomaly_flag AS INTEGER)) AS BIGINT) AS anomaly_count FROM decided GROUP BY 1, 2, 3, 4""",
          {"share_of_customers": 4, "avg_monetary": 2, "avg_churn_probability": 4})
def _(spark, d):
    return decisions.decision_summary(decision_rows(spark, d))


COUNTS_SQL = """counts AS (SELECT count(*) AS decision_table_customers, count(*) FILTER (churn_risk_tier = 'High') AS decision_high_priority_customers,
  count(*) FILTER (recommended_action IN ('Retain immediately', 'Win-back campaign')) AS decision_retention_targets,
  count(*) FILTER (cross_sell_signal = 'Yes') AS decision_cross_sell_targets, count(*) FILTER (recommended_action = 'Manual review') AS decision_manual_review_targets FROM decided)"""


@register("run_counts", f"WITH {DECISION_SQL}, {COUNTS_SQL} SELECT * FROM counts")
def _(spark, d):
    return decisions.run_counts(decision_rows(spark, d))


def _logged(spark, one_row: DataFrame, path: str) -> None:
    """Two runs into one log: the later values must win."""
    zero = one_row.select(*[F.lit(0).alias(c) for c in one_row.columns])
    runlog.append(runlog.row_as_metrics(zero, "run-1", datetime(2001, 1, 1)), path)
    runlog.append(runlog.row_as_metrics(one_row, "run-2", datetime(2001, 1, 2)), path)


@register("run_log", f"""
WITH {DECISION_SQL}, {COUNTS_SQL} SELECT metric, CAST(v AS VARCHAR) AS value FROM counts UNPIVOT (v FOR metric IN (
  decision_table_customers, decision_high_priority_customers, decision_retention_targets, decision_cross_sell_targets, decision_manual_review_targets))""")
def _(spark, d):
    import uuid

    path = f"{shared_folder(spark)}/custlens/{uuid.uuid4().hex}"
    _logged(spark, decisions.run_counts(decision_rows(spark, d)), path)
    return runlog.latest(runlog.read_log(spark, path))


FEATURE_COLUMNS = ["CustomerID", "Recency", "Frequency", "Monetary", "avg_basket_value", "avg_basket_size", "unique_products", "DominantCountry"]
# Every check is computed from the tables; `{f}` and `{t}` are the features and the decision table, sound or damaged.
REPORT_SQL = """
c AS (SELECT count(*) AS n, count(DISTINCT "CustomerID") AS ids, count(recommended_action) AS actions, count(priority_score) AS scores, count(DISTINCT priority_rank) AS ranks,
  min(priority_rank) AS first, max(priority_rank) AS last, min(source_run_generated_at) AS s1, max(source_run_generated_at) AS s2 FROM {t}),
top AS (SELECT "CustomerID" FROM decided WHERE priority_rank <= 25)
SELECT 'classification_features: columns' AS "check", (SELECT count({cols}) FROM {f}) >= 0 AS passed
UNION ALL SELECT 'churn_labels: columns', (SELECT count(churn) FROM labelled) >= 0
UNION ALL SELECT 'customer_decision_table: columns', (SELECT count(priority_rank) FROM {t}) >= 0
UNION ALL SELECT 'top_priority_customers: columns', (SELECT count(*) FROM top) >= 0
UNION ALL SELECT 'features and labels: customer sets', NOT EXISTS (SELECT 1 FROM {f} AS f FULL JOIN labelled l ON l."CustomerID" = f."CustomerID" WHERE f."CustomerID" IS NULL OR l."CustomerID" IS NULL)
UNION ALL SELECT 'classification_features: NULL cells', NOT EXISTS (SELECT 1 FROM {f} WHERE {nulls})
UNION ALL SELECT 'churn_labels: NULL cells', NOT EXISTS (SELECT 1 FROM labelled WHERE "CustomerID" IS NULL OR churn IS NULL)
UNION ALL SELECT 'features: sign of Recency', (SELECT count(*) FILTER ("Recency" < 0) = 0 FROM {f})
UNION ALL SELECT 'decisions: one row each', (SELECT n = ids AND n = (SELECT count(*) FROM {f}) FROM c)
UNION ALL SELECT 'decisions: every action set', (SELECT actions = n FROM c)
UNION ALL SELECT 'decisions: every score set', (SELECT scores = n FROM c)
UNION ALL SELECT 'decisions: gapless ranks', (SELECT ranks = n AND first = 1 AND last = n FROM c)
UNION ALL SELECT 'decisions: run stamp', (SELECT s1 = s2 FROM c)
UNION ALL SELECT 'top list: known customers', NOT EXISTS (SELECT 1 FROM top WHERE "CustomerID" NOT IN (SELECT "CustomerID" FROM {t}))"""


def _report_sql(features: str, table: str) -> str:
    quoted = [f'"{c}"' for c in FEATURE_COLUMNS]
    return REPORT_SQL.format(f=features, t=table, cols="concat(" + ", ".join(quoted) + ")", nulls=" OR ".join(f"{c} IS NULL" for c in quoted))


def _report(spark, known: DataFrame, features: DataFrame, table: DataFrame, top: DataFrame) -> DataFrame:
    found = quality.report(
        quality.columns_present(spark, {
            "classification_features": features, "churn_labels": known, "customer_decision_table": table, "top_priority_customers": top,
        }),
        quality.same_customers(features, known), quality.no_missing(features, "classification_features"), quality.no_missing(known, "churn_labels"),
        quality.recency_not_negative(features), quality.decisions_sound(table, features, top),
    )
    return found.select("check", "passed")


@register("quality_report", f"WITH {DECISION_SQL}, {_report_sql('features', 'decided')}")
def _(spark, d):
    inputs = decision_inputs(spark, d)
    table = materialize(decisions.decision_table(**inputs, source_run=RUN))
    return _report(spark, inputs["labels"], inputs["features"], table, decisions.top_priority(table))


@register("quality_report_broken", f"""
WITH {DECISION_SQL},
f2 AS (SELECT * REPLACE ("Recency" - 1000 * ("CustomerID" % 7 = 0)::INT AS "Recency", CASE WHEN "CustomerID" % 11 <> 0 THEN "Monetary" END AS "Monetary") FROM features WHERE "CustomerID" % 13 <> 0),
t2 AS (SELECT * REPLACE (CASE WHEN priority_rank <> 5 THEN recommended_action END AS recommended_action, CASE WHEN priority_rank <> 6 THEN priority_score END AS priority_score,
  CASE WHEN priority_rank = 7 THEN 'other run' ELSE source_run_generated_at END AS source_run_generated_at) FROM decided WHERE priority_rank <> 2),
{_report_sql('f2', 't2')}""")
def _(spark, d):
    """The same checks on damaged copies: customers, cells, ranks and stamps that are wrong are found."""
    inputs = decision_inputs(spark, d)
    table = materialize(decisions.decision_table(**inputs, source_run=RUN))
    rank, number = F.col("priority_rank"), F.col(config.ID)
    features = inputs["features"].filter(number % 13 != 0).withColumns({
        "Recency": F.col("Recency") - 1000 * (number % 7 == 0).cast("int"), "Monetary": F.when(number % 11 != 0, F.col("Monetary")),
    })
    damaged = table.filter(rank != 2).withColumns({
        "recommended_action": F.when(rank != 5, F.col("recommended_action")), "priority_score": F.when(rank != 6, F.col("priority_score")),
        "source_run_generated_at": F.when(rank == 7, "other run").otherwise(F.col("source_run_generated_at")),
    })
    return _report(spark, inputs["labels"], features, damaged, decisions.top_priority(table))
