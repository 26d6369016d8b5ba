"""Per-customer decisions: tiers, priority score, action, offer, rank, summary."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens import config
from custlens.functions.ordering import global_rank
from custlens.functions.quantiles import exact_quantiles
from custlens.operators.rules import strongest_first
from custlens.runtime import materialize

# Texts, points and column order of the published decision table.
VIP = "VIP nurture / Cross-sell"
RETAIN = "Retain immediately"
WIN_BACK = "Win-back campaign"
REVIEW = "Manual review"
REACTIVATE = "Reactivation campaign"
MONITOR = "Monitor / Standard nurture"
REASONS = {
    RETAIN: "High churn risk and high value",
    WIN_BACK: "High churn risk, lower value",
    VIP: "Low churn risk and high value",
    REVIEW: "Anomalous behaviour, no stronger action",
    REACTIVATE: "Dormant (top-quartile recency)",
    MONITOR: "No urgent signal",
}
HIGH_SEGMENT_SUFFIX = "; in high-churn segment"
ANOMALY_SUFFIX = "; anomaly flagged"
OFFERS = ["High-touch voucher", "Light discount", "Loyalty perk", "None"]
POINTS = {"risk": (50, 30), "value": (25, 10), "segment": (20, 10), "anomaly": 15, "dormant": 10}
TABLE_COLUMNS = [
    "CustomerID", "source_run_generated_at", "Recency", "Frequency", "Monetary", "avg_basket_value",
    "unique_products", "DominantCountry", "churn_probability", "churn_prediction", "churn_risk_tier",
    "churn_label", "segment", "segment_churn_rate", "anomaly_flag", "anomaly_score", "customer_value_tier",
    "priority_rank", "priority_score", "recommended_action", "action_reason", "retention_offer_type",
    "cross_sell_signal", "next_best_offer",
]
SUMMARY_KEYS = ["recommended_action", "churn_risk_tier", "customer_value_tier", "segment"]


def risk_tier(p: Column) -> Column:
    return F.when(p >= config.HIGH_RISK, "High").when(p >= config.MEDIUM_RISK, "Medium").otherwise("Low")


def value_tier(monetary: Column, q25: float, q75: float) -> Column:
    return F.when(monetary >= q75, "High").when(monetary < q25, "Low").otherwise("Medium")


def _points(high: Column, medium: Column, pair: tuple[int, int]) -> Column:
    return F.when(high, pair[0]).when(medium, pair[1]).otherwise(0)


def priority_score(risk: Column, value: Column, segment_rate: Column, anomaly: Column, dormant: Column) -> Column:
    """Additive score from 0 to 120; a missing segment rate counts as 0."""
    rate = F.coalesce(segment_rate, F.lit(0.0))
    return (
        _points(risk == "High", risk == "Medium", POINTS["risk"])
        + _points(value == "High", value == "Medium", POINTS["value"])
        + _points(rate >= config.HIGH_SEGMENT_CHURN, rate >= config.MEDIUM_SEGMENT_CHURN, POINTS["segment"])
        + F.when(anomaly, POINTS["anomaly"]).otherwise(0)
        + F.when(dormant, POINTS["dormant"]).otherwise(0)
    ).cast("int")


def recommended_action(risk: Column, value: Column, anomaly: Column, dormant: Column) -> Column:
    """The first rule that holds names the action."""
    return (
        F.when((risk == "High") & (value == "High"), RETAIN)
        .when(risk == "High", WIN_BACK)
        .when((risk == "Low") & (value == "High"), VIP)
        .when(anomaly, REVIEW)
        .when(dormant, REACTIVATE)
        .otherwise(MONITOR)
    )


def action_reason(action: Column, segment_rate: Column, anomaly: Column) -> Column:
    reason = F.lit(REASONS[MONITOR])
    for name, text in REASONS.items():
        reason = F.when(action == name, text).otherwise(reason)
    high_segment = (action == REACTIVATE) & (F.coalesce(segment_rate, F.lit(0.0)) >= config.HIGH_SEGMENT_CHURN)
    return F.concat(
        reason,
        F.when(high_segment, HIGH_SEGMENT_SUFFIX).otherwise(""),
        F.when(anomaly & (action != REVIEW), ANOMALY_SUFFIX).otherwise(""),
    )


def retention_offer(risk: Column, value: Column) -> Column:
    voucher, discount, perk, none = OFFERS
    return (
        F.when((risk == "High") & (value == "High"), voucher).when(risk == "High", discount)
        .when((risk == "Low") & (value == "High"), perk).otherwise(none)
    )


def top_offer(rules: DataFrame) -> str:
    """Consequent text of the strongest rule, empty without rules."""
    if "consequents_desc" not in rules.columns:
        return ""
    best = rules.orderBy(*strongest_first()).select("consequents_desc").first()
    return best["consequents_desc"] if best else ""


def score_customers(features: DataFrame, model, name: str = "") -> DataFrame:
    """Probability, prediction at 0.5, tier and model name from a fitted binary probabilistic model."""
    scored = model.transform(features)
    if "probability" not in scored.columns:
        raise TypeError(f"no probability column in the output of {name or type(model).__name__}")
    p = vector_to_array("probability")
    scored = scored.select(config.ID, p.alias("p"))
    width = scored.select(F.size("p").alias("k")).first()
    if width and width["k"] != 2:
        raise ValueError(f"two class probabilities are needed per customer, found {width['k']}")
    return churn_scores(scored.select(config.ID, F.col("p")[1].alias("churn_probability")), name)


def churn_scores(probabilities: DataFrame, name: str) -> DataFrame:
    p = F.col("churn_probability")
    return probabilities.select(
        config.ID, "churn_probability", (p >= 0.5).cast("int").alias("churn_prediction"),
        risk_tier(p).alias("churn_risk_tier"), F.lit(name).alias("scored_model"),
    )


# Fixed weights of a plain scorecard: a deterministic stand-in where no fitted model is wanted.
SCORECARD = {"Recency": 0.006, "Frequency": -0.12, "avg_basket_size": -0.004, "intercept": 0.2}


def scorecard_scores(features: DataFrame, name: str = "scorecard", weights: dict[str, float] = SCORECARD) -> DataFrame:
    logit = sum((F.col(c).cast("double") * F.lit(w) for c, w in weights.items() if c != "intercept"), F.lit(weights["intercept"]))
    probability = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return churn_scores(features.select(config.ID, probability.alias("churn_probability")), name)


def duplicate_keys(df: DataFrame, key: str) -> int:
    return df.groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").count()


def unranked_decisions(
    features: DataFrame,
    scores: DataFrame,
    labels: DataFrame,
    segments: DataFrame,
    segment_rates: DataFrame,
    anomalies: DataFrame,
    rules: DataFrame | None = None,
    source_run: str = "",
    train_ids: DataFrame | None = None,
) -> DataFrame:
    """One row per customer, without its rank.

    All inputs are keyed by customer, so the joins share one partitioning; a side with a repeated key
    raises instead of multiplying customers. Anomalies are read once for flag and score. `train_ids`
    adds `is_train`, which marks scores that the model saw in training.
    """
    for name, df, key in (("segments", segments, config.ID), ("segment_rates", segment_rates, "cluster"), ("labels", labels, config.ID), ("scores", scores, config.ID)):
        if duplicate_keys(df, key):
            raise ValueError(f"repeated keys in {name}: the join would fan out")
    cuts = exact_quantiles(features, {"Monetary": [0.25, 0.75], "Recency": [0.75]})
    (q25, q75), (dormant_from,) = cuts["Monetary"], cuts["Recency"]
    # one row per segment, written, so that Spark knows its size and does not deal all customers by segment
    segment_rates = materialize(segment_rates.select("cluster", "churn_rate"))
    rated = segments.select(config.ID, F.col("cluster").alias("segment")).join(
        segment_rates.select(F.col("cluster").alias("segment"), F.col("churn_rate").alias("segment_churn_rate")), "segment", "left"
    )
    score = F.col("reconstruction_error") if "reconstruction_error" in anomalies.columns else F.lit(None).cast("double")
    flagged = anomalies.groupBy(config.ID).agg(F.max(score).alias("anomaly_score")).withColumn("anomaly_flag", F.lit(True))
    t = (
        features.select(config.ID, *config.RFM, "avg_basket_value", "unique_products", config.COUNTRY)
        .join(scores.drop("scored_model"), config.ID, "left")
        .join(labels.select(config.ID, F.col(config.LABEL).alias("churn_label")), config.ID, "left")
        .join(rated, config.ID, "left")
        .join(flagged, config.ID, "left")
    )
    extra = []
    if train_ids is not None:
        t = t.join(train_ids.select(config.ID).distinct().withColumn("is_train", F.lit(True)), config.ID, "left")
        extra = [F.coalesce("is_train", F.lit(False)).alias("is_train")]
    risk, value, rate = F.col("churn_risk_tier"), F.col("customer_value_tier"), F.col("segment_churn_rate")
    anomaly, dormant = F.col("anomaly_flag"), F.col("Recency") >= F.lit(dormant_from)
    action = F.col("recommended_action")
    offer = top_offer(rules) if rules is not None else ""
    t = (
        t.withColumns({
            "segment_churn_rate": F.coalesce(rate, F.lit(0.0)),
            "anomaly_flag": F.coalesce("anomaly_flag", F.lit(False)),
            "customer_value_tier": value_tier(F.col("Monetary"), q25, q75),
        })
        .withColumns({
            "priority_score": priority_score(risk, value, rate, anomaly, dormant),
            "recommended_action": recommended_action(risk, value, anomaly, dormant),
        })
        .withColumns({
            "action_reason": action_reason(action, rate, anomaly),
            "retention_offer_type": retention_offer(risk, value),
            "cross_sell_signal": F.when(action == VIP, "Yes").otherwise("No"),
            "next_best_offer": F.when(action == VIP, F.lit(offer)).otherwise(""),
            "source_run_generated_at": F.lit(source_run),
        })
    )
    return t.select(*[c for c in TABLE_COLUMNS if c != "priority_rank"], *extra)


def _most_urgent() -> list[Column]:
    return [F.desc("priority_score"), F.desc("Monetary"), F.asc(config.ID)]


def decision_table(*inputs, **more) -> DataFrame:
    """One ranked row per customer, from the inputs of `unranked_decisions`."""
    t = unranked_decisions(*inputs, **more)
    return global_rank(t, _most_urgent(), "priority_rank").select(*TABLE_COLUMNS, *[c for c in t.columns if c not in TABLE_COLUMNS])


def top_decisions(*inputs, k: int = config.TOP_PRIORITY, **more) -> DataFrame:
    """The first `k` rows of the decision table. Each task keeps `k` rows; nothing else is ranked."""
    t = unranked_decisions(*inputs, **more)
    first = t.orderBy(*_most_urgent()).limit(k).withColumn("priority_rank", F.row_number().over(Window.orderBy(*_most_urgent())).cast("bigint"))
    return first.select(*TABLE_COLUMNS, *[c for c in t.columns if c not in TABLE_COLUMNS])


def top_priority(table: DataFrame, k: int = config.TOP_PRIORITY) -> DataFrame:
    return table.filter(F.col("priority_rank") <= k)


def decision_summary(table: DataFrame) -> DataFrame:
    """Customers, share, means and anomalies per action bucket; customers without a segment stay, as NULL."""
    total = table.agg(F.count("*")).scalar()
    return table.groupBy(*SUMMARY_KEYS).agg(
        F.count(config.ID).alias("n_customers"),
        F.avg("Monetary").alias("m"), F.avg("churn_probability").alias("p"),
        F.sum(F.col("anomaly_flag").cast("int")).alias("anomaly_count"),
    ).select(
        *SUMMARY_KEYS, "n_customers",
        F.bround(F.col("n_customers") / total, 4).alias("share_of_customers"),
        F.bround("m", 2).alias("avg_monetary"), F.bround("p", 4).alias("avg_churn_probability"), "anomaly_count",
    ).orderBy(F.desc("n_customers"), *SUMMARY_KEYS)


def run_counts(table: DataFrame) -> DataFrame:
    def n(c: Column, name: str) -> Column:
        return F.count(F.when(c, 1)).alias(name)

    action = F.col("recommended_action")
    return table.agg(
        F.count("*").alias("decision_table_customers"),
        n(F.col("churn_risk_tier") == "High", "decision_high_priority_customers"),
        n(action.isin(RETAIN, WIN_BACK), "decision_retention_targets"),
        n(F.col("cross_sell_signal") == "Yes", "decision_cross_sell_targets"),
        n(action == REVIEW, "decision_manual_review_targets"),
    )


def churn_by_segment(labels: DataFrame, segments: DataFrame) -> DataFrame:
    joined = labels.join(segments.select(config.ID, "cluster"), config.ID)
    return joined.groupBy("cluster").agg(F.count("*").alias("n_customers"), F.avg(config.LABEL).alias("churn_rate"))


def churn_gap(rates: DataFrame) -> DataFrame:
    return rates.agg((F.max("churn_rate") - F.min("churn_rate")).alias("churn_gap"))


def segment_synthesis(segments: DataFrame, labels: DataFrame, features: DataFrame) -> DataFrame:
    """Churn rate and mean R/F/M per segment; customers without a label are marked -1 and left out."""
    joined = segments.select(config.ID, "cluster").join(labels, config.ID, "left").join(features, config.ID, "left")
    marked = joined.withColumn(config.LABEL, F.coalesce(config.LABEL, F.lit(-1))).filter(F.col(config.LABEL) >= 0)
    return marked.groupBy("cluster").agg(
        F.count("*").alias("n_customers"), F.avg(config.LABEL).alias("churn_rate"), *[F.avg(c).alias(f"{c}_mean") for c in config.RFM]
    )


def flag_anomalies(scores: DataFrame, q: float = config.ANOMALY_QUANTILE, column: str = "reconstruction_error") -> DataFrame:
    """Rows whose score reaches the interpolated quantile."""
    cut = exact_quantiles(scores, {column: [q]})[column][0]
    return scores.filter(F.col(column) >= F.lit(cut))


def anomaly_share(segments: DataFrame, anomalies: DataFrame) -> DataFrame:
    """Percent of each segment's customers that are flagged."""
    flags = anomalies.select(config.ID).distinct().withColumn("flag", F.lit(100.0))
    joined = segments.select(config.ID, "cluster").join(flags, config.ID, "left")
    return joined.groupBy("cluster").agg(F.avg(F.coalesce("flag", F.lit(0.0))).alias("anomaly_pct"))
