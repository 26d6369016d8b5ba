import pytest
from pyspark.sql import functions as F

from custlens import config
from custlens.operators import decisions, quality
from custlens.runtime import materialize
from custlens.sources import runlog


def one(spark, **columns):
    return spark.range(1).select(*[F.lit(v).alias(k) for k, v in columns.items()])


def test_tiers(spark):
    p = spark.createDataFrame([(1.0, "High"), (0.7, "High"), (0.6999, "Medium"), (0.4, "Medium"), (0.3999, "Low"), (0.02, "Low")], "p double, want string")
    assert p.filter(decisions.risk_tier(F.col("p")) != F.col("want")).isEmpty()
    m = spark.createDataFrame([(4.99, "Low"), (5.0, "Medium"), (19.99, "Medium"), (20.0, "High"), (-3.0, "Low")], "m double, want string")
    assert m.filter(decisions.value_tier(F.col("m"), 5.0, 20.0) != F.col("want")).isEmpty()


def test_score_is_the_sum_of_its_points(spark):
    """Every combination of tiers, marks and segment rates on both sides of the two borders."""
    risk, value, rate = {"High": 50, "Medium": 30, "Low": 0}, {"High": 25, "Medium": 10, "Low": 0}, {0.75: 20, 0.7: 20, 0.69: 10, 0.4: 10, 0.39: 0, None: 0}
    assert (config.HIGH_SEGMENT_CHURN, config.MEDIUM_SEGMENT_CHURN) == (0.7, 0.4)
    rows = [(a, b, c, d, e, risk[a] + value[b] + rate[c] + 15 * d + 10 * e) for a in risk for b in value for c in rate for d in (False, True) for e in (False, True)]
    df = spark.createDataFrame(rows, "r string, v string, c double, a boolean, d boolean, want int")
    got = df.withColumn("got", decisions.priority_score(*map(F.col, "rvcad")))
    assert got.filter("got <> want").isEmpty() and got.agg(F.max("got")).first()[0] == 120


def test_first_rule_names_action_reason_and_offer(spark):
    """An independent reading of the rule list, over all 36 combinations and both sides of the segment border."""
    def want(r, v, anomaly, dormant, rate):
        if r == "High":
            action, offer = (decisions.RETAIN, 0) if v == "High" else (decisions.WIN_BACK, 1)
        elif r == "Low" and v == "High":
            action, offer = decisions.VIP, 2
        else:
            action, offer = decisions.REVIEW if anomaly else decisions.REACTIVATE if dormant else decisions.MONITOR, 3
        reason = decisions.REASONS[action]
        if action == decisions.REACTIVATE and rate >= 0.7:
            reason += decisions.HIGH_SEGMENT_SUFFIX
        if anomaly and action != decisions.REVIEW:
            reason += decisions.ANOMALY_SUFFIX
        return action, reason, decisions.OFFERS[offer]

    tiers = ("Low", "Medium", "High")
    rows = [(r, v, a, d, c, *want(r, v, a, d, c)) for r in tiers for v in tiers for a in (False, True) for d in (False, True) for c in (0.69, 0.7)]
    df = spark.createDataFrame(rows, "r string, v string, a boolean, d boolean, c double, action string, reason string, offer string")
    got = df.withColumn("act", decisions.recommended_action(*map(F.col, "rvad"))).withColumn("why", decisions.action_reason(F.col("act"), F.col("c"), F.col("a")))
    assert got.filter((F.col("act") != F.col("action")) | (F.col("why") != F.col("reason")) | (decisions.retention_offer(F.col("r"), F.col("v")) != F.col("offer"))).isEmpty()


@pytest.fixture(scope="module")
def shop(spark):
    """Six customers in two segments: spend 8 .. 600, quartiles 27.5 and 167.5; dormant from Recency 92.5 on."""
    people = [(11, 3, 600.0, 0.10), (12, 120, 200.0, 0.95), (13, 95, 70.0, 0.71), (14, 40, 8.0, 0.40), (15, 85, 60.0, 0.20), (16, 10, 20.0, 0.99)]
    features = spark.createDataFrame(
        [(i, recency, 2, money, money / 2, 3.0, 4, "Norway") for i, recency, money, _ in people],
        "CustomerID bigint, Recency int, Frequency bigint, Monetary double, avg_basket_value double, avg_basket_size double, unique_products bigint, DominantCountry string")
    p = spark.createDataFrame([(i, x) for i, _, _, x in people], "CustomerID bigint, churn_probability double")
    rules = spark.createDataFrame([(4.0, 0.6, 0.2, ["s"], ["t"], "Watering can"), (9.0, 0.4, 0.1, ["u"], ["v"], "Seed tray")], "lift double, confidence double, support double, antecedents array<string>, consequents array<string>, consequents_desc string")
    return dict(
        features=features, scores=decisions.churn_scores(p, "forest"), labels=spark.createDataFrame([(i, int(x > 0.5)) for i, _, _, x in people], "CustomerID bigint, churn int"),
        segments=spark.createDataFrame([(i, i % 2) for i, *_ in people], "CustomerID bigint, cluster int"),
        segment_rates=spark.createDataFrame([(0, 0.72), (1, 0.3)], "cluster int, churn_rate double"),
        anomalies=spark.createDataFrame([(15, 3.5)], "CustomerID bigint, reconstruction_error double").withColumn("anomaly_flag", F.lit(True)), rules=rules, source_run="run-7",
    )


def test_six_customer_table(spark, shop):
    table = materialize(decisions.decision_table(**{**shop, "anomalies": spark.createDataFrame([], "CustomerID bigint, reconstruction_error double")}))
    assert table.columns == decisions.TABLE_COLUMNS
    rows = table.orderBy("priority_rank").collect()
    got = [(r["CustomerID"], r["churn_risk_tier"], r["customer_value_tier"], r["priority_score"], r["recommended_action"], r["next_best_offer"]) for r in rows]
    # 12: 50 + 25 + 20 + 10; 16: 50 + 0 + 20; 13: 50 + 10 + 0 + 10; 14: 30 + 0 + 20; 11: 25; 15: 10
    assert got == [
        (12, "High", "High", 105, decisions.RETAIN, ""), (13, "High", "Medium", 70, decisions.WIN_BACK, ""), (16, "High", "Low", 70, decisions.WIN_BACK, ""),
        (14, "Medium", "Low", 50, decisions.MONITOR, ""), (11, "Low", "High", 25, decisions.VIP, "Seed tray"), (15, "Low", "Medium", 10, decisions.MONITOR, ""),
    ]
    summary = decisions.decision_summary(table).collect()
    assert sum(r["n_customers"] for r in summary) == 6
    checks = quality.decisions_sound(table, shop["features"], decisions.top_priority(table))
    assert all(r["passed"] for r in checks.collect()) and quality.exit_code(checks) == 0
    broken = quality.decisions_sound(table.unionByName(table), shop["features"], decisions.top_priority(table))
    assert quality.exit_code(broken) == 1


def test_null_segment_is_kept_and_fan_out_raises(spark, shop):
    some = shop["segments"].filter("CustomerID > 11")
    table = decisions.decision_table(**{**shop, "segments": some})
    row = table.filter("CustomerID = 11").first()
    assert row["segment"] is None and row["segment_churn_rate"] == 0.0
    assert decisions.decision_summary(table).filter("segment is null").first()["n_customers"] == 1
    with pytest.raises(ValueError):
        decisions.decision_table(**{**shop, "segments": some.unionByName(some)})


def test_train_mark(shop):
    ids = shop["features"].select("CustomerID").filter("CustomerID <= 12")
    got = decisions.decision_table(**shop, train_ids=ids)
    assert {r["CustomerID"] for r in got.filter("is_train").collect()} == {11, 12}


def test_checks_find_faults(spark, shop):
    features, labels = shop["features"], shop["labels"]
    assert quality.same_customers(features, labels).first()["passed"]
    assert not quality.same_customers(features, labels.filter("CustomerID < 16")).first()["passed"]
    assert not quality.recency_not_negative(features.withColumn("Recency", F.lit(-1))).first()["passed"]
    assert not quality.no_missing(features.withColumn("Monetary", F.lit(None)), "f").first()["passed"]
    assert not quality.columns_present(spark, {"churn_labels": labels.drop("churn")}).first()["passed"]
    assert not quality.tables_exist(spark, {"x": "/tmp/absent-custlens-table"}).first()["passed"]
    board = spark.createDataFrame([(0.97,), (0.7,)], "AUC double")
    assert not quality.auc_realistic(board).first()["passed"] and quality.auc_realistic(board.filter("AUC < 0.9")).first()["passed"]


def test_run_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    assert runlog.manifest(runlog.read_log(spark, path)) == {}
    runlog.log_metrics(spark, path, {"n_clean_rows": 1, "x": "a"})
    runlog.log_metrics(spark, path, {"n_clean_rows": 2})
    got = runlog.manifest(runlog.read_log(spark, path))
    assert got["n_clean_rows"] == "2" and got["x"] == "a" and got["seed"] == str(config.SEED)
    checks = quality.log_as_configured(runlog.latest(runlog.read_log(spark, path)), {"seed": 42, "churn_cutoff": "2011-09-01"})
    assert all(r["passed"] for r in checks.collect())


def test_snapshot(spark, tmp_path):
    path = f"{tmp_path}/log"
    runlog.log_metrics(spark, path, {"churn_gap_between_segments": 0.673, "n_clean_rows": 10})
    m = "AUC double, F1 double, Precision double, Recall double, Accuracy double"
    board = spark.createDataFrame([("LogisticRegression", 0.8, 0.785, 0.7, 0.7, 0.7, 0.7), ("KNN", 0.7, 0.76, 0.7, 0.7, 0.7, 0.7)], f"Model string, CV_AUC_mean double, {m}")
    base = spark.createDataFrame([("MajorityClass", 0.5), ("RecencyOnly_LR", 0.75), ("LR_without_Recency", 0.7)], "Baseline string, AUC double")
    nets = spark.createDataFrame([("MLP", 0.78, 0.73), ("LogisticRegression", 0.785, 0.74)], "Model string, AUC double, F1 double")
    calibration = spark.createDataFrame([(0.19,)], "brier_score double")
    stability = spark.createDataFrame([(0, 0.4), (1, 0.4), (None, 0.9)], "seed int, silhouette double")
    rules = spark.createDataFrame([(26.7,), (3.0,)], "lift double")
    s = runlog.snapshot(runlog.read_log(spark, path), board, base, nets, calibration, stability, rules).first()
    assert (s["best_model"], s["best_auc"], s["mlp_auc"], s["majority_auc"]) == ("LogisticRegression", 0.785, 0.78, 0.5)
    assert s["clustering_silhouette_std"] == 0 and s["top_rule_lift"] == 26.7 and s["churn_gap_between_segments"] == "0.673"
