import random
from unittest import mock

import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.functions.strata import hash_strata, seeded_hash
from custlens.operators import scoring, splits


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    rows = [(int(rng.random() < 0.4), round(rng.random(), 2) if i % 3 else 0.5) for i in range(900)]
    return rows, spark.createDataFrame([(y, s, int(s >= 0.5)) for y, s in rows], "label int, score double, pred int").repartition(5)


def brute_auc(rows):
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_auc_and_curve_in_one_or_many_ranges(scored):
    rows, df = scored
    assert scoring.roc_auc(df).first()[0] == pytest.approx(brute_auc(rows))
    one = sorted(map(tuple, scoring.roc_points(df).select("fpr", "tpr").collect()))
    with mock.patch.object(scoring, "ROWS_PER_BUCKET", 10):
        assert scoring.roc_auc(df).first()[0] == pytest.approx(brute_auc(rows))
        many = sorted(map(tuple, scoring.roc_points(df).select("fpr", "tpr").collect()))
    assert np.allclose(one, many) and one[0] == (0, 0) and one[-1] == (1, 1)


def test_metrics(scored):
    rows, df = scored
    tp = sum(y and s >= 0.5 for y, s in rows)
    m = scoring.classification_metrics(df).first()
    assert m["Precision"] == pytest.approx(tp / sum(s >= 0.5 for _, s in rows))
    assert m["Recall"] == pytest.approx(tp / sum(y for y, _ in rows))
    none = df.withColumn("pred", F.lit(0))
    assert scoring.classification_metrics(none).first()["Precision"] == 0 and scoring.confusion_matrix(none).count() == 4


def test_calibration(scored):
    rows, df = scored
    edges = np.quantile([s for _, s in rows], [i / 10 for i in range(1, 10)])
    places = np.searchsorted(edges, [s for _, s in rows], side="left")
    want = [np.mean([y for (y, _), p in zip(rows, places) if p == b]) for b in sorted(set(places))]
    got = scoring.reliability_curve(df).orderBy("bin").collect()
    assert [r["bin"] for r in got] == list(range(1, len(want) + 1))
    assert [r["fraction_positive"] for r in got] == pytest.approx(want)
    report = scoring.calibration_report(df, "m").first()
    assert report["brier_score"] == pytest.approx(np.mean([(s - y) ** 2 for y, s in rows]))
    again = scoring.recalibrate(df, df)
    assert scoring.brier(again).first()[0] <= report["brier_score"]


def test_split_is_stratified_and_stable(spark):
    df = spark.range(1000).select(F.col("id").alias("CustomerID"), (F.col("id") % 3 == 0).cast("int").alias("churn"))
    a = splits.train_test(df)
    sizes = {(r["churn"], r["is_train"]): r["count"] for r in a.groupBy("churn", "is_train").count().collect()}
    assert sizes == {(0, True): 532, (0, False): 134, (1, True): 267, (1, False): 67}
    b = splits.train_test(df.repartition(9))
    assert a.exceptAll(b).isEmpty()
    ordered = df.withColumn("h", seeded_hash(42, "CustomerID"))
    low = {r[0] for r in ordered.filter("churn = 1").orderBy("h", "CustomerID").limit(267).select("CustomerID").collect()}
    assert {r[0] for r in a.filter("churn = 1 and is_train").select("CustomerID").collect()} == low
    folds = [r["count"] for r in splits.folds(df).groupBy("churn", "fold").count().collect()]
    assert len(folds) == 10 and max(folds) - min(folds) <= 67 + 1
    three = hash_strata(df, "CustomerID", "churn", [0.0, 1.0], 1, "s")
    assert {r[0] for r in three.select("s").distinct().collect()} == {1}
