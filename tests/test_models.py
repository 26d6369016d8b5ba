import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.operators import attribution, cluster_metrics, decisions, models, smote
from custlens.operators.splits import train_test
from custlens.runtime import materialize
from custlens.sources import model_store

QUICK = {
    "LogisticRegression": {"C": 1.0}, "DecisionTree": {"max_depth": 4, "min_leaf": 5}, "RandomForest": {"trees": 10, "max_depth": 5},
    "KNN": {"k": 5}, "SVM": {"C": 1.0}, "NaiveBayes": {},
}


@pytest.fixture(scope="module")
def trained(supervised):
    split = materialize(train_test(supervised))
    data = models.prepare(split.filter("is_train"))
    return split, data, {n: models.fit(n, p, data) for n, p in QUICK.items()}


def test_six_models_beat_the_majority(trained):
    split, _, fitted = trained
    test = split.filter("not is_train")
    table = models.comparison({n: materialize(m.scored(test)) for n, m in fitted.items()}).collect()
    assert len(table) == 6
    for r in table:
        assert all(0 <= r[c] <= 1 for c in ("AUC", "F1", "Precision", "Recall", "Accuracy"))
        assert r["AUC"] > 0.6, r


def test_saved_pipeline_scores_the_same(spark, trained, tmp_path):
    split, _, fitted = trained
    for name in ("LogisticRegression", "SVM"):
        model_store.save_model(fitted[name].pipeline, str(tmp_path), name)
        back = model_store.load_model(str(tmp_path), name)
        a = decisions.score_customers(split, fitted[name].pipeline, name).orderBy("CustomerID").toPandas()
        b = decisions.score_customers(split, back, name).orderBy("CustomerID").toPandas()
        assert np.allclose(a["churn_probability"], b["churn_probability"]) and (a["scored_model"] == name).all()
    assert model_store.list_models(spark, str(tmp_path)) == ["LogisticRegression", "SVM"]
    with pytest.raises(TypeError):
        decisions.score_customers(split, fitted["LogisticRegression"].encoder, "x")


def test_trees_read_off_at_a_depth_are_the_trees_fitted_with_it(spark, trained):
    split, data, _ = trained
    held = data.encoder.transform(split.filter("not is_train"))
    for leaf in (1, 5):
        deep = models.fit("DecisionTree", {"max_depth": None, "min_leaf": leaf}, data).classifier
        nodes = models.tree_nodes(deep, spark)
        for depth in (2, 6, 30):
            fitted = models.fit("DecisionTree", {"max_depth": depth, "min_leaf": leaf}, data).classifier
            a, b = (m.transform(held).orderBy("CustomerID").select(models.positive_score().alias("p")).toPandas()["p"] for m in (models.CutTrees(nodes, depth), fitted))
            assert np.allclose(a, b)
    forest = models.fit("RandomForest", {"trees": 8, "max_depth": None}, data).classifier
    whole = models.CutTrees(models.tree_nodes(forest, spark), 30)
    a, b = (m.transform(held).orderBy("CustomerID").select(models.positive_score().alias("p")).toPandas()["p"] for m in (whole, forest))
    assert np.allclose(a, b)


def test_shared_fits_score_as_single_ones(trained):
    split, data, _ = trained
    held = split.filter("not is_train")
    candidates = [("KNN", {"k": 5}), ("DecisionTree", {"max_depth": 3}), ("KNN", {"k": 21}), ("DecisionTree", {"max_depth": None}), ("NaiveBayes", {}), ("DecisionTree", {"max_depth": 3, "min_leaf": 5})]
    groups = models._together(candidates)
    assert sorted(map(sorted, groups)) == [[0, 2], [1, 3], [4], [5]]
    for g in groups:
        each = [models.auc(models.fit(*candidates[i], data), held) for i in g]
        assert models._scores_of_group([candidates[i] for i in g], data, held, 42) == pytest.approx(each, abs=1e-9)


def test_logistic_penalty(spark, trained):
    """At the optimum the gradient of loss * C + |w|^2 / 2 is zero."""
    _, data, fitted = trained
    clf = fitted["LogisticRegression"].classifier
    rows = data.rows.toPandas()
    x, y = np.vstack([v.toArray() for v in rows["features"]]), rows["label"].to_numpy()
    w = clf.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ w + clf.intercept)))
    assert np.abs(w + x.T @ (p - y)).max() < 0.05


def test_smote_balance_and_convexity(spark):
    rng = np.random.default_rng(3)
    p = np.round(rng.normal(size=(90, 2)), 2)
    p[:10] = p[0]
    labels = [1] * 30 + [0] * 60
    df = spark.createDataFrame([(i, labels[i], [float(v) for v in p[i]]) for i in range(90)], "id bigint, label int, x array<double>")
    out = smote.smote(df, k=3).toPandas()
    assert out["label"].value_counts().to_dict() == {0: 60, 1: 60}
    minority = p[:30]
    new = [np.array(v) for v in out[out["label"] == 1]["x"] if not (np.abs(minority - np.array(v)).sum(1) < 1e-12).any()]
    for v in new:
        on = False
        for a in range(30):
            d = np.sqrt(((minority - minority[a]) ** 2).sum(1))
            for b in np.argsort(d, kind="stable")[:14]:
                ab, av = minority[b] - minority[a], v - minority[a]
                if abs(ab[0] * av[1] - ab[1] * av[0]) < 1e-9 and -1e-9 <= av @ ab <= ab @ ab + 1e-9:
                    on = True
        assert on
    again = smote.smote(df.repartition(5), k=3).toPandas()
    key = lambda d: sorted((r.label, *np.round(r.x, 9)) for r in d.itertuples())
    assert key(out) == key(again)


def test_smote_searches_neighbours_of_giving_rows_only(spark, monkeypatch):
    """60 and 63 rows: three rows give a new one, so three points are looked up; the new rows are those of a search for all."""
    rng = np.random.default_rng(5)
    p = np.round(rng.normal(size=(123, 2)), 3)
    df = materialize(spark.createDataFrame([(i, int(i < 60), [float(v) for v in p[i]]) for i in range(123)], "id bigint, label int, x array<double>"))
    asked, search = [], smote.nearest

    def counted(query, train, k):
        asked.append(query.count())
        return search(query, train, k)

    monkeypatch.setattr(smote, "nearest", counted)
    born = smote.new_rows(df, k=5).collect()
    assert asked == [3] and len(born) == 3
    for r in born:
        near = sorted((((p[r["id"]] - p[j]) ** 2).sum(), j) for j in range(60))[1:6]
        assert r["neighbour"] in [j for _, j in near]
        assert np.allclose(r["x"], p[r["id"]] + (p[r["neighbour"]] - p[r["id"]]) * r["u"])


def test_short_search(supervised):
    board, fitted, split = models.train_classical(supervised, {"LogisticRegression": [{"C": 0.1}, {"C": 10.0}], "NaiveBayes": [{}]}, k=3)
    rows = board.collect()
    assert {r["Model"] for r in rows} == {"LogisticRegression", "NaiveBayes"} == set(fitted)
    assert [r["AUC"] for r in rows] == sorted((r["AUC"] for r in rows), reverse=True) and all(0.6 < r["CV_AUC_mean"] <= 1 for r in rows)
    base = {r["Baseline"]: r for r in models.baselines(split, trees=10).collect()}
    assert base["MajorityClass"]["AUC"] == pytest.approx(0.5) and base["RecencyOnly_LR"]["AUC"] > 0.7


def test_network(supervised):
    model, tried = models.train_network(supervised, hidden=(8, 4), steps=(5, 40))
    assert tried.count() == 2
    p = [r["score"] for r in model.scored(supervised).collect()]
    assert len(p) == 260 and all(0 <= v <= 1 for v in p) and models.auc(model, supervised) > 0.7


def test_shapley_adds_up_and_matches_a_linear_model(spark, trained):
    split, _, fitted = trained
    model = fitted["LogisticRegression"]
    explain, background = split.filter("not is_train"), split.filter("is_train").limit(1)
    values = materialize(attribution.shapley_values(model, explain, background, orders=2))
    total = {r["CustomerID"]: r["t"] for r in values.groupBy("CustomerID").agg(F.sum("value").alias("t")).collect()}
    assert len(total) == explain.count()
    base = model.scored(background).first()["score"]
    for r in model.scored(explain.filter(F.col("CustomerID").isin(list(total)))).collect():
        assert total[r["CustomerID"]] == pytest.approx(r["score"] - base, abs=1e-9)
    top = attribution.ranked(values).first()["feature"]
    assert top == "Recency"
    assert cluster_metrics is not None


def test_a_lone_fit_uses_several_tasks(spark):
    """10,000 rows are three tasks of a network or shallow forest that is fitted alone; few rows stay one task."""
    rows = spark.range(10_000)
    assert models.Prepared(None, rows, rows, 10_000, 1).spread().rdd.getNumPartitions() == 3
    assert models.Prepared(None, rows, rows, 4096, 1).spread().rdd.getNumPartitions() == 1
    assert models.Prepared(None, rows, rows, 72_864, 1).spread().rdd.getNumPartitions() == models.LONE_TASKS
    assert models.Prepared(None, rows, rows, 6_000_000, 1).spread().rdd.getNumPartitions() == 120
