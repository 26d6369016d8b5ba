import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.sql import functions as F

from custlens.operators import forest, models
from custlens.operators.splits import train_test
from custlens.runtime import materialize


@pytest.fixture(scope="module")
def prepared(supervised):
    split = materialize(train_test(supervised))
    return split, models.prepare(split.filter("is_train"))


def gini(y, w):
    return sum((w * (y == c)).sum() ** 2 for c in (0, 1)) / w.sum()


def test_a_tree_takes_the_best_split_of_each_node():
    rng = np.random.default_rng(4)
    codes, y, w = rng.integers(0, 6, (80, 3)).astype(np.uint8), rng.integers(0, 2, 80), rng.integers(1, 4, 80)
    t = forest.grow(codes, w, y, 3, 4, 30, np.random.default_rng(0))
    reached = [np.arange(80)] + [None] * (len(t["feature"]) - 1)
    for i in range(len(t["feature"])):
        rows = reached[i]
        assert (t["n0"][i], t["n1"][i]) == ((w * (y == 0))[rows].sum(), (w * (y == 1))[rows].sum())
        best = 0.0
        for f in range(3):
            for c in range(5):
                left = codes[rows, f] <= c
                a, b = rows[left], rows[~left]
                if min(w[a].sum(), w[b].sum()) >= 4:
                    best = max(best, gini(y[a], w[a]) + gini(y[b], w[b]) - gini(y[rows], w[rows]))
        if t["feature"][i] < 0:
            assert best < 1e-9
            continue
        left = codes[rows, t["feature"][i]] <= t["cut"][i]
        a, b = rows[left], rows[~left]
        assert gini(y[a], w[a]) + gini(y[b], w[b]) - gini(y[rows], w[rows]) == pytest.approx(best)
        reached[t["left"][i]], reached[t["right"][i]] = a, b
    pure = forest.grow(codes, w, y, 3, 1, 30, np.random.default_rng(0))
    whole = {tuple(c) for c in codes}
    assert len(pure["feature"]) > len(t["feature"]) and len(whole) > 10


@pytest.mark.parametrize("most", [40, 1 << 15])
def test_deep_forests_grow_in_bounded_groups(spark, prepared, monkeypatch, tmp_path, most):
    """No task has more than GROUP_ROWS rows of a tree, no row of a bag is lost, and the forest scores as MLlib's does."""
    monkeypatch.setattr(forest, "GROUP_ROWS", most)
    split, data = prepared
    model = models.fit("RandomForest", {"trees": 40, "max_depth": None}, data)
    grown = model.classifier
    assert isinstance(grown, forest.GrownForest)
    drawn = {t: forest._bag(np.arange(1, data.n + 1), t, 42) for t in range(40)}
    sizes = grown.trees.select("tree", "node", (F.col("n0")[0] + F.col("n1")[0]).alias("n")).collect()
    assert all(r["n"] <= 7 * most for r in sizes) and (len(sizes) > 80) == (most == 40)
    nodes = grown.nodes()
    for t, tree in nodes.groupby("tree"):
        leaves = np.vstack(tree["votes"])[tree["feature"].to_numpy() < 0]
        assert leaves.sum() == drawn[t].sum()
    held = materialize(model.encoder.transform(split.filter("not is_train")))
    for depth in (3, 30):
        cut = models.CutTrees(nodes, depth).transform(held).orderBy("CustomerID").select(models.positive_score().alias("p")).toPandas()["p"]
        coded = grown.coded(held)
        own = coded.join(grown.scores(coded, [depth]), "_codes").orderBy("CustomerID").toPandas()["s0"]
        # a group merges its own leaves only
        assert np.allclose(cut, own, atol=0.05 if most == 40 else 1e-12)
    plain = RandomForestClassifier(numTrees=40, maxDepth=30, maxBins=64, seed=1).fit(data.rows)
    a, b = (m.transform(held).orderBy("CustomerID").select(models.positive_score().alias("p")).toPandas()["p"] for m in (grown, plain))
    assert np.corrcoef(a, b)[0, 1] > 0.9
    model.pipeline.write().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m")).transform(split.filter("not is_train")).orderBy("CustomerID").select(models.positive_score().alias("p")).toPandas()["p"]
    assert np.allclose(a, back)


def test_partitions_change_no_tree(prepared):
    _, data = prepared
    a, b = (forest.fit_forest(rows, data.n, data.d, 5, 30, 1, 7).nodes() for rows in (data.rows, data.rows.repartition(5)))
    assert a["feature"].tolist() == b["feature"].tolist() and a["cut"].tolist() == b["cut"].tolist()


def test_shared_forests_score_as_cut_ones(prepared):
    split, data = prepared
    held = split.filter("not is_train")
    group = [("RandomForest", {"trees": 20, "max_depth": None}), ("RandomForest", {"trees": 20, "max_depth": 3})]
    deep, shallow = models._scores_of_group(group, data, held, 42)
    nodes = models.fit(*group[0], data).classifier.nodes()
    coded = data.encoder.transform(held)
    for depth, found in ((30, deep), (3, shallow)):
        scored = models.CutTrees(nodes, depth).transform(coded).select(models.positive_score().alias("score"), F.col("churn").cast("double").alias("label"))
        assert found == pytest.approx(models._auc_of(scored))


def test_best_cuts_by_counts_and_by_sorts_agree():
    """Few nodes are cut by counts of all their bins, many by small sorts of the rows; both equal a plain search."""
    rng = np.random.default_rng(4)
    n, m, bins = 400, 3, 12
    cells, local, label = rng.integers(0, bins, (m, n)).astype(np.uint8), rng.integers(0, 9, n), rng.integers(0, 2, n)
    weight = rng.integers(1, 4, n)
    t = np.stack([np.bincount(local, weight * (label == c), 9) for c in (0, 1)])
    both = weight << np.where(label == 1, forest.HALF, 0)
    dense = forest._cuts(cells, local, both, t, 5, bins)
    sparse = forest._cuts(cells, local, both, t, 5, 1 << 20)  # so many bins that none of their counts are held
    assert all(np.array_equal(a, b) for a, b in zip(dense, sparse))
    for node in range(9):
        best = (-np.inf, 0, 0)
        for f in range(m):
            for b in range(bins):
                l = [(weight * (label == c) * (local == node) * (cells[f] <= b)).sum() for c in (0, 1)]
                r = [t[c, node] - l[c] for c in (0, 1)]
                if min(sum(l), sum(r)) >= 5:
                    gain = sum(v * v for v in l) / sum(l) + sum(v * v for v in r) / sum(r) - (t[:, node] ** 2).sum() / t[:, node].sum()
                    if gain > best[0]:
                        best = (gain, f, b)
        assert (dense[2][node], dense[0][node], dense[1][node]) == pytest.approx(best)
