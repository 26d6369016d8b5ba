"""Churn models: one interface over MLlib classifiers and neighbour voting, with encoding and oversampling inside."""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Model, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.operators import neighbours, scoring
from custlens.operators.encoding import ChurnEncoder, ChurnEncoderModel
from custlens.operators.forest import GrownForest, fit_forest
from custlens.operators.neighbours import knn_scores
from custlens.operators.smote import smote
from custlens.operators.splits import folds, train_test, train_valid_test
from custlens.runtime import materialize, shared_folder

# Model families and their search grids.
GRIDS: dict[str, list[dict]] = {
    "LogisticRegression": [{"C": 0.1}, {"C": 1.0}, {"C": 10.0}],
    "DecisionTree": [{"max_depth": d, "min_leaf": m} for d in (None, 6, 12) for m in (1, 5)],
    "RandomForest": [{"trees": 200, "max_depth": d, "min_leaf": m} for d in (None, 10) for m in (1, 5)],
    "KNN": [{"k": 5}, {"k": 11}, {"k": 21}],
    "SVM": [{"C": 1.0}, {"C": 10.0}],
    "NaiveBayes": [{}],
}
DEEPEST = 30
FOURIER_FEATURES = 128
ROWS_PER_PARTITION = 50_000
# A fit that runs alone deals a small table to more tasks: rows that a task has at least, and tasks.
LEAST_ROWS = 4096
LONE_TASKS = 12
# Node statistics that a forest may gather in one pass.
FOREST_MB = 1024


class RandomFourierFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Maps `features` to cosines whose inner products approximate the RBF kernel exp(-gamma |x - y|^2)."""

    gamma = Param(Params._dummy(), "gamma", "kernel width", TypeConverters.toFloat)
    inputSize = Param(Params._dummy(), "inputSize", "input dimension", TypeConverters.toInt)
    outputSize = Param(Params._dummy(), "outputSize", "number of cosines", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed of the projection", TypeConverters.toInt)

    @keyword_only
    def __init__(self, gamma=1.0, inputSize=1, outputSize=FOURIER_FEATURES, seed=config.SEED):
        super().__init__()
        self._setDefault(gamma=1.0, inputSize=1, outputSize=FOURIER_FEATURES, seed=config.SEED)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        rng = np.random.default_rng(self.getOrDefault(self.seed))
        size = self.getOrDefault(self.outputSize)
        w = rng.normal(scale=math.sqrt(2 * self.getOrDefault(self.gamma)), size=(self.getOrDefault(self.inputSize), size))
        b = rng.uniform(0, 2 * math.pi, size)

        @F.pandas_udf("array<double>")
        def project(x: pd.Series) -> pd.Series:
            if len(x) == 0:
                return pd.Series([], dtype=object)
            return pd.Series(list(np.sqrt(2.0 / size) * np.cos(np.vstack(x) @ w + b)))

        return df.withColumn("fourier", array_to_vector(project(vector_to_array("features"))))


class KnnModel:
    """Neighbour voting: the model is the training table, and scoring is a neighbour join."""

    def __init__(self, train: DataFrame, k: int):
        self.train, self.k = train, k

    def transform(self, df: DataFrame) -> DataFrame:
        points = df.select(F.col(config.ID).alias("id"), vector_to_array("features").alias("x"))
        scores = knn_scores(self.train, points, self.k).select(F.col("id").alias(config.ID), "score")
        p = F.col("score")
        return df.join(scores, config.ID).withColumn("probability", array_to_vector(F.array(1 - p, p))).drop("score")


class CutTrees:
    """Trees of one fit, read off at a smaller depth: a node at `max_depth` votes as if it were a leaf.

    MLlib grows trees level by level, and a split does not depend on the depth allowed, so a decision tree read off at a
    depth is the tree fitted with it; for a forest it is one of equal distribution. As in MLlib, two leaves of one parent with
    the same vote are merged. The trees are arrays of their nodes, a model that the driver holds anyway.
    """

    def __init__(self, nodes: pd.DataFrame, max_depth: int) -> None:
        self.trees = [_cut(tree, max_depth) for _, tree in nodes.groupby("tree")]

    def transform(self, df: DataFrame) -> DataFrame:
        trees = self.trees

        @F.pandas_udf("double")
        def vote(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            rows = np.vstack(x)
            total = np.zeros(len(rows))
            for feature, cut, left, right, share in trees:
                node = np.zeros(len(rows), np.int64)
                while (live := np.flatnonzero(feature[node] >= 0)).size:
                    at = node[live]
                    node[live] = np.where(rows[live, feature[at]] <= cut[at], left[at], right[at])
                total += share[node]
            return pd.Series(total / len(trees))

        p = F.col("_vote")
        return df.withColumn("_vote", vote(vector_to_array("features"))).withColumn("probability", array_to_vector(F.array(1 - p, p))).drop("_vote")


def tree_nodes(model: Model, spark) -> pd.DataFrame:
    """Nodes of all trees of a fitted model, as its stored form lists them, parents first."""
    if isinstance(model, GrownForest):
        return model.nodes()
    folder = f"{shared_folder(spark)}/custlens/{uuid.uuid4().hex}"
    model.write().save(folder)
    stored = spark.read.parquet(f"{folder}/data")
    nodes = stored.select("treeID", "nodeData.*") if "nodeData" in stored.columns else stored.withColumn("treeID", F.lit(0))
    columns = [F.col("treeID").alias("tree"), "id", "prediction", F.col("impurityStats").alias("votes"), F.col("leftChild").alias("left"), F.col("rightChild").alias("right"),
               F.col("split.featureIndex").alias("feature"), F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("cut")]
    return nodes.select(*columns).toPandas().sort_values(["tree", "id"])


def _cut(tree: pd.DataFrame, max_depth: int) -> tuple[np.ndarray, ...]:
    """Feature (-1: a leaf), cut, children and share of positive rows per node, down to `max_depth`."""
    left, right, feature, vote = (tree[c].to_numpy().copy() for c in ("left", "right", "feature", "prediction"))
    votes = np.vstack(tree["votes"])
    depth = np.zeros(len(tree), np.int64)
    for i in np.flatnonzero(left >= 0):
        depth[[left[i], right[i]]] = depth[i] + 1
    feature[(left < 0) | (depth >= max_depth)] = -1
    for i in np.flatnonzero(feature >= 0)[::-1]:  # children stand behind their parent
        a, b = left[i], right[i]
        if feature[a] < 0 and feature[b] < 0 and vote[a] == vote[b]:
            feature[i] = -1
    return feature, tree["cut"].fillna(0.0).to_numpy(), left, right, votes[:, 1] / votes.sum(axis=1)


@dataclass
class FittedModel:
    """Encoder and classifier; `pipeline` is the savable form (None for neighbour voting)."""

    name: str
    encoder: ChurnEncoderModel
    classifier: Model | KnnModel | PipelineModel
    params: Mapping = field(default_factory=dict)

    @property
    def pipeline(self) -> PipelineModel | None:
        return None if isinstance(self.classifier, KnnModel) else PipelineModel([self.encoder, self.classifier])

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(self.encoder.transform(df))

    def scored(self, df: DataFrame) -> DataFrame:
        """(CustomerID, label, score, pred) of labelled rows."""
        return self.transform(df).select(
            config.ID, F.col(config.LABEL).alias("label"), positive_score().alias("score"),
            (positive_score() >= 0.5).cast("int").alias("pred"),
        )

    def metadata(self) -> dict[str, object]:
        return {"model": self.name, "params": json.dumps(dict(self.params)), "threshold": 0.5, **{k: json.dumps(v) for k, v in self.encoder.fitted.items()}}


def positive_score(columns: Sequence[str] = ("probability",)):
    """Probability of the positive class where there is one, else the margin."""
    source = "probability" if "probability" in columns else "rawPrediction"
    return vector_to_array(source)[1]


@dataclass
class Prepared:
    """A training set ready for any classifier: encoder, oversampled rows (label, features), and the plain encoded points."""

    encoder: ChurnEncoderModel
    rows: DataFrame
    points: DataFrame
    n: int
    d: int

    def spread(self) -> DataFrame:
        """The rows in enough partitions for one fit to use several cores. The number depends on the rows only, as sampled trees do on it."""
        return self.rows.repartition(max(math.ceil(self.n / ROWS_PER_PARTITION), min(LONE_TASKS, math.ceil(self.n / LEAST_ROWS)))).persist(StorageLevel.MEMORY_AND_DISK)

    def release(self) -> None:
        self.rows.unpersist()


def prepare(train: DataFrame, columns: Sequence[str] | None = None, oversample: bool = True, seed: int = config.SEED, rare_share: float = config.RARE_COUNTRY) -> Prepared:
    """Fit the encoder on the training rows and oversample after encoding. Shared by all candidates of a fold."""
    encoder = ChurnEncoder(columns=list(columns) if columns else None, rareShare=rare_share).fit(train)
    coded = encoder.transform(train).select(F.col(config.ID).alias("id"), F.col(config.LABEL).alias("label"), vector_to_array("features").alias("x"))
    points = materialize(coded)
    rows = smote(points, seed=seed) if oversample else points.select("label", "x")
    rows = materialize(rows.select(F.col("label").cast("double").alias("label"), array_to_vector("x").alias("features")))
    n = rows.count()
    # partitions by size: many small fits run side by side, so a small table is one task of each
    rows = rows.repartition(math.ceil(n / ROWS_PER_PARTITION)).persist(StorageLevel.MEMORY_AND_DISK)
    return Prepared(encoder, rows, points, n, len(encoder.slots))


def fit(name: str, params: Mapping, data: Prepared, seed: int = config.SEED) -> FittedModel:
    """Fit one model family on prepared rows."""
    rows, n = data.rows, data.n
    if name == "LogisticRegression":
        clf = LogisticRegression(regParam=1.0 / (params.get("C", 1.0) * n), elasticNetParam=0.0, standardization=False, maxIter=200).fit(rows)
    elif name == "DecisionTree":
        clf = DecisionTreeClassifier(maxDepth=params.get("max_depth") or DEEPEST, minInstancesPerNode=params.get("min_leaf", 1), maxBins=64, seed=seed).fit(rows)
    elif name == "RandomForest" and not params.get("max_depth"):
        clf = fit_forest(rows, n, data.d, params.get("trees", 200), DEEPEST, params.get("min_leaf", 1), seed)
    elif name == "RandomForest":
        rows = data.spread()
        clf = RandomForestClassifier(
            numTrees=params.get("trees", 200), maxDepth=params["max_depth"], minInstancesPerNode=params.get("min_leaf", 1),
            featureSubsetStrategy="sqrt", maxBins=64, seed=seed, cacheNodeIds=True, maxMemoryInMB=FOREST_MB,
        ).fit(rows)
        rows.unpersist()
    elif name == "NaiveBayes":
        clf = NaiveBayes(modelType="gaussian").fit(rows)
    elif name == "SVM":
        clf = _fit_svm(params.get("C", 1.0), data, seed)
    elif name == "KNN":
        training = rows.select(F.col("label").cast("int").alias("label"), vector_to_array("features").alias("x"))
        training = materialize(training.withColumn("id", F.monotonically_increasing_id()))
        clf = KnnModel(training, params.get("k", 5))
    else:
        raise ValueError(f"unknown model {name}")
    return FittedModel(name, data.encoder, clf, params)


def _fit_svm(c: float, data: Prepared, seed: int) -> PipelineModel:
    """RBF machine as a linear machine over random cosines, with a logistic curve on its margin for probabilities."""
    x = vector_to_array("features")
    spread = data.rows.select(F.explode(x).alias("v")).agg(F.var_pop("v")).first()[0] or 1.0
    fourier = RandomFourierFeatures(gamma=1.0 / (data.d * spread), inputSize=data.d, seed=seed)
    lifted = fourier.transform(data.rows).select("label", "fourier").persist(StorageLevel.MEMORY_AND_DISK)
    svc = LinearSVC(featuresCol="fourier", rawPredictionCol="margin", predictionCol="side", regParam=1.0 / (c * data.n), maxIter=50, standardization=False).fit(lifted)
    margin = VectorAssembler(inputCols=["distance"], outputCol="platt")
    signed = _Margin()
    platt_rows = margin.transform(signed.transform(svc.transform(lifted)))
    platt = LogisticRegression(featuresCol="platt", maxIter=50).fit(platt_rows)
    lifted.unpersist()
    return PipelineModel([fourier, svc, signed, margin, platt])


class _Margin(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Signed distance of the linear machine as a number."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("distance", vector_to_array("margin")[1])


def auc(model: FittedModel, df: DataFrame) -> float:
    """Exact AUC from MLlib's evaluator (no down-sampling of thresholds), for search loops."""
    return _auc_of(model.transform(df).select(positive_score().alias("score"), F.col(config.LABEL).cast("double").alias("label")))


def _auc_of(scored: DataFrame) -> float:
    return BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(scored.select("score", "label"))


def _together(candidates: Sequence[tuple[str, Mapping]]) -> list[list[int]]:
    """Candidates (by number) that share one fit: neighbour votes for any k, trees of equal leaf size for any depth."""
    groups: dict[tuple, list[int]] = {}
    for i, (name, p) in enumerate(candidates):
        shared = {"KNN": "k", "DecisionTree": "max_depth", "RandomForest": "max_depth"}.get(name)
        rest = sorted((k, str(v)) for k, v in p.items() if k != shared)
        groups.setdefault((name, str(rest)) if shared else (name, i), []).append(i)
    return list(groups.values())


def _scores_of_group(group: Sequence[tuple[str, Mapping]], data: Prepared, held: DataFrame, seed: int) -> list[float]:
    """AUC of candidates that share a fit: the deepest trees are grown once, and neighbours are searched once at the largest k."""
    name = group[0][0]
    if len(group) == 1:
        return [auc(fit(name, group[0][1], data, seed), held)]
    if name == "KNN":
        most = max(p.get("k", 5) for _, p in group)
        model = fit(name, {"k": most}, data, seed)
        points = model.encoder.transform(held).select(F.col(config.ID).alias("id"), F.col(config.LABEL).cast("double").alias("label"), vector_to_array("features").alias("x"))
        near = neighbours.nearest(points, model.classifier.train, most)
        votes = near.join(model.classifier.train.select(F.col("id").alias("neighbour"), F.col("label").alias("vote")), "neighbour")
        shares = votes.groupBy("id").agg(*[F.avg(F.when(F.col("place") <= p.get("k", 5), F.col("vote"))).alias(f"s{i}") for i, (_, p) in enumerate(group)])
        scored = materialize(shares.join(points.select("id", "label"), "id"))
        return [_auc_of(scored.select(F.col(f"s{i}").alias("score"), "label")) for i in range(len(group))]
    deepest = max(group, key=lambda c: c[1].get("max_depth") or DEEPEST)
    model = fit(name, deepest[1], data, seed)
    if isinstance(model.classifier, GrownForest):
        coded = materialize(model.classifier.coded(model.encoder.transform(held)).select("_codes", F.col(config.LABEL).cast("double").alias("label")))
        scored = materialize(coded.join(model.classifier.scores(coded, [p.get("max_depth") or DEEPEST for _, p in group]), "_codes"))
        return [_auc_of(scored.select(F.col(f"s{i}").alias("score"), "label")) for i in range(len(group))]
    nodes = tree_nodes(model.classifier, held.sparkSession)
    coded = materialize(model.encoder.transform(held).select("features", F.col(config.LABEL).cast("double").alias("label")))

    def read_off(p: Mapping) -> float:
        depth = p.get("max_depth") or DEEPEST
        trees = model.classifier if depth >= (deepest[1].get("max_depth") or DEEPEST) else CutTrees(nodes, depth)
        return _auc_of(trees.transform(coded).select(positive_score().alias("score"), "label"))

    return [read_off(p) for _, p in group]


def cross_validate(
    train: DataFrame, candidates: Sequence[tuple[str, Mapping]], k: int = 5, columns: Sequence[str] | None = None,
    seed: int = config.SEED, parallelism: int = 4,
) -> list[list[float]]:
    """AUC per candidate and fold. Encoder and oversampling are refitted once per fold and shared by all candidates, and so are fits that differ in depth or k only."""
    folded = materialize(folds(train, k, seed))

    def run(f: int) -> list[float]:
        data = prepare(folded.filter(F.col("fold") != f), columns, seed=seed)
        held = folded.filter(F.col("fold") == f)
        groups = sorted(_together(candidates), key=lambda g: candidates[g[0]][0] != "RandomForest")  # the longest first
        with ThreadPool(min(parallelism, len(groups))) as pool:
            found = pool.map(lambda g: _scores_of_group([candidates[i] for i in g], data, held, seed), groups, 1)
        data.release()
        scores = {i: v for g, values in zip(groups, found) for i, v in zip(g, values)}
        return [scores[i] for i in range(len(candidates))]

    with ThreadPool(min(parallelism, k)) as pool:
        by_fold = pool.map(run, range(k))
    return [list(values) for values in zip(*by_fold)]


LEADERBOARD = "Model string, CV_AUC_mean double, CV_AUC_std double, AUC double, F1 double, Precision double, Recall double, Accuracy double, best_params string"


def train_classical(
    frame: DataFrame, grids: Mapping[str, Sequence[Mapping]] = GRIDS, k: int = 5, columns: Sequence[str] | None = None,
    seed: int = config.SEED, parallelism: int = 4,
) -> tuple[DataFrame, dict[str, FittedModel], DataFrame]:
    """Search each grid by cross-validated AUC, refit the best on the training split, score the hold-out.

    Returns the leaderboard, the fitted models and the split frame. The split is seeded and stored, and
    the hold-out is used for the report only.
    """
    split = materialize(train_test(frame, seed=seed))
    train, test = split.filter("is_train"), split.filter("not is_train")
    candidates = [(name, p) for name, grid in grids.items() for p in grid]
    scores = cross_validate(train, candidates, k, columns, seed, parallelism)
    best: dict[str, tuple[float, float, Mapping]] = {}
    for (name, p), s in zip(candidates, scores):
        mean, std = float(np.mean(s)), float(np.std(s))
        if name not in best or mean > best[name][0]:
            best[name] = (mean, std, p)
    data = prepare(train, columns, seed=seed)

    def finish(name: str):
        model = fit(name, best[name][2], data, seed)
        return name, model, scoring.metric_row(materialize(model.scored(test)))

    with ThreadPool(parallelism) as pool:
        done = pool.map(finish, best)
    data.release()
    rows = [(n, best[n][0], best[n][1], *[m[c] for c in ("AUC", "F1", "Precision", "Recall", "Accuracy")], json.dumps(dict(best[n][2]))) for n, _, m in done]
    board = frame.sparkSession.createDataFrame(rows, LEADERBOARD).orderBy(F.desc("AUC"), "Model")
    return board, {n: m for n, m, _ in done}, split


METRICS = "AUC double, F1 double, Precision double, Recall double, Accuracy double"


def baselines(split: DataFrame, seed: int = config.SEED, trees: int = 200) -> DataFrame:
    """Majority class, Recency alone, everything but Recency, and a forest on everything."""
    train, test = split.filter("is_train"), split.filter("not is_train")
    majority = train.groupBy(config.LABEL).agg(F.count("*").alias("n")).orderBy(F.desc("n"), config.LABEL).first()[0]
    constant = test.select(F.col(config.LABEL).alias("label"), F.lit(float(majority)).alias("score"), F.lit(majority).alias("pred"))
    everything = [*config.NUMERIC, config.COUNTRY]
    rows = [("MajorityClass", 1, scoring.metric_row(constant))]
    def run(spec: tuple) -> tuple:
        name, family, params, columns = spec
        data = prepare(train, columns, seed=seed)
        metrics = scoring.metric_row(materialize(fit(family, params, data, seed).scored(test)))
        data.release()
        return name, len(columns), metrics

    with ThreadPool(3) as pool:
        rows += pool.map(run, [
            ("RecencyOnly_LR", "LogisticRegression", {"C": 1.0}, ["Recency"]),
            ("LR_without_Recency", "LogisticRegression", {"C": 1.0}, everything[1:]),
            ("RandomForest_all", "RandomForest", {"trees": trees}, everything),
        ])
    out = [(n, c, *[m[x] for x in ("AUC", "F1", "Precision", "Recall", "Accuracy")]) for n, c, m in rows]
    return split.sparkSession.createDataFrame(out, f"Baseline string, n_features int, {METRICS}").orderBy(F.desc("AUC"), "Baseline")


def ablation(split: DataFrame, groups: Mapping[str, Sequence[str]] = config.FEATURE_GROUPS, k: int = 5, seed: int = config.SEED, parallelism: int = 3) -> DataFrame:
    """One logistic regression per feature group: cross-validated and hold-out AUC."""
    train, test = split.filter("is_train"), split.filter("not is_train")

    def run(group: tuple[str, Sequence[str]]) -> tuple:
        name, columns = group
        (values,) = cross_validate(train, [("LogisticRegression", {"C": 1.0})], k, columns, seed)
        data = prepare(train, columns, seed=seed)
        test_auc = auc(fit("LogisticRegression", {"C": 1.0}, data, seed), test)
        data.release()
        return name, len(columns), float(np.mean(values)), float(np.std(values)), test_auc

    with ThreadPool(parallelism) as pool:
        rows = pool.map(run, groups.items())
    return split.sparkSession.createDataFrame(rows, "FeatureGroup string, n_features int, CV_AUC_mean double, CV_AUC_std double, Test_AUC double")


def train_network(
    frame: DataFrame, hidden: Sequence[int] = (64, 32, 16), steps: Sequence[int] = (15, 30, 60), seed: int = config.SEED, columns: Sequence[str] | None = None
) -> tuple[FittedModel, DataFrame]:
    """Feed-forward network. Training length is chosen on the validation part; the test part stays unseen.

    Each length goes on from the weights of the one before, so the ladder costs its longest step only. The chosen length is
    then refitted on training and validation part, the rows that the classical models are fitted on. Returns the model and
    one row per length tried (max_iter, valid_auc).
    """
    parts = materialize(train_valid_test(frame, seed=seed))
    data = prepare(parts.filter("part = 0"), columns, seed=seed)
    valid = parts.filter("part = 1")
    rows, tried, weights, done = data.spread(), [], None, 0
    for upto in sorted(steps):
        net = MultilayerPerceptronClassifier(layers=[data.d, *hidden, 2], maxIter=upto - done, seed=seed)
        clf = (net.setInitialWeights(weights) if weights is not None else net).fit(rows)
        tried.append((upto, auc(FittedModel("MLP", data.encoder, clf), valid)))
        weights, done = clf.weights, upto
    rows.unpersist()
    data.release()
    length = max(tried, key=lambda t: (t[1], -t[0]))[0]
    whole = prepare(parts.filter("part < 2"), columns, seed=seed)
    rows = whole.spread()
    clf = MultilayerPerceptronClassifier(layers=[whole.d, *hidden, 2], maxIter=length, seed=seed).fit(rows)
    rows.unpersist()
    whole.release()
    model = FittedModel("MLP", whole.encoder, clf, {"layers": [whole.d, *hidden, 2], "max_iter": length})
    return model, frame.sparkSession.createDataFrame(tried, "max_iter int, valid_auc double")


def comparison(scored: Mapping[str, DataFrame]) -> DataFrame:
    """One metric row per scored model, best first."""
    rows = [(n, *[m[c] for c in ("AUC", "F1", "Precision", "Recall", "Accuracy")]) for n, m in ((n, scoring.metric_row(s)) for n, s in scored.items())]
    spark = next(iter(scored.values())).sparkSession
    return spark.createDataFrame(rows, f"Model string, {METRICS}").orderBy(F.desc("AUC"), "Model")


def forest_importance(model: FittedModel, spark) -> DataFrame:
    values = model.classifier.featureImportances.toArray()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(model.encoder.slots, values)], "feature string, importance double").orderBy(F.desc("importance"), "feature")


def scores_of(models: Mapping[str, FittedModel], df: DataFrame) -> DataFrame:
    """Hold-out scores of several models in long form."""
    return reduce(DataFrame.unionByName, [m.scored(df).withColumn("model", F.lit(n)) for n, m in models.items()])
