"""Deep random forests, grown in groups of bounded size.

MLlib sends statistics of every node of a level from every task, which for deep trees is far more than the rows. Here nodes
of more than `GROUP_ROWS` rows are split level by level from histograms that Spark adds up; the rows of any smaller node of a
tree go to one task as bytes, a bin per feature, and that task grows the whole subtree. Subtrees stay in a table; scoring sends rows to the
subtrees they fall into in the same way. Only the top nodes, a few per `GROUP_ROWS` rows of a tree, are on the driver.

As in MLlib: bootstrap weights are Poisson(1), each node draws the square root of the features, splits lower the Gini impurity,
both sides keep `min_leaf` bagged rows, leaves of one parent with the same vote are merged (inside a group), and trees vote with
their leaf's shares. Rows are numbered by their bins and all draws come from hashes of numbers, so partitioning changes nothing.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.ordering import global_rank
from custlens.runtime import materialize, ship_package

GROUP_ROWS = 1 << 15
# Rows that one task deals to the groups of all trees.
TASK_ROWS = 1 << 13
BINS = 64
SHIFT = 7  # a bin needs at most so many bits
HALF = 32  # weights of both labels are halves of one number
LOW = (1 << HALF) - 1
BATCH_BYTES = 1 << 22  # of bins that leave a task in one batch
SUBTREES = "tree int, node int, depth int, feature array<int>, cut array<int>, left array<int>, right array<int>, n0 array<double>, n1 array<double>"
PARTS = ("feature", "cut", "left", "right", "n0", "n1")
POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def _bag(row: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree."""
    x = row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree + 1) * 0xD1342543DE82EF95 + seed * 0x2545F4914F6CDD1D & 2**64 - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return np.searchsorted(POISSON, (x >> np.uint64(11)) * 2.0**-53, "right")


def _matrix(codes: Sequence[bytes], d: int) -> np.ndarray:
    return np.frombuffer(b"".join(codes), np.uint8).reshape(-1, d)


def _descend(codes: np.ndarray, top: dict, most: int = 1 << 30) -> np.ndarray:
    """The node that each row reaches, at depth `most` at the latest."""
    feature, cut, left, right = (np.asarray(top[c]) for c in PARTS[:4])
    inner = (feature >= 0) & (np.asarray(top["depth"]) < most)
    node = np.zeros(len(codes), np.int64)
    while (live := np.flatnonzero(inner[node])).size:
        at = node[live]
        node[live] = np.where(codes[live, feature[at]] <= cut[at], left[at], right[at])
    return node


def _gain(l0, l1, t0, t1, whole, least: int) -> np.ndarray:
    """What a cut lowers the Gini impurity by, -inf where a side is too small; `whole` is the impurity term of the node."""
    r0, r1 = t0 - l0, t1 - l1
    nl, nr = l0 + l1, r0 + r1
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (l0 * l0 + l1 * l1) / nl + (r0 * r0 + r1 * r1) / nr - whole
    gain[(nl < max(least, 1)) | (nr < max(least, 1))] = -np.inf
    return gain


def _cuts(cells: Iterable[np.ndarray], local: np.ndarray, both: np.ndarray, t: np.ndarray, least: int, bins: int) -> tuple[np.ndarray, ...]:
    """Of each node the best drawn feature (its place in the draw), the bin to cut behind, the gain, and both weights on the left.

    `cells`: bins of the rows for each drawn feature; `both`: weights of the rows, that of label 1 in the upper half of the
    number. Equal gains go to the first feature, then to the smallest bin.
    """
    k, whole = t.shape[1], (t[0] ** 2 + t[1] ** 2) / t.sum(axis=0)
    top, slot, cut, left = np.full(k, -np.inf), np.zeros(k, np.int64), np.zeros(k, np.int64), np.zeros((2, k))
    dense = k * bins <= 2 * len(local)  # counts of all bins of all nodes, else one sort of the rows
    if not dense:
        # small numbers are sorted without comparisons
        by_node = np.argsort(local.astype(np.uint16 if k <= 1 << 16 else np.int64), kind="stable")
        ls = local[by_node]
        edge, before = ls[1:] == ls[:-1], np.cumsum(t, axis=1) - t
        narrow = np.empty(len(local), np.uint16 if k <= 1 << 16 else np.int64)
    else:
        weights, start = [(both & LOW).astype(float), (both >> HALF).astype(float)], local * bins
    for f, cell in enumerate(cells):
        if dense:
            key = start + cell
            l0, l1 = (np.cumsum(np.bincount(key, w, k * bins).reshape(k, bins), axis=1) for w in weights)
            gain = _gain(l0, l1, t[0][:, None], t[1][:, None], whole[:, None], least)
            at = gain.argmax(axis=1)
            here, place = np.arange(k), (np.arange(k), at)
            best, behind = gain[place], at
        else:
            order = np.argsort(cell, kind="stable")
            narrow[:] = local[order]
            order = order[np.argsort(narrow, kind="stable")]
            sorted_ = cell[order]
            ends = np.flatnonzero((sorted_[1:] != sorted_[:-1]) & edge)  # a cut lies behind the last row of a bin
            if not len(ends):
                continue
            node, upto = ls[ends], np.cumsum(both[order])[ends]
            l0, l1 = (upto & LOW) - before[0][node], (upto >> HALF) - before[1][node]
            gain = _gain(l0, l1, t[0][node], t[1][node], whole[node], least)
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            here = node[first]
            best = np.maximum.reduceat(gain, first)
            of = np.cumsum(np.concatenate([[0], node[1:] != node[:-1]]))
            place = np.minimum.reduceat(np.where(gain == best[of], np.arange(len(gain)), len(gain)), first)
            behind = sorted_[ends[place]]
        won = np.flatnonzero(best > top[here])
        at = here[won]
        top[at], slot[at], cut[at] = best[won], f, behind[won]
        for side, l in zip(left, (l0, l1)):
            side[at] = l[place][won]
    return slot, cut, top, left


def grow(codes: np.ndarray, weight: np.ndarray, label: np.ndarray, m: int, least: int, levels: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One tree on bagged rows: arrays per node, parents first; feature -1 is a leaf. Level by level, from the counts per bin of each drawn feature."""
    both = weight.astype(np.int64) << np.where(label == 1, HALF, 0)
    out = {c: [np.array([-1])] for c in PARTS[:4]}
    totals = [np.array([[both.sum() & LOW], [both.sum() >> HALF]], float)]
    bins, flat, d = int(codes.max(initial=0)) + 1, codes.ravel(), codes.shape[1]
    rows, node, begin, size = np.arange(len(codes)), np.zeros(len(codes), np.int64), 0, 1
    for _ in range(levels):
        t = totals[-1]
        open_ = (t > 0).all(axis=0) & (t.sum(axis=0) >= 2 * least)
        k = int(open_.sum())
        if not k:
            break
        keep = open_[node - begin]
        rows, both, local = rows[keep], both[keep], (np.cumsum(open_) - 1)[node[keep] - begin]
        t = t[:, open_]
        chosen = rng.random((k, d)).argsort(axis=1)[:, :m]
        at = rows * d
        slot, cut, top, left = _cuts((flat[at + drawn[local]] for drawn in chosen.T), local, both, t, least, bins)
        good = np.flatnonzero(top > 1e-9)
        if not len(good):
            break
        slot, cut, parent = slot[good], cut[good], begin + np.flatnonzero(open_)[good]
        first = begin + size + 2 * np.arange(len(good))
        for c, v in (("feature", chosen[good, slot]), ("cut", cut), ("left", first), ("right", first + 1)):
            out[c][-1][parent - begin] = v
            out[c].append(np.full(2 * len(good), -1))
        child = np.empty((2, 2 * len(good)))
        child[:, ::2], child[:, 1::2] = left[:, good], t[:, good] - left[:, good]
        totals.append(child)
        number = np.full(k, -1)
        number[good] = np.arange(len(good))
        keep = number[local] >= 0
        rows, both, at = rows[keep], both[keep], number[local[keep]]
        node = first[at] + (flat[rows * d + chosen[good, slot][at]] > cut[at])
        begin, size = begin + size, 2 * len(good)
    n0, n1 = np.concatenate(totals, axis=1)
    return {c: np.concatenate(v) for c, v in out.items()} | {"n0": n0, "n1": n1}


def _read_off(tree: dict, codes: np.ndarray, levels: int) -> np.ndarray:
    """Share of positive rows in the leaf of each row, when the tree ends after `levels` and equal votes of one parent are merged."""
    feature, left, right = (np.array(tree[c]) for c in ("feature", "left", "right"))
    n0, n1 = np.asarray(tree["n0"]), np.asarray(tree["n1"])
    depth, level, by_level = np.zeros(len(feature), np.int64), np.zeros(1, np.int64), []
    while (inner := level[left[level] >= 0]).size:
        by_level.append(inner)
        level = np.concatenate([left[inner], right[inner]])
        depth[level] = len(by_level)
    feature[depth >= levels] = -1
    vote = n1 > n0
    for inner in by_level[levels - 1 :: -1] if levels > 0 else ():
        a, b = left[inner], right[inner]
        feature[inner[(feature[a] < 0) & (feature[b] < 0) & (vote[a] == vote[b])]] = -1
    return (n1 / (n0 + n1))[_descend(codes, {"feature": feature, "cut": tree["cut"], "left": left, "right": right, "depth": depth})]


def _dealt(df: DataFrame) -> DataFrame:
    """By tree and node, to a given number of tasks: by bytes all small groups would end in one."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, "tree", "node")


def _whole(batches: Iterator[pd.DataFrame], d: int) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Bins, numbers and labels of all rows of a task."""
    parts = [(_matrix(pdf["codes"], d), pdf["row"].to_numpy(), pdf["label"].to_numpy(np.uint8)) for pdf in batches if len(pdf)]
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else None


def _blocks(points: DataFrame, tops: list[dict], d: int, seed: int | None) -> DataFrame:
    """Rows (`codes`) packed by the open top node of each tree that they reach; with `seed` only bagged ones, with `weight` and `label`, else with `row`."""
    ship_package(points.sparkSession)
    columns = ["tree", "node", "codes", *(["row"] if seed is None else ["weight", "label"])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = _whole(batches, d)
        if rows is None:
            return
        codes, row, label = rows
        out, held = [], 0
        for tree, top in enumerate(tops):
            weight = None if seed is None else _bag(row, tree, seed).astype(np.uint8)
            mine = np.zeros(len(top["feature"]), bool)
            mine[top["open"]] = True
            node = _descend(codes, top)
            at = np.flatnonzero(mine[node] if weight is None else mine[node] & (weight > 0))
            at = at[np.argsort(node[at], kind="stable")]
            ends = np.flatnonzero(np.append(node[at][1:] != node[at][:-1], True)) + 1 if len(at) else ()
            for some in np.split(at, ends[:-1]) if len(at) else ():
                kept = [row[some]] if weight is None else [weight[some], label[some]]
                out.append((tree, int(node[some[0]]), *[v.tobytes() for v in (codes[some], *kept)]))
                held += len(some) * d
            if held >= BATCH_BYTES or len(out) >= 10_000:
                yield pd.DataFrame(out, columns=columns)
                out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=columns)

    return points.select("row", "codes", "label").mapInPandas(run, ", ".join(f"{c} {'int' if c in ('tree', 'node') else 'binary'}" for c in columns))


def _grow_tops(rows: DataFrame, n: int, trees: int, d: int, m: int, least: int, max_depth: int, seed: int) -> list[dict]:
    """Top nodes of each tree, down to nodes of at most `GROUP_ROWS` rows."""
    tops = [{"feature": [-1], "cut": [0], "left": [-1], "right": [-1], "n0": [0.0], "n1": [0.0], "depth": [0], "open": [0]} for _ in range(trees)]
    active = [(t, 0) for t in range(trees)] if n > GROUP_ROWS else []
    while active:
        drawn = {(t, a): np.random.default_rng([seed, t, a, 1]).permutation(d)[:m].tolist() for t, a in active}
        found = {(r["tree"], r["node"]): r for r in _best_splits(rows, tops, drawn, d, least, seed).collect()}
        after = []
        for t, a in active:
            top, r = tops[t], found.get((t, a))
            top["open"].remove(a)
            if r is None:  # no split: a leaf, with counts from its parent
                continue
            if a == 0:
                top["n0"][0], top["n1"][0] = r["l0"] + r["r0"], r["l1"] + r["r1"]
            top["feature"][a], top["cut"][a], top["left"][a], top["right"][a] = r["feature"], r["bin"], len(top["feature"]), len(top["feature"]) + 1
            for side in "lr":
                child, deep = len(top["feature"]), top["depth"][a] + 1
                for c, v in zip((*PARTS, "depth"), (-1, 0, -1, -1, r[f"{side}0"], r[f"{side}1"], deep)):
                    top[c].append(v)
                if r[f"{side}0"] > 0 and r[f"{side}1"] > 0 and deep < max_depth:
                    top["open"].append(child)
                    if r[f"{side}c"] > GROUP_ROWS:
                        after.append((t, child))
        active = after
    return tops


def _best_splits(rows: DataFrame, tops: list[dict], drawn: dict, d: int, least: int, seed: int) -> DataFrame:
    """The best split of each (tree, node) of `drawn` among its features, with weights (`l0`, `l1`, `r0`, `r1`) and rows (`lc`, `rc`) of both sides."""
    ship_package(rows.sparkSession)

    asked: dict[int, dict[int, list[int]]] = {}
    for (t, a), features in drawn.items():
        asked.setdefault(t, {})[a] = features
    columns, bins = ["tree", "node", "feature", "bin", "n0", "n1", "c"], 1 << SHIFT

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = _whole(batches, d)
        if got is None:
            return
        codes, row, label = got
        out, held = [], 0
        for tree, mine in asked.items():
            nodes, features = np.array(list(mine)), np.array(list(mine.values()))
            weight = _bag(row, tree, seed)
            local = np.full(len(tops[tree]["feature"]), -1)
            local[nodes] = np.arange(len(nodes))
            local = local[_descend(codes, tops[tree])]
            at = np.flatnonzero((local >= 0) & (weight > 0))
            local = local[at]
            one = label[at] == 1
            for drawn_ in features.T:  # one of the drawn features of each node at a time
                key = local * bins + codes[at, drawn_[local]]
                n0, n1, c = (np.bincount(key, w, len(nodes) * bins) for w in (weight[at] * ~one, weight[at] * one, None))
                cell = np.flatnonzero(c)
                of = cell >> SHIFT
                out.append((np.full(len(cell), tree), nodes[of], drawn_[of], cell & (bins - 1), n0[cell], n1[cell], c[cell]))
                held += len(cell)
            if held >= 1 << 18:
                yield pd.DataFrame(dict(zip(columns, (np.concatenate(v) for v in zip(*out)))))
                out, held = [], 0
        if out:
            yield pd.DataFrame(dict(zip(columns, (np.concatenate(v) for v in zip(*out)))))

    parts = rows.select("row", "codes", "label").mapInPandas(run, "tree int, node int, feature int, bin int, n0 double, n1 double, c long")
    cells = parts.groupBy("tree", "node", "feature", "bin").agg(*[F.sum(c).alias(c) for c in ("n0", "n1", "c")])
    whole = Window.partitionBy("tree", "node", "feature")
    upto = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    names = {"n0": "0", "n1": "1", "c": "c"}
    cells = cells.select("*", *[F.sum(c).over(upto).alias(f"l{s}") for c, s in names.items()], *[F.sum(c).over(whole).alias(f"t{s}") for c, s in names.items()])
    cells = cells.withColumns({f"r{s}": F.col(f"t{s}") - F.col(f"l{s}") for s in names.values()})

    def purity(side: str):
        return (F.col(f"{side}0") ** 2 + F.col(f"{side}1") ** 2) / (F.col(f"{side}0") + F.col(f"{side}1"))

    cells = cells.where((F.col("l0") + F.col("l1") >= max(least, 1)) & (F.col("r0") + F.col("r1") >= max(least, 1)))
    cells = cells.withColumn("gain", purity("l") + purity("r") - purity("t")).where("gain > 1e-9")
    kept = F.struct("feature", "bin", "l0", "l1", "lc", "r0", "r1", "rc")
    return cells.groupBy("tree", "node").agg(F.max_by(kept, F.struct("gain", -F.col("feature"), -F.col("bin"))).alias("s")).select("tree", "node", "s.*")


class GrownForest(Transformer, MLWritable, MLReadable):
    """A fitted forest: `trees` is the table of subtrees, `tops` the top nodes of each tree, `cuts` the bins' upper ends by feature."""

    def __init__(self, trees: DataFrame, tops: list[dict], cuts: list[list[float]], max_depth: int) -> None:
        super().__init__()
        self.trees, self.tops, self.cuts, self.max_depth = trees, tops, cuts, max_depth

    def coded(self, df: DataFrame, x: str = "features") -> DataFrame:
        return df.withColumn("_codes", _coder(self.cuts)(vector_to_array(x)))

    def scores(self, coded: DataFrame, depths: Sequence[int]) -> DataFrame:
        """`_codes` once each and a score `s0`, `s1`, … for each of `depths`."""
        points = materialize(coded.select(F.col("_codes").alias("codes"), F.lit(0).alias("label")).distinct().withColumn("row", F.monotonically_increasing_id()))
        points = points.repartition(points.sparkSession.sparkContext.defaultParallelism, "row")
        columns, d, tops = [f"s{i}" for i in range(len(depths))], len(self.cuts), self.tops
        schema = ", ".join(["row long", *[f"{c} double" for c in columns]])

        def vote(key: tuple, blocks: pd.DataFrame, subtree: pd.DataFrame) -> pd.DataFrame:
            if not len(blocks):
                return pd.DataFrame({c: [] for c in ("row", *columns)})
            codes = _matrix(blocks["codes"], d)
            tree = {c: np.asarray(subtree[c].iloc[0]) for c in PARTS}
            depth = int(subtree["depth"].iloc[0])
            shares = [_read_off(tree, codes, most - depth) if most >= depth else np.zeros(len(codes)) for most in depths]
            return pd.DataFrame({"row": np.frombuffer(b"".join(blocks["row"]), np.int64)} | dict(zip(columns, shares)))

        votes = _dealt(_blocks(points, tops, d, None)).groupBy("tree", "node").cogroup(_dealt(self.trees).groupBy("tree", "node")).applyInPandas(vote, schema)
        if any(len(t["feature"]) > 1 for t in tops):  # rows that end among the top nodes

            def end(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    codes, sums = _matrix(pdf["codes"], d), np.zeros((len(depths), len(pdf)))
                    for top in tops:
                        n0, n1, closed = np.asarray(top["n0"]), np.asarray(top["n1"]), np.ones(len(top["feature"]))
                        closed[top["open"]] = 0.0
                        share = closed * n1 / np.maximum(n0 + n1, 1.0)
                        for s, most in zip(sums, depths):
                            s += share[_descend(codes, top, most)]
                    yield pd.DataFrame({"row": pdf["row"]} | dict(zip(columns, sums)))

            votes = votes.unionByName(points.mapInPandas(end, schema))
        summed = votes.groupBy("row").agg(*[(F.sum(c) / F.lit(len(tops))).alias(c) for c in columns])
        return materialize(points.join(summed, "row").select(F.col("codes").alias("_codes"), *columns))

    def _transform(self, df: DataFrame) -> DataFrame:
        coded, p = self.coded(df), F.col("s0")
        return coded.join(self.scores(coded, [self.max_depth]), "_codes").withColumn("probability", array_to_vector(F.array(1 - p, p))).drop("_codes", "s0")

    def nodes(self) -> pd.DataFrame:
        """All nodes on the driver, as `models.tree_nodes` lists them: for small forests."""
        found = {(r["tree"], r["node"]): r for r in self.trees.collect()}
        out = []
        for t, top in enumerate(self.tops):
            whole = {c: list(top[c]) for c in PARTS}
            for a in top["open"]:
                sub, base = found[t, a], len(whole["feature"]) - 1
                for c in PARTS:
                    values = [v + base if c in ("left", "right") and v >= 0 else v for v in sub[c]]
                    whole[c][a] = values[0]
                    whole[c] += values[1:]
            cut = [self.cuts[f][c] if f >= 0 else 0.0 for f, c in zip(whole["feature"], whole["cut"])]
            votes = [np.array(v) for v in zip(whole["n0"], whole["n1"])]
            out.append(pd.DataFrame({"tree": t, "id": range(len(cut)), "prediction": [float(v[1] > v[0]) for v in votes], "votes": votes, "left": whole["left"], "right": whole["right"], "feature": whole["feature"], "cut": cut}))
        return pd.concat(out)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: GrownForest) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata={"max_depth": self.model.max_depth, "forest": json.dumps([self.model.tops, self.model.cuts])})
        self.model.trees.write.parquet(f"{path}/trees")


class _Reader(MLReader):
    def load(self, path: str) -> GrownForest:
        facts = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        tops, cuts = json.loads(facts["forest"])
        return GrownForest(self.sparkSession.read.parquet(f"{path}/trees"), tops, cuts, facts["max_depth"])


def _coder(cuts: list[list[float]]):
    @F.pandas_udf("binary")
    def code(x: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=object)
        rows = np.vstack(x)
        bins = np.column_stack([np.searchsorted(c, rows[:, j]) for j, c in enumerate(cuts)]).astype(np.uint8)
        return pd.Series([b.tobytes() for b in bins])

    return code


def fit_forest(rows: DataFrame, n: int, d: int, trees: int, max_depth: int, least: int, seed: int) -> GrownForest:
    """A forest on `rows` (`label` 0 or 1, `features`), of which there are `n`."""
    x = vector_to_array("features")
    wide = rows.select(*[x[j].alias(f"f{j}") for j in range(d)])
    cuts = [sorted(set(q)) for q in wide.approxQuantile(wide.columns, [i / BINS for i in range(BINS)], 0.001)]
    coded = rows.select(F.col("label").cast("int").alias("label"), _coder(cuts)(x).alias("codes"))
    numbered = materialize(global_rank(coded, [F.asc("codes"), F.asc("label")], "row")).repartition(math.ceil(n / TASK_ROWS), "row")
    m = math.ceil(math.sqrt(d))
    tops = _grow_tops(numbered, n, trees, d, m, least, max_depth, seed)

    def subtree(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        t, a = (int(k) for k in key)
        weight, label = (np.frombuffer(b"".join(blocks[c]), np.uint8) for c in ("weight", "label"))
        depth = tops[t]["depth"][a]
        tree = grow(_matrix(blocks["codes"], d), weight, label, m, least, max_depth - depth, np.random.default_rng([seed, t, a, 2]))
        return pd.DataFrame({"tree": [t], "node": [a], "depth": [depth]} | {c: [tree[c]] for c in PARTS})

    grown = materialize(_dealt(_blocks(numbered, tops, d, seed)).groupBy("tree", "node").applyInPandas(subtree, SUBTREES))
    return GrownForest(grown, tops, [[float(v) for v in c] for c in cuts], max_depth)
