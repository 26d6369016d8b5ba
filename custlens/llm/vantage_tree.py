"""Nearest neighbours by cosine with vantage-point trees per shard.

Rows are dealt by a hash of their id into shards of bounded size. Each shard's distinct vectors, scaled to length one (so
that Euclidean distance orders them as cosine does), become a vantage-point tree, and the trees are written as a table.
Blocks of queries meet every shard. With d a query's distance to the vantage point, m the median distance there and t its
k-th best distance so far, the other side of the median is visited if |m - d| <= factor * t: factor 1 is the triangle
inequality and gives exact results, smaller ones prune more. Cosines are then taken on the original vectors in double
precision, row by row, so that equal vectors have equal scores.

Defined cases: rows with a null id or a vector that is null, empty, zero or holds a null, NaN or infinite component take no
part. Only vectors of one length are compared. Rows equal in id and vector count once. A query's own id is never its
neighbour. Equal scores go by the smaller id, across any number of equal vectors: of each distinct vector the k + 1 smallest
ids of a shard are kept, which is enough. Extra columns are ignored.
"""

from __future__ import annotations

import io
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.runtime import materialize, ship_package

SHARD_ROWS = 2048
QUERY_ROWS = 1024
LEAF = 64
# Room for rounding when distances are compared; candidates within it are ranked by their exact cosine.
SLACK = 1e-9


@dataclass
class Tree:
    """`order`: points by leaf. Per node: its range in `order`, vantage point, median distance and children (-1: a leaf)."""

    points: np.ndarray
    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    vantage: np.ndarray
    median: np.ndarray
    inside: np.ndarray
    outside: np.ndarray


def build(points: np.ndarray) -> Tree:
    order = np.arange(len(points))
    nodes: list[list] = [[0, len(points), -1, 0.0, -1, -1]]
    rng = np.random.default_rng(len(points))
    waiting = [0]
    while waiting:
        i = waiting.pop()
        lo, hi = nodes[i][:2]
        if hi - lo <= LEAF:
            continue
        own = order[lo:hi]
        vantage = int(own[rng.integers(hi - lo)])
        d = distances(points[vantage : vantage + 1], points[own])[0]
        ranked = np.argsort(d, kind="stable")
        median = d[ranked[(hi - lo) // 2]]
        cut = int(np.searchsorted(d[ranked], median, "left"))  # inside: strictly nearer than the median
        if cut == 0:
            continue  # all in one half: nothing to part
        order[lo:hi] = own[ranked]
        nodes[i][2:] = [vantage, median, len(nodes), len(nodes) + 1]
        waiting += [len(nodes), len(nodes) + 1]
        nodes += [[lo, lo + cut, -1, 0.0, -1, -1], [lo + cut, hi, -1, 0.0, -1, -1]]
    lo, hi, vantage, median, inside, outside = (np.array(c) for c in zip(*nodes))
    return Tree(points, order, lo, hi, vantage, median.astype(float), inside, outside)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


def search(tree: Tree, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, point) that hold the k nearest points of each query, and all that tie with the k-th."""
    best = np.full((len(queries), k), np.inf)

    def nearest(active: np.ndarray, own: np.ndarray) -> None:
        both = np.concatenate([best[active], distances(queries[active], tree.points[own])], axis=1)
        best[active] = np.partition(both, k - 1, axis=1)[:, :k]

    def reach(active: np.ndarray) -> np.ndarray:
        return best[active].max(axis=1)

    _walk(tree, queries, 0, np.arange(len(queries)), factor, nearest, reach)
    limit = best.max(axis=1) + SLACK
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def within(active: np.ndarray, own: np.ndarray) -> None:
        q, p = np.nonzero(distances(queries[active], tree.points[own]) <= limit[active][:, None])
        found.append((active[q], own[p]))

    _walk(tree, queries, 0, np.arange(len(queries)), factor, within, lambda active: limit[active])
    return np.concatenate([q for q, _ in found]), np.concatenate([p for _, p in found])


def _walk(tree: Tree, queries: np.ndarray, node: int, active: np.ndarray, factor: float, visit, reach) -> None:
    """Visit leaves for all queries at once, each query's nearer side first; `reach` gives the distances that still matter."""
    if not len(active):
        return
    if tree.inside[node] < 0:
        visit(active, tree.order[tree.lo[node] : tree.hi[node]])
        return
    v, median = int(tree.vantage[node]), tree.median[node]
    d = distances(queries[active], tree.points[v : v + 1])[:, 0]
    near_in = d < median
    for side in (True, False):
        first, gap = near_in == side, np.abs(median - d)
        own, rest = (tree.inside[node], tree.outside[node]) if side else (tree.outside[node], tree.inside[node])
        _walk(tree, queries, own, active[first], factor, visit, reach)
        again = active[first][gap[first] <= factor * reach(active[first]) + SLACK]
        _walk(tree, queries, rest, again, factor, visit, reach)


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def usable(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """`id`, `v` (doubles) of the rows that take part, without repeated rows."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists("v", lambda x: x != 0)).dropDuplicates()


@dataclass(frozen=True)
class Index:
    """`trees`: one row per shard and vector length (`dim`, `shard`, `tree`: its arrays), written to the shared folder."""

    trees: DataFrame
    shards: int


def build_index(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> Index:
    """Trees over all rows that `usable` gave; good for searches of up to `k` neighbours."""
    ship_package(rows.sparkSession)
    shards = max(1, math.ceil(rows.count() / shard_rows))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        vectors = np.array(part["v"].tolist(), float)
        distinct, back = np.unique(vectors, axis=0, return_inverse=True)
        ids = part["id"].to_numpy()
        ranked = np.lexsort((ids, back.ravel()))
        owner = back.ravel()[ranked]
        nth = np.arange(len(owner)) - np.searchsorted(owner, owner)
        keep = nth <= k
        tree = build(_unit(distinct))
        store = io.BytesIO()
        np.savez(store, vectors=distinct, ids=ids[ranked][keep], owner=owner[keep], **{f: getattr(tree, f) for f in tree.__dataclass_fields__ if f != "points"})
        return pd.DataFrame({"dim": [vectors.shape[1]], "shard": [int(part["shard"].iloc[0])], "tree": [store.getvalue()]})

    dealt = rows.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard"))
    return Index(materialize(dealt.groupBy("dim", "shard").applyInPandas(pack, "dim int, shard int, tree binary")), shards)


def neighbours(index: Index, queries: DataFrame, k: int, factor: float = 1.0, query_rows: int = QUERY_ROWS) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: the k nearest of each query (`id`, `v`) among the rows of `index`."""
    ship_package(queries.sparkSession)
    blocks = max(1, math.ceil(queries.count() / query_rows))
    asked = queries.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(blocks)).cast("int").alias("block"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(index.shards - 1))))
    trees = index.trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def meet(tree_rows: pd.DataFrame, query_rows_: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        if not len(tree_rows) or not len(query_rows_):
            return empty
        z = np.load(io.BytesIO(tree_rows["tree"].iloc[0]))
        vectors, ids, owner = z["vectors"], z["ids"], z["owner"]
        tree = Tree(_unit(vectors), *(z[f] for f in Tree.__dataclass_fields__ if f != "points"))
        asked_v, asked_id = np.array(query_rows_["v"].tolist(), float), query_rows_["id"].to_numpy()
        # one more than asked for: a query's own vector may be among the nearest
        q, p = search(tree, _unit(asked_v), min(k + 1, len(vectors)), factor)
        a, b = asked_v[q], vectors[p]
        score = (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
        begin, count = np.searchsorted(owner, p), np.bincount(owner, minlength=len(vectors))[p]
        pair = np.repeat(np.arange(len(p)), count)
        member = begin[pair] + np.arange(len(pair)) - np.repeat(np.cumsum(count) - count, count)
        out = pd.DataFrame({"query_id": asked_id[q][pair], "vec_id": ids[member], "score": score[pair]})
        out = out[out["query_id"] != out["vec_id"]].sort_values(["query_id", "score", "vec_id"], ascending=[True, False, True])
        return out.groupby("query_id").head(k) if len(out) else empty

    found = trees.groupBy("dim", "shard", "block").cogroup(asked.groupBy("dim", "shard", "block")).applyInPandas(meet, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
