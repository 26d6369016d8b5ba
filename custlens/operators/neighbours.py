"""Exact nearest neighbours and exact mean distances by joins of bounded point blocks.

Points are rows (id bigint, x array<double>). They are cut into compact blocks of bounded size along a
space-filling curve; a block pair is compared inside one task with NumPy, and only k rows per point (or
one sum per point and cluster) leave it. Boxes around the blocks form a tree, kept as one table per level; pairs of
blocks that cannot hold a neighbour are dropped level by level, by joins on the parent box. The block nearest to a point's own
bounds the distance of its k-th neighbour; then each block is sent only the points that may have a neighbour in it.

Comparisons are dealt to a number of tasks that goes by the blocks: the rows are few and long, and by their bytes alone
they would be put together into one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.ordering import global_rank
from custlens.runtime import materialize, ship_package

BLOCK_ROWS = 2048
FAN = 16
CURVE_DIMENSIONS = 6
CURVE_BITS = 10
# Blocks that one task compares with, once there are more than four for each core.
TASK_BLOCKS = 32
# Cells of a distance matrix that are worked on at a time, and numbers sent to blocks in one batch.
TILE_CELLS = 1 << 17
# Blocks that a table is cut into for the mean distances, and numbers in one of them, which stop their growth.
SPREAD = 64
BLOCK_NUMBERS = 1 << 19
BATCH_NUMBERS = 1 << 20
# Clusters of a block up to which all its sums leave it.
FEW_CLUSTERS = 32


def _hash() -> Column:
    """Rows are sorted by it before whole points are compared."""
    return F.xxhash64("x")


def _tasks(spark, blocks: int) -> int:
    return max(1, min(blocks, max(4 * spark.sparkContext.defaultParallelism, blocks // TASK_BLOCKS)))


def _placed(lows: list[float], highs: list[float], flags: list[int] = ()):
    """Place of a point: `g`, its 0/1 coordinates as bits of one number, so that equal patterns come together, and in them `z`, the
    interleaved bits of the leading coordinates that are no flags: points close on the curve are close in space."""
    leading = [j for j in range(len(lows)) if j not in flags][:CURVE_DIMENSIONS]
    steps = 2**CURVE_BITS - 1

    @F.arrow_udf("struct<g: bigint, z: bigint>")
    def place(x: pa.Array) -> pa.Array:
        rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.zeros((0, len(lows)))
        g, z = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for i, j in enumerate(flags[:62]):
            g |= (rows[:, j] > 0).astype(np.int64) << i
        for at, j in enumerate(leading):
            span = highs[j] - lows[j]
            cell = np.nan_to_num(np.floor((rows[:, j] - lows[j]) / span * steps)).astype(np.int64) if span > 0 else np.zeros(len(rows), np.int64)
            for bit in range(CURVE_BITS):
                z |= (cell >> bit & 1) << (bit * len(leading) + at)
        return pa.StructArray.from_arrays([pa.array(g), pa.array(z)], names=["g", "z"])

    return place


def _box(xs: str, d: Column) -> Column:
    """Lower and upper corner of the points of each block."""

    @F.arrow_udf("struct<lows: array<double>, highs: array<double>>")
    def corners(flat: pa.Array, d: pa.Array) -> pa.Array:
        blocks = [np.asarray(v.values.to_numpy(zero_copy_only=False), float).reshape(-1, n.as_py()) for v, n in zip(flat, d)]
        sides = [pa.array([side.reduce(b, axis=0) for b in blocks], pa.list_(pa.float64())) for side in (np.fmin, np.maximum)]
        return pa.StructArray.from_arrays(sides, names=["lows", "highs"])

    return corners(xs, d)


@dataclass
class Blocks:
    """Points packed along the curve, and the boxes over them.

    `packed`: one row per block (block, n, ids, xs flattened, payload arrays, lows, highs, least, most), written once. Blocks
    are the leaves of a tree of boxes: `FAN` consecutive ones share a parent, and so on up. `least` and `most` bound the weights.
    """

    packed: DataFrame
    count: int
    levels: list[DataFrame] = field(default_factory=list)

    @property
    def height(self) -> int:
        """Levels until one has at most `FAN` boxes."""
        out = 1
        while self.count > FAN**out:
            out += 1
        return out

    def level(self, i: int) -> DataFrame:
        """Boxes `node`, `n`, `lows`, `highs`, `least`, `most` of one level; 0: the blocks."""
        while len(self.levels) <= i:
            if not self.levels:
                self.levels.append(self.packed.select(F.col("block").alias("node"), "n", "lows", "highs", "least", "most"))
                continue
            below = self.levels[-1]
            d = F.size("lows")
            each = below.select(F.expr(f"node div {FAN}").alias("node"), "n", "least", "most", F.posexplode(F.arrays_zip("lows", "highs")).alias("_j", "_e"), d.alias("_d"))
            sides = each.groupBy("node", "_j").agg(F.min("_e.lows").alias("l"), F.max("_e.highs").alias("h"), F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
            corner = F.array_sort(F.collect_list(F.struct("_j", "l", "h")))
            up = sides.groupBy("node").agg(corner.alias("c"), F.max("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most"))
            self.levels.append(materialize(up.select("node", "n", F.col("c.l").alias("lows"), F.col("c.h").alias("highs"), "least", "most")))
        return self.levels[i]


def blocks(points: DataFrame, rows: int = BLOCK_ROWS, payload: tuple[str, ...] = (), weight: str | None = None) -> Blocks:
    """Blocks of at most `rows` points. The curve position is ranked together with the id, so copies cannot overfill a block."""
    first = points.select(F.size("x").alias("d")).first()
    if first is None:
        raise ValueError("no points")
    d = first["d"]
    # one row per coordinate: three aggregates for each are more than Spark compiles into one loop
    edges = points.select(F.posexplode("x").alias("j", "v")).groupBy("j").agg(F.count("*").alias("n"), F.min("v").alias("l"), F.max("v").alias("h"), F.max(F.abs(F.col("v") - F.floor("v"))).alias("f"))
    edges = sorted(edges.where(F.col("j") < d).collect())
    flags = [r["j"] for r in edges if r["l"] == 0 and r["h"] == 1 and r["f"] == 0]
    ship_package(points.sparkSession)
    keyed = points.withColumn("_p", _placed([r["l"] for r in edges], [r["h"] for r in edges], flags)("x"))
    placed = global_rank(keyed, [F.asc("_p.g"), F.asc("_p.z"), F.asc("id")], "_r").withColumn("block", F.expr(f"(_r - 1) div {rows}"))
    members = F.array_sort(F.collect_list(F.struct("id", "x", *payload)))
    columns = [F.size("m").cast("bigint").alias("n"), F.col("m.id").alias("ids"), F.flatten("m.x").alias("xs"), *[F.col(f"m.{p}").alias(p) for p in payload]]
    size = F.col(weight).cast("double") if weight else F.lit(1.0)
    packed = placed.groupBy("block").agg(members.alias("m"), F.min(size).alias("least"), F.max(size).alias("most"))
    boxed = packed.select("block", *columns, "least", "most").withColumn("_box", _box("xs", F.lit(d)))
    return Blocks(materialize(boxed.withColumns({"lows": F.col("_box.lows"), "highs": F.col("_box.highs")}).drop("_box")), math.ceil(max(r["n"] for r in edges) / rows))


def _near_pairs(query: Blocks, train: Blocks, k: int, weighted: bool = False) -> DataFrame:
    """Block pairs (a, b) that may hold a k-nearest neighbour, with the squares of their gap (near) and reach (far), found by descending both trees level by level.

    The k-th neighbour of any point in box a is no farther than the k-th smallest farthest-corner distance over the boxes
    that a still meets (counted with their sizes); boxes nearer than that bound stay, and only their children are joined on
    the parent. `weighted` distances are those of Ward: w v / (w + v) times the square, which grows with either weight.
    """
    a_side = lambda t: t.select(F.col("node").alias("a"), F.expr(f"node div {FAN}").alias("a_up"), *[F.col(c).alias(f"a_{c}") for c in ("lows", "highs", "least", "most")])
    b_side = lambda t: t.select(F.col("node").alias("b"), F.expr(f"node div {FAN}").alias("b_up"), "n", *[F.col(c).alias(f"b_{c}") for c in ("lows", "highs", "least", "most")])

    def squares(ends: Column) -> Column:
        return F.aggregate(ends, F.lit(0.0), lambda s, v: s + v * v)

    def scale(bound: str) -> Column:
        w, v = F.col(f"a_{bound}"), F.col(f"b_{bound}")
        return w * v / (w + v) if weighted else F.lit(1.0)

    minus = lambda p, q: F.zip_with(p, q, lambda x, y: x - y)
    gap = F.zip_with(minus("b_lows", "a_highs"), minus("a_lows", "b_highs"), lambda p, q: F.greatest(p, q, F.lit(0.0)))
    reach = F.zip_with(minus("b_highs", "a_lows"), minus("a_highs", "b_lows"), lambda p, q: F.greatest(F.abs(p), F.abs(q)))
    whole = Window.partitionBy("a")
    upto = whole.orderBy("far", "b").rowsBetween(Window.unboundedPreceding, 0)
    pairs = None
    for level in range(max(query.height, train.height) - 1, -1, -1):
        asked, found = a_side(query.level(level)), b_side(train.level(level))
        if pairs is None:  # all boxes of the top have parent 0
            met = asked.join(found, F.col("a_up") == F.col("b_up"))
        else:
            met = pairs.select(F.col("a").alias("a_up"), F.col("b").alias("b_up")).join(asked, "a_up").join(found, "b_up")
        bounds = met.select("a", "b", "n", (squares(gap) * scale("least")).alias("near"), (squares(reach) * scale("most")).alias("far"))
        enough = bounds.withColumn("_upto", F.sum("n").over(upto)).withColumn("_bound", F.min(F.when(F.col("_upto") >= k, F.col("far"))).over(whole))
        pairs = materialize(enough.where(F.col("_bound").isNull() | (F.col("near") <= F.col("_bound") * (1 + 1e-9))).select("a", "b", "near", "far"))
    return pairs


def _matrix(flat, n: int) -> np.ndarray:
    return np.asarray(flat, dtype=float).reshape(n, -1)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances of two blocks, added coordinate by coordinate (no cancellation), a tile at a time."""
    out = np.zeros((len(a), len(b)))
    if not out.size:
        return out
    alike = (a.min(axis=0) == a.max(axis=0)) & (b.min(axis=0) == b.max(axis=0)) & (a[0] == b[0])  # adds nothing
    columns = [(j, np.ascontiguousarray(b[:, j])) for j in np.flatnonzero(~alike)]
    step = max(1, TILE_CELLS // len(b))
    for i in range(0, len(a), step):
        tile = out[i : i + step]
        for j, other in columns:
            diff = a[i : i + step, j, None] - other
            diff *= diff
            tile += diff
    return out


def _distances(r, weighted: bool) -> np.ndarray:
    """Squared distances, or Ward's costs without those of a point to itself, of the two blocks of a row."""
    q_ids, t_ids = np.asarray(r.q_ids), np.asarray(r.t_ids)
    dist = _squared(_matrix(r.q_xs, len(q_ids)), _matrix(r.t_xs, len(t_ids)))
    if weighted:
        w, v = np.asarray(r.q_weight, float)[:, None], np.asarray(r.t_weight, float)[None, :]
        dist *= w * v / (w + v)
        dist[q_ids[:, None] == t_ids[None, :]] = np.inf
    return dist


def _bounds(k: int, weighted: bool):
    """Per block the k-th smallest distance of each point to the other block."""

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                dist = _distances(r, weighted)
                bound = np.partition(dist, k - 1, axis=1)[:, k - 1] if k <= dist.shape[1] else np.full(len(dist), np.inf)
                yield pd.DataFrame({"a": [r.a], "bound": [bound]})

    return run


def _asking(weighted: bool):
    """For each block met the points that may have one of their neighbours in it: its box is no farther than their bound."""

    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                ids, bound, blocks = np.asarray(r.q_ids), np.asarray(r.bound, float), np.asarray(r.b)
                x, lows, highs = _matrix(r.q_xs, len(ids)), _matrix(r.lows, len(blocks)), _matrix(r.highs, len(blocks))
                weight = np.asarray(r.q_weight, float) if weighted else None
                out, size = [], 0
                for i, b in enumerate(blocks):
                    near = np.zeros(len(ids))
                    for j in range(x.shape[1]):
                        gap = np.maximum(np.maximum(lows[i, j] - x[:, j], x[:, j] - highs[i, j]), 0.0)
                        near += gap * gap
                    if weighted:
                        near *= weight * r.least[i] / (weight + r.least[i])
                    some = np.flatnonzero(near <= bound * (1 + 1e-9))
                    if not len(some):
                        continue
                    row = {"b": b, "q_ids": ids[some], "q_xs": x[some].ravel(), "bound": bound[some]}
                    out.append(row | {"q_weight": weight[some]} if weighted else row)
                    size += x.shape[1] * len(some)
                    if size >= BATCH_NUMBERS:
                        yield pd.DataFrame(out)
                        out, size = [], 0
                if out:
                    yield pd.DataFrame(out)

    return run


def _nearest_in_pair(k: int, weighted: bool):
    def run(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                q_ids, t_ids = np.asarray(r.q_ids), np.asarray(r.t_ids)
                dist = _distances(r, weighted)
                near = dist <= np.asarray(r.bound, float)[:, None]
                if k < dist.shape[1] and np.count_nonzero(near) > 4 * k * len(dist):
                    near &= dist <= np.partition(dist, k - 1, axis=1)[:, k - 1 : k]
                row, col = np.nonzero(near)
                order = np.lexsort((t_ids[col], dist[row, col], row))
                row, col = row[order], col[order]
                first = np.searchsorted(row, np.arange(len(q_ids)))
                keep = np.arange(len(row)) - first[row] < k
                row, col = row[keep], col[keep]
                yield pd.DataFrame({"id": q_ids[row], "neighbour": t_ids[col], "squared": dist[row, col]})

    return run


def distinct_points(points: DataFrame) -> DataFrame:
    """Copies collapse to one row (id = smallest id, weight = copies) by a plain aggregate."""
    return points.groupBy("x").agg(F.min("id").alias("id"), F.count("*").alias("weight"))


def nearest(query: DataFrame, train: DataFrame, k: int, rows: int = BLOCK_ROWS) -> DataFrame:
    """The k nearest train rows per query row: (id, neighbour, distance, place), ties by train id.

    Of equal train rows only the k lowest ids can be among the k nearest, so the others are left out
    before any comparison; that limit is applied ahead of the shuffle. Equal query rows are searched once.
    """
    same = Window.partitionBy(_hash(), "x").orderBy("id")
    train = materialize(train.select("id", "x").withColumn("_r", F.row_number().over(same)).filter(F.col("_r") <= k).drop("_r"))
    asked = materialize(distinct_points(query.select("id", "x")))
    found = compare(blocks(asked.select("id", "x"), rows), blocks(train, rows), k)
    return (
        query.select("id", "x", _hash().alias("_h")).join(asked.select(_hash().alias("_h"), "x", F.col("id").alias("_asked")), ["_h", "x"])
        .select("id", "_asked").join(found.withColumnRenamed("id", "_asked"), "_asked")
        .select("id", "neighbour", "distance", "place")
    )


def compare(query: Blocks, train: Blocks, k: int, weighted: bool = False) -> DataFrame:
    """(id, neighbour, distance, place) of the k nearest; `weighted` by the payload `weight` as Ward's costs, each point without itself."""
    spark = query.packed.sparkSession
    ship_package(spark)
    pairs = _near_pairs(query, train, k + 1 if weighted else k, weighted)
    extra = ["weight"] if weighted else []
    q = query.packed.select(F.col("block").alias("a"), F.col("ids").alias("q_ids"), F.col("xs").alias("q_xs"), *[F.col(c).alias(f"q_{c}") for c in extra])
    t = train.packed.select(F.col("block").alias("b"), F.col("ids").alias("t_ids"), F.col("xs").alias("t_xs"), *[F.col(c).alias(f"t_{c}") for c in extra])
    n_q, n_t = _tasks(spark, query.count), _tasks(spark, train.count)
    dealt = t.repartition(n_t, "b")
    first = pairs.groupBy("a").agg(F.min(F.struct("near", "far", "b"))["b"].alias("b"))
    bounds = materialize(first.join(q, "a").repartition(n_t, "b").join(dealt, "b").mapInPandas(_bounds(k, weighted), "a bigint, bound array<double>"))
    boxes = train.level(0).select(F.col("node").alias("b"), "lows", "highs", "least")
    met = pairs.join(boxes, "b").groupBy("a").agg(F.collect_list(F.struct("b", "lows", "highs", "least")).alias("m"))
    met = met.select("a", F.col("m.b").alias("b"), F.flatten("m.lows").alias("lows"), F.flatten("m.highs").alias("highs"), F.col("m.least").alias("least"))
    asked = q.join(bounds, "a").repartition(n_q, "a").join(met, "a")
    asked = asked.mapInPandas(_asking(weighted), "b bigint, q_ids array<bigint>, q_xs array<double>, bound array<double>" + ", q_weight array<double>" * weighted)
    local = asked.repartition(n_t, "b").join(dealt, "b").mapInPandas(_nearest_in_pair(k, weighted), "id bigint, neighbour bigint, squared double")
    if weighted:
        local = local.where(F.col("squared") < float("inf"))
    best = Window.partitionBy("id").orderBy("squared", "neighbour")
    placed = local.withColumn("place", F.row_number().over(best)).filter(F.col("place") <= k)
    return placed.select("id", "neighbour", (F.col("squared") if weighted else F.sqrt("squared")).alias("distance"), "place")


def k_distance(points: DataFrame, k: int = 4, rows: int = BLOCK_ROWS) -> DataFrame:
    """Distance to the k-th nearest row, the row itself being the first: (id, k_distance).

    Distinct points carry their number of copies, so a point with k copies has distance 0 at once.
    """
    unique = materialize(distinct_points(points.select("id", "x")))
    packed = blocks(unique.select("id", "x"), rows)
    found = compare(packed, packed, k)
    weight = unique.select(F.col("id").alias("neighbour"), "weight")
    upto = Window.partitionBy("id").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    reached = found.join(weight, "neighbour").withColumn("upto", F.sum("weight").over(upto)).filter(F.col("upto") >= k)
    per_point = reached.groupBy("id").agg(F.min("distance").alias("k_distance"))
    per_x = unique.select("id", "x").join(per_point, "id").select(_hash().alias("_h"), "x", "k_distance")
    return points.select("id", "x", _hash().alias("_h")).join(per_x, ["_h", "x"]).select("id", "k_distance")


def _members(clusters, weights) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Per cluster of a block its name, where its points stand, and their weights."""
    clusters, weights = np.asarray(clusters), np.asarray(weights, float)
    return [(int(c), at := np.flatnonzero(clusters == c), weights[at]) for c in np.unique(clusters)]


def _to_clusters(ids, x, own, other_x, other, weight, size, rows: int):
    """Distances of points to the many clusters of another block. A cluster that lies wholly in that block is done there: only the
    least mean over those leaves (as cluster -1), beside the sums to the point's own cluster and to clusters that go on elsewhere."""
    order = np.argsort(other, kind="stable")
    names, first = np.unique(other[order], return_index=True)
    weight, size, other_x = weight[order], size[order][first], other_x[order]
    whole = np.add.reduceat(weight, first) == size
    split = np.flatnonzero(~whole)
    for i in range(0, len(ids), max(1, min(rows, BATCH_NUMBERS // len(order)))):
        some = slice(i, i + max(1, min(rows, BATCH_NUMBERS // len(order))))
        total = np.add.reduceat(np.sqrt(_squared(x[some], other_x)) * weight, first, axis=1)
        at = np.minimum(np.searchsorted(names, own[some]), len(names) - 1)
        here = np.flatnonzero((names[at] == own[some]) & whole[at])
        yield pd.DataFrame({"id": ids[some][here], "other": own[some][here], "total": total[here, at[here]]})
        for c in split:
            yield pd.DataFrame({"id": ids[some], "other": names[c], "total": total[:, c]})
        mean = np.where(whole, total / size, np.inf)
        mean[here, at[here]] = np.inf
        least = mean.min(axis=1)
        found = np.isfinite(least)
        yield pd.DataFrame({"id": ids[some][found], "other": -1, "total": least[found]})


def silhouette(df: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """Mean silhouette under Euclidean distance, noise (-1) left out, NULL with fewer than two clusters.

    A mean of plain distances has no closed form, so the arithmetic is quadratic in the distinct points;
    blocks keep each task bounded, and each block pair of few clusters is compared once for both sides. Where clusters are many, as
    of a DBSCAN, those inside one block are settled there, so that rows that leave it grow with the points and not with points
    times clusters. For tables where it is too much, `silhouette_squared` needs the clusters' centres only. Input columns: id, cluster, x.
    """
    df = df.filter("cluster <> -1")
    unique = df.groupBy("x", "cluster").agg(F.min("id").alias("id"), F.count("*").cast("double").alias("weight"))
    sizes = df.groupBy("cluster").agg(F.count("*").alias("size"))
    none = df.sparkSession.createDataFrame([(None,)], "silhouette double")
    if sizes.limit(2).count() < 2:
        return none
    spark = df.sparkSession
    ship_package(spark)
    unique = materialize(unique.join(sizes, "cluster"))
    # What is moved falls with the size of a block, so blocks grow with the table up to a bound in bytes; tasks compare `rows` points at a time.
    n, d = unique.agg(F.count("*"), F.max(F.size("x"))).first()
    cut = blocks(unique.select("id", "x", "cluster", "weight", "size"), max(rows, min(n // SPREAD, BLOCK_NUMBERS // d)), ("cluster", "weight", "size"))
    g, tasks = cut.count, _tasks(spark, cut.count)
    packed = cut.packed.withColumn("at", F.col("block"))
    cols = ("ids", "xs", "cluster", "weight", "size")
    # each pair once, and each block with the same number of others
    steps = F.expr(f"sequence(0L, if(at < {g - g // 2}, {g // 2}L, {(g - 1) // 2}L))")
    others = packed.select("at", F.explode(F.transform(steps, lambda s: (F.col("at") + s) % g)).alias("other"), *[F.col(c).alias(f"l_{c}") for c in cols])
    left = others.repartition(tasks, "other")
    right = packed.select(F.col("at").alias("other"), *[F.col(c).alias(f"r_{c}") for c in cols]).repartition(tasks, "other")

    def sums(batches):
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                l_ids, r_ids = np.asarray(r.l_ids), np.asarray(r.r_ids)
                l_x, r_x = _matrix(r.l_xs, len(l_ids)), _matrix(r.r_xs, len(r_ids))
                if max(len(np.unique(c)) for c in (r.l_cluster, r.r_cluster)) > FEW_CLUSTERS:
                    l, o = ((ids, x, *(np.asarray(v) for v in more)) for ids, x, more in ((l_ids, l_x, (r.l_cluster, r.l_weight, r.l_size)), (r_ids, r_x, (r.r_cluster, r.r_weight, r.r_size))))
                    for p, q in ((l, o), (o, l))[: 1 if r.at == r.other else 2]:
                        yield from _to_clusters(*p[:3], *q[1:], rows)
                    continue
                l_inside, r_inside = (_members(c, w) for c, w in ((r.l_cluster, r.l_weight), (r.r_cluster, r.r_weight)))
                l_total, r_total = np.zeros((len(r_inside), len(l_ids))), np.zeros((len(l_inside), len(r_ids)))
                for i in range(0, len(l_ids), rows):
                    dist = np.sqrt(_squared(l_x[i : i + rows], r_x))
                    for total, (_, at, weight) in zip(l_total, r_inside):
                        total[i : i + rows] = dist[:, at] @ weight
                    if r.at != r.other:
                        for total, (_, at, weight) in zip(r_total, l_inside):
                            here = slice(*np.searchsorted(at, (i, i + rows)))
                            total += weight[here] @ dist[at[here] - i]
                for ids, inside, totals in ((l_ids, r_inside, l_total), (r_ids, l_inside, r_total))[: 1 if r.at == r.other else 2]:
                    for (c, _, _), total in zip(inside, totals):
                        yield pd.DataFrame({"id": ids, "other": c, "total": total})

    partial = left.join(right, "other").mapInPandas(sums, "id bigint, other int, total double")
    totals = partial.groupBy("id", "other").agg(F.sum("total").alias("total"), F.min("total").alias("least"))
    to = totals.join(sizes.select(F.col("cluster").cast("int").alias("other"), F.col("size").alias("other_size")), "other", "left")
    own = F.col("other") == F.col("cluster")
    per_point = to.join(unique.select("id", "cluster", "weight", "size"), "id").groupBy("id").agg(
        F.max("weight").alias("weight"), F.max("size").alias("size"),
        F.max(F.when(own, F.try_divide("total", F.col("size") - 1))).alias("a"),
        F.min(F.when(F.col("other") == -1, F.col("least")).when(~own, F.col("total") / F.col("other_size"))).alias("b"),
    )
    score = F.when(F.col("size") > 1, F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))).otherwise(0.0)
    return per_point.agg((F.sum(score * F.col("weight")) / F.sum("weight")).alias("silhouette"))


def knn_scores(train: DataFrame, test: DataFrame, k: int = 21) -> DataFrame:
    """Share of positive rows among the k nearest: (id, score). `train` also has `label`."""
    found = nearest(test, train, k)
    labels = train.select(F.col("id").alias("neighbour"), F.col("label").cast("double").alias("label"))
    return found.join(labels, "neighbour").groupBy("id").agg(F.avg("label").alias("score"))
