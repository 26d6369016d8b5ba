"""Density clustering on a grid: exact DBSCAN without listing pairs inside dense cells.

The cell side is eps / sqrt(d), so all points of one cell are within eps of each other. A cell that holds
`min_samples` rows is therefore all core and one connected piece, however many rows it has; only sparse
cells need neighbour counts. Dense neighbouring cells are compared through boxes that are refined until
every pair is decided. Labels: 0, 1, .. by smallest core id; a border row takes the lowest reachable
label; -1 is noise. Meant for few dimensions: a cell has up to 5^3 neighbours in three. With eps = 0 (more than one copy of
most rows makes the k-distance 0) only copies are near each other, and each distinct point is a cell.
"""

from __future__ import annotations

import itertools
import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.ordering import global_rank
from custlens.operators.cluster_metrics import squared_distance
from custlens.operators.neighbours import distinct_points
from custlens.runtime import materialize, ship_package

SALT_ROWS = 5_000
LAST_EDGES = 1 << 17


def _offsets(d: int) -> list[list[int]]:
    """Offsets of cells that can hold a point within eps of this cell."""
    reach = math.ceil(math.sqrt(d))
    return [list(o) for o in itertools.product(range(-reach, reach + 1), repeat=d) if sum(max(abs(v) - 1, 0) ** 2 for v in o) <= d]


def _cell(x: Column | str, side: float) -> Column:
    return F.transform(x, lambda v: F.floor(v / F.lit(side)).cast("bigint"))


def _near_cells(cell: str, offsets: list[list[int]]) -> Column:
    return F.transform(F.lit(offsets), lambda o: F.zip_with(F.col(cell), o, lambda a, b: a + b))


def _salted(points: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points with a salt inside crowded cells, and the number of salts per cell."""
    salts = points.groupBy("cell").agg(F.ceil(F.count("*") / F.lit(SALT_ROWS)).cast("int").alias("salts"))
    salted = points.join(salts, "cell").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    return salted.drop("salts"), salts


def _within(asking: DataFrame, targets: DataFrame, offsets, eps: float, *columns: str) -> DataFrame:
    """Rows (id, target columns) for targets within eps of each asking point, by an equi-join on (cell, salt)."""
    salted, salts = _salted(targets)
    near = asking.select(F.col("id").alias("asker"), F.col("x").alias("ax"), F.explode(_near_cells("cell", offsets)).alias("cell"))
    near = near.join(salts, "cell").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    joined = near.join(salted.select("cell", "salt", "x", *columns), ["cell", "salt"])
    return joined.filter(squared_distance("ax", "x") <= F.lit(eps * eps)).select(F.col("asker").alias("id"), *columns)


def core_points(points: DataFrame, eps: float, min_samples: int = 5) -> DataFrame:
    """Distinct points (x, id, weight, cell, core); a row counts itself and its copies."""
    if eps == 0:
        return materialize(distinct_points(points.select("id", "x")).select("x", "id", "weight", F.array("id").alias("cell"), (F.col("weight") >= min_samples).alias("core")))
    d = points.select(F.size("x")).first()[0]
    side = eps / math.sqrt(d)
    unique = materialize(distinct_points(points.select("id", "x")).withColumn("cell", _cell("x", side)))
    crowd = unique.groupBy("cell").agg(F.sum("weight").alias("crowd"))
    placed = unique.join(crowd, "cell")
    sparse = placed.filter(F.col("crowd") < min_samples)
    counted = _within(sparse, unique, _offsets(d), eps, "weight").groupBy("id").agg(F.sum("weight").alias("reach"))
    flagged = placed.join(counted, "id", "left")
    core = (F.col("crowd") >= min_samples) | (F.coalesce("reach", F.lit(0)) >= min_samples)
    return materialize(flagged.select("x", "id", "weight", "cell", core.alias("core")))


def _boxes(core: DataFrame, side: float, level: int, d: int) -> DataFrame:
    """Boxes of core points at a level of halving: per (node, sub-cell) the extent, one member and the count."""
    at = _cell("x", side / 2**level)
    return core.groupBy("node", at.alias("sub")).agg(
        F.array(*[F.min(F.col("x")[j]) for j in range(d)]).alias("low"), F.array(*[F.max(F.col("x")[j]) for j in range(d)]).alias("high"),
        F.min("x").alias("member"), F.count("*").alias("n"),
    )


def _connected_cells(core: DataFrame, cells: DataFrame, eps: float, side: float, d: int) -> DataFrame:
    """Edges (u, v) between neighbouring core cells that have a core pair within eps.

    Box pairs are accepted when their members are within eps, dropped when even the boxes are not, and
    halved otherwise. A box of one point is decided exactly, so the loop ends; each round keeps only
    node pairs still open, and a node pair leaves as soon as one of its box pairs is accepted.
    """
    other = cells.select(F.col("cell").alias("near"), F.col("node").alias("v"))
    pairs = cells.select(F.col("node").alias("u"), F.explode(_near_cells("cell", _offsets(d))).alias("near")).join(other, "near")
    open_pairs = materialize(pairs.filter("u < v").select("u", "v"))
    edges, level, parents = [], 0, None
    gap = F.zip_with(
        F.zip_with("a_low", "b_high", lambda p, q: p - q), F.zip_with("b_low", "a_high", lambda p, q: p - q),
        lambda p, q: F.greatest(p, q, F.lit(0.0)),
    )
    gap2 = F.aggregate(gap, F.lit(0.0), lambda s, v: s + v * v)
    while not open_pairs.isEmpty():
        used = open_pairs.select(F.col("u").alias("node")).union(open_pairs.select(F.col("v").alias("node"))).distinct()
        boxes = materialize(_boxes(core.join(used, "node", "left_semi"), side, level, d))
        parent = F.transform("sub", lambda v: F.floor(v / 2).cast("bigint"))
        box = {s: boxes.select(F.col("node").alias(n), F.col("sub").alias(f"{s}_sub"), *[F.col(c).alias(f"{s}_{c}") for c in ("low", "high", "member", "n")],
                               parent.alias(f"{s}_parent")) for s, n in (("a", "u"), ("b", "v"))}
        if parents is None:
            tested = open_pairs.join(box["a"], "u").join(box["b"], "v")
        else:
            tested = parents.join(box["a"], ["u", "a_parent"]).join(box["b"], ["v", "b_parent"])
        tested = tested.filter(gap2 <= F.lit(eps * eps)).withColumn("hit", squared_distance("a_member", "b_member") <= F.lit(eps * eps))
        tested = materialize(tested.select("u", "v", "a_sub", "b_sub", "a_n", "b_n", "hit"))
        linked = tested.filter("hit").select("u", "v").distinct()
        edges.append(linked)
        undecided = tested.filter("not hit and (a_n > 1 or b_n > 1)").join(linked, ["u", "v"], "left_anti")
        parents = undecided.select("u", "v", F.col("a_sub").alias("a_parent"), F.col("b_sub").alias("b_parent"))
        open_pairs = materialize(parents.select("u", "v").distinct())
        level += 1
    if not edges:
        return open_pairs
    out = edges[0]
    for e in edges[1:]:
        out = out.union(e)
    return out


def _linked(batches):
    """(node, root) of the edges of one task: trees of pointers to smaller nodes, which are shortened on the way."""
    up: dict[int, int] = {}

    def root(a: int) -> int:
        while (b := up.setdefault(a, a)) != a:
            up[a] = a = up.setdefault(b, b)
        return a

    for pdf in batches:
        for u, v in zip(pdf["u"].tolist(), pdf["v"].tolist()):
            a, b = root(u), root(v)
            up[max(a, b)] = min(a, b)
    if up:
        yield pd.DataFrame({"node": list(up), "root": [root(a) for a in list(up)]})


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node per node (node, root), by alternating large-star and small-star steps.

    Each step points neighbours at the smallest node in sight, so the number of rounds grows with the
    logarithm of the graph, not with its diameter. Hubs are reduced by a map-side min, never listed. At most `LAST_EDGES` edges are
    one task's.
    """
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct())
    if edges.count() <= LAST_EDGES:
        ship_package(edges.sparkSession)
        return edges.repartition(1).mapInPandas(_linked, "node bigint, root bigint")
    before = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct())
        state = edges.agg(F.count("*").alias("n"), F.sum("v").cast("string").alias("s"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).cast("string").alias("h")).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def dbscan(points: DataFrame, eps: float, min_samples: int = 5) -> DataFrame:
    """Labels (id, cluster, core) of rows (id, x)."""
    d = points.select(F.size("x")).first()[0]
    side = eps / math.sqrt(d)
    flagged = core_points(points, eps, min_samples)
    core = flagged.filter("core")
    if eps == 0:
        ranks = global_rank(core.select("x", "id"), [F.asc("id")], "rank").select("x", (F.col("rank") - 1).cast("int").alias("c"))
        per_x = flagged.join(ranks, "x", "left").select("x", "core", F.coalesce("c", F.lit(-1)).alias("cluster"))
        return points.select("id", "x").join(per_x, "x").select("id", "cluster", "core")
    cells = materialize(core.groupBy("cell").agg(F.min("id").alias("node")))
    core = materialize(core.join(cells, "cell").select("x", "id", "cell", "node"))
    linked = components(_connected_cells(core, cells, eps, side, d))
    rooted = cells.join(linked, "node", "left").select("cell", F.coalesce("root", "node").alias("root"))
    roots = global_rank(rooted.select("root").distinct(), [F.asc("root")], "rank")
    numbered = materialize(rooted.join(roots, "root").select("cell", (F.col("rank") - 1).cast("int").alias("cluster")))
    core = core.join(numbered, "cell")
    border = _within(flagged.filter("not core"), core.select("id", "x", "cell", "cluster"), _offsets(d), eps, "cluster")
    border = border.groupBy("id").agg(F.min("cluster").alias("cluster"))
    labelled = flagged.join(core.select("id", F.col("cluster").alias("c")).union(border), "id", "left")
    per_x = labelled.select("x", "core", F.coalesce("c", F.lit(-1)).alias("cluster"))
    return points.select("id", "x").join(per_x, "x").select("id", "cluster", "core")


def core_flags(points: DataFrame, eps: float, min_samples: int = 5) -> DataFrame:
    """(id, core, noise) of every row; noise = no core row within eps."""
    labels = dbscan(points, eps, min_samples)
    return labels.select("id", F.col("core").cast("int").alias("core"), (F.col("cluster") == -1).cast("int").alias("noise"))
