import numpy as np
import pytest
from pyspark.sql import functions as F

from custlens.operators import anomaly, cluster_metrics, dbscan, hierarchy, neighbours, segments
from custlens.runtime import materialize


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(0)
    p = np.round(np.concatenate([rng.normal(0, 0.4, (260, 3)), rng.normal(3, 0.5, (240, 3))]), 2)
    p[:170] = p[0]  # a third of the rows are copies of one point
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(p)], "id bigint, x array<double>")
    from custlens.runtime import materialize

    return p, np.sqrt(((p[:, None] - p[None]) ** 2).sum(-1)), materialize(df)


@pytest.mark.parametrize("rows", [2048, 60])
def test_neighbours_match_brute_force(cloud, rows):
    p, dist, df = cloud
    got = neighbours.k_distance(df, 4, rows).orderBy("id").toPandas()
    assert np.allclose(got["k_distance"], np.sort(dist, 1)[:, 3])
    near = neighbours.nearest(df, df, 5, rows).orderBy("id", "place").toPandas()
    assert len(near) == 5 * len(p) and np.allclose(near["distance"].to_numpy().reshape(-1, 5), np.sort(dist, 1)[:, :5])


def brute_silhouette(dist, labels):
    out = []
    for i, c in enumerate(labels):
        own = labels == c
        a = dist[i][own].sum() / (own.sum() - 1)
        b = min(dist[i][labels == o].mean() for o in set(labels) if o != c)
        out.append((b - a) / max(a, b))
    return np.mean(out)


@pytest.mark.parametrize("rows", [2048, 60])
def test_silhouettes(cloud, rows):
    p, dist, df = cloud
    labels = (p[:, 0] > 1.5).astype(int) + (p[:, 1] > 3.2)
    marked = df.withColumn("cluster", (F.col("x")[0] > 1.5).cast("int") + (F.col("x")[1] > 3.2).cast("int"))
    assert neighbours.silhouette(marked, rows).first()[0] == pytest.approx(brute_silhouette(dist, labels))
    assert cluster_metrics.silhouette_squared(marked).first()[0] == pytest.approx(brute_silhouette(dist**2, labels))
    assert neighbours.silhouette(df.withColumn("cluster", F.lit(0))).first()[0] is None


def test_silhouette_blocks_grow_with_the_table(cloud, monkeypatch):
    """The blocks that are moved grow with the table; each pair of them, of an even or odd number, counts once."""
    p, dist, df = cloud
    labels = (p[:, 0] > 1.5).astype(int)
    marked = df.withColumn("cluster", (F.col("x")[0] > 1.5).cast("int"))
    used, cut = [], neighbours.blocks
    monkeypatch.setattr(neighbours, "blocks", lambda points, rows, *rest: used.append(cut(points, rows, *rest)) or used[-1])
    for spread in (4, 5):
        monkeypatch.setattr(neighbours, "SPREAD", spread)
        assert neighbours.silhouette(marked, 7).first()[0] == pytest.approx(brute_silhouette(dist, labels))
    assert {u.count % 2 for u in used} == {0, 1} and max(u.count for u in used) <= 6


def brute_dbscan(dist, eps, m):
    near = dist <= eps
    core = near.sum(1) >= m
    labels, c = -np.ones(len(dist), int), 0
    for i in range(len(dist)):
        if labels[i] != -1 or not core[i]:
            continue
        stack = [i]
        while stack:
            j = stack.pop()
            if labels[j] == -1:
                labels[j] = c
                if core[j]:
                    stack.extend(np.nonzero(near[j] & (labels == -1))[0])
        c += 1
    return labels, core


@pytest.mark.parametrize("eps,m", [(0.2503, 5), (0.4007, 9)])
def test_dbscan_matches_brute_force(cloud, eps, m):
    _, dist, df = cloud
    labels, core = brute_dbscan(dist, eps, m)
    got = dbscan.dbscan(df, eps, m).orderBy("id").toPandas()
    assert (got["cluster"].to_numpy() == labels).all() and (got["core"].to_numpy() == core).all()


def test_dbscan_salts_a_crowded_cell(cloud, monkeypatch):
    _, dist, df = cloud
    monkeypatch.setattr(dbscan, "SALT_ROWS", 10)
    labels, _ = brute_dbscan(dist, 0.3003, 6)
    assert (dbscan.dbscan(df, 0.3003, 6).orderBy("id").toPandas()["cluster"].to_numpy() == labels).all()


def test_dbscan_of_copies_alone(spark):
    """More copies than the k-distance asks for make eps 0: each point with enough copies is a cluster."""
    rows = [(i, [float(i // 6), 1.0]) for i in range(18)] + [(20, [9.0, 9.0]), (21, [9.0, 9.0])]
    df = materialize(spark.createDataFrame(rows, "id bigint, x array<double>"))
    assert segments.eps_heuristic(df, 4, 0.5) == 0
    got = {r["id"]: (r["cluster"], r["core"]) for r in dbscan.dbscan(df, 0.0, 5).collect()}
    assert got == {i: (i // 6, True) for i in range(18)} | {20: (-1, False), 21: (-1, False)}


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (102, 101)]
    got = {r["node"]: r["root"] for r in dbscan.components(spark.createDataFrame(chain, "u bigint, v bigint")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[i] for i in (100, 101, 102)} == {100}


def test_kmeans_is_label_stable(cloud):
    p, dist, df = cloud
    labelled, inertia = segments.kmeans(df, 2, seed=1, restarts=2)
    got = labelled.orderBy("id").toPandas()["cluster"].to_numpy()
    centers = np.array([p[got == c].mean(0) for c in (0, 1)])
    assert centers[0][0] > centers[1][0]
    assert inertia == pytest.approx(sum(((p[got == c] - centers[c]) ** 2).sum() for c in (0, 1)))
    again, _ = segments.kmeans(df.repartition(3), 2, seed=7, restarts=2)
    assert (again.orderBy("id").toPandas()["cluster"].to_numpy() == got).all()


def plain_ward(x, weight):
    """Merges (height, size), the globally nearest pair each time, and the labels at two clusters."""
    x, weight = x.copy(), np.array(weight, float)
    groups, out, two = [[i] for i in range(len(x))], [], None
    gap = ((x[:, None] - x[None]) ** 2).sum(-1)
    while len(groups) > 1:
        if len(groups) == 2:
            two = [list(g) for g in groups]
        cost = gap * (weight[:, None] * weight[None] / (weight[:, None] + weight[None]))
        np.fill_diagonal(cost, np.inf)
        i, j = sorted(divmod(int(cost.argmin()), len(groups)))
        out.append((np.sqrt(2 * cost[i, j]), weight[i] + weight[j]))
        x[i] = (x[i] * weight[i] + x[j] * weight[j]) / (weight[i] + weight[j])
        weight[i] += weight[j]
        groups[i] += groups.pop(j)
        x, weight = np.delete(x, j, 0), np.delete(weight, j)
        gap = np.delete(np.delete(gap, j, 0), j, 1)
        gap[i] = gap[:, i] = ((x - x[i]) ** 2).sum(1)
    return out, two


def check_ward(spark, x, copies, rows, last):
    ids = np.cumsum(copies) - copies
    table = [(int(ids[i] + c), [float(v) for v in x[i]]) for i in range(len(x)) for c in range(copies[i])]
    labelled, merges = hierarchy.ward(materialize(spark.createDataFrame(table, "id bigint, x array<double>")), 2, rows, last)
    got = merges.orderBy("step").toPandas()
    want, two = plain_ward(x, copies)
    assert np.allclose(sorted(got["height"]), [h for h, _ in want]) and sorted(got["size"]) == pytest.approx(sorted(s for _, s in want))
    assert sorted([*got["left"], *got["right"]]) == list(range(2 * len(x) - 2)) and (got["left"] < got["right"]).all() and (got["right"] < len(x) + got["step"]).all()
    sets = labelled.join(spark.createDataFrame([(int(v), i) for i, v in enumerate(ids)], "id bigint, i int"), "id").groupBy("cluster").agg(F.collect_list("i").alias("i"), F.avg(F.col("x")[0]).alias("m")).orderBy("cluster").collect()
    assert {frozenset(r["i"]) for r in sets} == {frozenset(g) for g in two} and sets[0]["m"] > sets[1]["m"]
    assert labelled.count() == copies.sum()


def test_ward_in_rounds_equals_plain_ward(spark):
    """Every merge by a distributed round, over several blocks."""
    rng = np.random.default_rng(1)
    check_ward(spark, rng.normal(size=(150, 3)), rng.integers(1, 4, 150), 20, 1)


@pytest.mark.parametrize("n", [800, 3000])
def test_ward_of_many_points(spark, n):
    rng = np.random.default_rng(n)
    x = np.concatenate([rng.normal(0, 1, (n // 2, 2)), rng.normal(4, 1, (n - n // 2, 2))])
    check_ward(spark, x, np.ones(n, int), 256, 300)


def test_ward_of_few_points(spark):
    df = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "id bigint, x array<double>")
    labelled, merges = hierarchy.ward(df, 2)
    assert {r["cluster"] for r in labelled.collect()} == {0} and merges.count() == 0
    grid = spark.createDataFrame([(i, [float(i % 6), float(i // 6)]) for i in range(36)], "id bigint, x array<double>")
    labelled, merges = hierarchy.ward(grid, 3, 5, 4)  # many equal costs
    assert merges.count() == 35 and labelled.select("cluster").distinct().count() == 3


def test_pairs_of_blocks_are_pruned(cloud):
    """No box goes to the driver: pairs are equi-joins on the parent box, and far blocks never meet."""
    p, _, df = cloud
    cut = neighbours.blocks(neighbours.distinct_points(df).select("id", "x"), 5)
    assert cut.height == 2 and cut.level(1).agg(F.sum("n")).first()[0] == len(np.unique(p, axis=0)) == cut.packed.agg(F.sum("n")).first()[0]
    pairs = neighbours._near_pairs(cut, cut, 4)
    assert pairs.count() < 0.6 * cut.count**2 and cut.packed.agg(F.max("n")).first()[0] == 5
    plan = neighbours.compare(cut, cut, 4)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_comparisons_are_dealt_to_tasks(spark):
    """One-hot patterns come together in blocks, and the comparison does not end in one task when its rows are few."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(240, 2)), np.eye(4)[rng.integers(0, 4, 240)]], axis=1)
    df = materialize(spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id bigint, x array<double>"))
    cut = neighbours.blocks(df, 20)
    mixed = cut.packed.where("exists(sequence(2, 5), j -> lows[j] < highs[j])").count()
    assert cut.packed.count() == 12 and mixed <= 3
    found = neighbours.compare(cut, cut, 3)
    assert found.count() == 720 and "REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    got = found.orderBy("id", "place").toPandas()["distance"].to_numpy().reshape(-1, 3)
    assert np.allclose(got, np.sort(np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)), 1)[:, :3])


def test_reconstruction(spark, supervised):
    features = supervised.drop("churn")
    losses = {r["bottleneck"]: r["loss"] for r in anomaly.loss_curve(features).collect()}
    errors = anomaly.reconstruction_errors(features, 4)
    assert errors.agg(F.avg("reconstruction_error")).first()[0] == pytest.approx(losses[4], rel=1e-6)
    assert anomaly.reconstruction_errors(features, 6).agg(F.max("reconstruction_error")).first()[0] < 1e-9
    assert losses[0] == pytest.approx(1.0) and list(losses.values()) == sorted(losses.values(), reverse=True)


def test_silhouettes_of_a_sweep_read_distinct_points(spark, monkeypatch):
    """Copies count by their weight: the sweep scores 3 distinct points, not 120 rows, and gets what all rows give."""
    from custlens.operators import cluster_metrics

    rows = [(i, [[0.0, 0.0], [0.0, 1.0], [9.0, 9.0]][min(i % 4, 2)]) for i in range(120)]
    points = spark.createDataFrame(rows, "id bigint, x array<double>")
    seen, plain = [], cluster_metrics.silhouette_squared
    monkeypatch.setattr(cluster_metrics, "silhouette_squared", lambda df, *more: seen.append(df.count()) or plain(df, *more))
    (swept,) = segments.k_sweep(points, [2], restarts=2).collect()
    stable = segments.stability(points, 2, seeds=[1], restarts=2).first()
    assert seen == [3, 3]
    labelled, inertia = segments.kmeans(points, 2, restarts=2)
    want = plain(labelled).first()[0]
    assert (swept["silhouette"], swept["inertia"], stable["silhouette"]) == pytest.approx((want, inertia, want), rel=1e-12)
    assert stable["cluster_sizes"] == [60, 60]


def test_silhouette_of_many_clusters_leaves_few_rows(spark, monkeypatch):
    """Clusters inside one block are settled there: what leaves the comparison does not grow with points times clusters."""
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(size=(240, 3)), 3)
    names = np.concatenate([np.arange(240 - 60) // 2 + 5, np.full(40, 3), np.full(20, -1)])
    rows = [(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, names))]
    df = spark.createDataFrame(rows + [(1000, x[0].tolist(), int(names[0]))], "id bigint, x array<double>, cluster int")
    kept = np.concatenate([names != -1, [True]])
    points, labels = np.vstack([x, x[:1]])[kept], np.append(names, names[0])[kept]
    dist = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    monkeypatch.setattr(neighbours, "FEW_CLUSTERS", 8)
    left, plain = [], neighbours._to_clusters
    monkeypatch.setattr(neighbours, "_to_clusters", lambda *a: (left.append(sum(map(len, found := list(plain(*a))))), iter(found))[1])
    assert neighbours.silhouette(df, 60).first()[0] == pytest.approx(brute_silhouette(dist, labels))
    ids = np.arange(60)
    sent = sum(map(len, plain(ids, x[:60], names[:60], x[60:120], names[60:120], np.ones(60), np.full(60, 2), 16)))
    assert sent == 60  # 60 points and 30 clusters: one row a point


def test_indices_of_many_clusters(spark):
    """Rows against all of many clusters are arrays of bounded size, with the values of the expressions for few."""
    rng = np.random.default_rng(9)
    names = np.concatenate([np.arange(100), np.arange(100), np.arange(60)])
    x = rng.normal(size=(len(names), 2))
    df = spark.createDataFrame([(i, v.tolist(), int(c), 1.0) for i, (v, c) in enumerate(zip(x, names))], "id bigint, x array<double>, cluster int, w double")
    dist = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    plan = cluster_metrics.silhouette_squared(df)._jdf.queryExecution().toString()
    assert "MapInPandas" in plan
    assert cluster_metrics.silhouette_squared(df).first()[0] == pytest.approx(brute_silhouette(dist, names))
    assert cluster_metrics.silhouette_squared(df, "w").first()[0] == pytest.approx(brute_silhouette(dist, names))
    center = np.array([x[names == c].mean(axis=0) for c in np.unique(names)])
    scatter = np.array([np.sqrt(((x[names == c] - m) ** 2).sum(axis=1)).mean() for c, m in zip(np.unique(names), center)])
    apart = np.sqrt(((center[:, None] - center[None]) ** 2).sum(axis=2))
    np.fill_diagonal(apart, np.inf)
    worst = ((scatter[:, None] + scatter[None]) / apart).max(axis=1)
    assert cluster_metrics.davies_bouldin(df).first()[0] == pytest.approx(worst.mean())


def test_few_edges_are_one_task(spark, monkeypatch):
    """Components of a small graph need no rounds of joins, and equal those of the rounds."""
    rng = np.random.default_rng(10)
    df = spark.createDataFrame([(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))], "u bigint, v bigint")
    one = dbscan.components(df)
    assert "MapInPandas" in one._jdf.queryExecution().toString()
    found = sorted(map(tuple, one.collect()))
    monkeypatch.setattr(dbscan, "LAST_EDGES", 0)
    assert found == sorted(map(tuple, dbscan.components(df).collect()))


def test_ward_in_one_task_holds_some_rows_of_the_costs(monkeypatch):
    rng = np.random.default_rng(11)
    x, w = rng.normal(size=(90, 3)), rng.integers(1, 5, 90).astype(float)
    whole = [m.to_numpy() for m in hierarchy._mutual(np.arange(90), x.copy(), w.copy(), np.zeros(90))]
    shapes, plain = [], hierarchy._squared
    monkeypatch.setattr(hierarchy, "TILE_CELLS", 500)
    monkeypatch.setattr(hierarchy, "_squared", lambda a, b: shapes.append(len(a) * len(b)) or plain(a, b))
    tiled = [m.to_numpy() for m in hierarchy._mutual(np.arange(90), x.copy(), w.copy(), np.zeros(90))]
    assert max(shapes) <= 500 and all(np.array_equal(a, b) for a, b in zip(whole, tiled))


def test_points_are_written_before_they_are_cut_into_blocks(spark, monkeypatch):
    """Both sides of a search are read many times: what makes them runs once."""
    seen, cut = [], neighbours.blocks
    monkeypatch.setattr(neighbours, "blocks", lambda points, *rest: seen.append(points._jdf.queryExecution().optimizedPlan().toString()) or cut(points, *rest))
    df = spark.createDataFrame([(i, [float(i % 7), float(i // 7)]) for i in range(40)], "id bigint, x array<double>")
    assert neighbours.nearest(df, df, 3).count() == 120
    assert len(seen) == 2 and not any("Window" in p or "Aggregate" in p for p in seen)


def test_lloyd_steps_read_points_as_columns(spark):
    df = spark.createDataFrame([([0.0, 1.0], 2.0), ([3.0, 1.0], 1.0), ([1.0, 1.0], 1.0)], "x array<double>, weight double")
    step = segments.lloyd_sums(df, {0: np.array([[0.0, 1.0], [2.0, 1.0]])})  # the last point is as near to both: the first has it
    assert "MapInArrow" in step._jdf.queryExecution().toString()
    assert sorted((r["cluster"], r["n"], r["cost"], r["total"]) for r in step.collect()) == [(0, 3.0, 1.0, [1.0, 3.0]), (1, 1.0, 1.0, [3.0, 1.0])]


def test_grand_mean_is_computed_once(spark, monkeypatch):
    """Not again for each cluster: it is written beside the clusters."""
    seen, plain = [], cluster_metrics.materialize
    monkeypatch.setattr(cluster_metrics, "materialize", lambda df: seen.append(df.columns) or plain(df))
    df = spark.createDataFrame([(0, [0.0]), (0, [2.0]), (1, [10.0]), (1, [12.0])], "cluster int, x array<double>")
    assert cluster_metrics.calinski_harabasz(df).first()[0] == pytest.approx(50.0)
    assert any("mean" in c for c in seen)
