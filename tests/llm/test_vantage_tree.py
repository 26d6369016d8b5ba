"""Vantage-point search against brute force."""

import numpy as np
import pytest

from custlens.llm import queries as q
from custlens.llm import vantage_tree as vt


def brute(rows, asked, k):
    """(query, rank) -> (id, score) with the same row-wise arithmetic."""
    out = {}
    for i in asked:
        for a in [np.array(v, float) for j, v in rows if j == i]:
            got = {}
            for j, v in rows:
                if j != i and len(v) == len(a):
                    b = np.array(v, float)
                    got.setdefault(j, []).append((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())))
            flat = sorted(((-s, j) for j, ss in got.items() for s in ss))[:k]
            out[i] = [(j, -s) for s, j in flat]
    return out


def test_tree_is_exact_at_factor_one():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(1500, 3))
    points /= np.linalg.norm(points, axis=1)[:, None]
    queries = points[:200]
    tree = vt.build(points)
    assert (tree.inside >= 0).sum() > 10 and sorted(tree.order) == list(range(1500))
    want = np.sort(vt.distances(queries, points), axis=1)[:, :6]
    full = vt.search(tree, queries, 6, 1.0)
    near = [sorted(vt.distances(queries[i : i + 1], points[full[1][full[0] == i]])[0])[:6] for i in range(200)]
    assert np.allclose(near, want, atol=1e-7)
    loose = vt.search(tree, queries, 6, 0.2)
    hits = np.mean([len(set(loose[1][loose[0] == i]) & set(full[1][full[0] == i])) / 6 for i in range(200)])
    assert 0.5 < hits <= 1.0


def test_op9_equals_brute_force(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in q.table(spark, folder, "embeddings").collect()]
    want = brute(rows, [i for i, _ in rows if i % 50 == 0], 5)
    got = q.QUERIES["op9_vantage_trees"](spark, folder).collect()
    recall = np.mean([(r.query_id, r["rank"]) in {(i, n + 1) for i in want for n, (j, _) in enumerate(want[i]) if j == r.vec_id} for r in got])
    assert len(got) == sum(map(len, want.values())) and recall >= 0.9
    for r in got:
        assert r.score == pytest.approx(dict(want[r.query_id]).get(r.vec_id, r.score), abs=1e-15)


def test_many_shards_ties_and_bad_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.integers(-1, 2, size=(400, 4))) if any(v)]
    rows += [(1000 + i, [1.0, 0.0, 0.0, 0.0]) for i in range(300)] + [(2000, [1.0, 0.0, 0.0, 0.0])] * 2 + [(3000, [1.0, 2.0])]
    bad = [(None, [1.0] * 4), (4000, None), (4001, []), (4002, [0.0] * 4), (4003, [float("nan")] * 4), (4004, [float("inf"), 1.0, 1.0, 1.0]), (4005, [None, 1.0, 1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows + bad], "vec_id long, embedding array<double>, shard int")
    usable = vt.usable(df, "vec_id", "embedding")
    asked = [0, 50, 100, 1000, 2000, 3000, 4002]
    got = vt.neighbours(vt.build_index(usable, 5, 100), usable.where(usable.id.isin(asked)), 5, query_rows=3).collect()
    want = brute(sorted({(i, tuple(v)) for i, v in rows}), [i for i in asked if i < 4000 and any(j == i for j, _ in rows)], 5)
    for i, near in want.items():
        assert [(r.vec_id, r.score) for r in sorted((r for r in got if r.query_id == i), key=lambda r: r["rank"])] == near
    assert {r.query_id for r in got} == {i for i in want if want[i]}
    none = usable.where("false")
    assert vt.neighbours(vt.build_index(none, 5), none, 5).count() == 0
