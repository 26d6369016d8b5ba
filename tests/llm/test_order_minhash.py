"""Banded alignment against plain dynamic programming, and classes against brute force over all pairs."""

import random

import numpy as np
import pytest

from custlens.llm import alignment, order_minhash
from custlens.llm import queries as q

FOLDER = "/root/testdata/sf0.001"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (x != y))
    return row[-1]


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words) + 1)
        kind = rng.randrange(3)
        if kind == 0:
            words.insert(i, "n%d" % rng.randrange(99))
        elif words and kind == 1:
            words.pop(min(i, len(words) - 1))
        elif words:
            words[min(i, len(words) - 1)] = "r%d" % rng.randrange(99)
    return words


def test_distances_equal_plain():
    rng = random.Random(2)
    for _ in range(300):
        a = [rng.randrange(6) for _ in range(rng.randrange(1, 25))]
        b = edited(rng, a, rng.randrange(8)) if rng.random() < 0.7 else [rng.randrange(6) for _ in range(rng.randrange(1, 25))]
        d = plain_distance(a, b)
        x, y = (np.unique(a + b, return_inverse=True)[1][s] for s in (slice(0, len(a)), slice(len(a), None)))
        for band, most in ((0, 9), (1, 1), (3, 3), (3, 40), (30, 30)):
            got = alignment.distance(x, y, band, most)
            if min(band, most) >= d:
                assert got == d
            elif got is not None:
                assert d <= got <= most
            if len(x) and len(y) and abs(len(x) - len(y)) <= band:
                assert alignment._by_rows(x, y, band, most) == got
        s = alignment.similarity(a, b, 0.6)
        assert (s >= 0.6) == (1 - d / max(len(a), len(b)) >= 0.6) and s <= 1 - d / max(len(a), len(b)) + 1e-12
    assert alignment.similarity([], [], 0.8) == 1.0 and alignment.similarity([], ["a"], 0.8) == 0.0


def brute_classes(docs):
    """Smallest id per class over all pairs with edit similarity of at least 0.8."""
    ids = sorted(docs)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    words = {i: (docs[i] or "").encode().split() for i in ids}
    for k, i in enumerate(ids):
        for j in ids[:k]:
            if find(i) != find(j) and ((docs[i] or "") == (docs[j] or "") or words[i] and words[j] and alignment.similarity(words[i], words[j], 0.8) > 0):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i in ids}


def test_op6_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in q.table(spark, FOLDER, "documents").collect()}
    rows = q.QUERIES["op6_order_minhash"](spark, FOLDER).collect()
    assert len(rows) == len(docs)
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(docs)


def test_families_with_a_shared_passage(spark):
    rng = random.Random(6)
    passage = ["p%d" % rng.randrange(500) for _ in range(60)]
    docs, n = {}, 0
    for family in range(6):
        base = ["f%d_%d" % (family, rng.randrange(300)) for _ in range(90)]
        for _ in range(12):
            docs[n] = " ".join(edited(rng, base[:45] + passage + base[45:], rng.randrange(7)))
            n += 1
    for _ in range(30):
        docs[n] = " ".join(["u%d" % rng.randrange(10**6) for _ in range(80)] + passage)
        n += 1
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.id: r.class_id for r in order_minhash.near_duplicates(df).collect()}
    assert got == brute_classes(docs)


def test_order_counts(spark):
    a, b, c = (" ".join("%s%d" % (x, i) for i in range(100)) for x in "abc")
    df = spark.createDataFrame([(1, f"{a} {b} {c}"), (2, f"{c} {b} {a}"), (3, f"{a} {b} {c} end")], "doc_id long, text string")
    assert {r.id: r.class_id for r in order_minhash.near_duplicates(df).collect()} == {1: 1, 2: 2, 3: 1}


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "  "), (4, "a b"), (5, "a b"), (6, "a  b"), (7, "a"), (None, "a b"), (8, "x " * 50_000), (9, "x " * 50_000 + "y"), (10, "m n o p q r"), (10, "totally other words here now ok"), (11, "m n o p q r")]
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, class_id int")
    got = {r.id: r.class_id for r in order_minhash.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 4, 7: 7, 8: 8, 9: 8, 10: 10, 11: 10}
    assert order_minhash.near_duplicates(df.where("false")).count() == 0


def test_contracted_components(spark):
    rng = random.Random(4)
    for n, m in ((60, 20), (60, 45), (40, 120)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)] + [(i, i + 1) for i in range(100, 130)]
        root = {i: i for e in edges for i in e}
        for _ in root:
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
        got = order_minhash.contracted_components(spark.createDataFrame(edges, "u long, v long")).collect()
        alone = {a for a, b in edges if a == b} - {i for a, b in edges if a != b for i in (a, b)}
        assert len(got) == len({r.node for r in got}) and {r.node: r.root for r in got} == {i: r for i, r in root.items() if i not in alone}


def replaced(rng, words, edits, name):
    words = list(words)
    for k, i in enumerate(rng.sample(range(len(words)), edits)):
        words[i] = f"{name}_{k}"
    return words


def test_planted_pairs_are_found(spark):
    """Pairs with words replaced at scattered places: all of them in short texts, 99 % in longer ones."""
    rng, docs, pairs = random.Random(8), {}, {}
    for n, sizes in ((5, 20), (10, 40), (12, 40), (15, 40), (16, 40), (40, 40), (128, 40), (129, 150), (250, 150)):
        for similar in (0.8, 0.85, 0.9):
            for _ in range(sizes):
                base, at = ["w%d" % rng.randrange(10**9) for _ in range(n)], len(docs)
                docs[at], docs[at + 1] = " ".join(base), " ".join(replaced(rng, base, int((1 - similar) * n + 1e-9), f"r{at}"))
                pairs.setdefault((n > order_minhash.SHORT, similar), []).append(at)
    # every fifth word replaced: no run of five words is left
    for n in (10, 15, 60, 125):
        base, at = ["v%d" % rng.randrange(10**9) for _ in range(n)], len(docs)
        docs[at], docs[at + 1] = " ".join(base), " ".join("x%d" % i if i % 5 == 4 else w for i, w in enumerate(base))
        pairs[False, 0.8].append(at)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.id: r.class_id for r in order_minhash.near_duplicates(df).collect()}
    assert all(got[a] in (a, a - 1) for a in got)
    recall = {k: sum(got[a] == got[a + 1] for a in found) / len(found) for k, found in pairs.items()}
    print(recall)
    assert all(v >= (0.99 if long else 1) for (long, _), v in recall.items())


def test_short_texts_equal_brute_force(spark):
    rng, docs = random.Random(9), {}
    for n in (3, 5, 9, 11, 13, 14, 16, 19, 20, 33):
        for family in range(5):
            base = ["s%d_%d_%d" % (n, family, rng.randrange(40)) for _ in range(n)]
            for _ in range(8):
                docs[len(docs)] = " ".join(edited(rng, base, rng.randrange(1 + n // 5)))
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    got = {r.id: r.class_id for r in order_minhash.near_duplicates(df).collect()}
    assert got == brute_classes(docs)


def test_rows_without_id_have_a_class(spark):
    one, two = (" ".join(f"{x}{i}" for i in range(30)) for x in "ab")
    df = spark.createDataFrame([(4, one), (None, one), (None, one + " end"), (None, two), (None, two), (9, "c d e")], "doc_id long, text string")
    got = sorted(((r.id, r.class_id, r.text_id) for r in order_minhash.near_duplicates_of_all(df).collect()), key=str)
    end, other = (next(t for i, c, t in got if i is None and (c == 4) == near and t != 4) for near in (True, False))
    assert got == sorted([(4, 4, 4), (None, 4, 4), (None, 4, end), (None, other, other), (None, other, other), (9, 9, 9)], key=str)
    assert {end, other} <= {10, 11, 12}
