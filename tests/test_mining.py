import itertools
import random

import pytest
from pyspark.sql import functions as F

from custlens.operators import baskets, rules


def found(df):
    return {"".join(r["items"]): r["freq"] for r in df.collect()}


def test_itemsets_golden(baskets6):
    """Six baskets; a support of 0.3 asks for two of them."""
    long = baskets.long_baskets(baskets6)
    want = {"P": 4, "Q": 5, "R": 3, "S": 2, "PQ": 3, "PR": 2, "QR": 3, "QS": 2, "PQR": 2}
    assert found(baskets.frequent_itemsets(long, "apriori", 0.3)) == want
    assert found(baskets.frequent_itemsets(long, "fpgrowth", 0.3)) == want
    assert found(baskets.frequent_itemsets(long, "apriori", 0.9)) == {}
    assert rules.mine_rules(long, "apriori", 0.9)[1].count() == 0
    with pytest.raises(ValueError):
        baskets.frequent_itemsets(long, "no such miner")


def test_multi_item_consequents(baskets6):
    _, r = rules.mine_rules(baskets.long_baskets(baskets6), "apriori", 0.3, 0.5, 0.5)
    by = {("".join(x["antecedents"]), "".join(x["consequents"])): x for x in r.collect()}
    pq = by[("P", "Q")]
    assert (pq["lift"], pq["conviction"], pq["jaccard"]) == pytest.approx((0.9, 2 / 3, 0.5))
    assert by[("R", "Q")]["conviction"] == float("inf")
    assert by[("R", "PQ")]["confidence"] == pytest.approx(2 / 3)
    pruned = rules.prune(r)
    assert pruned.count() == pruned.select("consequents").distinct().count()
    named = rules.describe_rules(pruned, rules.code_descriptions(baskets6)).collect()
    assert {x["consequents_desc"] for x in named if len(x["consequents"]) == 2} == {"item P, item Q", "item Q, item R"}


def test_miners_keep_groups_apart(spark):
    """Two groups of different sizes: both miners give every support within its own group."""
    data = [(0, "a", "XY"), (0, "b", "X"), (0, "c", "XY"), (1, "d", "XZ"), (1, "e", "Z")]
    long = spark.createDataFrame([(g, i, c) for g, i, b in data for c in b], "grp int, Invoice string, item string")
    want = {(0, "X"): 1.0, (0, "Y"): 2 / 3, (0, "XY"): 2 / 3, (1, "X"): 0.5, (1, "Z"): 1.0, (1, "XZ"): 0.5}
    for miner in (baskets.apriori, baskets.fpgrowth):
        assert {(r["grp"], "".join(r["items"])): r["support"] for r in miner(long, 0.5).collect()} == pytest.approx(want)


def test_segment_rules_can_be_described(spark, baskets6):
    lines = baskets6.withColumn("CustomerID", F.col("Invoice").cast("int") % 2)
    both = spark.createDataFrame([(0, 0), (1, 1)], "CustomerID int, cluster int")
    per, _ = rules.segment_rules(lines, both, 0.3, 0.5, 0.1, min_invoices=2)
    named = rules.describe_rules(per, rules.code_descriptions(baskets6))
    assert named.count() == per.count() and named.filter("antecedents_desc not like 'item%'").isEmpty()


def test_miners_equal_brute_force_with_common_basket(spark, monkeypatch):
    rng = random.Random(3)
    data = ["ABCDE"] * 40 + ["".join(sorted(rng.sample("ABCDEFGH", rng.randint(1, 6)))) for _ in range(80)]
    lines = spark.createDataFrame([(str(i), c) for i, b in enumerate(data) for c in b], "Invoice string, StockCode string")
    want = {}
    for n in range(1, 9):
        for s in itertools.combinations("ABCDEFGH", n):
            freq = sum(set(s) <= set(b) for b in data)
            if freq >= 0.15 * len(data):
                want["".join(s)] = freq
    long = baskets.long_baskets(lines)
    assert found(baskets.apriori(long, 0.15)) == want and max(map(len, want)) == 5
    assert found(baskets.fpgrowth(long, 0.15)) == want
    monkeypatch.setattr(baskets, "SHARD_ROWS", 5)  # large shards are split by a second item
    assert found(baskets.fpgrowth(long, 0.15)) == want


def test_popular(spark):
    df = spark.createDataFrame([("1", "A"), ("1", "B"), ("2", "A"), ("3", "A"), ("4", "B")], "Invoice string, StockCode string")
    popular = baskets.popular_items(df, 0.0, 3)
    assert [r["StockCode"] for r in popular.collect()] == ["A"]
    assert baskets.keep_popular(df, popular).count() == 3
    index = baskets.item_index(baskets.long_baskets(df))
    assert index.orderBy("slot").collect() == [("A", 0), ("B", 1)]
    assert {r["Invoice"]: r["slots"] for r in baskets.encode(baskets.long_baskets(df), index).collect()} == {"1": [0, 1], "2": [0], "3": [0], "4": [1]}


def test_segment_skip_reasons(spark, baskets6):
    df = spark.createDataFrame([("1", "A", 1), ("1", "B", 1), ("2", "A", 2), ("2", "B", 2)], "Invoice string, StockCode string, CustomerID int")
    segments = spark.createDataFrame([(1, 0), (2, 0)], "CustomerID int, cluster int")
    found_rules, status = rules.segment_rules(df, segments)
    assert found_rules.count() == 0
    assert status.first()["skip_reason"] == "too few invoices: 2 of 50"
    lines = baskets6.withColumn("CustomerID", F.col("Invoice").cast("int") % 2)
    both = spark.createDataFrame([(0, 0), (1, 1)], "CustomerID int, cluster int")
    per, status = rules.segment_rules(lines, both, 0.3, 0.5, 0.1, min_invoices=2, top=1000)
    for c in (0, 1):
        alone = baskets.long_baskets(lines.filter(F.col("CustomerID") == c))
        want = rules.prune(rules.association_rules(baskets.apriori(alone, 0.3), 0.5, 0.1))
        pair = lambda d: {(tuple(r["antecedents"]), tuple(r["consequents"]), round(r["lift"], 9)) for r in d.collect()}
        assert pair(per.filter(F.col("cluster") == c)) == pair(want)
    assert all(r["skip_reason"] is None for r in status.collect())


def test_apriori_counts_a_basket_once(spark):
    """A row that comes twice is one item of its basket: support counts baskets, not rows."""
    rows = [("x", str(i), c) for i, b in enumerate(["PQ", "PQ", "P", "R"]) for c in b]
    long = spark.createDataFrame(rows * 2, "grp string, Invoice string, item string")
    assert found(baskets.apriori(long, 0.25)) == {"P": 3, "Q": 2, "R": 1, "PQ": 2}
    assert {r["n_baskets"] for r in baskets.apriori(long, 0.25).collect()} == {4}
