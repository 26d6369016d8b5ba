"""Merkle audit against direct comparison, and against its SQL."""

import hashlib
import random

import pytest
from oracle import compare, connect

from custlens.llm import queries as q
from custlens.llm import warc_fixity as wf

FOLDER = "/root/testdata/sf0.001"


def records(spark, rows):
    return spark.createDataFrame(rows, "offset long, length long, hash string")


def damaged(spark, one, two):
    return {(r.offset, r.damage) for r in wf.audit(wf.build_tree(records(spark, one)), wf.build_tree(records(spark, two))).collect()}


def test_op3_equals_sql(spark):
    assert compare(spark, connect(FOLDER), FOLDER, "op3_merkle_fixity", q.QUERIES, q.ORACLES).startswith("ok")


def test_audit_finds_every_damage_and_nothing_else(spark):
    rng = random.Random(1)
    one, at = [], 0
    for i in range(3000):
        size = rng.choice([1, 200, 5000, 300_000])
        one.append((at, size, hashlib.sha256(str(i).encode()).hexdigest()))
        at += size
    want, two = set(), []
    for r in one:
        kind = rng.random()
        if kind < 0.01:
            want.add((r[0], "changed"))
            two.append((r[0], r[1], "0" * 64))
        elif kind < 0.02:
            want.add((r[0], "lost"))
        else:
            two.append(r)
    two += [(at + 10**9, 5, "1" * 64)]
    want.add((at + 10**9, "added"))
    assert damaged(spark, one, two) == want
    assert damaged(spark, one, one) == set()
    assert damaged(spark, one, []) == {(r[0], "lost") for r in one} and damaged(spark, [], []) == set()


def test_equal_replicas_have_one_root_and_order_does_not_matter(spark):
    rows = [(i * 50_000, 50_000, hashlib.sha256(bytes([i])).hexdigest()) for i in range(100)]
    tops = [wf.build_tree(records(spark, x))[-1].collect() for x in (rows, rows[::-1], rows[:-1])]
    assert [len(t) for t in tops] == [1, 1, 1]
    assert tops[0][0].hash == tops[1][0].hash != tops[2][0].hash


def test_layout_with_nulls_and_repeated_rows(spark):
    df = spark.createDataFrame([(None, None, None), (1, "u", "é"), (1, "u", "é"), (2, None, "")], "page_id long, url string, html string")
    made = df.select("page_id", wf.record(df.url, df.html).alias("r"))
    rows = made.selectExpr("page_id", "r", "octet_length(r) as length", "sha2(r, 256) as h")
    got = wf.lay_out(rows.selectExpr("page_id", "h", "cast(length as long) as length"), ["page_id", "h"]).orderBy("offset").collect()
    sizes = [r.length for r in got]
    assert [r.offset for r in got] == [sum(sizes[:i]) for i in range(4)] and got[0].page_id is None
    assert made.collect()[1].r.endswith("Content-Length: 2\r\n\r\né\r\n\r\n")


def test_no_trees_is_refused():
    with pytest.raises(ValueError):
        wf.audit([], [])
