"""Jump consistent hashing against its published loop."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from custlens.llm import queries as q
from custlens.llm import sharding, warc_fixity

FOLDER = "/root/testdata/sf0.001"


def loop(key, shards):
    key, b, j = key % 2**64, -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


@pytest.mark.parametrize("shards", [1, 2, 8, 9, 1000])
def test_equals_published_loop(spark, shards):
    keys = [0, 1, 2, -1, 2**63 - 1, -(2**63), 1234567890123456789, *range(100, 400)]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = df.select("k", sharding.jump_shard(F.col("k"), shards).alias("s")).collect()
    assert [r.s for r in got] == [loop(r.k, shards) for r in got]


def test_rows_move_only_into_the_new_shard(spark):
    rows = spark.range(20_000).select("id", *[sharding.jump_shard(F.col("id"), n).alias(f"s{n}") for n in (8, 9)]).collect()
    assert {r.s9 for r in rows if r.s8 != r.s9} == {8}
    assert 0.08 < sum(r.s8 != r.s9 for r in rows) / 20_000 < 0.14
    assert max(Counter(r.s8 for r in rows).values()) < 1.1 * 2500


def test_op7(spark):
    texts = {r.doc_id: (r.text or "").encode() for r in q.table(spark, FOLDER, "documents").collect()}
    df = q.QUERIES["op7_jump_sharding"](spark, FOLDER)
    rows = df.collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert (r["size"], r.text_crc32, r.law, r.shard, r.grown_shard) == (len(texts[r.doc_id]) + 1, zlib.crc32(texts[r.doc_id]), "key", loop(r.doc_id, 8), loop(r.doc_id, 9))
    for s in range(8):
        inside = sorted((r.slot, r.doc_id) for r in rows if r.shard == s)
        assert [x for x, _ in inside] == list(range(len(inside))) and inside == sorted(inside, key=lambda x: x[1])


def test_nulls_repeats_strings_and_empty(spark):
    df = spark.createDataFrame([(None, "a", 1), (0, "b", 2), (5, "c", 3), (5, "c", 3), (5, "c", 3)], "k long, text string, slot int")
    rows = sharding.assign(df, "k", 3, ["text"]).collect()
    assert len(rows) == 5 and len({(r.shard, r.slot) for r in rows}) == 5
    assert len({r.shard for r in rows if r.k in (None, 0)}) == 1
    named = sharding.assign(df, "text", 4, ["k"]).groupBy("text").agg(F.countDistinct("shard").alias("n")).collect()
    assert {r.n for r in named} == {1}
    assert sharding.assign(df.where("false"), "k", 3, ["text"]).count() == 0


def test_columns_with_inner_names_are_carried(spark):
    names = ["_rank", "_part", "_at", "_before", "_n", "_row", "_first", "_s0", "_o0", "_end", "_r"]
    rows = [(i, 10 + i, *[f"{c}{i}" for c in names]) for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, length long, " + ", ".join(f"`{c}` string" for c in names))
    placed = sharding.assign(df, "doc_id", 8, ["length"])
    assert set(placed.columns) == {*df.columns, "shard", "slot", "grown_shard"}
    assert all(r[c] == f"{c}{r.doc_id}" for r in placed.collect() for c in names)
    laid = warc_fixity.lay_out(df, ["doc_id"])
    assert set(laid.columns) == {*df.columns, "offset"} and all(r[c] == f"{c}{r.doc_id}" for r in laid.collect() for c in names)
    assert {r.doc_id: r.offset for r in laid.collect()} == {i: sum(range(10, 10 + i)) for i in range(50)}
