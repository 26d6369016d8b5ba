"""Merkle fixity audit of archive replicas.

Records of an archive lie one behind the other. Their hashes, in order of offset, are hashed into ranges of offsets, ranges
into wider ranges (`FANOUT` at a time), up to one root. Two replicas are compared at the root; below it only the children of
branches that differ are met, level by level, down to the records that were changed, lost or added. Trees are written once
per replica, so that a later audit against another replica reads them again.

All steps are SQL aggregates and joins on offsets: a range holds a bounded number of bytes, a node a bounded number of
children, and the only value on the driver is the largest offset. Defined cases: null payload parts are empty; a null id or
repeated record is a record like others (its offset is its own); an empty archive has no nodes and equals another empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens.functions.ordering import global_rank, unused
from custlens.runtime import materialize

RANGE_BYTES = 1 << 16
FANOUT = 16


def record(uri: Column, payload: Column) -> Column:
    """A record as archives hold it: header lines, an empty line, the payload, and two line ends."""
    payload = F.coalesce(payload, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce(uri, F.lit("")), F.lit("\r\nContent-Length: "))
    return F.concat(head, F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def lay_out(records: DataFrame, order: list[str], length: str = "length") -> DataFrame:
    """`records` with the `offset` of each, one behind the other in the order of the given columns (a total order but for equal rows)."""
    rank, end = unused(records, "rank", "end")
    placed = global_rank(records, order, rank=rank, sums={end: length})
    return placed.withColumn("offset", F.col(end).cast("long") - F.col(length)).drop(rank, end)


def build_tree(records: DataFrame) -> list[DataFrame]:
    """Levels of the tree over `offset`, `length`, `hash` (hex), leaves first: each `node`, `parent`, `hash`. Empty for no records."""
    leaf = records.select(F.col("offset").alias("node"), F.floor(F.col("offset") / RANGE_BYTES).alias("parent"), F.sha2(F.concat_ws(":", "length", "hash"), 256).alias("hash"))
    levels = [materialize(leaf)]
    last = levels[0].agg(F.max("parent")).first()[0]
    while last is not None:
        child = F.struct("node", "hash")
        joined = F.array_join(F.transform(F.sort_array(F.collect_list(child)), lambda c: F.concat_ws("=", c["node"].cast("string"), c["hash"])), ",")
        up = levels[-1].groupBy(F.col("parent").alias("node")).agg(F.sha2(joined, 256).alias("hash"))
        levels.append(materialize(up.select("node", F.floor(F.col("node") / FANOUT).alias("parent"), "hash")))
        if last == 0:
            break
        last //= FANOUT
    return levels


def audit(one: list[DataFrame], two: list[DataFrame]) -> DataFrame:
    """Offsets of records that differ between two trees: `offset`, `damage` (changed, lost or added in the second)."""
    spark_empty = "node long, parent long, hash string"
    height = max(len(one), len(two))
    if not height:
        raise ValueError("a tree has at least its leaves")
    spark = one[0].sparkSession
    none = spark.createDataFrame([], spark_empty)
    suspects = None
    for level in range(height - 1, -1, -1):
        sides = [t[level] if level < len(t) else none for t in (one, two)]
        if suspects is not None:
            sides = [s.join(suspects, "parent", "left_semi") for s in sides]
        a, b = (s.select("node", F.col("hash").alias(h)) for s, h in zip(sides, ("first_hash", "second_hash")))
        differ = materialize(a.join(b, "node", "full").where(~F.col("first_hash").eqNullSafe(F.col("second_hash"))))
        suspects = differ.select(F.col("node").alias("parent"))
    damage = F.when(F.col("second_hash").isNull(), "lost").when(F.col("first_hash").isNull(), "added").otherwise("changed")
    return differ.select(F.col("node").alias("offset"), damage.alias("damage"))
