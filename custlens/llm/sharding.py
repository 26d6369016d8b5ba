"""Jump consistent hashing (Lamping and Veach, 2014) with SQL expressions only.

A 64-bit key and the shard count decide the shard; there is no ring table, and one more shard takes from every other one only
the rows it must hold. The generator key * 2862933555777941757 + 1 modulo 2^64 runs on 32-bit halves and 16-bit
quarters, because SQL integers must not overflow.

Defined cases: integer keys are taken as they are (negative ones as their two's complement), other types by xxhash64. A null
key is key 0. Equal keys share a shard. `assign` numbers the rows of a shard in the order of the key and the given columns;
fully equal rows are numbered in the order in which they are stored. Extra columns are carried over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.functions.ordering import global_rank, unused
from custlens.runtime import materialize

# Fixed value: the multiplier of the published algorithm, 2862933555777941757, in halves.
MULTIPLIER_HIGH, MULTIPLIER_LOW = 2862933555777941757 >> 32, 2862933555777941757 & 0xFFFFFFFF
HALF = 0xFFFFFFFF
# Jumps made for every row before rows that still jump are gone on with; a row makes about ln(shards) jumps.
USUAL_JUMPS = 48


def _low_product(x: Column, factor: int) -> Column:
    """x * factor modulo 2^32, and a little more, for 32-bit x and factor."""
    high = F.shiftright(x, 16) * F.lit(factor)
    return x.bitwiseAND(F.lit(0xFFFF)) * F.lit(factor) + F.shiftleft(high.bitwiseAND(F.lit(0xFFFF)), 16)


def _jump(state: Column, shards: int) -> Column:
    hi, lo, j = state["hi"], state["lo"], state["j"]
    low = _low_product(lo, MULTIPLIER_LOW) + F.lit(1)
    carry = F.shiftright(low, 32) + F.shiftright(F.shiftright(lo, 16) * F.lit(MULTIPLIER_LOW), 16)
    high = (carry + _low_product(lo, MULTIPLIER_HIGH) + _low_product(hi, MULTIPLIER_LOW)).bitwiseAND(F.lit(HALF))
    ahead = ((j + 1).cast("double") * (F.lit(float(1 << 31)) / (F.shiftright(high, 1) + 1).cast("double"))).cast("long")
    moved = F.struct(high.alias("hi"), low.bitwiseAND(F.lit(HALF)).alias("lo"), j.alias("b"), ahead.alias("j"))
    return F.when(j < shards, moved).otherwise(state)


def jump_shard(key: Column, shards: int) -> Column:
    """Shard 0 .. shards - 1 of a long key."""
    if shards < 1:
        raise ValueError("there must be at least one shard")
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    zero = F.lit(0).cast("long")
    start = F.struct(F.shiftrightunsigned(key, 32).alias("hi"), key.bitwiseAND(F.lit(HALF)).alias("lo"), (zero - 1).alias("b"), zero.alias("j"))
    step = lambda s, _: _jump(s, shards)
    first = F.aggregate(F.sequence(F.lit(1), F.lit(min(shards, USUAL_JUMPS))), start, step)
    if shards <= USUAL_JUMPS:
        return first["b"].cast("int")
    rest = F.when(first["j"] < shards, F.sequence(F.lit(1), F.lit(shards))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(rest, first, step)["b"].cast("int")


def key_of(df: DataFrame, key: str) -> Column:
    integral = isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    return F.col(f"`{key}`").cast("long") if integral else F.when(F.col(f"`{key}`").isNotNull(), F.xxhash64(f"`{key}`"))


def assign(df: DataFrame, key: str, shards: int, order: list[str]) -> DataFrame:
    """`df` with `shard` of `shards`, `slot` (0, 1, ... in the shard) and `grown_shard` (its shard of one more).

    The rows are written to the shared folder once, then ranked by range partitions, so that no shard is one task.
    """
    row, rank, first = unused(df, "row", "rank", "first")
    placed = df.drop("shard", "slot", "grown_shard").withColumns({"shard": jump_shard(key_of(df, key), shards), "grown_shard": jump_shard(key_of(df, key), shards + 1)})
    stored = materialize(placed).withColumn(row, F.monotonically_increasing_id())
    ranked = global_rank(stored, ["shard", *[f"`{c}`" for c in (key, *order)], row], rank=rank)
    begins = ranked.groupBy("shard").agg(F.min(rank).alias(first))
    return ranked.join(begins, "shard").withColumn("slot", F.col(rank) - F.col(first)).drop(rank, first, row)
