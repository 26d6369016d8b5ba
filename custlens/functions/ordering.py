"""Global ranks and running sums without sending every row to one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens.runtime import materialize


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names made from `names` that no column of `df` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        name = f"_{name}"
        while name in taken:
            name += "_"
        out.append(name)
    return out


def global_rank(
    df: DataFrame, keys: Sequence[Column], rank: str = "rank", sums: dict[str, str] | None = None
) -> DataFrame:
    """Rank 1..N in the order of `keys`, and running sums `{new column: summed column}` in that order.

    The keys must be a total order (end in a unique id), so that range partitions stay even when one
    value is very common. Rows are range-partitioned and sorted once and written with their position;
    the only other data are one count and sum per partition.
    """
    sums = sums or {}
    part, at, before, n = unused(df, "part", "at", "before", "n")
    totals, offsets_of = unused(df, *[f"s{i}" for i in range(len(sums))]), unused(df, *[f"o{i}" for i in range(len(sums))])
    placed = materialize(
        df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id())
    ).withColumn(part, F.shiftright(at, 33))
    upto = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy(part).agg(F.count("*").alias(n), *[F.sum(c).alias(s) for s, c in zip(totals, sums.values())])
    offsets = offsets.select(
        part,
        F.coalesce(F.sum(n).over(upto), F.lit(0)).alias(before),
        *[F.coalesce(F.sum(s).over(upto), F.lit(0.0)).alias(o) for s, o in zip(totals, offsets_of)],
    )
    inside = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, 0)
    # one offset row per partition: its size is the partition count, never the data
    out = placed.join(F.broadcast(offsets), part)
    for o, (name, c) in zip(offsets_of, sums.items()):
        out = out.withColumn(name, F.sum(c).over(inside) + F.col(o))
    position = F.col(at) - F.shiftleft(F.col(part), 33)
    return out.withColumn(rank, (F.col(before) + position + 1).cast("bigint")).drop(part, at, before, *offsets_of)
