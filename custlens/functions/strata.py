"""Seeded, reproducible strata: cut each class at exact shares of its hash order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_BITS = 60


def seeded_hash(seed: int, *cols: str | Column) -> Column:
    """First 15 hex digits of md5("seed|a|b.."), as a whole number in [0, 2^60)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[(F.col(c) if isinstance(c, str) else c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def merge_intervals(intervals) -> list[tuple[float, float]]:
    """Sorted disjoint intervals that cover the given ones."""
    out: list[list[float]] = []
    for lo, hi in sorted(intervals):
        if out and lo <= out[-1][1]:
            out[-1][1] = max(out[-1][1], hi)
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def hash_strata(
    df: DataFrame, unique: str, label: str, shares: Sequence[float], seed: int, name: str = "stratum"
) -> DataFrame:
    """Number each row by how many cut points lie below it; cut i keeps floor(share_i * n) rows of each class.

    `unique` must be without NULLs and repeats, and `label` without NULLs, else ValueError: a cut between equal ids is not
    defined. A window ordered by hash would put a whole class into one task. The hash is uniform, so the cut
    row lies in a narrow band known in advance; one pass counts below the band and looks only inside
    it, and a band that misses is widened. Rows are then labelled by comparison alone, with no shuffle.
    """
    h = seeded_hash(seed, unique)
    keys = df.groupBy(unique).agg(F.count("*").alias("n"), F.count(label).alias("labels"))
    if not keys.filter(F.col(unique).isNull() | (F.col("n") > 1) | (F.col("labels") < 1)).isEmpty():
        raise ValueError(f"{unique} must be unique and not NULL, and {label} not NULL")
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    wanted = [(c, i, math.floor(s * n + 1e-9)) for c, n in sizes.items() for i, s in enumerate(shares)]
    cuts: dict[tuple, tuple[int, int]] = {}
    width = 6.0
    while True:
        todo = [w for w in wanted if (w[0], w[1]) not in cuts and w[2] > 0]
        if not todo:
            break
        zone = F.lit(None).cast("int")
        for c in {w[0] for w in todo}:
            n, half = sizes[c], width * math.sqrt(sizes[c]) + 2
            bands = [((k - half) / n, (k + half) / n) for cc, _, k in todo if cc == c]
            bands = [(max(0, int(lo * 2**HASH_BITS)), min(2**HASH_BITS, int(hi * 2**HASH_BITS))) for lo, hi in merge_intervals(bands)]
            here = sum(((F.col("_h") >= lo).cast("int") + (F.col("_h") > hi).cast("int") for lo, hi in bands), F.lit(0))
            zone = F.when(F.col(label) == F.lit(c), here).otherwise(zone)
        inside = F.col("_zone") % 2 == 1
        near = (
            df.select(F.col(label).alias("_c"), F.col(unique).alias("_id"), h.alias("_h"), F.col(label))
            .withColumn("_zone", zone).filter("_zone is not null")
            .groupBy("_c", "_zone", F.when(inside, F.col("_h")).alias("_h"), F.when(inside, F.col("_id")).alias("_id")).agg(F.count("*").alias("n"))
        )
        order = Window.partitionBy("_c").orderBy("_zone", "_h", "_id").rowsBetween(Window.unboundedPreceding, 0)
        hit = F.lit(False)
        for c, _, k in todo:
            hit = hit | ((F.col("_c") == F.lit(c)) & (F.col("upto") == k))
        hits = near.withColumn("upto", F.sum("n").over(order)).filter(inside & hit).collect()
        for r in hits:
            for c, i, k in todo:
                if r["_c"] == c and r["upto"] == k:
                    cuts[(c, i)] = (r["_h"], r["_id"])
        if width > 2**HASH_BITS:
            raise ArithmeticError("no cut was found")
        width *= 8
    stratum = F.lit(0)
    for c, i, k in wanted:
        here = F.col(label) == F.lit(c)
        if k == 0:
            past = here
        else:
            ch, cid = cuts[(c, i)]
            past = here & ((h > ch) | ((h == ch) & (F.col(unique) > F.lit(cid))))
        stratum = stratum + F.when(past, 1).otherwise(0)
    return df.withColumn(name, stratum.cast("int"))
