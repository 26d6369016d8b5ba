"""Exact linear-interpolated quantiles whose cost and memory do not grow with one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens.functions.strata import merge_intervals


def exact_quantiles(
    df: DataFrame, wanted: dict[str, Sequence[float]], accuracy: int = 20_000
) -> dict[str, list[float | None]]:
    """Quantiles of whole columns, NULLs ignored, as plain numbers.

    `percentile` would hold every distinct value in one task. Here a bounded sketch brackets each
    rank, one more pass counts what lies below and groups the few values inside, and the bracket is
    widened when the counts show that the rank lies outside it. So the answer is exact for any sketch.
    """
    targets = [(c, q) for c, qs in wanted.items() for q in qs]
    values: dict[int, float | None] = {}
    open_ids = list(range(len(targets)))
    slack = 3.0 / accuracy
    while open_ids:
        probs = [(max(0.0, targets[i][1] - slack), min(1.0, targets[i][1] + slack)) for i in open_ids]
        row = df.agg(
            *[F.count(c).alias(f"n_{j}") for j, c in enumerate(wanted)],
            *[
                F.percentile_approx(F.col(targets[i][0]).cast("double"), list(p), accuracy).alias(f"b_{i}")
                for i, p in zip(open_ids, probs)
            ],
        ).first()
        counts = {c: row[f"n_{j}"] for j, c in enumerate(wanted)}
        for i in open_ids:
            if counts[targets[i][0]] == 0:
                values[i] = None
        open_ids = [i for i in open_ids if i not in values]
        if not open_ids:
            break
        found = _ranks_within(df, targets, open_ids, counts, {i: row[f"b_{i}"] for i in open_ids})
        for i in open_ids:
            position = targets[i][1] * (counts[targets[i][0]] - 1)
            low, high = math.floor(position), math.ceil(position)
            if (i, low) in found and (i, high) in found:
                a, b = found[(i, low)], found[(i, high)]
                values[i] = a + (b - a) * (position - low)
        open_ids = [i for i in open_ids if i not in values]
        slack = min(1.0, slack * 8)
    out: dict[str, list[float | None]] = {c: [] for c in wanted}
    for i, (c, _) in enumerate(targets):
        out[c].append(values[i])
    return out


def _ranks_within(df, targets, ids, counts, brackets) -> dict[tuple[int, int], float]:
    """Values at the two ranks around each target, where a bracket (or the edge of a gap) holds them.

    Per column the brackets become disjoint intervals; zones alternate gap, interval, gap, .. A row's key
    is its zone per column and its value only inside an interval, so nearly all rows fall into one group
    and the pass is a plain aggregate with map-side combine.
    """
    columns = list(dict.fromkeys(targets[i][0] for i in ids))
    keys, aggs, parts, ranks = [], [F.count("*").alias("n")], [], []
    for j, c in enumerate(columns):
        v = F.col(c).cast("double")
        own = [i for i in ids if targets[i][0] == c]
        zone = sum(((v >= F.lit(lo)).cast("int") + (v > F.lit(hi)).cast("int") for lo, hi in merge_intervals([float(b) for b in brackets[i]] for i in own)), F.lit(0))
        keys += [zone.alias(f"z{j}"), F.when(zone % 2 == 1, v).alias(f"v{j}")]
        aggs += [F.min(v).alias(f"lo{j}"), F.max(v).alias(f"hi{j}")]
        parts.append(F.struct(F.lit(j).alias("j"), F.col(f"z{j}").alias("zone"), F.col(f"v{j}").alias("inside"), "n", F.col(f"lo{j}").alias("lo"), F.col(f"hi{j}").alias("hi")))
        positions = {targets[i][1] * (counts[c] - 1) for i in own}
        ranks += [(j, r) for r in {f(p) for p in positions for f in (math.floor, math.ceil)}]
    groups = df.groupBy(*keys).agg(*aggs).select(F.explode(F.array(*parts)).alias("t")).select("t.*").filter("lo is not null")
    groups = groups.groupBy("j", "zone", "inside").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    ordered = Window.partitionBy("j").orderBy("zone", "inside").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(r).cast("bigint").alias("r")) for j, r in ranks])
    first, last = F.col("upto") - F.col("n"), F.col("upto") - 1
    covered = (
        groups.withColumn("upto", F.sum("n").over(ordered))
        .withColumn("r", F.explode(F.transform(F.filter(wanted, lambda w: w["j"] == F.col("j")), lambda w: w["r"])))
        .filter(F.when(F.col("zone") % 2 == 1, F.col("r").between(first, last)).otherwise((F.col("r") == first) | (F.col("r") == last)))
        .select("j", "r", F.when(F.col("r") == first, F.col("lo")).otherwise(F.col("hi")).alias("value"))
    )
    by_column = {(columns[t["j"]], t["r"]): t["value"] for t in covered.collect()}
    return {(i, r): by_column[(targets[i][0], r)] for i in ids for _, r in ranks if (targets[i][0], r) in by_column}

