"""Minority oversampling: new rows between a minority row and one of its nearest minority neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens import config
from custlens.functions.strata import HASH_BITS, hash_strata, seeded_hash
from custlens.operators.neighbours import nearest
from custlens.runtime import materialize


def new_rows(points: DataFrame, k: int = 5, seed: int = config.SEED) -> DataFrame | None:
    """The rows that make both classes equally large: (id, copy, neighbour, u, label, x); None if nothing is missing.

    Each minority row gives the same number of new rows, and the remainder goes to the first rows in
    hash order. Neighbour and position `u` between the two are drawn from hashes of (seed, id, copy), so the result does
    not depend on partitioning. Neighbours are searched among minority rows only.
    """
    sizes = {r["label"]: r["n"] for r in points.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    minority, majority = sorted(sizes, key=lambda c: (sizes[c], c))
    have, missing = sizes[minority], sizes[majority] - sizes[minority]
    if missing == 0:
        return None
    if have < 2:
        raise ValueError("oversampling needs at least two minority rows")
    k = min(k, have - 1)
    rows = points.filter(F.col("label") == minority).select("id", "x")
    each, rest = divmod(missing, have)
    counted = hash_strata(rows.withColumn("_one", F.lit(1)), "id", "_one", [rest / have], seed, "_later")
    copies = F.lit(each) + F.when(F.col("_later") == 0, 1).otherwise(0)
    born = counted.withColumn("copies", copies).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    pick = F.pmod(seeded_hash(seed, "id", "copy", F.lit("neighbour")), F.lit(k)).cast("int") + 2  # place 1 is the row itself or its copy
    share = seeded_hash(seed, "id", "copy", F.lit("share")) / F.lit(float(2**HASH_BITS))
    born = born.select("id", "x", "copy", pick.alias("place"), share.alias("u"))
    # without a copy for each, most rows give no new row: neighbours are searched only for those that do
    asking = rows if each else rows.join(materialize(born.select("id").distinct()), "id", "left_semi")
    found = nearest(asking, rows, k + 1).select("id", "place", "neighbour")
    partner = rows.select(F.col("id").alias("neighbour"), F.col("x").alias("nx"))
    born = born.join(found, ["id", "place"]).join(partner, "neighbour")
    new = F.zip_with("x", "nx", lambda a, b: b - a)
    new = F.zip_with("x", F.transform(new, lambda v: v * F.col("u")), lambda a, b: a + b)
    return born.select("id", "copy", "neighbour", "u", F.lit(minority).cast(points.schema["label"].dataType).alias("label"), new.alias("x"))


def smote(points: DataFrame, k: int = 5, seed: int = config.SEED) -> DataFrame:
    """(label, x) with both classes of equal size. Input (id, label, x), `x` an array of the encoded features."""
    kept, born = points.select("label", "x"), new_rows(points, k, seed)
    return kept if born is None else kept.unionByName(born.select("label", "x"))
