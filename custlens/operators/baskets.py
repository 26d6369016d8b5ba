"""Baskets and frequent itemsets. Everything is keyed by a group, so one plan mines all segments at once."""

from __future__ import annotations

from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens import config
from custlens.functions.ordering import global_rank
from custlens.runtime import materialize, ship_package

# Rows of a shard beyond which it is split by a second item.
SHARD_ROWS = 200_000


def popular_items(
    lines: DataFrame, fraction: float = config.POPULAR_FRACTION, floor: int = config.POPULAR_FLOOR, item: str = "StockCode"
) -> DataFrame:
    """Items in at least max(floor, int(fraction * invoices)) distinct invoices."""
    invoices = lines.filter(F.col("Invoice").isNotNull()).select("Invoice").distinct().agg(F.count("*").alias("n"))
    need = F.greatest(F.lit(floor), F.floor(F.lit(fraction) * F.col("n"))).alias("need")
    pairs = lines.filter(F.col("Invoice").isNotNull() & F.col(item).isNotNull()).select(item, "Invoice").distinct()
    counts = pairs.groupBy(item).agg(F.count("*").alias("n_invoices"))
    return counts.filter(F.col("n_invoices") >= invoices.select(need).scalar())


def keep_popular(lines: DataFrame, popular: DataFrame, item: str = "StockCode") -> DataFrame:
    return lines.join(popular.select(item), item, "left_semi")


def long_baskets(lines: DataFrame, item: str = "StockCode", group: Column | None = None) -> DataFrame:
    """One row per (group, invoice, item): the encoded form that mining reads."""
    group = F.lit(0) if group is None else group
    rows = lines.select(group.alias("grp"), "Invoice", F.col(item).alias("item"))
    return rows.filter("Invoice is not null and item is not null").distinct()


def baskets(lines: DataFrame, item: str = "StockCode") -> DataFrame:
    """Distinct items per invoice, sorted. A list holds at most the item catalogue."""
    return long_baskets(lines, item).groupBy("Invoice").agg(F.array_sort(F.collect_set("item")).alias("items"))


def item_index(long: DataFrame) -> DataFrame:
    """(item, slot): items in alphabetical order, numbered from 0."""
    return global_rank(long.select("item").distinct(), [F.asc("item")], "_r").select("item", (F.col("_r") - 1).alias("slot"))


def encode(long: DataFrame, index: DataFrame) -> DataFrame:
    """One-hot baskets in sparse form: (grp, Invoice, slots), the sorted slots that are 1. No limit on the catalogue."""
    return long.join(index, "item").groupBy("grp", "Invoice").agg(F.array_sort(F.collect_set("slot")).alias("slots"))


def basket_sizes(long: DataFrame) -> DataFrame:
    """Invoices per group, the denominator of every support."""
    return long.select("grp", "Invoice").distinct().groupBy("grp").agg(F.count("*").alias("n_baskets"))


def _needed(support: float) -> Column:
    # a hair below s * n, so that a count equal to s * n passes despite rounding of the product
    return F.ceil(F.lit(support) * F.col("n_baskets") - F.lit(1e-9))


def apriori(long: DataFrame, min_support: float = config.MIN_SUPPORT, max_length: int | None = None) -> DataFrame:
    """Level-wise frequent itemsets: (grp, items, freq, n_baskets, support).

    Equal baskets collapse into one row with a weight first, so invoices are dealt once and a popular
    basket costs one row; sizes, items and pairs are counted on these rows. Items below support are
    dropped, which makes more baskets equal. Level k joins each basket's leading item pair with the candidates
    that start with it and keeps those the basket contains; counts combine before the shuffle.
    """
    whole = long.groupBy("grp", "Invoice").agg(F.array_sort(F.collect_set("item")).alias("basket"))
    whole = whole.groupBy("grp", "basket").agg(F.count("*").alias("weight"))
    whole = materialize(whole.withColumn("at", F.monotonically_increasing_id()))
    # one row per group, written, so that Spark knows its size and does not deal all counts by group
    sizes = materialize(whole.groupBy("grp").agg(F.sum("weight").alias("n_baskets")))
    held = whole.select("grp", "at", "weight", F.explode("basket").alias("item"))
    single = held.groupBy("grp", "item").agg(F.sum("weight").alias("freq")).join(sizes, "grp").filter(F.col("freq") >= _needed(min_support))
    single = materialize(single.select("grp", F.array("item").alias("items"), "freq", "n_baskets"))
    frequent = held.join(single.select("grp", F.col("items")[0].alias("item")), ["grp", "item"], "left_semi")
    packed = frequent.groupBy("grp", "at").agg(F.array_sort(F.collect_set("item")).alias("basket"), F.first("weight").alias("weight"))
    packed = materialize(packed.filter(F.size("basket") > 1).groupBy("grp", "basket").agg(F.sum("weight").alias("weight")))
    pairs = (
        packed.select("grp", "basket", "weight", F.posexplode("basket").alias("at", "a"))
        .filter(F.col("at") + 1 < F.size("basket"))
        .withColumn("rest", F.slice("basket", F.col("at") + 2, F.size("basket")))
        .select("grp", "weight", "a", F.posexplode("rest").alias("at", "b"), "rest")
        .withColumn("tail", F.slice("rest", F.col("at") + 2, F.size("rest")))
        .drop("rest", "at")
    )
    levels, level, length = [single], single, 1
    while (max_length is None or length < max_length) and not level.isEmpty():
        length += 1
        if length == 2:
            counted = pairs.groupBy("grp", F.array("a", "b").alias("items"))
        else:
            wanted = _candidates(level, length).withColumn("a", F.col("items")[0]).withColumn("b", F.col("items")[1])
            more = F.slice("items", 3, length)
            counted = pairs.filter(F.size("tail") >= length - 2).join(wanted, ["grp", "a", "b"]).filter(
                F.size(F.array_except(more, "tail")) == 0
            ).groupBy("grp", "items")
        level = counted.agg(F.sum("weight").alias("freq")).join(sizes, "grp").filter(F.col("freq") >= _needed(min_support))
        level = materialize(level.select("grp", "items", "freq", "n_baskets"))
        levels.append(level)
    every = reduce(DataFrame.unionByName, levels)
    return every.withColumn("support", F.col("freq") / F.col("n_baskets"))


def _candidates(level: DataFrame, length: int) -> DataFrame:
    """Sets of `length` items whose every smaller set is frequent: join on the shared prefix, then count subsets."""
    prefix, last = F.slice("items", 1, length - 2).alias("prefix"), F.element_at("items", -1)
    left = level.select("grp", prefix, last.alias("x"))
    right = level.select("grp", prefix, last.alias("y"))
    grown = left.join(right, ["grp", "prefix"]).filter("x < y").select("grp", F.concat("prefix", F.array("x", "y")).alias("items"))
    drop_one = F.transform(
        F.sequence(F.lit(1), F.lit(length)),
        lambda i: F.concat(F.slice("items", 1, i - 1), F.slice("items", i + 1, length)),
    )
    subsets = grown.select("grp", "items", F.explode(drop_one).alias("subset"))
    known = level.select("grp", F.col("items").alias("subset"))
    whole = subsets.join(known, ["grp", "subset"]).groupBy("grp", "items").agg(F.count("*").alias("n"))
    return whole.filter(F.col("n") == length).select("grp", "items")


def fpgrowth(long: DataFrame, min_support: float = config.MIN_SUPPORT) -> DataFrame:
    """The same table by parallel FP-Growth (Li and others, 2008), all groups in one job.

    Items of a group are ranked by falling frequency and infrequent ones dropped. Each basket sends, for every item it holds,
    the more frequent items before it to the shard of that item; a shard lists the sets whose least frequent item it is, so
    no set is found twice. Equal prefixes become one weighted row before the shuffle, and a shard whose rows are many is
    split once more, by its second least frequent item: a popular item is no single task.
    """
    ship_package(long.sparkSession)
    sizes = materialize(basket_sizes(long))
    single = long.groupBy("grp", "item").agg(F.count("*").alias("freq")).join(sizes, "grp").withColumn("need", F.greatest(F.lit(1), _needed(min_support))).filter("freq >= need")
    by_frequency = Window.partitionBy("grp").orderBy(F.desc("freq"), "item")  # the catalogue of one group
    single = materialize(single.withColumn("rank", F.row_number().over(by_frequency)))
    packed = long.join(single.select("grp", "item", "rank"), ["grp", "item"]).groupBy("grp", "Invoice").agg(F.array_sort(F.collect_list("rank")).alias("basket"))
    packed = packed.filter(F.size("basket") > 1).groupBy("grp", "basket").agg(F.count("*").alias("weight"))
    ends = packed.select("grp", "weight", "basket", F.posexplode("basket").alias("at", "last")).filter("at > 0")
    shards = ends.groupBy("grp", "last", F.slice("basket", F.lit(1), F.col("at")).alias("prefix")).agg(F.sum("weight").alias("weight"))
    shards = materialize(shards)
    # a second item for the rows of large shards: each of their pairs is a shard of its own
    large = shards.groupBy("grp", "last").count().filter(F.col("count") > SHARD_ROWS).select("grp", "last")
    small = shards.join(large, ["grp", "last"], "left_anti").select("grp", F.array("last").alias("ends"), "prefix", "weight")
    pairs = shards.join(large, ["grp", "last"], "left_semi").select("grp", "last", "prefix", "weight", F.posexplode("prefix").alias("at", "second"))
    pairs = pairs.groupBy("grp", F.array("last", "second").alias("ends"), F.slice("prefix", F.lit(1), F.col("at")).alias("prefix")).agg(F.sum("weight").alias("weight"))
    need = single.groupBy("grp").agg(F.max("need").alias("need"))
    spread = small.unionByName(pairs).join(need, "grp")
    kind = long.schema["grp"].dataType.simpleString()
    found = spread.withColumn("shard", F.array_join("ends", ",")).groupBy("grp", "shard").applyInPandas(_grow_shard, f"grp {kind}, ranks array<int>, freq bigint")
    several = found.withColumn("_set", F.col("ranks")).select("grp", "_set", "freq", F.explode("ranks").alias("rank"))
    named = several.join(single.select("grp", "rank", "item"), ["grp", "rank"]).groupBy("grp", "_set", "freq").agg(F.array_sort(F.collect_list("item")).alias("items"))
    every = single.select("grp", F.array("item").alias("items"), "freq").unionByName(named.select("grp", "items", "freq"))
    return every.join(sizes, "grp").select("grp", "items", "freq", "n_baskets", (F.col("freq") / F.col("n_baskets")).alias("support"))


def _grow_shard(rows: pd.DataFrame) -> pd.DataFrame:
    """Frequent sets of two items or more that end in a shard's `ends`, from its weighted prefixes."""
    need, ends = int(rows["need"].iloc[0]), tuple(rows["ends"].iloc[0])
    sets: list[tuple[tuple[int, ...], int]] = []

    def grow(suffix: tuple[int, ...], prefixes: list[tuple[list[int], int]]) -> None:
        counts: dict[int, int] = {}
        for items, weight in prefixes:
            for i in items:
                counts[i] = counts.get(i, 0) + weight
        for item, freq in counts.items():
            if freq < need:
                continue
            sets.append(((*suffix, item), freq))
            projected: dict[tuple[int, ...], int] = {}
            for items, weight in prefixes:
                if item in items:
                    before = tuple(i for i in items[: items.index(item)] if counts[i] >= need)
                    if before:
                        projected[before] = projected.get(before, 0) + weight
            if projected:
                grow((*suffix, item), [(list(k), w) for k, w in projected.items()])

    prefixes = [(list(p), int(w)) for p, w in zip(rows["prefix"], rows["weight"])]
    whole = sum(w for _, w in prefixes)
    if len(ends) == 2 and whole >= need:
        sets.append((ends, whole))
    if whole >= need:
        grow(ends, prefixes)
    columns = {"ranks": pd.Series([list(s) for s, _ in sets], dtype=object), "freq": pd.Series([f for _, f in sets], dtype="int64")}
    return pd.DataFrame({"grp": pd.Series([rows["grp"].iloc[0]] * len(sets), dtype=rows["grp"].dtype), **columns})


def frequent_itemsets(long: DataFrame, algorithm: str = "fpgrowth", min_support: float = config.MIN_SUPPORT) -> DataFrame:
    if algorithm not in ("apriori", "fpgrowth"):
        raise ValueError("algorithm must be 'apriori' or 'fpgrowth'")
    return apriori(long, min_support) if algorithm == "apriori" else fpgrowth(long, min_support)
