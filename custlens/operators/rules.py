"""Association rules with any number of consequent items, their measures, pruning and descriptions."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from custlens import config
from custlens.operators.baskets import apriori, basket_sizes, fpgrowth, frequent_itemsets, long_baskets
from custlens.runtime import materialize

MEASURES = [
    "antecedent_support", "consequent_support", "support", "confidence", "lift", "representativity", "leverage",
    "conviction", "zhangs_metric", "jaccard", "certainty", "kulczynski",
]


def strongest_first() -> list[Column]:
    """A total order: lift ties between a rule and its mirror are broken by the other measures, then by items."""
    return [F.desc("lift"), F.desc("confidence"), F.desc("support"), F.asc("antecedents"), F.asc("consequents")]


def association_rules(
    itemsets: DataFrame, min_confidence: float = config.MIN_CONFIDENCE, min_lift: float = config.MIN_LIFT
) -> DataFrame:
    """Every split of every frequent itemset into two non-empty parts, filtered by confidence, then lift.

    Each itemset lists its proper subsets by bit mask; two equi-joins on (group, items) fetch the
    supports, which exist because every part of a frequent set is frequent.
    """
    size = F.size("items")
    masks = F.sequence(F.lit(1).cast("bigint"), F.call_function("shiftleft", F.lit(1).cast("bigint"), size) - 2)

    def part(bit: int) -> Column:
        return F.filter("items", lambda _, i: F.call_function("getbit", F.col("mask"), i) == bit)

    whole = itemsets.filter(size > 1).select("grp", "items", F.col("support"), F.explode(masks).alias("mask"))
    split = whole.select("grp", part(1).alias("antecedents"), part(0).alias("consequents"), "support")
    known = itemsets.select("grp", "items", "support")
    a = known.select("grp", F.col("items").alias("antecedents"), F.col("support").alias("antecedent_support"))
    c = known.select("grp", F.col("items").alias("consequents"), F.col("support").alias("consequent_support"))
    rules = split.join(a, ["grp", "antecedents"]).filter(F.col("support") / F.col("antecedent_support") >= F.lit(min_confidence))
    rules = with_measures(rules.join(c, ["grp", "consequents"]))
    return rules.filter(F.col("lift") >= F.lit(min_lift))


def with_measures(rules: DataFrame) -> DataFrame:
    s, a, c = F.col("support"), F.col("antecedent_support"), F.col("consequent_support")
    confidence = s / a
    leverage = s - a * c
    one = F.lit(1.0)
    worst = F.greatest(s * (1 - a), a * (c - s))
    return rules.select(
        "grp", "antecedents", "consequents", a, c, s,
        confidence.alias("confidence"),
        (confidence / c).alias("lift"),
        one.alias("representativity"),
        leverage.alias("leverage"),
        F.when(confidence >= 1, F.lit(float("inf"))).otherwise((1 - c) / (1 - confidence)).alias("conviction"),
        F.when(worst == 0, F.lit(0.0)).otherwise(leverage / worst).alias("zhangs_metric"),
        (s / (a + c - s)).alias("jaccard"),
        F.when(c >= 1, F.lit(0.0)).otherwise((confidence - c) / (1 - c)).alias("certainty"),
        ((s / a + s / c) / 2).alias("kulczynski"),
    )


def prune(rules: DataFrame) -> DataFrame:
    """The strongest rule per consequent set. The row_number limit is applied before the shuffle too."""
    best = Window.partitionBy("grp", "consequents").orderBy(*strongest_first())
    return rules.withColumn("_r", F.row_number().over(best)).filter("_r = 1").drop("_r")


def top_rules(rules: DataFrame, k: int = config.TOP_RULES) -> DataFrame:
    return rules.orderBy(*strongest_first()).limit(k)


def top_rules_per_group(rules: DataFrame, k: int = config.SEGMENT_TOP_RULES) -> DataFrame:
    best = Window.partitionBy("grp").orderBy(*strongest_first())
    return rules.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k).drop("_r")


def code_descriptions(lines: DataFrame, item: str = "StockCode") -> DataFrame:
    """Most frequent description per code, ties alphabetical: independent of row order."""
    known = lines.filter(F.col("Description").isNotNull() & F.col(item).isNotNull())
    counts = known.groupBy(F.col(item).alias("code"), "Description").agg(F.count("*").alias("n"))
    return counts.groupBy("code").agg(F.min(F.struct(-F.col("n"), "Description"))["Description"].alias("Description"))


def describe_rules(rules: DataFrame, descriptions: DataFrame, width: int = config.DESCRIPTION_WIDTH) -> DataFrame:
    """Readable names of both sides: distinct, cut to `width`, sorted, comma-joined; unknown codes stay codes.

    Takes rules of baskets (`grp`) and of segments (`cluster`).
    """
    group = "grp" if "grp" in rules.columns else "cluster"
    key = F.struct(group, "antecedents", "consequents")
    long = rules.select(
        key.alias("key"),
        F.explode(F.concat(
            F.transform("antecedents", lambda c: F.struct(F.lit("a").alias("side"), c.alias("code"))),
            F.transform("consequents", lambda c: F.struct(F.lit("c").alias("side"), c.alias("code"))),
        )).alias("t"),
    ).select("key", "t.*")
    named = long.join(descriptions, "code", "left").withColumn("name", F.left(F.coalesce("Description", "code"), F.lit(width)))

    def text(side: str) -> Column:
        return F.array_join(F.array_sort(F.collect_set(F.when(F.col("side") == side, F.col("name")))), ", ")

    texts = named.groupBy("key").agg(text("a").alias("antecedents_desc"), text("c").alias("consequents_desc"))
    texts = texts.select("key.*", "antecedents_desc", "consequents_desc")
    return rules.join(texts, [group, "antecedents", "consequents"])


def mine_rules(
    long: DataFrame,
    algorithm: str = "fpgrowth",
    min_support: float = config.MIN_SUPPORT,
    min_confidence: float = config.MIN_CONFIDENCE,
    min_lift: float = config.MIN_LIFT,
) -> tuple[DataFrame, DataFrame]:
    itemsets = frequent_itemsets(long, algorithm, min_support)
    return itemsets, association_rules(itemsets, min_confidence, min_lift)


def segment_rules(
    lines: DataFrame,
    segments: DataFrame,
    min_support: float = config.SEGMENT_MIN_SUPPORT,
    min_confidence: float = config.MIN_CONFIDENCE,
    min_lift: float = config.MIN_LIFT,
    min_invoices: int = config.SEGMENT_MIN_INVOICES,
    top: int = config.SEGMENT_TOP_RULES,
    item: str = "StockCode",
) -> tuple[DataFrame, DataFrame]:
    """Rules inside each segment, and a status row per segment that says why one has none.

    The segment is a grouping key through mining, so all segments share the same few jobs.
    """
    ids = segments.filter(F.col("cluster").isNotNull()).select("CustomerID", F.col("cluster").alias("_grp"))
    long = materialize(long_baskets(lines.join(ids, "CustomerID"), item, F.col("_grp")))
    sizes = materialize(basket_sizes(long))
    enough = long.join(sizes.filter(F.col("n_baskets") >= min_invoices).select("grp"), "grp", "left_semi")
    rules = association_rules(apriori(enough, min_support), min_confidence, min_lift)
    rules = materialize(top_rules_per_group(prune(rules), top))
    found = rules.groupBy("grp").agg(F.count("*").alias("n_rules"))
    every = segments.filter(F.col("cluster").isNotNull()).select(F.col("cluster").alias("grp")).distinct()
    status = every.join(sizes, "grp", "left").join(found, "grp", "left").na.fill(0, ["n_baskets", "n_rules"])
    few = F.concat(F.lit("too few invoices: "), F.col("n_baskets").cast("string"), F.lit(f" of {min_invoices}"))
    none = F.lit(f"nothing reaches support {min_support} and lift {min_lift}")
    reason = F.when(F.col("n_baskets") < min_invoices, few).when(F.col("n_rules") == 0, none)
    return rules.withColumnRenamed("grp", "cluster"), status.select(
        F.col("grp").alias("cluster"), "n_baskets", "n_rules", reason.alias("skip_reason")
    )


def compare_miners(long: DataFrame, min_support: float, min_confidence: float, min_lift: float) -> DataFrame:
    """Itemset and rule counts and wall time per algorithm; `n_differences` is 0 when both agree row by row."""
    spark, rows, tables = long.sparkSession, [], {}
    for name, miner in (("apriori", apriori), ("fpgrowth", fpgrowth)):
        start = time.perf_counter()
        itemsets = miner(long, min_support)
        tables[name] = itemsets.select("items", "freq")
        n_rules = association_rules(itemsets, min_confidence, min_lift).count()
        rows.append((name, tables[name].count(), n_rules, time.perf_counter() - start))
    a, b = tables["apriori"], tables["fpgrowth"]
    differences = a.exceptAll(b).count() + b.exceptAll(a).count()
    return spark.createDataFrame(
        [(*r, differences) for r in rows], "algorithm string, n_itemsets bigint, n_rules bigint, runtime_s double, n_differences bigint"
    )
