"""Reporting queries over clean lines, features and segments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from custlens import config
from custlens.functions.ordering import global_rank


def monthly_revenue(lines: DataFrame) -> DataFrame:
    return lines.groupBy(F.date_trunc("month", "InvoiceDate").cast("date").alias("month")).agg(F.sum("TotalAmount").alias("revenue"))


def top_products(lines: DataFrame, k: int = 10) -> DataFrame:
    revenue = lines.groupBy("StockCode").agg(F.sum("TotalAmount").alias("revenue"))
    return revenue.orderBy(F.desc("revenue"), "StockCode").limit(k)


def top_export_countries(lines: DataFrame, home: str = "United Kingdom", k: int = 10) -> DataFrame:
    revenue = lines.filter(F.col("Country") != home).groupBy("Country").agg(F.sum("TotalAmount").alias("revenue"))
    return revenue.orderBy(F.desc("revenue"), "Country").limit(k)


def pareto_curve(lines: DataFrame) -> DataFrame:
    """Customers by revenue, with the share of revenue held by them and everyone above them."""
    revenue = lines.groupBy("CustomerID").agg(F.sum("TotalAmount").alias("revenue"))
    ranked = global_rank(revenue, [F.desc("revenue"), F.asc("CustomerID")], "position", {"upto": "revenue"})
    total = ranked.agg(F.sum("revenue").alias("total"), F.count("*").alias("n")).first()
    n = total["n"]
    return ranked.select(
        "CustomerID", "revenue", "position",
        (F.lit(0.0) if n < 2 else (F.col("position") - 1) / F.lit(n - 1)).alias("customer_share"),
        (F.col("upto") / F.lit(total["total"])).alias("revenue_share"),
    )


def pareto_share(lines: DataFrame, top: float = 0.2) -> DataFrame:
    """Revenue share at the element that `top` of the customers points to."""
    curve = pareto_curve(lines)
    n = curve.count()
    return curve.filter(F.col("position") == int(top * n) + 1).select("revenue_share")


def histogram(df: DataFrame, columns: list[str], bins: int, log: tuple[str, ...] = ()) -> DataFrame:
    """Equal-width counts per column, all columns in two passes; the last bin is closed on the right."""
    for c in columns:
        v = F.col(c).cast("double")
        df = df.withColumn(c, F.log1p(v) if c in log else v)
    edges = df.agg(*[F.min(c).alias(f"lo_{c}") for c in columns], *[F.max(c).alias(f"hi_{c}") for c in columns]).first()
    parts = []
    for c in columns:
        low, high = edges[f"lo_{c}"], edges[f"hi_{c}"]
        if low is None:
            continue
        if low == high:
            low, high = low - 0.5, high + 0.5
        width = (high - low) / bins
        place = F.least(F.floor((F.col(c) - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("int")
        parts.append(F.when(F.col(c).isNotNull(), F.struct(F.lit(c).alias("feature"), place.alias("bin"), F.lit(low).alias("low"), F.lit(width).alias("width"))))
    placed = df.select(F.explode(F.array(*parts)).alias("t")).filter("t is not null").select("t.*")
    counted = placed.groupBy("feature", "bin", "low", "width").agg(F.count("*").alias("n"))
    return counted.select("feature", "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("left_edge"), "n")


def segment_product_share(lines: DataFrame, segments: DataFrame, k: int = 15) -> DataFrame:
    """Share of each segment's units over the k products with most units, absent pairs as 0.

    Lines reduce to (segment, code) sums once; top products and shares are read from those sums.
    """
    sold = lines.join(segments.select("CustomerID", "cluster"), "CustomerID").groupBy("cluster", "StockCode").agg(F.sum("Quantity").alias("units"))
    top = sold.groupBy("StockCode").agg(F.sum("units").alias("units")).orderBy(F.desc("units"), "StockCode").limit(k)
    codes = [r["StockCode"] for r in top.collect()]
    wide = sold.filter(F.col("StockCode").isin(codes)).groupBy("cluster").pivot("StockCode", sorted(codes)).agg(F.sum("units")).na.fill(0.0)
    pairs = F.array(*[F.struct(F.lit(c).alias("StockCode"), F.col(f"`{c}`").alias("units")) for c in sorted(codes)])
    total = sum((F.col(f"`{c}`") for c in sorted(codes)), F.lit(0.0))
    long = wide.select("cluster", total.alias("total"), F.explode(pairs).alias("t"))
    return long.select("cluster", "t.StockCode", (F.col("t.units") / F.col("total")).alias("share"))


def profile_minmax(profile: DataFrame, columns: tuple[str, ...] = ("Recency_mean", "Frequency_mean", "Monetary_mean")) -> DataFrame:
    """Cluster profile scaled to [0, 1] per column; one row per cluster, so the window is tiny."""
    everything = Window.partitionBy()
    scaled = []
    for c in columns:
        low, high = F.min(c).over(everything), F.max(c).over(everything)
        scaled.append(F.try_divide(F.col(c) - low, high - low).alias(c))
    return profile.select("cluster", *scaled)


def rule_edges(rules: DataFrame, k: int = 20) -> DataFrame:
    """Edges of the rule graph: the k strongest rules."""
    from custlens.operators.rules import strongest_first

    top = rules.orderBy(*strongest_first()).limit(k)
    return top.select(F.array_join("antecedents", ", ").alias("source"), F.array_join("consequents", ", ").alias("target"), "lift")


def churn_overview(labels: DataFrame, segments: DataFrame) -> DataFrame:
    """Churn rate per segment and over all labelled customers (segment NULL) in one pass."""
    joined = labels.join(segments.select("CustomerID", "cluster"), "CustomerID")
    return joined.rollup("cluster").agg(F.count("*").alias("n_customers"), F.avg(config.LABEL).alias("churn_rate"))
