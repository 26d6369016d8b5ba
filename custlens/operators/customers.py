"""Per-customer recency, frequency, money and basket features, and churn labels."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from custlens import config


def moment(t: datetime) -> Column:
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def days_until(last: Column, snapshot: datetime) -> Column:
    """Whole elapsed days, time of day counted: 12:50 on the day before is 0 days ago."""
    return F.timestamp_diff("DAY", last, moment(snapshot)).cast("int")


def rfm(lines: DataFrame, snapshot: datetime = config.SNAPSHOT) -> DataFrame:
    """Recency, Frequency (distinct invoices), Monetary.

    Lines are first reduced to one row per (customer, invoice) with map-side combine, so one very
    active customer is spread over its invoices, and Frequency becomes a plain count.
    """
    return _per_invoice(lines).groupBy("CustomerID").agg(
        days_until(F.max("last"), snapshot).alias("Recency"),
        F.count("Invoice").alias("Frequency"),
        F.sum("value").alias("Monetary"),
    )


def _per_invoice(lines: DataFrame) -> DataFrame:
    return lines.groupBy("CustomerID", "Invoice").agg(F.max("InvoiceDate").alias("last"), F.sum("TotalAmount").alias("value"))


def basket_behaviour(lines: DataFrame) -> DataFrame:
    """Mean invoice value and mean invoice item count."""
    invoices = lines.groupBy("CustomerID", "Invoice").agg(
        F.sum("TotalAmount").alias("value"), F.sum("Quantity").alias("items")
    )
    return invoices.groupBy("CustomerID").agg(
        F.avg("value").alias("avg_basket_value"), F.avg("items").alias("avg_basket_size")
    )


def product_variety(lines: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct if approximate else F.count_distinct
    return lines.groupBy("CustomerID").agg(count("StockCode").alias("unique_products"))


def dominant_country(lines: DataFrame) -> DataFrame:
    """Country of most lines; a tie goes to the alphabetically first. Two aggregates, no window or sort."""
    counts = lines.filter(F.col("Country").isNotNull()).groupBy("CustomerID", "Country").agg(F.count("*").alias("n"))
    return counts.groupBy("CustomerID").agg(F.min(F.struct(-F.col("n"), "Country"))["Country"].alias("DominantCountry"))


def customer_features(lines: DataFrame, snapshot: datetime = config.SNAPSHOT) -> DataFrame:
    """All customer features. The first shuffle of each branch is keyed finer than the customer.

    Grouping sets reduce lines to (customer, invoice) and (customer, code) partials in one scan, and a
    second hash aggregate reads each kind with conditional aggregates. The country keeps its own
    branch: a text in the aggregation buffer would force a sort, which is cheap only on the few
    (customer, country) counts. Both branches end partitioned by customer, so the join adds no shuffle.
    """
    c, inv, code = (F.col(x) for x in ("CustomerID", "Invoice", "StockCode"))
    columns = ["CustomerID", "Invoice", "StockCode", "InvoiceDate", "Quantity", "TotalAmount"]
    partial = lines.select(*columns).groupingSets([[c, inv], [c, code]], c, inv, code).agg(
        F.grouping_id().alias("kind"),
        F.max("InvoiceDate").alias("last"),
        F.sum("TotalAmount").alias("value"),
        F.sum("Quantity").alias("items"),
    )
    # grouping_id bits: customer, invoice, code; 1 = rolled up
    invoice, product = (F.col("kind") == k for k in (0b001, 0b010))
    numbers = partial.groupBy("CustomerID").agg(
        days_until(F.max(F.when(invoice, F.col("last"))), snapshot).alias("Recency"),
        F.count(F.when(invoice, inv)).alias("Frequency"),
        F.sum(F.when(invoice, F.col("value"))).alias("Monetary"),
        F.avg(F.when(invoice, F.col("value"))).alias("avg_basket_value"),
        F.avg(F.when(invoice, F.col("items"))).alias("avg_basket_size"),
        F.count(F.when(product, code)).alias("unique_products"),
    )
    return numbers.join(dominant_country(lines), "CustomerID", "left")


def before(lines: DataFrame, cutoff: datetime) -> DataFrame:
    return lines.filter(F.col("InvoiceDate") < moment(cutoff))


def pre_cutoff_features(lines: DataFrame, cutoff: datetime = config.CHURN_CUTOFF, check: bool = False) -> DataFrame:
    """Features from lines strictly before the cutoff, as of the cutoff. `check` raises when there are none."""
    history = before(lines, cutoff)
    if check and history.isEmpty():
        raise ValueError(f"no lines before the cutoff {cutoff}")
    return customer_features(history, cutoff)


def churn_labels(
    lines: DataFrame, cutoff: datetime = config.CHURN_CUTOFF, window_days: int = config.CHURN_WINDOW_DAYS
) -> DataFrame:
    """Of customers seen before the cutoff, 1 when none of their lines falls in [cutoff, cutoff + window).

    One aggregate with two flags; lines after the window are not read.
    """
    end = cutoff + timedelta(days=window_days)
    day = F.col("InvoiceDate")
    flags = lines.filter(day < moment(end)).groupBy("CustomerID").agg(
        F.max((day < moment(cutoff)).cast("int")).alias("seen"), F.max((day >= moment(cutoff)).cast("int")).alias("back")
    )
    return flags.filter("seen = 1").select("CustomerID", (1 - F.col("back")).alias("churn"))


def supervised_frame(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Features joined with labels; rows with any missing value dropped; missing columns raise."""
    needed = [*config.NUMERIC, config.COUNTRY]
    missing = [c for c in needed if c not in features.columns] + [c for c in [config.LABEL] if c not in labels.columns]
    if missing:
        raise KeyError(f"missing required columns {missing}")
    joined = features.join(labels, config.ID)
    return joined.select(
        config.ID, *needed[:-1], F.col(config.COUNTRY).cast("string").alias(config.COUNTRY),
        F.col(config.LABEL).cast("int").alias(config.LABEL),
    ).na.drop(subset=[*needed, config.LABEL])
