"""Cleaning of raw invoice lines, and the reports that describe it."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens import config
from custlens.functions.quantiles import exact_quantiles
from custlens.runtime import materialize

CLIPPED = ["Quantity", "Price"]


def customer_id(c: Column) -> Column:
    """Whole-number id; text that is no number becomes NULL. "17850.0" is 17850."""
    return c.try_cast("double").try_cast("bigint")


def is_cancelled(invoice: Column) -> Column:
    return F.coalesce(invoice.cast("string").startswith("C"), F.lit(False))


def keep_valid(raw: DataFrame) -> DataFrame:
    """Known customer, not cancelled, positive quantity and price."""
    named = raw.withColumn("CustomerID", customer_id(F.col("Customer ID"))).drop("Customer ID")
    for c in CLIPPED:
        named = named.withColumn(c, F.col(c).try_cast("double"))
    return named.filter(F.col("CustomerID").isNotNull()).filter(~is_cancelled(F.col("Invoice"))).filter(
        (F.col("Quantity") > 0) & (F.col("Price") > 0)
    )


def invoice_time(df: DataFrame) -> Column:
    """InvoiceDate as a timestamp without zone; unreadable text becomes NULL."""
    kind = df.schema["InvoiceDate"].dataType
    return F.col("InvoiceDate") if isinstance(kind, T.TimestampNTZType) else F.col("InvoiceDate").try_cast("timestamp_ntz")


def winsor_bounds(
    raw: DataFrame, q: tuple[float, float] = config.WINSOR, fit_before: datetime | None = None
) -> dict[str, list[float | None]]:
    """Clip bounds of Quantity and Price over the valid lines.

    `fit_before` fits on lines before a cutoff only, so that bounds do not look ahead.
    """
    valid = keep_valid(raw)
    if fit_before is not None:
        valid = valid.filter(invoice_time(valid) < F.lit(fit_before).cast("timestamp_ntz"))
    # two narrow columns, written: the passes of the quantiles do not read and join the raw lines again
    return bounds_of(materialize(valid.select(*CLIPPED)), q)


def bounds_of(valid: DataFrame, q: tuple[float, float] = config.WINSOR) -> dict[str, list[float | None]]:
    """Clip bounds over valid lines that are stored."""
    return exact_quantiles(valid.select(*CLIPPED), {c: list(q) for c in CLIPPED})


def clean(
    raw: DataFrame,
    q: tuple[float, float] | None = config.WINSOR,
    bounds: dict[str, list[float | None]] | None = None,
    fit_before: datetime | None = None,
) -> DataFrame:
    """Raw lines to clean lines. Pass `bounds` to reuse ones already fitted; `q=None` leaves values as they are."""
    if bounds is None and q is not None:
        bounds = winsor_bounds(raw, q, fit_before)
    return finish(keep_valid(raw), bounds)


def finish(lines: DataFrame, bounds: dict[str, list[float | None]] | None = None) -> DataFrame:
    """Valid lines to clean lines: clipped, dated, trimmed; text columns that are not there stay away."""
    for c, (low, high) in (bounds or {}).items():
        if low is not None:
            lines = lines.withColumn(c, F.least(F.greatest(F.col(c), F.lit(low)), F.lit(high)))
    return (
        lines.withColumn("InvoiceDate", invoice_time(lines))
        .filter(F.col("InvoiceDate").isNotNull())
        .select(
            F.col("Invoice").cast("string").alias("Invoice"),
            *[F.trim(F.col(c).cast("string")).alias(c) for c in ("StockCode", "Description") if c in lines.columns],
            "Quantity",
            "InvoiceDate",
            "Price",
            "CustomerID",
            F.trim(F.col("Country").cast("string")).alias("Country"),
            (F.col("Quantity") * F.col("Price")).alias("TotalAmount"),
        )
    )


def cleaning_audit(raw: DataFrame) -> DataFrame:
    """Share of raw lines hit by each filter (they overlap), what lines without id hold, share removed. One pass."""
    no_id = customer_id(F.col("Customer ID")).isNull()
    cancelled = is_cancelled(F.col("Invoice"))
    quantity, price = (F.col(c).try_cast("double") for c in CLIPPED)
    positive = F.coalesce((quantity > 0) & (price > 0), F.lit(False))
    readable = invoice_time(raw).isNotNull()
    revenue = quantity * price

    def share(flag: Column) -> Column:
        return F.avg(flag.cast("double"))

    return raw.agg(
        F.count("*").alias("n_raw"),
        share(no_id).alias("missing_id_share"),
        share(cancelled).alias("cancelled_share"),
        share(~positive).alias("non_positive_share"),
        F.try_divide(F.sum(F.when(no_id, quantity).otherwise(0.0)), F.sum(quantity)).alias("missing_id_unit_share"),
        F.try_divide(F.sum(F.when(no_id, revenue).otherwise(0.0)), F.sum(revenue)).alias("missing_id_revenue_share"),
        share(~(~no_id & ~cancelled & positive & readable)).alias("removed_share"),
    )


def raw_vs_clean(raw: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows and distinct customers, invoices, codes and countries before and after cleaning.

    Each distinct count is its own two-step aggregate over one narrow column of an exploded
    (column, value) list, so several distinct counts do not multiply whole rows.
    """
    keys = ["CustomerID", "Invoice", "StockCode", "Country"]
    raw = raw.withColumn("CustomerID", customer_id(F.col("Customer ID")))

    def long(df: DataFrame, stage: str) -> DataFrame:
        pairs = [F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys]
        return df.select(F.lit(stage).alias("stage"), F.explode(F.array(*pairs)).alias("t")).select("stage", "t.*")

    both = long(raw, "raw").unionByName(long(lines, "clean"))
    distinct = both.groupBy("stage", "k", "v").agg(F.count("*").alias("n"))

    def counted(key: str) -> Column:
        return F.count(F.when((F.col("k") == key) & F.col("v").isNotNull(), 1))

    return distinct.groupBy("stage").agg(
        F.coalesce(F.sum(F.when(F.col("k") == "Invoice", F.col("n"))), F.lit(0)).alias("n_lines"),
        counted("CustomerID").alias("n_customers"),
        counted("Invoice").alias("n_invoices"),
        counted("StockCode").alias("n_codes"),
        counted("Country").alias("n_countries"),
    )


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs per column, one row each, in one pass."""
    counts = df.agg(*[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_null")) for i, c in enumerate(df.columns)])
    return counts.select(F.explode(rows).alias("t")).select("t.*")


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, interpolated quartiles, max; one row per column."""
    quartiles = exact_quantiles(df, {c: [0.25, 0.5, 0.75] for c in columns})
    aggs = []
    for c in columns:
        v = F.col(c).cast("double")
        stats = [F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min")]
        stats += [F.lit(x).cast("double").alias(n) for n, x in zip(("q25", "q50", "q75"), quartiles[c])]
        aggs.append(F.struct(F.lit(c).alias("feature"), *stats, F.max(v).alias("max")).alias(c))
    return df.agg(*aggs).select(F.explode(F.array(*columns)).alias("t")).select("t.*")
