"""Order/lineitem star schema read as retail invoice lines."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SNAPSHOT = datetime(2001, 8, 2)
CUTOFF = datetime(2001, 1, 1)
WINDOW_DAYS = 180


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def repeats(df: DataFrame, key: str) -> bool:
    """Whether a key that is not NULL stands in several rows."""
    return not df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n")).filter("n > 1").isEmpty()


def repeated_lines(spark: SparkSession, folder: str) -> bool:
    """Whether the joins to part, supplier and nation give some line several times."""
    return any(repeats(table(spark, folder, name), key) for name, key in (("nation", "n_nationkey"), ("supplier", "s_suppkey"), ("part", "p_partkey")))


def raw_lines(spark: SparkSession, folder: str, item: str = "l_partkey", described: bool = True, texts: bool = True) -> DataFrame:
    """Lines in the raw retail schema. Returned lines carry a "C" invoice, as cancellations do.

    The joins to part and supplier are left joins on their unique keys, so they never change the line
    count and AQE may broadcast whichever side proves small. `described=False` leaves out what needs them, `texts=False`
    the description only: part is not joined then, unless its keys repeat and so repeat lines.
    """
    line, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey)
    cancelled = F.when(F.col("l_returnflag") == "R", "C").otherwise("")
    columns = {
        "Invoice": F.concat(cancelled, F.col("o_orderkey").cast("string")),
        "StockCode": F.col(item if described else "l_partkey").cast("string"),
        "Description": F.col("p_name"),
        "Quantity": F.col("l_quantity"),
        "InvoiceDate": F.col("o_orderdate"),
        "Price": F.col("l_extendedprice") / F.col("l_quantity"),
        "Customer ID": F.col("o_custkey").cast("double"),
        "Country": F.col("n_name"),
    }
    if not texts:
        del columns["Description"]
    if described:
        part = table(spark, folder, "part").select("p_partkey", "p_name", "p_type", "p_brand")
        nation = table(spark, folder, "nation").select("n_nationkey", "n_name")
        supplier = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        if texts or item != "l_partkey" or repeats(part, "p_partkey"):
            joined = joined.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
        joined = joined.join(supplier.select("s_suppkey", "n_name"), F.col("l_suppkey") == F.col("s_suppkey"), "left")
    else:
        columns.pop("Description", None)
        del columns["Country"]
    return joined.select(*[c.alias(n) for n, c in columns.items()])


def event_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Purchase events as clean lines: one line per event, time of day kept to the microsecond."""
    return table(spark, folder, "events").filter("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("Invoice"),
        F.col("event_type").alias("StockCode"),
        F.col("ts").alias("InvoiceDate"),
        F.col("user_id").alias("CustomerID"),
        F.col("value").alias("TotalAmount"),
    )
