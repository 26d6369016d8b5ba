"""Sources and sinks for invoice lines and stage tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("Invoice", T.StringType()),
    T.StructField("StockCode", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("Quantity", T.IntegerType()),
    T.StructField("InvoiceDate", T.TimestampNTZType()),
    T.StructField("Price", T.DoubleType()),
    T.StructField("Customer ID", T.DoubleType()),
    T.StructField("Country", T.StringType()),
])


def load_raw(spark: SparkSession, *parts: str) -> DataFrame:
    """Bag-union of the raw parts (CSV files or Parquet), column names trimmed.

    CSV parts are read by header with every column as text; cleaning coerces types, so that a bad
    id or date becomes NULL there instead of failing the read. A missing part raises at once.
    """
    if not parts:
        raise ValueError("no raw part given")
    frames = []
    for path in parts:
        if path.rstrip("/").endswith(".csv"):
            df = spark.read.option("header", True).option("multiLine", False).csv(path)
        else:
            df = spark.read.parquet(path)
        frames.append(trim_names(df))
    return union_parts(*frames)


def trim_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def union_parts(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def write_clean(lines: DataFrame, path: str) -> None:
    """Clean lines as Parquet, one folder per invoice month so that cutoff filters prune folders.

    Rebalancing by month and letting AQE split large ones avoids both tiny files and a hot month.
    """
    out = lines.withColumn("invoice_month", F.date_format("InvoiceDate", "yyyy-MM"))
    out.hint("rebalance", "invoice_month").write.mode("overwrite").partitionBy("invoice_month").parquet(path)


def read_clean(spark: SparkSession, path: str, before=None) -> DataFrame:
    df = spark.read.parquet(path)
    if before is not None:
        month = before.strftime("%Y-%m")
        df = df.filter(F.col("invoice_month").cast("string") <= month).filter(F.col("InvoiceDate") < F.lit(before))
    return df.drop("invoice_month")


def write_csv(df: DataFrame, path: str) -> None:
    """Stage table as CSV with a header; arrays are joined by commas since CSV has no arrays."""
    flat = [
        F.array_join(f.name, ",").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
