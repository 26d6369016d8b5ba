"""Named queries over the driver tables, each beside the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

# Added before rounding, in units of the last digit: keeps exact halves (sums of cents over an even count) off the edge.
EDGE_SHIFT = 0.2137318

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None, digits: Mapping[str, int] | None = None):
    """Register a query. `digits` rounds floating columns on both sides, since sums in another order differ in the last bits."""
    digits = dict(digits or {})
    shift = {c: f"{EDGE_SHIFT * 10.0 ** -d:.17f}" for c, d in digits.items()}

    def wrap(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            df = fn(spark, folder)
            return df.withColumns({c: F.round(F.col(c) + float(shift[c]), d) for c, d in digits.items()}) if digits else df

        QUERIES[name] = run
        if sql is not None:
            swaps = ", ".join(f'round("{c}" + CAST({shift[c]} AS DOUBLE), {d}) + 0.0 AS "{c}"' for c, d in digits.items())
            ORACLES[name] = f"SELECT * REPLACE ({swaps}) FROM ({sql}) AS t" if swaps else sql
        return fn

    return wrap
