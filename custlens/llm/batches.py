"""Columns computed from a text column in Arrow batches of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.llm.bpe import CHARS_AT_ONCE, batches_of_texts
from custlens.runtime import ship_package, tidy


def add_columns(df: DataFrame, text: str, fields: Sequence[T.StructField], compute: Callable[[list], list[pa.Array]], size: int = CHARS_AT_ONCE, keep_text: bool = True) -> DataFrame:
    """Add `fields`, computed by `compute(texts)` for runs of rows that hold about `size` characters. Columns of the same names are replaced, and the text goes unless `keep_text`."""
    ship_package(df.sparkSession)
    new = {f.name.lower() for f in fields} | ({text.lower()} if not keep_text else set())
    # a text that stays goes to Python once, any other as a last column of its own
    stays = keep_text and text.lower() not in new and isinstance(df.schema[text].dataType, T.StringType)
    if not stays:
        df = df.select("*", F.col(f"`{text}`").cast("string").alias("__text"))
    df = df.drop(*[c for c in df.columns if c.lower() in new])
    kept = [c for c in df.columns if c != "__text"]
    schema = T.StructType([f for f in df.schema.fields if f.name != "__text"] + list(fields))
    at = kept.index(text) if stays else len(kept)

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for lo, hi in batches_of_texts(texts, size):
                columns = [batch.column(i).slice(lo, hi - lo) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, *compute(texts[lo:hi])], names=[*kept, *[f.name for f in fields]])

    return df.mapInArrow(tidy(run), schema)
