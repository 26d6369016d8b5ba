"""Token counts by rank-synchronous array merging.

Pre-tokens of a batch are ragged numpy arrays; every round applies each sequence's lowest-rank pair at all its places, and
the surviving symbols are counted (`bpe.merge_ragged`). Narrow work: no shuffle, one pass over the texts, memory bounded by
one batch and by a bounded store of pre-tokens seen before.

Defined cases: a null or empty text has 0 tokens. A special token's string in a text is one token. Lone surrogates do not
occur in Spark strings. Repeated rows are counted each. A column that has the output's name is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from custlens.llm import bpe
from custlens.llm.batches import add_columns


def merged(voc: bpe.Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    codes, starts = bpe.first_symbols(voc, words)
    return bpe.merge_ragged(voc, voc.symbols[codes], starts)


def counts(voc: bpe.Vocabulary, texts: list[str | None]) -> np.ndarray:
    """Number of tokens of each text. Very long texts are taken piece by piece."""
    if any(t and len(t) > bpe.CHARS_AT_ONCE for t in texts):
        return np.array([sum(int(_counts(voc, [p])[0]) for p in bpe.pieces_at_blanks(t or "")) for t in texts], np.int64)
    return _counts(voc, texts)


def _counts(voc: bpe.Vocabulary, texts: list[str | None]) -> np.ndarray:
    words = bpe.pre_tokens(voc, texts)
    _, _, count = bpe.encode_words(voc, words.distinct, merged)
    each = np.append(count, np.ones(len(words.special_ids), np.int64))[words.word]
    return np.bincount(words.doc, weights=each, minlength=len(texts)).astype(np.int64)


def count_tokens(df: DataFrame, vocabulary_path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """`df` with the number of tokens of each text. `vocabulary_path`: a tokenizers JSON file that every executor has."""

    def compute(texts: list) -> list[pa.Array]:
        return [pa.array(counts(bpe.vocabulary(vocabulary_path), texts), pa.int64())]

    return add_columns(df, text, [T.StructField(out, T.LongType())], compute)
