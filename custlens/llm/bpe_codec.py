"""BPE encoding and decoding with forced boundaries.

A byte pair that occurs inside no token of the vocabulary can never be joined, so each such place is a certain cut
(`Vocabulary.joinable`; the last byte of a word counts as a symbol of its own). The fragments between cuts are encoded
independently, all of a batch at once, and their ids concatenated. Narrow work: no shuffle, one pass over the texts.

Defined cases: a null or empty text has no ids and decodes to "". Special tokens' strings are their ids. Repeated rows are
encoded each. Columns that have an output's name are replaced. Decoding joins the tokens' texts by one space, which is what
the library does for a vocabulary without a decoder; other vocabularies are refused.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from custlens.llm import bpe
from custlens.llm.batches import add_columns


def cut_and_encode(voc: bpe.Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of words, flat, and their number per word: cut at certain boundaries, encode the fragments, concatenate."""
    codes, word_start = bpe.first_symbols(voc, words)
    cut = np.ones(len(codes), bool)
    cut[1:] = ~voc.joinable[codes[:-1] & 255, codes[1:]]
    cut[word_start] = True
    starts = np.flatnonzero(cut)
    ids, count = bpe.merge_ragged(voc, voc.symbols[codes], starts)
    return ids, np.add.reduceat(count, np.searchsorted(starts, word_start))


def encode_batch(voc: bpe.Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, flat, and their number per text. Very long texts are taken piece by piece."""
    if any(t and len(t) > bpe.CHARS_AT_ONCE for t in texts):
        each = [[_encode(voc, [p])[0] for p in bpe.pieces_at_blanks(t or "")] for t in texts]
        return np.concatenate([x for e in each for x in e]), np.array([sum(map(len, e)) for e in each], np.int64)
    return _encode(voc, texts)


def _encode(voc: bpe.Vocabulary, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    words = bpe.pre_tokens(voc, texts)
    flat, begin, count = bpe.encode_words(voc, words.distinct, cut_and_encode)
    specials = len(words.special_ids)
    begin = np.append(begin, len(flat) + np.arange(specials))
    count = np.append(count, np.ones(specials, np.int64))
    each = count[words.word]
    ids = bpe.gather_ragged(np.append(flat, words.special_ids).astype(np.int32), begin[words.word], each)
    return ids, np.bincount(words.doc, weights=each, minlength=len(texts)).astype(np.int64)


class Decoder:
    """Token texts as one flat byte array; decoding gathers them."""

    def __init__(self, voc: bpe.Vocabulary) -> None:
        if not voc.suffix:
            raise ValueError("this vocabulary has a decoder of its own")
        raw = [(t + " ").encode() for t in voc.token_text]
        self.flat = np.frombuffer(b"".join(raw), np.uint8)
        self.count = np.array([len(r) for r in raw], np.int64)
        self.begin = np.cumsum(self.count) - self.count

    def decode(self, ids: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 of all texts, flat, and the bytes of each."""
        size = self.count[ids]
        owner = np.repeat(np.arange(len(count)), count)
        length = np.bincount(owner, weights=size, minlength=len(count)).astype(np.int64)
        data = bpe.gather_ragged(self.flat, self.begin[ids], size)
        keep = np.ones(len(data), bool)
        keep[(np.cumsum(length) - 1)[length > 0]] = False  # no space after the last token
        return data[keep], np.maximum(length - 1, 0)


@functools.cache
def decoder_of(vocabulary_path: str) -> Decoder:
    return Decoder(bpe.vocabulary(vocabulary_path))


def encode(df: DataFrame, vocabulary_path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """`df` with the token ids of each text as an array and, if `decoded` names a column, the text they decode to."""

    def compute(texts: list) -> list[pa.Array]:
        voc = bpe.vocabulary(vocabulary_path)
        flat, count = encode_batch(voc, texts)
        out = [pa.ListArray.from_arrays(_offsets(count), pa.array(flat, pa.int32()))]
        if decoded:
            data, length = decoder_of(vocabulary_path).decode(flat, count)
            out.append(pa.StringArray.from_buffers(len(texts), _offsets(length).buffers()[1], pa.py_buffer(data)))
        return out

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False))] + ([T.StructField(decoded, T.StringType())] if decoded else [])
    return add_columns(df, text, fields, compute)


def _offsets(count: np.ndarray) -> pa.Array:
    return pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
