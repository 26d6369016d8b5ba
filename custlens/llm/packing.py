"""Vector bin packing of examples into training sequences.

A sequence has simultaneous limits on tokens, segments and loss-bearing tokens. Each open sequence takes, again and again,
the piece whose demand vector has the largest weighted dot product with what is left of the limits (a dimension weighs as
much as the waiting pieces ask of it); when none fits whole, the best one is cut to fill the rest. Pieces wait in a bounded
pool, and every input partition packs its own rows: no shuffle, and only its last sequence can stay part full.

Defined cases: an empty or null example is its end token alone. Repeated and null ids are packed like others. An example of
any length is cut; all its tokens lie in exactly one piece each. Extra columns are not carried over. No rows, no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from custlens.llm import bpe
from custlens.llm.bpe_codec import encode_batch
from custlens.runtime import ship_package, tidy

PIECE_FIELDS = "start long, length long, doc_tokens long, sequence_id long, segment int, offset long, loss_tokens long, ids binary"


@dataclass(frozen=True)
class Limits:
    """Of one sequence. `shortest_cut`: a gap below this many tokens stays padding rather than being filled by a cut."""

    tokens: int = 4096
    segments: int = 64
    loss: int = 4096
    shortest_cut: int = 4


@dataclass
class Example:
    key: object
    ids: np.ndarray
    loss_before: np.ndarray  # loss-bearing tokens before each token, and after the last

    def loss(self, start: int, end: int) -> int:
        return int(self.loss_before[end] - self.loss_before[start])

    def longest(self, start: int, tokens: int, loss: int) -> int:
        """Tokens from `start` on that stay within both limits."""
        end = min(start + tokens, len(self.ids))
        return min(end, int(np.searchsorted(self.loss_before, self.loss_before[start] + loss, "right")) - 1) - start


class Packer:
    """Packs examples as they come; `add` and `finish` yield sequences, each a list of (example, start, end)."""

    def __init__(self, limits: Limits, pool_pieces: int = 2048, pool_tokens: int = 2_000_000) -> None:
        self.limits, self.pool_pieces, self.pool_tokens = limits, pool_pieces, pool_tokens
        self.caps = np.array([limits.tokens, limits.segments, limits.loss], float)
        self.pieces: list[tuple[Example, int, int]] = []
        self.demand = np.zeros((2 * pool_pieces, 3))
        self.held = 0

    def add(self, example: Example) -> Iterator[list[tuple[Example, int, int]]]:
        at, n = 0, len(example.ids)
        while at < n:
            size = example.longest(at, self.limits.tokens, self.limits.loss)
            if size < 1:
                raise ValueError("a single token exceeds the limit on loss-bearing tokens")
            if size == self.limits.tokens:
                yield [(example, at, at + size)]
            else:
                self._wait(example, at, at + size)
            at += size
            if len(self.pieces) >= self.pool_pieces or self.held >= self.pool_tokens:
                yield from self._pack(self.pool_pieces // 2, self.pool_tokens // 2)

    def finish(self) -> Iterator[list[tuple[Example, int, int]]]:
        yield from self._pack(0, 0)

    def _wait(self, example: Example, start: int, end: int) -> None:
        k = len(self.pieces)
        if k == len(self.demand):
            self.demand = np.concatenate([self.demand, np.zeros_like(self.demand)])
        self.demand[k] = end - start, 1, example.loss(start, end)
        self.pieces.append((example, start, end))
        self.held += end - start

    def _take(self, k: int) -> tuple[Example, int, int]:
        piece, last = self.pieces[k], len(self.pieces) - 1
        self.pieces[k], self.demand[k] = self.pieces[last], self.demand[last]
        self.pieces.pop()
        self.held -= piece[2] - piece[1]
        return piece

    def _pack(self, leave_pieces: int, leave_tokens: int) -> Iterator[list[tuple[Example, int, int]]]:
        while self.pieces and (len(self.pieces) > leave_pieces or self.held > leave_tokens):
            yield self._fill()

    def _fill(self) -> list[tuple[Example, int, int]]:
        left, out = self.caps.copy(), []
        weight = self.demand[: len(self.pieces)].sum(axis=0) / self.caps**2
        while self.pieces and left[0] >= 1 and left[1] >= 1:
            waiting = self.demand[: len(self.pieces)]
            score = waiting @ (weight * left / self.caps)
            fits = (waiting <= left).all(axis=1)
            if fits.any():
                k = int(np.argmax(np.where(fits, score, -1.0)))
                piece = self._take(k)
                left -= (piece[2] - piece[1], 1, piece[0].loss(piece[1], piece[2]))
                out.append(piece)
                continue
            k = int(np.argmax(score))
            example, start, end = self.pieces[k]
            size = example.longest(start, int(left[0]), int(left[2]))
            if size < self.limits.shortest_cut:
                break
            self._take(k)
            out.append((example, start, start + size))
            left -= (size, 1, example.loss(start, start + size))
            self._wait(example, start + size, end)
        return out


def pack(df: DataFrame, vocabulary_path: str, end_id: int, key: str = "doc_id", parts: str = "parts", limits: Limits = Limits()) -> DataFrame:
    """Pieces of all examples of `df`. `parts`: array<struct<text, loss>>, encoded in order, then `end_id` (loss-bearing if the last part is).

    Per piece: `key` (with `_key` behind its name if that is the name of another column here), `start` (tokens of its example before it), `length`, `doc_tokens` (of its example), `sequence_id`,
    `segment` (its number in the sequence), `offset` (tokens before it there), `loss_tokens`, and `ids` (unsigned 32-bit,
    little-endian). Parts are encoded exactly as the vocabulary's library does.
    """
    ship_package(df.sparkSession)
    fields = T._parse_datatype_string(PIECE_FIELDS).fields
    named = f"{key}_key" if key.lower() in {f.name for f in fields} else key
    schema = T.StructType([T.StructField(named, df.schema[key].dataType), *fields])
    narrow = df.select(F.col(f"`{key}`"), F.col(f"`{parts}`"))
    rows_at_once = 4096

    def examples(batches) -> Iterator[Example]:
        voc = bpe.vocabulary(vocabulary_path)
        for batch in batches:
            keys, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            texts, flags, owner = [], [], []
            for i, each in enumerate(lists):
                for part in each or []:
                    texts.append((part or {}).get("text") or "")
                    flags.append(bool((part or {}).get("loss")))
                    owner.append(i)
            pending: dict[int, list[tuple[np.ndarray, bool]]] = {}
            row = 0
            for lo, hi in bpe.batches_of_texts(texts):
                flat, count = encode_batch(voc, texts[lo:hi])
                for j, ids in enumerate(np.split(flat, np.cumsum(count)[:-1]), lo):
                    pending.setdefault(owner[j], []).append((ids, flags[j]))
                ready = owner[hi] if hi < len(texts) else len(keys)
                for row in range(row, ready):
                    yield example(keys[row], pending.pop(row, []))
                row = ready
            for row in range(row, len(keys)):
                yield example(keys[row], [])

    def example(which, encoded: list[tuple[np.ndarray, bool]]) -> Example:
        ids = np.concatenate([*[x for x, _ in encoded], [end_id]]).astype(np.uint32)
        bears = np.concatenate([*[np.full(len(x), b) for x, b in encoded], [encoded[-1][1] if encoded else True]])
        bears[0] = False  # nothing comes before the first token, so nothing predicts it
        return Example(which, ids, np.concatenate([[0], np.cumsum(bears)]))

    def rows(sequences) -> Iterator[pa.RecordBatch]:
        at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        out: list[tuple] = []
        for sequence in sequences:
            offset = 0
            for segment, (e, start, end) in enumerate(sequence):
                out.append((e.key, start, end - start, len(e.ids), at, segment, offset, e.loss(start, end), e.ids[start:end].astype("<u4").tobytes()))
                offset += end - start
            at += 1
            if len(out) >= rows_at_once:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)

    def run(batches):
        packer = Packer(limits)

        def sequences():
            for e in examples(batches):
                yield from packer.add(e)
            yield from packer.finish()

        return rows(sequences())

    return narrow.mapInArrow(tidy(run), schema)


def document_parts(text: str = "text"):
    """A whole document as one loss-bearing part."""
    return F.array(F.struct(F.col(text).cast("string").alias("text"), F.lit(True).alias("loss")))


def conversation_examples(conversations: DataFrame) -> DataFrame:
    """One example per conversation: its turns in order, of which only the assistant's bear loss."""
    turn = F.struct("turn", F.col("text"), (F.lower("role") == "assistant").alias("loss"))
    turns = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return turns.select("conv_id", F.transform("turns", lambda t: F.struct(t["text"].alias("text"), F.coalesce(t["loss"], F.lit(False)).alias("loss"))).alias("parts"))
