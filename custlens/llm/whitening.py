"""Whitening of embeddings by Chebyshev-filtered subspace iteration (Zhou, Saad, Tiago and Chelikowsky, 2006).

The fit list, each distinct integer vector once, is written as packed blocks. One product VQ of its covariance V with a
narrow block Q is one distributed pass: every task sums Xᵀ(XQ) of its centred rows, tasks are added up in groups, and the
driver holds matrices of `dim` rows and `width` columns only. A short block Krylov space gives the first block and both ends
of the spectrum. Each round then filters the block by a Chebyshev polynomial that is small on the unwanted interval and
grows fast above it (one pass per degree), orthogonalises it (QR) and turns it to Ritz vectors (Rayleigh-Ritz, one pass).
It ends when each wanted residual |Vq - eq| is certified: below `ANGLE` times the gap to the next Ritz value, so that the
vector is off by no more than that angle, or below `FLOOR` times the greatest eigenvalue, the rounding of a pass.
Should a whole round no longer lower the residuals, double precision is used up; that is accepted below `STALLED`.

Defined cases: rows whose vector is null or holds a null, NaN or infinite entry take no part; repeated rows are whitened
each, but fitted once. Entries beyond a long become the nearest long. Vectors of each length are fitted apart (a pass loop
per length: tables have one, rarely a few); empty vectors have no component. Fewer dimensions than components give as many
components as dimensions. A component without variance has a null `whitened`, and `explained` is null if nothing varies.
`deviation` is exact as decimal(38, 0), and null where that is too narrow. Only the key and the vector are read: extra
columns can not clash.
"""

from __future__ import annotations

import functools
import math
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from custlens.runtime import materialize, ship_package

SCALE = 256
COMPONENTS = 4
# Columns of the block: six for each wanted component, so that the unwanted interval begins well below the last of them.
WIDTH = 6 * COMPONENTS
DEGREE = 10
ANGLE = 1e-12
FLOOR = 2e-14
STALLED = 1e-11
MOST_ROUNDS = 60
BLOCK_ROWS = 4096
# A component below this part of the greatest eigenvalue has no variance but that of rounding.
NO_VARIANCE = 1e-13
DECIMAL_LIMIT = 10**38


def integer_vectors(df: DataFrame, key: str, vector: str, scale: int = SCALE) -> DataFrame:
    """`id` and `x` = floor(`scale` * entry) of the rows that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").alias("id"), v.alias("v")).where("v is not null")
    bad = F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return rows.where(~bad).select("id", F.transform("v", lambda c: F.floor(c * F.lit(float(scale))) + F.lit(0).cast("long")).alias("x"))


def _packed(rows: np.ndarray) -> tuple[str, bytes]:
    """Integers in the narrowest type that holds them."""
    kind = next(k for k in ("<i1", "<i2", "<i4", "<i8") if np.iinfo(k).min <= rows.min() and rows.max() <= np.iinfo(k).max)
    return kind, rows.astype(kind).tobytes()


def fit_list(vectors: DataFrame) -> DataFrame:
    """Each distinct `x` once: blocks of rows (`dim`, `kind`, `block`) in a written table."""

    def pack(batches):
        for batch in batches:
            x = batch.column(0)
            flat, ends = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()
            size = np.diff(ends)
            for dim in np.unique(size[size > 0]):
                rows = flat[ends[:-1][size == dim][:, None] + np.arange(dim)]
                for lo in range(0, len(rows), BLOCK_ROWS):
                    kind, block = _packed(rows[lo : lo + BLOCK_ROWS])
                    yield pa.RecordBatch.from_pydict({"dim": pa.array([dim], pa.int32()), "kind": [kind], "block": pa.array([block], pa.binary())})

    return materialize(vectors.select("x").distinct().mapInArrow(pack, "dim int, kind string, block binary"))


def _blocks(batches, dim: int):
    for batch in batches:
        for kind, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            yield np.frombuffer(block, kind).reshape(-1, dim).astype(np.int64)


def _exact_sums(rows: np.ndarray) -> list[int]:
    """Sums of each column, as Python's integers where a long is too narrow."""
    widest = max(1, int(rows.max()), -int(rows.min()))
    return [int(s) for s in (rows.astype(object) if len(rows) * widest >= 2**63 else rows).sum(axis=0)]


@dataclass
class Fit:
    """The fit list of one length: `blocks`, its number of vectors, and exact sums by dimension."""

    blocks: DataFrame
    dim: int
    n: int
    sums: list[int]

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @functools.cached_property
    def trace(self) -> float:
        """Of the covariance, by one pass."""
        return float(self.add_up((1,), lambda x: (x * x).sum())[0]) / self.n

    def add_up(self, shape: tuple[int, ...], part) -> np.ndarray:
        """The sum of `part(centred rows)` over the whole list, in one pass."""
        dim, mean = self.dim, self.mean

        def task(batches):
            total = np.zeros(shape)
            for rows in _blocks(batches, dim):
                total += part(rows - mean)
            yield pa.RecordBatch.from_pydict({"total": pa.array([total.tobytes()], pa.binary())})

        def together(parts: pd.DataFrame) -> pd.DataFrame:
            return pd.DataFrame({"total": [sum(np.frombuffer(t) for t in sorted(parts["total"])).tobytes()]})

        tasks = self.blocks.select("kind", "block").mapInArrow(task, "total binary")
        groups = max(1, math.isqrt(self.blocks.rdd.getNumPartitions()))
        parts = tasks.groupBy(F.pmod(F.spark_partition_id(), F.lit(groups)).alias("g")).applyInPandas(together, "total binary").collect()
        return sum((np.frombuffer(r.total) for r in sorted(parts)), np.zeros(math.prod(shape))).reshape(shape)

    def times(self, q: np.ndarray) -> np.ndarray:
        """VQ by one pass."""
        return self.add_up(q.shape, lambda x: x.T @ (x @ q)) / self.n


def fits(blocks: DataFrame) -> list[Fit]:
    """One for each length, with sums that are exact at any size."""

    def task(batches):
        for batch in batches:
            for dim, kind, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                rows = np.frombuffer(block, kind).reshape(-1, dim).astype(np.int64)
                digits = pa.array([Decimal(s) for s in _exact_sums(rows)], pa.decimal128(38, 0))
                yield pa.RecordBatch.from_pydict({"dim": pa.array([dim] * dim, pa.int32()), "at": pa.array(range(dim), pa.int32()), "n": pa.array([len(rows)] * dim, pa.int64()), "v": digits})

    summed = blocks.mapInArrow(task, "dim int, at int, n long, v decimal(38, 0)").groupBy("dim", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).toPandas()
    out = []
    for dim, each in summed.sort_values(["dim", "at"]).groupby("dim"):
        out.append(Fit(blocks.where(F.col("dim") == int(dim)), int(dim), int(each["n"].iloc[0]), [int(v) for v in each["v"]]))
    return out


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values, falling; vectors; their products with V."""
    h = q.T @ vq
    e, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return e[::-1], q @ turn, vq @ turn


def chebyshev(times, q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The block under the Chebyshev polynomial of `degree` that stays within one on [low, high], scaled to one at `top`."""
    half, middle = (high - low) / 2, (high + low) / 2
    first = sigma = half / (top - middle)
    before, now = q, (vq - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - middle * now) * (2 * after / half) - before * (sigma * after)
        sigma = after
    return now


def leading(times, dim: int, k: int = COMPONENTS, width: int = WIDTH, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The `k` greatest eigenvalues and their unit vectors (columns); `times` multiplies a block by V."""
    k, width = min(k, dim), min(width, dim)
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((dim, width)))[0]
    vq = times(q)
    e, q, vq = _ritz(q, vq)
    if width == dim:
        return e[:k], q[:, :k]
    # the block Krylov space [Q, VQ]: both ends of the spectrum, and the first block
    more = np.linalg.qr(np.concatenate([q, vq], axis=1))[0][:, width : min(2 * width, dim)]
    both, v_both = np.concatenate([q, more], axis=1), np.concatenate([vq, times(more)], axis=1)
    e, q, vq = _ritz(both, v_both)
    low = max(0.0, e[-1] - np.linalg.norm(vq[:, -1] - e[-1] * q[:, -1]))
    e, q, vq = e[:width], q[:, :width], vq[:, :width]
    last = math.inf
    for _ in range(MOST_ROUNDS):
        residual = np.linalg.norm(vq[:, :k] - q[:, :k] * e[:k], axis=0)
        gap = np.minimum(np.append(math.inf, e[: k - 1] - e[1:k]), e[:k] - e[1 : k + 1])
        if (residual <= np.maximum(ANGLE * gap, FLOOR * e[0])).all() or last <= 2 * residual.max() <= 2 * STALLED * e[0]:
            return e[:k], q[:, :k]
        last = residual.max()
        low = min(low, max(0.0, e[-1]))
        high = max(e[-1], low + 1e-9 * e[0])
        # columns whose growth differs by more than double precision would lose each other: then a lower degree
        spread = [math.acosh(max(1.0, (2 * v - high - low) / (high - low))) for v in (e[0], e[k - 1])]
        steps = min(degree, max(1, int(20 / max(1e-9, spread[0] - spread[1]))))
        q = np.linalg.qr(chebyshev(times, q, vq, low, high, e[0], steps))[0]
        e, q, vq = _ritz(q, times(q))
    raise ArithmeticError(f"residuals {residual} are not certified after {MOST_ROUNDS} rounds")


@dataclass
class Whitener:
    fit: Fit
    values: np.ndarray
    vectors: np.ndarray
    identity_error: float

    @property
    def weights(self) -> np.ndarray:
        """Columns that turn a centred vector to unit variances; NaN where nothing varies."""
        some = self.values > NO_VARIANCE * max(self.values[0], 0.0)
        return self.vectors / np.sqrt(np.where(some, self.values, np.nan))

    @property
    def explained(self) -> np.ndarray:
        return np.where(self.values > 0, self.values, 0.0) / self.fit.trace if self.fit.trace > 0 else np.full(len(self.values), np.nan)


def fit(vectors: DataFrame, k: int = COMPONENTS) -> list[Whitener]:
    """A whitener for each length of `vectors` (`x`, of `integer_vectors`)."""
    ship_package(vectors.sparkSession)
    out = []
    for each in fits(fit_list(vectors)):
        values, q = leading(each.times, each.dim, k)
        model = Whitener(each, values, q, 0.0)
        w = model.weights[:, ~np.isnan(model.weights[0])]
        if w.shape[1]:
            # means and products of the whitened fit list, measured in one more pass
            found = each.add_up((w.shape[1] + 1, w.shape[1]), lambda x: (lambda z: np.vstack([z.sum(axis=0), z.T @ z]))(x @ w)) / each.n  # noqa: B023
            model.identity_error = float(np.abs(found[1:] - np.outer(found[0], found[0]) - np.eye(w.shape[1])).max())
        out.append(model)
    return out


def deviations(rows: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n * x - sum)², exact, as decimal(38, 0); null beyond it."""
    widest = n * max(1, int(rows.max(initial=0)), -int(rows.min(initial=0))) + max(map(abs, sums))
    if widest * widest * len(sums) < 2**63:
        own = n * rows - np.array(sums)
        return pa.array((own * own).sum(axis=1)).cast(pa.decimal128(38, 0))
    own = n * rows.astype(object) - np.array(sums, object)
    return pa.array([Decimal(int(v)) if v < DECIMAL_LIMIT else None for v in (own * own).sum(axis=1)], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, models: list[Whitener]) -> DataFrame:
    """Per row of `vectors` (`id`, `x`) and component: `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error`."""
    ship_package(vectors.sparkSession)
    known = {m.fit.dim: (m.fit.n, m.fit.sums, m.fit.mean, m.weights, m.explained, m.identity_error) for m in models}
    kind = vectors.schema["id"].dataType.simpleString()

    def task(batches):
        for batch in batches:
            x = batch.column(1)
            flat, ends = x.values.to_numpy(zero_copy_only=False), x.offsets.to_numpy()
            size = np.diff(ends)
            for dim in np.unique(size[size > 0]):
                n, sums, mean, weights, explained, error = known[int(dim)]
                at = np.flatnonzero(size == dim)
                rows = flat[ends[:-1][at][:, None] + np.arange(dim)]
                z, k = (rows - mean) @ weights, weights.shape[1]
                every = np.repeat(np.arange(len(at)), k)
                columns = {
                    "id": batch.column(0).take(pa.array(at[every])),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    "n": pa.array(np.full(len(every), n)),
                    "deviation": deviations(rows, n, sums).take(pa.array(every)),
                    "whitened": pa.array(z.ravel(), from_pandas=True),
                    "explained": pa.array(np.tile(explained, len(at)), from_pandas=True),
                    "identity_error": pa.array(np.full(len(every), error)),
                }
                yield pa.RecordBatch.from_pydict(columns)

    return vectors.mapInArrow(task, f"id {kind}, component int, n long, deviation decimal(38, 0), whitened double, explained double, identity_error double")
