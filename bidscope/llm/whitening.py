"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The covariance is never formed: every step is a distributed pass that sums ``(x - mean) (x - mean)' Q`` over the
rows, in the tasks that read them, and adds the sums by dimension. Only blocks of dimension x columns reach the
driver. A round runs a Chebyshev recurrence over such passes, which damps the spectrum between zero and the
block's least Ritz value, then orthonormalises by QR and takes Ritz pairs (Rayleigh-Ritz). Rounds end when the
residual of every wanted pair is certified to be below ``TOLERANCE`` of the largest eigenvalue.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidscope.llm.common import table
from bidscope.session import stage_table

COMPONENTS = 32
#: Columns of the iterated block beyond the wanted components.
GUARD = 24
#: Passes of one Chebyshev recurrence, at most, and the factor by which it may raise the largest eigenvalue.
DEGREE = 12
LIFT = 1e9
#: Largest residual of a certified pair, and the least eigenvalue that counts as more than rounding; both as a share of
#: the largest eigenvalue.
TOLERANCE = 1e-13
RANK = 1e-12
ROUNDS = 60
SCALE = 64
SEED = 13

_SAFE = 1 << 62


def quantised(embeddings: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id, x``: the rows whose vector is whole and finite, each entry as floor(64 c).

    The offset of a million is left out here: neither a deviation nor a covariance depends on it.
    """
    good = F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return embeddings.where(F.col(vec_col).isNotNull() & F.coalesce(good, F.lit(False))).select(
        F.col(id_col).alias("vec_id"),
        F.transform(vec_col, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"),
    )


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(x: DataFrame, d: int, width: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all batches of a ``rows x width`` block; each task adds its own first."""
    names = [f"c{j}" for j in range(width)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                block = of(_matrix(batch, d))
                total = block if total is None else total + block
        if total is not None:
            columns = [pa.array(np.arange(len(total), dtype=np.int64)), *[pa.array(c) for c in total.T]]
            yield pa.RecordBatch.from_arrays(columns, names=["at", *names])

    parts = x.select("x").mapInArrow(add, ", ".join(["at long", *[f"{n} double" for n in names]]))
    rows = parts.groupBy("at").agg(*[F.sum(n).alias(n) for n in names]).collect()
    out = np.zeros((len(rows), width))
    for row in rows:
        out[row[0]] = row[1:]
    return out


def _sums(x: DataFrame, d: int) -> list[int]:
    """The exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            block = _matrix(batch, d)
            if block.size and float(np.abs(block).max()) * len(block) >= _SAFE:
                block = block.astype(object)
            total = [a + int(b) for a, b in zip(total, block.sum(axis=0))]
        at, text = pa.array(range(d), pa.int64()), pa.array([str(t) for t in total])
        yield pa.RecordBatch.from_arrays([at, text], names=["at", "total"])

    parts = x.select("x").mapInArrow(add, "at long, total string")
    rows = parts.groupBy("at").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    sums = {r["at"]: int(r["total"]) for r in rows}
    return [sums.get(j, 0) for j in range(d)]


def principal_components(
    x: DataFrame, d: int, n: int, mean: np.ndarray, components: int = COMPONENTS
) -> tuple[np.ndarray, np.ndarray, float]:
    """Eigenvalues (falling), unit eigenvectors as columns, and the trace of the covariance of ``x``.

    As many as wanted, as there are dimensions, or as have an eigenvalue above rounding. Raises where ``ROUNDS``
    rounds do not certify them.
    """
    trace = 0.0

    def covariance(q: np.ndarray) -> np.ndarray:
        nonlocal trace

        def of(block: np.ndarray) -> np.ndarray:
            centred = block - mean
            return np.hstack([centred.T @ (centred @ q), (centred * centred).sum(axis=0)[:, None]])

        total = _summed(x, d, q.shape[1] + 1, of) / n
        trace = float(total[:, -1].sum())
        return total[:, :-1]

    m = min(d, components + GUARD)
    wanted = min(d, components)
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, m)))[0]
    for _ in range(ROUNDS):
        vq = covariance(q)
        small = q.T @ vq
        ritz, turn = np.linalg.eigh((small + small.T) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        top = max(float(ritz[0]), 0.0)
        residual = np.linalg.norm(vq - q * ritz, axis=0)[:wanted]
        if top <= 0 or residual.max() <= TOLERANCE * math.sqrt(d) * top:
            keep = int((ritz[:wanted] > RANK * top).sum()) if top > 0 else 0
            return ritz[:keep], q[:, :keep], trace
        q = np.linalg.qr(_filtered(covariance, q, vq, top, max(float(ritz[-1]), RANK * top)))[0]
    raise ArithmeticError(f"{ROUNDS} rounds left a residual of {residual.max() / top:.1e} of the largest eigenvalue")


def _filtered(
    covariance: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, top: float, cut: float
) -> np.ndarray:
    """A Chebyshev polynomial of the covariance, small on [0, cut] and scaled to one at ``top``, times ``q``."""
    centre = half = cut / 2
    reach = math.acosh(max((top - centre) / half, 1.0 + 1e-12))
    degree = int(min(DEGREE, max(2.0, math.acosh(LIFT) / reach)))
    first = scale = half / (top - centre)
    before, now = q, (vq - centre * q) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (covariance(now) - centre * now) * (2 * following / half) - (scale * following) * before
        scale = following
    return now


def whiten(
    embeddings: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every fitted row and component.

    Rows whose vector is null, or has null or non-finite entries, are neither fitted nor returned. Repeated rows and
    rows with a null id count like any other. An empty table, equal vectors and vectors without entries have no
    components and give no rows; components without variance are left out. Vectors of different lengths raise, and
    so does a deviation beyond 64 bits. Other columns are not read.
    """
    spark = embeddings.sparkSession
    x = stage_table(quantised(embeddings, id_col, vec_col), "vectors")
    n, d, longest = x.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    schema = (
        f"vec_id {x.schema['vec_id'].dataType.simpleString()}, component int, n long, deviation long, "
        "whitened double, explained double, identity_error double"
    )
    if not n or not longest:
        return spark.createDataFrame([], schema)
    if d != longest:
        raise ValueError(f"vectors of {d} to {longest} entries")
    sums = _sums(x, d)
    mean = np.array([s / n for s in sums])
    values, vectors, trace = principal_components(x, d, n, mean, components)
    if not len(values):
        return spark.createDataFrame([], schema)
    project = vectors / np.sqrt(values)
    k = len(values)

    def squares(block: np.ndarray) -> np.ndarray:
        w = (block - mean) @ project
        return np.hstack([w.T @ w, w.sum(axis=0)[:, None]])

    moments = _summed(x, d, k + 1, squares) / n
    error = float(np.abs(moments[:, :-1] - np.outer(moments[:, -1], moments[:, -1]) - np.eye(k)).max())
    shares = values / trace

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = _matrix(batch, d)
            whitened = (block - mean) @ project
            rows = len(block)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, dtype=np.int64)),
                    pa.array(np.repeat(_deviations(block, n, sums), k)),
                    pa.array(whitened.reshape(-1)),
                    pa.array(np.tile(shares, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return x.mapInArrow(rows_of, schema)


def _deviations(block: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """The sum over dimensions of ``(n x - S)^2`` of each row, exact."""
    reach = max((abs(s) for s in sums), default=0) + n * (int(np.abs(block).max()) if block.size else 0)
    if reach * reach * block.shape[1] < _SAFE:
        apart = block.astype(np.int64) * n - np.array(sums, dtype=np.int64)
        return (apart * apart).sum(axis=1)
    apart = block.astype(object) * n - np.array(sums, dtype=object)
    exact = (apart * apart).sum(axis=1)
    if len(exact) and max(exact) >= 1 << 63:
        raise OverflowError("a deviation does not fit into 64 bits")
    return exact.astype(np.int64)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))
