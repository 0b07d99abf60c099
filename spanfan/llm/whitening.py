"""Whitening of vectors with exact integer statistics from bit slices.

An entry *c* becomes the integer ``x = floor(1024 * c) + 100000``. For a block of rows
every dimension is shifted by its least *x* of the block, and each bit of the shifted
values is packed across the rows into 64-bit words. The cross-product of two dimensions is then
the sum over pairs of bit planes of ``2 ** (a + b) * popcount(plane_a & plane_b)``; the
shift is undone in integers. So counts, sums and cross-products are exact whatever
the order of rows and tasks. A task emits one row per pair of dimensions, in 40-bit
limbs that Spark adds up; the driver reads ``d * d / 2`` sums whatever the size of the table.

They are centred as integers, ``n * P - S S^T``, divided by ``n ** 2`` once, and
``eigh`` gives the components. ``deviation`` is computed in integers too. The covariance of the
whitened rows, which shows the error, is aggregated by Spark from the rows themselves.

Cases: rows whose vector is null or holds null or non-finite entries are dropped, and
so are those with an entry whose *x* has no place in 62 bits (the contract's long); an empty or
shorter vector counts as padded with zeros to the longest; a null or repeated ``vec_id`` is a row like any
other; an empty table gives no rows. A component without variance (constant
dimensions, fewer rows than dimensions) cannot be scaled: its ``whitened`` is null and it is not
in ``identity_error``; ``explained`` is null if all rows are equal. Other columns are
not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanfan.llm.common import read_table, stored
from spanfan.llm.vectors import dimension, finite_vectors, lists, matrix

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
BLOCK = 8192  # rows that are sliced at once
LIMBS, LIMB_BITS = 5, 40


def integers(c: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * c).astype(np.int64) + SHIFT


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for b in batches:
        for at in range(0, b.num_rows, BLOCK):
            part = b.slice(at, BLOCK)
            yield part, integers(matrix(part.column(1), d))


def cross_products(x: np.ndarray) -> np.ndarray:
    """``x.T @ x`` in exact Python integers (upper triangle; the rest is not set), by bit slices."""
    n, d = x.shape
    least = x.min(axis=0)
    y = (x - least).astype(np.uint64)
    bits = [int(top).bit_length() for top in y.max(axis=0)]
    dim = np.repeat(np.arange(d), bits)  # of a plane
    bit = np.concatenate([np.arange(b) for b in bits]).astype(np.uint64)
    words = -(-n // 64)
    planes = np.zeros((len(dim), words * 8), dtype=np.uint8)
    by_dim = np.ascontiguousarray(y.T)
    for k, (i, b) in enumerate(zip(dim, bit)):
        packed = np.packbits((by_dim[i] >> b).astype(np.uint8) & 1)
        planes[k, : len(packed)] = packed
    planes = planes.view(np.uint64)
    exact = 2 * max(bits, default=0) + n.bit_length() <= 62  # the weighted sums fit in a long
    weight = (np.int64(1) << bit.astype(np.int64)) if exact else np.array([1 << int(b) for b in bit], dtype=object)
    out = np.zeros((d, d), dtype=np.int64 if exact else object)
    for k in range(len(dim)):
        both = np.bitwise_count(planes[k] & planes[k:]).sum(axis=1, dtype=np.int64)
        both[1:][dim[k + 1 :] == dim[k]] *= 2  # (a, b) and (b, a) of one dimension
        terms = (both if exact else both.astype(object)) * weight[k:] * weight[k]
        np.add.at(out[dim[k]], dim[k:], terms)
    out, s, low = out.astype(object), _sums(y), least.astype(object)
    return out + np.outer(low, s) + np.outer(s, low) + n * np.outer(low, low)


def _sums(x: np.ndarray) -> np.ndarray:
    """Exact column sums as Python integers."""
    low, high = x & x.dtype.type(0xFFFFFFFF), x >> x.dtype.type(32)
    return low.sum(axis=0).astype(object) + (high.sum(axis=0).astype(object) * (1 << 32))


@dataclass
class Whitening:
    """Fitted statistics: ``n`` rows, exact sums ``s``, eigenvalues ``e`` (falling), unit
    eigenvectors in the columns of ``axes``, and the trace of the covariance."""

    n: int
    s: list[int]
    e: np.ndarray
    axes: np.ndarray
    trace: float


def scatter(vectors: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, exact sums, and exact cross-products (upper triangle) over ``vec_id, v``."""
    parts = [f"l{i}" for i in range(LIMBS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros((d + 1, d), dtype=object)  # the last row holds the sums
        for _, x in _blocks(batches, d):
            n += len(x)
            total[:d] += cross_products(x)
            total[d] += _sums(x)
        if not n:
            return
        at = [(i, j) for i in range(d) for j in range(i, d)] + [(d, j) for j in range(d)]
        values = [total[i, j] for i, j in at] + [n]
        at.append((d, d))
        mask = (1 << LIMB_BITS) - 1
        columns = [[(v >> (LIMB_BITS * k)) & mask for v in values] for k in range(LIMBS - 1)]
        columns.append([v >> (LIMB_BITS * (LIMBS - 1)) for v in values])
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in at], pa.int32()), pa.array([j for _, j in at], pa.int32()), *[pa.array(c, pa.int64()) for c in columns]],
            names=["i", "j", *parts],
        )

    rows = vectors.mapInArrow(run, "i int, j int, " + ", ".join(f"{p} long" for p in parts))
    n, s, p = 0, np.zeros(d, dtype=object), np.zeros((d, d), dtype=object)
    for i, j, *limbs in rows.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in parts]).collect():
        value = sum(x << (LIMB_BITS * k) for k, x in enumerate(limbs))
        if i < d:
            p[i, j] = value
        elif j < d:
            s[j] = value
        else:
            n = value
    return n, s, p


def usable(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, v`` of the rows that take part."""
    fits = F.forall("v", lambda c: F.abs(c) < float(1 << 62) / SCALE)
    return finite_vectors(df, vec_id, vector).filter(fits)


def fit(vectors: DataFrame) -> Whitening | None:
    """Statistics and components of ``vec_id, v`` (``None`` without a row or dimension)."""
    d = dimension(vectors)
    if not d:
        return None
    n, s, p = scatter(vectors, d)
    cov = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            cov[i, j] = cov[j, i] = (n * p[i, j] - s[i] * s[j]) / (n * n)
    e, axes = np.linalg.eigh(cov)
    return Whitening(n, [int(v) for v in s], e[::-1].copy(), axes[:, ::-1].copy(), float(np.trace(cov)))


def apply(vectors: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """``vec_id``, ``deviation`` (decimal(38,0), null beyond 38 digits) and ``whitened`` (array
    of the first ``components``; null entries where there is no variance)."""
    n, s, d = model.n, model.s, len(model.s)
    e = model.e[:components]
    live = e > d * np.finfo(float).eps * max(float(model.e[0]), 0.0)
    scaled = model.axes[:, : len(e)] / np.sqrt(np.where(live, e, 1.0))
    top = max(abs(v) for v in s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from decimal import Decimal

        digits = pa.decimal128(38, 0)
        for part, x in _blocks(batches, d):
            if n * int(np.abs(x).max()) + top < 1 << 62:
                y = n * x - np.array(s, dtype=np.int64)
            else:
                y = n * x.astype(object) - np.array(s, dtype=object)
            if y.dtype == np.int64 and d * int(np.abs(y).max()) ** 2 < 1 << 63:
                deviation = pa.array((y * y).sum(axis=1)).cast(digits)
            else:
                exact = (y.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([Decimal(v) if v < 10**38 else None for v in exact], digits)
            z = (y / n).astype(float) @ scaled
            values = pa.array(z.ravel(), mask=np.tile(~live, len(z)))
            starts = np.arange(len(z) + 1, dtype=np.int32) * np.int32(len(e))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), deviation, pa.ListArray.from_arrays(starts, values)], names=["vec_id", "deviation", "whitened"]
            )

    return vectors.mapInArrow(run, "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, components: int) -> float | None:
    """Largest absolute entry of the covariance of the ``whitened`` column (divisor n) minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    z = lambda i: F.col("whitened")[i]
    row = whitened.agg(*[F.covar_pop(z(i), z(j)) for i, j in pairs]).first() if pairs else ()
    errors = [abs(v - (i == j)) for (i, j), v in zip(pairs, row) if v is not None]
    return max(errors, default=None)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector and component: exact deviation, whitened value, explained share, and the
    error of the whitened covariance. ``deviation`` is null where it does not fit in a
    long; ``deviation_exact`` holds it as a decimal."""
    vectors = stored(usable(read_table(spark, sf_dir, "embeddings")), "whitening-vectors")
    model = fit(vectors)
    if model is None:
        model = Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
        rows = vectors.select("vec_id", F.lit(None).cast("decimal(38,0)").alias("deviation"), F.array().cast("array<double>").alias("whitened")).limit(0)
        error = None
    else:
        rows = stored(apply(vectors, model), "whitening-rows")
        error = identity_error(rows, min(COMPONENTS, len(model.e)))
    share = F.array(*[F.lit(float(v / model.trace) if model.trace > 0 else None).cast("double") for v in model.e[:COMPONENTS]]).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.expr("try_cast(deviation as long)").alias("deviation"),
        "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
        F.col("deviation").alias("deviation_exact"),
    )
