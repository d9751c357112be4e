"""Whitening of embeddings by shifted Cholesky QR (Fukaya et al., 2020).

Centred rows are orthogonalised in passes: each adds up the Gram matrix of the
rows as they are so far, factors it, and multiplies rows by the inverse of the
factor from then on. The first factor is of the shifted matrix, so that it
exists even where rounding has made the Gram matrix indefinite; two more passes
bring the rows to orthogonality. The product of the factors is the R of a QR of
the rows; its singular values and right vectors are those of the rows, without
the loss of half the digits that the eigenvalues of one Gram matrix would bring.

Only d by d matrices reach the driver, d being the dimension; they are summed
up in Spark by entry.

Rows that go: those whose vector is null or has a null or non-finite entry, one
beyond 2^42 (its integer and the sums of squares would pass a long) or a length
other than the commonest (of equals, the greatest). An empty table gives no
rows. Equal rows, null ids and equal ids count and come back as they are; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS = 8
SCALE, OFFSET, MOST = 1024, 100_000, float(1 << 42)
#: An eigenvalue below this share of the first is rounding; its component has no whitened values.
FLAT = 1e-24
#: Rows multiplied at once in a task.
ROWS = 8192


def fit_rows(embeddings: DataFrame, vec: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """``(vec_id, x)`` of the rows that remain, x in longs, and their dimension."""
    small = lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) <= MOST)
    rows = embeddings.where(F.col(vec).isNotNull() & (F.size(vec) > 0) & F.forall(vec, small))
    sizes = rows.groupBy(F.size(vec).alias("d")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    d = top["d"] if top else 0
    # the entry is tested again, as Spark may make x before it drops a row
    whole = lambda v: F.when(small(v), F.floor(v.cast("double") * SCALE).cast("long") + OFFSET)
    return rows.where(F.size(vec) == d).select(F.col(key).alias("vec_id"), F.transform(vec, whole).alias("x")), d


def _blocks(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for whole in batches:
        for start in range(0, whole.num_rows, ROWS):
            b = whole.slice(start, ROWS)
            yield b, b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _summed(rows: DataFrame, d: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int]) -> np.ndarray:
    """The sum, over blocks of rows, of the matrix that ``part`` makes of a block: summed up in each task, then by entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for _, x in _blocks(batches, d):
            m = part(x)
            total = m if total is None else total + m
        if total is not None:
            i, j = np.indices(shape)
            yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel(), pa.float64())], names=["i", "j", "v"])

    out = np.zeros(shape)
    for r in rows.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[r.i, r.j] = r.v
    return out


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """x less the mean; the mean comes as integer and fraction, so that the large part goes exactly."""
    return (x - whole).astype(float) - rest


def _factor(gram: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper R with R'R = Gram; the first Gram matrix is shifted by its rounding error's bound, and any that still fails by more."""
    d = len(gram)
    norm = float(np.linalg.norm(gram, 2))
    shift = 11 * (n * d + d * (d + 1)) * np.finfo(float).eps / 2 * norm if first else 0.0
    shift = min(shift, 1e-8 * norm)
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(d)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, 1e-15 * norm)


def components(rows: DataFrame, d: int, n: int, whole: np.ndarray, rest: np.ndarray, passes: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors in columns, of the covariance of ``rows``; of each vector the largest entry is positive."""
    r = np.eye(d)
    for k in range(passes):
        inverse = np.linalg.inv(r)

        def part(x: np.ndarray, inverse: np.ndarray = inverse) -> np.ndarray:
            q = _centred(x, whole, rest) @ inverse
            return q.T @ q

        gram = _summed(rows, d, part, (d, d))
        if not gram.any():
            return np.zeros(d), np.eye(d)
        r = _factor(gram, n, first=k == 0) @ r
    _, s, vt = np.linalg.svd(r)
    sign = np.sign(vt[np.arange(d), np.abs(vt).argmax(axis=1)])
    return s**2 / n, (vt * sign[:, None]).T


def whiten(embeddings: DataFrame, most: int = COMPONENTS, vec: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)``, a row for each remaining vector and component.

    A component without variance has null in ``whitened``; ``identity_error`` is
    measured in one more pass over those that have some. A deviation beyond a
    long is null.
    """
    rows, d = fit_rows(embeddings, vec, key)
    shape = "vec_id {}, component int, n long, deviation long, whitened double, explained double, identity_error double".format(rows.schema["vec_id"].dataType.simpleString())
    if not d:
        return embeddings.sparkSession.createDataFrame([], shape)
    total = rows.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).orderBy("i").collect()
    n, sums = total[0].n, [int(t.s) for t in total]
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([float(Decimal(s % n) / n) for s in sums])
    e, w = components(rows, d, n, whole, rest)
    k = min(most, d)
    live = e[:k] > FLAT * max(e[0], np.finfo(float).tiny)
    scale = w[:, :k] / np.sqrt(np.where(live, e[:k], 1.0))

    def square(x: np.ndarray) -> np.ndarray:
        y = _centred(x, whole, rest) @ scale
        return np.hstack([y.T @ y, y.sum(axis=0)[:, None]])

    second = _summed(rows, d, square, (k, k + 1))
    mean = second[:, k] / n
    off = np.abs(second[:, :k] / n - np.outer(mean, mean) - np.eye(k))[np.ix_(live, live)]
    error = float(off.max()) if live.any() else 0.0
    explained = e[:k] / max(e.sum(), np.finfo(float).tiny)
    remainders = np.array([s % n for s in sums], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in _blocks(batches, d):
            m = len(x)
            apart = x - whole
            if float(np.abs(apart).max() + 1) * n < np.sqrt(2.0**62 / d):
                by = apart * n - remainders.astype(np.int64)
                deviation = pa.array((by * by).sum(axis=1), pa.int64())
            else:
                exact = ((apart.astype(object) * n - remainders) ** 2).sum(axis=1)
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            y = _centred(x, whole, rest) @ scale
            at = np.repeat(np.arange(m), k)
            dead = ~np.tile(live, m)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()), deviation.take(pa.array(at)), pa.array(y.ravel(), mask=dead), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, shape)
