"""Embedding whitening by incremental eigendecomposition.

Each partition keeps the spectrum of its centred scatter matrix and applies
rank-one updates: the secular equation gives the new eigenvalues, deflation
leaves out directions that do not move, and Loewner's formula gives vectors
that are orthogonal to working precision.  Spectra of partitions are combined
by rank-one updates along the directions of the smaller one and of the
difference of the means.  A last distributed Rayleigh-Ritz step projects all
vectors on the basis and solves the projected matrix, which takes away what
the updates lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import release, saved, ship_package

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = 1 << 46              # of 64 * c: beyond it a product of two entries is no longer exact
FAN_IN = 16                    # spectra combined by one task
BLOCK = 1024                   # rows that meet as one triangular factor
TINY = 1e-12                   # eigenvalues below this share of the largest count as none
_EPS = np.finfo(float).eps


def secular_roots(d: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The roots of ``1 + sum(z_j^2 / (d_j - x))`` for ascending, distinct
    ``d`` and nonzero ``z``, each as the index of the nearest ``d`` and the
    distance from it (so that small distances keep their digits)."""
    m, z2 = len(d), z * z
    gap = np.append(np.diff(d), z2.sum())
    with np.errstate(divide="ignore", over="ignore"):
        middle = 1 + (z2 / (d[None, :] - (d + gap / 2)[:, None])).sum(axis=1)
    from_left = (middle >= 0) | (np.arange(m) == m - 1)
    origin = np.where(from_left, np.arange(m), np.minimum(np.arange(m) + 1, m - 1))
    delta = d[None, :] - d[origin][:, None]
    low = np.where(from_left, 0.0, -gap / 2)
    high = np.where(from_left, np.where(np.arange(m) == m - 1, gap, gap / 2), 0.0)
    for step in range(200):
        x = (low + high) / 2
        inside = (x > low) & (x < high)
        if not inside.any():
            break
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            f = 1 + (z2 / (delta - x[:, None])).sum(axis=1)
        up = inside & (f < 0)      # the function rises between its poles
        low, high = np.where(up, x, low), np.where(inside & ~up, x, high)
        if step > 60 and (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high))).all():
            break
    return origin, np.where(from_left, high, low)


def rank_one_update(d: np.ndarray, q: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and vectors of ``q diag(d) q' + v v'``."""
    z = q.T @ v
    weight = float(z @ z)
    if not weight > 0:
        return d, q
    tol = 8 * _EPS * max(abs(d).max(), weight)
    d, z, q = d.copy(), z.copy(), q.copy()
    # deflation: equal values are turned until one of them does not move
    last = -1
    for i in np.flatnonzero(np.abs(z) * np.sqrt(weight) > tol):
        if last >= 0 and d[i] - d[last] <= tol:
            r = np.hypot(z[last], z[i])
            c, s = z[i] / r, z[last] / r
            z[last], z[i] = 0.0, r
            q[:, [last, i]] = np.stack([c * q[:, last] - s * q[:, i], s * q[:, last] + c * q[:, i]], axis=1)
            d[last], d[i] = c * c * d[last] + s * s * d[i], s * s * d[last] + c * c * d[i]
        last = i
    moves = np.abs(z) * np.sqrt(weight) > tol
    at = np.flatnonzero(moves)
    if len(at):
        at = at[np.argsort(d[at], kind="stable")]
        e, w = d[at], z[at]
        origin, tau = secular_roots(e, w)
        apart = (e[origin][:, None] - e[None, :]) + tau[:, None]          # root i less value j
        # Loewner: the z for which these roots are exact
        num = np.abs(apart)
        den = np.abs(e[:, None] - e[None, :])
        np.fill_diagonal(den, 1.0)
        with np.errstate(divide="ignore"):
            logs = np.log(num).sum(axis=0) - np.log(den).sum(axis=0)
        fixed = np.sign(w) * np.exp(logs / 2)
        with np.errstate(divide="ignore", invalid="ignore"):
            u = fixed[None, :] / -apart
        u = np.where(np.isfinite(u), u, 0.0)
        hit = np.abs(apart).min(axis=1) == 0                              # a root on its pole keeps its vector
        for i in np.flatnonzero(hit):
            u[i] = 0.0
            u[i, np.abs(apart[i]).argmin()] = 1.0
        u /= np.linalg.norm(u, axis=1)[:, None]
        d[at], q[:, at] = e[origin] + tau, q[:, at] @ u.T
    by = np.argsort(d, kind="stable")
    return d[by], q[:, by]


class Spectrum:
    """Count, mean and spectrum of the centred scatter of vectors."""

    def __init__(self, size: int):
        self.n, self.mean = 0, np.zeros(size)
        self.values, self.vectors = np.zeros(size), np.eye(size)

    def _update(self, v: np.ndarray) -> None:
        self.values, self.vectors = rank_one_update(self.values, self.vectors, v)

    def _combine(self, n: int, mean: np.ndarray, directions: np.ndarray) -> None:
        """Take up ``n`` vectors with that mean whose centred scatter is the
        sum of the outer products of ``directions``."""
        apart = mean - self.mean
        for v in directions:
            self._update(v)
        if self.n:
            self._update(apart * np.sqrt(self.n * n / (self.n + n)))
        self.mean = self.mean + apart * (n / (self.n + n))
        self.n += n

    def add(self, rows: np.ndarray) -> None:
        """Centred rank-one updates for a block of rows.  A block with more
        rows than dimensions is replaced by the rows of its triangular factor,
        whose outer products have the same sum."""
        mean = rows.mean(axis=0)
        centred = rows - mean
        self._combine(len(rows), mean, np.linalg.qr(centred, mode="r") if len(rows) > rows.shape[1] else centred)

    def merge(self, other: Spectrum) -> None:
        if other.n:
            self._combine(other.n, other.mean, (other.vectors * np.sqrt(np.maximum(other.values, 0))).T)

    def to_array(self) -> np.ndarray:
        return np.concatenate([[self.n], self.mean, self.values, self.vectors.ravel()])

    @classmethod
    def from_array(cls, a: np.ndarray, size: int) -> Spectrum:
        out = cls(size)
        out.n, out.mean, out.values = int(a[0]), a[1:1 + size], a[1 + size:1 + 2 * size]
        out.vectors = a[1 + 2 * size:].reshape(size, size)
        return out


def _tree(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One array out of a row per partition (``part, data``), ``FAN_IN`` at a
    time: no task and no driver holds more than that many."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("part")
        whole = merge([np.asarray(x) for x in rows["data"]])
        return pd.DataFrame({"part": [int(rows["part"].iloc[0]) // FAN_IN], "data": [whole]})
    parts = saved(parts, "white-parts")
    highest = parts.agg(F.max("part")).first()[0]
    while highest:
        up = saved(parts.groupBy(F.floor(F.col("part") / FAN_IN).alias("group")).applyInPandas(run, "part bigint, data array<double>"), "white-parts")
        release(parts.sparkSession, parts)
        parts, highest = up, highest // FAN_IN
    row = parts.first()
    release(parts.sparkSession, parts)
    return None if row is None else np.asarray(row.data)


def _matrix(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    """Integer vectors of ``size`` entries each, as a matrix."""
    column = batch.column(name)
    return np.asarray(column.flatten()).reshape(-1, size).astype(np.int64)


def _per_partition(df: DataFrame, size: int, fn: Callable[[Iterator[np.ndarray]], np.ndarray | None]) -> DataFrame:
    """``part, data``: what ``fn`` makes of each partition's vectors ``x``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        out = fn(_matrix(b, "x", size) for b in batches if b.num_rows)
        if out is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([out.tolist()], pa.list_(pa.float64()))], names=["part", "data"])
    ship_package(df.sparkSession)
    return df.select("x").mapInArrow(run, "part bigint, data array<double>")


def integer_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, x``: ``floor(64 * c) + 1000000`` of the entries of every row
    whose vector is whole: no null, no entry that is null or not finite, none
    beyond ``LARGEST / 64``, at least one entry."""
    c = F.transform(F.col(column), lambda v: v.cast("double") * SCALE)
    fits = F.forall(F.col("__c"), lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float(LARGEST)))
    return (vectors.select(F.col("vec_id"), c.alias("__c")).filter(F.coalesce(fits, F.lit(False)) & (F.size("__c") > 0))
            .select("vec_id", F.transform("__c", lambda v: F.floor(v) + F.lit(SHIFT)).alias("x")))


def _scaled(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: in 64 bits where that holds, else in Python's whole numbers."""
    base = [s // n for s in sums]                       # x and S move by it together
    rest = np.array([s - n * b for s, b in zip(sums, base)], np.int64)
    near = x - np.array(base, np.int64)
    if int(np.abs(near).max(initial=0)) * n < 1 << 61:
        return near * np.int64(n) - rest
    return near.astype(object) * n - rest.astype(object)


def _deviation(scaled: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null where one does not fit 64 bits."""
    top = int(np.abs(scaled).max(initial=0))
    if top * top * scaled.shape[1] < 1 << 62:
        return (scaled.astype(np.int64) ** 2).sum(axis=1).tolist()
    sums = (scaled.astype(object) ** 2).sum(axis=1)
    return [int(s) if s < 1 << 63 else None for s in sums]


def whiten(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained,
    identity_error`` per row of ``vectors`` (``vec_id``, ``column``) that
    takes part, and component.

    Rows take part as ``integer_vectors`` says, and only those of the longest
    length among them.  The covariance is that of the distinct vectors, so
    copies weigh nothing, however many there are.  Components go from 1 by
    falling eigenvalue, at most ``components`` of them and as many as there
    are dimensions; the largest entry of each (the first of equals) is
    positive.  A direction without variance has a null ``whitened``; with no
    variance at all ``explained`` is null.  ``deviation`` is exact and null
    where it does not fit 64 bits.  Rows that repeat an id, or have none, are
    returned each.  An empty table gives no rows.

    The distinct vectors are written once and read three times: for the
    partitions' spectra, for the projected matrix and for ``identity_error``.
    What tasks and driver hold besides is a matrix of the dimensions.
    """
    spark = vectors.sparkSession
    out = "component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    whole = integer_vectors(vectors, column)
    size = whole.agg(F.max(F.size("x"))).first()[0]
    if size is None:
        return spark.createDataFrame([], f"vec_id {id_type}, {out}")
    size = int(size)
    rows = whole.filter(F.size("x") == size)
    fit = saved(rows.groupBy("x").agg(F.lit(1).alias("__one")).select("x"), "white-fit")
    sums_of = fit.agg(F.count(F.lit(1)).alias("n"), *[F.sum(F.get("x", F.lit(j)).cast("decimal(38,0)")).alias(f"s{j}") for j in range(size)]).first()
    n, sums = int(sums_of[0]), [int(s) for s in sums_of[1:]]
    base = np.array([s // n for s in sums], np.int64)

    def spectra(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        own = Spectrum(size)
        for x in blocks:
            for at in range(0, len(x), BLOCK):
                own.add((x[at:at + BLOCK] - base).astype(float))
        return own.to_array() if own.n else None

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        own = Spectrum.from_array(parts[0], size)
        for p in parts[1:]:
            own.merge(Spectrum.from_array(p, size))
        return own.to_array()
    basis = np.linalg.qr(Spectrum.from_array(_tree(_per_partition(fit, size, spectra), merged), size).vectors)[0]

    def centred(x: np.ndarray) -> np.ndarray:
        return (_scaled(x, n, sums) / n).astype(float)

    def projected(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        total = np.zeros((size, size))
        for x in blocks:
            y = centred(x) @ basis
            total += y.T @ y
        return total.ravel()
    ritz = _tree(_per_partition(fit, size, projected), lambda parts: np.sum(parts, axis=0)).reshape(size, size) / n
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    values, axes = np.maximum(values[::-1], 0), basis @ turn[:, ::-1]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(size)])
    k = min(components, size)
    trace, real = float(values.sum()), int((values[:k] > TINY * max(values[0], 1e-300)).sum())
    to_unit = axes[:, :real] / np.sqrt(values[:real])

    def covariance(blocks: Iterator[np.ndarray]) -> np.ndarray | None:
        total = np.zeros(real + real * real)
        for x in blocks:
            w = centred(x) @ to_unit
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        return total
    error = 0.0
    if real:
        got = _tree(_per_partition(fit, size, covariance), lambda parts: np.sum(parts, axis=0)) / n
        mean = got[:real]
        error = float(np.abs(got[real:].reshape(real, real) - np.outer(mean, mean) - np.eye(real)).max())
    release(spark, fit)
    share = [float(values[i] / trace) if trace > 0 else None for i in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scaled = _scaled(_matrix(batch, "x", size), n, sums)
            white = (scaled / n).astype(float) @ to_unit
            white = np.concatenate([white, np.full((len(white), k - real), np.nan)], axis=1)
            rows = len(white)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(pa.array(np.repeat(np.arange(rows), k))), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                 pa.array([n] * (rows * k), pa.int64()), pa.array([d for d in _deviation(scaled) for _ in range(k)], pa.int64()),
                 pa.array(white.ravel(), from_pandas=True), pa.array(share * rows, pa.float64()), pa.array([error] * (rows * k), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return rows.mapInArrow(run, f"vec_id {id_type}, {out}")
