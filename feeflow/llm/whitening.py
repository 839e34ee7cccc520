"""Whitening of integer-coded embeddings by singular values of the centred rows.

The rows are never squared. Blocks of centred rows are reduced by QR, the triangles of blocks are
stacked and reduced again in groups until one is left: R, with R'R the rows' scatter matrix, dim by
dim whatever the number of rows. R is brought to bidiagonal form by Householder reflections. The
differential quotient-difference transform with shifts (dqds) finds the singular values of the
bidiagonal; twisted factorisations of its square at each of them give the vectors, which
the reflections carry back.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feeflow.llm.store import saved

SCALE, SHIFT = 64.0, 1_000_000
# Codes stay within this distance of SHIFT, so that sums and products of them stay exact.
FAR = 1 << 46
COMPONENTS = 16
# Rows of a block that is reduced at once; triangles that are reduced together.
BLOCK, FAN_IN = 4096, 32
EPS = np.finfo(float).eps
# Eigenvalues below this share of the largest are those of directions without spread.
FLAT = 1e-18


# --- singular values and vectors of a triangle --------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of U'RP, and P, by Householder reflections from both sides."""
    a = r.astype(float).copy()
    n = a.shape[1]
    p = np.eye(n)

    def reflection(x: np.ndarray) -> np.ndarray | None:
        v = x.copy()
        norm = np.linalg.norm(x)
        if norm == 0 or not x[1:].any():
            return None
        v[0] += np.copysign(norm, x[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflection(a[k:, k])
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        if k < n - 2:
            v = reflection(a[k, k + 1 :])
            if v is not None:
                a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
                p[:, k + 1 :] -= 2 * np.outer(p[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), p


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One transform of the qd array at ``shift``, the least d of it, and the last one."""
    n = len(q)
    q2, e2 = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    least = d
    for i in range(n - 1):
        q2[i] = d + e[i]
        if q2[i] == 0 or not np.isfinite(q2[i]):
            return q2, e2, -1.0, d
        ratio = q[i + 1] / q2[i]
        e2[i] = e[i] * ratio
        d = d * ratio - shift
        least = min(least, d)
    q2[n - 1] = d
    return q2, e2, least, d


def singular_squares(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of an upper bidiagonal matrix, falling."""
    out: list[float] = []
    blocks = [(diagonal**2, above**2, 0.0)]
    while blocks:
        q, e, sigma = blocks.pop()
        for _ in range(100 * len(q) + 100):
            n = len(q)
            if n == 1:
                break
            small = np.flatnonzero(e <= EPS**2 * np.maximum(sigma + np.minimum(q[:-1], q[1:]), np.finfo(float).tiny))
            if len(small):
                k = int(small[-1]) + 1
                blocks.append((q[:k], e[: k - 1], sigma))
                q, e = q[k:], e[k:]
                continue
            if q[0] == 0 or q.min() <= 0 and sigma == 0:
                shift = 0.0
            else:
                # The smaller eigenvalue of the last two rows, which the least one doesn't exceed.
                b, c = q[n - 2] + e[n - 2], q[n - 1] + (e[n - 2] if n == 2 else 0.0)
                half = (q[n - 2] + e[n - 2] + q[n - 1]) / 2
                root = np.sqrt(max(0.0, half * half - q[n - 2] * q[n - 1]))
                shift = max(0.0, min(q[n - 2] * q[n - 1] / (half + root) if half + root > 0 else 0.0, b, c, q.min()))
                if n > 2:
                    shift *= 1 - 8 * EPS
            new = _dqds(q, e, shift)
            while new[2] < 0 and shift > 0:  # beyond the least one: try a smaller shift
                shift = shift / 4 if shift > EPS**2 * (sigma + q.max()) else 0.0
                new = _dqds(q, e, shift)
            if new[2] < 0:  # a zero on the diagonal: one step without shift moves it to the end
                q = np.maximum(q, np.finfo(float).tiny)
                new = _dqds(q, e, 0.0)
            q, e, sigma = np.maximum(new[0], 0.0), new[1], sigma + shift
        out.extend(q + sigma if len(q) == 1 else np.maximum(q + sigma, 0.0))
    return np.sort(np.array(out))[::-1]


def twisted_vector(diagonal: np.ndarray, above: np.ndarray, value: float, near: list[np.ndarray]) -> np.ndarray:
    """Unit eigenvector of B'B for an eigenvalue close to ``value``, apart from the vectors ``near``
    of values that can't be told from it; B has no zero entry."""
    n = len(diagonal)
    d, low = diagonal**2, above / diagonal[:-1]
    tiny = np.finfo(float).tiny ** 0.5
    for _ in range(3):
        down, up, s, p = np.empty(n), np.empty(n), np.empty(n), np.empty(n)
        lower, upper = np.empty(n - 1), np.empty(n - 1)
        s[0] = -value
        for i in range(n - 1):  # top down: L+ D+ L+'
            down[i] = d[i] + s[i] or tiny
            lower[i] = d[i] * low[i] / down[i]
            s[i + 1] = lower[i] * low[i] * s[i] - value
        p[n - 1] = d[n - 1] - value
        for i in range(n - 2, -1, -1):  # bottom up: U- D- U-'
            up[i + 1] = d[i] * low[i] ** 2 + p[i + 1] or tiny
            t = d[i] / up[i + 1]
            upper[i] = low[i] * t
            p[i] = p[i + 1] * t - value
        gamma = s + p + value
        order = np.argsort(np.abs(gamma), kind="stable")
        z = np.zeros(n)
        for at in order[: len(near) + 1]:  # where both meet: the least, or one that gives another vector
            z = _solved(lower, upper, int(at))
            rest = z - sum((x * (x @ z) for x in near), np.zeros(n))
            if rest @ rest > 0.01 * (z @ z):
                break
        step = gamma[at] / (z @ z)
        if not np.isfinite(step) or abs(step) <= 4 * EPS * abs(value) or near:
            break
        value += step  # the Rayleigh quotient's correction
    return z / np.linalg.norm(z)


def _solved(lower: np.ndarray, upper: np.ndarray, at: int) -> np.ndarray:
    z = np.zeros(len(lower) + 1)
    z[at] = 1.0
    for i in range(at - 1, -1, -1):
        z[i] = -lower[i] * z[i + 1]
    for i in range(at, len(lower)):
        z[i + 1] = -upper[i] * z[i]
    return z


def principal_axes(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest ``count`` eigenvalues of R'R, falling, without those of flat directions, and their unit vectors (columns)."""
    n = r.shape[1]
    scale = np.abs(r).max(initial=0.0)
    if scale == 0 or n == 0:
        return np.zeros(0), np.zeros((n, 0))
    square = np.zeros((n, n))  # fewer rows than dimensions: the others are 0
    square[: len(r)] = r / scale
    a, b, p = bidiagonal(square)
    top = np.abs(a).max()
    a = np.where(np.abs(a) < EPS**2 * top, EPS**2 * top, a)  # B'B needs a diagonal without zeros
    cut = np.flatnonzero(np.abs(b) <= n * EPS * np.minimum(np.abs(a[:-1]), np.abs(a[1:])))
    values, vectors = [], []
    for lo, hi in zip([0, *(cut + 1)], [*(cut + 1), n], strict=True):
        aa, bb = a[lo:hi], b[lo : hi - 1]
        found: list[tuple[float, np.ndarray]] = []
        for v in singular_squares(aa, bb):
            near = [x for w, x in found if w - v <= 1e-12 * w]
            found.append((v, twisted_vector(aa, bb, v, near) if hi - lo > 1 else np.ones(1)))
        for v, x in found:
            z = np.zeros(n)
            z[lo:hi] = x
            values.append(v)
            vectors.append(z)
    order = np.argsort(values, kind="stable")[::-1]
    keep = [int(i) for i in order if values[i] > FLAT * values[order[0]]][:count]
    z = p @ np.array([vectors[i] for i in keep]).T
    for j in range(z.shape[1]):  # vectors of nearly equal values: made orthogonal
        for _ in range(2):
            z[:, j] -= z[:, :j] @ (z[:, :j].T @ z[:, j])
        z[:, j] /= np.linalg.norm(z[:, j])
    z *= np.where(z[np.abs(z).argmax(0), np.arange(z.shape[1])] < 0, -1.0, 1.0)
    return np.array([values[i] for i in keep]) * scale**2, z


# --- on Spark -------------------------------------------------------------------------------


@dataclass
class Centre:
    """Number of fitted rows and the sum of each dimension, exact."""

    n: int
    sums: list[int]

    def __post_init__(self):
        self.near = np.array([s // self.n for s in self.sums], np.int64)  # whole part of the mean
        self.rest = np.array([s - self.n * int(m) for s, m in zip(self.sums, self.near, strict=True)], float) / self.n

    def rows(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, the whole parts exactly."""
        return (x - self.near).astype(float) - self.rest

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over the dimensions of (n * x - S) ** 2; null beyond 64 bits."""
        off = x - self.near
        rest = [s - self.n * int(m) for s, m in zip(self.sums, self.near, strict=True)]
        most = float(np.abs(off).max(initial=0) + 1) * self.n
        if most * most * x.shape[1] < 2.0**62:
            return ((self.n * off - np.array(rest, np.int64)) ** 2).sum(1).tolist()
        exact = (np.array([self.n * v - w for row in off.tolist() for v, w in zip(row, rest, strict=True)], object).reshape(off.shape) ** 2).sum(1)
        return [int(v) if v < 2**63 else None for v in exact]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _map_codes(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without nulls and non-finite entries, their entries as codes."""
    for batch in it:
        v = batch.column("v")
        full = v.filter(pc.is_valid(v))
        size = full.value_lengths().to_numpy().astype(np.int64)
        flat = full.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null entry is nan
        bad = np.bincount(np.repeat(np.arange(len(size)), size), ~np.isfinite(flat), len(size)) > 0
        good = np.flatnonzero(~bad & (size > 0))
        keep = np.repeat(~bad, size)
        x = np.clip(np.floor(SCALE * flat[keep]), -FAR, FAR).astype(np.int64) + SHIFT
        off = np.concatenate(([0], np.cumsum(size[good]))).astype(np.int32)
        ids = batch.column("id").filter(pc.is_valid(v)).take(pa.array(good))
        yield pa.RecordBatch.from_arrays([ids, pa.ListArray.from_arrays(pa.array(off), pa.array(x))], ["id", "x"])


def _triangle(rows: np.ndarray) -> np.ndarray:
    return np.linalg.qr(rows, mode="r")


def _packed(part: int, r: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.ravel()], pa.list_(pa.float64()))], ["part", "r"])


def _map_triangle(it: Iterator[pa.RecordBatch], centre: Centre, dim: int) -> Iterator[pa.RecordBatch]:
    """One triangle for the rows of a partition, block by block."""
    from pyspark import TaskContext

    r = np.zeros((0, dim))
    for batch in it:
        for lo in range(0, batch.num_rows, BLOCK):
            x = _matrix(batch.column("x").slice(lo, BLOCK), dim)
            r = _triangle(np.concatenate((r, centre.rows(x))))
    if len(r):
        yield _packed(TaskContext.get().partitionId(), r)


def _reduce_triangles(table: pa.Table, dim: int) -> pa.Table:
    order = np.argsort(table.column("part").to_numpy())
    rows = table.column("r").combine_chunks().take(pa.array(order))
    part = int(table.column("part").to_numpy().min()) // FAN_IN
    return pa.Table.from_batches([_packed(part, _triangle(rows.flatten().to_numpy().reshape(-1, dim)))])


def _map_whitened(it: Iterator[pa.RecordBatch], centre: Centre, dim: int, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in it:
        x = _matrix(batch.column("x"), dim)
        w = centre.rows(x) @ axes
        k = axes.shape[1]
        off = pa.array(np.arange(len(x) + 1) * k, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(centre.deviations(x), pa.int64()), pa.ListArray.from_arrays(off, pa.array(w.ravel()))], ["id", "deviation", "w"]
        )


def _map_products(it: Iterator[pa.RecordBatch], centre: Centre, dim: int, axes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Sums and sums of products of the whitened rows of a partition."""
    k = axes.shape[1]
    total, products = np.zeros(k), np.zeros((k, k))
    for batch in it:
        w = centre.rows(_matrix(batch.column("x"), dim)) @ axes
        total += w.sum(0)
        products += w.T @ w
    value = np.concatenate((total, products.ravel()))
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(value))), pa.array(value)], ["at", "value"])


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per remaining row of ``vectors`` and component: id, component, n, deviation, whitened,
    explained, identity_error.

    Rows whose vector is null or empty, or holds null or non-finite entries, are dropped. Every other
    entry c becomes x = floor(64 * c) + 1000000 (64 * c is cut at 2**46 either way). The covariance is
    that of the distinct x vectors (n of them), so copies don't weigh. Component k has the k-th
    largest eigenvalue e; ``whitened`` is (x - mean) along its unit vector over sqrt(e), ``explained``
    e over the trace, ``identity_error`` how far the whitened fit rows' covariance is from the
    identity. A direction without spread is no component, so there may be fewer (none for a single
    distinct vector: no rows then). ``deviation`` is null beyond 64 bits. Vectors of another
    length than most distinct ones (of equally many: the longest) are dropped. Repeated ids and null ids are
    rows like others; other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    given = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    rows = saved(given.mapInArrow(_map_codes, f"id {id_type}, x array<long>"), "white_rows")
    fit = saved(rows.select("x").distinct(), "white_fit")
    lengths = fit.groupBy(F.size("x").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    dim, n = lengths["dim"], lengths["count"]
    rows, fit = (t.filter(F.size("x") == dim) for t in (rows, fit))
    sums = fit.agg(*[F.sum(F.get("x", F.lit(i)).cast("decimal(20,0)")).alias(f"s{i}") for i in range(dim)]).first()
    centre = Centre(n, [int(s) for s in sums])
    triangles = fit.mapInArrow(lambda it: _map_triangle(it, centre, dim), "part long, r array<double>")
    parts = fit.rdd.getNumPartitions()
    while parts > 1:
        group = F.floor(F.col("part") / FAN_IN)
        triangles = saved(triangles, "white_triangles").groupBy(group).applyInArrow(lambda t: _reduce_triangles(t, dim), "part long, r array<double>")
        parts = -(-parts // FAN_IN)
    r = np.array(triangles.first()["r"]).reshape(-1, dim)  # dim by dim, whatever the number of rows
    squares, axes = principal_axes(r, components)
    if not len(squares):
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    axes = axes / np.sqrt(squares / n)
    explained = squares / (r * r).sum()
    products = fit.mapInArrow(lambda it: _map_products(it, centre, dim, axes), "at long, value double")
    k = len(squares)
    flat = np.array([x["value"] for x in products.groupBy("at").agg(F.sum("value").alias("value")).orderBy("at").collect()])  # k * (k + 1) numbers
    mean = flat[:k] / n
    error = float(np.abs(flat[k:].reshape(k, k) / n - np.outer(mean, mean) - np.eye(k)).max())
    out = rows.mapInArrow(lambda it: _map_whitened(it, centre, dim, axes), f"id {id_type}, deviation long, w array<double>")
    share = F.array(*[F.lit(float(v)) for v in explained])
    out = out.select("id", "deviation", F.posexplode("w").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(id_col), (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"),
    )
