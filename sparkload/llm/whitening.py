"""Embedding whitening by QDWH spectral divide and conquer.

Entries become integers, x = floor(``SCALE`` * c) + ``SHIFT``, so counts, sums
and products are exact in any order: tasks add up x, then the products of x
less the nearest integers to the means (blocks small enough for exact doubles),
Spark adds these up as decimals, and the driver, which gets a number for each
pair of dimensions, corrects for the rest of the means in integers.  The
covariance is thus that of centred vectors, rounded once.

Its leading components come from polar decompositions: the polar factor U of
V - s*I (QDWH: dynamically weighted Halley steps, by QR while the weight is
large, else by a linear solve) gives the projector (U + I) / 2 on the invariant
subspace of the eigenvalues above s.  Bases of that subspace and of its
complement split V into two smaller blocks, and so on, down to single components
or equal eigenvalues; blocks below the components asked for aren't split
further.  A last refinement by residuals takes the eigenvectors to double
precision.  Components of one eigenvalue are any basis of their space.

Means and components (a number for each dimension and component) go along with
the tasks, which whiten their rows.  Nothing is shuffled but sums.

Rows whose vector is null or holds null or non-finite entries, or entries of
which no long holds x, are left out, as are rows of another length than the
commonest one (ties: the longer).  A component whose variance is 0 (or below
rounding, ``FLAT`` of the largest) has whitened null and no part in
identity_error; with fewer dimensions than components there are fewer rows.
``deviation`` is null where the exact sum (``deviation_exact``) is beyond a
long.  Null and repeated ids are whitened like others; an empty table (or empty
vectors) gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, map_partitions, stored, table

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Entries beyond it have no x that a double still holds.
LARGEST = 2.0**52 / SCALE
FLAT = 1e-13
ROWS = 4096  # of a block
_EXACT = 1 << 53  # integers that doubles add up exactly


def integers(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, x of the rows that can be whitened (of any length)."""
    c = col(rows, vector)
    fit = F.forall(c, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < LARGEST))  # no NaN: it is the largest value
    x = F.transform(c, lambda v: F.floor(v.cast("double") * SCALE) + F.lit(SHIFT))
    return rows.where(c.isNotNull() & (F.size(c) > 0) & fit).select(col(rows, vec_id).alias("vec_id"), x.cast("array<long>").alias("x"))


def matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, d)


def products(y: np.ndarray) -> np.ndarray:
    """The exact sum over rows of the products of all pairs of columns, as
    Python integers; doubles add up blocks of it where they can."""
    d = y.shape[1]
    total = np.zeros((d, d), object)
    top = int(np.abs(y).max(initial=0))
    step = min(ROWS, _EXACT // max(1, top * top))
    for at in range(0, len(y), max(1, step)):
        some = y[at:at + max(1, step)]
        total += (some.T.astype(np.float64) @ some.astype(np.float64)).astype(np.int64) if step else some.T.astype(object) @ some.astype(object)
    return total


def sums(vectors: DataFrame, d: int) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of each dimension."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, object)
        for batch in batches:
            x = matrix(batch, d)
            n += len(x)
            for at in range(0, len(x), 512):  # x is below 2^53: 512 of them fit a long
                total += x[at:at + 512].sum(axis=0)
        yield pa.record_batch([pa.array([-1, *range(d)], pa.int32()), pa.array([Decimal(int(v)) for v in (n, *total)], pa.decimal128(38, 0))], ["k", "v"])

    out = map_partitions(vectors.select("x"), rows, "k int, v decimal(38,0)").groupBy("k").agg(F.sum("v").alias("v"))
    found = {r.k: int(r.v) for r in out.collect()}  # a number for each dimension
    return found.get(-1, 0), [found.get(k, 0) for k in range(d)]


def covariance(vectors: DataFrame, n: int, total: list[int]) -> np.ndarray:
    """Of the centred vectors, divisor n: exact, then rounded to doubles."""
    d = len(total)
    centre = [(2 * s + n) // (2 * n) for s in total]
    rest = [s - n * c for s, c in zip(total, centre)]  # of the sums, after centring

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sum_of = np.zeros((d, d), object)
        for batch in batches:
            sum_of += products(matrix(batch, d) - np.array(centre, np.int64))
        i, j = np.triu_indices(d)
        yield pa.record_batch([pa.array(i * d + j, pa.int32()), pa.array([Decimal(int(v)) for v in sum_of[i, j]], pa.decimal128(38, 0))], ["k", "v"])

    out = map_partitions(vectors.select("x"), rows, "k int, v decimal(38,0)").groupBy("k").agg(F.sum("v").alias("v"))
    v = np.zeros((d, d))
    for r in out.collect():  # a number for each pair of dimensions
        i, j = divmod(r.k, d)
        v[i, j] = v[j, i] = (n * int(r.v) - rest[i] * rest[j]) / (n * n)
    return v


def polar(a: np.ndarray, least: float = 1e-16) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix by QDWH steps.
    ``least`` bounds its smallest singular value, over its norm, from below."""
    x, low, eye = a / np.linalg.norm(a), least, np.eye(len(a))
    for _ in range(60):
        d = np.cbrt(4 * (1 - low * low) / low**4)
        g = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * np.sqrt(1 + d)))
        b = (g - 1)**2 / 4
        c = g + b - 1
        if c > 100:
            q = np.linalg.qr(np.vstack([np.sqrt(c) * x, eye]))[0]
            new = b / c * x + (g - b / c) / np.sqrt(c) * q[:len(a)] @ q[len(a):].T
        else:
            new = b / c * x + (g - b / c) * np.linalg.solve(eye + c * x.T @ x, x.T).T
        low = min(1.0, low * (g + b * low * low) / (1 + c * low * low))
        new = (new + new.T) / 2
        still = np.linalg.norm(new - x) <= 1e-15 * len(a)
        x = new
        if still and 1 - low < 1e-12:
            break
    return x


def split(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces of a symmetric matrix's
    eigenvalues above and below a shift between them; None where all are equal
    up to rounding."""
    m = len(a)
    mean, size = np.trace(a) / m, np.linalg.norm(a)
    spread = np.linalg.norm(a - mean * np.eye(m)) / np.sqrt(m)
    if spread <= 1e-15 * size:
        return None
    draws = np.random.default_rng(m).normal(size=(m, m))
    for part in (0.0, 0.3, -0.3, 0.1, -0.1, 0.6, -0.6, 0.2, -0.2, 0.05, -0.05):  # a shift may hit an eigenvalue
        u = polar(a - (mean + part * spread) * np.eye(m))
        k = round((np.trace(u) + m) / 2)
        if not 0 < k < m:
            continue
        projector = (u + np.eye(m)) / 2
        q = np.linalg.qr(projector @ draws)[0]
        q = np.linalg.qr(np.hstack([projector @ q[:, :k], q[:, k:] - projector @ q[:, k:]]))[0]
        if np.linalg.norm(q[:, :k].T @ a @ q[:, k:]) <= 1e-13 * m * max(size, 1e-300):
            return q[:, :k], q[:, k:]
    return None  # closer than rounding tells apart


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors (as
    columns) by spectral divide and conquer."""
    found: list[np.ndarray] = []

    def divide(basis: np.ndarray) -> None:
        if len(found) >= k:
            return
        a = basis.T @ v @ basis
        parts = split((a + a.T) / 2) if basis.shape[1] > 1 else None
        if parts is None:
            found.extend(basis.T)
        else:
            divide(basis @ parts[0])
            divide(basis @ parts[1])

    divide(np.eye(len(v)))
    x = np.array(found).T
    for _ in range(2):  # refinement by residuals, inside the space that was found
        r = np.eye(x.shape[1]) - x.T @ x
        s = x.T @ v @ x
        e = np.diag(s) / (1 - np.diag(r))
        apart = e[None, :] - e[:, None]
        near = np.abs(apart) <= 1e-12 * max(float(np.abs(e).max()), 1e-300)
        x = np.linalg.qr(x + x @ np.where(near, r / 2, (s + e[None, :] * r) / np.where(near, 1, apart)))[0]
    e = np.diag(x.T @ v @ x) / (x * x).sum(axis=0)
    order = np.argsort(-e, kind="stable")[:k]
    return e[order], x[:, order] / np.linalg.norm(x[:, order], axis=0)


def whiten(spark: SparkSession, rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame | None:
    """vec_id, n, deviation, deviation_exact, whitened (array of ``components``
    doubles), explained (array) for each remaining row, stored; None without
    rows."""
    vectors = stored(spark, integers(rows, vec_id, vector), "vectors")
    lengths = vectors.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    if common is None:
        return None
    d = common.d
    vectors = vectors.where(F.size("x") == d)
    n, total = sums(vectors, d)
    v = covariance(vectors, n, total)
    e, x = leading(v, min(components, d))
    flat = e <= FLAT * max(float(e.max()), 0.0)
    weights = x / np.sqrt(np.where(flat, 1, e))
    explained = (e / np.trace(v)).tolist() if np.trace(v) > 0 else [0.0] * len(e)
    wide = n * (1 << 53) + max(map(abs, total)) >= 1 << 62

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = matrix(batch, d)
            if wide:  # a bound on the table, not on this batch
                top = n * int(np.abs(z).max(initial=0)) + max(map(abs, total))
                z = z.astype(object) if top >= 1 << 62 else z
            z = n * z - np.array(total, z.dtype)
            top = int(np.abs(z).max(initial=0))
            exact = (z * z).sum(axis=1) if top * top * d < 1 << 63 else (z.astype(object)**2).sum(axis=1)
            white = (z.astype(np.float64) / n) @ weights
            if exact.dtype == object:
                long = pa.array([int(q) if q < 1 << 63 else None for q in exact], pa.int64())
                whole = pa.array([Decimal(int(q)) for q in exact], pa.decimal128(38, 0))
            else:
                long = pa.array(exact, pa.int64())
                whole = long.cast(pa.decimal128(38, 0))
            values = pa.array(white.ravel(), mask=np.tile(flat, len(white)))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(white) + 1) * len(e), pa.int32()), values)
            yield pa.record_batch([batch.column("vec_id"), long, whole, lists], ["vec_id", "deviation", "deviation_exact", "whitened"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    out = map_partitions(vectors, apply, f"vec_id {kind}, deviation long, deviation_exact decimal(38,0), whitened array<double>")
    out = stored(spark, out, "whitened")
    return out.withColumns({"n": F.lit(n).cast("long"), "explained": F.lit(explained) if explained else F.array().cast("array<double>")})


def identity_error(whitened: DataFrame) -> float:
    """The largest absolute entry of the whitened rows' covariance (divisor n,
    centred by their means) less the identity; 0 where no component has
    variance."""
    k = F.col("whitened")
    size = whitened.select(F.max(F.size(k)).alias("k")).first().k or 0
    means = whitened.agg(*[F.avg(k[i]).alias(f"m{i}") for i in range(size)]).first()
    live = [i for i in range(size) if means[i] is not None]
    if not live:
        return 0.0
    pairs = [(i, j) for i in live for j in live if i <= j]
    cov = whitened.agg(*[F.avg((k[i] - means[i]) * (k[j] - means[j])).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(cov[at] - (i == j)) for at, (i, j) in enumerate(pairs))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(spark, table(spark, sf_dir, "embeddings"))
    if white is None:
        return spark.range(0).selectExpr("id AS vec_id", "int(id) AS component", "id AS n", "id AS deviation", "double(id) AS whitened",
                                         "double(id) AS explained", "double(id) AS identity_error", "cast(id AS decimal(38,0)) AS deviation_exact")
    error = identity_error(white)
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    rows = white.select(F.col("vec_id").cast("long").alias("vec_id"), "n", "deviation", "deviation_exact", each)
    return rows.select("vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"),
                       F.col("c.explained").alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_exact")
