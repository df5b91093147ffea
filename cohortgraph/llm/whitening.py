"""Embedding whitening: leading principal components by FEAST contour integration.

Sums and centred second moments of all vectors are made in map tasks and added up by (row, column) in
Spark, so what reaches the driver is one number for each pair of dimensions (``MAX_DIMENSIONS`` bounds
it), whatever the number of vectors. The spectrum is cut into intervals of about ``PER_INTERVAL``
eigenvalues at points found by inertia counts (the signs of an LDL^T factorisation of the shifted
covariance); a group of equal eigenvalues is never cut. Each interval is a task: Gauss-Legendre
quadrature of complex shifted solves along the upper half of a circle around it projects a block of
vectors, Rayleigh-Ritz extracts eigenpairs, and both repeat until the residuals are at rounding level.
An interval that does not give as many eigenvalues as its inertia count says is an error, so none is missed.

Defined cases: rows whose vector is null, or holds null or non-finite entries, are dropped; the
dimension is the most frequent length of the remaining vectors (of equally frequent ones the longest),
rows of another length are dropped too; entries beyond 2^34 in size count as that; ids may be null or
repeat; directions whose eigenvalue is under ``RANK`` times the largest have no variance to divide by
and are no components, so equal vectors or a single one give no rows, as an empty table does.
``deviation`` is null where it does not fit a long.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortgraph.llm import common

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
PER_INTERVAL = 8
#: Quadrature points on the half circle.
POINTS = 8
#: Eigenvalues below this share of the largest count as zero.
RANK = 1e-10
#: The covariance of so many dimensions (about 134 MB) is held by the driver and by each task of an interval.
MAX_DIMENSIONS = 4096
_LARGEST = float(1 << 40)
_ROUNDS = 40


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v) of the rows whose vector is whole."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), v.alias("v"))
    return rows.filter(F.col("v").isNotNull() & F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))


def _integers(column: pa.Array, size: int) -> np.ndarray:
    """x of the vectors of one batch, a row each."""
    flat = np.asarray(column.flatten(), np.float64).reshape(-1, size)
    return np.clip(np.floor(SCALE * flat), -_LARGEST, _LARGEST).astype(np.int64) + OFFSET


def _scaled(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n*x - S, exactly; as Python integers where longs would not hold it."""
    largest = max(int(np.abs(x).max(initial=0)), 1)
    if largest * n < 1 << 62:
        return n * x - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (_scaled(x, n, sums) / n).astype(np.float64)


def _triangle(moments: np.ndarray) -> pa.RecordBatch:
    i, j = np.tril_indices(len(moments))
    return pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(moments[i, j])], names=["i", "j", "m"])


def _moments(rows: DataFrame, size: int, of) -> np.ndarray:
    """Sum of the outer products of ``of(x)`` over all rows: one lower triangle a task, added up in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                c = of(batch.column("v"))
                total = c.T @ c if total is None else total + c.T @ c
        if total is not None:
            yield _triangle(total)

    out = np.zeros((size, size))
    for r in rows.mapInArrow(run, "i int, j int, m double").groupBy("i", "j").agg(F.sum("m").alias("m")).collect():
        out[r.i, r.j] = out[r.j, r.i] = r.m
    return out


# ---- eigenvalues of a symmetric matrix -----------------------------------------------------------------


def inertia(a: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: positive pivots of a symmetric factorisation with 1x1 and 2x2 pivots."""
    a = a - shift * np.eye(len(a))
    above = 0
    while len(a):
        size = np.abs(a)
        diagonal = size.diagonal()
        r = int(diagonal.argmax())
        p, q = divmod(int(size.argmax()), len(a))
        if p == q or diagonal[r] >= 0.64 * size[p, q]:  # (1 + sqrt 17) / 8 bounds the growth
            if a[r, r] == 0:
                break
            above += a[r, r] > 0
            rest = np.delete(np.arange(len(a)), r)
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, r], a[r, rest]) / a[r, r]
        else:
            above += 1  # the pivot has a negative determinant: one eigenvalue on either side
            pivot = [p, q]
            rest = np.delete(np.arange(len(a)), pivot)
            w = a[np.ix_(rest, pivot)]
            a = a[np.ix_(rest, rest)] - w @ np.linalg.solve(a[np.ix_(pivot, pivot)], w.T)
            a = (a + a.T) / 2
    return int(above)


def intervals(a: np.ndarray, wanted: int, each: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """(low, high, count) from the top of the spectrum down, with at least ``wanted`` eigenvalues (as many as are not zero)."""
    top = min(float(np.trace(a)), float(np.abs(a).sum(axis=1).max())) * (1 + 1e-9)
    if not top > 0:
        return []
    floor, close = RANK * top, 1e-13 * top
    wanted = min(wanted, inertia(a, floor))
    out: list[tuple[float, float, int]] = []
    high, done = top, 0
    while done < wanted:
        # no interval much wider than its distance from zero: the projection would not part small eigenvalues below it
        reach = max(high / 4, floor)
        within = inertia(a, reach)
        if within == done:
            high = reach
            continue
        goal = min(done + each, wanted, within)
        least = max(reach / 2, floor)
        low, up, found = least, high, None
        while up - low > close and found is None:
            mid = (low + up) / 2
            n = inertia(a, mid)
            if n == goal:
                found = mid
            elif n > goal:
                low = mid
            else:
                up = mid
        if found is None:  # equal eigenvalues: take all of them
            found, low = low, least
            goal = inertia(a, found)
        ends = []  # the cut goes to the middle of the gap
        for far in (low, up):
            near = found
            while abs(far - near) > max(close, 0.05 * abs(far - found)):
                mid = (far + near) / 2
                near, far = (mid, far) if inertia(a, mid) == goal else (near, mid)
            ends.append(near)
        cut = sum(ends) / 2
        out.append((cut, high, goal - done))
        high, done = cut, goal
    return out


def feast(a: np.ndarray, low: float, high: float, count: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns), falling, of the ``count`` eigenvalues between ``low`` and ``high``."""
    d = len(a)
    width = min(d, max(count + 6, 2 * count))
    block = np.random.default_rng(11).standard_normal((d, width))
    nodes, weights = np.polynomial.legendre.leggauss(POINTS)
    turn = np.exp(0.5j * np.pi * (1 - nodes))
    centre, radius, norm = (low + high) / 2, (high - low) / 2, np.abs(a).sum(axis=1).max()
    best, since = np.inf, 0
    for _ in range(_ROUNDS):
        projected = np.zeros((d, width))
        for t, w in zip(turn, weights, strict=True):
            projected += 0.5 * w * (radius * t * np.linalg.solve((centre + radius * t) * np.eye(d) - a, block.astype(complex))).real
        basis, _ = np.linalg.qr(projected)
        values, inner = np.linalg.eigh(basis.T @ a @ basis)  # Rayleigh-Ritz in the small space
        block = basis @ inner
        own = np.flatnonzero((values > low) & (values <= high))
        if len(own) == count:
            worst = np.linalg.norm(a @ block[:, own] - block[:, own] * values[own], axis=0).max() / norm
            since = 0 if worst < best / 2 else since + 1
            best = min(best, worst)
            if worst < d * 1e-16 or since >= 3 and worst < 1e-12:
                own = own[::-1]
                return values[own], block[:, own]
    raise ArithmeticError(f"{count} eigenvalues between {low} and {high} by inertia; residual {best}")


def components(spark: SparkSession, covariance: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns), falling: one Spark task for each interval of the spectrum."""
    d = len(covariance)
    parts = intervals(covariance, wanted)
    if not parts:
        return np.zeros(0), np.zeros((d, 0))
    held = spark.sparkContext.broadcast(covariance)  # MAX_DIMENSIONS squared at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, count in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                values, vectors = feast(held.value, low, high, count)
                yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["e", "v"])

    dealt = spark.createDataFrame(parts, "low double, high double, n int").repartition(len(parts))
    found = sorted(dealt.mapInArrow(run, "e double, v array<double>").collect(), key=lambda r: -r.e)
    basis, _ = np.linalg.qr(np.array([r.v for r in found]).T)  # vectors of different intervals, orthogonal to rounding
    values, inner = np.linalg.eigh(basis.T @ covariance @ basis)
    vectors = (basis @ inner)[:, ::-1][:, :wanted]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[::-1][:wanted], vectors * signs


# ---- the operator ---------------------------------------------------------------------------------------


@dataclass
class Model:
    """Sums, eigenvalues and components of the fitted vectors; ``whiten`` takes any table of vectors."""

    size: int
    n: int
    sums: np.ndarray
    trace: float
    values: np.ndarray
    vectors: np.ndarray

    def whitened(self, column: pa.Array) -> np.ndarray:
        return _centred(_integers(column, self.size), self.n, self.sums) @ (self.vectors / np.sqrt(self.values))

    def whiten(self, vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
        """(vec_id, deviation, whitened): one row for each whole vector, ``whitened`` an array by component."""
        rows = _usable(vectors, id_col, vector_col).filter(F.size("v") == self.size)
        if not len(self.values):
            return rows.limit(0).selectExpr("vec_id", "0L AS deviation", "v AS whitened")
        model = rows.sparkSession.sparkContext.broadcast(self)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = model.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                exact = _scaled(_integers(batch.column("v"), m.size), m.n, m.sums)
                if int(np.abs(exact).max()) ** 2 * m.size < 1 << 63:
                    deviation = pa.array((exact.astype(np.int64) ** 2).sum(axis=1))
                else:
                    whole = (exact.astype(object) ** 2).sum(axis=1)
                    deviation = pa.array([s if s < 1 << 63 else None for s in whole.tolist()], pa.int64())
                flat = m.whitened(batch.column("v"))
                ends = np.arange(len(flat) + 1, dtype=np.int32) * flat.shape[1]
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), deviation, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.reshape(-1)))],
                                                 names=["vec_id", "deviation", "whitened"])

        return rows.mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>")

    def identity_error(self, vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
        """Largest absolute entry of the whitened vectors' covariance minus the identity, over all rows."""
        k = len(self.values)
        if not k:
            return 0.0
        rows = _usable(vectors, id_col, vector_col).filter(F.size("v") == self.size)
        model = rows.sparkSession.sparkContext.broadcast(self)

        def with_one(column: pa.Array) -> np.ndarray:
            w = model.value.whitened(column)
            return np.hstack([w, np.ones((len(w), 1))])

        m = _moments(rows, k + 1, with_one)  # the last row holds the sums: centred once more for what rounding left of the mean
        mean = m[k, :k] / m[k, k]
        return float(np.abs(m[:k, :k] / m[k, k] - np.outer(mean, mean) - np.eye(k)).max())


def fit(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", wanted: int = COMPONENTS) -> Model:
    """Components of all usable rows: a pass for the sums, one for the centred moments."""
    spark = vectors.sparkSession
    rows = _usable(vectors, id_col, vector_col)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(pc.list_value_length(batch.column("v")))
            for size in np.unique(sizes[sizes > 0]).tolist():
                x = _integers(batch.column("v").filter(pa.array(sizes == size)), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([size] * size, pa.int32()), pa.array(np.arange(size, dtype=np.int32)), pa.array([len(x)] * size, pa.int64()), pa.array(x.sum(axis=0))],
                    names=["size", "i", "n", "s"])

    added = rows.mapInArrow(sums, "size int, i int, n long, s long").groupBy("size", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    added = common.stored(added, "whitening-sums")
    chosen = added.filter("i = 0").orderBy(F.desc("n"), F.desc("size")).select("size", "n").first()
    if chosen is None:
        return Model(0, 0, np.zeros(0, object), 0.0, np.zeros(0), np.zeros((0, 0)))
    size, n = chosen.size, chosen.n
    if size > MAX_DIMENSIONS:
        raise ValueError(f"vectors have {size} entries; the covariance of at most {MAX_DIMENSIONS} is held in one place")
    total = np.array([int(r.s) for r in added.filter(F.col("size") == size).orderBy("i").collect()], object)
    covariance = _moments(rows.filter(F.size("v") == size), size, lambda column: _centred(_integers(column, size), n, total)) / n
    values, found = components(spark, covariance, wanted)
    return Model(size, n, total, float(np.trace(covariance)), values, found)


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings")
    model = fit(vectors)
    error = model.identity_error(vectors)
    shares = F.array(*[F.lit(float(e / model.trace)) for e in model.values]).cast("array<double>")
    rows = model.whiten(vectors).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return rows.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))
