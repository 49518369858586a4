"""Embedding whitening by a block Jacobi-Davidson eigensolver (operator 11).

The covariance matrix is never built. The distinct scaled vectors (the fit list) are stored once as
blocks; a *product* is one Spark job in which every task multiplies its centred blocks with a few
columns and adds up, and Spark sums the tasks' results. All wanted eigenpairs are sought together:

* Rayleigh-Ritz in a growing subspace gives the leading Ritz pairs and their residuals;
* a leading pair whose residual has reached ``TOLERANCE`` (rounding size, relative to the largest
  eigenvalue) is *locked*: it leaves the subspace and everything stays orthogonal to it;
* for the others, the correction equation, projected off the locked and the current Ritz vectors,
  is solved by a few steps of MINRES, all columns in step, so one product serves them all;
* the corrections widen the subspace; a full one restarts from its best Ritz vectors.

The driver holds a few columns of the vectors' length, whatever the number of rows.

Components become ``x = floor(scale * c) + offset``, as long. Nulls and odd rows: a row whose vector is
NULL or holds NULL or non-finite entries is dropped; all others get rows, those with a NULL id and
repeated ones too. An empty vector has no component, hence no row. Vectors of another length are
fitted for themselves. Equal vectors count once in the fit. Components of no variance (rounding
size) are not returned: a table with one distinct vector gives no rows. Equal eigenvalues have no
unique eigenvectors; any orthonormal ones are given, the same for all rows. Scaled entries,
``n * x`` and the deviation must fit a long; a deviation that does not stops the job with an
overflow error instead of a wrong number. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from peerscore.llm.common import stage_path
from peerscore.llm.vectors import usable

BLOCK_ROWS = 2048
#: a residual of this size, relative to the largest eigenvalue, is rounding
TOLERANCE = 64 * np.finfo(float).eps
#: eigenvalues below this share of the largest are rounding
NO_VARIANCE = 1e-12

Product = Callable[[np.ndarray], np.ndarray]


def minres(apply: Product, rhs: np.ndarray, steps: int) -> np.ndarray:
    """About solves ``A_j t_j = rhs_j`` for symmetric operators, all columns in step (``apply`` gets every column)."""
    x = np.zeros_like(rhs)
    beta = np.linalg.norm(rhs, axis=0)
    tiny = 1e-30 + 1e-14 * beta
    v_old, v = np.zeros_like(rhs), rhs / np.where(beta > 0, beta, 1)
    eta, live = beta.copy(), beta > 0
    c_old = c = np.ones_like(beta)
    s_old = s = np.zeros_like(beta)
    w_old = w = np.zeros_like(rhs)
    beta_here = np.zeros_like(beta)  # no previous Lanczos vector yet
    for _ in range(steps):
        p = apply(v)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta_here * v_old
        beta_next = np.linalg.norm(p, axis=0)
        # the two earlier rotations, then the new one
        first, second = c * alpha - c_old * s * beta_here, s * alpha + c_old * c * beta_here
        third = s_old * beta_here
        size = np.hypot(first, beta_next)
        live &= size > tiny
        safe = np.where(size > 0, size, 1)
        c_old, s_old, c, s = c, s, first / safe, beta_next / safe
        w_old, w = w, (v - third * w_old - second * w) / safe
        x = x + np.where(live, c * eta, 0) * w
        eta = -s * eta
        live &= beta_next > tiny
        v_old, v, beta_here = v, p / np.where(beta_next > 0, beta_next, 1), beta_next
    return x


def _orthonormal(columns: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Orthonormal columns that span what ``columns`` adds to the orthonormal ``basis``."""
    columns = columns / np.maximum(np.linalg.norm(columns, axis=0), 1e-300)
    for _ in range(2):
        columns = columns - basis @ (basis.T @ columns)
    u, size, _ = np.linalg.svd(columns, full_matrices=False)
    new = u[:, size > 1e-10]
    new = new - basis @ (basis.T @ new)
    return np.linalg.qr(new)[0] if new.shape[1] else new


def leading_eigenpairs(product: Product, dim: int, k: int, inner: int = 5, widest: int | None = None, rounds: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues (falling) and unit eigenvectors (columns) of a symmetric operator.

    ``product`` applies it to a block of columns. ``inner`` is the number of MINRES steps of a correction,
    ``widest`` the subspace's largest size (at least three blocks).
    """
    k = min(k, dim)
    widest = min(dim, max(3 * k, widest or 6 * k))
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    start = np.random.default_rng(17).normal(size=(dim, min(dim, k + 4)))
    space = np.linalg.qr(start)[0]
    image = product(space)
    top, stalled, least = 0.0, 0, np.inf
    for _ in range(rounds):
        theta, y = np.linalg.eigh((m := space.T @ image) / 2 + m.T / 2)
        theta, y = theta[::-1], y[:, ::-1]
        want = min(k - len(values), space.shape[1])
        ritz, ritz_image = space @ y, image @ y
        residual = ritz_image[:, :want] - ritz[:, :want] * theta[:want]
        residual -= locked @ (locked.T @ residual)
        size = np.linalg.norm(residual, axis=0)
        top = max(top, float(theta[0]), float(values.max(initial=0)))
        # rounding of the products can be larger than the tolerance: what no round lessens any more is done
        stalled, least = (0, size.max()) if size.max() < 0.5 * least else (stalled + 1, least)
        limit = TOLERANCE * top if stalled < 6 else max(TOLERANCE * top, min(100 * TOLERANCE * top, 4 * least))
        whole = space.shape[1] + locked.shape[1] >= dim  # the subspace is everything: Rayleigh-Ritz is exact
        small = (size <= limit) | (whole & (stalled >= 2))
        ready = int(np.argmin(small)) if not small.all() else want
        if ready:  # locking, from the largest on
            locked = np.hstack([locked, ritz[:, :ready]])
            values = np.concatenate([values, theta[:ready]])
            if len(values) >= k or locked.shape[1] >= dim:
                break
            space, image = ritz[:, ready:], ritz_image[:, ready:]
            theta, residual, stalled, least = theta[ready:], residual[:, ready:], 0, np.inf
            ritz, ritz_image = space, image
            if not space.shape[1]:
                space = _orthonormal(np.random.default_rng(dim).normal(size=(dim, k)), locked)
                image = product(space)
                continue
            if not residual.shape[1]:
                continue
        at = min(residual.shape[1], theta.shape[0])
        theta, now = theta[:at], ritz[:, :at]
        if space.shape[1] + at > widest:  # restart from the best Ritz vectors
            keep = max(at, min(2 * k, widest - at))
            space, image = ritz[:, :keep], ritz_image[:, :keep]
        # both projections: off everything locked, and off each column's own Ritz vector

        def project(z: np.ndarray, now: np.ndarray = now) -> np.ndarray:
            z = z - locked @ (locked.T @ z)
            return z - now * (now * z).sum(axis=0)

        def corrected(z: np.ndarray, project: Callable = project, theta: np.ndarray = theta) -> np.ndarray:
            z = project(z)
            return project(product(z) - z * theta)

        correction = minres(corrected, -project(residual[:, :at]), inner)
        new = _orthonormal(correction, np.hstack([locked, space]))
        if not new.shape[1]:  # nothing new: restart with an image that is computed afresh
            space, _ = np.linalg.qr(space - locked @ (locked.T @ space))
            image = product(space)
            continue
        space, image = np.hstack([space, new]), np.hstack([image, product(new)])
    else:
        raise ArithmeticError(f"the residuals did not reach rounding size in {rounds} rounds")
    order = np.argsort(-values, kind="stable")
    vectors = locked[:, order]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    return values[order], vectors * sign


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """Vectors (column ``x``) to blocks of at most ``BLOCK_ROWS`` rows, as little-endian longs."""
    waiting: list[np.ndarray] = []
    held = 0

    def block() -> pa.RecordBatch:
        data = np.concatenate(waiting)
        return pa.RecordBatch.from_arrays([pa.array([len(data)], pa.int64()), pa.array([data.tobytes()], pa.binary())], names=["n", "data"])

    for b in batches:
        flat = b.column("x").flatten().to_numpy(zero_copy_only=False).astype("<i8").reshape(-1, dim)
        for at in range(0, len(flat), BLOCK_ROWS):
            part = flat[at : at + BLOCK_ROWS]
            if held + len(part) > BLOCK_ROWS:
                yield block()
                waiting, held = [], 0
            waiting.append(part)
            held += len(part)
    if held:
        yield block()


class FitList:
    """The distinct vectors of one length, stored once as blocks, and the passes over them."""

    def __init__(self, distinct: DataFrame, dim: int) -> None:
        self.spark, self.dim = distinct.sparkSession, dim
        path = stage_path(self.spark, f"whitening-{dim}")
        distinct.mapInArrow(lambda batches: _blocks(batches, dim), "n long, data binary").write.parquet(path)
        self.blocks = self.spark.read.parquet(path)
        self.n = int(self.blocks.agg(F.sum("n")).first()[0] or 0)
        self.sums = self._sums()

    def _sums(self) -> np.ndarray:
        """Exact sum of each dimension (Python integers)."""
        dim = self.dim

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [0] * dim
            for b in batches:
                for data in b.column("data").to_pylist():
                    total = [t + s for t, s in zip(total, np.frombuffer(data, "<i8").reshape(-1, dim).sum(axis=0).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(map(str, total)))], names=["cell", "total"])

        found = self.blocks.mapInArrow(add, "cell int, total string").groupBy("cell").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        sums = [0] * dim
        for r in found.collect():  # one row a dimension
            sums[r["cell"]] = int(r["total"])
        return np.array(sums, object)

    def summed(self, work: Callable[[np.ndarray], np.ndarray], cells: int) -> np.ndarray:
        """The sum over all blocks of ``work(centred block)`` (``cells`` numbers): summed in the tasks, then by Spark."""
        dim, n, sums = self.dim, self.n, self.sums

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, some = np.zeros(cells), False
            for b in batches:
                for data in b.column("data").to_pylist():
                    total += work(centred(np.frombuffer(data, "<i8").reshape(-1, dim), n, sums)).reshape(-1)
                    some = True
            if some:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], names=["cell", "part"])

        found = self.blocks.mapInArrow(run, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("total"))
        out, table = np.zeros(cells), found.toArrow()  # one row a cell
        out[table.column("cell").to_numpy()] = table.column("total").to_numpy()
        return out

    def covariance_product(self, columns: np.ndarray) -> np.ndarray:
        """The covariance matrix times ``columns``, in one pass."""
        n, shape = self.n, columns.shape
        return self.summed(lambda x: x.T @ (x @ columns), columns.size).reshape(shape) / n


def centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``x - S / n``, from the exact difference ``n * x - S``."""
    return differences(x, n, sums).astype(np.float64) / n


def differences(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``: exact, in longs where they are sure to hold it."""
    largest = n * max(1, int(np.abs(x).max(initial=0))) + max(map(abs, sums.tolist()), default=0)
    return n * x - sums.astype(np.int64) if largest < 1 << 62 else n * x.astype(object) - sums


def squared_length(d: np.ndarray) -> list[int]:
    """The exact sum of squares of each row."""
    if int(np.abs(d).max(initial=0)) ** 2 * max(1, d.shape[1]) < 1 << 62:
        return (d.astype(np.int64) ** 2).sum(axis=1).tolist()
    return (d.astype(object) ** 2).sum(axis=1).tolist()


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, offset: int = 1_000_000, components: int = 16, inner: int = 5
) -> DataFrame:
    """A row per vector and component: ``vec_id``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    ``inner`` is the number of MINRES steps a correction takes.
    """
    spark = vectors.sparkSession
    scaled = F.transform(vector_col, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))
    rows = vectors.where(usable(vector_col, zero=True)).select(F.col(id_col).alias("vec_id"), scaled.alias("x"))
    models: dict[int, tuple] = {}
    for r in rows.select(F.size("x").alias("dim")).distinct().orderBy("dim").collect():  # the lengths: one, in a proper table
        models[r["dim"]] = _fit(rows.where(F.size("x") == r["dim"]).select("x").distinct(), r["dim"], components, inner)
    shared = spark.sparkContext.broadcast(models)
    id_type = vectors.schema[id_col].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = np.asarray(b.column("x").value_lengths().to_numpy(zero_copy_only=False))
            flat = b.column("x").flatten().to_numpy(zero_copy_only=False)
            first = np.cumsum(length) - length
            for dim, (n, sums, to_white, explained, error) in shared.value.items():
                at, k = np.flatnonzero(length == dim), len(explained)
                if not len(at) or not k:
                    continue
                d = differences(flat[first[at][:, None] + np.arange(dim)], n, sums)
                white = (d.astype(np.float64) / n) @ to_white
                deviation = pa.array(squared_length(d), pa.int64())
                each = pa.array(np.repeat(np.arange(len(at)), k))
                arrays = [
                    b.column("vec_id").take(pa.array(np.repeat(at, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(len(at) * k, n)), deviation.take(each), pa.array(white.reshape(-1)),
                    pa.array(np.tile(explained, len(at))), pa.array(np.full(len(at) * k, error)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return rows.mapInArrow(project, schema)


def _fit(distinct: DataFrame, dim: int, components: int, inner: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, float]:
    """``n``, ``S``, the matrix that whitens centred rows, the explained shares and the identity error."""
    fit = FitList(distinct, dim)
    trace = float(fit.summed(lambda x: np.array([(x * x).sum()]), 1)[0]) / fit.n
    if not trace > 0:
        return fit.n, fit.sums, np.zeros((dim, 0)), np.zeros(0), 0.0
    values, directions = leading_eigenpairs(fit.covariance_product, dim, components, inner)
    real = values > NO_VARIANCE * values[0]
    values, directions = values[real], directions[:, real]
    to_white, k = directions / np.sqrt(values), len(values)
    mean = fit.summed(lambda x: (x @ to_white).sum(axis=0), k) / fit.n

    def spread(x: np.ndarray) -> np.ndarray:
        w = x @ to_white - mean
        return w.T @ w

    error = float(np.abs(fit.summed(spread, k * k).reshape(k, k) / fit.n - np.eye(k)).max())
    return fit.n, fit.sums, to_white, values / trace, error
