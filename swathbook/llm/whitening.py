"""Whitening of embeddings by the leading eigenvectors of their covariance, found by the Jacobi-Davidson method.

The covariance is never formed. Vectors lie in blocks in a shared table, and a product of the covariance with a
few directions is one Spark job: every task centres its rows, multiplies them twice, and the small partial sums are added by
key. The driver holds a search space of a few dozen directions. Each round makes the Rayleigh-Ritz pairs of that space,
locks those whose residual is down to double precision, and widens the space by solutions of the projected correction
equations, for which all open pairs run MINRES side by side on the same distributed products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from swathbook.llm.shared import ship_package, write_table
from swathbook.llm.topk import quantise

#: Components, fixed-point scale and offset of an entry.
COMPONENTS, FACTOR, OFFSET = 16, 64.0, 1_000_000
#: Rows of a block of the fit list.
BLOCK = 4096
#: Directions beyond the wanted ones, MINRES steps of a correction, and rounds after which the search fails.
GUARD, INNER, ROUNDS = 4, 6, 200
#: A pair is locked at this residual, and has no variance below this share of the largest eigenvalue (both relative).
TOLERANCE, NO_VARIANCE = 2e-14, 1e-12


@dataclass
class Whitening:
    """The fit list's size n, sums S, eigenvectors (columns) and eigenvalues, trace and the error of the whitened covariance."""

    n: int
    sums: np.ndarray  # int64, or Python integers
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    residuals: np.ndarray


def fixed_point(df: DataFrame, vector: str, factor: float = FACTOR, offset: int = OFFSET) -> DataFrame:
    """``df`` with the column x in place of ``vector``: floor(factor * c) + offset of each entry as long.

    Rows whose vector is null or empty or holds a null, NaN or infinite entry are dropped.
    """
    x = F.transform(quantise(vector, factor), lambda v: v + F.lit(offset))
    kept = df.withColumn("x", x).where("x is not null and size(x) > 0")
    return kept if vector == "x" else kept.drop(vector)


def _rows(column: pa.Array, dims: int, fill: int) -> np.ndarray:
    """Rows of a list column as a matrix; a shorter vector is filled up."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(len(column), dims)
    out = np.full((len(column), dims), fill, np.int64)
    which = np.repeat(np.arange(len(column)), lengths)
    out[which, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _pack(dims: int, fill: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(0), dims, fill)
            for i in range(0, len(x), BLOCK):
                part = np.ascontiguousarray(x[i : i + BLOCK])
                yield pa.RecordBatch.from_pydict({"body": pa.array([part.tobytes()], pa.binary())})

    return run


def _explode(x: pa.Array, dims: int) -> Iterator[np.ndarray]:
    for body in x:
        yield np.frombuffer(body.as_buffer(), np.int64).reshape(-1, dims)


def _sums(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dims + 1, np.int64)  # a task's rows: far below 2 ** 63 / offset
        for batch in batches:
            for x in _explode(batch.column(0), dims):
                total[:dims] += x.sum(0)
                total[dims] += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims + 1)), pa.array(total)], ["cell", "value"])

    return run


def centre(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - S / n as double: the whole part of the mean is taken off in integers, so nothing is lost to the offset."""
    whole = np.array([int(s) // n for s in sums], np.int64)
    rest = np.array([(int(s) % n) / n for s in sums])
    return (x - whole).astype(np.float64) - rest


def _partial(dims: int, n: int, sums: np.ndarray, work: Callable[[np.ndarray], np.ndarray]):
    """Sums of work(centred rows) over the blocks of a task, as rows (cell, value)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _explode(batch.column(0), dims):
                part = work(centre(x, n, sums))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "value"])

    return run


class Covariance:
    """Products of the centred covariance of a table of blocks; counts its passes over the table."""

    def __init__(self, blocks: DataFrame, dims: int, n: int, sums: np.ndarray):
        self.blocks, self.dims, self.n, self.sums, self.passes = blocks, dims, n, sums, 0

    def total(self, work: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        self.passes += 1
        parts = self.blocks.mapInArrow(_partial(self.dims, self.n, self.sums, work), "cell long, value double")
        found = parts.groupBy("cell").agg(F.sum("value").alias("value")).toPandas()
        out = np.zeros(int(np.prod(shape)))
        out[found["cell"].to_numpy()] = found["value"].to_numpy()
        return out.reshape(shape)

    def __call__(self, y: np.ndarray) -> np.ndarray:
        return self.total(lambda c: c.T @ (c @ y), y.shape) / self.n

    def trace(self) -> float:
        return float(self.total(lambda c: np.array([np.einsum("ij,ij->", c, c)]), (1,))[0] / self.n)

    def whitened(self, p: np.ndarray) -> np.ndarray:
        """Covariance of the centred rows times p."""
        k = p.shape[1]

        def work(c: np.ndarray) -> np.ndarray:
            w = np.hstack([c @ p, np.ones((len(c), 1))])
            return w.T @ w

        sums = self.total(work, (k + 1, k + 1)) / self.n
        return sums[:k, :k] - np.outer(sums[:k, k], sums[:k, k])


def _orthonormal(new: np.ndarray, *held: np.ndarray) -> np.ndarray:
    """Columns of ``new`` made orthonormal to ``held`` and to each other; those that are (nearly) in their span go."""
    base = np.hstack(held) if held else np.zeros((new.shape[0], 0))
    kept: list[np.ndarray] = []
    for column in new.T:
        size = np.linalg.norm(column)
        if not size > 0:
            continue
        v = column / size
        for _ in range(3):
            v = v - base @ (base.T @ v)
            for w in kept:
                v = v - w * (w @ v)
            left = np.linalg.norm(v)
            if left < 1e-8:
                break
            v = v / left
        else:
            kept.append(v)
    return np.array(kept).T if kept else np.zeros((new.shape[0], 0))


def minres(product: Callable[[np.ndarray], np.ndarray], shifts: np.ndarray, space: np.ndarray, right: np.ndarray, steps: int) -> np.ndarray:
    """Approximate solutions t of P (A - shift) P t = right, P off ``space``, one column for each shift.

    Each column is its own MINRES recurrence (Lanczos and Givens rotations); a step multiplies all columns at once.
    """

    def off(y: np.ndarray) -> np.ndarray:
        return y - space @ (space.T @ y)

    right = off(right)
    beta = np.linalg.norm(right, axis=0)
    scale = np.where(beta > 0, beta, 1.0)
    v, before = right / scale, np.zeros_like(right)
    residual, t = beta.copy(), np.zeros_like(right)
    cs, sn, old_cs, old_sn = np.ones_like(beta), np.zeros_like(beta), np.ones_like(beta), np.zeros_like(beta)
    w, old_w, beta = np.zeros_like(right), np.zeros_like(right), np.zeros_like(beta)
    alive = residual > 0
    for _ in range(steps):
        if not alive.any():
            break
        y = off(product(v) - v * shifts)
        alpha = np.einsum("ij,ij->j", v, y)
        y = y - v * alpha - before * beta
        next_beta = np.linalg.norm(y, axis=0)
        # the new column of the tridiagonal matrix under the two rotations before
        epsilon, bar = old_sn * beta, old_cs * beta
        delta, gamma = cs * bar + sn * alpha, -sn * bar + cs * alpha
        size = np.hypot(gamma, next_beta)
        alive &= size > 1e-300
        safe = np.where(size > 0, size, 1.0)
        new_cs, new_sn = np.where(alive, gamma / safe, 1.0), np.where(alive, next_beta / safe, 0.0)
        new_w = (v - old_w * epsilon - w * delta) / safe
        t = t + np.where(alive, new_cs * residual, 0.0) * new_w
        residual = -new_sn * residual
        old_w, w, old_cs, old_sn, cs, sn = w, new_w, cs, sn, new_cs, new_sn
        alive &= next_beta > 1e-14 * np.abs(shifts)
        before, v, beta = v, np.where(alive, y / np.where(next_beta > 0, next_beta, 1.0), 0.0), next_beta
    return off(t)


def jacobi_davidson(product: Callable[[np.ndarray], np.ndarray], dims: int, wanted: int, inner: int = INNER, tolerance: float = TOLERANCE, seed: int = 7):
    """Values, vectors and residual norms of the ``wanted`` largest eigenpairs of a symmetric product, by falling value."""
    wanted = min(wanted, dims)
    width = min(dims, wanted + GUARD)
    most = min(dims, 6 * width)
    locked, locked_values = np.zeros((dims, 0)), np.zeros(0)
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dims, width)))
    image = product(space)
    largest = 0.0
    for _ in range(ROUNDS):
        small = space.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        largest = max(largest, float(np.abs(values).max(initial=0.0)), float(locked_values.max(initial=0.0)))
        limit = tolerance * largest
        open_ = wanted - locked.shape[1]
        residuals = image - space * values
        residuals = residuals - locked @ (locked.T @ residuals)
        norms = np.linalg.norm(residuals, axis=0)
        # a pair may be locked when all larger ones are: components come by falling value
        done = 0
        while done < open_ and done < len(values) and norms[done] <= limit:
            done += 1
        if done:
            locked, locked_values = np.hstack([locked, space[:, :done]]), np.concatenate([locked_values, values[:done]])
            space, image, values, residuals, norms = space[:, done:], image[:, done:], values[done:], residuals[:, done:], norms[done:]
            open_ -= done
        if not open_:
            break
        if space.shape[1] + min(open_ + GUARD, dims) > most and locked.shape[1] + space.shape[1] < dims:
            space, image = space[:, : 2 * width], image[:, : 2 * width]  # a thick restart on the best pairs
        now = [i for i in range(min(open_ + GUARD, space.shape[1])) if norms[i] > limit]
        off = np.hstack([locked, space[:, : open_ + GUARD]])
        corrections = minres(product, values[now], off, -residuals[:, now], inner) if now else np.zeros((dims, 0))
        more = _orthonormal(np.hstack([corrections, residuals[:, now]]), locked, space)[:, : len(now)]
        if not more.shape[1]:
            # the space is whole, or rounding stopped the residuals: its products anew, and a start from them
            fresh = _orthonormal(space, locked)
            before, space, image = norms[:open_].max(), fresh, product(fresh)
            small = space.T @ image
            again = np.linalg.eigh((small + small.T) / 2)
            check = image @ again[1][:, ::-1] - space @ again[1][:, ::-1] * again[0][::-1]
            check = check - locked @ (locked.T @ check)
            if np.linalg.norm(check, axis=0)[:open_].max() > limit and np.linalg.norm(check, axis=0)[:open_].max() >= before / 2:
                raise ArithmeticError(f"residual {before / largest:.2e} of the largest eigenvalue, not {tolerance:.2e}")
            continue
        space, image = np.hstack([space, more]), np.hstack([image, product(more)])
    else:
        raise ArithmeticError(f"no convergence in {ROUNDS} rounds")
    # one Rayleigh-Ritz step on fresh products of all locked vectors: true values and residuals
    locked = _orthonormal(locked)
    image = product(locked)
    small = locked.T @ image
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, vectors, image = values[::-1], locked @ turn[:, ::-1], image @ turn[:, ::-1]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return values, vectors, np.linalg.norm(product(vectors) - vectors * values, axis=0)


def fit_whitening(df: DataFrame, vector: str, components: int = COMPONENTS, factor: float = FACTOR, offset: int = OFFSET) -> Whitening | None:
    """Eigenvectors of the covariance of each distinct fixed-point vector once; None without a vector.

    At most ``components`` of them: as many as there are dimensions, and none whose variance is zero up to rounding
    (all vectors equal: no component at all). A vector shorter than the longest counts as filled up with entries of 0.
    """
    spark = df.sparkSession
    ship_package(spark)
    listed = fixed_point(df.select(F.col(vector).alias("v")), "v", factor, offset).select("x").distinct()
    listed = write_table(listed, "vectors")
    dims = listed.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return None
    if listed.agg(F.min(F.size("x"))).first()[0] < dims:
        full = F.slice(F.concat("x", F.array_repeat(F.lit(offset).cast("long"), dims)), 1, dims)
        listed = write_table(listed.select(full.alias("x")).distinct(), "vectors")
    blocks = write_table(listed.mapInArrow(_pack(dims, offset), "body binary"), "blocks")
    cells = blocks.mapInArrow(_sums(dims), "cell long, value long").groupBy("cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect()
    total = {r["cell"]: int(r["value"]) for r in cells}
    n, sums = total[dims], np.array([total[i] for i in range(dims)], object)
    covariance = Covariance(blocks, dims, n, sums)
    trace = covariance.trace()
    values, vectors, residuals = np.zeros(0), np.zeros((dims, 0)), np.zeros(0)
    if trace > 0:
        values, vectors, residuals = jacobi_davidson(covariance, dims, components)
        kept = values > NO_VARIANCE * values[0]
        values, vectors, residuals = values[kept], vectors[:, kept], residuals[kept]
    error = 0.0
    if len(values):
        error = float(np.abs(covariance.whitened(vectors / np.sqrt(values)) - np.eye(len(values))).max())
    return Whitening(n, sums, vectors, values, trace, error, residuals)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sum over dimensions of (n x - S) squared, exact; None beyond a long."""
    far = x.astype(object) * n - sums if n > 2**40 else x * n - sums.astype(np.int64)
    largest = int(np.abs(far).max(initial=0))
    if largest and largest * largest * x.shape[1] >= 2**63:
        far = far.astype(object)
    return [v if v < 2**63 else None for v in map(int, (far * far).sum(1))]


def _project(model: Whitening, offset: int):
    dims, k = model.vectors.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scaled = model.vectors / np.sqrt(model.values)
        explained = model.values / model.trace
        for batch in batches:
            x = _rows(batch.column(1), dims, offset)
            y = centre(x, model.n, model.sums) @ scaled
            rows = np.repeat(np.arange(len(x)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(deviations(x, model.n, model.sums), pa.int64()).take(pa.array(rows)),
                    pa.array(y.ravel()),
                    pa.array(np.tile(explained, len(x))),
                ],
                ["id", "component", "deviation", "whitened", "explained"],
            )

    return run


def whiten(df: DataFrame, model: Whitening | None, id: str = "vec_id", vector: str = "embedding", factor: float = FACTOR, offset: int = OFFSET) -> DataFrame:
    """``id``, component, n, deviation, whitened, explained, identity_error for every row with a vector and every component.

    Component numbers start at 1, by falling variance. ``deviation`` is null where it does not fit in a long. Rows whose vector is null or
    empty or holds a null, NaN or infinite entry give nothing; a repeated row gives its rows again, a null id stays
    null, other columns are not read. A vector longer than the fitted ones is an error, a shorter one is filled up with
    entries of 0. Without a model (no vectors) or components there are no rows.
    """
    kind = df.schema[id].dataType.simpleString()
    named = f"`{id}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return df.sparkSession.createDataFrame([], named)
    ship_package(df.sparkSession)
    rows = fixed_point(df.select(F.col(id).alias("id"), F.col(vector).alias("v")), "v", factor, offset).select("id", "x")
    found = rows.mapInArrow(_project(model, offset), f"id {kind}, component int, deviation long, whitened double, explained double")
    return found.select(
        F.col("id").alias(id), "component", F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", "explained",
        F.lit(model.identity_error).alias("identity_error"),
    )
