"""Embedding whitening: principal components of unit variance, by a distributed Jacobi-Davidson method.

The covariance is never formed. What is asked of it is its product with a few vectors, a pass over the
centred points: each task multiplies its tiles of points, and the sums of the tasks are summed. The driver
holds some forty vectors of the embedding's dimension, whatever the number of points.

A subspace gives the best approximations (Rayleigh-Ritz). For all that are not good enough yet, a
projected correction equation each is solved roughly by a few steps of MINRES, side by side, one pass
a step for all of them; the corrections extend the subspace, which begins anew from its best vectors
when it is full. Leading pairs whose residual has reached double precision are locked: they leave the
subspace and all that follows is kept orthogonal to them.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promolens.llm.common import fresh, store

#: Components, steps to a unit, and what is added so that points are positive.
COMPONENTS, STEPS_PER_UNIT, OFFSET = 16, 64, 1_000_000
#: Entries of this size or more count as not finite: points then stay exact in 64 bits.
LIMIT = float(1 << 40)
#: Vectors beyond the wanted ones in the first subspace, vectors in the largest, MINRES steps, rounds at most.
GUARD, LARGEST, INNER, ROUNDS = 4, 40, 8, 200
#: Residual asked for, as a part of the largest eigenvalue, and the most that is accepted after the last round.
ASKED, ACCEPTED = 64 * float(np.finfo(float).eps), 1e-10
#: Points in a tile, and entries in a stored part.
TILE, PART = 4096, 1 << 22
#: Part of a right side that MINRES is to leave.
ENOUGH = 1e-3

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Points:
    """The distinct points in tiles, less ``base``, the whole part of their mean; ``rest`` is n times the remaining part."""

    tiles: DataFrame
    parts: int
    n: int
    dim: int
    base: tuple[int, ...]
    rest: tuple[int, ...]
    largest: int  # distance of an entry from its base


@dataclass(frozen=True)
class Whitening:
    """Unit eigenvectors in columns, their eigenvalues, all variance, and the error of the whitened covariance."""

    points: Points
    vectors: np.ndarray
    variances: np.ndarray
    total_variance: float
    identity_error: float


def on_grid(vector: Column) -> Column:
    """floor(64 c) + 1,000,000 for every entry c."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * STEPS_PER_UNIT) + OFFSET)


def usable(vector: Column) -> Column:
    """Whether the vector and all its entries are there, finite and below ``LIMIT`` in size."""
    within = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < LIMIT, F.lit(False)))
    return F.coalesce(within, F.lit(False))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), dim)


def _summed(
    df: DataFrame, parts: int, task: Callable[[pa.RecordBatch], np.ndarray], shape: tuple[int, ...], kind: str = "f8"
) -> np.ndarray:
    """The sum of what ``task`` gives for every batch: in each task, then in few tasks, then here."""

    def partial(batches: Iterator[pa.RecordBatch], of: Callable[[pa.RecordBatch], np.ndarray]):
        total = np.zeros(shape, kind)
        for batch in batches:
            total += of(batch)
        yield pa.record_batch([pa.array([total.tobytes()], pa.binary())], ["sum"])

    def together(batch: pa.RecordBatch) -> np.ndarray:
        held = [np.frombuffer(part, kind).reshape(shape) for part in batch["sum"].to_pylist()]
        return np.sum(held, axis=0) if held else np.zeros(shape, kind)

    first = df.mapInArrow(lambda batches: partial(batches, task), "sum binary")
    few = first.repartition(max(1, math.isqrt(parts))).mapInArrow(lambda batches: partial(batches, together), "sum binary")
    return np.sum([together(batch) for batch in few.toArrow().to_batches()] or [np.zeros(shape, kind)], axis=0)


def fit_points(embeddings: DataFrame, vector: str, dim: int) -> Points | None:
    """The distinct points of the vectors, stored in tiles; None if there are none."""
    distinct = store(embeddings.select(on_grid(F.col(vector)).alias("x")).distinct())
    n = distinct.count()
    if n == 0:
        return None
    parts = max(embeddings.sparkSession.sparkContext.defaultParallelism, -(-n * dim // PART))

    def sums(batch: pa.RecordBatch) -> np.ndarray:
        x = _matrix(batch["x"], dim)
        return np.stack([(x >> 20).sum(axis=0), (x & 0xFFFFF).sum(axis=0)])

    high, low = _summed(distinct, parts, sums, (2, dim), "i8").tolist()
    whole = [(a << 20) + b for a, b in zip(high, low, strict=True)]
    base, rest = tuple(s // n for s in whole), tuple(s % n for s in whole)
    middle = np.array(base)

    def tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, TILE):
                x = _matrix(batch.slice(start, TILE)["x"], dim) - middle
                largest = int(np.abs(x).max(initial=0))
                x = x.astype("i4") if largest < 1 << 31 else x
                yield pa.record_batch(
                    [pa.array([x.tobytes()], pa.binary()), pa.array([x.itemsize]), pa.array([largest])],
                    ["data", "width", "largest"],
                )

    tiled = store(distinct.repartition(parts).mapInArrow(tiles, "data binary, width long, largest long"))
    largest = tiled.agg(F.max("largest")).first()[0]
    return Points(tiled, parts, n, dim, base, rest, largest)


def _centred_tiles(batch: pa.RecordBatch, dim: int, shift: np.ndarray) -> Iterator[np.ndarray]:
    for data, width in zip(batch["data"].to_pylist(), batch["width"].to_pylist(), strict=True):
        yield np.frombuffer(data, f"i{width}").reshape(-1, dim) - shift


def _over_points(p: Points, of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
    """The mean over all centred points of what ``of`` sums for a tile."""
    dim, shift = p.dim, np.array(p.rest) / p.n

    def task(batch: pa.RecordBatch) -> np.ndarray:
        return sum((of(tile) for tile in _centred_tiles(batch, dim, shift)), np.zeros(shape))

    return _summed(p.tiles.select("data", "width"), p.parts, task, shape) / p.n


def covariance_product(p: Points) -> Product:
    """The covariance times a matrix with few columns: one pass over the points."""

    def product(block: np.ndarray) -> np.ndarray:
        return _over_points(p, lambda tile: tile.T @ (tile @ block), block.shape)

    return product


def _extended(basis: np.ndarray, block: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the block adds to the given one."""
    for _ in range(3):
        norm = np.linalg.norm(block, axis=0)
        block = block[:, norm > 0] / norm[norm > 0]
        block = block - basis @ (basis.T @ block)
        if block.shape[1] == 0:
            break
        block, size = np.linalg.qr(block)
        block = block[:, np.abs(np.diag(size)) > 1e-10]
    return block


def _minres(product: Product, right: np.ndarray, steps: int) -> np.ndarray:
    """Some MINRES steps for a symmetric system for each column, all columns in the same passes.

    A column whose residual has fallen to ``ENOUGH`` of the right side stays as it is: near an eigenvalue, further
    steps would only enlarge rounding.
    """
    columns = right.shape[1]
    old, beta = np.zeros_like(right), np.zeros(columns)
    size = first = np.linalg.norm(right, axis=0)
    new = right / np.where(size > 0, size, 1)
    cosine, sine = np.ones((2, columns)), np.zeros((2, columns))  # of the last two rotations
    direction = np.zeros((2, *right.shape))
    found = np.zeros_like(right)
    for _ in range(steps):
        ahead = product(new) - old * beta
        alpha = (new * ahead).sum(axis=0)
        ahead -= new * alpha
        following = np.linalg.norm(ahead, axis=0)
        before = cosine[1] * alpha - cosine[0] * sine[1] * beta
        turned = np.hypot(before, following)
        turned = np.where(turned > 0, turned, 1)
        step = new - direction[0] * (sine[0] * beta) - direction[1] * (sine[1] * alpha + cosine[0] * cosine[1] * beta)
        direction = np.stack([direction[1], step / turned])
        cosine, sine = np.stack([cosine[1], before / turned]), np.stack([sine[1], following / turned])
        open_ = np.abs(size) > ENOUGH * first
        if not open_.any():
            break
        found += direction[1] * (cosine[1] * size) * open_
        size = -sine[1] * size
        old, new, beta = new, ahead / np.where(following > 0, following, 1), following
    return found


def jacobi_davidson(
    product: Product, dim: int, wanted: int, *, largest: int = LARGEST, inner: int = INNER, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors in columns) of the ``wanted`` largest of a symmetric operator.

    Pairs are locked from the largest on, once their residual is at most ``ASKED`` of the largest eigenvalue.
    """
    wanted = min(wanted, dim)
    start = min(wanted + GUARD, dim)
    most = min(dim, max(largest, 2 * start))
    locked, values = np.zeros((dim, 0)), np.zeros(0)
    basis = _extended(locked, np.random.default_rng(1).standard_normal((dim, start)))
    image = product(basis)
    for _ in range(rounds):
        small = basis.T @ image
        theta, turn = np.linalg.eigh((small + small.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        open_ = wanted - len(values)
        # What the images have of locked vectors is rounding.
        rest = image[:, :open_] - basis[:, :open_] * theta[:open_]
        rest -= locked @ (locked.T @ rest)
        worst, scale = np.linalg.norm(rest, axis=0), max([*values[:1], theta[0], 0.0])
        good = worst <= ASKED * scale
        done = len(good) if good.all() else int(good.argmin())
        locked = np.hstack([locked, basis[:, :done]])
        values = np.concatenate([values, theta[:done]])
        basis, image, theta = basis[:, done:], image[:, done:], theta[done:]
        if len(values) == wanted:
            break
        open_, rest, good = open_ - done, rest[:, done:], good[done:]
        near = np.hstack([locked, basis[:, :open_]])
        shift = theta[:open_][~good]

        def projected(block: np.ndarray, near=near) -> np.ndarray:
            return block - near @ (near.T @ block)

        def corrected(block: np.ndarray, shift=shift, projected=projected) -> np.ndarray:
            return projected(product(block) - block * shift)

        more = _minres(corrected, -projected(rest[:, ~good]), inner)
        if basis.shape[1] + more.shape[1] > most - len(values):
            kept = min(open_ + GUARD, basis.shape[1])
            basis, image = basis[:, :kept], image[:, :kept]
        more = _extended(np.hstack([locked, basis]), more)
        if more.shape[1] == 0:  # the subspace holds all that can be reached
            more = _extended(np.hstack([locked, basis]), np.random.default_rng(len(values)).standard_normal((dim, 1)))
        if more.shape[1]:
            basis, image = np.hstack([basis, more]), np.hstack([image, product(more)])
    else:
        if (worst > ACCEPTED * scale).any():
            raise ArithmeticError(f"residuals of {worst.max() / scale:.1e} after {rounds} rounds")
        locked, values = np.hstack([locked, basis[:, :open_]]), np.concatenate([values, theta[:open_]])
    order = np.argsort(-values, kind="stable")
    return values[order], locked[:, order]


def fit_whitening(points: Points, components: int = COMPONENTS) -> Whitening:
    """The components of the points; those without variance (10^-12 of all) are left out."""
    total = float(_over_points(points, lambda tile: np.array([np.vdot(tile, tile)]), (1,))[0])
    values, vectors = np.zeros(0), np.zeros((points.dim, 0))
    if total > 0:
        values, vectors = jacobi_davidson(covariance_product(points), points.dim, components)
    kept = values > 1e-12 * total
    values, vectors = values[kept], vectors[:, kept]
    if not len(values):
        return Whitening(points, vectors, values, total, 0.0)
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    vectors = vectors * sign
    scaled = vectors / np.sqrt(values)

    def moments(tile: np.ndarray) -> np.ndarray:
        white = np.hstack([tile @ scaled, np.ones((len(tile), 1))])
        return white.T @ white

    found = _over_points(points, moments, (len(values) + 1,) * 2)
    mean = found[-1, :-1]
    covariance = found[:-1, :-1] - np.outer(mean, mean)
    return Whitening(points, vectors, values, total, float(np.abs(covariance - np.eye(len(values))).max()))


def _deviations(off: np.ndarray, n: int, rest: Sequence[int], largest: int) -> list[decimal.Decimal]:
    """Sum over the dimensions of (n off - rest)^2, exact."""
    bound = n * (largest + 1)
    if bound * bound * len(rest) < 1 << 62:
        own = n * off - np.array(rest)
        sums = (own * own).sum(axis=1).tolist()
    else:
        own = n * off.astype(object) - np.array(rest, object)
        sums = (own * own).sum(axis=1).tolist()
    return [decimal.Decimal(s) for s in sums]


def whiten(
    embeddings: DataFrame,
    *,
    vector: str = "embedding",
    components: int = COMPONENTS,
    keep: Sequence[str] = ("vec_id",),
    dim: int | None = None,
) -> DataFrame:
    """``keep`` of every usable row, with n, deviation, whitened, explained and identity_error.

    A vector is put on a grid, x = floor(64 c) + 1,000,000 for each entry c. The fit list is every
    distinct x once, n of them with sums S. ``deviation`` is the sum of (n x - S)^2 over all dimensions, exact
    (DECIMAL(38,0)); ``whitened`` an array, x - S / n on each of the first ``components`` unit eigenvectors of the fit list's
    covariance, by falling eigenvalue, over the root of the eigenvalue; ``explained`` the eigenvalues' parts of all variance;
    ``identity_error`` the largest entry of the whitened fit list's covariance less the identity.

    Rows go whose vector is NULL, or holds NULL, non-finite entries or ones of 2^40 or more in size, and
    those of another dimension than ``dim``, which is that of most rows if it is not given, the larger one of two. Repeated
    rows are each returned. There are fewer components if the dimension is smaller or the rest has no
    variance: with one distinct vector the arrays are empty. An empty table gives an empty result. Points and tiles are stored.
    """
    out = [c for c in keep if c not in ("n", "deviation", "whitened", "explained", "identity_error")]
    x, fields = fresh(embeddings.select(*out), "_x"), embeddings.select(*out).schema
    sound = embeddings.where(usable(F.col(vector)))
    if dim is None:
        found = sound.groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("c")).orderBy(F.desc("c"), F.desc("d")).first()
        dim = found["d"] if found else 0
    sound = sound.where(F.size(vector) == dim)
    fitted = fit_points(sound, vector, dim) if dim else None
    schema = ", ".join(
        [*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields),
         "n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"]
    )
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], schema)
    fit = fit_whitening(fitted, components)
    base, shift = np.array(fitted.base), np.array(fitted.rest) / fitted.n
    n, rest, scaled = fitted.n, fitted.rest, fit.vectors / np.sqrt(fit.variances)
    explained, error = (fit.variances / (fit.total_variance or 1)).tolist(), fit.identity_error
    largest = fitted.largest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            off = _matrix(batch[x], dim) - base
            white = (off - shift) @ scaled
            lists = pa.ListArray.from_arrays(
                pa.array(np.arange(len(off) + 1) * white.shape[1], pa.int32()), pa.array(white.ravel(), pa.float64())
            )
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(np.full(len(off), n)),
                    pa.array(_deviations(off, n, rest, largest), pa.decimal128(38, 0)),
                    lists,
                    pa.array([explained] * len(off), pa.list_(pa.float64())),
                    pa.array(np.full(len(off), error)),
                ],
                names=names,
            )

    names = [*out, "n", "deviation", "whitened", "explained", "identity_error"]
    return sound.select(*out, on_grid(F.col(vector)).alias(x)).mapInArrow(run, schema)
