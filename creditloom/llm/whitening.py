"""Whitening of embeddings by Chebyshev-filtered subspace iteration."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditloom.session import materialize

EPS = np.finfo(float).eps
LONG = 1 << 63
HALF = 32
"""Sums of whole numbers travel as the sums of their upper and lower 32 bits, so that they are exact."""


@dataclass
class Whitening:
    """A fitted whitening: unit components as columns, their eigenvalues, and what proves them."""

    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    residuals: np.ndarray
    identity_error: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def fit_whitening(
    vectors: DataFrame, components: int = 4, scale: int = 256, block: int = 24, degree: int = 8, rounds: int = 12,
    vector_col: str = "embedding", seed: int = 13,
) -> Whitening | None:
    """The leading eigenvectors of the covariance of all distinct vectors, certified to double precision.

    Entries become whole numbers floor(scale * c). Rows whose vector is null or holds null or non-finite
    entries are left out, as are vectors of another length than most of the distinct ones have (of
    lengths equally frequent, the greatest); entries beyond a long count as its ends. Each distinct
    vector is fitted once.

    A block of random orthonormal columns Q is improved in rounds. A pass over the vectors sums up
    (x - mean)(x - mean)'Q, centred before multiplying; its projection on Q gives Ritz values and vectors and
    their residuals. `degree` passes apply the Chebyshev polynomial that is small on [0, least Ritz value of
    the block] and grows beyond, so the unwanted part of the spectrum is damped; QR makes the block
    orthonormal again. The result is certified when every wanted vector's residual is below 1e-11 of its
    gap to the other Ritz values, which bounds its angle to an eigenvector, or at rounding. After
    `rounds` rounds without that, as for eigenvalues that are (nearly) equal at the end of the wanted ones,
    the block is doubled; at the full dimension Rayleigh-Ritz is the whole decomposition.

    The distinct vectors are written once, packed, and read in each pass. Each task sends one block of
    sums, combined by cell in Spark; dimension x block numbers reach the driver. Eigenvalues below 1e-10 of the largest
    count as zero and give no component. None when nothing remains: an empty table, equal vectors, no entries.
    """
    packed = vectors.select(F.col(vector_col).alias("v")).mapInArrow(
        lambda batches: _pack(batches, scale), "dims int, key binary"
    )
    fit = materialize(packed.where("key is not null").distinct(), "fit-list")
    lengths = fit.groupBy("dims").count().orderBy(F.desc("count"), F.desc("dims")).first()
    if lengths is None or not lengths["dims"]:
        return None
    dims, n = lengths
    fit = fit.where(F.col("dims") == dims)
    sums = _sums(fit, dims)
    mean = np.array([s / n for s in sums])
    trace = float(_over(fit, dims, lambda x: np.square(x - mean).sum(keepdims=True))[0, 0]) / n
    if trace == 0:
        return None
    passes = 0

    def covariance(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ q)

        return _over(fit, dims, part) / n

    wanted, width = min(components, dims), min(dims, max(block, components))
    draw = np.random.default_rng(seed)
    q = np.linalg.qr(draw.standard_normal((dims, width)))[0]
    turn = 0
    while True:
        vq = covariance(q)
        h = q.T @ vq
        ritz, u = np.linalg.eigh((h + h.T) / 2)
        ritz, u = ritz[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        residual = np.linalg.norm(vq - q * ritz, axis=0)[:wanted]
        rest = np.abs(ritz[:wanted, None] - ritz[None, :])
        rest[np.arange(wanted), np.arange(wanted)] = np.inf
        gap = rest.min(axis=1) if width > 1 else np.full(wanted, ritz[0])
        zero = ritz[:wanted] <= 1e-10 * ritz[0]
        if width == dims or np.all(zero | (residual <= np.maximum(1e-11 * gap, 2 * EPS * ritz[0]))):
            break
        turn += 1
        if turn % rounds == 0:
            more = draw.standard_normal((dims, min(dims, 2 * width) - width))
            q = np.linalg.qr(np.hstack([q, more]))[0]
            width = q.shape[1]
            continue
        q = np.linalg.qr(_chebyshev(covariance, q, vq, degree, max(ritz[-1], EPS * ritz[0])))[0]

    keep = ritz[:wanted] > 1e-10 * ritz[0]
    found = Whitening(n, sums, q[:, :wanted][:, keep], ritz[:wanted][keep], trace, residual[keep], 0.0, passes)
    found.identity_error = _identity_error(fit, dims, found)
    return found


def _chebyshev(covariance, q: np.ndarray, vq: np.ndarray, degree: int, beta: float) -> np.ndarray:
    """The Chebyshev polynomial of the covariance, for the interval [0, beta], applied to q, up to a factor."""
    half = beta / 2
    before, now = q, (vq - half * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (covariance(now) - half * now) / half - before
        size = np.abs(now).max()
        before, now = before / size, now / size
    return now


def whiten(vectors: DataFrame, fitted: Whitening | None, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per remaining vector and component: the whitened coordinate, with the fit's figures.

    A map over the rows, nothing is shuffled. Repeated rows and null identifiers give rows of their
    own; rows that the fit leaves out give none; other columns are ignored. `deviation` is exact, and null where
    it exceeds a long.

    Returns vec_id, component (from 1), n, deviation (sum of (n * x - sums) ** 2), whitened, explained (share of
    the trace), identity_error.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("v"))
    if fitted is None:
        return rows.select(*[F.lit(None).cast(t).alias(c) for c, t in (part.split(" ") for part in schema.split(", "))]).limit(0)
    return rows.mapInArrow(lambda batches: _project(batches, fitted, scale), schema)


def _whole(v: pa.Array, scale: int) -> list[np.ndarray | None]:
    """The whole numbers of each vector, None for a vector that is left out."""
    values = v.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    with np.errstate(over="ignore", invalid="ignore"):
        x = np.floor(scale * values)
        whole = np.where(np.abs(x) < LONG, x, 0).astype("<i8")
    whole[x >= LONG], whole[x < -LONG] = LONG - 1, -LONG
    good = np.isfinite(values)
    out, at = [], 0
    for size in v.value_lengths().to_pylist():
        if size is None:
            out.append(None)
            continue
        out.append(whole[at : at + size] if good[at : at + size].all() else None)
        at += size
    return out


def _pack(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """Each vector's length and its numbers in the least of 2, 4 or 8 bytes that holds them all."""
    for batch in batches:
        dims, keys = [], []
        for x in _whole(batch.column("v"), scale):
            if x is None:
                dims.append(None)
                keys.append(None)
                continue
            low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
            width = next(w for w in (2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
            dims.append(len(x))
            keys.append(x.astype(f"<i{width}").tobytes())
        yield pa.record_batch({"dims": pa.array(dims, pa.int32()), "key": pa.array(keys, pa.binary())})


def _unpack(batch: pa.RecordBatch, dims: int) -> Iterator[np.ndarray]:
    """The packed vectors as matrices of whole numbers, one per width."""
    keys = batch.column("key").to_pylist()
    for width in (2, 4, 8):
        same = [k for k in keys if len(k) == width * dims]
        if same:
            yield np.frombuffer(b"".join(same), dtype=f"<i{width}").reshape(-1, dims)


def _over(fit: DataFrame, dims: int, part) -> np.ndarray:
    """The sum of a matrix that is computed per block of vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for x in _unpack(batch, dims):
                here = part(x.astype(float))
                total = here if total is None else total + here
        if total is not None:
            rows, columns = np.indices((total.size // total.shape[-1], total.shape[-1])).reshape(2, -1)
            yield pa.record_batch(
                {"i": pa.array(rows, pa.int32()), "j": pa.array(columns, pa.int32()), "value": pa.array(total.ravel())}
            )

    cells = fit.mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()
    out = np.zeros((1 + max(c["i"] for c in cells), 1 + max(c["j"] for c in cells)))
    for c in cells:
        out[c["i"], c["j"]] = c["value"]
    return out


def _sums(fit: DataFrame, dims: int) -> list[int]:
    """The exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, lower = np.zeros(dims, dtype="<i8"), np.zeros(dims, dtype="<i8")
        for batch in batches:
            for x in _unpack(batch, dims):
                x = x.astype("<i8")
                upper += (x >> HALF).sum(axis=0)
                lower += (x & ((1 << HALF) - 1)).sum(axis=0)
        yield pa.record_batch({"i": pa.array(range(dims), pa.int32()), "upper": pa.array(upper), "lower": pa.array(lower)})

    cells = fit.mapInArrow(run, "i int, upper long, lower long").groupBy("i").agg(
        *[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("upper", "lower")]
    )
    return [(int(c["upper"]) << HALF) + int(c["lower"]) for c in cells.orderBy("i").collect()]


def _identity_error(fit: DataFrame, dims: int, found: Whitening) -> float:
    """The largest entry of the whitened vectors' covariance less the identity."""
    mean, axes = found.mean, found.components / np.sqrt(found.eigenvalues)
    middle = _over(fit, dims, lambda x: ((x - mean) @ axes).sum(axis=0, keepdims=True))[0] / found.n

    def part(x: np.ndarray) -> np.ndarray:
        centred = (x - mean) @ axes - middle
        return centred.T @ centred

    return float(np.abs(_over(fit, dims, part) / found.n - np.eye(axes.shape[1])).max())


def _project(batches: Iterator[pa.RecordBatch], fitted: Whitening, scale: int) -> Iterator[pa.RecordBatch]:
    mean, axes = fitted.mean, fitted.components / np.sqrt(fitted.eigenvalues)
    dims, k = axes.shape
    sums = np.array(fitted.sums, dtype=object)
    top = max(map(abs, fitted.sums))
    for batch in batches:
        whole = _whole(batch.column("v"), scale)
        used = [i for i, x in enumerate(whole) if x is not None and len(x) == dims]
        if not used:
            continue
        x = np.stack([whole[i] for i in used])
        far = fitted.n * max(abs(int(x.min())), abs(int(x.max()))) + top
        if dims * far * far < LONG:
            deviation = np.square(fitted.n * x - sums.astype("<i8")).sum(axis=1).tolist()
        else:
            exact = (np.square(fitted.n * x.astype(object) - sums)).sum(axis=1)
            deviation = [d if d < LONG else None for d in exact]
        rows = len(used)
        ids = batch.column("vec_id").take(pa.array(np.repeat(used, k), pa.int64()))
        yield pa.record_batch(
            {
                "vec_id": ids,
                "component": pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()),
                "n": pa.array(np.full(rows * k, fitted.n), pa.int64()),
                "deviation": pa.array([d for d in deviation for _ in range(k)], pa.int64()),
                "whitened": pa.array(((x - mean) @ axes).ravel()),
                "explained": pa.array(np.tile(fitted.eigenvalues / fitted.trace, rows)),
                "identity_error": pa.array(np.full(rows * k, fitted.identity_error)),
            }
        )
