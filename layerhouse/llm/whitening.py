"""Whitening of embeddings by QDWH spectral divide and conquer.

Entries become integers, so the moments of the fit list are exact: counts, sums and centred products are
added up as integers in the tasks and merged in a tree.  The covariance (one small matrix, whatever the
number of rows) is split on the driver: the polar factor of the matrix less a shift, found by the dynamically
weighted Halley iteration with QR factors only, gives the projectors on the eigenspaces above and below the
shift, and each invariant subspace is split again until its components stand alone.  Mean and leading
components then go to the tasks, which whiten every row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from layerhouse.session import written

#: Components returned, and the scale and offset of the integers.
COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000

#: Partial sums that one task of the next round adds up, and that the driver reads in the end.
FAN = 32

#: Rows that are turned into one array at a time: bytes of their integers.
STEP_BYTES = 4_000_000

EPS = np.finfo(float).eps


# ---------------------------------------------------------------- exact sums in a tree

def tree_sum(partials: DataFrame, parse: Callable[[str], object]) -> list | None:
    """Sum the lists of numbers in ``partials.values``, place by place; None where there are none.

    Each round one task adds up about ``FAN`` lists, one after the other, so neither a task nor the driver
    holds more than a few of them.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for row in range(batch.num_rows):
                own = [parse(v) for v in batch.column(0)[row].as_py()]
                total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([[repr(v) for v in total]], pa.list_(pa.string()))], names=["values"])

    partials = written(partials)
    parts = partials.rdd.getNumPartitions()
    while parts > FAN:
        parts = -(-parts // FAN)
        partials = written(partials.repartition(parts).mapInArrow(add, partials.schema))
    rows = partials.mapInArrow(add, partials.schema).collect()
    total = None
    for row in rows:
        own = [parse(v) for v in row["values"]]
        total = own if total is None else [a + b for a, b in zip(total, own, strict=True)]
    return total


PARTIAL = T.StructType([T.StructField("values", T.ArrayType(T.StringType()))])


def _emit(values: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([[repr(v) for v in values]], pa.list_(pa.string()))], names=["values"])


def rows_of(batches: Iterator[pa.RecordBatch], place: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Runs of rows with their vectors as one array; all vectors have one length."""
    for batch in batches:
        if not batch.num_rows:
            continue
        width = max(1, len(batch.column(place)[0]))
        step = max(1, STEP_BYTES // (8 * width))
        for start in range(0, batch.num_rows, step):
            part = batch.slice(start, step)
            yield part, part.column(place).flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def usable(vector: Column) -> Column:
    """Not null, not empty, and without null or non-finite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & ~bad, F.lit(False))


def one_width(df: DataFrame, column: str) -> int | None:
    """The length of all vectors; None for an empty table, an error where lengths differ."""
    least, most = df.agg(F.min(F.size(column)), F.max(F.size(column))).first()
    if least != most:
        raise ValueError(f"vectors of different lengths: {least} to {most}")
    return least


# ---------------------------------------------------------------- moments

def moments(fit: DataFrame) -> tuple[int, list[int], np.ndarray] | None:
    """Rows, sums per dimension, and the covariance of the integer vectors ``x`` (divisor: rows).

    Products are taken about the integers nearest to the means and corrected by what is left, all in exact
    integers; only the last division rounds.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high = 0, 0, 0
        for _, x in rows_of(batches, 0):
            n += len(x)
            low = low + (x & 0xFFFFFFFF).sum(axis=0)  # halves cannot overflow
            high = high + (x >> 32).sum(axis=0)
        if n:
            yield _emit([n, *(int(h) * (1 << 32) + int(lo) for h, lo in zip(high, low, strict=True))])

    told = tree_sum(fit.mapInArrow(count, PARTIAL), int)
    if told is None:
        return None
    n, sums = told[0], told[1:]
    near = [(2 * s + n) // (2 * n) for s in sums]
    width = len(sums)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held, bound = np.zeros((width, width), object), np.zeros((width, width), "i8"), 0
        middle = np.array(near, "i8")
        for _, x in rows_of(batches, 0):
            y = x - middle
            most = int(np.abs(y.astype(float)).max()) + 1
            if most >= 1 << 26:
                wide = np.array([[int(a) - b for a, b in zip(row, near, strict=True)] for row in x], object)
                total = total + wide.T @ wide
                continue
            step = (1 << 53) // (most * most)  # sums of so many products are exact in doubles
            for start in range(0, len(y), step):
                part = y[start:start + step].astype(float)
                bound += most * most * len(part)
                if bound >= 1 << 62:
                    total, held, bound = total + held.astype(object), np.zeros((width, width), "i8"), most * most * len(part)
                held += (part.T @ part).astype("i8")
        yield _emit([int(v) for v in (total + held.astype(object)).ravel()])

    gram = tree_sum(fit.mapInArrow(multiply, PARTIAL), int)
    rest = [s - n * c for s, c in zip(sums, near, strict=True)]
    covariance = np.array([
        [(n * gram[i * width + j] - rest[i] * rest[j]) / (n * n) for j in range(width)] for i in range(width)])
    return n, sums, covariance


# ---------------------------------------------------------------- QDWH

def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix by QR-based dynamically weighted Halley steps."""
    size = len(a)
    one = np.eye(size)
    x = a / np.linalg.norm(a)  # the Frobenius norm bounds the largest singular value
    least = 1 / max(1.0, np.linalg.norm(np.linalg.pinv(np.linalg.qr(x, mode="r")), 1) * np.sqrt(size)) if size > 1 else 1.0
    low = max(min(least, 1.0), EPS)
    for _ in range(40):
        before = x
        d = np.cbrt(4 * max(0.0, 1 - low * low) / low ** 4)
        first = np.sqrt(1 + d)
        a_k = first + 0.5 * np.sqrt(max(0.0, 8 - 4 * d + 8 * (2 - low * low) / (low * low * first)))
        b_k = (a_k - 1) ** 2 / 4
        c_k = a_k + b_k - 1
        q = np.linalg.qr(np.vstack([np.sqrt(c_k) * x, one]))[0]
        x = (b_k / c_k) * x + (a_k - b_k / c_k) / np.sqrt(c_k) * (q[:size] @ q[size:].T)
        low = min(1.0, low * (a_k + b_k * low * low) / (1 + c_k * low * low))
        if np.linalg.norm(x - before) <= np.cbrt(EPS) and 1 - low < 10 * EPS:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, int] | None:
    """An orthogonal basis whose first ``k`` vectors span the eigenspace above the shift; None if it does not split."""
    size = len(a)
    sign = polar(a - shift * np.eye(size))
    projector = (sign + sign.T) / 4 + np.eye(size) / 2
    k = int(round(np.trace(projector)))
    if not 0 < k < size or np.linalg.norm(projector @ projector - projector) > 1e-8 * size:
        return None  # all on one side, or the shift is an eigenvalue
    lead = projector[:, np.argsort(-np.diag(projector), kind="stable")]
    basis = np.linalg.qr(lead, mode="complete")[0]
    for _ in range(2):  # subspace iteration makes the span exact
        basis = np.linalg.qr(np.hstack([projector @ basis[:, :k], basis[:, k:] - projector @ basis[:, k:]]), mode="complete")[0]
    return basis, k


def components(a: np.ndarray, norm: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    size = len(a)
    norm = np.linalg.norm(a) if norm is None else norm
    diagonal = np.diag(a)
    if size == 1 or np.linalg.norm(a - np.diag(diagonal)) <= EPS * norm / 4:
        order = np.argsort(-diagonal, kind="stable")
        return diagonal[order], np.eye(size)[:, order]
    mean, spread = float(diagonal.mean()), float(np.linalg.norm(a - diagonal.mean() * np.eye(size)))
    if spread <= 8 * EPS * norm:
        return diagonal.copy(), np.eye(size)  # one eigenvalue, as far as doubles tell
    # the mean always lies inside the spectrum; small moves leave an eigenvalue it may have met
    for shift in (float(np.median(diagonal)), mean, *(mean + f * spread / size for f in (1e-3, -1e-3, 1e-2, -1e-2, 0.1, -0.1))):
        if (found := _split(a, shift)) is not None:
            break
    else:
        raise ArithmeticError("a symmetric matrix could not be split")
    basis, k = found
    values, vectors = [], []
    for part in (basis[:, :k], basis[:, k:]):
        inner = part.T @ a @ part
        own, turned = components((inner + inner.T) / 2, norm)
        values.append(own)
        vectors.append(part @ turned)
    values, vectors = np.concatenate(values), np.hstack(vectors)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


# ---------------------------------------------------------------- whitening

class Whitening(NamedTuple):
    """What the tasks need: rows and sums of the fit list, components (rows) and their eigenvalues, null where zero."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: list[float]
    explained: list[float | None]
    alive: list[bool]


def fitted(fit: DataFrame, most: int = COMPONENTS) -> Whitening | None:
    told = moments(fit)
    if told is None:
        return None
    n, sums, covariance = told
    values, vectors = components(covariance)
    trace = float(np.trace(covariance))
    most = min(most, len(values))
    floor = len(values) * EPS * max(float(values[0]), 0.0)
    return Whitening(n, sums, vectors[:, :most].T.copy(), values[:most].tolist(),
                     [float(v) / trace if trace > 0 else None for v in values[:most]],
                     [bool(v > floor) for v in values[:most]])


def _centred(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, list[int | None]]:
    """``x`` less the mean, and the sum of squares of ``n * x`` less the sums, exactly; null beyond 64 bits."""
    sums = np.array(model.sums, float)
    most = float(np.abs(x.astype(float) * model.n - sums).max()) + 1 if x.size else 0.0
    if most * most * x.shape[1] < 2.0 ** 62 and float(np.abs(x.astype(float)).max(initial=0)) * model.n < 2.0 ** 62:
        far = x * model.n - np.array(model.sums, "i8")
        return far / model.n, (far * far).sum(axis=1).tolist()
    far = x.astype(object) * model.n - np.array(model.sums, object)
    squares = [int(v) for v in (far * far).sum(axis=1)]
    return (far / model.n).astype(float), [v if v < 1 << 63 else None for v in squares]


def _project(centred: np.ndarray, model: Whitening) -> np.ndarray:
    scale = np.array([1 / np.sqrt(v) if ok else np.nan for v, ok in zip(model.values, model.alive, strict=True)])
    return (centred @ model.axes.T) * scale


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity, over components with a variance."""
    alive = np.array(model.alive)
    size = int(alive.sum())
    if not size:
        return None

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + size * size)
        for _, x in rows_of(batches, 0):
            w = _project(_centred(x, model)[0], model)[:, alive]
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield _emit([float(v) for v in total])

    total = np.array(tree_sum(fit.mapInArrow(add, PARTIAL), float)) / model.n
    mean, products = total[:size], total[size:].reshape(size, size)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(size)).max())


def integers(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id`` and ``x``, the integers of each usable vector; entries beyond 64 bits are held at the border."""
    kept = df.select(F.col(id_col).alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(usable(F.col("v")))
    border = float(1 << 62)
    held = F.transform("v", lambda c: F.greatest(F.least(c * SCALE, F.lit(border)), F.lit(-border)))
    return kept.select("vec_id", F.transform(held, lambda c: F.floor(c).cast("long") + F.lit(OFFSET).cast("long")).alias("x"))


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` for every usable row and component.

    Rows whose vector is null, empty or holds null or non-finite entries are left out; vectors of different
    lengths are an error.  Equal vectors count once in the fit.  A component without variance has a null
    ``whitened`` and takes no part in ``identity_error``; a fit list of one vector has none at all and a null
    ``explained``.  ``deviation`` is null beyond 64 bits.  Repeated rows repeat their result, a null identifier
    stays null, an empty table gives an empty result, other columns are not read.
    """
    rows = integers(df, id_col, vec_col)
    schema = T.StructType([
        rows.schema["vec_id"], T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    # equal vectors meet in the map tasks first, so a hot one is a row per task
    fit = written(rows.select("x").distinct())
    width = one_width(fit, "x")
    model = fitted(fit, most) if width else None
    error = identity_error(fit, model) if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in rows_of(batches, 1):
            centred, deviation = _centred(x, model)
            out = _project(centred, model)
            size, many = part.num_rows, len(model.values)
            yield pa.RecordBatch.from_arrays([
                part.column(0).take(pa.array(np.repeat(np.arange(size), many))),
                pa.array(np.tile(np.arange(1, many + 1, dtype="i4"), size)), pa.array([model.n] * (size * many), pa.int64()),
                pa.array([v for v in deviation for _ in range(many)], pa.int64()),
                pa.array(out.ravel(), pa.float64(), from_pandas=True),
                pa.array(model.explained * size, pa.float64()), pa.array([error] * (size * many), pa.float64()),
            ], names=schema.names)

    return rows.mapInArrow(run, schema)
