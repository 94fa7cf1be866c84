"""Whitening of embeddings by the principal components of their distinct vectors, on a grid of integers."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from driftlake.llm.scratch import ship, write_shared

#: A component c becomes floor(SCALE * c) + SHIFT; beyond 2**REACH either way it stays there.
SCALE, SHIFT, REACH = 64, 1_000_000, 40
#: Components that are returned at most.
COMPONENTS = 16
#: Rows multiplied at once.
ROWS = 4096
#: Rounds of refinement at most; eigenvalues closer than so much of the largest are solved together.
#: The largest error of a residue or an inner product at which the rounds end.
ROUNDS, CLOSE, DONE = 20, 1e-5, 1e-17
#: The precision of refinement: more than the double precision that is asked of its result.
_HIGH = np.longdouble


@dataclass
class Fit:
    """Of the n distinct vectors: sums, variances along the components (falling), components by column, the trace, and the
    largest entry of whitened's covariance minus the identity."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0


def _refined(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One step of Ogita and Aishima: better eigenvectors x (by column) of the symmetric a, and their eigenvalues.

    r tells how far x is from orthonormal, s how far x' a x is from diagonal. Where two eigenvalues are well apart, the
    correction follows from both; where not, it only makes the two vectors orthogonal, and _parted does the rest."""
    r = np.eye(x.shape[1], dtype=_HIGH) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = np.abs(s - np.diag(values)).sum(1).max() + np.abs(values).max() * np.abs(r).sum(1).max()
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > 2 * off
    e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
    np.fill_diagonal(e, np.diag(r) / 2)
    return x + x @ e, values


def _parted(a: np.ndarray, x: np.ndarray, values: np.ndarray, close: float) -> tuple[np.ndarray, np.ndarray]:
    """Inside each cluster of eigenvalues that are close, the small problem of the vectors' own span, shifted by the cluster's
    mean so that its differences count in full, is solved and turns the vectors."""
    order = np.argsort(-values)
    values, x = values[order], x[:, order].copy()
    breaks = np.flatnonzero(values[:-1] - values[1:] > close) + 1
    for own in np.split(np.arange(len(values)), breaks):
        if len(own) > 1:
            span = x[:, own]
            for _ in range(2):  # orthonormal first, as the small problem takes it to be
                span = span + span @ (np.eye(len(own), dtype=_HIGH) - span.T @ span) / 2
            mean = values[own].mean()
            small = span.T @ (a @ span - mean * span)
            small = (small + small.T) / 2
            size = float(np.abs(small).max())
            if size > 0:
                moved, turn = np.linalg.eigh((small / size).astype(np.float64))
                turn = turn.astype(_HIGH)
                for _ in range(3):
                    turn, moved = _refined(small / size, turn)
                back = np.argsort(-moved)
                x[:, own], values[own] = span @ turn[:, back], mean + moved[back] * size
    return x, values


def eigen(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (by column) of a symmetric matrix, to double precision.

    Vectors of single precision are the start. Each round corrects all of them by products of matrices in higher precision,
    which doubles the right digits of those whose eigenvalues are apart, and solves clusters of close ones by themselves; it
    ends when what is left is below what double precision can tell."""
    d = len(a)
    if not d:
        return np.zeros(0), np.zeros((0, 0))
    size = float(np.abs(a).max()) or 1.0
    high = (a / size).astype(_HIGH)
    high = (high + high.T) / 2
    x = np.linalg.eigh((a / size).astype(np.float32))[1].astype(_HIGH)
    eye = np.eye(d, dtype=_HIGH)
    for _ in range(ROUNDS):
        x, values = _refined(high, x)
        x, values = _parted(high, x, values, CLOSE * float(np.abs(values).max()))
        if max(np.abs(high @ x - x * values).max(), np.abs(x.T @ x - eye).max()) < DONE:
            break
    x = x / np.sqrt((x * x).sum(0))
    values = (x * (high @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    return (values[order] * size).astype(np.float64), x[:, order].astype(np.float64)


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of packed integers."""
    _, offsets, data = column.buffers()
    n = len(column)
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + n + 1]
    return np.frombuffer(data, np.int64, count=(offsets[-1] - offsets[0]) // 8, offset=offsets[0]).reshape(n, -1) if n else np.zeros((0, 0), np.int64)


def _packed(values: pa.Array) -> pa.Array:
    """Each vector's integers, without SHIFT, as little-endian bytes."""
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    y = np.floor(np.clip(flat * SCALE, -(2.0**REACH), 2.0**REACH)).astype("<i8")
    sizes = np.diff(values.offsets.to_numpy())
    offsets = np.r_[0, np.cumsum(8 * sizes)].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(values), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(y.tobytes())])


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, total = 0, None
    for batch in batches:
        for lo in range(0, batch.num_rows, ROWS):
            y = _matrix(batch.column(0).slice(lo, ROWS))
            part = y.sum(0).astype(object)
            total, n = part if total is None else total + part, n + len(y)
    if n:
        d = len(total)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, d), pa.int32()), pa.array([str(v) for v in (n, *total)], pa.string())], ["i", "s"])


def _centred(y: np.ndarray, fit: Fit) -> tuple[np.ndarray, np.ndarray]:
    """n * y - sums of each entry, exactly: as integers of 64 bits where that is safe, else of any size; and the same over n."""
    most = max([1, *map(abs, fit.sums)]) + fit.n * (int(np.abs(y).max()) if y.size else 0)
    exact = (y if most < 1 << 62 else y.astype(object)) * fit.n - np.array(fit.sums, np.int64 if most < 1 << 62 else object)
    return exact, exact.astype(np.float64) / fit.n


def _gram(shared, whiten: bool):
    """Upper halves of sums of products of centred vectors (or of whitened ones with their sums, at i = -1), a task's own."""

    def go(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit: Fit = shared.value
        total = None
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                z = _centred(_matrix(batch.column(0).slice(lo, ROWS)), fit)[1]
                if whiten:
                    z = np.c_[_whitened(z, fit), np.ones(len(z))]
                part = z.T @ z
                total = part if total is None else total + part
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "v"])

    return go


def _whitened(z: np.ndarray, fit: Fit) -> np.ndarray:
    return (z @ fit.vectors) / np.sqrt(fit.values)


def _products(rows: DataFrame, fit: Fit, whiten: bool) -> np.ndarray:
    shared = rows.sparkSession.sparkContext.broadcast(fit)
    sums = rows.mapInArrow(_gram(shared, whiten), "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j, v = (sums[c].to_numpy() for c in ("i", "j", "v"))
    out = np.zeros((int(j.max()) + 1,) * 2)
    out[i, j] = out[j, i] = v
    return out


def usable(vectors: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """vectors with `__y`, the packed integers; rows whose vector is null, empty, holds null or a number that isn't finite, or is
    not of the commonest length (of two the longer), are left out."""
    ship(vectors.sparkSession)
    v = F.col(vector_col)
    whole = vectors.where(v.isNotNull() & (F.size(v) > 0) & ~F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    sizes = whole.groupBy(F.size(v).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    pack = F.arrow_udf("binary")(_packed)
    return whole.where(F.size(v) == (sizes[0]["d"] if sizes else 0)).withColumn("__y", pack(v.cast("array<double>")))


def _none(n: int = 0) -> Fit:
    return Fit(n, [], np.zeros(0), np.zeros((0, 0)), 0.0)


def fit(rows: DataFrame, most: int = COMPONENTS) -> Fit:
    """The components of usable()'s rows, each distinct vector counted once.

    Sums are exact, products are of vectors centred by them, and tasks hand on sums alone: as many numbers as half the square of
    the vectors' length, which alone reach the driver, where the small eigenproblem is solved. Components along which the
    variance is none but rounding (equal vectors, or fewer than there are components) are left out."""
    distinct = write_shared(rows.select("__y").distinct(), "distinct")
    parts = distinct.mapInArrow(_sums, "i int, s string").groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    if not parts:
        return _none()
    found = {r["i"]: int(r["s"]) for r in parts}
    n, sums = found[-1], [found[i] for i in range(len(found) - 1)]
    model = Fit(n, sums, np.zeros(0), np.zeros((0, 0)), 0.0)
    v = _products(distinct, model, False) / n
    model.trace = float(np.trace(v))
    values, vectors = eigen(v)
    kept = int((values[:most] > len(v) * 2.0**-48 * max(model.trace, 0.0)).sum())
    model.values, model.vectors = values[:kept], vectors[:, :kept]
    if kept:
        w = _products(distinct, model, True) / n
        mean = w[:-1, -1]
        model.identity_error = float(np.abs(w[:-1, :-1] - np.outer(mean, mean) - np.eye(kept)).max())
    return model


def _applied(shared):
    def go(column: pa.Array) -> pa.Array:
        model: Fit = shared.value
        k, deviations, whitened = len(model.values), [], [np.zeros((0, len(model.values)))]
        for lo in range(0, len(column), ROWS):
            exact, z = _centred(_matrix(column.slice(lo, ROWS)), model)
            safe = exact.dtype == np.int64 and (not exact.size or int(np.abs(exact).max()) ** 2 * exact.shape[1] < 1 << 62)
            squares = exact * exact if safe else exact.astype(object) ** 2
            deviations += [str(s) for s in squares.sum(1)]
            whitened.append(_whitened(z, model))
        flat = np.concatenate(whitened).ravel()
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * k), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array(deviations, pa.string()), lists], ["deviation", "whitened"])

    return go


def whiten(rows: DataFrame, model: Fit) -> DataFrame:
    """usable()'s rows with a row for each component: component (from 1), n, deviation (decimal(38,0): sum over entries of
    (n * x - sums)**2, exact), whitened (the centred vector along the component over its deviation), explained (the component's share of
    the variance) and identity_error. Repeated rows have the same answers; no components give no rows. A name that rows has already
    gets `_` after it."""
    spark: SparkSession = rows.sparkSession
    shared = spark.sparkContext.broadcast(model)
    told = F.arrow_udf("struct<deviation:string,whitened:array<double>>")(_applied(shared)).asNondeterministic()
    shares = [float(v / model.trace) for v in model.values]
    rest = [c for c in rows.columns if c != "__y"]
    found = rows.select(*[F.col(f"`{c}`") for c in rest], told("__y").alias("__told")).select(*[F.col(f"`{c}`") for c in rest], F.col("__told.deviation").cast("decimal(38,0)").alias("__deviation"), F.posexplode("__told.whitened").alias("__at", "__whitened"))
    share = F.array(*[F.lit(s) for s in shares]) if shares else F.array(F.lit(0.0))
    new = {"component": F.col("__at") + 1, "n": F.lit(model.n).cast("long"), "deviation": F.col("__deviation"), "whitened": F.col("__whitened"), "explained": F.get(share, F.col("__at")), "identity_error": F.lit(model.identity_error)}
    out = [F.col(f"`{c}`") for c in rest]
    for name, value in new.items():
        while name in rest:
            name += "_"
        out.append(value.alias(name))
    return found.select(*out)
