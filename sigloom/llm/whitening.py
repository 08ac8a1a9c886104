"""Embedding whitening by cyclic Jacobi rotations.

Vectors are quantised to integers, floor(scale * c). The fit list holds each distinct
integer vector once, so that hot copies neither weigh more nor meet in a task: copies are
packed to bytes and combined before their shuffle. Over this list Spark adds up exact sums, then the scatter of
the vectors centred by them, both as one partial result a partition. The driver has
only the symmetric d by d matrix of d dimensions: it applies Jacobi rotations in a fixed
cyclic order, d/2 disjoint ones at a time, until every off-diagonal entry has vanished beside the
square root of its diagonal entries' product, which keeps small eigenvalues accurate. The whitening
matrix (components by d) travels to the tasks, which project every row of the table;
rows are never shuffled.

Defined results: null vectors and vectors with null or non-finite components (a component that scaling
takes beyond a double included) are left out; rows
without id stay, with a null id; repeated rows get their rows each; shorter vectors count as
padded by zeros; integers beyond a long are held at its ends, deviations beyond it too; with
fewer dimensions than components there are rows for the dimensions alone; a component
without variance (one vector, or vectors in a subspace) has null as whitened and 0 as explained, and
the identity's error is then over the others (0 if there is none); signs are set so that a component's
largest entry is positive; an empty table gives no row.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.llm.mtree import quantise
from sigloom.session import materialise

#: The driver holds two square matrices of this many dimensions at most.
MAX_DIMENSIONS = 4096
#: Partial sums of one dimension meet in so many groups before the last.
SALT = 32
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Rows that a task has unpacked at a time.
CHUNK = 1024


def jacobi(a: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and, as columns, eigenvectors of a symmetric matrix.

    A sweep meets every pair (p, q) once in the order of a round-robin tournament, whose rounds are of
    disjoint pairs and so can be rotated together.
    """
    n = len(a)
    a, v = np.array(a, np.float64), np.eye(n)
    if n < 2:
        return np.diag(a).copy(), v
    seats = np.arange(n + n % 2)
    eps, top = np.finfo(np.float64).eps, np.abs(np.diag(a)).max()
    for _ in range(sweeps):
        size = np.sqrt(np.abs(np.diag(a)))
        off = np.abs(a - np.diag(np.diag(a)))
        if (off <= np.maximum(eps * np.outer(size, size), eps * eps * top)).all():
            return np.diag(a).copy(), v
        for _ in range(len(seats) - 1):
            p, q = seats[: len(seats) // 2], seats[::-1][: len(seats) // 2]
            p, q = np.minimum(p, q), np.maximum(p, q)
            p, q = p[q < n], q[q < n]
            x, y, z = a[p, p], a[q, q], a[p, q]
            live = z != 0
            p, q, x, y, z = p[live], q[live], x[live], y[live], z[live]
            with np.errstate(over="ignore"):
                tau = (y - x) / (2 * z)
                t = np.where(tau >= 0, 1.0, -1.0) / (np.abs(tau) + np.hypot(1, tau))
            c = 1 / np.hypot(1, t)
            s = t * c
            for m in (a.T, a, v.T):  # columns of a, rows of a, columns of v
                m[p], m[q] = c[:, None] * m[p] - s[:, None] * m[q], s[:, None] * m[p] + c[:, None] * m[q]
            a[p, q] = a[q, p] = 0
            a[p, p], a[q, q] = x - t * z, y + t * z
            seats = np.r_[seats[:1], seats[-1:], seats[1:-1]]
    raise ArithmeticError(f"off-diagonal entries have not vanished after {sweeps} sweeps")


def whole(column, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the usable vectors and their integers."""
    at, x = quantise(column, scale)
    out = np.clip(x, -(2.0**63), 2.0**63 - 1024).astype(np.int64)
    return at, np.where(x >= 2.0**63, MOST, out)


#: Kinds of integers that a vector is packed in, by its first byte.
KINDS = tuple(np.dtype(k) for k in ("<i1", "<i2", "<i4", "<i8"))


def packed(x: np.ndarray) -> bytes:
    """A vector of longs without its last zeros, in the least kind that holds it: equal vectors have equal bytes."""
    ink = np.flatnonzero(x)
    x = x[: ink[-1] + 1] if len(ink) else x[:0]
    low, high = (int(x.min()), int(x.max())) if len(x) else (0, 0)
    code = next(i for i, k in enumerate(KINDS) if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    return bytes([code]) + x.astype(KINDS[code]).tobytes()


def length(data: bytes) -> int:
    return (len(data) - 1) // KINDS[data[0]].itemsize


def unpacked(column, dims: int) -> np.ndarray:
    """Vectors of longs from bytes."""
    out = np.zeros((len(column), dims), np.int64)
    for i, b in enumerate(column.to_pylist()):
        x = np.frombuffer(b, KINDS[b[0]], offset=1)
        out[i, : len(x)] = x
    return out


def distinct_vectors(rows: DataFrame, scale: float) -> DataFrame:
    """x: each distinct integer vector once, packed. rows: v."""

    def run(batches):
        for batch in batches:
            seen: dict[bytes, None] = {}
            for at in range(0, len(batch), CHUNK):
                seen |= dict.fromkeys(map(packed, whole(batch.column(0).slice(at, CHUNK), scale)[1]))
            yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary())], names=["x"])

    return rows.select("v").mapInArrow(run, "x binary").distinct()


def added(parts: DataFrame) -> list:
    """Partial rows (i, data: doubles) of all partitions added up by i, in two steps so that no group takes more than its share."""

    def run(table: pa.Table) -> pa.Table:
        rows = [np.frombuffer(b, np.float64) for b in table["data"].to_pylist()]
        total = np.zeros(max(map(len, rows)))
        for r in rows:
            total[: len(r)] += r
        return pa.table({"i": table["i"].slice(0, 1), "data": pa.array([total.tobytes()], pa.binary())})

    salted = parts.withColumn("s", F.pmod(F.spark_partition_id(), F.lit(SALT)))
    return salted.groupBy("i", "s").applyInArrow(run, "i int, data binary").groupBy("i").applyInArrow(run, "i int, data binary").collect()


def scatter(rows: DataFrame, centred, dims: int) -> np.ndarray:
    """The sum of c c' over centred(x) = c of all rows x: a row of the matrix for each dimension and partition."""

    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                c = centred(batch.column(0).slice(at, CHUNK))
                total += c.T @ c
        yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([np.ascontiguousarray(r).tobytes() for r in total], pa.binary())], names=["i", "data"])

    out = np.zeros((dims, dims))
    for r in added(rows.mapInArrow(run, "i int, data binary")):
        out[r["i"]] = np.frombuffer(r["data"], np.float64)
    return (out + out.T) / 2


def exact_sums(rows: DataFrame) -> tuple[int, list[int]]:
    """The number of vectors and each dimension's sum. Longs are added as high and low halves, which can't overflow."""

    def run(batches):
        n, high, low = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for at in range(0, len(batch), CHUNK):
                part = batch.column(0).slice(at, CHUNK)
                dims = max(map(length, part.to_pylist()), default=0)
                x = unpacked(part, dims)
                n += len(x)
                if dims > len(high):
                    high, low = np.pad(high, (0, dims - len(high))), np.pad(low, (0, dims - len(low)))
                high[:dims] += (x >> 32).sum(axis=0)
                low[:dims] += (x & 0xFFFFFFFF).sum(axis=0)
        i = range(-1, len(high))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array([0, *high.tolist()], pa.int64()), pa.array([n, *low.tolist()], pa.int64())], names=["i", "high", "low"])

    wide = lambda c: F.sum(F.col(c).cast("decimal(28,0)")).alias(c)
    got = {r["i"]: (int(r["high"]) << 32) + int(r["low"]) for r in rows.mapInArrow(run, "i int, high long, low long").groupBy("i").agg(wide("high"), wide("low")).collect()}
    return got.pop(-1, 0), [got[i] for i in range(len(got))]


def whiten(vectors: DataFrame, components: int = 4, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every usable row and component."""
    rows = vectors.select(F.col(vector_col).alias("v"), F.col(id_col).alias("vec_id"))
    fit = materialise(distinct_vectors(rows, scale), "distinct-vectors")
    n, sums = exact_sums(fit)
    sound = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * F.lit(scale)) < float("inf"))
    dims = rows.where(F.col("v").isNotNull() & F.forall("v", sound)).agg(F.max(F.size("v")).alias("d")).first()["d"] or 0
    sums += [0] * (dims - len(sums))
    if dims > MAX_DIMENSIONS:
        raise ValueError(f"{dims} dimensions; the matrix is held on the driver for {MAX_DIMENSIONS} at most")
    exact = [Fraction(s, n) for s in sums] if n else []
    mean = np.asarray([float(m) for m in exact])
    cov = scatter(fit, lambda c: unpacked(c, dims) - mean, dims) / max(n, 1)
    values, basis = jacobi(cov)
    order = np.argsort(-values, kind="stable")[:components]
    values, basis = values[order], basis[:, order]
    trace = float(np.trace(cov))
    known = values > dims * np.finfo(np.float64).eps * trace
    largest = basis[np.abs(basis).argmax(axis=0), np.arange(len(order))] if dims else np.zeros(0)
    weight = (basis * np.where(largest < 0, -1.0, 1.0) / np.sqrt(np.where(known, values, 1.0))).T
    # the doubles' mean differs from the true one by a rounding, whose projection is taken off again
    rest = weight @ np.asarray([float(m - Fraction(d)) for m, d in zip(exact, mean.tolist())]) if dims else np.zeros(0)
    explained = np.where(known, values / trace if trace > 0 else 0.0, 0.0)

    def project(x: np.ndarray) -> np.ndarray:
        c = x - mean
        return np.stack([(c * w).sum(axis=1) - r for w, r in zip(weight, rest)], axis=1) if len(weight) else np.zeros((len(x), 0))

    error = 0.0
    if known.any():
        own = scatter(fit, lambda c: project(unpacked(c, dims))[:, known], int(known.sum())) / n
        error = float(np.abs(own - np.eye(len(own))).max())

    def deviations(x: np.ndarray) -> list[int]:
        """Exact; in longs where these are known to hold, otherwise in Python's integers."""
        top = max(int(np.abs(x.astype(np.float64)).max(initial=0)), 1)
        if (n * top + max(map(abs, sums), default=0)) ** 2 * max(dims, 1) < 1 << 62:
            y = n * x - np.asarray(sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        return [min(MOST, sum((n * v - s) ** 2 for v, s in zip(r, sums))) for r in x.tolist()]

    def run(batches):
        k = len(weight)
        for batch in batches:
            for first in range(0, len(batch), CHUNK):
                part = batch.slice(first, CHUNK)
                at, x = whole(part.column(0), scale)
                if not len(x) or not k:
                    continue
                x = np.pad(x, ((0, 0), (0, dims - x.shape[1]))) if x.shape[1] < dims else x[:, :dims]
                w = project(x)
                m = len(x)
                ids = part.column(1).take(pa.array(np.repeat(at, k)))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()), pa.array(np.full(m * k, n), pa.int64()), pa.array(np.repeat(np.asarray(deviations(x), np.int64), k)),
                     pa.array(w.ravel(), mask=np.tile(~known, m)), pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    kind = rows.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
