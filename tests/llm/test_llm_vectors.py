"""Operators 12 and 13 on tables with every awkward vector, against plain arithmetic on all rows."""

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from sigloom.llm import blockjoin, queries, whitening

NAN, INF = float("nan"), float("inf")


def vectors(seed=0, n=400, dims=7):
    """(vec_id, embedding, label): usable ones, hot copies, ties, and all that is left out."""
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dims)) * np.logspace(0, -2, dims) + 0.3).astype(np.float32).tolist()
    rows = [(i, v, 0) for i, v in enumerate(x)] + [(1000 + i, x[3], 1) for i in range(150)] + [(2000 + i, [0.5] * dims, 1) for i in range(60)]
    rows += [(20, x[5], 0), (40, x[40], 0), (40, x[40], 0), (7, x[7], 2), (-60, x[9], 0), (None, x[8], 0)]
    return rows + [(5000, None, 0), (5001, [NAN] * dims, 0), (5002, [1.0, None] + [0.0] * (dims - 2), 0), (5003, [INF] * dims, 0), (5004, [-INF] + [1.0] * (dims - 1), 0), (5020, [0.25, -1.0], 0), (5040, [0.0] * dims, 0), (5041, [], 0), (5060, [1e-30] * dims, 0)]


def frame(spark, rows, kind="float"):
    return spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int").repartition(5)


def usable(rows):
    return [(i, v) for i, v, _ in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]


def brute_nearest(rows, k, every):
    """For every query id its k first of all pairs with rows of other ids."""
    keep = [(i, v) for i, v in usable(rows) if i is not None and any(v)]
    out = []
    for q in sorted({i for i, _ in keep if i % every == 0}):
        pairs = [(-dot(v, w) + 0.0, j) for i, v in keep if i == q for j, w in keep if j != q]
        out += [(q, r, j, -s + 0.0) for r, (s, j) in enumerate(sorted(pairs)[:k], 1)]
    return out


def dot(v, w):
    total = 0.0
    for a, b in zip(v, w):
        total += a * b
    return total


def as_floats(rows):
    return [(i, v if v is None else [c if c is None else float(np.float32(c)) for c in v], x) for i, v, x in rows]


@pytest.mark.parametrize("tile, k, groups", [((1024, 2048), 20, 8192), ((3, 17), 5, 9), ((8, 64), 200, 4)])
def test_nearest_equals_all_pairs(spark, monkeypatch, tile, k, groups):
    monkeypatch.setattr(blockjoin, "TILE", tile)
    monkeypatch.setattr(blockjoin, "QUERY_GROUP", groups)
    monkeypatch.setattr(blockjoin, "LEAST", 50)
    rows = as_floats(vectors())
    got = sorted(tuple(r) for r in blockjoin.nearest(frame(spark, rows), k, 20).collect())
    assert got == brute_nearest(rows, k, 20)


def test_nearest_of_few_of_none_and_of_far_away(spark):
    assert blockjoin.nearest(frame(spark, [])).count() == 0
    assert blockjoin.nearest(frame(spark, [(20, [1.0], 0)])).count() == 0
    rows = [(0, [1.0, 2.0], 0), (1, [-1.0], 0), (20, [3.0], 0)]
    assert sorted(tuple(r) for r in blockjoin.nearest(frame(spark, rows)).collect()) == [(0, 1, 20, 3.0), (0, 2, 1, -1.0), (20, 1, 0, 3.0), (20, 2, 1, -3.0)]
    large = [(0, [1e200, 1.0], 0), (1, [1e200, 0.0], 0), (2, [-1e200, 0.0], 0), (3, [1e-320, 5.0], 0)]
    assert [tuple(r)[1:] for r in blockjoin.nearest(frame(spark, large, "double")).orderBy("rank").collect()] == [(1, 1, INF), (2, 3, 1e-120 + 5.0), (3, 2, -INF)]


def test_codes_bound_every_product():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(200, 33)) * 10.0 ** rng.integers(-5, 6, (200, 1)), np.eye(33), np.full((1, 33), 1e-100)])
    c = blockjoin.Coded(np.arange(len(x)), x)
    low, high = blockjoin.bounds(c, slice(None), c, slice(None))
    true = np.asarray([[math.fsum(a * b for a, b in zip(v, w)) for w in x.tolist()] for v in x.tolist()])
    assert c.codes.dtype == np.int8 and (low <= true).all() and (true <= high).all()
    assert np.median(((high - low) / (c.near[:, None] * c.near))[:200, :200]) < 0.05


def test_rows_of_equal_vectors_that_can_rank():
    x = np.ones((40, 3))
    x[30:] = 2
    ids = np.r_[np.full(10, 5), np.arange(20), np.full(10, 7)]
    kept = blockjoin.in_ranking(ids, x, 3)
    assert sorted(ids[kept[kept < 30]].tolist()) == [0, 1, 2, 3] and np.count_nonzero(kept >= 30) == 3


def brute_whitening(rows, dims, components=4):
    """n, deviations by row, and the covariance's eigenvalues and -vectors, from exact sums."""
    x = [(i, [math.floor(256 * c) for c in v] + [0] * (dims - len(v))) for i, v in usable(rows)]
    fit = sorted({tuple(v) for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.asarray([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in fit])
    values, basis = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    return x, n, sums, values[order], basis[:, order], values.sum()


def check_whitening(got, rows, dims, components=4):
    x, n, sums, values, basis, trace = brute_whitening(rows, dims, components)
    k = min(components, dims)
    assert len(got) == len(x) * k and {r["n"] for r in got} == {n}
    want = sorted((i is None, i or 0, c + 1, sum((n * a - s) ** 2 for a, s in zip(v, sums))) for i, v in x for c in range(k))
    assert sorted((r["vec_id"] is None, r["vec_id"] or 0, r["component"], r["deviation"]) for r in got) == want
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9
    for r in got:
        assert abs(r["explained"] * trace / values[r["component"] - 1] - 1) < 1e-9
    mine = {(r["vec_id"], r["component"], r["deviation"]): r["whitened"] for r in got}
    for c in range(k):
        plain = [((i, c + 1, sum((n * a - s) ** 2 for a, s in zip(v, sums))), sum((a - s / n) * b for a, s, b in zip(v, sums, basis[:, c])) / math.sqrt(values[c])) for i, v in x]
        sign = np.sign(sum(mine[key] * w for key, w in plain))
        assert max(abs(mine[key] - sign * w) for key, w in plain) < 1e-7


def test_whitening_equals_plain_arithmetic(spark):
    rows = as_floats(vectors())
    check_whitening(whitening.whiten(frame(spark, rows)).collect(), rows, 7)


def test_whitening_query_on_a_given_table(spark, small):
    rows = [(r["vec_id"], r["embedding"], 0) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    check_whitening(queries.op12_jacobi_whitening(spark, small).collect(), rows, 64)


def test_whitening_of_few_dimensions_and_subspaces(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None, 0), (2, [NAN], 0)])).count() == 0
    one = whitening.whiten(frame(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).collect()
    assert len(one) == 4 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, None, 0.0, 0.0) for r in one)
    line = whitening.whiten(frame(spark, [(i, [i / 4, i / 2, 0.0], 0) for i in range(9)])).collect()
    assert {(r["component"], r["whitened"] is None) for r in line} == {(1, False), (2, True), (3, True)}
    assert abs(next(r["explained"] for r in line if r["component"] == 1) - 1) < 1e-12
    far = whitening.whiten(frame(spark, [(1, [1e300], 0), (2, [-1e300], 0), (3, [0.0], 0), (4, [1e308], 0)], "double")).collect()
    assert {r["vec_id"]: r["deviation"] for r in far}[1] == (1 << 63) - 1 and 4 not in {r["vec_id"] for r in far}


@pytest.mark.parametrize("n", [1, 2, 3, 8, 17, 64])
def test_jacobi_is_accurate_in_small_eigenvalues(n):
    """A badly scaled matrix D B D: every eigenvalue has its digits, also those far below the largest."""
    rng = np.random.default_rng(n)
    values, basis = whitening.jacobi((b := rng.normal(size=(n, n + 3))) @ b.T)
    assert np.allclose(basis @ np.diag(values) @ basis.T, b @ b.T, atol=1e-9) and np.allclose(basis.T @ basis, np.eye(n), atol=1e-12)
    d = np.logspace(0, -9, n)
    near = 0.1 * np.ones((n, n)) + 0.9 * np.eye(n)
    values, _ = whitening.jacobi(d[:, None] * near * d)
    # the least eigenvalue, from the inverse, whose greatest one is well determined
    inverse = (1 / d)[:, None] * np.linalg.inv(near) * (1 / d)
    assert abs(values.min() * np.linalg.eigvalsh(inverse).max() - 1) < 1e-6


def test_packed_vectors_are_equal_as_bytes_only():
    rows = [[0, 0], [], [1, -128], [1, -128, 0], [1, 128], [1, -129], [40_000, 0, 1], [-(1 << 63), (1 << 63) - 1]]
    data = [whitening.packed(np.asarray(r, np.int64)) for r in rows]
    assert [len(d) for d in data] == [1, 1, 3, 3, 5, 5, 13, 17] and len(set(data)) == 6
    assert [whitening.unpacked(pa.array([d], pa.binary()), 3)[0].tolist() for d in data] == [(r + [0, 0, 0])[:3] for r in rows]
