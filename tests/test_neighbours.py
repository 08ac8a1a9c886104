"""Windows over neighbours and block tables in stretches, against plain lists."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sigloom.operators import blocks, sequence, signal

ROWS = [(c, int(t), i, float((7 * i) % 31)) for c, n in (("a", 60), ("b", 1), ("c", 9), (None, 14)) for i, t in enumerate(np.sort(np.random.default_rng(n).integers(0, 300, n)))]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "channel string, t long, i long, v double").repartition(3)


def by_channel():
    return [[r for r in ROWS if r[0] == c] for c in ("a", "b", "c", None)]


@pytest.mark.parametrize("bucket, halo_rows", [(1, 1), (17, 4), (1000, 10), (1000, 1000)])
def test_running_quantile_in_stretches(rows, bucket, halo_rows):
    for span, half in ((3, 1), (4, 2), (15, 7)):
        got = {(r["channel"], r["i"]): r["q"] for r in signal.running_quantile(rows, "v", ["t", "i"], "channel", span=span, bucket=bucket, halo_rows=halo_rows).collect()}
        want = {(g[k][0], g[k][2]): float(np.quantile([r[3] for r in g[max(0, k - half) : k + half + 1]], 0.5)) for g in by_channel() for k in range(len(g))}
        assert got == pytest.approx(want)


@pytest.mark.parametrize("bucket, halo_rows", [(1, 1), (50, 3), (1000, 1000)])
def test_next_and_clamp_in_stretches(rows, bucket, halo_rows):
    ends = rows.withColumn("e", F.col("t") + 5)
    got = {(r["channel"], r["i"]): r["clamped_end"] for r in sequence.clamp_to_next(ends, "t", "e", "channel", tie="i", bucket=bucket, halo_rows=halo_rows).collect()}
    assert got == {(x[0], x[2]): min(x[1] + 5, y[1]) if y else x[1] + 5 for g in by_channel() for x, y in zip(g, [*g[1:], None])}
    assert sequence.clamp_to_next(ends.limit(0), "t", "e", "channel").count() == 0
    places = {(r["channel"], r["i"]): r["_pos"] for r in sequence.numbered(rows, ["t", "i"], "channel", bucket=bucket).collect()}
    assert places == {(r[0], r[2]): k for g in by_channel() for k, r in enumerate(g)}


def test_no_task_orders_a_whole_channel(rows):
    plan = signal.running_quantile(rows, "v", ["t", "i"], "channel", span=3)._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.splitlines() if "Window [" in x]
    assert windows and all("_stretch" in x or "_b" in x for x in windows)


def test_blocks_fitted_and_chunked(spark):
    """Ten samples a second; blocks that meet, overlap by 2 samples, leave gaps, and are alone."""
    starts = {"x": [0, 1_000_000, 1_800_000, 2_800_001, 9_000_000], "y": [5]}
    table = [(c, 10.0, k, t, 10, k in ({0, 3, 4} if c == "x" else {0})) for c, ts in starts.items() for k, t in enumerate(ts)]
    d = spark.createDataFrame(table, "channel string, rate double, block long, t_us long, n long, discontinuous boolean")
    got = [(r["channel"], r["block"], r["follows"], r["end_us"], r["change"]) for r in blocks.fitted(d, "rate", "channel", bucket=2, halo_rows=2).orderBy("channel", "block").collect()]
    assert got == [("x", 0, "next", 1_000_000, 0), ("x", 1, "overlap", 1_800_000, -2), ("x", 2, "gap", 2_800_000, 0), ("x", 3, "gap", 3_800_001, 0), ("x", 4, "last", 10_000_000, 0), ("y", 0, "last", 1_000_005, 0)]
    chunks = blocks.chunk_table(d, "channel", cycle=2)
    assert sorted(tuple(r) for r in chunks.collect()) == [("x", 1, 0, 2, 20), ("x", 2, 1_800_000, 1, 10), ("x", 3, 2_800_001, 1, 10), ("x", 4, 9_000_000, 1, 10), ("y", 1, 5, 1, 10)]
    assert sorted((r["chunk"], r["block"]) for r in blocks.block_times(chunks, d, "channel").where("channel = 'x'").collect()) == [(1, 0), (2, 2), (3, 3), (4, 4)]
