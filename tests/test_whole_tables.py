"""Queries on made tables that earlier cuts of the input would have shortened."""

import numpy as np
from datetime import datetime, timedelta, timezone

import pytest

from sigloom.plans import catalogue

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def put(spark, tmp_path):
    """Writes a table and gives the folder."""

    def write(name, rows, ddl):
        spark.createDataFrame(rows, ddl).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def events(put, channels):
    """channels: name to minutes after START."""
    rows = [(c, START + timedelta(minutes=m), 1.0) for c, ms in channels.items() for m in ms]
    return put("events", [(i, *r) for i, r in enumerate(rows)], "event_id long, event_type string, ts timestamp, value double")


def test_interval_overlap_takes_all_segments(spark, put):
    starts = {c: [125 * i + 7 * k for i in range(60)] for k, c in enumerate("abc")}
    folder = events(put, {c: [m + d for m in ms for d in (0, 10)] for c, ms in starts.items()})
    got = [(r["channel_id"], r["seg"], r["other"]) for r in catalogue.interval_overlap(spark, folder).collect()]
    pairs = [(a, i + 1, j + 1) for a in "abc" for b in "abc" if a < b for i, x in enumerate(starts[a]) for j, y in enumerate(starts[b]) if x <= y + 10 and y <= x + 10]
    assert sorted(got) == sorted(pairs) and max(g[1] for g in got) == 60


def test_range_expand_takes_all_positions(spark, put):
    folder = events(put, {"a": [*range(120), 400], "b": [0, 1]})
    lo = int(START.timestamp()) * 1_000_000
    want = [("a", 1, i, lo + i * 250000.0) for i in range(120)] + [("a", 2, 0, lo + 400 * 60e6), ("b", 1, 0, float(lo)), ("b", 1, 1, lo + 250000.0)]
    assert sorted(tuple(r) for r in catalogue.range_expand(spark, folder).collect()) == want


def test_file_names_takes_all_orders(spark, put):
    folder = put("orders", [(7, 1), (999_999, 2), (1_000_000, 3), (23_456_789, 4)], "o_orderkey long, o_custkey long")
    want = [(7, 7, 7, 1, "raw"), (999_999, 999_999, 999_999, 0, "raw"), (1_000_000, 0, 1_000_000, 1, "raw"), (23_456_789, 456_789, 23_456_789, 0, "raw")]
    assert sorted(tuple(r) for r in catalogue.file_names(spark, folder).collect()) == want


def test_waveform_reshape_takes_all_components(spark, put):
    folder = put("embeddings", [(1, [float(i) for i in range(70)]), (2, [1.0]), (3, []), (4, None)], "vec_id long, embedding array<float>")
    want = [(1, p, [float(i) for i in range(16 * p, min(70, 16 * p + 16))]) for p in range(5)] + [(2, 0, [1.0])]
    assert sorted(tuple(r) for r in catalogue.waveform_reshape(spark, folder).collect()) == want


def test_lfilter_equals_the_recurrence():
    """Sample by sample, for lengths around those of a block, with a state and without."""
    from sigloom.operators import signal

    rng = np.random.default_rng(5)
    for order, kind, cut in ((2, "lowpass", (10.0,)), (3, "bandpass", (5.0, 20.0)), (1, "highpass", (3.0,))):
        b, a = signal.butterworth(order, cut, 100.0, kind)
        for n in (0, 1, 127, 128, 129, 1000):
            x, z = rng.normal(size=n), rng.normal(size=len(a) - 1)
            state, want = np.append(z, 0.0), []
            for v in x:
                y = b[0] * v + state[0]
                state[:-1] = b[1:] * v + state[1:] - a[1:] * y
                want.append(y)
            assert np.allclose(signal.lfilter(b, a, x, z), want, atol=1e-10)


def recurrence(b, a, x):
    """Zero-phase filtering sample by sample, with the initial state solved for a constant."""
    n = len(a) - 1
    pad = min(3 * n, len(x) - 1)
    if pad <= 0:
        return list(x)
    companion = np.array([[-a[i + 1] if j == 0 else float(j == i + 1) for j in range(n)] for i in range(n)])
    settled = np.linalg.solve(np.eye(n) - companion, b[1:] - a[1:] * b[0])

    def once(values):
        state, out = np.append(settled * values[0], 0.0), []
        for v in values:
            y = b[0] * v + state[0]
            state[:-1] = b[1:] * v + state[1:] - a[1:] * y
            out.append(y)
        return out

    wide = [2 * x[0] - v for v in x[pad:0:-1]] + list(x) + [2 * x[-1] - v for v in x[-2 : -pad - 2 : -1]]
    return once(once(wide)[::-1])[::-1][pad : pad + len(x)]


@pytest.mark.parametrize("order, kind, cut", [(2, "lowpass", (10.0,)), (4, "lowpass", (30.0,)), (2, "bandpass", (5.0, 20.0)), (3, "highpass", (3.0,)), (2, "bandstop", (35.0, 45.0))])
@pytest.mark.parametrize("bucket_rows", [1, 7, 64, 5000])
def test_filter_in_buckets_equals_the_whole_stretch(spark, order, kind, cut, bucket_rows):
    """Buckets shorter than the reflected ends, of one sample, longer than the stretch; stretches of 1 to 900 samples, one with equal times."""
    from sigloom.operators import signal

    rng = np.random.default_rng(bucket_rows)
    stretches = {("a", 1): 900, ("a", 2): 1, ("b", 1): 2, ("b", 2): 5, (None, 7): 40, ("d", 1): 129} if bucket_rows != 1 else {("a", 1): 60, ("b", 1): 1, ("c", 2): 9}
    rows = [(c, s, 1_000_000_000 + 10_000 * i // (1 + (c == "d")), i, float(rng.normal() * 50 + i / 9)) for (c, s), n in stretches.items() for i in range(n)]
    d = spark.createDataFrame(rows, "channel_id string, seg long, t_us long, i long, value double").repartition(3)
    got = signal.filter_segments(d, order, cut, 100.0, kind, "channel_id", "seg", tie="i", bucket_rows=bucket_rows).toPandas()
    assert len(got) == len(rows)
    b, a = signal.butterworth(order, cut, 100.0, kind)
    for (c, s), n in stretches.items():
        g = got[(got["channel_id"].isna() if c is None else got["channel_id"] == c) & (got["seg"] == s)].sort_values("i")
        want = np.asarray(recurrence(b, a, [r[4] for r in rows if r[:2] == (c, s)]))
        assert len(g) == n and np.abs(g["filtered"].to_numpy() - want).max() <= 1e-9 * max(1, np.abs(want).max())
        assert np.allclose(signal.filtfilt(b, a, g["value"].to_numpy()), want, atol=1e-9)


def test_filter_of_no_rows_and_of_missing_values(spark):
    from sigloom.operators import signal

    rows = [("a", 0, t, None if t == 3 else 1.0) for t in range(6)] + [("b", 0, t, 2.0) for t in range(6)]
    d = spark.createDataFrame(rows, "channel_id string, seg long, t_us long, value double")
    out = signal.filter_segments(d, 1, (10.0,), 100.0, "lowpass", "channel_id", "seg", bucket_rows=2).collect()
    assert all((r["filtered"] != r["filtered"]) if r["channel_id"] == "a" else abs(r["filtered"] - 2) < 1e-12 for r in out) and len(out) == 12
    assert signal.filter_segments(d.limit(0), 1, (10.0,), 100.0, "lowpass", "channel_id", "seg").count() == 0


def test_segments_count_equal_times_once(spark):
    """Samples of one time that begins a segment belong to that segment, whatever their order."""
    from pyspark.sql import functions as F

    from sigloom.operators import sequence

    rows = [("c", t, float(i)) for i, t in enumerate([0, 0, 10, 10, 500, 500, 500, 505])]
    d = spark.createDataFrame(rows, "channel_id string, t_us long, value double")
    got = sequence.segments(d, F.lit(20)).orderBy("seg").collect()
    assert [(r["seg"], r["lo"], r["hi"], r["n"]) for r in got] == [(1, 0, 11, 4), (2, 500, 506, 4)]


def test_mef3_windows_and_filling(spark, tmp_path):
    from sigloom import sources
    from sigloom.sources import mef

    sources.register(spark)
    r = spark.createDataFrame([("c", 10.0, 1_000_000, [1.0, 2.0]), ("c", 10.0, 1_500_000, [3.0]), ("c", 10.0, 1_600_000, [4.0])], "channel_id string, rate double, lo long, values array<double>")
    mef.write_mef3(r, str(tmp_path / "s.mefd"), per_segment=2).collect()
    load = lambda **o: [(x["t_us"] // 1000, x["value"]) for x in spark.read.format("mef3").options(**o).load(str(tmp_path / "s.mefd")).orderBy("t_us").collect()]
    bare = lambda rows: [(t, None if v != v else v) for t, v in rows]
    assert load() == [(1000, 1.0), (1100, 2.0), (1500, 3.0), (1600, 4.0)]
    assert bare(load(fill="true")) == [(1000, 1.0), (1100, 2.0), (1200, None), (1300, None), (1400, None), (1500, 3.0), (1600, 4.0)]
    assert bare(load(fill="true", start="1250000", end="1550000")) == [(1300, None), (1400, None), (1500, 3.0)]
    assert load(first_sample="1", end_sample="3") == [(1100, 2.0), (1500, 3.0)]
    assert load(first_sample="3") == [(1600, 4.0)] and load(first_sample="9") == []
