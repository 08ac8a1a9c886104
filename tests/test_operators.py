"""Golden arrays and properties of the signal operators."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sigloom.functions import labels, scale, timeaxis
from sigloom.functions.red import crc32_koopman
from sigloom.operators import export, joins, sequence, signal, store
from sigloom.streaming import ingest


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def samples(spark, channel, times, values):
    return frame(spark, [(channel, int(t), float(v)) for t, v in zip(times, values)], "channel_id string, t_us long, value double")


def rates(spark, **by):
    return frame(spark, list(by.items()), "channel_id string, rate double")


def test_range_round_trip(spark):
    s = samples(spark, "x", [5000, 5100, 5200, 5300, 5400, 5500, 6000, 6100, 6200], [0, 1, 2, 3, 4, 5, 9, 8, 9])
    r = store.to_ranges(s, rates(spark, x=10000.0))
    assert sorted((q["lo"], q["hi"]) for q in r.collect()) == [(5000, 5501), (6000, 6201)]
    back = store.read_channel(r, "x").collect()
    assert [(b["t"], b["value"]) for b in back] == [(5000.0, 0), (5100.0, 1), (5200.0, 2), (5300.0, 3), (5400.0, 4), (5500.0, 5), (6000.0, 9), (6100.0, 8), (6200.0, 9)]
    assert [b["t"] for b in store.read_channel(r, "x", 5400, 6001).collect()] == [5400.0, 5500.0, 6000.0]


def test_gaps_and_retimed_samples(spark):
    t = np.r_[np.linspace(0, 90, 10), np.linspace(150, 240, 10), np.linspace(300, 390, 10), 421, 430, 440]
    r = store.to_ranges(samples(spark, "g", t, np.arange(33) * 33.0), rates(spark, g=100000.0))
    (c,) = store.counts(r).collect()
    assert (c["n_samples"], c["n_gaps"]) == (33, 3)
    assert [b["t"] for b in store.read_channel(r, "g").collect()][-3:] == [421.0, 431.0, 441.0]


def test_batches_and_buckets_do_not_change_segments(spark):
    rng = np.random.default_rng(1)
    t = np.cumsum(rng.choice([1000, 1001, 999, 9000], 3000, p=[0.5, 0.24, 0.25, 0.01]))
    s = samples(spark, "a", t, range(3000)).unionByName(samples(spark, "b", t[:7], range(7)))
    seg = lambda width: sorted(tuple(r) for r in sequence.segments(s, F.lit(2000), bucket_us=width).collect())
    whole = seg(10**12)
    assert whole == seg(5000) == seg(777) and sum(r[4] for r in whole) == 3007
    r = store.to_ranges(s, rates(spark, a=1000.0, b=1000.0), size=100, bucket_us=5000)
    assert r.agg(F.max(F.size("values"))).first()[0] == 100 and [x["value"] for x in store.read_channel(r, "a").collect()] == list(range(3000))


def test_append_skips_or_fails(spark):
    old = frame(spark, [("a", 0, 100), ("b", 0, 100)], "channel_id string, lo long, hi long")
    new = frame(spark, [("a", 50, 150), ("a", 100, 200), ("c", 0, 100), ("b", -10, 1)], "channel_id string, lo long, hi long")
    assert sorted((r["channel_id"], r["lo"]) for r in store.append(old, new).collect()) == [("a", 100), ("c", 0)]
    with pytest.raises(Exception, match="overlaps"):
        store.append(old, new, skip=False).collect()
    assert store.append(new, new).count() == 0


@given(st.lists(st.tuples(st.integers(0, 500), st.integers(1, 300)), min_size=1, max_size=12), st.lists(st.tuples(st.integers(0, 500), st.integers(1, 300)), min_size=1, max_size=12), st.sampled_from([1, 7, 64, 10_000]))
@settings(max_examples=8, deadline=None)
def test_overlap_join_equals_nested_loops(spark, a, b, bucket):
    rows = lambda x: [("k", lo, lo + n) for lo, n in x]
    d = [frame(spark, rows(x), "k string, lo long, hi long") for x in (a, b)]
    got = sorted((r["lo"], r["hi"], r["b_lo"], r["b_hi"]) for r in joins.overlapping(*d, "k", bucket=bucket).collect())
    assert got == sorted((l, h, m, i) for _, l, h in rows(a) for _, m, i in rows(b) if l < i and m < h)


def test_spike_ranges(spark):
    rows = [("u", 100 * i, i % 3, [float(i), -float(i)]) for i in range(25)]
    s = frame(spark, rows, "channel_id string, t_us long, unit short, waveform array<double>")
    u = store.to_unit_ranges(s, 10)
    assert sorted((r["lo"], r["hi"], r["count"]) for r in u.collect()) == [(0, 901, 10), (1000, 1901, 10), (2000, 2401, 5)]
    assert sorted(tuple(r) for r in store.expand_units(u).collect()) == sorted(rows)


def test_export(spark, tmp_path):
    r = frame(spark, [("1", 10000.0, 5000, 5501, [0.0, 1.0, 2.0, 3.0, 4.0, 5.0]), ("2", 5000.0, 5500, 5901, [6.0, 6.0, 6.0])], "channel_id string, rate double, lo long, hi long, values array<double>")
    c = frame(spark, [("1", "Channel 1", "uV", 5000, 5500), ("2", "Channel 2", "V", 5500, 5900)], "channel_id string, name string, unit string, start long, `end` long")
    out = sorted((x["name"], round(x["seconds"], 9), x["value"]) for x in export.acquisitions(r, c).collect())
    assert out == [("Channel 1", i / 10000, float(i)) for i in range(6)] + [("Channel 2", t, 6.0) for t in (0.0005, 0.0007, 0.0009)]
    export.write_export(r, c, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 9
    store.write(r.withColumn("location", F.lit("x")), str(tmp_path / "store"))
    plan = spark.read.parquet(str(tmp_path / "store")).where("channel_id = '1' and hi > 5100")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(channel_id" in plan and "PushedFilters: [IsNotNull(hi), GreaterThan(hi,5100)]" in plan


def test_streaming_append_is_idempotent(spark, tmp_path):
    s = samples(spark, "x", [0, 100, 200, 900, 1000], [1, 2, 3, 4, 5])
    s.write.parquet(str(tmp_path / "in"))
    for k in range(2):
        stream = spark.readStream.schema(s.schema).parquet(str(tmp_path / "in"))
        ingest.append_batches(spark, stream, rates(spark, x=10000.0), str(tmp_path / "store"), str(tmp_path / f"cp{k}")).awaitTermination()
    r = spark.read.parquet(str(tmp_path / "store"))
    assert sorted((q["lo"], len(q["values"])) for q in r.collect()) == [(0, 3), (900, 2)]


def test_functions(spark):
    one = spark.range(1)
    f = lambda c: one.select(c.alias("x")).first()["x"]
    L = F.lit
    assert f(scale.twos_complement(L(65535), 16)) == -1 and f(scale.sign_extend_24(L(0x7FFFFF))) == 0x7FFFFF and f(scale.sign_extend_24(L(0x800000))) == -(1 << 23)
    assert f(scale.sign_extend_24(L(0x010000), True)) == 0x010000 - (1 << 24)
    assert f(scale.spike_volts(L(32768 + 7000), L(2.0))) == 3.5 and f(scale.spike_volts(L(32768 - 7000), L(2.0), True)) == 65533
    assert f(scale.conversion(L(-10.0), L(10.0), L(-5.0), L(5.0))) == 0.5
    with pytest.raises(Exception, match="symmetric"):
        f(scale.conversion(L(-10.0), L(10.0), L(-4.0), L(5.0)))
    assert f(labels.guid(L("CBCC71A25D519045B6A1DC170C8D6EE2"))) == "{A271CCCB-515D-4590-B6A1-DC170C8D6EE2}"
    assert [f(labels.default_label(L(n))) for n in (1, 128, 129)] == ["chan1", "chan128", "ainp1"]
    assert [f(labels.unit_class(L(n))) for n in (0, 16, 255)] == ["unclassified", "16", "noise"]
    with pytest.raises(Exception, match="no such unit"):
        f(labels.unit_class(L(17)))
    assert f(labels.clean(L(" ab\0\0"))) == "ab" and f(labels.sample_format(L(0x85))) == 3 and f(labels.is_composite(L(0x85)))
    assert f(labels.xml_text(L("<a><Units>uV</Units></a>"), "a/Units")) == "uV"
    assert [f(timeaxis.two_digit_year(L(y))) for y in (84, 85, 99, 0)] == [2084, 1985, 1999, 2000]
    assert f(timeaxis.ole_to_micros(L(25569.0))) == 0 and f(timeaxis.span_from_increment(L(5), L(0.25))) == 1_000_000
    assert f(timeaxis.remove_offset(L(-5), L(10))) == 15 and f(timeaxis.apply_offset(L(15), L(10))) == -5
    assert f(timeaxis.range_end(L(5000), L(6), L(10000.0))) == 5501 and f(timeaxis.range_count(L(5000), L(5501), L(10000.0))) == 6
    drift = f(timeaxis.time_at(L(946684800000000), L(1), L(499.906982421875), True)) - 946684800000000
    assert drift == 2000.375
    assert f(labels.file_kind(L("a.events"), L(""))) == "skip" and f(labels.upload_key(L(None).cast("string"), L(None).cast("string"), L("j"), L("f"))) == "j/exports/j/f"
    assert crc32_koopman(b"") == 0xFFFFFFFF and crc32_koopman(b"abc") != crc32_koopman(b"abd")


def test_lookup_joins(spark):
    b = frame(spark, [("k", 0, 0, 10), ("k", 100, 10, 5)], "k string, t long, first long, n long")
    p = frame(spark, [("k", -1), ("k", 0), ("k", 99), ("k", 100), ("k", 500)], "k string, at long")
    got = {r["at"]: r["block_first"] for r in joins.last_at_or_before(p, b, "at", "t", ["first"], "k").collect()}
    assert got == {-1: None, 0: 0, 99: 0, 100: 10, 500: 10}
    m = joins.match_intervals(frame(spark, [("s", 1, 100.0), ("s", 2, 101.5), ("s", 3, 103.9), ("s", 4, 99.0)], "s string, i int, v double"), "v", "i", "s")
    assert [r["matched"] for r in m.orderBy("i").collect()] == [100.0, 100.0, 103.9, 100.0]
    again = [("s", 1, 100.0), ("s", 2, None), ("s", 3, 0.0), ("s", 4, 101.0), ("s", 5, 100.0), ("s", 6, 0.0), ("s", 7, 102.5), ("s", 8, 101.0), ("t", 1, 101.0), (None, 1, 7.0), (None, 2, 7.1)]
    m = joins.match_intervals(frame(spark, again, "s string, i int, v double"), "v", "i", "s")
    assert sorted((str(r["s"]), r["i"], r["matched"]) for r in m.collect()) == [("None", 1, 7.0), ("None", 2, 7.0), ("s", 1, 100.0), ("s", 2, None), ("s", 3, 0.0), ("s", 4, 100.0), ("s", 5, 100.0), ("s", 6, 0.0), ("s", 7, 102.5), ("s", 8, 100.0), ("t", 1, 101.0)]
    known = frame(spark, [("a",)], "channel string")
    asked = frame(spark, [("a",), ("z",)], "channel string")
    assert [r[0] for r in joins.unknown_channels(asked, known).collect()] == ["z"]
    with pytest.raises(Exception, match="no such channel"):
        joins.require_known(asked, known).collect()


def test_islands_and_rates(spark):
    v = [1, 2, None, None, 3, None, 4, 5]
    s = frame(spark, [("c", i, None if x is None else float(x)) for i, x in enumerate(v)], "channel_id string, t_us long, value double")
    assert sorted((r["lo"], r["hi"], r["n"]) for r in sequence.islands(s, F.col("value").isNotNull(), bucket_us=3).collect()) == [(0, 1, 2), (4, 4, 1), (6, 7, 2)]
    r = sequence.infer_rate(samples(spark, "a", np.arange(50) * 8108, np.zeros(50))).first()["rate"]
    assert abs(r - 123.335) < 0.001
    one = spark.range(1)
    assert one.select(sequence.check_rate(F.lit(101.0), F.lit(100.0))).first()[0] == 100.0
    with pytest.raises(Exception, match="sampling rate"):
        one.select(sequence.check_rate(F.lit(103.0), F.lit(100.0))).collect()


def test_filters(spark):
    t = np.arange(2000) / 500
    for kind, cut, keep, drop in (("lowpass", (30.0,), 5, 120), ("highpass", (60.0,), 120, 5), ("bandpass", (30.0, 60.0), 42, 150), ("bandstop", (30.0, 60.0), 150, 42)):
        b, a = signal.butterworth(3, cut, 500.0, kind)
        y = lambda f: np.std(signal.filtfilt(b, a, np.sin(2 * np.pi * f * t))[300:-300])
        assert y(keep) > 0.69 and y(drop) < 0.05, kind
    b, a = signal.butterworth(1, (100.0,), 1000.0)
    k = math.tan(math.pi * 0.1)
    assert np.allclose(b, [k / (1 + k)] * 2) and np.allclose(a, [1, (k - 1) / (1 + k)])
    rows = [("c", i, 10 + (3.0 if i % 5 == 0 else 0.0)) for i in range(100)]
    out = signal.remove_line_noise(frame(spark, rows, "channel_id string, i long, value double"), 5, "i", "value", "channel_id")
    assert out.agg(F.stddev_pop("cleaned")).first()[0] < 1e-9


def test_blobs_round_trip(spark, tmp_path):
    from sigloom.operators import wire

    s = samples(spark, "x", [0, 100, 200, 900, 1000], [1, 2.5, -3, 4, 5])
    r = store.to_ranges(s, rates(spark, x=10000.0))
    back = wire.from_blobs(wire.to_blobs(r))
    assert sorted((q["lo"], q["values"]) for q in back.collect()) == [(0, [1.0, 2.5, -3.0]), (900, [4.0, 5.0])]
    index = wire.write_blob_files(r, str(tmp_path / "blobs"))
    rows = index.collect()
    assert sorted(q["location"] for q in rows) == ["x_0_201.bfts.gz", "x_900_1001.bfts.gz"]
    again = wire.read_blob_files(spark, str(tmp_path / "blobs"), spark.createDataFrame(rows, index.schema))
    assert sorted((q["lo"], q["values"]) for q in again.collect()) == [(0, [1.0, 2.5, -3.0]), (900, [4.0, 5.0])]
    t, u, w = wire.read_spike_blobs(*wire.spike_blobs(np.asarray([5, 7]), np.asarray([1, 2]), np.ones((2, 3))))
    assert t.tolist() == [5, 7] and u.tolist() == [1, 2] and w.shape == (2, 3)
    assert wire.rename_channel(r, "x", "y").select("channel_id").distinct().first()[0] == "y"
