"""Readers against files written here from the formats' layouts."""

import hashlib
import struct

import numpy as np
import pyarrow as pa
import pyarrow.feather
import pytest

from sigloom import sources
from sigloom.functions import crypto, red
from sigloom.sources import blackrock, edf, mef, moberg, nex, nicolet, openephys, persyst, plain, spike2


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    sources.register(spark)


def load(spark, name, path, **options):
    return spark.read.format(name).options(**options).load(str(path))


def series(df, channel):
    rows = df.where(df.channel == channel).orderBy("t_us").collect()
    return [r["t_us"] for r in rows], [r["value"] for r in rows], (rows[0]["unit"], rows[0]["rate"])


def test_csv_series(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text("timestamp, channel-1, channel-2\n3000, 3, 3.5\n1000, 1, \n2000, 2, 2.5\n4000, NaN, 4.5\n")
    d = plain.read_csv_series(spark, str(p))
    assert series(d, "channel-1") == ([1000, 2000, 3000], [1, 2, 3], ("uV", 1000.0))
    assert series(d, "channel-2")[1] == [3.5 - 1, 3.5, 4.5]
    p.write_text("t,x\n2020-01-01 00:00:00.001,1\n2020-01-01 00:00:00.003,2\n")
    assert series(plain.read_csv_series(spark, str(p)), "x")[2] == ("uV", 500.0)


def test_feather(spark, tmp_path):
    pa.feather.write_feather(pa.table({"index": [0, 5000, 10000], "a": [1.0, float("nan"), 3.0], "b": [4, 5, 6]}), str(tmp_path / "x.feather"))
    d = load(spark, "feather_series", tmp_path / "x.feather")
    assert series(d, "a") == ([0, 10000], [1, 3], ("uV", 200.0)) and series(d, "b")[1] == [4, 5, 6]
    pa.feather.write_feather(pa.table({"a": [1.0]}), str(tmp_path / "y.feather"))
    with pytest.raises(Exception, match="no column named index"):
        load(spark, "feather_series", tmp_path / "y.feather").count()


def test_interleaved(spark, tmp_path):
    t = np.r_[np.linspace(0, 90, 10), np.linspace(150, 240, 10), np.linspace(300, 390, 10), 421, 430, 440]
    np.stack([t, np.arange(33) * 33.0], axis=1).tofile(tmp_path / "c.ts.bin")
    d = load(spark, "interleaved_samples", tmp_path / "c.ts.bin", rate="100000")
    assert series(d, "c") == (t.astype(int).tolist(), (np.arange(33) * 33.0).tolist(), ("uV", 100000.0))
    (tmp_path / "bad.ts.bin").write_bytes(b"123")
    with pytest.raises(Exception, match="whole pairs"):
        load(spark, "interleaved_samples", tmp_path / "bad.ts.bin").count()


def test_spike_file(spark, tmp_path):
    s = np.zeros(5, plain.SPIKE)
    s["t"], s["unit"] = np.arange(5) * 100, [0, 1, 2, 1, 0]
    w = np.arange(20.0).reshape(5, 4)
    (tmp_path / "u.ts.bin").write_bytes(struct.pack("<qqq", 45, 5, 4) + s.tobytes() + w.tobytes())
    rows = load(spark, "spike_file", tmp_path / "u.ts.bin").orderBy("t_us").collect()
    assert [(r["t_us"], r["unit"], r["waveform"]) for r in rows] == list(zip((np.arange(5) * 100).tolist(), [0, 1, 2, 1, 0], w.tolist()))
    (tmp_path / "v.ts.bin").write_bytes(struct.pack("<qqq", 45, 5, 4) + s.tobytes())
    with pytest.raises(Exception, match="don't match"):
        load(spark, "spike_file", tmp_path / "v.ts.bin").count()


def write_edf(path, records, broken=False, onsets=None):
    labels = ["A", "B"] + (["EDF Annotations"] if broken else [])
    n = [4, 2] + ([16] if broken else [])
    f = lambda values, w: "".join(str(v).ljust(w) for v in values)
    k = len(labels)
    head = "0".ljust(8) + "p".ljust(80) + "r".ljust(80) + "02.03.04" + "05.06.07" + str(256 * (k + 1)).ljust(8) + ("EDF+D" if broken else "").ljust(44) + str(len(records)).ljust(8) + "1".ljust(8) + str(k).ljust(4)
    head += f(labels, 16) + f([""] * k, 80) + f(["uV"] * k, 8) + f([-100, -50, -1][:k], 8) + f([100, 50, 1][:k], 8) + f([-1000, -500, -32768][:k], 8) + f([1000, 500, 32767][:k], 8) + f([""] * k, 80) + f(n, 8) + f([""] * k, 32)
    body = b""
    for i, r in enumerate(records):
        body += np.asarray(r, "<i2").tobytes()
        if broken:
            body += (f"+{onsets[i]}".encode() + b"\x14\x14\x00" + f"+{onsets[i]}\x152\x14note{i}\x14\x00".encode()).ljust(32, b"\x00")
    path.write_bytes(head.encode() + body)


def test_edf(spark, tmp_path):
    write_edf(tmp_path / "a.edf", [[0, 10, -10, 1000, 1, 2], [5, 6, 7, 8, 3, 4]])
    d = load(spark, "edf", tmp_path / "a.edf")
    start = 1078203967_000_000
    t, x, (unit, rate) = series(d, "A")
    assert t == [start + i * 250_000 for i in range(8)] and np.allclose(x, [0, 1, -1, 100, 0.5, 0.6, 0.7, 0.8]) and (unit, rate) == ("uV", 4.0)
    assert np.allclose(series(d, "B")[1], [0.1, 0.2, 0.3, 0.4])


def test_edf_discontinuous(spark, tmp_path):
    write_edf(tmp_path / "b.edf", [[0, 1, 2, 3, 1, 2], [5, 6, 7, 8, 3, 4]], True, [0, 10])
    start = 1078203967_000_000
    assert series(load(spark, "edf", tmp_path / "b.edf"), "B")[0] == [start, start + 500_000, start + 10_000_000, start + 10_500_000]
    notes = load(spark, "edf_annotations", tmp_path / "b.edf").orderBy("t_us").collect()
    assert [(n["t_us"], n["label"]) for n in notes] == [(start, "note0"), (start + 10_000_000, "note1")]


def oe_header(**more):
    fields = {"format": "'Open Ephys Data Format'", "date_created": "'03-Feb-2016 93130'", "channel": "'CH1'", "sampleRate": 1000, "blockLength": 4, "bitVolts": 0.5, "description": "'each record contains one 64-bit timestamp, one 16-bit sample count: continuous'"} | more
    return "".join(f"header.{k} = {v};\n" for k, v in fields.items()).encode().ljust(1024, b" ")


def test_openephys(spark, tmp_path):
    kind = np.dtype([("t", "<i8"), ("n", "<u2"), ("r", "<u2"), ("x", ">i2", 4), ("m", "u1", 10)])
    r = np.zeros(3, kind)
    r["t"], r["x"] = [2000, 2004, 2008], np.arange(12).reshape(3, 4) - 6
    (tmp_path / "a.continuous").write_bytes(oe_header() + r.tobytes())
    start = 1454491890_000_000
    t, x, (_, rate) = series(load(spark, "openephys_continuous", tmp_path), "CH1")
    assert t == [start + 2_000_000 + i * 1000 for i in range(12)] and x == [(i - 6) / 2 for i in range(12)] and rate == 1000
    assert series(load(spark, "openephys_continuous", tmp_path, bitVolts="false", twice="true"), "CH1")[0][0] == start + 4_000_000
    s = np.zeros(2, openephys.spike_type(2))
    s["stamp"], s["w"], s["gain"], s["sorted"] = [100, 200], 32768 + 7000, 2.0, [1, 2]
    (tmp_path / "b.spikes").write_bytes(oe_header(num_channels=2, electrode="'TT0'", description="'spike'") + s.tobytes())
    rows = load(spark, "openephys_spikes", tmp_path).orderBy("channel", "t_us").collect()
    assert [(q["channel"], q["t_us"] - start, q["unit"], set(q["waveform"])) for q in rows] == [(c, t, u, {3.5}) for c in ("TT0-0", "TT0-1") for t, u in ((100_000, 1), (200_000, 2))]
    e = np.zeros(2, openephys.EVENT)
    e["stamp"], e["channel"] = [1000, 3000], [4, 5]
    (tmp_path / "c.events").write_bytes(oe_header(description="'event'") + e.tobytes())
    assert [v["t_us"] - start for v in load(spark, "openephys_events", tmp_path).orderBy("t_us").collect()] == [1_000_000, 3_000_000]
    assert [openephys.kind_of(str(tmp_path / n)) for n in ("a.continuous", "b.spikes", "c.events")] == ["continuous", "spike", "skip"]


def test_persyst(spark, tmp_path):
    np.arange(20, dtype="<i2").tofile(tmp_path / "d.dat")
    (tmp_path / "d.lay").write_text("[FileInfo]\nFile=d.dat\nFileType=Interleaved\nSamplingRate=100\nHeaderLength=0\nCalibration=0.5\nWaveformCount=2\nDataType=0\n[Patient]\nTestDate=02/06/2000\nTestTime=01:02:03\n[SampleTimes]\n0=10.0\n6=20.0\n[ChannelMap]\nFP1-Ref=1\nC3=2\n")
    d = load(spark, "persyst", tmp_path)
    t, x, _ = series(d, "FP1-Ref")
    assert t == [10_000_000 + i * 10_000 for i in range(6)] + [20_000_000 + i * 10_000 for i in range(4)] and x == [float(i) for i in range(10)]
    assert series(load(spark, "persyst", tmp_path, lower="true"), "fp1-ref")[1] == x
    assert persyst.start_time({"testdate": "02/06/2000", "testtime": "01:02:03"}) == 949798923_000_000 and persyst.start_time({}) == 0
    (tmp_path / "b").mkdir()
    np.arange(100, 120, dtype="<i2").tofile(tmp_path / "b" / "d.dat")
    (tmp_path / "b" / "d.lay").write_text((tmp_path / "d.lay").read_text().replace("C3=2", "C4=2"))
    assert series(load(spark, "persyst", tmp_path), "C4")[1] == [50.5 + i for i in range(10)] and series(load(spark, "persyst", tmp_path), "C3")[1] == [0.5 + i for i in range(10)]
    (tmp_path / "e").mkdir()
    with pytest.raises(Exception, match="no .lay"):
        load(spark, "persyst", tmp_path / "e").count()


def write_nsx(path):
    h = np.zeros(1, blackrock.BASIC)
    h["id"], h["spec"], h["bytes"], h["period"], h["resolution"], h["n"] = b"NEURALCD", (2, 3), 314 + 132, 30, 30000, 2
    h["origin"] = (2016, 2, 3, 3, 4, 5, 6, 7)
    c = np.zeros(2, blackrock.CHANNEL)
    c["type"], c["id"], c["label"], c["unit"] = b"CC", [1, 130], [b"e1", b""], b"uV"
    c["min_dig"], c["max_dig"], c["min_ana"], c["max_ana"] = [-100, 0], [100, 100], [-50, 10], [50, 20]
    block = lambda t, x: struct.pack("<BII", 1, t, len(x)) + np.asarray(x, "<i2").tobytes()
    path.write_bytes(h.tobytes() + c.tobytes() + block(0, [[10, 50], [20, 100]]) + block(60000, [[-10, 0]]))


def test_nsx(spark, tmp_path):
    write_nsx(tmp_path / "a.ns2")
    start = 1454472306_007_000
    d = load(spark, "nsx", tmp_path)
    assert series(d, "e1") == ([start, start + 1000, start + 2_000_000], [5, 10, -5], ("uV", 1000.0))
    assert series(d, "ainp2")[1] == [15, 20, 10]
    (tmp_path / "b.ns5").write_bytes(b"NEURALSG" + b"x" * 16 + struct.pack("<II", 1, 1) + struct.pack("<I", 7) + np.arange(4, dtype="<i2").tobytes())
    assert series(load(spark, "nsx", tmp_path, nsx="5"), "chan7") == ([0, 33, 66, 100], [0, 1, 2, 3], ("uV", 30000.0))


def test_nev(spark, tmp_path):
    h = np.zeros(1, blackrock.NEV)
    h["id"], h["spec"], h["bytes"], h["packet"], h["resolution"], h["n"], h["origin"] = b"NEURALEV", (2, 3), 336 + 64, 16, 30000, 2, (2016, 2, 3, 3, 4, 5, 6, 0)
    w = np.zeros(1, blackrock.WAVE)
    w["id"], w["factor"], w["bytes"] = 3, 250, 2
    label = b"NEUEVLBL" + struct.pack("<H16s6s", 3, b"elec3", b"")
    packets = struct.pack("<IHBB4h", 30000, 3, 1, 0, 4, 8, -4, 0) + struct.pack("<IHBBH6s", 60000, 0, 1, 0, 77, b"") + struct.pack("<IHBB4h", 90000, 3, 255, 0, 1, 1, 1, 1)
    (tmp_path / "a.nev").write_bytes(h.tobytes() + b"NEUEVWAV" + w.tobytes() + label + packets)
    start = 1454472306_000_000
    rows = load(spark, "nev_spikes", tmp_path).orderBy("t_us").collect()
    assert [(r["channel"], r["t_us"] - start, r["unit"], r["waveform"]) for r in rows] == [("elec3", 1_000_000, 1, [1.0, 2.0, -1.0, 0.0]), ("elec3", 3_000_000, 255, [0.25] * 4)]
    (e,) = load(spark, "nev_events", tmp_path).collect()
    assert (e["type"], e["t_us"] - start, e["label"]) == ("digital", 2_000_000, "77")


def test_moberg(spark, tmp_path):
    base = tmp_path / "CVP,na,SampleSeries,Integer,dev,"
    runs = np.zeros(2, moberg.INDEX)
    runs["first"], runs["clock"], runs["whole"], runs["fraction"], runs["format"] = [0, 3], [1_000_000, 9_000_000], 8000, 2**31, 5
    (tmp_path / (base.name + "index")).write_bytes(runs.tobytes())
    x = [1, -1, 70_000, -70_000, 8_388_607]
    (tmp_path / (base.name + "data")).write_bytes(b"".join(int(v).to_bytes(3, "little", signed=True) for v in x))
    (tmp_path / (base.name + "settings")).write_text("<r><Units>mmHg</Units><SampleConversion>-10,10,-5,5</SampleConversion></r>")
    (tmp_path / ("._" + base.name + "data")).write_bytes(b"junk")
    t, v, (unit, rate) = series(load(spark, "moberg", tmp_path), "CVP")
    assert t == [1_000_000, 1_008_000, 1_016_001, 9_000_000, 9_008_000] and v == [y / 2 for y in x] and unit == "mmHg" and abs(rate - 124.99) < 0.01
    comp = "ECG,na,Numeric,Composite,dev,"
    runs = np.zeros(1, moberg.INDEX)
    runs["whole"], runs["format"], runs["bytes"] = 1000, 0x84, 8
    (tmp_path / (comp + "index")).write_bytes(runs.tobytes())
    (tmp_path / (comp + "data")).write_bytes(np.arange(6, dtype="<f4").tobytes())
    (tmp_path / (comp + "settings")).write_text("<r><Units>mV</Units><CompositeElements><CompositeElement type='a,I,b,Float'/><CompositeElement type='a,II,b,Float'/></CompositeElements></r>")
    assert series(load(spark, "moberg", tmp_path), "ECG-II")[1] == [1, 3, 5]
    (tmp_path / "patient.xml").write_text("<p><Name>X</Name></p>")
    assert [(r["label"], r["props"]["field"]) for r in load(spark, "moberg_patient", tmp_path).collect()] == [("X", "Name")]


def test_red_blocks_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 500, 3000):
        x = np.cumsum(rng.integers(-70, 70, n))
        x[:: max(1, n // 7)] += rng.integers(-90_000, 90_000)
        t, y, gap = red.decode_mef2(red.encode_mef2(123, x, True), True)
        assert t == 123 and gap and (x == y).all()
        t, y, gap = red.decode_mef3(red.encode_mef3(-9, x * 300), True)
        assert t == -9 and not gap and (x * 300 == y).all()
    bad = bytearray(red.encode_mef3(0, x))
    bad[100] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        red.decode_mef3(bytes(bad), True)


def write_mef2(path, blocks, rate=200.0):
    h = bytearray(1024)
    data, index, sample = b"", [], 0
    for t, x in blocks:
        index.append((t, 1024 + len(data), sample))
        b = red.encode_mef2(t, x)
        data += b + bytes(-len(b) % 8)
        sample += len(x)
    struct.pack_into("<Q", h, 368, sample)
    h[376:380] = b"LFP1"
    struct.pack_into("<QQd", h, 408, blocks[0][0], blocks[-1][0], rate)
    struct.pack_into("<d", h, 456, 0.5)
    struct.pack_into("<QQ", h, 816, 1024 + len(data), len(index))
    path.write_bytes(bytes(h) + data + np.asarray(index, "<u8").tobytes())


def test_mef2(spark, tmp_path):
    x = np.cumsum(np.random.default_rng(2).integers(-300, 300, 200))
    write_mef2(tmp_path / "a.mef", [(1_000_000, x[:120]), (1_500_000, x[120:])])
    t, v, (_, rate) = series(load(spark, "mef2", tmp_path, validate="true"), "LFP1")
    assert rate == 200 and sorted(v) == sorted((x * 0.5).tolist())
    cut = load(spark, "mef2", tmp_path, clamp="true")
    assert cut.where("t_us < 1500000").count() == 100 and cut.count() == 180
    assert mef.mef2_channels(spark, str(tmp_path)).first()["samples"] == 200


def test_aes_and_passwords():
    key, plain_text = bytes(range(16)), bytes.fromhex("00112233445566778899aabbccddeeff")
    sealed = bytes.fromhex("69c4e0d86a7b0430d8cdb78070b4c55a")
    assert crypto.encrypt_block(plain_text, key) == sealed and crypto.decrypt_block(sealed, key) == plain_text
    one, two = crypto.password_key("open"), crypto.password_key("sesame")
    h = bytearray(1024)
    h[868:884] = hashlib.sha256(one).digest()[:16]
    h[884:900] = bytes(a ^ b for a, b in zip(hashlib.sha256(two).digest()[:16], one))
    assert crypto.mef3_access(bytes(h), "open") == (1, one, None) and crypto.mef3_access(bytes(h), "sesame") == (2, one, two)
    assert crypto.mef3_access(bytes(h), "wrong")[0] == 0 and crypto.mef3_access(bytes(1024), "x")[0] == 0


def test_mef3_adds_the_recording_offset(spark, tmp_path):
    """Negative stored times lack the offset of section 3; pruning goes by the true times."""
    d = tmp_path / "s.mefd" / "ch1.timd" / "ch1-000000.segd"
    d.mkdir(parents=True)
    offset, x = 1_500_000_000_000_000, np.arange(200)
    data, index = bytes(1024), np.zeros(2, mef.INDEX3)
    for k in range(2):
        b = red.encode_mef3(-(1_000_000 * (k + 1)), x[100 * k : 100 * k + 100])
        index[k]["at"], index[k]["t"], index[k]["sample"], index[k]["n"], index[k]["bytes"] = len(data), -(1_000_000 * (k + 1)), 100 * k, 100, len(b)
        data += b
    m = bytearray(16384)
    m[52:55] = b"ch1"
    struct.pack_into("<d", m, 8720, 100.0)
    struct.pack_into("<qqq", m, 8912, 0, 200, 2)
    struct.pack_into("<q", m, 13312, offset)
    for ext, b in ((".tdat", data), (".tidx", bytes(1024) + index.tobytes()), (".tmet", bytes(m))):
        (d / f"ch1-000000{ext}").write_bytes(b)
    t, v, _ = series(load(spark, "mef3", tmp_path / "s.mefd"), "ch1")
    assert t == [offset + 1_000_000 + 10_000 * i for i in range(200)] and v == x.tolist()
    assert load(spark, "mef3", tmp_path / "s.mefd", start=str(offset + 2_500_000)).count() == 50
    struct.pack_into("<q", m, 13312, mef.NO_OFFSET)
    (d / "ch1-000000.tmet").write_bytes(bytes(m))
    assert series(load(spark, "mef3", tmp_path / "s.mefd"), "ch1")[0][0] == 1_000_000


def test_mef3(spark, tmp_path):
    d = tmp_path / "s.mefd" / "ch1.timd" / "ch1-000000.segd"
    d.mkdir(parents=True)
    x = np.cumsum(np.random.default_rng(3).integers(-300, 300, 300))
    data, index = bytes(1024), np.zeros(3, mef.INDEX3)
    for k in range(3):
        b = red.encode_mef3(10_000_000 + k * 1_000_000, x[100 * k : 100 * k + 100])
        index[k]["at"], index[k]["t"], index[k]["sample"], index[k]["n"], index[k]["bytes"] = len(data), 10_000_000 + k * 1_000_000, 100 * k, 100, len(b)
        data += b
    m = bytearray(16384)
    m[52:55] = b"ch1"
    struct.pack_into("<d", m, 8720, 100.0)
    struct.pack_into("<d", m, 8760, 2.0)
    m[8768:8770] = b"uV"
    struct.pack_into("<qqq", m, 8912, 0, 300, 3)
    for ext, b in ((".tdat", data), (".tidx", bytes(1024) + index.tobytes()), (".tmet", bytes(m))):
        (d / f"ch1-000000{ext}").write_bytes(b)
    t, v, meta = series(load(spark, "mef3", tmp_path / "s.mefd", validate="true"), "ch1")
    assert t == [10_000_000 + 10_000 * i for i in range(300)] and v == (x * 2.0).tolist() and meta == ("uV", 100.0)
    part = load(spark, "mef3", tmp_path / "s.mefd", start="11500000", end="12000000")
    assert part.count() == 50 and len(mef.chosen_blocks(mef.Mef3.plan(str(tmp_path / "s.mefd"), {})[0].info, {"start": "11500000", "end": "12000000"})) == 1
    assert mef.mef3_channels(spark, str(tmp_path)).first()["samples"] == 300
    key = crypto.password_key("open")
    m[868:884], m[1024] = hashlib.sha256(key).digest()[:16], 1
    m[2560:13312] = b"".join(crypto.encrypt_block(bytes(m[k : k + 16]), key) for k in range(2560, 13312, 16))
    (d / "ch1-000000.tmet").write_bytes(bytes(m))
    sealed = bytearray(data)
    for at in index["at"].tolist():
        sealed[at + 4] |= 2
        sealed[at + 48 : at + 64] = crypto.encrypt_block(bytes(sealed[at + 48 : at + 64]), key)
    (d / "ch1-000000.tdat").write_bytes(bytes(sealed))
    assert series(load(spark, "mef3", tmp_path / "s.mefd", password="open"), "ch1")[1] == v
    with pytest.raises(Exception, match="password"):
        load(spark, "mef3", tmp_path / "s.mefd", password="wrong").count()


def test_mef3_writer(spark, tmp_path):
    x = np.cumsum(np.random.default_rng(4).integers(-300, 300, 900)).astype(float)
    r = spark.createDataFrame([("ch", 100.0, 5_000_000, x[:500].tolist()), ("ch", 100.0, 20_000_000, x[500:].tolist())], "channel_id string, rate double, lo long, values array<double>")
    out = mef.write_mef3(r, str(tmp_path / "s.mefd"), factor=0.5, per_segment=1, block=128).collect()
    assert sorted((o["segment"], o["samples"]) for o in out) == [(0, 500), (1, 400)]
    t, v, meta = series(load(spark, "mef3", tmp_path / "s.mefd", validate="true"), "ch")
    assert v == x.tolist() and meta == ("uV", 100.0) and t[0] == 5_000_000 and t[500] == 20_000_000 and t[-1] == 20_000_000 + 399 * 10_000


def test_nex(spark, tmp_path):
    h, v = np.zeros(1, nex.FILE), np.zeros(3, nex.VARIABLE)
    h["magic"], h["frequency"], h["n"] = 827868494, 1000.0, 3
    at = nex.FILE.itemsize + 3 * nex.VARIABLE.itemsize
    cont = np.asarray([100, 500], "<i4").tobytes() + np.asarray([0, 3], "<i4").tobytes() + np.asarray([1, 2, 3, 4, 5], "<i2").tobytes()
    wave = np.asarray([10, 20], "<i4").tobytes() + np.asarray([[1, 2], [3, 4]], "<i2").tobytes()
    event = np.asarray([7], "<i4").tobytes()
    v["type"], v["name"], v["count"], v["points"] = [nex.CONTINUOUS, nex.WAVEFORM, nex.EVENT], [b"ad1", b"sig1", b"ev"], [2, 2, 1], [5, 2, 0]
    v["at"], v["to_mv"], v["rate"] = [at, at + len(cont), at + len(cont) + len(wave)], 0.5, 100.0
    (tmp_path / "a.nex").write_bytes(h.tobytes() + v.tobytes() + cont + wave + event)
    assert series(load(spark, "nex_continuous", tmp_path), "ad1") == ([100_000, 110_000, 120_000, 500_000, 510_000], [0.5, 1, 1.5, 2, 2.5], ("mV", 100.0))
    assert [(r["t_us"], r["waveform"]) for r in load(spark, "nex_spikes", tmp_path).orderBy("t_us").collect()] == [(10_000, [0.5, 1.0]), (20_000, [1.5, 2.0])]
    assert [r["t_us"] for r in load(spark, "nex_events", tmp_path).collect()] == [7000]


def write_nicolet(path):
    out = bytearray(172_208 + 4096)
    wide = lambda s, n: s.encode("utf-16-le").ljust(n, b"\0")
    raw_guid = bytes.fromhex("CBCC71A25D519045B6A1DC170C8D6EE2")
    sections = {}

    def put(section, data):
        sections.setdefault(section, []).append((len(out), len(data)))
        out.extend(data)

    ts = bytearray(760 + 552)
    struct.pack_into("<I", ts, 752, 1)
    ts[760 : 760 + 128] = wide("C3", 128)
    struct.pack_into("<4d", ts, 760 + 256, 0.1, 70.0, 4.0, 0.25)
    put(2, bytes(ts[:700]))
    put(2, bytes(ts[700:]))
    put(1, raw_guid + struct.pack("<ddQQ", 0, 0, 0, len(ts)))
    ole = (1_000_000_000 + 2209161600) / 86400
    put(3, b"".join(struct.pack("<ddd", o, 0, d) + bytes(128) for o, d in ((ole, 2.0), (ole + 1, 1.5))))
    put(4, np.arange(5, dtype="<i2").tobytes())
    put(4, np.arange(5, 14, dtype="<i2").tobytes())
    tags = [("InfoChangeStream", 1), (nicolet.TS_PACKET, 2), ("SegmentStream", 3), ("0", 4)]
    chain = len(out)
    rows = [(s, at, size) for s, parts in sections.items() for at, size in parts]
    out.extend(struct.pack("<Q", len(rows)) + b"".join(struct.pack("<QQQ", s, at, size << 32) for s, at, size in rows) + struct.pack("<Q", 0))
    struct.pack_into("<I", out, 24, chain)
    struct.pack_into("<I", out, 172, len(tags))
    for i, (tag, section) in enumerate(tags):
        out[176 + 84 * i : 176 + 84 * i + 80] = wide(tag, 80)
        struct.pack_into("<I", out, 176 + 84 * i + 80, section)
    struct.pack_into("<I", out, 172_208, len(rows))
    path.write_bytes(bytes(out))


def test_nicolet(spark, tmp_path):
    write_nicolet(tmp_path / "a.e")
    t, x, (_, rate) = series(load(spark, "nicolet", tmp_path), "C3")
    assert rate == 4 and x == [i * 0.25 for i in range(14)]
    assert abs(t[0] - 1_000_000_000_000_000) < 100 and abs(t[7] - t[0] - 2_000_000) <= 1 and abs(t[8] - t[0] - 86_400_000_000) < 100
    assert load(spark, "nicolet_segments", tmp_path).count() == 2


def test_channels_json(spark, tmp_path):
    (tmp_path / "c.json").write_text('[{"nodeId": "N:1", "name": "a", "start": 5000, "end": 5500, "rate": 10000, "unit": "uV", "type": "CONTINUOUS", "properties": []}]')
    for source in (str(tmp_path / "c.json"), '{"nodeId": "N:1", "start": 5000, "rate": 10000}', [{"id": "N:1", "start": 5000, "rate": 1e4}]):
        r = plain.read_channels(spark, source).first()
        assert (r["channel_id"], r["start"], r["rate"]) == ("N:1", 5000, 10000.0)
    with pytest.raises(ValueError):
        plain.read_channels(spark, "5")


def test_empty_folder_gives_no_rows(spark, tmp_path):
    assert load(spark, "edf", tmp_path).count() == 0 and edf.Edf.plan(str(tmp_path), {}) == []


def write_tdms(path, interleaved=False):
    text = lambda s: struct.pack("<I", len(s)) + s.encode()
    prop = lambda k, kind, v: text(k) + struct.pack("<I", kind) + v

    def channel(name, n, **more):
        props = [prop("wf_increment", 10, struct.pack("<d", 0.001)), prop("wf_start_time", 0x44, struct.pack("<Qq", 1 << 63, 2_082_844_800 + 10)), *more.values()]
        return text(f"/'g'/'{name}'") + struct.pack("<IIIQ", 20, 10, 1, n) + struct.pack("<I", len(props)) + b"".join(props)

    meta = struct.pack("<I", 4) + text("/") + struct.pack("<II", 0xFFFFFFFF, 0) + channel("a", 3, u=prop("unit_string", 0x20, text("uV"))) + channel("b", 3) + channel("c", 3, d=prop("DecimationLevel", 3, struct.pack("<i", 2)))
    x = np.arange(9.0).reshape(3, 3)
    raw = (x.T if interleaved else x).copy().tobytes()
    toc = 2 | 4 | 8 | (32 if interleaved else 0)
    lead = lambda toc, m, r: b"TDSm" + struct.pack("<IIQQ", toc, 4713, len(m) + len(r), len(m))
    path.write_bytes(lead(toc, meta, raw) + meta + raw + lead(8 | (32 if interleaved else 0), b"", raw) + raw)


@pytest.mark.parametrize("interleaved", [False, True])
def test_tdms(spark, tmp_path, interleaved):
    write_tdms(tmp_path / "x.tdms", interleaved)
    d = load(spark, "tdms", tmp_path)
    assert series(d, "a") == ([10_500_000 + 1000 * i for i in range(6)], [0, 1, 2, 0, 1, 2], ("uV", 1000.0))
    assert series(d, "b")[1] == [3, 4, 5, 3, 4, 5] and series(d, "b")[2][0] == "V" and d.where("channel = 'c'").count() == 0


def test_spike2(spark, tmp_path):
    h, c = np.zeros(1, spike2.FILE), np.zeros(3, spike2.CHANNEL)
    h["system"], h["us_per_time"], h["time_base"], h["channels"] = 8, 10, 1e-6, 3
    text = lambda s, n: np.void(bytes([len(s)]) + s.encode().ljust(n - 1, b"\0"))
    at = spike2.FILE.itemsize + 3 * spike2.CHANNEL.itemsize
    block = lambda nxt, start, x, kind: struct.pack("<iiiihh", -1, nxt, start, 0, 1, len(x)) + np.asarray(x, kind).tobytes()
    second = at + len(block(0, 0, [1, 2, 3], "<i2"))
    data = block(second, 0, [0, 6554, -6554], "<i2") + block(-1, 900, [100], "<i2")
    events = at + len(data)
    data += block(-1, 0, [5, 8], "<i4")
    c["kind"], c["blocks"], c["first"], c["divide"], c["scale"] = [1, 0, 2], [2, 0, 1], [at, 0, events], [100, 0, 0], [2.0, 0, 0]
    c["title"][0], c["unit"][0], c["title"][2] = text("LFP", 10), text("mV", 6), text("trig", 10)
    (tmp_path / "a.smr").write_bytes(h.tobytes() + c.tobytes() + data)
    t, x, meta = series(load(spark, "spike2", tmp_path, first="true"), "LFP")
    assert t == [0, 1000, 2000, 9000] and np.allclose(x, [0, 2.0001, -2.0001, 0.0305], atol=1e-3) and meta == ("mV", 1000.0)
    assert [(e["t_us"], e["label"]) for e in load(spark, "spike2_events", tmp_path).orderBy("t_us").collect()] == [(50, "trig"), (80, "trig")]
