"""MEF 3 metadata laid out by hand: segments, channels and sessions folded, sealed sections, video clips."""

import hashlib
import struct

import pytest

from sigloom import sources
from sigloom.functions import crypto
from sigloom.sources import mefmeta

NONE = -(1 << 63)


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    sources.register(spark)


def put(root, channel, number, start, end, video=False, rate=100.0, samples=50, notch=-1.0, offset=NONE, levels=(0, 0), unit="uV", name="Ann"):
    folder = root / "ses.mefd" / f"{channel}.{'vidd' if video else 'timd'}" / f"{channel}-{number:06d}.segd"
    folder.mkdir(parents=True)
    m = bytearray(16384)
    struct.pack_into("<qqqqi", m, 16, start, end, 1, 0, number)
    for at, s in ((52, channel), (308, "ses"), (564, "anon"), (2560, f"about {channel}"), (4608, "a night"), (13340, name), (13596, "P7"), (13724, "Oslo")):
        m[at : at + len(s)] = s.encode()
    struct.pack_into("<q", m, 6656, end - start + 1)
    if video:
        struct.pack_into("<qqdqq", m, 6664, 640, 480, 25.0, 2, 900 + number)
        m[6704:6708] = b"MPEG"
        (folder / f"{channel}-{number:06d}.vidx").write_bytes(bytes(m[:1024]) + b"".join(struct.pack("<qqIIqq", start + k, start + k + 1, 25 * k, 25 * k + 24, 100 * k, 90).ljust(64, b"\0") for k in range(2)))
    else:
        m[6664:6667] = b"ref"
        struct.pack_into("<qdddddd", m, 8712, 3, rate, 0.5, -1.0, notch, 50.0, 0.25)
        m[8768 : 8768 + len(unit)] = unit.encode()
        struct.pack_into("<ddqqqqIIqqqqq", m, 8896, 9.0 + number, -5.0 - number, 1000 - 50 * number, samples, 7, 400 + number, 60, 61, -1, number, 4, 500, 40)
    struct.pack_into("<qqqi", m, 13312, offset, NONE, NONE, 3600)
    one, two = crypto.password_key("open"), crypto.password_key("sesame")
    if any(levels):
        m[868:884] = hashlib.sha256(one).digest()[:16]
        m[884:900] = bytes(a ^ b for a, b in zip(hashlib.sha256(two).digest()[:16], one))
    for at, a, b, level in ((1024, 2560, 13312, levels[0]), (1025, 13312, 16384, levels[1])):
        m[at] = level
        if level:
            m[a:b] = b"".join(crypto.encrypt_block(bytes(m[k : k + 16]), (one, two)[level - 1]) for k in range(a, b, 16))
    (folder / f"{channel}-{number:06d}.{'vmet' if video else 'tmet'}").write_bytes(bytes(m))


@pytest.fixture
def session(tmp_path):
    put(tmp_path, "a", 0, 1000, 1999)
    put(tmp_path, "a", 1, 3000, 3999, samples=60, notch=50.0)
    put(tmp_path, "b", 0, 500, 2500, rate=200.0, unit="mV", name="")
    put(tmp_path, "v", 0, 900, 5000, video=True)
    return tmp_path


def test_segments_and_channels(spark, session):
    seg = spark.read.format("mef3_segments").load(str(session))
    a0 = seg.where("channel = 'a' and segment = 0").first().asDict(recursive=True)
    assert a0["series"] == {"reference_description": "ref", "acquisition_channel": 3, "rate": 100.0, "low_filter": 0.5, "high_filter": None, "notch_filter": None, "line_frequency": 50.0, "factor": 0.25, "unit": "uV", "greatest": 9.0, "least": -5.0, "first_sample": 1000,
                            "samples": 50, "blocks": 7, "block_bytes": 400, "block_samples": 60, "difference_bytes": 61, "block_interval": None, "discontinuities": 0, "contiguous_blocks": 4, "contiguous_bytes": 500, "contiguous_samples": 40}
    assert a0["private"] == {"recording_offset": None, "dst_start": None, "dst_end": None, "gmt_offset": 3600, "name_1": "Ann", "name_2": None, "subject": "P7", "location": "Oslo"} and a0["video"] is None and a0["anonymized"] == "anon"
    a = next(r for r in mefmeta.channels(seg).collect() if r["channel"] == "a").asDict(recursive=True)
    assert (a["n_segments"], a["start"], a["end"], a["general"]["recording_duration"]) == (2, 1000, 3999, 3000) and [s["segment"] for s in a["segments"]] == [0, 1]
    s = a["series"]
    assert (s["samples"], s["blocks"], s["first_sample"], s["greatest"], s["least"], s["block_bytes"], s["discontinuities"], s["rate"], s["notch_filter"], s["unit"]) == (110, 14, 950, 10.0, -6.0, 401, 1, 100.0, None, "uV")
    assert sorted(tuple(r) for r in mefmeta.basic_info(seg).collect()) == [("ses", "a", 100.0, 110, 0.25, "uV", 1000, 3999), ("ses", "b", 200.0, 50, 0.25, "mV", 500, 2500)]


def test_a_session_is_one_nested_row(spark, session):
    rows = mefmeta.read_sessions(spark, str(session)).collect()
    assert len(rows) == 1
    r = rows[0].asDict(recursive=True)
    assert (r["session"], r["n_series"], r["n_video"], r["start"], r["end"]) == ("ses", 2, 1, 500, 5000)
    assert [c["channel"] for c in r["series_channels"]] == ["a", "b"] and r["video_channels"][0]["video"] == {"width": 640, "height": 480, "frame_rate": 25.0, "clips": 2, "clip_bytes": 900, "format": "MPEG"}
    assert r["private"]["subject"] == "P7" and r["private"]["name_1"] is None and r["general"]["session_description"] == "a night" and r["general"]["channel_description"] is None
    assert [s["series"]["samples"] for s in r["series_channels"][0]["segments"]] == [50, 60] and r["series"]["rate"] is None


def test_sealed_sections_and_offsets(spark, tmp_path):
    put(tmp_path, "a", 0, -1000, -1999, offset=7_000_000, levels=(1, 2))
    load = lambda **o: spark.read.format("mef3_segments").options(**o).load(str(tmp_path)).first()
    assert (load()["series"], load()["private"], load()["start"]) == (None, None, 1000)
    assert load(password="open")["series"]["rate"] == 100.0 and load(password="open")["private"] is None
    r = load(password="sesame")
    assert r["private"]["recording_offset"] == 7_000_000 and (r["start"], r["end"], r["opened"]) == (7_001_000, 7_001_999, 2)
    assert mefmeta.sessions(spark.read.format("mef3_segments").load(str(tmp_path))).first()["series"] is None


def test_video_clips(spark, session):
    got = [tuple(r) for r in spark.read.format("mef3_video_clips").load(str(session)).orderBy("clip").collect()]
    assert got == [("ses", "v", 0, 0, 900, 901, 0, 24, 0, 90), ("ses", "v", 0, 1, 901, 902, 25, 49, 100, 90)]
    assert spark.read.format("mef3_segments").load(str(session / "ses.mefd" / "v.vidd")).count() == 1
