"""Nicolet tables from files laid out here byte by byte."""

import struct

import pytest

from sigloom import sources
from sigloom.sources import nicolet


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    sources.register(spark)


def wide(text, n):
    return text.encode("utf-16-le").ljust(n, b"\0")


def write(path, sections):
    """Sections by tag, in parts; their index in a chain of entries of two each."""
    out, rows = bytearray(172_216), []
    for number, (tag, parts) in enumerate(sections.items(), 1):
        out[176 + 84 * (number - 1) : 260 + 84 * (number - 1)] = wide(tag, 80) + struct.pack("<I", number)
        for part in parts:
            rows.append((number, len(out), len(part) << 32))
            out += part
    struct.pack_into("<I", out, 172, len(sections))
    struct.pack_into("<I", out, 172_208, len(rows))
    struct.pack_into("<I", out, 24, len(out))
    for a in range(0, len(rows), 2):
        part = rows[a : a + 2]
        entry = struct.pack("<Q", len(part)) + b"".join(struct.pack("<QQQ", *r) for r in part)
        out += entry + struct.pack("<Q", len(out) + len(entry) + 8 if a + 2 < len(rows) else 0)
    path.write_bytes(bytes(out))


def event(kind, days, rest, duration, label, more=b""):
    """A packet: its kind and length, dates in days and seconds, the user, the event's kind, its label."""
    head = bytes([128, 246, 153, 183, 164, 114, 211, 17, 147, 211, 0, 80, 4, 0, 193, 72]) + struct.pack("<Q", 272 + len(more)) + bytes(8)
    return (head + struct.pack("<ddd", days, rest, duration) + bytes(48) + wide("Eva", 24) + struct.pack("<Q", 3) + bytes.fromhex(kind) + bytes(16) + wide(label, 64)).ljust(272, b"\0") + more


def patient():
    texts = [(1, "P-7"), (4, "Núñez"), (40, "extra")]
    values = struct.pack("<Qd", 7, 36526.4) + struct.pack("<Qd", 23, 171.5) + struct.pack("<Q", 10)
    heads = b"".join(struct.pack("<QQ", k, len(t)) for k, t in texts)
    return bytes(24) + struct.pack("<QQ", 3, 3) + values + heads + b"".join(wide(t, 2 * len(t) + 2) for _, t in texts)


def montage(traces):
    d = bytes(40) + wide("Bipolar", 64) + bytes(640) + struct.pack("<II", 2, 0)
    for a, b in (("Fp1", "F3"), ("F3", "C3")):
        d += wide(f"{a}-{b}", 128) + wide(a, 64) + wide(b, 64) + bytes(264)
    shown = bytes(40) + wide("Page", 64) + bytes(640) + struct.pack("<II", traces, 0) + b"".join(bytes(32) + struct.pack("<I", 255 << 8 * k) + bytes(132) for k in range(traces))
    return d, shown


@pytest.fixture
def file(tmp_path):
    d, shown = montage(2)
    kinds = {v: k for k, v in nicolet.SECTION_NAMES.items()}
    events = event("1256A9A5F8A7CF11831A0800091B5BDA", 25570, 1.5, 2.0, "spike", bytes(40)) + event("4656A9A5F8A7CF11831A0800091B5BDA", 25571, 0.25, 0.0, "onset") + event("00" * 16, 25571, 3, 0.5, "") + bytes(300)
    whole = patient()
    write(tmp_path / "a.e", {"Events": [events], kinds["PATIENTINFOGUID"]: [whole[:37], whole[37:]], kinds["DERIVATIONGUID"]: [d], kinds["DISPLAYGUID"]: [shown], "{00000000-0000-0000-0000-000000000001}": [b"x"], "7": []})
    return tmp_path


def rows(spark, name, path):
    return [r.asDict() for r in spark.read.format(name).load(str(path)).drop("source").collect()]


def test_events(spark, file):
    got = rows(spark, "nicolet_events", file)
    assert [(r["type"], r["t_us"], r["duration_us"], r["user"], r["label"], r["text_length"]) for r in got] == [
        ("Annotation", 86_401_500_000, 2_000_000, "Eva", "spike", 3), ("Seizure", 172_800_250_000, 0, "Eva", "onset", 3), ("UNKNOWN", 172_803_000_000, 500_000, "Eva", "", 3),
    ]
    assert got[0]["guid"] == "{A5A95612-A7F8-11CF-831A-0800091B5BDA}"


def test_patient(spark, file):
    assert {r["field"]: r["value"] for r in rows(spark, "nicolet_patient", file)} == {"DOB": "2000-01-01", "height": "171.5", "sexID": "0", "patientID": "P-7", "lastName": "Núñez", "field40": "extra"}


def test_montage(spark, file, tmp_path):
    want = [{"montage": "Bipolar", "position": 0, "derivation": "Fp1-F3", "signal_1": "Fp1", "signal_2": "F3", "color": 255}, {"montage": "Bipolar", "position": 1, "derivation": "F3-C3", "signal_1": "F3", "signal_2": "C3", "color": 255 << 8}]
    assert rows(spark, "nicolet_montage", file) == want
    kinds = {v: k for k, v in nicolet.SECTION_NAMES.items()}
    d, shown = montage(3)
    write(tmp_path / "a.e", {kinds["DERIVATIONGUID"]: [d], kinds["DISPLAYGUID"]: [shown]})
    assert [r["color"] for r in rows(spark, "nicolet_montage", tmp_path)] == [None, None]


def test_sections_and_names(spark, file, tmp_path):
    got = {r["tag"]: (r["name"], r["parts"]) for r in rows(spark, "nicolet_sections", file)}
    assert got["Events"] == ("Events", 1) and got["7"] == ("7", 0) and got["{00000000-0000-0000-0000-000000000001}"] == ("UNKNOWN", 1)
    assert got["{D0B3FD0B-49D9-4BF0-8929-296DE5A55910}"] == ("PATIENTINFOGUID", 2) and len(nicolet.SECTION_NAMES) == 39 and len(nicolet.EVENT_NAMES) == 9
    write(tmp_path / "a.e", {"SegmentStream": []})
    assert all(rows(spark, f"nicolet_{x}", tmp_path) == [] for x in ("events", "patient", "montage"))
