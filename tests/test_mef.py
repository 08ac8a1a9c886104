"""MEF files whose bytes are laid out here by hand: blocks, encrypted headers, records."""

import hashlib
import struct

import numpy as np
import pytest

from sigloom import sources
from sigloom.functions import crypto, red
from sigloom.sources import mef, mefrec


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    sources.register(spark)


def load(spark, name, path, **options):
    return spark.read.format(name).options(**options).load(str(path))


def sealed(data, key):
    return b"".join(crypto.encrypt_block(bytes(data[i : i + 16]), key) for i in range(0, len(data), 16))


#: Symbols 0 and 1 with a count of one each take one bit apiece, highest first: a whole value of 1, then differences of one bit.
TWO = bytes([1, 1]) + bytes(254)


def hand_block_2(t, gap=0):
    """Value 1 (bytes 1 0 0), then +1 +1 0 +1 0: bits 100 11010."""
    data = b"\0" + bytes([0b10011010]) + bytes(6)
    body = struct.pack("<IQII", len(data), t, 8, 6) + bytes([4, 0, 0, 1, 0, 0, gap]) + TWO + data
    return struct.pack("<I", red.crc32_koopman(body)) + body


def test_blocks_worked_out_by_hand():
    assert hand_block_2(5)[287:289] == b"\x00\x9a" and len(hand_block_2(5)) == 295
    t, x, gap = red.decode_mef2(hand_block_2(7, 1), validate=True)
    assert (t, x.tolist(), gap) == (7, [1, 2, 3, 3, 4, 4], True)
    # value 1 (bytes 1 0 0 0), then +1 +1 0 +1: bits 1000 1101; scaled by 3, a line of slope 2 from 10
    head = struct.pack("<IB3s4s4sfffIIIq", 0, 1, b"", b"", b"", 0.0, 0.0, 1.0, 8, 5, 312, 99)
    t, x, gap = red.decode_mef3(head + TWO + bytes([0b10001101]) + bytes(7))
    assert (t, x.tolist(), gap) == (99, [1, 2, 3, 3, 4], True)
    head = struct.pack("<IB3s4s4sfffIIIq", 0, 0, b"", b"", b"", 2.0, 10.0, 3.0, 8, 5, 312, 99)
    assert red.decode_mef3(head + TWO + bytes([0b10001101]) + bytes(7))[1].tolist() == [3 + 12, 6 + 14, 9 + 16, 9 + 18, 12 + 20]
    # the polynomial's checksum of one byte by long division of its bits
    crc = 0xFFFFFFFF ^ 0x61
    for _ in range(8):
        crc = (crc >> 1) ^ (0xEB31D82E if crc & 1 else 0)
    assert red.crc32_koopman(b"a") == crc


def mef2_file(path, starts, subject=None, session=None, data=None, name=b"LFP1"):
    """Blocks of six samples at 2 Hz; passwords seal the header's regions and, with data, the first 16 model bytes of each block."""
    h, blocks, index = bytearray(1024), b"", []
    for k, t in enumerate(starts):
        b = hand_block_2(t, int(k == 0 or t > starts[k - 1] + 3_000_000))
        if data:
            b = b[:31] + sealed(b[31:47], crypto.mef2_key(data)) + b[47:]
        index.append((t, 1024 + len(blocks), 6 * k))
        blocks += b + bytes(-len(b) % 8)
    h[0:4], h[128:139], h[160:163] = b"Home", b"128-bit AES", bytes([subject is not None, session is not None, data is not None])
    h[176:180], h[208:212], h[272:275] = b"Anna", b"Lind", b"P07"
    if session:
        h[304 : 304 + len(session)] = session.encode()
        h[352 : 353 + len(session)] = bytes([len(session)]) + session.encode()
    if subject:
        h[320 : 321 + len(subject)] = bytes([len(subject)]) + subject.encode()
    struct.pack_into("<Q", h, 368, 6 * len(starts))
    h[376 : 376 + len(name)] = name
    struct.pack_into("<QQdddddI", h, 408, starts[0], starts[-1], 2.0, 0.1, 100.0, 60.0, -0.5, 0)
    h[464:467], h[624:628] = b"Box", b"Seen"
    struct.pack_into("<iI", h, 808, 4, 1)
    struct.pack_into("<QQ", h, 816, 1024 + len(blocks), len(starts))
    if subject:
        h[176:336] = sealed(h[176:336], crypto.mef2_key(subject))
    if session:
        h[352:864] = sealed(h[352:864], crypto.mef2_key(session))
    path.write_bytes(bytes(h) + blocks + np.asarray(index, "<u8").tobytes())


X = [-0.5 * v for v in (1, 2, 3, 3, 4, 4)]


def values(df):
    return [(r["t_us"], r["value"]) for r in df.orderBy("t_us").collect()]


def test_encrypted_mef2(spark, tmp_path):
    want = [(10_000_000 + 500_000 * i, v) for i, v in enumerate(X)]
    for n, (subject, session, data) in enumerate([(None, None, None), ("doctor", "recorder", "recorder"), (None, "recorder", "recorder"), ("doctor", None, None), ("fifteen letters", "recorder", None)]):
        f = tmp_path / f"f{n}.mef"
        mef2_file(f, [10_000_000], subject, session, data)
        for password in filter(None, {subject, session}):
            assert values(load(spark, "mef2", f, password=password)) == want
            row = mef.mef2_channels(spark, str(f), password).first()
            assert (row["samples"], row["name"], row["system"], row["notch"], row["study"]) == (6, "LFP1", "Box", 60.0, "Seen")
            opened = subject is None or password == subject
            assert (row["subject"], row["first_name"], row["second_name"]) == (("P07", "Anna", "Lind") if opened else (None, None, None))
        if session:
            for wrong in ("wrong", "", "recorder2"):
                with pytest.raises(Exception, match="password"):
                    load(spark, "mef2", f, password=wrong).count()
            with pytest.raises(Exception, match="password"):
                load(spark, "mef2", f).count()
        else:
            assert values(load(spark, "mef2", f)) == want


def test_mef2_blocks_and_names(spark, tmp_path):
    mef2_file(tmp_path / "A7.mef", [10_000_000, 13_000_000, 20_000_000], session="s", data="s", name=b"")
    rows = [tuple(r) for r in load(spark, "mef2_blocks", tmp_path, password="s").orderBy("block").collect()]
    assert rows == [("A7", 2.0, -0.5, 0, 10_000_000, 0, 6, 296, 1, 4, True), ("A7", 2.0, -0.5, 1, 13_000_000, 6, 6, 296, 1, 4, False), ("A7", 2.0, -0.5, 2, 20_000_000, 12, 6, 296, 1, 4, True)]
    assert len(values(load(spark, "mef2", tmp_path, password="s"))) == 18


# records of MEF 3

OFFSET = 1_500_000_000_000_000


def record(kind, t, body, level=0, key=None):
    body += bytes(-len(body) % 16)
    head = kind.encode() + b"\0" + struct.pack("<BBbIq", 1, 0, level, len(body), t)
    data = head + (sealed(body, key) if level else body)
    return struct.pack("<I", red.crc32_koopman(data)) + data


def put(folder, base, records, number, one=None, two=None):
    """A record file and its index in a folder, with the validation fields of the passwords."""
    folder.mkdir(parents=True, exist_ok=True)
    head = bytearray(1024)
    struct.pack_into("<i", head, 48, number)
    head[52:54], head[308:311] = b"c1", b"ses"
    validate(head, one, two)
    index, data = bytes(head), bytes(head)
    for r in records:
        index += r[4:12] + struct.pack("<qq", len(data), struct.unpack_from("<q", r, 16)[0])
        data += r
    (folder / f"{base}.rdat").write_bytes(data)
    (folder / f"{base}.ridx").write_bytes(index)


def validate(head, one, two):
    if one:
        head[868:884] = hashlib.sha256(one).digest()[:16]
    if two:
        head[884:900] = bytes(a ^ b for a, b in zip(hashlib.sha256(two).digest()[:16], one))


@pytest.fixture
def session(tmp_path):
    """Records of all levels and types, one sealed at each level, times with the recording's offset in a sealed section."""
    one, two = crypto.password_key("open"), crypto.password_key("sesame")
    s = tmp_path / "ses.mefd"
    seizure = struct.pack("<qqqii", -1_000_000, -4_000_000, 3_000_000, 2, 2) + b"first".ljust(128, b"\0") + b"second".ljust(128, b"\0") + "séance".encode().ljust(1024, b"\0")
    seizure += b"c1".ljust(256, b"\0") + struct.pack("<qq", -1_500_000, -1) + b"c2".ljust(256, b"\0") + struct.pack("<qq", -1, -3_000_000)
    electric = struct.pack("<ddqii", 2.5, 130.0, 90, 1, 2) + b"biphasic".ljust(128, b"\0") + b"c1".ljust(128, b"\0") + b"c2".ljust(128, b"\0")
    cognitive = b"memory".ljust(64, b"\0") + struct.pack("<q", 700) + b"image".ljust(64, b"\0") + b"yes".ljust(64, b"\0")
    put(s, "ses", [record("Note", -1_000_000, "Tag gut, ä".encode()), record("SyLg", -2_000_000, b"started", 1, one), record("Seiz", -3_000_000, seizure, 2, two)], -3, one, two)
    put(s / "c1.timd", "c1", [record("EDFA", -4_000_000, struct.pack("<q", 250) + b"spindle"), record("LNTP", -5_000_000, struct.pack("<q", 3) + struct.pack("<iii", 5, -6, 7))], -2, one, two)
    put(s / "c1.timd" / "c1-000004.segd", "c1-000004", [record("ESti", -6_000_000, electric), record("CSti", -7_000_000, cognitive), record("Abcd", -8_000_000, b"\x01\x02")], 4, one, two)
    m = bytearray(16384)
    validate(m, one, two)
    m[1024:1026] = bytes([1, 2])
    struct.pack_into("<q", m, 13312, OFFSET)
    m[2560:13312], m[13312:16384] = sealed(m[2560:13312], one), sealed(m[13312:16384], two)
    (s / "c1.timd" / "c1-000004.segd" / "c1-000004.tmet").write_bytes(bytes(m))
    return s


def test_records_by_type_and_level(spark, session):
    rows = {r["type"]: r for r in load(spark, "mef3_records", session, password="sesame", validate="true").collect()}
    assert len(rows) == 8 and all(r["readable"] and r["valid"] for r in rows.values())
    assert [rows[k]["t_us"] - OFFSET for k in ("Note", "SyLg", "Seiz", "EDFA", "LNTP", "ESti", "CSti", "Abcd")] == [1_000_000 * i for i in range(1, 9)]
    assert {k: (r["level"], r["session"], r["channel"], r["segment"], r["number"]) for k, r in rows.items() if k in ("Note", "LNTP", "CSti")} == {"Note": ("session", "ses", None, None, 0), "LNTP": ("channel", "ses", "c1", None, 1), "CSti": ("segment", "ses", "c1", 4, 1)}
    assert rows["Note"]["text"] == "Tag gut, ä" and rows["SyLg"]["text"] == "started" and rows["Note"]["version"] == "1.0"
    assert (rows["EDFA"]["duration_us"], rows["EDFA"]["text"], rows["LNTP"]["template"]) == (250, "spindle", [5, -6, 7])
    s = rows["Seiz"]["seizure"].asDict(recursive=True)
    assert s.pop("channels") == [{"name": "c1", "onset": OFFSET + 1_500_000, "offset": None}, {"name": "c2", "onset": None, "offset": OFFSET + 3_000_000}]
    assert s == {"earliest_onset": OFFSET + 1_000_000, "latest_offset": OFFSET + 4_000_000, "onset": "generalized", "marker_1": "first", "marker_2": "second", "annotation": "séance"} and rows["Seiz"]["duration_us"] == 3_000_000
    assert rows["ESti"]["electric"].asDict() == {"amplitude": 2.5, "frequency": 130.0, "pulse_width": 90, "unit": "mA", "mode": "voltage", "waveform": "biphasic", "anode": "c1", "cathode": "c2"}
    assert rows["CSti"]["cognitive"].asDict() == {"task_type": "memory", "stimulus_type": "image", "response": "yes"} and rows["CSti"]["duration_us"] == 700
    assert bytes(rows["Abcd"]["body"])[:2] == b"\x01\x02"


def test_records_stay_closed_without_their_password(spark, session):
    closed = lambda **o: {r["type"] for r in load(spark, "mef3_records", session, **o).where("not readable").collect()}
    assert closed() == closed(password="wrong") == {"SyLg", "Seiz"} and closed(password="open") == {"Seiz"} and closed(password="sesame") == set()
    row = load(spark, "mef3_records", session).where("type = 'Seiz'").first()
    assert row["seizure"] is None and len(row["body"]) == 1312 + 2 * 272 and row["t_us"] == -3_000_000 * -1


def test_records_chosen_by_the_index(spark, session, monkeypatch):
    pick = lambda **o: sorted(r["type"] for r in load(spark, "mef3_records", session, password="sesame", **o).collect())
    assert pick(start=str(OFFSET + 2_000_000), end=str(OFFSET + 4_000_000)) == ["Seiz", "SyLg"]
    assert pick(types="Note,EDFA") == ["EDFA", "Note"] and pick(types="None") == []
    (session / "ses.ridx").unlink()
    assert pick(types="Note,SyLg") == ["Note", "SyLg"] and pick(end=str(OFFSET + 3_000_000)) == ["Note", "SyLg"]
    data = bytearray((session / "ses.rdat").read_bytes())
    data[1024 + 30] ^= 1
    (session / "ses.rdat").write_bytes(bytes(data))
    assert {r["type"]: r["valid"] for r in load(spark, "mef3_records", session, validate="true", types="Note,SyLg").collect()} == {"Note": False, "SyLg": True}


def test_written_records_read_back(spark, session, tmp_path):
    """All types and levels, sealed ones too, in the same files as those laid out by hand."""
    load_all = lambda where: sorted((r["type"], str(r.asDict(recursive=True) | {"body": None})) for r in load(spark, "mef3_records", where, password="sesame", validate="true").collect())
    rows = load(spark, "mef3_records", session, password="sesame")
    files = mefrec.write_records(rows, str(tmp_path / "again"), ("open", "sesame")).collect()
    assert sorted((f["name"], f["records"]) for f in files) == [("ses.mefd/c1.timd/c1", 2), ("ses.mefd/c1.timd/c1-000004.segd/c1-000004", 3), ("ses.mefd/ses", 3)]
    assert load_all(tmp_path / "again") == load_all(session)
    assert {r["type"] for r in load(spark, "mef3_records", tmp_path / "again", password="open").where("not readable").collect()} == {"Seiz"}
    with pytest.raises(Exception, match="needs that level"):
        mefrec.write_records(rows, str(tmp_path / "no"), ("open", None)).collect()


def test_lossy_session(spark, tmp_path):
    x = np.rint(np.random.default_rng(5).normal(0, 300, 5000))
    r = spark.createDataFrame([("c", 100.0, 0, x[:3000].tolist()), ("c", 100.0, 90_000_000, x[3000:].tolist())], "channel_id string, rate double, lo long, values array<double>")
    mef.write_mef3(r, str(tmp_path / "s.mefd"), block=1000, residual=0.1).collect()
    mef.write_mef3(r, str(tmp_path / "w.mefd"), block=1000).collect()
    read = lambda name: np.asarray([v for _, v in values(load(spark, "mef3", tmp_path / name, validate="true"))])
    y, size = read("s.mefd"), lambda n: sum(f.stat().st_size for f in (tmp_path / n).rglob("*.tdat"))
    assert (read("w.mefd") == x).all() and (y != x).any() and size("s.mefd") < 0.8 * size("w.mefd")
    for a in range(0, 5000, 1000):
        v, w = x[a : a + 1000], y[a : a + 1000]
        assert 0.05 < np.mean(np.abs((v - w)[v != 0] / v[v != 0])) <= 0.1
