"""Archives read in place and unpacked, nested ones too."""

import gzip
import io
import struct
import tarfile

import numpy as np
import pyarrow as pa
import pyarrow.feather
import pytest

from sigloom import sources
from sigloom.sources import archives, base, nex, nicolet, plain
from test_mef import X, mef2_file


@pytest.fixture(scope="module", autouse=True)
def formats(spark):
    sources.register(spark)


def tar(path, files, mode="w"):
    with tarfile.open(path, mode) as t:
        for name, data in files.items():
            entry = tarfile.TarInfo(name)
            entry.size = len(data)
            t.addfile(entry, io.BytesIO(data))


def pairs(n, by=1.0):
    return np.stack([np.arange(n) * 1000.0, np.arange(n) * by], axis=1).astype("<f8").tobytes()


def test_members_are_read_in_place(spark, tmp_path):
    tar(tmp_path / "a.tar", {"./x/one.ts.bin": pairs(5), "x/._one.ts.bin": b"fork", "x/" + "long" * 60 + ".ts.bin": pairs(3, 2.0)})
    (tmp_path / "two.ts.bin").write_bytes(pairs(2))
    files = base.list_files(str(tmp_path))
    assert sum("!/" in f for f in files) == 2 and len(files) == 3
    inside = next(f for f in files if f.endswith("x/one.ts.bin"))
    assert base.file_size(inside) == 80 and base.read_at(inside, 16, 16) == pairs(5)[16:32] and base.read_at(inside, 64) == pairs(5)[64:] and base.read_at(inside, 72, 100) == pairs(5)[72:]
    rows = spark.read.format("interleaved_samples").option("rate", "1000").load(str(tmp_path)).collect()
    assert len(rows) == 10 and sum(r["value"] for r in rows if r["channel"].startswith("long")) == 6
    assert spark.read.format("interleaved_samples").load(str(tmp_path / "a.tar")).count() == 8


def test_sessions_in_archives(spark, tmp_path):
    mef2_file(tmp_path / "m.mef", [10_000_000], session="s", data="s")
    data = (tmp_path / "m.mef").read_bytes()
    for name, files, mode in (("a.tar", {"s/m.mef": data}, "w"), ("b.tgz", {"s/m.mef": data}, "w:gz"), ("c.tar.bz2", {"s/m.mef.gz": gzip.compress(data)}, "w:bz2"), ("d.tar", {"s/m.mef.gz": gzip.compress(data)}, "w")):
        folder = tmp_path / name.split(".")[0]
        folder.mkdir()
        tar(folder / name, files, mode)
        where = str(folder) if name == "a.tar" else archives.unpacked(spark, str(folder))
        rows = spark.read.format("mef2").option("password", "s").load(where).orderBy("t_us").collect()
        assert [r["value"] for r in rows] == X, name


def test_unpacking_names_and_plain_files(spark, tmp_path):
    (tmp_path / "in" / "deep").mkdir(parents=True)
    (tmp_path / "in" / "deep" / "a.txt.gz").write_bytes(gzip.compress(b"alpha" * 1000))
    (tmp_path / "in" / "b.txt").write_bytes(b"beta")
    tar(tmp_path / "in" / "c.tar.xz", {"._x": b"fork", "x/y.bin": b"\0" * 3_000_000}, "w:xz")
    got = sorted((r["name"], r["bytes"]) for r in archives.unpack(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect())
    assert got == [("b.txt", 4), ("deep/a.txt", 5000), ("x/y.bin", 3_000_000)] and (tmp_path / "out" / "deep" / "a.txt").read_bytes() == b"alpha" * 1000
    (tmp_path / "bad").mkdir()
    tar(tmp_path / "bad" / "e.tar", {"../out.txt": b"x"})
    with pytest.raises(Exception, match="leads out"):
        archives.unpacked(spark, str(tmp_path / "bad"))


def test_feather_in_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(plain.FeatherSeries, "BATCHES", 2)
    t = pa.table({"index": np.arange(0, 7000, 1000), " a ": [1.0, None, 3, 4, 5, 6, 7], "b": np.arange(7)})
    pyarrow.feather.write_feather(t, tmp_path / "x.feather", chunksize=2)
    assert [p.info["batches"] for p in plain.FeatherSeries.plan(str(tmp_path), {}) if p.info["column"] == "b"] == [(0, 2), (2, 4)]
    rows = sorted((r["channel"], r["t_us"], r["value"], r["rate"]) for r in spark.read.format("feather_series").load(str(tmp_path)).collect())
    assert rows == [("a", 1000 * i, i + 1.0, 1000.0) for i in range(7) if i != 1] + [("b", 1000 * i, float(i), 1000.0) for i in range(7)]


def test_long_variables_are_split(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(nex, "PIECE", 3)
    h, v = np.zeros(1, nex.FILE), np.zeros(2, nex.VARIABLE)
    h["magic"], h["frequency"], h["n"] = 827868494, 1000.0, 2
    at = h.nbytes + v.nbytes
    x, starts = np.arange(8, dtype="<i2"), np.asarray([100, 900], "<i4")
    first = starts.tobytes() + np.asarray([0, 5], "<i4").tobytes() + x.tobytes()
    v["name"], v["type"], v["at"], v["count"], v["rate"], v["to_mv"], v["points"] = [b"c", b"n"], [nex.CONTINUOUS, nex.EVENT], [at, at + len(first)], [2, 5], [10.0, 0], [0.5, 0], [8, 0]
    events = np.arange(10, 60, 10, dtype="<i4").tobytes()
    (tmp_path / "x.nex").write_bytes(h.tobytes() + v.tobytes() + first + events)
    assert len(nex.NexContinuous.plan(str(tmp_path), {})) == 3 and len(nex.NexEvents.plan(str(tmp_path), {})) == 2
    rows = [(r["t_us"], r["value"]) for r in spark.read.format("nex_continuous").load(str(tmp_path)).orderBy("value").collect()]
    assert rows == [(100_000 + 100_000 * i, i / 2) for i in range(5)] + [(900_000 + 100_000 * i, (5 + i) / 2) for i in range(3)]
    assert sorted(r["t_us"] for r in spark.read.format("nex_events").load(str(tmp_path)).collect()) == [10_000 * i for i in range(1, 6)]


def test_nicolet_channels_are_split(monkeypatch):
    monkeypatch.setattr(nicolet, "PIECE", 4)
    layout = type("L", (), {"channels": lambda s: [[(1000, 10), (2000, 18)]], "series": lambda s: [{"label": "c", "rate": 2.0, "resolution": 1.0}], "segments": lambda s: [(0, 3.0), (9, 4.0)]})
    monkeypatch.setattr(nicolet, "Layout", lambda f: layout())
    monkeypatch.setattr(nicolet, "list_files", lambda p: ["a.e"])
    cuts = [(p.info["start"], p.info["first"], p.info["at"], p.info["size"]) for p in nicolet.Nicolet.plan("x", {})]
    assert cuts == [(0, 0, 1000, 4), (0, 4, 1008, 1), (0, 5, 2000, 1), (9, 0, 2002, 4), (9, 4, 2010, 4)]
    assert struct.calcsize("<h") == 2
