"""Many small files: their tasks read the headers, and the driver lists names and sizes only."""

import os

import numpy as np
import pytest

from sigloom.sources import base, blackrock, edf, mef, mefrec, moberg, nex, nicolet, openephys, persyst, plain, spike2, tdms

#: Formats, and the names of a recording's files.
FORMATS = [
    (persyst.Persyst, ("{0}/d.lay", "{0}/d.dat")),
    (moberg.Moberg, ("P{0},na,SampleSeries,Integer,dev,index", "P{0},na,SampleSeries,Integer,dev,data")),
    (mef.Mef2, ("{0}.mef",)),
    (blackrock.BlackrockElectrodes, ("{0}.nev", "{0}.ns2", "{0}.ccf")),
    (tdms.Tdms, ("{0}.tdms",)),
    (blackrock.BlackrockSpikes, ("{0}.nev", "{0}.ns2")),
    (plain.FeatherSeries, ("{0}.feather",)),
    (nicolet.Nicolet, ("{0}.e",)),
    (mef.Mef2Blocks, ("{0}.mef",)),
    (openephys.Continuous, ("{0}.continuous",)),
    (nex.NexContinuous, ("{0}.nex",)),
    (openephys.Spikes, ("{0}.spikes",)),
    (nex.NexSpikes, ("{0}.nex",)),
    (nicolet.NicoletEvents, ("{0}.e",)),
    (blackrock.Nsx, ("{0}.ns2",)),
    (blackrock.NevSpikes, ("{0}.nev",)),
    (edf.Edf, ("{0}.edf",)),
    (plain.InterleavedSamples, ("{0}.ts.bin",)),
    (plain.SpikeFile, ("{0}.ts.bin",)),
    (spike2.Spike2Events, ("{0}.smr",)),
    (mefrec.Mef3Records, ("{0}.mefd/r.rdat", "{0}.mefd/r.ridx")),
]


def put(root, name, content=b"not a recording"):
    (root / name).parent.mkdir(parents=True, exist_ok=True)
    (root / name).write_bytes(content)


@pytest.mark.parametrize("kind, names", FORMATS, ids=[k.NAME for k, _ in FORMATS])
def test_driver_opens_no_small_file(tmp_path, monkeypatch, kind, names):
    for k in range(300):
        for name in names:
            put(tmp_path, name.format(k))
    opened = []
    for module in (base, plain):
        monkeypatch.setattr(module, "open_file", lambda path: opened.append(path))
    parts = base.FormatReader(kind, {"path": str(tmp_path)}).partitions()
    assert not opened and 8 <= len(parts) <= 2 * base.LEAST and sum(len(p.info["works"]) for p in parts) == 300 * (2 if kind is blackrock.BlackrockElectrodes else 1)


def test_groups_keep_all_in_order_and_are_bounded():
    works = [(k, k % 7 * 1_000_000) for k in range(1000)]
    groups = base.shared_out(works)
    assert [w for g in groups for w in g] == list(range(1000))
    assert all(sum(works[w][1] + base.OPENING for w in g) <= base.SHARE for g in groups)
    assert base.shared_out([]) == [] and base.shared_out([("a", 5)]) == [["a"]]


def read(kind, path):
    reader = base.FormatReader(kind, {"path": str(path)})
    parts = reader.partitions()
    return len(parts), sorted(v for p in parts for b in reader.read(p) for v in b.column("value").to_pylist())


def test_large_files_are_split_as_before(tmp_path, monkeypatch):
    x = np.random.default_rng(0).normal(size=(6 * base.BATCH, 2))
    put(tmp_path, "a.ts.bin", x.tobytes())
    put(tmp_path, "b.ts.bin", x[:9].tobytes())
    whole = sorted(np.r_[x[:, 1], x[:9, 1]].tolist())
    assert read(plain.InterleavedSamples, tmp_path) == (2, whole)
    monkeypatch.setattr(base, "SHARE", 1 << 20)
    assert read(plain.InterleavedSamples, tmp_path) == (3, whole)


LAY = "[FileInfo]\nFile={0}.dat\nSamplingRate=100\nCalibration=1\nWaveformCount=1\nDataType=0\n[SampleTimes]\n0=0.0\n[ChannelMap]\nA{0}=1\n"


def test_persyst_data_in_other_folders(tmp_path):
    for k in range(3):
        put(tmp_path, f"lay/{k}.lay", LAY.format(k).encode())
        put(tmp_path, f"dat/{k}.dat", np.asarray([k, 10 + k], "<i2").tobytes())
    assert read(persyst.Persyst, tmp_path)[1] == [0, 1, 2, 10, 11, 12]
    put(tmp_path, "lay/9.dat", np.asarray([99], "<i2").tobytes())
    assert read(persyst.Persyst, tmp_path)[1] == [0, 1, 2, 10, 11, 12]
    os.remove(tmp_path / "dat/1.dat")
    assert read(persyst.Persyst, tmp_path)[1] == [0, 2, 10, 12, 99]
    assert read(persyst.Persyst, tmp_path / "lay/0.lay")[1] == [99]
