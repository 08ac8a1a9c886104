"""Queries of the sources and sinks, with their SQL: recordings are written from orders in the shared folder and read back.

A file holds a thousand keys of orders: `f` is the file, `i` the position in it and
`k0` the first key. Executors write the files, one at a time, each of bounded size.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import os
import struct
import tarfile
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.feather
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom import sources
from sigloom.functions import crypto, red
from sigloom.operators import blocks, export, filesets, wire
from sigloom.session import scratch, ship, table
from sigloom.sources import archives, blackrock, edf, mef, mefmeta, moberg, nex, nicolet, openephys, plain, spike2
from sigloom.sources.base import filesystem

#: Keys in a file.
KEYS = 1000
#: 2000-01-01 in microseconds, the start of recordings whose format holds a date.
START = 946_684_800_000_000
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Orders by file in SQL.
O = f"""o AS (SELECT *, o_orderkey // {KEYS} AS f, min(o_orderkey) OVER (PARTITION BY o_orderkey // {KEYS}) AS k0,
    row_number() OVER (PARTITION BY o_orderkey // {KEYS} ORDER BY o_orderkey) - 1 AS i FROM orders)"""


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = f"WITH {O} {sql}"
        return f

    return add


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return o.withColumn("f", F.floor(F.col("o_orderkey") / KEYS).cast("long"))


def _written(spark: SparkSession, sf_dir: str, suffix: str, encode: Callable[[int, pd.DataFrame], bytes | dict[str, bytes]]) -> str:
    """A folder with the file (or files by name) that `encode` makes of each thousand keys; a repeated task writes the same again."""
    ship(spark)
    sources.register(spark)
    root = scratch(spark, "recording")

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("o_orderkey")
        f = int(pdf["f"].iloc[0])
        fs, folder = filesystem(root)
        data = encode(f, pdf)
        for name, content in data.items() if isinstance(data, dict) else [(f"f{f}{suffix}", data)]:
            fs.create_dir(os.path.dirname(f"{folder}/{name}"), recursive=True)
            with fs.open_output_stream(f"{folder}/{name}", compression=None) as out:
                out.write(content)
        return pd.DataFrame({"f": [f], "n": [len(pdf)]})

    _orders(spark, sf_dir).groupBy("f").applyInPandas(write, "f long, n long").agg(F.sum("n")).collect()
    return root


def _custom(pdf: pd.DataFrame, below: int) -> np.ndarray:
    return (pdf["o_custkey"] % below).to_numpy(np.int64)


@query("SELECT 'f' || f AS channel, 1000.0::DOUBLE AS rate, o_orderkey * 1000 AS t_us, o_totalprice AS value FROM o")
def interleaved_samples(spark, sf_dir):
    path = _written(spark, sf_dir, ".ts.bin", lambda f, p: np.stack([p["o_orderkey"] * 1000.0, p["o_totalprice"]], axis=1).astype("<f8").tobytes())
    return spark.read.format("interleaved_samples").option("rate", "1000").load(path).select("channel", "rate", "t_us", "value")


def _tar(files: dict[str, bytes], mode: str = "w") -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode=mode) as t:
        for name, data in files.items():
            entry = tarfile.TarInfo(name)
            entry.size = len(data)
            t.addfile(entry, io.BytesIO(data))
    return out.getvalue()


def _pairs(p: pd.DataFrame) -> bytes:
    return np.stack([p["o_orderkey"] * 1000.0, p["o_totalprice"]], axis=1).astype("<f8").tobytes()


@query("SELECT 'f' || f AS channel, o_orderkey * 1000 AS t_us, o_totalprice AS value FROM o")
def tar_members(spark, sf_dir):
    """Interleaved samples in uncompressed archives, read in place; a resource fork beside them isn't."""
    path = _written(spark, sf_dir, ".tar", lambda f, p: _tar({f"in/._f{f}.ts.bin": b"fork", f"in/f{f}.ts.bin": _pairs(p)}))
    return spark.read.format("interleaved_samples").load(path).select("channel", "t_us", "value")


@query("SELECT 'f' || f AS channel, o_orderkey * 1000 AS t_us, o_totalprice AS value FROM o")
def nested_archives(spark, sf_dir):
    """The same files, compressed within archives, every other archive compressed too, unpacked to the shared folder."""

    def encode(f, p):
        inner = {f"in/f{f}.ts.bin.gz": gzip.compress(_pairs(p), mtime=0)}
        return {f"a{f}.tar.gz" if f % 2 else f"a{f}.tar": _tar(inner, "w:gz" if f % 2 else "w")}

    path = archives.unpacked(spark, _written(spark, sf_dir, "", encode))
    return spark.read.format("interleaved_samples").load(path).select("channel", "t_us", "value")


@query("SELECT 'f' || f AS channel, o_orderkey * 1000 AS t_us, (o_custkey % 5)::SMALLINT AS unit, o_totalprice AS w0, o_custkey::DOUBLE AS w1 FROM o")
def spike_files(spark, sf_dir):
    def encode(f, p):
        s = np.zeros(len(p), plain.SPIKE)
        s["t"], s["unit"] = p["o_orderkey"] * 1000, _custom(p, 5)
        return struct.pack("<qqq", plain.SPIKE.itemsize * len(p), len(p), 2) + s.tobytes() + p[["o_totalprice", "o_custkey"]].to_numpy("<f8").tobytes()

    rows = spark.read.format("spike_file").load(_written(spark, sf_dir, ".ts.bin", encode))
    return rows.select("channel", "t_us", "unit", F.col("waveform")[0].alias("w0"), F.col("waveform")[1].alias("w1"))


def _edf(f: int, p: pd.DataFrame) -> bytes:
    """EDF+C of a second a record: two signals of a sample each, in steps of a half, and a note."""
    fields = {"label": (f"A{f}", f"B{f}", edf.ANNOTATIONS), "unit": ("uV", "mV", ""), "pmin": (-16384,) * 3, "pmax": (16383.5,) * 3, "dmin": (-32768,) * 3, "dmax": (32767,) * 3, "samples": (1, 1, 32)}
    head = "0".ljust(168) + "01.01.0000.00.00" + "1024".ljust(8) + "EDF+C".ljust(44) + f"{len(p):<8}{1:<8}{3:<4}"
    for name, width in edf.FIELDS:
        head += "".join(str(v).ljust(width) for v in fields.get(name, ("",) * 3))
    notes = [f"+{i}\x14\x14\0+{i}\x14n{k}\x14\0".encode().ljust(64, b"\0") for i, k in enumerate(p["o_orderkey"])]
    pairs = np.stack([_custom(p, 30000), -_custom(p, 1000)], axis=1).astype("<i2")
    return head.encode() + b"".join(x.tobytes() + n for x, n in zip(pairs, notes))


@query(f"SELECT 'A' || f AS channel, 'uV' AS unit, 1.0::DOUBLE AS rate, {START} + i * 1000000 AS t_us, o_custkey % 30000 / 2 AS value FROM o UNION ALL SELECT 'B' || f, 'mV', 1.0::DOUBLE, {START} + i * 1000000, -(o_custkey % 1000) / 2 FROM o")
def edf_samples(spark, sf_dir):
    return spark.read.format("edf").load(_written(spark, sf_dir, ".edf", _edf))


@query(f"SELECT 'annotation' AS type, {START} + i * 1000000 AS t_us, 'n' || o_orderkey AS label FROM o")
def edf_notes(spark, sf_dir):
    return spark.read.format("edf_annotations").load(_written(spark, sf_dir, ".edf", _edf)).select("type", "t_us", "label")


@query(f"SELECT 'a' || f AS channel, 'uV' AS unit, 1000.0::DOUBLE AS rate, {START} + i * 1000 AS t_us, o_custkey % 30000 / 2 AS value FROM o UNION ALL SELECT 'b' || f, 'uV', 1000.0::DOUBLE, {START} + i * 1000, (o_custkey % 1000) / 2 FROM o")
def nsx_samples(spark, sf_dir):
    def encode(f, p):
        h, c = np.zeros(1, blackrock.BASIC), np.zeros(2, blackrock.CHANNEL)
        h["id"], h["spec"], h["bytes"], h["period"], h["resolution"], h["n"] = b"NEURALCD", (2, 3), h.itemsize + 2 * c.itemsize, 30, 30000, 2
        h["origin"] = (2000, 1, 6, 1, 0, 0, 0, 0)
        c["type"], c["id"], c["label"], c["unit"] = b"CC", [1, 2], [f"a{f}".encode(), f"b{f}".encode()], b"uV"
        c["min_dig"], c["max_dig"], c["min_ana"], c["max_ana"] = -1000, 1000, -500, 500
        x = np.stack([_custom(p, 30000), _custom(p, 1000)], axis=1).astype("<i2")
        return h.tobytes() + c.tobytes() + struct.pack("<BII", 1, 0, len(x)) + x.tobytes()

    return spark.read.format("nsx").load(_written(spark, sf_dir, ".ns2", encode))


@query(f"SELECT 'e' || f AS channel, {START} + i * 1000000 AS t_us, (o_custkey % 16)::SMALLINT AS unit, (o_custkey % 30000) / 4 AS w0, -(o_custkey % 1000) / 4 AS w1 FROM o")
def nev_spikes(spark, sf_dir):
    def encode(f, p):
        h, w = np.zeros(1, blackrock.NEV), np.zeros(1, blackrock.WAVE)
        h["id"], h["spec"], h["bytes"], h["packet"], h["resolution"], h["n"], h["origin"] = b"NEURALEV", (2, 3), 336 + 64, 12, 30000, 2, (2000, 1, 6, 1, 0, 0, 0, 0)
        w["id"], w["factor"], w["bytes"] = 3, 250, 2
        x = np.zeros(len(p), np.dtype([("t", "<u4"), ("id", "<u2"), ("unit", "u1"), ("pad", "u1"), ("w", "<i2", 2)]))
        x["t"], x["id"], x["unit"] = np.arange(len(p)) * 30000, 3, _custom(p, 16)
        x["w"] = np.stack([_custom(p, 30000), -_custom(p, 1000)], axis=1)
        return h.tobytes() + b"NEUEVWAV" + w.tobytes() + b"NEUEVLBL" + struct.pack("<H16s6s", 3, f"e{f}".encode(), b"") + x.tobytes()

    rows = spark.read.format("nev_spikes").load(_written(spark, sf_dir, ".nev", encode))
    return rows.select("channel", "t_us", "unit", F.col("waveform")[0].alias("w0"), F.col("waveform")[1].alias("w1"))


def _blackrock(spark: SparkSession, sf_dir: str) -> str:
    """A set of files for each thousand keys: spikes of electrodes 1 to 3 in units 0 to 4, two analog files, settings for every third."""

    def encode(f, p):
        h, w = np.zeros(1, blackrock.NEV), np.zeros(3, blackrock.WAVE)
        h["id"], h["spec"], h["bytes"], h["packet"], h["resolution"], h["n"], h["origin"] = b"NEURALEV", (2, 3), 336 + 96, 12, 30000, 3, (2000, 1, 6, 1, 0, 0, 0, 0)
        w["id"], w["factor"], w["bytes"], w["units"] = [1, 2, 3], 250, 2, 4
        x = np.zeros(len(p), np.dtype([("t", "<u4"), ("id", "<u2"), ("unit", "u1"), ("pad", "u1"), ("w", "<i2", 2)]))
        x["t"], x["id"], x["unit"] = np.arange(len(p)) * 30000, 1 + _custom(p, 3), (p["o_orderkey"] % 5).to_numpy()
        out = {f"s{f}.nev": h.tobytes() + b"".join(b"NEUEVWAV" + v.tobytes() for v in w) + x.tobytes()}
        for k, n in ((2, 2), (5, 1)):
            b, c = np.zeros(1, blackrock.BASIC), np.zeros(n, blackrock.CHANNEL)
            b["id"], b["spec"], b["bytes"], b["period"], b["resolution"], b["n"], b["origin"] = b"NEURALCD", (2, 3), b.itemsize + c.nbytes, 30, 30000, n, (2000, 1, 6, 1, 0, 0, 0, 0)
            c["type"], c["id"], c["label"], c["unit"], c["max_dig"], c["max_ana"] = b"CC", 1 + np.arange(n), [f"a{f}-{i}".encode() for i in range(n)], b"uV", 1000, 500
            out[f"s{f}.ns{k}"] = b.tobytes() + c.tobytes() + struct.pack("<BII", 1, 0, len(p)) + np.zeros((len(p), n), "<i2").tobytes()
        return out | ({f"s{f}.ccf": b"settings"} if f % 3 == 0 else {})

    return _written(spark, sf_dir, "", encode)


def _set_name(rows: DataFrame) -> DataFrame:
    return rows.withColumn("recording", F.element_at(F.split("recording", "/"), -1))


@query("SELECT DISTINCT 's' || f AS recording, '2,5' AS nsx, TRUE AS nev, f % 3 = 0 AS ccf FROM o")
def blackrock_files(spark, sf_dir):
    """Which files each recording has."""
    sets = filesets.available(filesets.file_sets(spark.read.format("blackrock_files").load(_blackrock(spark, sf_dir))))
    return _set_name(sets).select("recording", F.concat_ws(",", F.transform("nsx", lambda n: n.cast("string"))).alias("nsx"), "nev", "ccf")


@query("""SELECT 's' || f AS recording, (1 + o_custkey % 3)::INTEGER AS channel_id, (o_orderkey % 5)::INTEGER AS unit, i // 300 AS segment, count(*) AS spikes, START_US + min(i) * 1000000 AS first_us, START_US + max(i) * 1000000 AS last_us
    FROM o GROUP BY ALL""".replace("START_US", str(START)))
def spike_trains(spark, sf_dir):
    """Every unit that has spikes (9 is asked for too, but has none), and its spikes in segments of 300 seconds."""
    path = _blackrock(spark, sf_dir)
    spikes = spark.read.format("blackrock_spikes").load(path)
    found = filesets.units(spikes)
    asked = found.select("recording", "channel_id", F.explode(F.array("unit", F.lit(9))).alias("unit"))
    bounds = spikes.groupBy("recording").agg(F.min("t_us").alias("a"), F.max("t_us").alias("b")).withColumn("segment", F.explode(F.expr("sequence(0L, (b - a) div 300000000L)")))
    segments = bounds.select("recording", "segment", (F.lit(START) + F.col("segment") * 300_000_000).alias("lo"), (F.lit(START) + (F.col("segment") + 1) * 300_000_000).alias("hi"))
    return _set_name(filesets.spike_trains(spikes, filesets.existing(asked, found), segments))


@query("""SELECT 's' || f AS recording, e AS channel_id, 'chan' || e AS label, CASE WHEN e = 1 THEN 2 WHEN e = 2 THEN 1 ELSE 0 END AS analog, count(DISTINCT o_orderkey % 5)::INTEGER AS units, count(*)::BIGINT AS spikes FROM (SELECT *, (1 + o_custkey % 3)::INTEGER AS e FROM o) GROUP BY f, e""")
def channel_groups(spark, sf_dir):
    """Electrodes with their analog signals and units."""
    path = _blackrock(spark, sf_dir)
    groups = filesets.channel_groups(spark.read.format("blackrock_channels").load(path), filesets.units(spark.read.format("blackrock_spikes").load(path)))
    spikes = F.aggregate("units", F.lit(0).cast("long"), lambda a, u: a + u["spikes"])
    rows = _set_name(groups).select("recording", "channel_id", "label", F.coalesce(F.size("analog"), F.lit(0)).alias("analog"), F.size("units").alias("units"), spikes.alias("spikes"))
    return rows.where("spikes is not null").withColumn("analog", F.greatest("analog", F.lit(0)))


@query(f"SELECT 'c' || f AS channel, 1000.0::DOUBLE AS rate, {START} + i * 1000 AS t_us, (o_custkey % 30000) / 2 AS value FROM o")
def openephys_continuous(spark, sf_dir):
    def encode(f, p):
        fields = {"format": "'Open Ephys Data Format'", "date_created": "'01-Jan-2000 000000'", "channel": f"'c{f}'", "sampleRate": 1000, "blockLength": 1, "bitVolts": 0.5, "description": "'continuous'"}
        r = np.zeros(len(p), np.dtype([("t", "<i8"), ("n", "<u2"), ("recording", "<u2"), ("x", ">i2"), ("marker", "u1", 10)]))
        r["t"], r["n"], r["x"] = np.arange(len(p)), 1, _custom(p, 30000)
        return "".join(f"header.{k} = {v};\n" for k, v in fields.items()).encode().ljust(1024) + r.tobytes()

    return spark.read.format("openephys_continuous").load(_written(spark, sf_dir, ".continuous", encode)).select("channel", "rate", "t_us", "value")


@query(f"SELECT 'T' || f || '-0' AS channel, {START} + i * 1000000 AS t_us, (o_custkey % 5)::SMALLINT AS unit, (o_custkey % 30000)::DOUBLE / 1000.0::DOUBLE AS w0, (-(o_orderkey % 1000))::DOUBLE / 1000.0::DOUBLE AS w1 FROM o")
def openephys_spikes(spark, sf_dir):
    def encode(f, p):
        fields = {"format": "'Open Ephys Data Format'", "date_created": "'01-Jan-2000 000000'", "electrode": f"'T{f}'", "num_channels": 1, "sampleRate": 1000, "description": "'spike'"}
        r = np.zeros(len(p), openephys.spike_type(1))
        r["stamp"], r["gain"], r["sorted"] = np.arange(len(p)) * 1000, 1.0, _custom(p, 5)
        r["w"][:, 0, 0], r["w"][:, 0, 1] = 32768 + _custom(p, 30000), 32768 - (p["o_orderkey"] % 1000)
        return "".join(f"header.{k} = {v};\n" for k, v in fields.items()).encode().ljust(1024) + r.tobytes()

    rows = spark.read.format("openephys_spikes").load(_written(spark, sf_dir, ".spikes", encode))
    return rows.select("channel", "t_us", "unit", F.col("waveform")[0].alias("w0"), F.col("waveform")[1].alias("w1"))


@query("SELECT 'A' || f AS channel, 100.0::DOUBLE AS rate, f * 100000000 + i * 10000 AS t_us, (o_custkey % 30000) / 2 AS value FROM o UNION ALL SELECT 'B' || f, 100.0::DOUBLE, f * 100000000 + i * 10000, (o_custkey % 1000) / 2 FROM o")
def persyst_samples(spark, sf_dir):
    """Two interleaved channels a recording; each is a folder of a layout and its data."""

    def encode(f, p):
        lay = f"[FileInfo]\nFile=d.dat\nFileType=Interleaved\nSamplingRate=100\nHeaderLength=0\nCalibration=0.5\nWaveformCount=2\nDataType=0\n[SampleTimes]\n0={100 * f}.0\n[ChannelMap]\nA{f}=1\nB{f}=2\n"
        return {f"p{f}/d.lay": lay.encode(), f"p{f}/d.dat": np.stack([_custom(p, 30000), _custom(p, 1000)], axis=1).astype("<i2").tobytes()}

    return spark.read.format("persyst").load(_written(spark, sf_dir, "", encode)).select("channel", "rate", "t_us", "value")


def _nex(f: int, p: pd.DataFrame) -> bytes:
    """A continuous variable of one fragment, and a neuron's waveforms of two points."""
    h, v = np.zeros(1, nex.FILE), np.zeros(2, nex.VARIABLE)
    h["magic"], h["frequency"], h["n"] = 827868494, 1000.0, 2
    cont = struct.pack("<ii", 1000 * f, 0) + _custom(p, 30000).astype("<i2").tobytes()
    waves = (np.arange(len(p)) * 10).astype("<i4").tobytes() + np.stack([_custom(p, 30000), -_custom(p, 1000)], axis=1).astype("<i2").tobytes()
    at = h.nbytes + v.nbytes
    v["type"], v["name"], v["count"], v["points"] = [nex.CONTINUOUS, nex.WAVEFORM], [f"c{f}".encode(), f"n{f}".encode()], [1, len(p)], [len(p), 2]
    v["at"], v["to_mv"], v["rate"], v["unit"] = [at, at + len(cont)], 0.5, 100.0, 3
    return h.tobytes() + v.tobytes() + cont + waves


@query("SELECT 'c' || f AS channel, 'mV' AS unit, 100.0::DOUBLE AS rate, f * 1000000 + i * 10000 AS t_us, (o_custkey % 30000) / 2 AS value FROM o")
def nex_samples(spark, sf_dir):
    return spark.read.format("nex_continuous").load(_written(spark, sf_dir, ".nex", _nex))


@query("SELECT 'n' || f AS channel, i * 10000 AS t_us, 3::SMALLINT AS unit, (o_custkey % 30000) / 2 AS w0, -(o_custkey % 1000) / 2 AS w1 FROM o")
def nex_spikes(spark, sf_dir):
    rows = spark.read.format("nex_spikes").load(_written(spark, sf_dir, ".nex", _nex))
    return rows.select("channel", "t_us", "unit", F.col("waveform")[0].alias("w0"), F.col("waveform")[1].alias("w1"))


@query("SELECT 'a' || f AS channel, 'uV' AS unit, 1000.0::DOUBLE AS rate, f * 1000000 + i * 1000 AS t_us, o_totalprice AS value FROM o UNION ALL SELECT 'b' || f, 'V', 1000.0::DOUBLE, f * 1000000 + i * 1000, o_custkey::DOUBLE FROM o")
def tdms_samples(spark, sf_dir):
    """Two channels of a group, one with a unit, and one that is decimated and so left out."""

    def encode(f, p):
        text = lambda s: struct.pack("<I", len(s)) + s.encode()
        prop = lambda k, kind, v: text(k) + struct.pack("<I", kind) + v

        def channel(name, *more):
            props = [prop("wf_increment", 10, struct.pack("<d", 0.001)), prop("wf_start_time", 0x44, struct.pack("<Qq", 0, 2_082_844_800 + f)), *more]
            return text(f"/'g'/'{name}{f}'") + struct.pack("<IIIQ", 20, 10, 1, len(p)) + struct.pack("<I", len(props)) + b"".join(props)

        meta = struct.pack("<I", 4) + text("/") + struct.pack("<II", 0xFFFFFFFF, 0) + channel("a", prop("unit_string", 0x20, text("uV"))) + channel("b") + channel("c", prop("DecimationLevel", 3, struct.pack("<i", 2)))
        raw = b"".join(p[c].to_numpy("<f8").tobytes() for c in ("o_totalprice", "o_custkey", "o_custkey"))
        return b"TDSm" + struct.pack("<IIQQ", 2 | 4 | 8, 4713, len(meta) + len(raw), len(meta)) + meta + raw

    return spark.read.format("tdms").load(_written(spark, sf_dir, ".tdms", encode)).select("channel", "unit", "rate", "t_us", "value")


@query("SELECT 'P' || f AS channel, 'mmHg' AS unit, 125.0::DOUBLE AS rate, CASE WHEN i < 300 THEN k0 * 1000000 + i * 8000 ELSE k0 * 1000000 + 9000000 + (i - 300) * 8000 END AS t_us, (o_custkey - o_orderkey) / 2 AS value FROM o")
def moberg_samples(spark, sf_dir):
    """Series of 24-bit numbers, or of 32-bit ones where these don't hold a file's values, in two runs; each is an index, data and settings."""

    def encode(f, p):
        base, k0 = f"P{f},na,SampleSeries,Integer,dev,", int(p["o_orderkey"].iloc[0]) * 1_000_000
        runs = np.zeros(2 if len(p) > 300 else 1, moberg.INDEX)
        values = (p["o_custkey"] - p["o_orderkey"]).tolist()
        code = 5 if -(1 << 23) <= min(values) and max(values) < 1 << 23 else 4
        runs["first"], runs["clock"], runs["whole"], runs["format"] = [0, 300][: len(runs)], [k0, k0 + 9_000_000][: len(runs)], 8000, code
        x = b"".join(v.to_bytes(moberg.WIDTH[code], "little", signed=True) for v in values)
        return {f"{base}index": runs.tobytes(), f"{base}data": x, f"{base}settings": b"<r><Units>mmHg</Units><SampleConversion>-10,10,-5,5</SampleConversion></r>"}

    return spark.read.format("moberg").load(_written(spark, sf_dir, "", encode))


@query("SELECT 't' || f AS label, i * 50 AS t_us FROM o")
def spike2_events(spark, sf_dir):
    def encode(f, p):
        h, c = np.zeros(1, spike2.FILE), np.zeros(1, spike2.CHANNEL)
        h["system"], h["us_per_time"], h["time_base"], h["channels"] = 8, 10, 1e-6, 1
        name = f"t{f}".encode()
        c["kind"], c["blocks"], c["first"] = 2, 1, h.nbytes + c.nbytes
        c["title"] = np.void(bytes([len(name)]) + name.ljust(9, b"\0"))
        return h.tobytes() + c.tobytes() + struct.pack("<iiiihh", -1, -1, 0, 0, 1, len(p)) + (np.arange(len(p)) * 5).astype("<i4").tobytes()

    return spark.read.format("spike2_events").load(_written(spark, sf_dir, ".smr", encode)).select("label", "t_us")


@query("SELECT CASE WHEN f % 10 = 3 THEN 'third' ELSE 'c' || f % 10 END AS channel_id, k0 * 1000000 AS lo, count(*) AS n FROM o GROUP BY f, k0")
def channel_rename(spark, sf_dir):
    """Stored ranges after a channel's name has changed."""
    return wire.rename_channel(_ranges(spark, sf_dir), "c3", "third").select("channel_id", "lo", F.size("values").cast("long").alias("n"))


@query("SELECT 'v' || f AS channel, o_orderkey * 1000 AS t_us, o_totalprice AS value FROM o WHERE o_custkey % 3 > 0")
def feather_series(spark, sf_dir):
    def encode(f, p):
        out = io.BytesIO()
        pa.feather.write_feather(pa.table({"index": p["o_orderkey"].to_numpy() * 1000, f"v{f}": p["o_totalprice"].where(p["o_custkey"] % 3 > 0).to_numpy()}), out)
        return out.getvalue()

    return spark.read.format("feather_series").load(_written(spark, sf_dir, ".feather", encode)).select("channel", "t_us", "value")


def _mef2(starts: Callable[[int, np.ndarray], np.ndarray], size: int, password: str | None = None) -> Callable[[int, pd.DataFrame], bytes]:
    """MEF 2 files of blocks of `size` samples at 1 Hz, in steps of a half; starts(first key, first positions) are the blocks' times, in seconds."""

    def encode(f, p):
        x, at = _custom(p, 30000), np.arange(0, len(p), size)
        times = starts(int(p["o_orderkey"].iloc[0]), at).tolist()
        data, index = b"", []
        for k, (a, t) in enumerate(zip(at.tolist(), times)):
            b = red.encode_mef2(t * 1_000_000, x[a : a + size], k == 0 or t > times[k - 1] + size)
            if password:
                b = b[:31] + crypto.encrypt_block(b[31:47], crypto.mef2_key(password)) + b[47:]
            index.append((t * 1_000_000, 1024 + len(data), a))
            data += b + bytes(-len(b) % 8)
        h, name = bytearray(1024), f"m{f}".encode()
        h[376 : 376 + len(name)] = name
        struct.pack_into("<QQQdd", h, 408, index[0][0], index[-1][0], 0, 0.0, 0.0)
        struct.pack_into("<Q", h, 368, len(x))
        struct.pack_into("<d", h, 424, 1.0)
        struct.pack_into("<d", h, 456, 0.5)
        struct.pack_into("<QQ", h, 816, 1024 + len(data), len(index))
        if password:
            h[161:163] = b"\1\1"
            h[352 : 353 + len(password)] = bytes([len(password)]) + password.encode()
            h[352:864] = b"".join(crypto.encrypt_block(bytes(h[k : k + 16]), crypto.mef2_key(password)) for k in range(352, 864, 16))
        return bytes(h) + data + np.asarray(index, "<u8").tobytes()

    return encode


@query("SELECT 'm' || f AS channel, 1.0::DOUBLE AS rate, k0 * 1000000 + i * 1000000 AS t_us, (o_custkey % 30000) / 2 AS value FROM o")
def mef2_samples(spark, sf_dir):
    """Two blocks a file at least, if it has the samples."""
    path = _written(spark, sf_dir, ".mef", _mef2(lambda k0, at: k0 + at, 600))
    return spark.read.format("mef2").option("validate", "true").load(path).select("channel", "rate", "t_us", "value")


@query("SELECT 'm' || f AS channel, k0 * 1000000 + i * 1000000 AS t_us, (o_custkey % 30000) / 2 AS value FROM o")
def mef2_encrypted(spark, sf_dir):
    """Sessions and blocks that a password opens."""
    path = _written(spark, sf_dir, ".mef", _mef2(lambda k0, at: k0 + at, 600, "recorder"))
    return spark.read.format("mef2").option("password", "recorder").load(path).select("channel", "t_us", "value")


#: Blocks of 50 samples: every fourth begins where the last ends, 3 s after it, 2 s before that, 7 s after.
CASES = """, b AS (SELECT f, i // 50 AS block, k0 + 50 * (i // 50) + [0, 3, -2, 5][i // 50 % 4 + 1] AS t, count(*) AS n FROM o GROUP BY ALL),
    c AS (SELECT 'm' || f AS channel, block, t, n, lead(t) OVER w AS next_t, lag(t) OVER w IS NULL OR t > lag(t) OVER w + 50 AS starts FROM b WINDOW w AS (PARTITION BY f ORDER BY block))"""


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _written(spark, sf_dir, ".mef", _mef2(lambda k0, at: k0 + at + np.asarray([0, 3, -2, 5])[at // 50 % 4], 50))
    return spark.read.format("mef2_blocks").load(path)


@query(CASES + """ SELECT channel, block, t * 1000000 AS t_us, n, CASE WHEN next_t IS NULL THEN 'last' WHEN next_t < t + n THEN 'overlap' WHEN next_t > t + n THEN 'gap' ELSE 'next' END AS follows,
    least(t + n, coalesce(next_t, t + n)) * 1000000 AS end_us, CASE WHEN next_t < t + n THEN next_t - t - n ELSE 0 END AS change FROM c""")
def mef2_fitted(spark, sf_dir):
    """What follows each block, and how its samples are fitted to the time that there is."""
    return blocks.fitted(_cases(spark, sf_dir), "rate", "channel", bucket=1 << 20).select("channel", "block", "t_us", "n", "follows", "end_us", "change")


@query(CASES + """, k AS (SELECT *, sum(CASE WHEN starts OR block % 6 = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY block) AS chunk FROM c),
    s AS (SELECT channel, chunk, arg_min(t, block) * 1000000 AS start, count(*) AS blocks, sum(n)::BIGINT AS samples FROM k GROUP BY ALL)
    SELECT channel, chunk::BIGINT AS chunk, start, blocks, samples, (SELECT min(block) FROM c WHERE c.channel = s.channel AND c.t * 1000000 = s.start) AS block FROM s""")
def mef2_block_times(spark, sf_dir):
    """Contiguous chunks of six blocks at most, joined with the block table on their start."""
    table_ = _cases(spark, sf_dir)
    return blocks.block_times(blocks.chunk_table(table_, "channel", cycle=6), table_, "channel").select("channel", "chunk", "start", "blocks", "samples", "block")


def _nicolet(sections: dict[str, list[bytes]]) -> bytes:
    """A Nicolet file of sections by tag, each in parts."""
    out, rows = bytearray(172_216), []
    for number, parts in enumerate(sections.values(), 1):
        for part in parts:
            rows.append((number, len(out), len(part) << 32))
            out += part
    struct.pack_into("<I", out, 24, len(out))
    out += struct.pack("<Q", len(rows)) + b"".join(struct.pack("<QQQ", *r) for r in rows) + bytes(8)
    struct.pack_into("<I", out, 172, len(sections))
    for k, tag in enumerate(sections):
        out[176 + 84 * k : 260 + 84 * k] = tag.encode("utf-16-le").ljust(80, b"\0") + struct.pack("<I", k + 1)
    struct.pack_into("<I", out, 172_208, len(rows))
    return bytes(out)


def _mixed(kind: str) -> bytes:
    """A GUID's bytes in the order of files."""
    g = bytes.fromhex(kind.strip("{}").replace("-", ""))
    return g[3::-1] + g[5:3:-1] + g[7:5:-1] + g[8:]


@query("SELECT 'Seizure' AS type, o_orderkey * 86400000000 + o_custkey * 1000 AS t_us, o_custkey * 1000000 AS duration_us, 'u' || f AS user_name, 'n' || o_orderkey AS label FROM o WHERE o_orderkey % 2 = 0 UNION ALL SELECT 'UNKNOWN', o_orderkey * 86400000000 + o_custkey * 1000, o_custkey * 1000000, 'u' || f, 'n' || o_orderkey FROM o WHERE o_orderkey % 2 > 0")
def nicolet_events(spark, sf_dir):
    """Event markers of two kinds, one without a name, in packets of unlike lengths."""

    def encode(f, p):
        kinds = [_mixed("{A5A95646-A7F8-11CF-831A-0800091B5BDA}"), bytes(range(16))]
        events = b""
        for k, c in zip(p["o_orderkey"].tolist(), p["o_custkey"].tolist()):
            tail = bytes(k % 3 * 8)
            e = _mixed(nicolet.EVENT_PACKET) + struct.pack("<Qqddd", 272 + len(tail), 0, 25569 + k, c / 1000, c) + bytes(48) + f"u{f}".encode("utf-16-le").ljust(24, b"\0")
            events += (e + struct.pack("<Q", 0) + kinds[k % 2] + bytes(16) + f"n{k}".encode("utf-16-le").ljust(64, b"\0")).ljust(272, b"\0") + tail
        return _nicolet({"Events": [events + bytes(272)]})

    rows = spark.read.format("nicolet_events").load(_written(spark, sf_dir, ".e", encode))
    return rows.select("type", "t_us", "duration_us", F.col("user").alias("user_name"), "label")


@query(", c AS (SELECT *, count(*) OVER (PARTITION BY f) AS n FROM o) SELECT 'c' || f AS channel, 1.0::DOUBLE AS rate, floor((f * 86400000000)::DOUBLE + i * (n * 1e6::DOUBLE / greatest(n - 1, 1)) + 0.001::DOUBLE)::BIGINT AS t_us, (o_custkey % 30000) / 2 AS value FROM c")
def nicolet_samples(spark, sf_dir):
    """A segment of one channel a file, its samples in two parts; times run to the segment's end, the last one included."""

    def encode(f, p):
        x, n = _custom(p, 30000).astype("<i2").tobytes(), len(p)
        ts = bytearray(760 + 552)
        struct.pack_into("<I", ts, 752, 1)
        name = f"c{f}".encode("utf-16-le")
        ts[760 : 760 + len(name)] = name
        struct.pack_into("<4d", ts, 760 + 256, 0.1, 70.0, 1.0, 0.5)
        change = _mixed(nicolet.TS_PACKET) + struct.pack("<ddQQ", 0, 0, 0, len(ts))
        segment = struct.pack("<ddd", 25569 + f, 0, n) + bytes(128)
        return _nicolet({"InfoChangeStream": [change], nicolet.TS_PACKET: [bytes(ts[:700]), bytes(ts[700:])], "SegmentStream": [segment], "0": [x[:10], x[10:]]})

    return spark.read.format("nicolet").load(_written(spark, sf_dir, ".e", encode)).select("channel", "rate", "t_us", "value")


def _ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of each file's keys at a sample a second, on the channel of the file's last digit."""
    g = _orders(spark, sf_dir).groupBy("f").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", "o_custkey"))).alias("x"))
    lo = F.element_at("x.o_orderkey", 1) * 1_000_000
    return g.select(F.concat(F.lit("c"), (F.col("f") % 10).cast("string")).alias("channel_id"), F.lit(1.0).alias("rate"), lo.alias("lo"), (lo + F.size("x") * 1_000_000).alias("hi"), F.transform("x.o_custkey", lambda v: v.cast("double")).alias("values"))


def _session(spark: SparkSession, sf_dir: str) -> str:
    ship(spark)
    sources.register(spark)
    root = scratch(spark, "session")
    mef.write_mef3(_ranges(spark, sf_dir), root, per_segment=4).agg(F.sum("samples")).collect()
    return root


@query("SELECT 'c' || f % 10 AS channel, 'uV' AS unit, 1.0::DOUBLE AS rate, (k0 + i) * 1000000 AS t_us, o_custkey::DOUBLE AS value FROM o")
def mef3_samples(spark, sf_dir):
    return spark.read.format("mef3").option("validate", "true").load(_session(spark, sf_dir))


@query(""", r AS (SELECT f, k0, count(*) AS n FROM o GROUP BY ALL)
    SELECT 'c' || f % 10 AS name, 1.0::DOUBLE AS rate, sum(n)::BIGINT AS samples, 'uV' AS unit, min(k0) * 1000000 AS start_us, max(k0 + n) * 1000000 AS end_us, ((count(*) + 3) // 4)::BIGINT AS n_segments FROM r GROUP BY f % 10""")
def mef3_sessions(spark, sf_dir):
    """The channels of a session's nested metadata, and how many segments each has."""
    nested = mefmeta.read_sessions(spark, _session(spark, sf_dir)).select(F.explode("series_channels").alias("c"))
    return nested.select("c.channel", F.col("c.series").alias("s"), "c.start", "c.end", F.size("c.segments").cast("long").alias("n_segments")).select(
        F.col("channel").alias("name"), "s.rate", "s.samples", "s.unit", F.col("start").alias("start_us"), F.col("end").alias("end_us"), "n_segments"
    )


@query(", r AS (SELECT *, row_number() OVER (PARTITION BY f % 10 ORDER BY o_orderkey) - 1 AS s FROM o) SELECT 'c' || f % 10 AS channel, (k0 + i) * 1000000 AS t_us, o_custkey::DOUBLE AS value FROM r WHERE s >= 500 AND s < 1300")
def mef3_by_sample(spark, sf_dir):
    """Samples 500 to 1,299 of every channel."""
    return spark.read.format("mef3").options(first_sample="500", end_sample="1300").load(_session(spark, sf_dir)).select("channel", "t_us", "value")


@query(", e AS (SELECT f % 10 AS c, f, k0 + count(*) AS a, lead(k0) OVER (PARTITION BY f % 10 ORDER BY f) AS b FROM o GROUP BY f, k0) SELECT 'c' || f % 10 AS channel, (k0 + i) * 1000000 AS t_us, o_custkey::DOUBLE AS value FROM o UNION ALL SELECT 'c' || c, unnest(range(a, b)) * 1000000, NULL FROM e WHERE b > a")
def mef3_filled(spark, sf_dir):
    """All samples, and a missing one for each period between blocks."""
    rows = spark.read.format("mef3").option("fill", "true").load(_session(spark, sf_dir))
    return rows.select("channel", "t_us", F.nanvl("value", F.lit(None).cast("double")).alias("value"))


@query("""SELECT 'f' || f AS session, i AS number, ['Note', 'EDFA', 'LNTP', 'Seiz'][o_orderkey % 4 + 1] AS type, o_orderkey * 1000 AS t_us, CASE WHEN o_orderkey % 4 < 2 THEN 'n' || o_orderkey END AS text,
    CASE WHEN o_orderkey % 4 IN (1, 3) THEN o_custkey ELSE -1 END AS duration_us, CASE WHEN o_orderkey % 4 = 2 THEN o_custkey % 1000 ELSE -1 END AS last, CASE WHEN o_orderkey % 4 = 3 THEN o_orderkey * 1000 - o_custkey ELSE -1 END AS onset, CASE WHEN o_orderkey % 4 = 3 THEN 'focal' END AS kind FROM o""")
def mef3_records(spark, sf_dir):
    """Records of four types in a session's file, some sealed by its password."""

    def encode(f, p):
        key, name = crypto.password_key("open"), f"f{f}".encode()
        head = bytearray(1024)
        head[308 : 308 + len(name)], head[868:884] = name, hashlib.sha256(key).digest()[:16]
        data, index = bytearray(head), bytearray(head)
        # times before 1970 can be stored only less the recording's offset, which a segment's metadata hold
        least = int((p["o_orderkey"] * 1000 - p["o_custkey"]).min())
        offset = least - 1 if least < 0 else mef.NO_OFFSET
        meta = bytes(13312) + struct.pack("<q", offset) + bytes(16384 - 13320)
        for k, c in zip(p["o_orderkey"].tolist(), p["o_custkey"].tolist()):
            n, t, onset = f"n{k}".encode(), mef.stored_time(k * 1000, offset), mef.stored_time(k * 1000 - c, offset)
            kind, body = ((b"Note", n), (b"EDFA", struct.pack("<q", c) + n), (b"LNTP", struct.pack("<qii", 2, -7, c % 1000)), (b"Seiz", struct.pack("<qqqii", onset, t, c, 0, 1).ljust(1312, b"\0")))[k % 4]
            body, level = body + bytes(-len(body) % 16), int(k % 40 == 0)
            if level:
                body = b"".join(crypto.encrypt_block(body[a : a + 16], key) for a in range(0, len(body), 16))
            index += kind + struct.pack("<xBBbqq", 1, 0, level, len(data), t)
            data += struct.pack("<I4sxBBbIq", 0, kind, 1, 0, level, len(body), t) + body
        files = {f"f{f}.mefd/f{f}.rdat": bytes(data), f"f{f}.mefd/f{f}.ridx": bytes(index)}
        return files | ({f"f{f}.mefd/c.timd/c-000000.segd/c-000000.tmet": meta} if least < 0 else {})

    r = spark.read.format("mef3_records").option("password", "open").load(_written(spark, sf_dir, "", encode))
    whole = lambda c, name: F.coalesce(c.cast("long"), F.lit(-1)).alias(name)
    return r.select("session", "number", "type", "t_us", "text", whole(F.col("duration_us"), "duration_us"), whole(F.element_at("template", -1), "last"), whole(F.col("seizure.earliest_onset"), "onset"), F.col("seizure.onset").alias("kind"))


@query(", r AS (SELECT 'c' || f % 10 AS channel, k0, i, o_custkey FROM o) SELECT channel, (k0 + i - min(k0) OVER ())::DOUBLE AS seconds, 'name ' || channel AS name, o_custkey::DOUBLE AS value FROM r")
def parquet_export(spark, sf_dir):
    ship(spark)
    r = _ranges(spark, sf_dir)
    channels = r.groupBy("channel_id").agg(F.min("lo").alias("start"), F.max("hi").alias("end"))
    channels = channels.select("channel_id", F.concat(F.lit("name "), "channel_id").alias("name"), F.lit("uV").alias("unit"), "start", "end")
    path = scratch(spark, "export")
    export.write_export(r, channels, path)
    return spark.read.parquet(path).select(F.col("channel_id").alias("channel"), "seconds", "name", "value")
