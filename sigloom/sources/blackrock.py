"""Blackrock and Ripple NSx (continuous) and NEV (spikes and events), file specifications 2.1, 2.2 and 2.3."""

from __future__ import annotations

import os
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql.pandas.types import from_arrow_schema

from sigloom.sources.base import BATCH, Format, Piece, event_batch, file_size, list_files, read_at, sample_batch, spike_batch, split, whole_micros

BASIC = np.dtype([("id", "S8"), ("spec", "u1", 2), ("bytes", "<u4"), ("label", "S16"), ("comment", "S256"), ("period", "<u4"), ("resolution", "<u4"), ("origin", "<u2", 8), ("n", "<u4")])
CHANNEL = np.dtype([("type", "S2"), ("id", "<u2"), ("label", "S16"), ("connector", "u1"), ("pin", "u1"), ("min_dig", "<i2"), ("max_dig", "<i2"), ("min_ana", "<i2"), ("max_ana", "<i2"), ("unit", "S16"), ("high", "<u4"), ("high_order", "<u4"), ("high_type", "<u2"), ("low", "<u4"), ("low_order", "<u4"), ("low_type", "<u2")])
BLOCK = np.dtype([("head", "u1"), ("stamp", "<u4"), ("n", "<u4")])
NEV = np.dtype([("id", "S8"), ("spec", "u1", 2), ("flags", "<u2"), ("bytes", "<u4"), ("packet", "<u4"), ("resolution", "<u4"), ("waveform_rate", "<u4"), ("origin", "<u2", 8), ("application", "S32"), ("comment", "S256"), ("n", "<u4")])
WAVE = np.dtype([("id", "<u2"), ("connector", "u1"), ("pin", "u1"), ("factor", "<u2"), ("energy", "<u2"), ("high", "<i2"), ("low", "<i2"), ("units", "u1"), ("bytes", "u1"), ("width", "<u2"), ("rest", "S8")])


def origin_us(parts, milliseconds_as_micros: bool = False) -> int:
    """year, month, weekday, day, hour, minute, second, millisecond."""
    y, mo, _, d, h, mi, s, ms = (int(x) for x in parts)
    if not y or not mo:
        return 0
    t = int(datetime(y, mo, d, h, mi, s, tzinfo=timezone.utc).timestamp()) * 1_000_000
    return t + (ms if milliseconds_as_micros else ms * 1000)


def text(x: bytes) -> str:
    return x.split(b"\x00")[0].decode("latin-1").strip()


def default_label(electrode: int) -> str:
    return f"chan{electrode}" if electrode < 129 else f"ainp{electrode - 128}"


def nsx_header(path: str) -> dict:
    kind = read_at(path, 0, 8)
    if kind == b"NEURALSG":
        period, n = np.frombuffer(read_at(path, 24, 8), "<u4").tolist()
        ids = np.frombuffer(read_at(path, 32, 4 * n), "<u4").tolist()
        channels = [{"id": i, "label": default_label(i), "unit": "uV", "digital": None} for i in ids]
        first = 32 + 4 * n
        return {"rate": 30000.0 / period, "resolution": 30000, "origin": 0, "channels": channels, "blocks": [(first, 0, (file_size(path) - first) // (2 * n))]}
    if kind != b"NEURALCD":
        raise ValueError(f"{path}: not an NSx file")
    h = np.frombuffer(read_at(path, 0, BASIC.itemsize), BASIC)[0]
    n = int(h["n"])
    ext = np.frombuffer(read_at(path, BASIC.itemsize, CHANNEL.itemsize * n), CHANNEL)
    channels = [{"id": int(c["id"]), "label": text(c["label"]) or default_label(int(c["id"])), "unit": text(c["unit"]), "digital": [int(c[k]) for k in ("min_dig", "max_dig", "min_ana", "max_ana")]} for c in ext]
    blocks, at, size = [], int(h["bytes"]), file_size(path)
    while at + BLOCK.itemsize <= size:
        b = np.frombuffer(read_at(path, at, BLOCK.itemsize), BLOCK)[0]
        if b["head"] != 1:
            break
        count = int(b["n"]) or (size - at - BLOCK.itemsize) // (2 * n)
        blocks.append((at + BLOCK.itemsize, int(b["stamp"]), count))
        at += BLOCK.itemsize + 2 * n * count
    return {"rate": 30000.0 / int(h["period"]), "resolution": int(h["resolution"]), "origin": origin_us(h["origin"]), "channels": channels, "blocks": blocks}


def to_units(x: np.ndarray, digital: list[int] | None) -> np.ndarray:
    """In single precision: a factor for symmetric ranges, an affine map for others."""
    x = x.astype(np.float32)
    if digital is None:
        return x
    a, b, c, d = (np.float32(v) for v in digital)
    if a == -b and c == -d:
        return x * (d / b)
    return (x - a) * ((d - c) / (b - a)) + c


class Nsx(Format):
    """Partitions are stretches of data blocks; a pause begins a new block. Option: files of given suffixes, e.g. nsx=2,6."""

    NAME = "nsx"
    APART = True
    ENDS = tuple(f".ns{k}" for k in range(1, 7))

    @staticmethod
    def plan(path, options):
        wanted = {f".ns{k.strip()}" for k in options.get("nsx", "1,2,3,4,5,6").split(",")}
        out = []
        for f in (x for x in list_files(path) if os.path.splitext(x)[1] in wanted):
            h = nsx_header(f)
            per = max(1, 16 * BATCH // max(1, len(h["channels"])))
            shared = {k: h[k] for k in ("rate", "resolution", "origin", "channels")}
            out += [Piece(f, shared | {"at": at, "stamp": stamp, "first": a, "end": b}) for at, stamp, n in h["blocks"] for a, b in split(n, per)]
        return out

    @staticmethod
    def decode(piece, options):
        i = piece.info
        n = len(i["channels"])
        x = np.frombuffer(read_at(piece.path, i["at"] + 2 * n * i["first"], 2 * n * (i["end"] - i["first"])), "<i2").reshape(-1, n)
        t = i["origin"] + i["stamp"] / i["resolution"] * 1e6 + np.arange(i["first"], i["end"]) * (1e6 / i["rate"])
        for c, channel in enumerate(i["channels"]):
            yield sample_batch(channel["label"], channel["unit"], i["rate"], t, to_units(x[:, c], channel["digital"]))


def nev_header(path: str) -> dict:
    h = np.frombuffer(read_at(path, 0, NEV.itemsize), NEV)[0]
    if h["id"] not in (b"NEURALEV", b"BREVENTS"):
        raise ValueError(f"{path}: not a NEV file")
    waves, names = {}, {}
    raw = read_at(path, NEV.itemsize, 32 * int(h["n"]))
    for k in range(int(h["n"])):
        part = raw[32 * k : 32 * k + 32]
        if part[:8] == b"NEUEVWAV":
            w = np.frombuffer(part[8:], WAVE)[0]
            waves[int(w["id"])] = {"factor": int(w["factor"]), "bytes": max(1, int(w["bytes"])), **{k: int(w[k]) for k in ("connector", "pin", "energy", "high", "low", "units")}}
        elif part[:8] == b"NEUEVLBL":
            names[int(np.frombuffer(part[8:10], "<u2")[0])] = text(part[10:26])
    return {"first": int(h["bytes"]), "packet": int(h["packet"]), "resolution": int(h["resolution"]), "origin": origin_us(h["origin"]), "wide": bool(int(h["flags"]) & 1), "waves": waves, "names": names, "spec": tuple(int(v) for v in h["spec"])}


def _packets(piece: Piece) -> tuple[dict, np.ndarray, np.ndarray, np.ndarray]:
    h = piece.info["header"]
    raw = np.frombuffer(read_at(piece.path, h["first"] + piece.info["first"] * h["packet"], (piece.info["end"] - piece.info["first"]) * h["packet"]), np.uint8).reshape(-1, h["packet"])
    stamp = np.ascontiguousarray(raw[:, :4]).view("<u4").ravel()
    kind = np.ascontiguousarray(raw[:, 4:6]).view("<u2").ravel()
    return h, raw, h["origin"] + stamp / h["resolution"] * 1e6, kind


class NevSpikes(Format):
    """Spikes of each electrode with unit and waveform in microvolts. Partitions are ranges of packets."""

    NAME = "nev_spikes"
    APART = True
    ENDS = (".nev",)
    KIND = "spikes"

    @staticmethod
    def plan(path, options):
        out = []
        for f in (x for x in list_files(path) if x.endswith(".nev")):
            h = nev_header(f)
            out += [Piece(f, {"header": h, "first": a, "end": b}) for a, b in split((file_size(f) - h["first"]) // h["packet"], BATCH)]
        return out

    @staticmethod
    def decode(piece, options):
        h, raw, t, kind = _packets(piece)
        for electrode in np.unique(kind[(kind > 0) & (kind <= (2048 if h["spec"] >= (2, 3) else 512))]).tolist():
            at = np.flatnonzero(kind == electrode)
            wave = h["waves"].get(electrode, {"factor": 1000, "bytes": 1})
            size = 2 if h["wide"] else wave["bytes"]
            body = np.ascontiguousarray(raw[at, 8:])
            w = body.view({1: "i1", 2: "<i2", 4: "<i4"}[size]).astype(float) * wave["factor"] / 1000
            yield spike_batch(h["names"].get(electrode) or default_label(electrode), t[at], raw[at, 6], w)


SPECIAL = {0: "digital", 0xFFFF: "continuation", 0xFFFE: "button", 0xFFFD: "tracking", 0xFFFC: "video sync", 0xFFFB: "comment"}


class NevEvents(Format):
    """Digital inputs, comments and the other special packets."""

    NAME = "nev_events"
    APART = True
    ENDS = (".nev",)
    KIND = "events"
    plan = staticmethod(NevSpikes.plan)

    @staticmethod
    def decode(piece, options):
        h, raw, t, kind = _packets(piece)
        at = np.flatnonzero((kind == 0) | (kind >= 0xFFFB))
        names, labels, props = [], [], []
        for k in at.tolist():
            body = raw[k].tobytes()
            names.append(SPECIAL.get(int(kind[k]), "unknown"))
            if kind[k] == 0:
                labels.append(str(int.from_bytes(body[8:10], "little")))
                props.append({"reason": str(body[6])})
            elif kind[k] == 0xFFFB:
                labels.append(text(body[12:]))
                props.append({"charset": str(body[6])})
            else:
                labels.append("")
                props.append({"hex": body[6:].hex()})
        yield event_batch(piece.path, names, t[at].astype(np.int64).tolist(), labels, props)


#: Suffixes of the files of one recording.
MEMBERS = ("ns1", "ns2", "ns3", "ns4", "ns5", "ns6", "nev", "sif", "ccf")


def set_of(path: str) -> tuple[str, str] | None:
    """A file's recording, its path without the suffix, and which member of its set it is."""
    base, ext = os.path.splitext(path)
    return (base, ext[1:]) if ext[1:] in MEMBERS else None


class BlackrockFiles(Format):
    """One row a file of a recording's set: which of its members there are."""

    NAME = "blackrock_files"

    def schema(self):
        return "recording string, member string, path string, bytes long"

    @staticmethod
    def plan(path, options):
        files = [f for f in list_files(path) if set_of(f)]
        return [Piece(files[a], {"files": files[a:b]}) for a, b in split(len(files), 1024)]

    @staticmethod
    def decode(piece, options):
        files = piece.info["files"]
        sets = [set_of(f) for f in files]
        yield pa.RecordBatch.from_pydict({"recording": [s[0] for s in sets], "member": [s[1] for s in sets], "path": files, "bytes": pa.array([file_size(f) for f in files], pa.int64())})


class BlackrockElectrodes(Format):
    """One row an electrode of a NEV or channel of an NSx file, from the headers."""

    NAME = "blackrock_channels"
    APART = True
    ENDS = (".nev", *Nsx.ENDS)
    COLUMNS = pa.schema({"recording": pa.string(), "member": pa.string(), "channel_id": pa.int32(), "label": pa.string(), "unit": pa.string(), "rate": pa.float64(), "samples": pa.int64(), "connector": pa.int32(), "pin": pa.int32(), "factor": pa.int32(), "energy_threshold": pa.int32(), "high_threshold": pa.int32(), "low_threshold": pa.int32(), "sorted_units": pa.int32()})

    def schema(self):
        return from_arrow_schema(self.COLUMNS)

    @staticmethod
    def plan(path, options):
        return [Piece(f) for f in list_files(path) if (s := set_of(f)) and (s[1] == "nev" or s[1].startswith("ns"))]

    @staticmethod
    def decode(piece, options):
        recording, member = set_of(piece.path)
        own = {"recording": recording, "member": member}
        if member == "nev":
            h = nev_header(piece.path)
            rows = [own | {"channel_id": e, "label": h["names"].get(e) or default_label(e), "unit": "uV", "rate": float(h["resolution"]), "connector": w["connector"], "pin": w["pin"], "factor": w["factor"], "energy_threshold": w["energy"], "high_threshold": w["high"], "low_threshold": w["low"], "sorted_units": w["units"]} for e, w in sorted(h["waves"].items())]
        else:
            h = nsx_header(piece.path)
            n = sum(b[2] for b in h["blocks"])
            rows = [own | {"channel_id": c["id"], "label": c["label"], "unit": c["unit"], "rate": h["rate"], "samples": n} for c in h["channels"]]
        yield pa.RecordBatch.from_pylist(rows, schema=BlackrockElectrodes.COLUMNS)


class BlackrockSpikes(Format):
    """Spikes with their recording, electrode and unit, without waveforms. Partitions are ranges of packets."""

    NAME = "blackrock_spikes"
    APART = True
    ENDS = (".nev",)
    plan = staticmethod(NevSpikes.plan)

    def schema(self):
        return "recording string, channel_id int, unit int, t_us long"

    @staticmethod
    def decode(piece, options):
        h, raw, t, kind = _packets(piece)
        at = np.flatnonzero((kind > 0) & (kind <= (2048 if h["spec"] >= (2, 3) else 512)))
        recording = set_of(piece.path)[0]
        yield pa.RecordBatch.from_arrays([pa.array([recording] * len(at), pa.string()), pa.array(kind[at].astype(np.int32)), pa.array(raw[at, 6].astype(np.int32)), pa.array(whole_micros(t[at]))], names=["recording", "channel_id", "unit", "t_us"])


ALL = (Nsx, NevSpikes, NevEvents, BlackrockFiles, BlackrockElectrodes, BlackrockSpikes)
