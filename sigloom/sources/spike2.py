"""Spike2 .smr files: a header, a header per channel, and chains of data blocks.

Written from public descriptions of the format and tested on files made from them, not on recordings.
"""

from __future__ import annotations

import numpy as np

from sigloom.sources.base import Format, Piece, event_batch, list_files, read_at, sample_batch, sized_files, split, whole_micros

#: Layouts and kinds fixed by the format.
FILE = np.dtype([("system", "<i2"), ("copyright", "S10"), ("creator", "S8"), ("us_per_time", "<i2"), ("time_per_adc", "<i2"), ("state", "<i2"), ("first", "<i4"), ("channels", "<i2"), ("channel_size", "<i2"), ("extra", "<i2"), ("buffer", "<i2"), ("format", "<i2"), ("max_time", "<i4"), ("time_base", "<f8"), ("clock", "u1", 6), ("year", "<i2"), ("pad", "S52"), ("comments", "S400")])
CHANNEL = np.dtype([("deleted", "<i2"), ("next_deleted", "<i4"), ("first", "<i4"), ("last", "<i4"), ("blocks", "<i2"), ("extra", "<i2"), ("pre_trigger", "<i2"), ("free", "<i2"), ("size", "<i2"), ("max_data", "<i2"), ("comment", "V72"), ("max_time", "<i4"), ("divide", "<i4"), ("physical", "<i2"), ("title", "V10"), ("ideal", "<f4"), ("kind", "u1"), ("pad", "i1"), ("scale", "<f4"), ("offset", "<f4"), ("unit", "V6"), ("old_divide", "<i2")])
BLOCK = np.dtype([("before", "<i4"), ("next", "<i4"), ("start", "<i4"), ("end", "<i4"), ("channel", "<i2"), ("items", "<i2")])
ADC, EVENTS, REAL = 1, (2, 3, 4), 9


def counted(v) -> str:
    """Text after its length."""
    b = bytes(v)
    return b[1 : 1 + b[0]].split(b"\0")[0].decode("latin-1").strip()


def header(path: str) -> tuple[dict, list[dict]]:
    h = np.frombuffer(read_at(path, 0, FILE.itemsize), FILE)[0]
    base = float(h["time_base"]) if h["system"] >= 6 and h["time_base"] > 0 else 1e-6
    tick, unit_of = float(h["us_per_time"]) * base, 512 if h["system"] >= 9 else 1
    raw = np.frombuffer(read_at(path, FILE.itemsize, CHANNEL.itemsize * int(h["channels"])), CHANNEL)
    channels = []
    for i, c in enumerate(raw):
        if c["kind"] == 0 or c["blocks"] == 0:
            continue
        step = float(c["divide"]) * tick if h["system"] >= 6 else float(c["old_divide"]) * tick * float(h["time_per_adc"])
        channels.append({"number": i, "kind": int(c["kind"]), "name": counted(c["title"]) or f"ch{i}", "unit": counted(c["unit"]), "scale": float(c["scale"]), "offset": float(c["offset"]), "step": step, "first": int(c["first"]) * unit_of})
    return {"tick": tick, "unit_of": unit_of}, channels


def blocks(path: str, h: dict, c: dict) -> list[tuple[int, int, int]]:
    """(place of the data, start, items) along a channel's chain."""
    out, at, seen = [], c["first"], set()
    while at > 0 and at not in seen:
        seen.add(at)
        b = np.frombuffer(read_at(path, at, BLOCK.itemsize), BLOCK)[0]
        out.append((at + BLOCK.itemsize, int(b["start"]), int(b["items"])))
        at = int(b["next"]) * h["unit_of"] if b["next"] > 0 else -1
    return out


class Spike2(Format):
    """Waveform channels in physical units; a partition is a run of blocks. Options: first=true reads only a folder's first file, start_us the recording's start."""

    NAME = "spike2"
    APART = True

    @classmethod
    def works(cls, path, options):
        found = [(f, n) for f, n in sized_files(path) if f.lower().endswith(".smr")]
        return found[:1] if options.get("first", "false") == "true" else found

    @staticmethod
    def plan(path, options):
        files = [f for f in list_files(path) if f.lower().endswith(".smr")]
        files = files[:1] if options.get("first", "false") == "true" else files
        out = []
        for f in files:
            h, channels = header(f)
            for c in (c for c in channels if c["kind"] in (ADC, REAL)):
                chain = blocks(f, h, c)
                out += [Piece(f, h | c | {"chain": chain[a:b]}) for a, b in split(len(chain), 64)]
        return out

    @staticmethod
    def decode(piece, options):
        i = piece.info
        kind = "<i2" if i["kind"] == ADC else "<f4"
        for at, start, n in i["chain"]:
            x = np.frombuffer(read_at(piece.path, at, n * np.dtype(kind).itemsize), kind).astype(float)
            if i["kind"] == ADC:
                x = x * (i["scale"] / 6553.6) + i["offset"]
            t = float(options.get("start_us", 0)) + start * i["tick"] * 1e6 + np.arange(n) * (i["step"] * 1e6)
            yield sample_batch(i["name"], i["unit"], 1 / i["step"], t, x)


class Spike2Events(Format):
    NAME = "spike2_events"
    APART = True
    KIND = "events"

    @staticmethod
    def plan(path, options):
        return [Piece(f, h | c) for f in list_files(path) if f.lower().endswith(".smr") for h, cs in (header(f),) for c in cs if c["kind"] in EVENTS]

    @staticmethod
    def decode(piece, options):
        i = piece.info
        for at, _, n in blocks(piece.path, i, i):
            t = whole_micros(float(options.get("start_us", 0)) + np.frombuffer(read_at(piece.path, at, 4 * n), "<i4") * i["tick"] * 1e6)
            yield event_batch(piece.path, ["event"] * n, t.tolist(), [i["name"]] * n, [{}] * n)


ALL = (Spike2, Spike2Events)
