"""OpenEphys .continuous, .spikes and .events files."""

from __future__ import annotations

import os
import re
from datetime import datetime, timezone

import numpy as np

from sigloom.sources.base import BATCH, Format, Piece, event_batch, file_size, flag, list_files, read_at, sample_batch, spike_batch, split

HEADER = 1024


def header(path: str) -> dict:
    """key = value pairs, numbers as floats, and the start time in microseconds."""
    text = read_at(path, 0, HEADER).decode("latin-1").replace("\n", "").replace("header.", "")
    out: dict = {}
    for part in text.split(";"):
        key, eq, value = part.partition(" = ")
        if eq:
            value = value.strip().strip("'")
            out[key.strip()] = value
            if key.strip() not in ("date_created", "format", "description", "channel", "channelType", "electrode"):
                try:
                    out[key.strip()] = float(value)
                except ValueError:
                    pass
    stamp = out.get("date_created", "")
    if re.fullmatch(r"\d+-\w{3}-\d{4} \d{5,6}", stamp):
        day, clock = stamp.split(" ")
        out["start_us"] = int(datetime.strptime(f"{day} {clock.zfill(6)}", "%d-%b-%Y %H%M%S").replace(tzinfo=timezone.utc).timestamp()) * 1_000_000
    return out


def kind_of(path: str) -> str:
    """skip, continuous, spike or event; other files fail."""
    if path.endswith((".openephys", ".events")):
        return "skip"
    d = str(header(path).get("description", "")).lower()
    for word in ("continuous", "spike", "event"):
        if word in d or (word == "continuous" and "one 64-bit timestamp, one 16-bit" in d):
            return word
    raise ValueError(f"unsupported file: {path}")


class Continuous(Format):
    """Records of a stamp, a count, a number, big-endian samples and a marker. Options: bitVolts=false for raw values, twice=true for a start offset counted twice."""

    NAME = "openephys_continuous"
    APART = True
    ENDS = (".continuous",)

    @staticmethod
    def plan(path, options):
        out = []
        for f in (x for x in list_files(path) if x.endswith(".continuous")):
            h = header(f)
            size = 22 + 2 * int(h["blockLength"])
            n = (file_size(f) - HEADER) // size
            if n:
                first = int(np.frombuffer(read_at(f, HEADER, 8), "<i8")[0])
                out += [Piece(f, {"header": h, "first": a, "end": b, "stamp": first}) for a, b in split(n, 4096)]
        return out

    @staticmethod
    def decode(piece, options):
        h, a, b = piece.info["header"], piece.info["first"], piece.info["end"]
        block = int(h["blockLength"])
        kind = np.dtype([("stamp", "<i8"), ("n", "<u2"), ("recording", "<u2"), ("x", ">i2", block), ("marker", "u1", 10)])
        r = np.frombuffer(read_at(piece.path, HEADER + a * kind.itemsize, (b - a) * kind.itemsize), kind)
        rate = float(h["sampleRate"])
        offset = piece.info["stamp"] / rate * 1e6 * (2 if flag(options, "twice") else 1)
        scale = 1.0 if options.get("bitvolts", options.get("bitVolts", "true")) == "false" else float(h.get("bitVolts", 1.0))
        for x, y in split(b - a, max(1, BATCH // block)):
            position = ((a + np.arange(x, y))[:, None] * block + np.arange(block)).ravel()
            yield sample_batch(str(h.get("channel") or os.path.basename(piece.path)), "uV", rate, h.get("start_us", 0) + offset + position * 1e6 / rate, r["x"][x:y].astype(float).ravel() * scale)


def spike_type(channels: int, samples: int = 40) -> np.dtype:
    return np.dtype([("type", "u1"), ("stamp", "<i8"), ("software", "<i8"), ("source", "<u2"), ("channels", "<u2"), ("samples", "<u2"), ("sorted", "<u2"), ("electrode", "<u2"), ("channel", "<u2"), ("colour", "u1", 3), ("pca", "<f4", 2), ("hz", "<u2"), ("w", "<u2", (channels, samples)), ("gain", "<f4", channels), ("threshold", "<u2", channels), ("recording", "<u2")])


class Spikes(Format):
    """One channel per electrode contact; waveforms in volts. Options: truncate=true stores them as whole 16-bit numbers, twice=true."""

    NAME = "openephys_spikes"
    APART = True
    ENDS = (".spikes",)
    KIND = "spikes"

    @staticmethod
    def plan(path, options):
        out = []
        for f in (x for x in list_files(path) if x.endswith(".spikes")):
            h = header(f)
            kind = spike_type(int(h["num_channels"]))
            n = (file_size(f) - HEADER) // kind.itemsize
            if n:
                first = int(np.frombuffer(read_at(f, HEADER, kind.itemsize), kind)["stamp"][0])
                out += [Piece(f, {"header": h, "first": a, "end": b, "stamp": first}) for a, b in split(n, 65_536)]
        return out

    @staticmethod
    def decode(piece, options):
        h, a, b = piece.info["header"], piece.info["first"], piece.info["end"]
        kind = spike_type(int(h["num_channels"]))
        r = np.frombuffer(read_at(piece.path, HEADER + a * kind.itemsize, (b - a) * kind.itemsize), kind)
        rate = float(h["sampleRate"])
        extra = piece.info["stamp"] / rate * 1e6 if flag(options, "twice") else 0.0
        t = h.get("start_us", 0) + extra + r["stamp"] / rate * 1e6
        for c in range(int(h["num_channels"])):
            w = (r["w"][:, c].astype(float) - 32768) / r["gain"][:, c, None].astype(float) / 1000
            if flag(options, "truncate"):
                w = np.trunc(w).astype(np.int64) % 65536
            yield spike_batch(f"{h.get('electrode', os.path.basename(piece.path))}-{c}", t, r["sorted"], w)


EVENT = np.dtype([("stamp", "<i8"), ("position", "<i2"), ("type", "u1"), ("processor", "u1"), ("id", "u1"), ("channel", "u1"), ("recording", "<u2")])


class Events(Format):
    NAME = "openephys_events"
    APART = True
    ENDS = (".events",)
    KIND = "events"

    @staticmethod
    def plan(path, options):
        return [Piece(f, {"header": header(f), "first": a, "end": b}) for f in list_files(path) if f.endswith(".events") for a, b in split((file_size(f) - HEADER) // EVENT.itemsize, BATCH)]

    @staticmethod
    def decode(piece, options):
        h, a, b = piece.info["header"], piece.info["first"], piece.info["end"]
        r = np.frombuffer(read_at(piece.path, HEADER + a * EVENT.itemsize, (b - a) * EVENT.itemsize), EVENT)
        t = h.get("start_us", 0) + r["stamp"] / float(h.get("sampleRate", 30000)) * 1e6
        yield event_batch(piece.path, [str(x) for x in r["type"]], t.astype(np.int64).tolist(), [str(x) for x in r["id"]], [{"channel": str(c), "processor": str(p)} for c, p in zip(r["channel"], r["processor"])])


ALL = (Continuous, Spikes, Events)
