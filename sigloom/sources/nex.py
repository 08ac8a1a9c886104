"""NeuroExplorer .nex files: continuous variables, neurons with waveforms, events."""

from __future__ import annotations

import numpy as np

from sigloom.sources.base import BATCH, Format, Piece, event_batch, list_files, read_at, sample_batch, spike_batch, split

#: File and variable headers, fixed by the format.
FILE = np.dtype([("magic", "<i4"), ("version", "<i4"), ("comment", "S256"), ("frequency", "<f8"), ("begin", "<i4"), ("end", "<i4"), ("n", "<i4"), ("next", "<i4"), ("pad", "S256")])
VARIABLE = np.dtype([("type", "<i4"), ("version", "<i4"), ("name", "S64"), ("at", "<i4"), ("count", "<i4"), ("wire", "<i4"), ("unit", "<i4"), ("gain", "<i4"), ("filter", "<i4"), ("x", "<f8"), ("y", "<f8"), ("rate", "<f8"), ("to_mv", "<f8"), ("points", "<i4"), ("markers", "<i4"), ("marker_length", "<i4"), ("offset", "<f8"), ("pad", "S60")])
NEURON, EVENT, INTERVAL, WAVEFORM, _, CONTINUOUS, MARKER = range(7)

#: Items in a partition.
PIECE = 1 << 22


def variables(path: str) -> tuple[dict, list[dict]]:
    h = np.frombuffer(read_at(path, 0, FILE.itemsize), FILE)[0]
    if h["magic"] != 827868494:
        raise ValueError(f"{path}: not a NeuroExplorer file")
    v = np.frombuffer(read_at(path, FILE.itemsize, VARIABLE.itemsize * int(h["n"])), VARIABLE)
    name = lambda b: b.split(b"\x00")[0].decode("latin-1").strip()
    return {"frequency": float(h["frequency"])}, [{k: (name(x["name"]) if k == "name" else x[k].item()) for k in VARIABLE.names if k != "pad"} for x in v]


def pieces(path: str, kinds: tuple[int, ...]) -> list[Piece]:
    """A partition for some items of a variable (samples of a continuous one, events of the others)."""
    size = lambda v: v["points"] if v["type"] == CONTINUOUS else v["count"]
    return [Piece(f, h | {"v": v, "cut": cut}) for f in list_files(path) if f.endswith(".nex") for h, all_ in (variables(f),) for v in all_ if v["type"] in kinds for cut in split(size(v), PIECE)]


class NexContinuous(Format):
    """A partition for a stretch of a variable's samples; fragments have their own start stamps. Option start_us sets the recording's start."""

    NAME = "nex_continuous"
    APART = True
    ENDS = (".nex",)

    @staticmethod
    def plan(path, options):
        return pieces(path, (CONTINUOUS,))

    @staticmethod
    def decode(piece, options):
        v = piece.info["v"]
        n, (lo, hi) = v["count"], piece.info["cut"]
        stamps = np.frombuffer(read_at(piece.path, v["at"], 4 * n), "<i4") / piece.info["frequency"]
        firsts = np.append(np.frombuffer(read_at(piece.path, v["at"] + 4 * n, 4 * n), "<i4"), v["points"])
        data_at = v["at"] + 8 * n
        for k in range(n):
            first, end = max(lo, int(firsts[k])), min(hi, int(firsts[k + 1]))
            for a, b in split(end - first, BATCH):
                x = np.frombuffer(read_at(piece.path, data_at + 2 * (first + a), 2 * (b - a)), "<i2")
                t = float(options.get("start_us", 0)) + stamps[k] * 1e6 + np.arange(first + a - firsts[k], first + b - firsts[k]) * (1e6 / v["rate"])
                yield sample_batch(v["name"], "mV", v["rate"], t, x * v["to_mv"] + v["offset"])


class NexSpikes(Format):
    NAME = "nex_spikes"
    APART = True
    ENDS = (".nex",)
    KIND = "spikes"

    @staticmethod
    def plan(path, options):
        return pieces(path, (NEURON, WAVEFORM))

    @staticmethod
    def decode(piece, options):
        v = piece.info["v"]
        lo, hi = piece.info["cut"]
        n = hi - lo
        t = float(options.get("start_us", 0)) + np.frombuffer(read_at(piece.path, v["at"] + 4 * lo, 4 * n), "<i4") / piece.info["frequency"] * 1e6
        width = v["points"] if v["type"] == WAVEFORM else 0
        w = np.frombuffer(read_at(piece.path, v["at"] + 4 * v["count"] + 2 * lo * width, 2 * n * width), "<i2").reshape(n, width) * v["to_mv"] + v["offset"] if width else np.zeros((n, 0))
        yield spike_batch(v["name"], t, np.full(n, v["unit"]), w)


class NexEvents(Format):
    NAME = "nex_events"
    APART = True
    ENDS = (".nex",)
    KIND = "events"

    @staticmethod
    def plan(path, options):
        return pieces(path, (EVENT, INTERVAL))

    @staticmethod
    def decode(piece, options):
        v = piece.info["v"]
        lo, hi = piece.info["cut"]
        n = hi - lo
        t = (float(options.get("start_us", 0)) + np.frombuffer(read_at(piece.path, v["at"] + 4 * lo, 4 * n), "<i4") / piece.info["frequency"] * 1e6).astype(np.int64)
        yield event_batch(piece.path, ["interval" if v["type"] == INTERVAL else "event"] * n, t.tolist(), [v["name"]] * n, [{}] * n)


ALL = (NexContinuous, NexSpikes, NexEvents)
