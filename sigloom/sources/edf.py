"""EDF, EDF+C and EDF+D."""

from __future__ import annotations

from datetime import datetime, timezone

import numpy as np

from sigloom.sources.base import BATCH, Format, Piece, event_batch, file_size, list_files, read_at, sample_batch, split

#: Field widths of a signal header, fixed by the format.
FIELDS = (("label", 16), ("transducer", 80), ("unit", 8), ("pmin", 8), ("pmax", 8), ("dmin", 8), ("dmax", 8), ("filter", 80), ("samples", 8), ("reserved", 32))
ANNOTATIONS = "EDF Annotations"


def header(path: str) -> dict:
    h = read_at(path, 0, 256).decode("latin-1")
    n = int(h[252:256])
    body = read_at(path, 256, 256 * n).decode("latin-1")
    signals, at = [{} for _ in range(n)], 0
    for name, width in FIELDS:
        for s in signals:
            s[name] = body[at : at + width].strip()
            at += width
    for s in signals:
        s["samples"] = int(s["samples"])
        for k in ("pmin", "pmax", "dmin", "dmax"):
            s[k] = float(s[k])
    day, month, year = (int(x) for x in h[168:176].split("."))
    hour, minute, second = (int(x) for x in h[176:184].split("."))
    year += 2000 if year < 85 else 1900
    start = datetime(year, month, day, hour, minute, second, tzinfo=timezone.utc)
    record = 2 * sum(s["samples"] for s in signals)
    first = int(h[184:192])
    n_records = int(h[236:244])
    if n_records < 0:
        n_records = (file_size(path) - first) // record
    return {"start_us": int(start.timestamp()) * 1_000_000, "first": first, "records": n_records, "duration": float(h[244:252]), "signals": signals, "record": record, "broken": h[192:236].startswith("EDF+D")}


def annotation_lists(raw: bytes) -> list[tuple[float, float | None, list[str]]]:
    """Time-stamped lists: onset, duration, texts."""
    out = []
    for part in raw.split(b"\x00"):
        fields = part.split(b"\x14")
        if len(fields) < 2 or fields[0][:1] not in (b"+", b"-"):
            continue
        onset, _, duration = fields[0].partition(b"\x15")
        out.append((float(onset), float(duration) if duration else None, [f.decode("utf-8", "replace") for f in fields[1:] if f]))
    return out


def _records(path: str, h: dict, a: int, b: int) -> np.ndarray:
    return np.frombuffer(read_at(path, h["first"] + a * h["record"], (b - a) * h["record"]), "<i2").reshape(b - a, -1)


def _spans(h: dict) -> list[tuple[int, int]]:
    ends = np.cumsum([s["samples"] for s in h["signals"]])
    return [(int(e) - s["samples"], int(e)) for e, s in zip(ends, h["signals"])]


class Edf(Format):
    """Samples of all signals but annotations, in physical units. Partitions are ranges of records."""

    NAME = "edf"
    APART = True

    @staticmethod
    def plan(path, options):
        out = []
        for f in list_files(path):
            h = header(f)
            per = max(1, 8 * BATCH // max(1, h["record"] // 2))
            out += [Piece(f, {"header": h, "first": a, "end": b}) for a, b in split(h["records"], per)]
        return out

    @staticmethod
    def decode(piece, options):
        h, a, b = piece.info["header"], piece.info["first"], piece.info["end"]
        data = _records(piece.path, h, a, b)
        spans = _spans(h)
        onset = np.arange(a, b) * h["duration"]
        if h["broken"]:
            keeper = next((i for i, s in enumerate(h["signals"]) if s["label"] == ANNOTATIONS), None)
            if keeper is None:
                raise ValueError(f"{piece.path}: a discontinuous recording without annotations")
            x, y = spans[keeper]
            onset = np.asarray([annotation_lists(r[x:y].tobytes())[0][0] for r in data])
        for s, (x, y) in zip(h["signals"], spans):
            if s["label"] == ANNOTATIONS or not s["samples"]:
                continue
            n = s["samples"]
            gain = (s["pmax"] - s["pmin"]) / (s["dmax"] - s["dmin"])
            values = gain * ((s["pmax"] / gain - s["dmax"]) + data[:, x:y].astype(float))
            t = h["start_us"] + onset[:, None] * 1e6 + np.arange(n) * (h["duration"] * 1e6 / n)
            yield sample_batch(s["label"], s["unit"], n / h["duration"] if h["duration"] else 0.0, t.ravel(), values.ravel())


class EdfAnnotations(Format):
    NAME = "edf_annotations"
    APART = True
    KIND = "events"

    plan = staticmethod(Edf.plan)

    @staticmethod
    def decode(piece, options):
        h, a, b = piece.info["header"], piece.info["first"], piece.info["end"]
        data = _records(piece.path, h, a, b)
        for s, (x, y) in zip(h["signals"], _spans(h)):
            if s["label"] == ANNOTATIONS:
                rows = [(h["start_us"] + int(onset * 1e6), text, {} if duration is None else {"duration_s": str(duration)}) for r in data for onset, duration, texts in annotation_lists(r[x:y].tobytes()) for text in texts]
                yield event_batch(piece.path, ["annotation"] * len(rows), [r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])


ALL = (Edf, EdfAnnotations)
