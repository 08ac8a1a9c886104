"""Moberg monitor archives: index, data and settings files of one source share a name of five comma-ended fields."""

from __future__ import annotations

import os
import xml.etree.ElementTree as ET
from collections import defaultdict

import numpy as np

from sigloom.sources.base import BATCH, Format, Piece, event_batch, file_size, list_files, read_at, sample_batch, sized_files, split

INDEX = np.dtype([("first", "<u8"), ("clock", "<u8"), ("fraction", "<u4"), ("whole", "<u4"), ("format", "u1"), ("checksum", "u1"), ("bytes", "<u2")])
WIDTH = {0x04: 4, 0x05: 3}


def sources(path: str) -> dict[str, dict[str, str]]:
    """Files of each source by what they hold."""
    return by_source(list_files(path))


def by_source(files: list[str]) -> dict[str, dict[str, str]]:
    out: dict[str, dict[str, str]] = defaultdict(dict)
    for f in files:
        name = os.path.basename(f)
        if not name.startswith("._") and name.count(",") == 5:
            prefix, _, kind = name.rpartition(",")
            out[prefix][kind.lower()] = f
    return dict(out)


def settings(path: str | None, composite: bool, series: bool) -> dict:
    out = {"unit": "", "factor": 1.0, "signals": [None], "format": None}
    if path is None:
        return out
    root = ET.fromstring(read_at(path))
    out["unit"] = (root.findtext("Units") or "").strip()
    if series and root.findtext("SampleConversion"):
        ilo, ihi, olo, ohi = (float(x) for x in root.findtext("SampleConversion").strip().split(","))
        if ohi / ihi != olo / ilo:
            raise ValueError(f"{path}: the conversion isn't symmetric")
        out["factor"] = ohi / ihi
    if composite:
        parts = [e.get("type", ",unknown,").split(",") for e in root.findall("CompositeElements/CompositeElement")]
        kinds = {p[3].strip().lower() for p in parts}
        if len(kinds) != 1:
            raise ValueError(f"{path}: elements of several types")
        out["signals"], out["format"] = [p[1] for p in parts], kinds.pop()
    return out


def decode_values(raw: bytes, width: int, form: str) -> np.ndarray:
    form = form.strip().lower()
    if width == 4 and form == "float":
        return np.frombuffer(raw, "<f4").astype(float)
    if form not in ("integer", "integeraggregate"):
        raise ValueError(f"unsupported sample type: {form} of {width} bytes")
    if width == 4:
        return np.frombuffer(raw, "<i4").astype(float)
    b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
    v = b[:, 0] | (b[:, 1] << 8) | (b[:, 2] << 16)
    return np.where(v & 0x800000, v - 0x1000000, v).astype(float)


class Moberg(Format):
    """Sample series and numerics. Partitions are stretches of runs; every run has its own sample interval."""

    NAME = "moberg"
    APART = True

    @classmethod
    def works(cls, path, options):
        """Sources, joined by the names of their files."""
        size = dict(sized_files(path))
        return [((prefix, files), sum(size[f] for f in files.values())) for prefix, files in by_source(list(size)).items() if cls.holds(prefix, files)]

    @staticmethod
    def holds(prefix, files):
        return prefix.split(",")[2] in ("SampleSeries", "Numeric") and "index" in files and "data" in files

    @classmethod
    def plan(cls, path, options):
        return [p for work, _ in cls.works(path, options) for p in cls.plan_work(work, options)]

    @classmethod
    def plan_work(cls, work, options):
        (prefix, files), out = work, []
        modality, _, kind, form, _ = prefix.split(",")
        runs = np.frombuffer(read_at(files["index"]), INDEX)
        if not len(runs):
            return out
        code = int(runs["format"][0]) & 0x7F
        if code not in WIDTH:
            raise ValueError(f"{files['index']}: unsupported format {code}")
        composite = bool(runs["format"][0] & 0x80)
        s = settings(files.get("settings"), composite, kind == "SampleSeries")
        per = int(runs["bytes"][0]) if composite else WIDTH[code]
        total = file_size(files["data"]) // per
        lengths = np.diff(np.append(runs["first"].astype(np.int64), total))
        if lengths.sum() != total - int(runs["first"][0]) or (lengths < 0).any():
            raise ValueError(f"{files['data']}: runs and samples don't match")
        for r, n in zip(runs, lengths.tolist()):
            interval = int(r["whole"]) + int(r["fraction"]) / 2**32
            label = [f"{modality}-{x}" if x else modality for x in s["signals"]] if composite else [modality]
            for a, b in split(n, BATCH):
                out.append(Piece(files["data"], {"at": (int(r["first"]) + a) * per, "n": b - a, "per": per, "width": WIDTH[code], "labels": label, "format": s["format"] or form, "unit": s["unit"], "factor": s["factor"], "t": int(r["clock"]) + a * interval, "interval": interval}))
        return out

    @staticmethod
    def decode(piece, options):
        i = piece.info
        x = decode_values(read_at(piece.path, i["at"], i["n"] * i["per"]), i["width"], i["format"]).reshape(i["n"], -1)
        t = i["t"] + np.arange(i["n"]) * i["interval"]
        for c, name in enumerate(i["labels"]):
            yield sample_batch(name.strip(), i["unit"], 1e6 / i["interval"], t, x[:, c] * i["factor"])


class MobergPatient(Format):
    """Fields of the XML files that belong to no source, a row each."""

    NAME = "moberg_patient"
    KIND = "events"

    @staticmethod
    def plan(path, options):
        return [Piece(f) for f in list_files(path) if f.lower().endswith(".xml")]

    @staticmethod
    def decode(piece, options):
        root = ET.fromstring(read_at(piece.path))
        fields = [(e.tag, (e.text or "").strip()) for e in root.iter() if e is not root and (e.text or "").strip()]
        yield event_batch(piece.path, ["patient"] * len(fields), [0] * len(fields), [v for _, v in fields], [{"field": k} for k, _ in fields])


ALL = (Moberg, MobergPatient)
