"""Persyst: a .lay layout beside interleaved 16- or 32-bit samples."""

from __future__ import annotations

import configparser
import os
from datetime import datetime, timezone

import numpy as np

from sigloom.sources.base import BATCH, SHARE, Format, Piece, file_size, flag, is_file, list_files, read_at, sample_batch, sized_files


def layout(path: str, lower: bool = False) -> dict:
    """The sections of a layout; channel names keep their case unless `lower`."""
    c = configparser.RawConfigParser(strict=False, allow_no_value=True)
    if not lower:
        c.optionxform = str
    c.read_string(read_at(path).decode("latin-1"))
    return {s.lower(): dict(c.items(s)) for s in c.sections()}


def start_time(patient: dict) -> int:
    """Microseconds of the test's date and time; 0 if it can't be read. Years of two and four digits."""
    low = {k.lower(): v for k, v in patient.items()}
    text = f"{low.get('testdate', '')} {low.get('testtime', '00:00:00')}".strip()
    for form in ("%m/%d/%y %H:%M:%S", "%m/%d/%Y %H:%M:%S", "%Y/%m/%d %H:%M:%S", "%Y.%m.%d %H:%M:%S"):
        try:
            return int(datetime.strptime(text, form).replace(tzinfo=timezone.utc).timestamp()) * 1_000_000
        except ValueError:
            pass
    return 0


def data_of(lay: str, named: str, root: str, names: dict[str, str] | None = None) -> str:
    """A layout's data: of the files of that name, or else of all data files, one beside the layout first. Files elsewhere come by name, or are listed if it isn't beside it."""
    folder = os.path.dirname(lay)
    if names is not None:
        dat = names.get(named) or next((f for n, f in reversed(names.items()) if n.endswith(".dat")), None)
    elif named and is_file(os.path.join(folder, named)):
        dat = os.path.join(folder, named)
    else:
        near = sorted(list_files(root if not root.endswith(".lay") else folder or "."), key=lambda f: os.path.dirname(f) != folder)
        dat = next((f for f in near if os.path.basename(f) == named), next((f for f in near if f.endswith(".dat")), None))
    if dat is None:
        raise FileNotFoundError(f"{lay}: no data file")
    return dat


class Persyst(Format):
    """Partitions are stretches of samples within the layout's segments. Option: lower=true folds channel names."""

    NAME = "persyst"
    APART = True

    @classmethod
    def works(cls, path, options):
        """Layouts, each with the greatest file beside it for its bytes. One with nothing beside it takes all files by name along and counts as large."""
        found = sized_files(path if not path.endswith(".lay") else os.path.dirname(path) or ".")
        layouts = [path] if path.endswith(".lay") else [f for f, _ in found if f.endswith(".lay")]
        if not layouts:
            raise FileNotFoundError(f"{path}: no .lay file")
        beside: dict[str, int] = {}
        for f, n in found:
            if not f.endswith(".lay"):
                beside[os.path.dirname(f)] = max(n, beside.get(os.path.dirname(f), 0))
        names = {} if all(os.path.dirname(f) in beside for f in layouts) else {os.path.basename(f): f for f, _ in reversed(found)}
        return [((f, None), beside[os.path.dirname(f)]) if os.path.dirname(f) in beside else ((f, names), SHARE + 1) for f in layouts]

    @classmethod
    def plan(cls, path, options):
        return [p for work, _ in cls.works(path, options) for p in cls.plan_work(work, options | {"path": path})]

    @classmethod
    def plan_work(cls, work, options):
        (lay, names), out = work, []
        sections = layout(lay, flag(options, "lower"))
        info = {k.lower(): v for k, v in sections["fileinfo"].items()}
        dat = data_of(lay, os.path.basename(info.get("file", "").replace("\\", "/")), options["path"], names)
        kind = {"0": "<i2", "7": "<i4"}[info["datatype"]]
        n_channels, head, rate = int(info["waveformcount"]), int(info.get("headerlength", 0)), float(info["samplingrate"])
        total = (file_size(dat) - head) // (np.dtype(kind).itemsize * n_channels)
        times = sorted((int(k), float(v)) for k, v in sections.get("sampletimes", {}).items())
        starts = [(i, int(s * 1e6)) for i, s in times] or [(0, start_time(sections.get("patient", {})))]
        channels = [(name, int(i) - 1) for name, i in sections["channelmap"].items()]
        for (a, t), b in zip(starts, [i for i, _ in starts[1:]] + [total]):
            for x in range(a, min(b, total), BATCH):
                out.append(Piece(dat, {"first": x, "end": min(x + BATCH, b, total), "segment": a, "start": t, "kind": kind, "n": n_channels, "head": head, "rate": rate, "calibration": float(info["calibration"]), "channels": channels}))
        return out

    @staticmethod
    def decode(piece, options):
        i = piece.info
        width = np.dtype(i["kind"]).itemsize * i["n"]
        x = np.frombuffer(read_at(piece.path, i["head"] + i["first"] * width, (i["end"] - i["first"]) * width), i["kind"]).reshape(-1, i["n"])
        t = 1e6 * (np.arange(i["first"], i["end"]) - i["segment"]) / i["rate"] + i["start"]
        for name, c in i["channels"]:
            if 0 <= c < i["n"]:
                yield sample_batch(name.strip(), options.get("unit", "uV"), i["rate"], t, x[:, c].astype(float) * i["calibration"])


ALL = (Persyst,)
