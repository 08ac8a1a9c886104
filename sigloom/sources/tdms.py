"""TDMS: segments of metadata objects and raw data, contiguous or interleaved."""

from __future__ import annotations

import struct

import numpy as np

from sigloom.sources.base import BATCH, Format, Piece, file_size, list_files, read_at, sample_batch, split

#: Fixed values of the format: flags of a segment and codes of types.
NEW_OBJECTS, RAW, INTERLEAVED, BIG_ENDIAN, DAQMX = 1 << 2, 1 << 3, 1 << 5, 1 << 6, 1 << 7
TYPES = {1: "i1", 2: "i2", 3: "i4", 4: "i8", 5: "u1", 6: "u2", 7: "u4", 8: "u8", 9: "f4", 10: "f8", 0x19: "f4", 0x1A: "f8"}
STRING, BOOLEAN, STAMP = 0x20, 0x21, 0x44
NO_DATA, SAME = 0xFFFFFFFF, 0
EPOCH = 2_082_844_800


class Reader:
    def __init__(self, data: bytes, order: str):
        self.data, self.at, self.order = data, 0, order

    def number(self, code: str):
        (v,) = struct.unpack_from(self.order + code, self.data, self.at)
        self.at += struct.calcsize(code if code not in "qQ" else "<" + code)
        return v

    def text(self) -> str:
        n = self.number("I")
        self.at += n
        return self.data[self.at - n : self.at].decode("utf-8", "replace")

    def value(self, kind: int):
        if kind == STRING:
            return self.text()
        if kind == BOOLEAN:
            return bool(self.number("B"))
        if kind == STAMP:
            a, b = (self.number("Q"), self.number("q")) if self.order == "<" else (self.number("q"), self.number("Q"))
            fraction, seconds = (a, b) if self.order == "<" else (b, a)
            return (seconds - EPOCH) * 1_000_000 + int(fraction / 2**64 * 1e6)
        if kind in TYPES:
            t = np.dtype(TYPES[kind]).newbyteorder(self.order)
            self.at += t.itemsize
            return np.frombuffer(self.data, t, 1, self.at - t.itemsize)[0].item()
        raise ValueError(f"unsupported property type {kind:#x}")


def scan(path: str) -> dict[str, dict]:
    """Objects with their properties and the places of their values: (offset, stride, count, type)."""
    objects: dict[str, dict] = {}
    active: list[str] = []
    at, size = 0, file_size(path)
    while at + 28 <= size:
        lead = read_at(path, at, 28)
        if lead[:4] != b"TDSm":
            break
        (toc,) = struct.unpack_from("<I", lead, 4)
        order = ">" if toc & BIG_ENDIAN else "<"
        next_at, raw_at = struct.unpack_from(order + "QQ", lead, 12)
        end = size if next_at == 0xFFFFFFFFFFFFFFFF else at + 28 + next_at
        if toc & DAQMX:
            raise ValueError(f"{path}: raw device data isn't supported")
        if raw_at:
            r = Reader(read_at(path, at + 28, raw_at), order)
            if toc & NEW_OBJECTS:
                active = []
            for _ in range(r.number("I")):
                name = r.text()
                o = objects.setdefault(name, {"props": {}, "parts": [], "index": None})
                head = r.number("I")
                if head == NO_DATA:
                    if name in active:
                        active.remove(name)
                else:
                    if head != SAME:
                        kind = r.number("I")
                        r.number("I")
                        n = r.number("Q")
                        if kind == STRING:
                            r.number("Q")
                        o["index"] = (kind, n)
                    if name not in active:
                        active.append(name)
                for _ in range(r.number("I")):
                    key = r.text()
                    o["props"][key] = r.value(r.number("I"))
        if toc & RAW and active:
            data_at = at + 28 + raw_at
            layout = [(n, *objects[n]["index"]) for n in active if objects[n]["index"]]
            if all(k in TYPES for _, k, _ in layout):
                width = [np.dtype(TYPES[k]).itemsize for _, k, _ in layout]
                chunk = sum(w * n for w, (_, _, n) in zip(width, layout))
                for c in range((end - data_at) // chunk if chunk else 0):
                    inside = data_at + c * chunk
                    for w, (name, kind, n) in zip(width, layout):
                        stride = sum(width) if toc & INTERLEAVED else w
                        objects[name]["parts"].append((inside, stride, n, order + TYPES[kind]))
                        inside += w if toc & INTERLEAVED else w * n
        at = end
    return objects


class Tdms(Format):
    """Channels with data and without decimation; a partition is a stretch of a channel's part. Units default to V."""

    NAME = "tdms"
    APART = True
    ENDS = (".tdms",)

    @staticmethod
    def plan(path, options):
        out = []
        for f in (x for x in list_files(path) if x.endswith(".tdms")):
            for name, o in scan(f).items():
                p = o["props"]
                if name.count("'/'") != 1 or not o["parts"] or int(p.get("DecimationLevel", 0)):
                    continue
                step, done = float(p.get("wf_increment", 1.0)), 0
                info = {"name": name.split("'/'")[1].rstrip("'").replace("''", "'"), "unit": p.get("unit_string") or "V", "step": step, "start": int(p.get("wf_start_time", 0))}
                for at, stride, n, kind in o["parts"]:
                    out += [Piece(f, info | {"at": at + a * stride, "stride": stride, "n": b - a, "kind": kind, "first": done + a}) for a, b in split(n, BATCH)]
                    done += n
        return out

    @staticmethod
    def decode(piece, options):
        i = piece.info
        t = np.dtype(i["kind"])
        raw = read_at(piece.path, i["at"], (i["n"] - 1) * i["stride"] + t.itemsize)
        x = np.ndarray((i["n"],), t, raw, strides=(i["stride"],)).astype(float)
        yield sample_batch(i["name"], i["unit"], 1 / i["step"], i["start"] + np.arange(i["first"], i["first"] + i["n"]) * (i["step"] * 1e6), x)


ALL = (Tdms,)
