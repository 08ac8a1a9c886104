"""Records of MEF 3 sessions: notes, annotations, seizures, stimulations and system logs of a session, its channels and segments.

A record is a header of 24 bytes and a body whose layout its type decides; an index file lists type, place and time of
each. A partition is a range of index entries, planned from file sizes alone: the driver reads no index.
"""

from __future__ import annotations

import bisect
import hashlib
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema

from sigloom.functions.crypto import decrypt, encrypt_block, mef3_access, password_key
from sigloom.functions.red import crc32_koopman
from sigloom.sources.base import Format, Piece, file_size, filesystem, flag, read_at, sized_files, split
from sigloom.sources.mef import NO_OFFSET, absolute_time, recording_offset, text

#: Bytes of a universal header, of a record's header and of an index entry.
UNIVERSAL, HEADER, ENTRY = 1024, 24, 24
#: Fixed layout of an index entry.
INDEX = np.dtype([("type", "S4"), ("end", "u1"), ("major", "u1"), ("minor", "u1"), ("encryption", "i1"), ("at", "<i8"), ("t", "<i8")])
#: Fixed values of the record types.
SEIZURE = np.dtype([("earliest_onset", "<i8"), ("latest_offset", "<i8"), ("duration", "<i8"), ("n", "<i4"), ("onset_code", "<i4"), ("marker_1", "S128"), ("marker_2", "S128"), ("annotation", "S1024")])
SEIZURE_CHANNEL = np.dtype([("name", "S256"), ("onset", "<i8"), ("offset", "<i8")])
COGNITIVE = np.dtype([("task_type", "S64"), ("duration", "<i8"), ("stimulus_type", "S64"), ("response", "S64")])
ELECTRIC = np.dtype([("amplitude", "<f8"), ("frequency", "<f8"), ("pulse_width", "<i8"), ("unit_code", "<i4"), ("mode_code", "<i4"), ("waveform", "S128"), ("anode", "S128"), ("cathode", "S128")])
ONSETS = ("unknown", "focal", "generalized", "propagated", "mixed")
UNITS, MODES = ("unknown", "mA", "V"), ("unknown", "current", "voltage")

#: Entries in a partition.
PART = 65_536
BATCH = 1024

_S, _L, _I = pa.string(), pa.int64(), pa.int32()
_SEIZED = pa.struct({"name": _S, "onset": _L, "offset": _L})
_SEIZURE = pa.struct({"earliest_onset": _L, "latest_offset": _L, "onset": _S, "marker_1": _S, "marker_2": _S, "annotation": _S, "channels": pa.list_(_SEIZED)})
_COGNITIVE = pa.struct({"task_type": _S, "stimulus_type": _S, "response": _S})
_ELECTRIC = pa.struct({"amplitude": pa.float64(), "frequency": pa.float64(), "pulse_width": _L, "unit": _S, "mode": _S, "waveform": _S, "anode": _S, "cathode": _S})
#: A row a record: where it stands, its header, and by its type one of the columns from text on.
SCHEMA = pa.schema({
    "level": _S, "session": _S, "channel": _S, "segment": _I, "number": _L, "type": _S, "version": _S, "t_us": _L, "encryption": _I, "readable": pa.bool_(), "valid": pa.bool_(),
    "text": _S, "duration_us": _L, "template": pa.list_(_I), "seizure": _SEIZURE, "cognitive": _COGNITIVE, "electric": _ELECTRIC, "body": pa.binary(),
})
LEVELS = {".mefd": "session", ".timd": "channel", ".vidd": "channel", ".segd": "segment"}


def named(code: int, names: tuple[str, ...]) -> str | None:
    """A code's name; null where there is no entry (-1) or no such code."""
    return names[code] if 0 <= code < len(names) else None


def layout(kind: np.dtype, body: bytes) -> dict:
    """A body's fixed part as texts and numbers, cut or filled up with zeros to its length."""
    row = np.frombuffer(body[: kind.itemsize].ljust(kind.itemsize, b"\0"), kind)[0]
    return {n: text(bytes(row[n])) if kind[n].kind == "S" else row[n].item() for n in kind.names}


def read_body(kind: str, body: bytes, at) -> dict:
    """The columns of a record by its type; of an unknown type, the body itself. at: makes times absolute."""
    if kind in ("Note", "SyLg"):
        return {"text": text(body)}
    if kind == "EDFA":
        return {"duration_us": struct.unpack_from("<q", body)[0], "text": text(body[8:])}
    if kind == "LNTP":
        n = struct.unpack_from("<q", body)[0]
        return {"template": np.frombuffer(body, "<i4", n, 8).tolist()}
    if kind == "Seiz":
        s = layout(SEIZURE, body)
        rows = [layout(SEIZURE_CHANNEL, body[a : a + SEIZURE_CHANNEL.itemsize]) for a in range(SEIZURE.itemsize, SEIZURE.itemsize + s["n"] * SEIZURE_CHANNEL.itemsize, SEIZURE_CHANNEL.itemsize)]
        entry = lambda t: None if t == -1 else at(t)
        channels = [{"name": r["name"], "onset": entry(r["onset"]), "offset": entry(r["offset"])} for r in rows]
        own = {k: s[k] for k in ("marker_1", "marker_2", "annotation")}
        return {"duration_us": s["duration"], "seizure": {"earliest_onset": at(s["earliest_onset"]), "latest_offset": at(s["latest_offset"]), "onset": named(s["onset_code"], ONSETS), "channels": channels, **own}}
    if kind == "CSti":
        c = layout(COGNITIVE, body)
        return {"duration_us": c.pop("duration"), "cognitive": c}
    if kind == "ESti":
        e = layout(ELECTRIC, body)
        return {"electric": e | {"unit": named(e.pop("unit_code"), UNITS), "mode": named(e.pop("mode_code"), MODES)}}
    return {"body": body}


class Mef3Records(Format):
    """One row a record. Options: password opens encrypted records of its level (others come with readable = false and their
    sealed body); start and end (microseconds, half-open) and types (comma-separated) choose records by the index; validate=true fills in `valid`."""

    NAME = "mef3_records"
    APART = True

    def schema(self):
        return from_arrow_schema(SCHEMA)

    @classmethod
    def works(cls, path, options):
        """Files of records with their index and the first metadata file of their session, if they have them."""
        size = dict(sized_files(path))
        metas = [m for m in size if m.endswith((".tmet", ".vmet"))]
        out = []
        for f in (x for x in size if os.path.splitext(x)[1] == ".rdat"):
            index = os.path.splitext(f)[0] + ".ridx"
            session = f[: f.index(".mefd") + 5] if ".mefd" in f else os.path.dirname(f)
            k = bisect.bisect_left(metas, session)
            meta = metas[k] if k < len(metas) and metas[k].startswith(session) else None
            out.append(((f, index if index in size else None, meta), size[f]))
        return out

    @classmethod
    def plan(cls, path, options):
        return [p for work, _ in cls.works(path, options) for p in cls.plan_work(work, options)]

    @classmethod
    def plan_work(cls, work, options):
        f, index, meta = work
        info = {"level": LEVELS.get(os.path.splitext(os.path.dirname(f))[1], "session"), "index": index, "meta": meta}
        cuts = split(max((file_size(index) - UNIVERSAL) // ENTRY, 0), PART) if index else [(0, 0)]
        return [Piece(f, info | {"cut": cut}) for cut in cuts]

    @staticmethod
    def decode(piece, options):
        i, password = piece.info, options.get("password")
        lo, hi = int(options.get("start", -(2**62))), int(options.get("end", 2**62))
        types = {x.strip() for x in options["types"].split(",")} if options.get("types") else None
        head = read_at(piece.path, 0, UNIVERSAL)
        level, *keys = mef3_access(head, password)
        offset = recording_offset(i["meta"], password) if i["meta"] else NO_OFFSET
        at = lambda t: absolute_time(t, offset)
        number = struct.unpack_from("<i", head, 48)[0]
        own = {"level": i["level"], "session": text(head[308:564]), "channel": text(head[52:308]) or None if i["level"] != "session" else None, "segment": number if i["level"] == "segment" else None}
        rows = []
        for k, begin in places(piece, lo, hi, types, at):
            h = read_at(piece.path, begin, HEADER)
            crc, kind, major, minor, sealed, size, t = struct.unpack("<I4sxBBbIq", h)
            body, kind, t = read_at(piece.path, begin + HEADER, size), kind.decode("latin-1"), at(t)
            if not lo <= t < hi or types and kind not in types:
                continue
            valid = None
            if flag(options, "validate") and crc:
                valid = sealed >= 0 and crc32_koopman(h[4:] + body) == crc
            readable = sealed <= 0 or sealed <= level
            if sealed > 0 and readable:
                whole = len(body) // 16 * 16
                body = decrypt(body[:whole], keys[sealed - 1]) + body[whole:]
            rows.append(own | {"number": k, "type": kind, "version": f"{major}.{minor}", "t_us": t, "encryption": sealed, "readable": readable, "valid": valid} | (read_body(kind, body, at) if readable else {"body": body}))
            if len(rows) == BATCH:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)


def places(piece: Piece, lo: int, hi: int, types: set[str] | None, at):
    """(number, place) of the records to read: of the index's entries, or one after the other where there is none."""
    a, b = piece.info["cut"]
    if piece.info["index"] is not None:
        for k, e in enumerate(np.frombuffer(read_at(piece.info["index"], UNIVERSAL + ENTRY * a, ENTRY * (b - a)), INDEX), a):
            if lo <= at(int(e["t"])) < hi and (types is None or e["type"].decode("latin-1") in types):
                yield k, int(e["at"])
        return
    begin, end, k = UNIVERSAL, file_size(piece.path), 0
    while begin + HEADER <= end:
        yield k, begin
        begin, k = begin + HEADER + struct.unpack_from("<I", read_at(piece.path, begin, HEADER), 12)[0], k + 1


def batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=SCHEMA)


def sealed_text(value: str | None, size: int | None = None) -> bytes:
    """A text with its end, cut or filled up to size."""
    data = (value or "").encode()
    return data + b"\0" if size is None else data[: size - 1].ljust(size, b"\0")


def write_body(r: dict) -> bytes:
    """A record's body by its type, the inverse of read_body; of a type without a layout, the body given."""
    kind, duration = r["type"], r.get("duration_us") or 0
    code = lambda name, names: names.index(name) if name in names else -1
    if kind in ("Note", "SyLg"):
        return sealed_text(r.get("text"))
    if kind == "EDFA":
        return struct.pack("<q", duration) + sealed_text(r.get("text"))
    if kind == "LNTP":
        x = np.asarray(r.get("template") or [], "<i4")
        return struct.pack("<q", len(x)) + x.tobytes()
    if kind == "Seiz":
        s = r.get("seizure") or {}
        channels = s.get("channels") or []
        time = lambda t: -1 if t is None else t
        head = struct.pack("<qqqii", s.get("earliest_onset") or 0, s.get("latest_offset") or 0, duration, len(channels), code(s.get("onset"), ONSETS))
        head += sealed_text(s.get("marker_1"), 128) + sealed_text(s.get("marker_2"), 128) + sealed_text(s.get("annotation"), 1024)
        return head + b"".join(sealed_text(c["name"], 256) + struct.pack("<qq", time(c["onset"]), time(c["offset"])) for c in channels)
    if kind == "CSti":
        c = r.get("cognitive") or {}
        return sealed_text(c.get("task_type"), 64) + struct.pack("<q", duration) + sealed_text(c.get("stimulus_type"), 64) + sealed_text(c.get("response"), 64)
    if kind == "ESti":
        e = r.get("electric") or {}
        numbers = struct.pack("<ddqii", e.get("amplitude") or 0.0, e.get("frequency") or 0.0, e.get("pulse_width") or 0, code(e.get("unit"), UNITS), code(e.get("mode"), MODES))
        return numbers + sealed_text(e.get("waveform"), 128) + sealed_text(e.get("anode"), 128) + sealed_text(e.get("cathode"), 128)
    return r.get("body") or b""


def records_file(rows: list[dict], session: str, channel: str | None, segment: int, keys: tuple) -> tuple[bytes, bytes]:
    """A record file and its index, in order of time."""
    head = bytearray(UNIVERSAL)
    head[12], head[13], head[15] = 0, 3, 1
    times = [r["t_us"] for r in rows]
    struct.pack_into("<qqq", head, 16, min(times), max(times), len(rows))
    struct.pack_into("<i", head, 48, segment)
    head[52:308], head[308:564] = sealed_text(channel, 256), sealed_text(session, 256)
    validate(head, *keys)
    data, index = bytearray(head), bytearray(head)
    data[8:12], index[8:12] = b"rdat", b"ridx"
    for r in sorted(rows, key=lambda r: r["t_us"]):
        body, level = write_body(r), r.get("encryption") or 0
        body += bytes(-len(body) % 16)
        if level > 0:
            if keys[level - 1] is None:
                raise ValueError(f"a record of level {level} needs that level's password")
            body = b"".join(encrypt_block(body[a : a + 16], keys[level - 1]) for a in range(0, len(body), 16))
        major, minor = (int(x) for x in (r.get("version") or "1.0").split("."))
        own = struct.pack("<4sxBBbIq", r["type"].encode("latin-1"), major, minor, level, len(body), r["t_us"]) + body
        index += own[:8] + struct.pack("<qq", len(data), r["t_us"])
        data += struct.pack("<I", crc32_koopman(own)) + own
    return bytes(data), bytes(index)


def write_records(records: DataFrame, path: str, passwords: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Writes records (the columns of mef3_records) as files of a session in a folder all nodes share; one row a file: its name and its number of records.

    Records of a session, channel or segment are one file, written by one task, so few as people and devices make them. passwords: of
    levels 1 and 2, for records whose encryption asks for them.
    """
    keys = tuple(None if p is None else password_key(p) for p in passwords)
    named = [f.name for f in SCHEMA if f.name in records.columns]
    where = ["level", "session", "channel", "segment"]

    def write(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        level, session, channel, segment = (rows[0][c] for c in where)
        folder, base, number = f"{session}.mefd", session, -3
        if level != "session":
            folder, base, number = f"{folder}/{channel}.timd", channel, -2
        if level == "segment":
            folder, base, number = f"{folder}/{channel}-{segment:06d}.segd", f"{channel}-{segment:06d}", segment
        fs, root = filesystem(path)
        fs.create_dir(f"{root}/{folder}", recursive=True)
        for ext, content in zip((".rdat", ".ridx"), records_file(rows, session, channel, number, keys)):
            with fs.open_output_stream(f"{root}/{folder}/{base}{ext}", compression=None) as out:
                out.write(content)
        return pa.table({"name": [f"{folder}/{base}"], "records": pa.array([len(rows)], pa.int64())})

    return records.select(*named).groupBy(*where).applyInArrow(write, "name string, records long")


def validate(head: bytearray, one: bytes | None, two: bytes | None) -> None:
    """The fields by which passwords of levels 1 and 2 are known again."""
    digest = lambda k: hashlib.sha256(k).digest()[:16]
    if one is not None:
        head[868:884] = digest(one)
        if two is not None:
            head[884:900] = bytes(a ^ b for a, b in zip(digest(two), one))


ALL = (Mef3Records,)
