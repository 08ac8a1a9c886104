"""Mayo EEG formats: MEF 2 files and MEF 3 sessions."""

from __future__ import annotations

import os
import struct
from collections import defaultdict

import numpy as np

from sigloom.functions.crypto import decrypt, mef2_access, mef3_access
from sigloom.functions.red import decode_mef2, decode_mef3
from sigloom.sources.base import BATCH, Format, Piece, file_size, flag, list_files, read_at, sample_batch, split


def text(b: bytes) -> str:
    return b.split(b"\x00")[0].decode("utf-8", "replace").strip()


def mef2_header(path: str, password: str | None = None) -> dict:
    """Fields by their offsets, fixed by the format. A session's encrypted fields need a password; a subject's are null without theirs."""
    h, level, key = mef2_access(read_at(path, 0, 1024), password)
    if (h[161] and not level) or (h[162] and key is None):
        raise ValueError(f"{path}: the password doesn't open the encrypted session")
    u8, f8, u4, i4 = (lambda o, k=k: struct.unpack_from(k, h, o)[0] for k in ("<Q", "<d", "<I", "<i"))
    person = (lambda o: None) if h[160] and level != 1 else (lambda o: text(h[o : o + 32]))
    out = {"institution": text(h[0:64]), "first_name": person(176), "second_name": person(208), "third_name": person(240), "subject": person(272)}
    out |= {"samples": u8(368), "name": text(h[376:408]), "start": u8(408), "end": u8(416), "rate": f8(424), "low_filter": f8(432), "high_filter": f8(440), "notch": f8(448), "factor": f8(456)}
    out |= {"system": text(h[464:496]), "comments": text(h[496:624]), "study": text(h[624:752]), "number": i4(752), "greatest": i4(808), "least": i4(812), "index_at": u8(816), "blocks": u8(824), "gaps_at": u8(840), "gaps": u4(848)}
    return out | {"subject_sealed": bool(h[160]), "session_sealed": bool(h[161]), "data_sealed": bool(h[162]), "key": key}


#: Fixed layouts: an entry of a MEF 2 file's index, and the head of a block.
INDEX2 = np.dtype([("t", "<u8"), ("at", "<u8"), ("sample", "<u8")])
BLOCK2 = np.dtype([("crc", "<u4"), ("bytes", "<u4"), ("t", "<u8"), ("differences", "<u4"), ("n", "<u4"), ("max", "u1", 3), ("min", "u1", 3), ("gap", "u1")])
#: Blocks in a partition.
BLOCKS = 64


def index_mef2(path: str, h: dict, a: int, b: int) -> tuple[np.ndarray, list[int], list[int | None]]:
    """Entries a to b of a file's index, where each block ends and when the one after it begins."""
    i = np.frombuffer(read_at(path, h["index_at"] + INDEX2.itemsize * a, INDEX2.itemsize * (b + 1 - a if b < h["blocks"] else b - a)), INDEX2)
    last = b == h["blocks"]
    ends = i["at"][1:].tolist() + ([h["index_at"]] if last else [])
    return i[: b - a], ends, i["t"][1:].tolist() + ([None] if last else [])


def plan_mef2(path: str, options: dict, per: int) -> list[Piece]:
    """A partition for every `per` blocks, from the headers alone."""
    out = []
    for f in (x for x in list_files(path) if x.endswith(".mef")):
        h = mef2_header(f, options.get("password"))
        h["name"] = h["name"] or os.path.splitext(os.path.basename(f))[0].strip()
        out += [Piece(f, h | {"cut": cut}) for cut in split(h["blocks"], per)]
    return out


class Mef2(Format):
    """Samples in physical units; a partition is a group of blocks, whose part of the index its task reads.

    Options: password (the subject's or the session's) opens encrypted files, validate=true checks block checksums, clamp=true cuts a block at the next one's start.
    """

    NAME = "mef2"
    APART = True
    ENDS = (".mef",)

    @staticmethod
    def plan(path, options):
        return plan_mef2(path, options, BLOCKS)

    @staticmethod
    def decode(piece, options):
        i = piece.info
        index, ends, nexts = index_mef2(piece.path, i, *i["cut"])
        first = int(index["at"][0])
        raw = read_at(piece.path, first, ends[-1] - first)
        for a, b, following in zip(index["at"].tolist(), ends, nexts):
            t0, x, _ = decode_mef2(raw[a - first : b - first], flag(options, "validate"), i["key"])
            t = t0 + np.arange(len(x)) * (1e6 / i["rate"])
            if flag(options, "clamp") and following is not None:
                keep = t < following
                t, x = t[keep], x[keep]
            yield sample_batch(i["name"], options.get("unit", "uV"), i["rate"], t, x * i["factor"])


class Mef2Blocks(Format):
    """One row a block, from the blocks' heads alone: when it begins, how many samples it has from which on, its extremes, and whether a gap comes before it."""

    NAME = "mef2_blocks"
    APART = True
    ENDS = (".mef",)

    def schema(self):
        return "channel string, rate double, factor double, block long, t_us long, sample long, n long, bytes long, min int, max int, discontinuous boolean"

    @staticmethod
    def plan(path, options):
        return plan_mef2(path, options, 64 * BLOCKS)

    @staticmethod
    def decode(piece, options):
        import pyarrow as pa

        i, (a, b) = piece.info, piece.info["cut"]
        index, ends, _ = index_mef2(piece.path, i, a, b)
        heads = np.frombuffer(b"".join(read_at(piece.path, at, BLOCK2.itemsize) for at in index["at"].tolist()), BLOCK2)
        three = lambda x: (np.left_shift(x.astype(np.int32) @ (1 << np.arange(0, 24, 8, dtype=np.int32)), 8) >> 8).astype(np.int32)
        same = lambda v: np.full(b - a, v)
        cols = [pa.array([i["name"]] * (b - a)), same(i["rate"]), same(i["factor"]), np.arange(a, b), heads["t"].astype(np.int64), index["sample"].astype(np.int64), heads["n"].astype(np.int64), np.asarray(ends, np.int64) - index["at"].astype(np.int64), three(heads["min"]), three(heads["max"]), heads["gap"] > 0]
        yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in cols], names=["channel", "rate", "factor", "block", "t_us", "sample", "n", "bytes", "min", "max", "discontinuous"])


INDEX3 = np.dtype([("at", "<i8"), ("t", "<i8"), ("sample", "<i8"), ("n", "<u4"), ("bytes", "<u4"), ("max", "<i4"), ("min", "<i4"), ("protected", "V4"), ("flags", "u1"), ("rest", "V11")])


#: Fixed value: the recording time offset of a file without one.
NO_OFFSET = -(1 << 63)


def absolute_time(t: int, offset: int) -> int:
    """Negative stored times lack the recording's offset, if it has one."""
    return -t + (0 if offset == NO_OFFSET else offset) if t < 0 else t


def stored_time(t: int, offset: int) -> int:
    """The inverse of absolute_time: with an offset, which must lie before all times, the time less it and negative; without one, a time from 1970 on as it is."""
    if offset == NO_OFFSET and t < 0 or offset != NO_OFFSET and t <= offset:
        raise ValueError(f"time {t} needs a recording offset before it")
    return t if offset == NO_OFFSET else offset - t


def opened(meta: bytes, base: str, password: str | None) -> tuple[bytes, list]:
    """A metadata file with its sections decrypted, and the keys of levels 1 and 2. Encrypted sections need the password of their level."""
    level, *keys = mef3_access(meta, password)
    for flag_at, first, end in ((1024, 2560, 13312), (1025, 13312, 16384)):
        need = struct.unpack_from("b", meta, flag_at)[0]
        if need > 0:
            if level < need:
                raise ValueError(f"{base}: the password doesn't open encrypted metadata")
            meta = meta[:first] + decrypt(meta[first:end], keys[need - 1]) + meta[end:]
    return meta, keys


def recording_offset(path: str, password: str | None) -> int:
    """The recording time offset of a metadata file; none where its section stays closed."""
    meta = read_at(path)
    level, *keys = mef3_access(meta, password)
    need = struct.unpack_from("b", meta, 1025)[0]
    if need > level:
        return NO_OFFSET
    section = decrypt(meta[13312:13328], keys[need - 1]) if need > 0 else meta[13312:13328]
    return struct.unpack_from("<q", section)[0]


def mef3_segments(path: str, password: str | None = None) -> list[dict]:
    """Time-series segments of a session: channel, files, and what their metadata say. Encrypted sections need the password of their level."""
    found: dict[str, dict[str, str]] = defaultdict(dict)
    for f in list_files(path):
        base, ext = os.path.splitext(f)
        if ext in (".tmet", ".tdat", ".tidx"):
            found[base][ext] = f
    out = []
    for base, files in sorted(found.items()):
        if set(files) != {".tmet", ".tdat", ".tidx"}:
            continue
        m, keys = opened(read_at(files[".tmet"]), base, password)
        d = lambda o: struct.unpack_from("<d", m, o)[0]
        q = lambda o: struct.unpack_from("<q", m, o)[0]
        out.append({"name": text(m[52:308]), "session": text(m[308:564]), "segment": struct.unpack_from("<i", m, 48)[0], "rate": d(8720), "factor": d(8760) or 1.0, "unit": text(m[8768:8896]), "first_sample": q(8912), "samples": q(8920), "blocks": q(8928), "offset": q(13312), "files": files, "keys": keys, "start": q(16), "end": q(24)})
    return out


def mef3_index(segment: dict, a: int = 0, b: int | None = None) -> np.ndarray:
    """Entries a to b of a segment's index."""
    return np.frombuffer(read_at(segment["files"][".tidx"], 1024 + INDEX3.itemsize * a, None if b is None else INDEX3.itemsize * (b - a)), INDEX3)


class Mef3(Format):
    """Samples of every channel's segments. A partition is a range of a segment's blocks, planned from the metadata; its task reads
    its part of the index and of these blocks only those that are asked for.

    Options: password opens encrypted files; start and end (microseconds) or first_sample and end_sample
    (counted within the channel) bound what is read; fill=true adds a NaN for each period between blocks.
    """

    NAME = "mef3"

    @staticmethod
    def plan(path, options):
        _, _, first, end = _bounds(options)
        segments = sorted(mef3_segments(path, options.get("password")), key=lambda s: (s["session"], s["name"], s["segment"]))
        out, after = [], {}
        for s in reversed(segments):
            channel = (s["session"], s["name"], os.path.dirname(os.path.dirname(s["files"][".tdat"])))
            s["after"] = after.get(channel)
            n = (file_size(s["files"][".tidx"]) - 1024) // INDEX3.itemsize
            if n:
                after[channel] = s["files"]
            if s["first_sample"] < end and s["first_sample"] + s["samples"] > first:
                out += [Piece(s["files"][".tdat"], s | {"cut": cut, "entries": n}) for cut in split(n, 4 * BLOCKS)][::-1]
        return out[::-1]

    @staticmethod
    def decode(piece, options):
        i, period = piece.info, 1e6 / piece.info["rate"]
        lo, hi, first, end = _bounds(options)
        for at, size, sample, gap in chosen_blocks(i, options):
            t0, x, _ = decode_mef3(read_at(piece.path, at, size), flag(options, "validate"), i["keys"])
            t0, number = absolute_time(t0, i["offset"]), sample + np.arange(len(x))
            t = t0 + np.arange(len(x)) * period
            keep = (t >= lo) & (t < hi) & (number >= first) & (number < end)
            yield sample_batch(i["name"], i["unit"], i["rate"], t[keep], x[keep] * i["factor"])
            if first < sample + len(x) < end:
                for c, d in split(gap, BATCH):
                    t = t0 + (len(x) + np.arange(c, d)) * period
                    t = t[(t >= lo) & (t < hi)]
                    yield sample_batch(i["name"], i["unit"], i["rate"], t, np.full(len(t), np.nan))


def chosen_blocks(segment: dict, options: dict) -> list[tuple[int, int, int, int]]:
    """Of a segment's blocks in its cut those that the options ask for: place, bytes, first sample and the periods missing after it."""
    (a, b), n, period = segment["cut"], segment["entries"], 1e6 / segment["rate"]
    lo, hi, first, end = _bounds(options)
    index = mef3_index(segment, a, min(b + 1, n))
    times = [absolute_time(int(t), segment["offset"]) for t in index["t"]]
    if b == n:
        times.append(absolute_time(int(mef3_index({"files": segment["after"]}, 0, 1)["t"][0]), segment["offset"]) if segment["after"] else None)
    index = index[: b - a]
    ends = [t + n * period for t, n in zip(times, index["n"].tolist())]
    gaps = [round((later - e) / period) if flag(options, "fill") and later is not None and later - e > period / 2 else 0 for e, later in zip(ends, times[1:])]
    samples = segment["first_sample"] + index["sample"] - (mef3_index(segment, 0, 1)["sample"][0] if a else index["sample"][:1].sum())
    keep = [k for k in range(b - a) if times[k] < hi and ends[k] + gaps[k] * period > lo and samples[k] < end and samples[k] + index["n"][k] > first]
    return [(int(index["at"][k]), int(index["bytes"][k]), int(samples[k]), gaps[k]) for k in keep]


def _bounds(options: dict) -> tuple[int, int, int, int]:
    """start, end, first_sample, end_sample."""
    whole = (("start", -(2**62)), ("end", 2**62), ("first_sample", 0), ("end_sample", 2**62))
    return tuple(int(options.get(k, v)) for k, v in whole)


def mef3_channels(spark, path: str):
    """One row per segment: names, rate, factor, samples, bounds."""
    fields = ("session", "name", "segment", "rate", "factor", "unit", "first_sample", "samples", "blocks", "start", "end")
    rows = [tuple(s[f] for f in fields) for s in mef3_segments(path)]
    return spark.createDataFrame(rows, "session string, name string, segment int, rate double, factor double, unit string, first_sample long, samples long, blocks long, `start` long, `end` long")


#: Columns of a MEF 2 file's header.
MEF2_FIELDS = "name string, samples long, start long, end long, rate double, factor double, blocks long, gaps long, institution string, first_name string, second_name string, third_name string, subject string, system string, comments string, study string, number int, low_filter double, high_filter double, notch double, least int, greatest int, subject_sealed boolean, session_sealed boolean, data_sealed boolean"


def mef2_channels(spark, path: str, password: str | None = None):
    """One row per file: all fields of its header. A subject's fields are null where the password doesn't open them."""
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(MEF2_FIELDS)
    rows = [tuple(h[f] for f in schema.names) for h in (mef2_header(f, password) for f in list_files(path) if f.endswith(".mef"))]
    return spark.createDataFrame(rows, schema)


ALL = (Mef2, Mef2Blocks, Mef3)


def write_mef3(ranges, path: str, factor: float = 1.0, unit: str = "uV", per_segment: int = 64, block: int = 4096, residual: float | None = None, detrend: bool = False, least_normality: float | None = 0.5):
    """Writes stored ranges (channel_id, rate, lo, values) as a MEF 3 session, per_segment ranges to a segment; values become whole multiples of factor.

    With residual, blocks normal enough lose as much as keeps their mean residual ratio under it, without their trend if detrend is set; all blocks of a
    segment are searched at once.

    Segments are written by executors to a folder that all nodes share. Returns one row per segment: channel_id, segment, samples.
    """
    import pandas as pd
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from sigloom.functions import lossy
    from sigloom.functions.red import encode_mef3
    from sigloom.sources.base import filesystem

    over = Window.partitionBy("channel_id").orderBy("lo")
    rows = ranges.select("channel_id", "rate", "lo", "values", F.floor((F.row_number().over(over) - 1) / F.lit(per_segment)).cast("int").alias("segment"), (F.sum(F.size("values")).over(over) - F.size("values")).cast("long").alias("first"))

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lo")
        name, number, rate = pdf["channel_id"].iloc[0], int(pdf["segment"].iloc[0]), float(pdf["rate"].iloc[0])
        data, index, expected = bytearray(1024), [], None
        arrays = [np.rint(np.asarray(values, float) / factor).astype(np.int64) for values in pdf["values"]]
        cuts = [len(x[a : a + block]) for x in arrays for a in range(0, len(x), block)]
        ptr = np.r_[0, np.cumsum(cuts)].astype(np.int64)
        plan = None if residual is None or not cuts else lossy.for_residual(np.concatenate(arrays), ptr, residual, detrend, least_normality)
        n_block = 0
        for lo, x, first in zip(pdf["lo"], arrays, pdf["first"]):
            for a in range(0, len(x), block):
                part, t = x[a : a + block], int(lo + a * 1e6 / rate)
                gap = expected is None or abs(t - expected) > 1e6 / rate
                b = encode_mef3(t, part, gap) if plan is None else lossy.encode_block(t, part, gap, plan.scale[n_block], plan.slope[n_block], plan.intercept[n_block])
                n_block += 1
                e = np.zeros(1, INDEX3)
                e["at"], e["t"], e["sample"], e["n"], e["bytes"], e["max"], e["min"], e["flags"] = len(data), t, first + a, len(part), len(b), part.max(), part.min(), int(gap)
                index.append(e.tobytes())
                data += b
                expected = t + len(part) * 1e6 / rate
        n = int(sum(len(v) for v in pdf["values"]))
        start, end = int(pdf["lo"].iloc[0]), int(expected or pdf["lo"].iloc[0])

        def head(kind: bytes, entries: int) -> bytearray:
            h = bytearray(1024)
            h[8:12], h[13], h[14], h[15] = kind, 3, 0, 1
            struct.pack_into("<qqq", h, 16, start, end, entries)
            struct.pack_into("<i", h, 48, number)
            h[52 : 52 + len(name.encode()[:255])] = name.encode()[:255]
            return h

        meta = head(b"tmet", 1) + bytearray(16384 - 1024)
        for at, v in ((8720, rate), (8760, factor)):
            struct.pack_into("<d", meta, at, v)
        meta[8768 : 8768 + len(unit)] = unit.encode()
        struct.pack_into("<qqq", meta, 8912, int(pdf["first"].iloc[0]), n, len(index))
        data[:1024] = head(b"tdat", len(index))
        fs, root = filesystem(path)
        base = f"{name}-{number:06d}"
        folder = f"{root}/{name}.timd/{base}.segd"
        fs.create_dir(folder, recursive=True)
        for ext, content in ((".tmet", meta), (".tidx", head(b"tidx", len(index)) + b"".join(index)), (".tdat", data)):
            with fs.open_output_stream(f"{folder}/{base}{ext}") as out:
                out.write(bytes(content))
        return pd.DataFrame({"channel_id": [name], "segment": [number], "samples": [n]})

    return rows.groupBy("channel_id", "segment").applyInPandas(write, "channel_id string, segment int, samples long")
