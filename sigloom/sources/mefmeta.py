"""Metadata of MEF 3 sessions: of segments as they are read, folded to channels and to one nested row a session; video clips.

A partition is some segments' metadata files, which its task opens; the driver only lists them. Folding is grouping: what all
segments of a channel (or channels of a session) agree on stays, what they don't is null, counts are added up and extremes taken.
"""

from __future__ import annotations

import math
import os
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sigloom.functions.crypto import decrypt, mef3_access
from sigloom.sources.base import Format, Piece, file_size, list_files, read_at, split
from sigloom.sources.mef import NO_OFFSET, absolute_time, text

_S, _L, _I, _D = pa.string(), pa.int64(), pa.int32(), pa.float64()
#: Fixed layout: name, offset, form and the value that stands for none; a number as form is a text of so many bytes.
BOTH = (("channel_description", 2560, 2048, ""), ("session_description", 4608, 2048, ""), ("recording_duration", 6656, "<q", -1))
SERIES = (
    ("reference_description", 6664, 2048, ""), ("acquisition_channel", 8712, "<q", -1), ("rate", 8720, "<d", -1.0), ("low_filter", 8728, "<d", -1.0), ("high_filter", 8736, "<d", -1.0), ("notch_filter", 8744, "<d", -1.0),
    ("line_frequency", 8752, "<d", -1.0), ("factor", 8760, "<d", 0.0), ("unit", 8768, 128, ""), ("greatest", 8896, "<d", None), ("least", 8904, "<d", None), ("first_sample", 8912, "<q", -1), ("samples", 8920, "<q", -1),
    ("blocks", 8928, "<q", -1), ("block_bytes", 8936, "<q", -1), ("block_samples", 8944, "<I", 0xFFFFFFFF), ("difference_bytes", 8948, "<I", 0xFFFFFFFF), ("block_interval", 8952, "<q", -1), ("discontinuities", 8960, "<q", -1),
    ("contiguous_blocks", 8968, "<q", -1), ("contiguous_bytes", 8976, "<q", -1), ("contiguous_samples", 8984, "<q", -1),
)
VIDEO = (("width", 6664, "<q", -1), ("height", 6672, "<q", -1), ("frame_rate", 6680, "<d", -1.0), ("clips", 6688, "<q", -1), ("clip_bytes", 6696, "<q", -1), ("format", 6704, 128, ""))
PRIVATE = (("recording_offset", 13312, "<q", NO_OFFSET), ("dst_start", 13320, "<q", NO_OFFSET), ("dst_end", 13328, "<q", NO_OFFSET), ("gmt_offset", 13336, "<i", -86401), ("name_1", 13340, 128, ""), ("name_2", 13468, 128, ""), ("subject", 13596, 128, ""), ("location", 13724, 512, ""))
#: How a value folds that needn't agree.
SUMS, GREATEST, LEAST = ("samples", "blocks", "clips"), ("greatest", "block_bytes", "block_samples", "difference_bytes", "discontinuities", "contiguous_blocks", "contiguous_bytes", "contiguous_samples", "clip_bytes"), ("least", "first_sample")
#: Fixed layout of a video file's index.
CLIP = np.dtype([("start", "<i8"), ("end", "<i8"), ("first_frame", "<u4"), ("last_frame", "<u4"), ("at", "<i8"), ("bytes", "<i8"), ("rest", "V24")])
PART = 64


def kind_of(fields) -> pa.StructType:
    types = {"<q": _L, "<I": _L, "<i": _I, "<d": _D}
    return pa.struct([(n, types.get(form, _S)) for n, _, form, _ in fields])


SCHEMA = pa.schema({
    "session": _S, "channel": _S, "kind": _S, "segment": _I, "anonymized": _S, "start": _L, "end": _L, "level_2": _I, "level_3": _I, "opened": _I,
    "general": kind_of(BOTH), "series": kind_of(SERIES), "video": kind_of(VIDEO), "private": kind_of(PRIVATE), "path": _S,
})


def read_fields(m: bytes, fields) -> dict:
    out = {}
    for name, at, form, none in fields:
        v = text(m[at : at + form]) if isinstance(form, int) else struct.unpack_from(form, m, at)[0]
        out[name] = None if v == none or (isinstance(v, float) and math.isnan(v)) else v
    return out


def read_segment(path: str, password: str | None) -> dict:
    """A row of SCHEMA. Sections that the password doesn't open are null; negative times lack the recording's offset, which is added if known."""
    m = read_at(path)
    level, *keys = mef3_access(m, password)
    need_2, need_3 = struct.unpack_from("bb", m, 1024)
    if 0 < need_2 <= level:
        m = m[:2560] + decrypt(m[2560:13312], keys[need_2 - 1]) + m[13312:]
    if 0 < need_3 <= level:
        m = m[:13312] + decrypt(m[13312:16384], keys[need_3 - 1])
    open_2, open_3, video = need_2 <= level, need_3 <= level, path.endswith(".vmet")
    private = read_fields(m, PRIVATE) if open_3 else None
    offset = private["recording_offset"] if private and private["recording_offset"] is not None else NO_OFFSET
    time = lambda at: None if (t := struct.unpack_from("<q", m, at)[0]) == NO_OFFSET else absolute_time(t, offset)
    own = {"session": text(m[308:564]), "channel": text(m[52:308]), "kind": "video" if video else "time_series", "segment": struct.unpack_from("<i", m, 48)[0], "anonymized": text(m[564:820]) or None}
    own |= {"start": time(16), "end": time(24), "level_2": need_2, "level_3": need_3, "opened": level, "general": read_fields(m, BOTH) if open_2 else None}
    return own | {"series": read_fields(m, SERIES) if open_2 and not video else None, "video": read_fields(m, VIDEO) if open_2 and video else None, "private": private, "path": path}


class Mef3Segments(Format):
    """One row a segment, time series and video. Option password opens sections of its level."""

    NAME = "mef3_segments"

    def schema(self):
        return from_arrow_schema(SCHEMA)

    @staticmethod
    def plan(path, options):
        files = [f for f in list_files(path) if f.endswith((".tmet", ".vmet"))]
        return [Piece(files[a], {"files": files[a:b]}) for a, b in split(len(files), PART)]

    @staticmethod
    def decode(piece, options):
        yield pa.RecordBatch.from_pylist([read_segment(f, options.get("password")) for f in piece.info["files"]], schema=SCHEMA)


class Mef3VideoClips(Format):
    """One row a clip, from the video channels' indexes."""

    NAME = "mef3_video_clips"
    COLUMNS = pa.schema({"session": _S, "channel": _S, "segment": _I, "clip": _L, "start": _L, "end": _L, "first_frame": _L, "last_frame": _L, "at": _L, "bytes": _L})

    def schema(self):
        return from_arrow_schema(self.COLUMNS)

    @staticmethod
    def plan(path, options):
        return [Piece(f, {"cut": cut}) for f in list_files(path) if f.endswith(".vidx") for cut in split((file_size(f) - 1024) // CLIP.itemsize, 1 << 16)]

    @staticmethod
    def decode(piece, options):
        a, b = piece.info["cut"]
        head, rows = read_at(piece.path, 0, 1024), np.frombuffer(read_at(piece.path, 1024 + CLIP.itemsize * a, CLIP.itemsize * (b - a)), CLIP)
        meta = os.path.splitext(piece.path)[0] + ".vmet"
        offset = (read_segment(meta, options.get("password"))["private"] or {}).get("recording_offset")
        time = lambda c: pa.array([absolute_time(int(t), NO_OFFSET if offset is None else offset) for t in rows[c]], _L)
        same = lambda v, t: pa.array([v] * (b - a), t)
        cols = [same(text(head[308:564]), _S), same(text(head[52:308]), _S), same(struct.unpack_from("<i", head, 48)[0], _I), pa.array(np.arange(a, b)), time("start"), time("end"), *[pa.array(rows[c].astype(np.int64)) for c in ("first_frame", "last_frame", "at", "bytes")]]
        yield pa.RecordBatch.from_arrays(cols, schema=Mef3VideoClips.COLUMNS)


def agreed(c: Column) -> Column:
    """The value that all rows have; null if they differ or one has none."""
    return F.when((F.min(c) == F.max(c)) & (F.count(c) == F.count("*")), F.min(c))


def folded(struct_name: str, fields) -> Column:
    parts = []
    for name, *_ in fields:
        c = F.col(f"{struct_name}.{name}")
        parts.append((F.sum(c) if name in SUMS else F.max(c) if name in GREATEST else F.min(c) if name in LEAST else agreed(c)).alias(name))
    return F.when(F.count(struct_name) > 0, F.struct(*parts)).alias(struct_name)


def _fold() -> list[Column]:
    level = [agreed(F.col(c)).alias(c) for c in ("anonymized", "level_2", "level_3")]
    return [F.min("start").alias("start"), F.max("end").alias("end"), *level, *[folded(n, f) for n, f in (("general", BOTH), ("series", SERIES), ("video", VIDEO), ("private", PRIVATE))]]


def channels(segments: DataFrame) -> DataFrame:
    """One row a channel: what its segments come to, and the segments, in order. The recording's duration is that from its earliest start to its latest end."""
    one = F.sort_array(F.collect_list(F.struct("segment", "start", "end", "general", "series", "video", "path")))
    rows = segments.groupBy("session", "kind", "channel").agg(F.count("*").alias("n_segments"), *_fold(), one.alias("segments"))
    span = F.col("end") - F.col("start") + 1
    return rows.withColumn("general", F.when(F.col("general").isNotNull(), F.col("general").withField("recording_duration", span)))


def sessions(segments: DataFrame) -> DataFrame:
    """One nested row a session: its bounds, what its channels come to by kind, and the channels with their segments."""
    rows = channels(segments)
    one = lambda kind: F.sort_array(F.collect_list(F.when(F.col("kind") == kind, F.struct("channel", "n_segments", "start", "end", "general", "series", "video", "segments"))))
    return rows.groupBy("session").agg(F.count_if(F.col("kind") == "time_series").alias("n_series"), F.count_if(F.col("kind") == "video").alias("n_video"), *_fold(), one("time_series").alias("series_channels"), one("video").alias("video_channels"))


def basic_info(segments: DataFrame) -> DataFrame:
    """Name, rate, samples, factor, unit and bounds of each time series channel."""
    c = channels(segments.where("kind = 'time_series'"))
    return c.select("session", F.col("channel").alias("name"), "series.rate", "series.samples", "series.factor", "series.unit", "start", "end")


def read_sessions(spark: SparkSession, path: str, password: str | None = None) -> DataFrame:
    """sessions of the segments under a path."""
    reader = spark.read.format("mef3_segments")
    return sessions((reader.option("password", password) if password is not None else reader).load(path))


ALL = (Mef3Segments, Mef3VideoClips)
