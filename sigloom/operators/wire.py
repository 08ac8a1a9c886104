"""Ranges and spikes as compressed blobs: gzip over big-endian doubles, and over big-endian times with a unit byte; blocks of whole numbers, coded without loss or for a goal."""

from __future__ import annotations

import gzip
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sigloom.functions import lossy, red

TIMES = np.dtype([("t", ">i8"), ("unit", "i1")])


def compress(values: np.ndarray, kind: str = ">f8") -> bytes:
    return gzip.compress(np.asarray(values).astype(kind).tobytes(), mtime=0)


def decompress(blob: bytes, kind: str = ">f8") -> np.ndarray:
    raw = np.frombuffer(gzip.decompress(blob), kind)
    return raw.astype(raw.dtype.newbyteorder("=")) if raw.dtype.names is None else raw


def to_blobs(ranges: DataFrame) -> DataFrame:
    """channel_id, rate, lo, hi, location, blob."""
    kept = ranges.select("channel_id", "rate", "lo", "hi", F.concat("location", F.lit(".bfts.gz")).alias("location"), "values")

    def run(batches):
        for b in batches:
            blobs = [compress(np.asarray(v.values)) for v in b.column(5)]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(blobs, pa.binary())], names=[*b.schema.names[:5], "blob"])

    return kept.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in kept.dtypes[:5]) + ", blob binary")


def from_blobs(blobs: DataFrame) -> DataFrame:
    """The ranges again: blob to values."""
    names = [c for c in blobs.columns if c != "blob"]
    kept = blobs.select(*names, "blob")

    def run(batches):
        for b in batches:
            values = pa.array([decompress(v.as_py()) for v in b.column(len(names))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], values], names=[*names, "values"])

    return kept.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in kept.dtypes[:-1]) + ", values array<double>")


def read_blob_files(spark: SparkSession, path: str, index: DataFrame) -> DataFrame:
    """Blobs of a folder beside their index rows (channel_id, rate, lo, hi, location), joined by location."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bfts.gz").load(path)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("location"), F.col("content").alias("blob"))
    return from_blobs(index.join(named, "location"))


def write_blob_files(ranges: DataFrame, path: str) -> DataFrame:
    """Writes every range's blob under its name, from the executors; returns the index. The folder must be shared."""
    from sigloom.sources.base import filesystem

    def run(batches):
        fs, root = filesystem(path)
        fs.create_dir(root, recursive=True)
        for b in batches:
            for name, blob in zip(b.column(4).to_pylist(), b.column(5).to_pylist()):
                with fs.open_output_stream(f"{root}/{re.sub(r'[^A-Za-z0-9_.:-]', '_', name)}", compression=None) as out:
                    out.write(blob)
            yield b.select(b.schema.names[:5])

    blobs = to_blobs(ranges)
    return blobs.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in blobs.dtypes[:5]))


def spike_blobs(times: np.ndarray, units: np.ndarray, waveforms: np.ndarray) -> tuple[bytes, bytes]:
    s = np.zeros(len(times), TIMES)
    s["t"], s["unit"] = times, units
    return gzip.compress(s.tobytes(), mtime=0), compress(waveforms)


def read_spike_blobs(index: bytes, waves: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    s = np.frombuffer(gzip.decompress(index), TIMES)
    return s["t"].astype(np.int64), s["unit"].astype(np.int16), decompress(waves).reshape(len(s), -1)


#: What to_red adds.
RED = "block binary, scale float, slope float, intercept float, normality double, residual double"


def to_red(rows: DataFrame, t: str, values: str, scale: float | None = None, ratio: float | None = None, residual: float | None = None, detrend: bool = False, least_normality: float | None = 0.5) -> DataFrame:
    """rows, with each array of whole numbers coded as a block that starts at t; adds RED's columns. Null and empty arrays have no block.

    Lossless unless one goal is given: a fixed scale, a size in relation to four bytes a sample, or a mean residual ratio, for which
    each block gets the greatest scale found that stays under it. All blocks of a batch are searched at once. With a goal but a fixed scale,
    blocks less normal than least_normality stay lossless.
    """
    kept = rows.select(*[c for c in rows.columns], F.col(t).cast("long").alias("_t"), F.transform(values, lambda v: v.cast("double")).alias("_v"))

    def run(batches):
        for whole in batches:
            for first in range(0, len(whole), 256):
                b = whole.slice(first, 256)
                lists = [None if v is None or not len(v) else np.nan_to_num(np.asarray(v, float)) for v in b.column(b.num_columns - 1).to_pylist()]
                times = b.column(b.num_columns - 2).to_pylist()
                full = [k for k, v in enumerate(lists) if v is not None]
                ptr = np.r_[0, np.cumsum([len(lists[k]) for k in full])].astype(np.int64)
                x = red.round_away(np.concatenate([lists[k] for k in full])) if full else np.zeros(0)
                out: list[tuple] = [(None,) * 6] * len(lists)
                plan = lossy.for_residual(x, ptr, residual if residual is not None else 0.0, detrend, least_normality, rounds=lossy.ROUNDS if residual is not None else 0)
                if scale is not None:
                    plan.scale[:] = max(scale, 1.0)
                    plan.residual = lossy.residuals(x, lossy.decoded(red.round_away(x - lossy.line_at(plan.slope, plan.intercept, ptr)), lossy.line_at(plan.slope, plan.intercept, ptr), plan.scale, ptr), ptr)
                for k, a, e, n in zip(full, ptr[:-1], ptr[1:], range(len(full))):
                    if ratio is not None and (least_normality is None or plan.normality[n] >= least_normality):
                        block, s = lossy.encode_for_ratio(times[k], x[a:e], ratio)
                        back = red.decode_mef3(block)[1]
                        out[k] = (block, s, 0.0, 0.0, plan.normality[n], lossy.residuals(x[a:e], back, np.asarray([0, e - a]))[0])
                        continue
                    block = lossy.encode_block(times[k], x[a:e], scale=plan.scale[n], slope=plan.slope[n], intercept=plan.intercept[n])
                    out[k] = (block, plan.scale[n], plan.slope[n], plan.intercept[n], plan.normality[n], plan.residual[n])
                kinds = (pa.binary(), pa.float32(), pa.float32(), pa.float32(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns[:-2], *[pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)]], names=[*b.schema.names[:-2], "block", "scale", "slope", "intercept", "normality", "residual"])

    return kept.mapInArrow(run, StructType([*rows.schema.fields, *StructType.fromDDL(RED).fields]))


def from_red(rows: DataFrame, block: str = "block", out: str = "values") -> DataFrame:
    """rows, with the whole numbers of each block in place of it (null where there is none)."""
    kept = rows.select(*[c for c in rows.columns if c != block], block)

    def run(batches):
        for b in batches:
            values = [None if x is None else red.decode_mef3(x)[1].tolist() for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(values, pa.list_(pa.int64()))], names=[*b.schema.names[:-1], out])

    return kept.mapInArrow(run, StructType([*kept.schema.fields[:-1], *StructType.fromDDL(f"`{out}` array<long>").fields]))


def rename_channel(df: DataFrame, old: str, new: str, column: str = "channel_id") -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, F.lit(new)).otherwise(F.col(column)))
