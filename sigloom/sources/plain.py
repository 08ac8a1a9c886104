"""Tabular and plain binary inputs: CSV time series, Feather, interleaved samples, spike files, channel JSON."""

from __future__ import annotations

import json
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sigloom import schema
from sigloom.operators import sequence
from sigloom.sources.base import BATCH, Format, Piece, file_size, list_files, open_file, read_at, sample_batch, spike_batch, split


def read_csv_series(spark: SparkSession, path: str, unit: str = "uV") -> DataFrame:
    """First column times (microseconds or date-times), each other one a channel. Missing values go; the rate is inferred once per channel."""
    raw = spark.read.csv(path, header=True, inferSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    index, names = raw.columns[0], raw.columns[1:]
    t = F.coalesce(F.col(f"`{index}`").try_cast("double").cast("long"), F.unix_micros(F.try_to_timestamp(F.col(f"`{index}`"))))
    wide = raw.select(t.alias("t_us"), *[F.col(f"`{n}`").try_cast("double").alias(n.strip()) for n in names])
    long = wide.unpivot(["t_us"], [n.strip() for n in names], "channel", "value").where("t_us is not null and value is not null and not isnan(value)")
    rates = sequence.infer_rate(long.withColumnRenamed("channel", "channel_id")).select(F.col("channel_id").alias("channel"), "rate")
    return long.join(rates, "channel").select("channel", F.lit(unit).alias("unit"), "rate", "t_us", "value")


def feather_times(index: pa.Array) -> np.ndarray:
    if pa.types.is_timestamp(index.type):
        return index.cast(pa.timestamp("us")).cast(pa.int64()).to_numpy(zero_copy_only=False)
    return index.to_numpy(zero_copy_only=False)


class FeatherSeries(Format):
    """Columns of numbers beside one named `index`; a file without it fails. A partition per column and some record batches, by the file's footer.

    The rate is that of the first ten times of the file's first batch.
    """

    NAME = "feather_series"
    APART = True
    #: Record batches in a partition.
    BATCHES = 16

    @staticmethod
    def plan(path, options):
        out = []
        for f in list_files(path):
            with open_file(f) as handle:
                reader = pa.ipc.open_file(handle)
                names, n = reader.schema.names, reader.num_record_batches
            if "index" not in names:
                raise ValueError(f"{f} has no column named index")
            out += [Piece(f, {"column": c, "batches": cut}) for c in names if c != "index" for cut in split(n, FeatherSeries.BATCHES)]
        return out

    @staticmethod
    def decode(piece, options):
        column = piece.info["column"]
        with open_file(piece.path) as handle:
            own = pa.ipc.open_file(handle).schema.get_field_index
            reader = pa.ipc.open_file(handle, options=pa.ipc.IpcReadOptions(included_fields=sorted({own("index"), own(column)})))
            head = np.sort(feather_times(reader.get_batch(0).column("index").slice(0, 4096)).astype(float))
            steps = np.diff(head[:10])
            rate = 1e6 / float(np.median(steps)) if len(steps) else 0.0
            for k in range(*piece.info["batches"]):
                batch = reader.get_batch(k)
                times, values = feather_times(batch.column("index")), batch.column(column).to_numpy(zero_copy_only=False).astype(float)
                keep = ~np.isnan(values)
                yield sample_batch(column.strip(), options.get("unit", "uV"), rate, times[keep], values[keep])


class InterleavedSamples(Format):
    """Pairs of little-endian doubles, time and value; the size must be whole pairs. Partitions are byte ranges."""

    NAME = "interleaved_samples"
    APART = True

    @staticmethod
    def plan(path, options):
        out = []
        for f in list_files(path):
            size = file_size(f)
            if size % 16:
                raise ValueError(f"{f}: {size} bytes aren't whole pairs of doubles")
            out += [Piece(f, {"first": a, "end": b}) for a, b in split(size // 16, 4 * BATCH)]
        return out

    @staticmethod
    def decode(piece, options):
        name = options.get("channel") or os.path.basename(piece.path).removesuffix(".ts.bin")
        for a, b in split(piece.info["end"] - piece.info["first"], BATCH):
            x = np.frombuffer(read_at(piece.path, 16 * (piece.info["first"] + a), 16 * (b - a)), "<f8").reshape(-1, 2)
            yield sample_batch(name, options.get("unit", "uV"), float(options.get("rate", 0)), x[:, 0], x[:, 1])


SPIKE = np.dtype([("t", "<i8"), ("unit", "i1")])


class SpikeFile(Format):
    """A header (offset, spikes, samples), packed times and units, then waveforms of doubles; counts must agree with the size."""

    NAME = "spike_file"
    APART = True
    KIND = "spikes"

    @staticmethod
    def plan(path, options):
        out = []
        for f in list_files(path):
            offset, n, width = np.frombuffer(read_at(f, 0, 24), "<i8").tolist()
            if offset != SPIKE.itemsize * n or file_size(f) != 24 + offset + 8 * n * width:
                raise ValueError(f"{f}: spikes and waveforms don't match")
            out += [Piece(f, {"first": a, "end": b, "offset": offset, "width": width}) for a, b in split(n, BATCH)]
        return out

    @staticmethod
    def decode(piece, options):
        i = piece.info
        n = i["end"] - i["first"]
        s = np.frombuffer(read_at(piece.path, 24 + SPIKE.itemsize * i["first"], SPIKE.itemsize * n), SPIKE)
        w = np.frombuffer(read_at(piece.path, 24 + i["offset"] + 8 * i["width"] * i["first"], 8 * i["width"] * n), "<f8").reshape(n, i["width"])
        yield spike_batch(options.get("channel") or os.path.basename(piece.path).removesuffix(".ts.bin"), s["t"], s["unit"], w)


def read_channels(spark: SparkSession, source: str | list | dict) -> DataFrame:
    """Channels from a JSON file, JSON text or objects; anything but a list of objects or one object fails."""
    if isinstance(source, str):
        try:
            source = json.loads(read_at(source).decode())
        except (OSError, ValueError):
            source = json.loads(source)
    rows = [source] if isinstance(source, dict) else source
    if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
        raise ValueError("channels must be a list of objects")
    pick = lambda r, *names: next((r[n] for n in names if n in r), None)
    number = lambda x, kind: None if x is None else kind(x)
    data = [(str(pick(r, "nodeId", "id", "channel_id")), pick(r, "packageId"), pick(r, "name"), number(r.get("start"), int), number(r.get("end"), int), r.get("unit"), number(r.get("rate"), float), r.get("type"), r.get("group"), number(r.get("lastAnnotation"), int), [{str(k): str(v) for k, v in p.items()} for p in r.get("properties") or []], r.get("createdAt")) for r in rows]
    return spark.createDataFrame(data, schema.CHANNELS)


ALL = (FeatherSeries, InterleavedSamples, SpikeFile)
