"""Export: sessions, relative time and columnar files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sigloom.functions import timeaxis
from sigloom.operators import store


def session_bounds(channels: DataFrame) -> DataFrame:
    return channels.agg(F.min("start").alias("session_start"), F.max("end").alias("session_end"))


def acquisitions(ranges: DataFrame, channels: DataFrame) -> DataFrame:
    """name, unit, seconds since the session's start and value of every sample, in one pass. channels is the dimension table."""
    start = session_bounds(channels).select("session_start")
    named = channels.select("channel_id", "name", "unit").join(F.broadcast(start))
    rows = store.expand(ranges).join(named, "channel_id")
    return rows.select("channel_id", "name", "unit", timeaxis.relative_seconds(F.col("t"), F.col("session_start")).alias("seconds"), "value")


def write_export(ranges: DataFrame, channels: DataFrame, path: str) -> None:
    """One folder per channel, ordered by time within files."""
    rows = acquisitions(ranges, channels)
    rows.repartitionByRange("channel_id", "seconds").sortWithinPartitions("channel_id", "seconds").write.mode("overwrite").partitionBy("channel_id").parquet(path)


def write_hdf5(ranges: DataFrame, channels: DataFrame, path: str) -> None:
    """A hierarchical file with a time series per channel: data and timestamps, streamed range by range in order."""
    try:
        import h5py
    except ImportError as e:
        raise ImportError("writing HDF5 needs h5py; write_export writes the same columns as Parquet") from e
    start = session_bounds(channels).first()["session_start"]
    with h5py.File(path, "w") as out:
        for c in channels.select("channel_id", "name", "unit").toLocalIterator():
            g = out.create_group(f"acquisition/{c['name']}")
            g.attrs["unit"] = c["unit"] or ""
            data = g.create_dataset("data", (0,), maxshape=(None,), chunks=True, dtype="f8")
            times = g.create_dataset("timestamps", (0,), maxshape=(None,), chunks=True, dtype="f8")
            for r in ranges.where(F.col("channel_id") == c["channel_id"]).orderBy("lo").toLocalIterator():
                n, k = data.shape[0], len(r["values"])
                data.resize((n + k,))
                times.resize((n + k,))
                data[n:] = r["values"]
                times[n:] = [(r["lo"] + i * 1e6 / r["rate"] - start) / 1e6 for i in range(k)]
