"""Incremental ingest with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sigloom.operators import sequence, store


def append_batches(spark: SparkSession, stream: DataFrame, rates: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch of samples becomes ranges; those that overlap stored ones are skipped, so a batch may be run again."""

    def write(batch: DataFrame, _: int) -> None:
        ranges = store.to_ranges(batch, rates)
        try:
            stored = spark.read.parquet(path)
        except Exception as e:  # the store's first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            stored = ranges.limit(0)
        store.write(store.append(stored, ranges), path)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def gap_sessions(samples: DataFrame, ts: str, gap: str | Column, *keys: str, watermark: str | None = None) -> DataFrame:
    """Contiguous stretches as session windows, in batch or (with a watermark) as a stream; the end is the last sample's, plus a microsecond."""
    rows = samples.withWatermark(ts, watermark) if watermark else samples
    out = rows.groupBy(*keys, F.session_window(F.col(ts), gap).alias("w")).agg(F.min(ts).alias("first"), F.max(ts).alias("last"), F.count("*").alias("n"))
    return out.select(*keys, F.unix_micros("first").alias("lo"), (F.unix_micros("last") + 1).alias("hi"), "n")


__all__ = ["append_batches", "gap_sessions", "sequence"]
