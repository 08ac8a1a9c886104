"""The range store: arrays of values beside [lo, hi), written, appended, read and expanded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sigloom.functions import timeaxis
from sigloom.operators import sequence
from sigloom.operators.joins import overlapping

#: Values of a stored range: 1 MiB of doubles.
BATCH = 131_072


def batch_number(position: Column, size: int = BATCH) -> Column:
    """Batch of the position-th row (from 1)."""
    return F.floor((position - 1) / F.lit(size)).cast("long")


def to_ranges(samples: DataFrame, rates: DataFrame, size: int = BATCH, bucket_us: int = sequence.BUCKET) -> DataFrame:
    """Samples (channel_id, t_us, value) to ranges at the channels' rates (channel_id, rate): cut at gaps of over two periods and at `size` values."""
    rows = samples.join(rates.select("channel_id", "rate"), "channel_id")
    rows = sequence.find_gaps(rows, F.lit(2e6) / F.col("rate"), bucket_us=bucket_us)
    rows = sequence.running_count(rows, F.lit(True), "_n")
    first = rows.groupBy("channel_id", "seg").agg(F.min("_n").alias("_first"))
    rows = rows.join(first, ["channel_id", "seg"]).withColumn("batch", batch_number(F.col("_n") - F.col("_first") + 1, size))
    packed = rows.groupBy("channel_id", "rate", "seg", "batch").agg(F.sort_array(F.collect_list(F.struct("t_us", "value"))).alias("s"))
    lo = F.col("s")[0]["t_us"]
    n = F.size("s")
    return packed.select(
        "channel_id", "rate", lo.alias("lo"), timeaxis.range_end(lo, n, F.col("rate")).alias("hi"),
        F.concat_ws("_", "channel_id", lo.cast("string"), timeaxis.range_end(lo, n, F.col("rate")).cast("string")).alias("location"),
        F.lit(False).alias("follows_gap"), F.transform("s", lambda x: x["value"]).alias("values"),
    )


def expand(ranges: DataFrame, drift: bool = False) -> DataFrame:
    """Ranges to samples in order of position: t = lo + pos * period."""
    rows = ranges.select("channel_id", "rate", "lo", F.posexplode("values").alias("pos", "value"))
    return rows.select("channel_id", timeaxis.time_at(F.col("lo"), F.col("pos"), F.col("rate"), drift).alias("t"), "value")


def read_channel(ranges: DataFrame, channel_id: str, start: int | None = None, end: int | None = None) -> DataFrame:
    """One channel's samples in order, optionally within [start, end): the ranges are pruned before they are expanded."""
    rows = ranges.where(F.col("channel_id") == channel_id)
    if start is not None:
        rows = rows.where(F.col("hi") > start)
    if end is not None:
        rows = rows.where(F.col("lo") < end)
    out = expand(rows)
    if start is not None:
        out = out.where(F.col("t") >= start)
    if end is not None:
        out = out.where(F.col("t") < end)
    return out.orderBy("t")


def append(stored: DataFrame, new: DataFrame, skip: bool = True) -> DataFrame:
    """The new ranges that may be stored. Those overlapping a stored range of their channel are skipped, or fail."""
    clash = overlapping(new, stored.select("channel_id", "lo", "hi"), "channel_id").select("channel_id", "lo", "hi").distinct()
    if skip:
        return new.join(clash, ["channel_id", "lo", "hi"], "left_anti")
    marked = new.join(clash.withColumn("_c", F.lit(1)), ["channel_id", "lo", "hi"], "left")
    return marked.withColumn("lo", F.when(F.col("_c").isNull(), F.col("lo")).otherwise(F.raise_error(F.lit("the range overlaps a stored one")).cast("long"))).drop("_c").select(new.columns)


def write(ranges: DataFrame, path: str, mode: str = "append") -> None:
    """Parquet by channel; readers prune by channel and by lo and hi."""
    ranges.repartition("channel_id", F.floor(F.col("lo") / F.lit(86_400_000_000))).sortWithinPartitions("channel_id", "lo").write.mode(mode).partitionBy("channel_id").parquet(path)


def to_unit_ranges(spikes: DataFrame, size: int = BATCH) -> DataFrame:
    """Spikes (channel_id, t_us, unit, waveform) to stored batches with their times, units and waveforms."""
    rows = sequence.running_count(sequence.bucketed(spikes, "t_us"), F.lit(True), "_n")
    rows = rows.withColumn("batch", batch_number(F.col("_n"), size))
    packed = rows.groupBy("channel_id", "batch").agg(F.sort_array(F.collect_list(F.struct("t_us", "unit", "waveform"))).alias("s"))
    lo, hi = F.col("s")[0]["t_us"], F.element_at("s", -1)["t_us"] + 1
    name = F.concat_ws("_", "channel_id", lo.cast("string"), hi.cast("string"))
    return packed.select("channel_id", lo.alias("lo"), hi.alias("hi"), F.size("s").cast("long").alias("count"), F.concat(name, F.lit(".bfsk.gz")).alias("tsindex"), F.concat(name, F.lit(".bfwv.gz")).alias("tsblob"), F.transform("s", lambda x: x["t_us"]).alias("times"), F.transform("s", lambda x: x["unit"]).alias("units"), F.transform("s", lambda x: x["waveform"]).alias("waveforms"))


def expand_units(units: DataFrame) -> DataFrame:
    zipped = F.arrays_zip("times", "units", "waveforms")
    return units.select("channel_id", F.explode(zipped).alias("s")).select("channel_id", F.col("s.times").alias("t_us"), F.col("s.units").alias("unit"), F.col("s.waveforms").alias("waveform"))


def counts(ranges: DataFrame) -> DataFrame:
    """Samples and gaps of each channel."""
    over = Window.partitionBy("channel_id").orderBy("lo")
    rows = ranges.withColumn("_gap", (F.col("lo") - F.lag("hi").over(over)) > F.lit(2e6) / F.col("rate"))
    return rows.groupBy("channel_id").agg(F.sum(F.size("values")).cast("long").alias("n_samples"), F.count_if("_gap").alias("n_gaps"))
