"""Ordered operators on long channels.

A window over a whole channel puts its rows in one task. Here rows are cut into time
buckets; windows run over (channel, bucket), and what crosses a bucket's edge comes
from a summary of one row per bucket, over which a window per channel is small. So one
channel may hold most of the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Microseconds in a bucket; choose it so that a bucket has up to some million samples.
BUCKET = 3_600_000_000


def bucketed(df: DataFrame, t: str, bucket_us: int = BUCKET) -> DataFrame:
    return df.withColumn("_b", F.floor(F.col(t) / F.lit(bucket_us)).cast("long"))


def with_previous(samples: DataFrame, channel: str = "channel_id", t: str = "t_us", tie: str | None = None, bucket_us: int = BUCKET) -> DataFrame:
    """Adds `prev`, the time of the sample before (null for a channel's first)."""
    rows = bucketed(samples, t, bucket_us)
    order = [t] + ([tie] if tie else [])
    local = Window.partitionBy(channel, "_b").orderBy(*order)
    last = rows.groupBy(channel, "_b").agg(F.max(t).alias("_last"))
    before = last.withColumn("_before", F.lag("_last").over(Window.partitionBy(channel).orderBy("_b"))).drop("_last")
    return rows.withColumn("prev", F.lag(t).over(local)).join(before, [channel, "_b"]).withColumn("prev", F.coalesce("prev", "_before")).drop("_before")


def running_count(rows: DataFrame, flag: Column, out: str, channel: str = "channel_id", t: str = "t_us", tie: str | None = None) -> DataFrame:
    """Adds the number of flagged rows up to and with each row, flagged ones first among equals; rows has _b."""
    order = [F.col(t)] + ([F.col(tie)] if tie else [])
    local = Window.partitionBy(channel, "_b").orderBy(*order, F.col("_f").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_f", flag.cast("long"))
    sums = rows.groupBy(channel, "_b").agg(F.sum("_f").alias("_s"))
    base = sums.withColumn("_base", F.coalesce(F.sum("_s").over(Window.partitionBy(channel).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_s")
    return rows.withColumn(out, F.sum("_f").over(local)).join(base, [channel, "_b"]).withColumn(out, F.col(out) + F.col("_base")).drop("_f", "_base")


def find_gaps(samples: DataFrame, gap_us: Column, channel: str = "channel_id", t: str = "t_us", tie: str | None = None, bucket_us: int = BUCKET) -> DataFrame:
    """Adds `seg`, counting from 1: a new segment begins where a sample follows the one before by more than gap_us (twice the period)."""
    rows = with_previous(samples, channel, t, tie, bucket_us)
    starts = F.col("prev").isNull() | ((F.col(t) - F.col("prev")) > gap_us)
    return running_count(rows, starts, "seg", channel, t, tie)


def segments(samples: DataFrame, gap_us: Column, channel: str = "channel_id", t: str = "t_us", tie: str | None = None, bucket_us: int = BUCKET) -> DataFrame:
    """One row per contiguous stretch: [lo, hi) and the number of samples."""
    return find_gaps(samples, gap_us, channel, t, tie, bucket_us).groupBy(channel, "seg").agg(F.min(t).alias("lo"), (F.max(t) + 1).alias("hi"), F.count("*").alias("n"))


def infer_rate(samples: DataFrame, first: int = 10, channel: str = "channel_id", t: str = "t_us") -> DataFrame:
    """Rate by the median of the differences of the first ten times."""
    turn = Window.partitionBy(channel).orderBy(t)
    head = samples.select(channel, t).withColumn("rn", F.row_number().over(turn)).where(F.col("rn") <= first)
    steps = head.withColumn("dt", F.col(t) - F.lag(t).over(turn)).where("dt is not null")
    return steps.groupBy(channel).agg(F.median("dt").alias("period_us")).withColumn("rate", F.lit(1e6) / F.col("period_us"))


def rate_error(inferred: Column, nominal: Column) -> Column:
    return F.abs(inferred - nominal) / nominal


def check_rate(inferred: Column, nominal: Column, tolerance: float = 0.02) -> Column:
    """The nominal rate; fails where the inferred one is off by more than the tolerance."""
    return F.when(rate_error(inferred, nominal) <= tolerance, nominal).otherwise(F.raise_error(F.lit("the sampling rate doesn't match the channel's")).cast("double"))


def islands(samples: DataFrame, valid: Column, channel: str = "channel_id", t: str = "t_us", tie: str | None = None, bucket_us: int = BUCKET) -> DataFrame:
    """Runs of valid samples between missing ones: island number, first and last time, count. The last run is one like the others."""
    rows = bucketed(samples, t, bucket_us).withColumn("_v", valid)
    rows = running_count(rows, ~F.col("_v"), "_hole", channel, t, tie)
    return rows.where("_v").groupBy(channel, "_hole").agg(F.min(t).alias("lo"), F.max(t).alias("hi"), F.count("*").alias("n"))


def block_lengths(blocks: DataFrame, position: str, total: Column, *keys: str) -> DataFrame:
    """Length of each block: the next one's position, or the total, less its own."""
    over = Window.partitionBy(*keys).orderBy(position)
    return blocks.withColumn("length", F.coalesce(F.lead(position).over(over), total) - F.col(position))


def cumulative_offsets(rows: DataFrame, length: str, order: list[str], *keys: str) -> DataFrame:
    """Running totals, truncated to whole numbers after adding up; rows without a place in the order come last."""
    over = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order]).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("offset_end", F.sum(length).over(over).cast("long"))


def first_reaching(rows: DataFrame, cumulative: Column, limit: Column, index: str, *keys: str) -> DataFrame:
    """Per key the least index whose running total reaches the limit."""
    return rows.where(cumulative >= limit).groupBy(*keys).agg(F.min(index).alias("first_index"))


#: Rows of a channel in one task of a window over neighbours.
HALO_ROWS = 1 << 18


def numbered(rows: DataFrame, order: list[str], *keys: str, bucket: int = BUCKET) -> DataFrame:
    """Adds `_pos`, each row's place from 0 in the order of its keys' rows. order begins with a number, which is cut into buckets."""
    rows = rows.withColumn("_b", F.floor(F.col(order[0]) / F.lit(bucket)).cast("long"))
    sizes = rows.groupBy(*keys, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate([*keys, "_b"])], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate([*keys, "_b"])]
    place = F.row_number().over(Window.partitionBy(*keys, "_b").orderBy(*order)) - 1
    out = rows.withColumn("_local", place).join(base, same)
    return out.withColumn("_pos", F.col("_local") + F.col("_base")).drop("_b", "_local", "_base", *[f"_k{i}" for i in range(len(keys) + 1)])


def with_neighbours(rows: DataFrame, out: str, value, order: list[str], *keys: str, before: int = 0, after: int = 0, bucket: int = BUCKET, halo_rows: int = HALO_ROWS) -> DataFrame:
    """Adds value(window), with a window from `before` rows before each row to `after` rows after it, for keys with any number of rows.

    Rows are numbered and cut into stretches; rows near a stretch's edge are copied to the
    neighbouring one, so that its windows see all they need, and leave it afterwards. No task
    orders more than a stretch and its edges.
    """
    cut = max(halo_rows, before + after + 1)
    first, last = F.greatest(F.floor((F.col("_pos") - after) / cut), F.lit(0)), F.floor((F.col("_pos") + before) / cut)
    spread = numbered(rows, order, *keys, bucket=bucket).withColumn("_stretch", F.explode(F.sequence(first.cast("long"), last.cast("long"))))
    over = Window.partitionBy(*keys, "_stretch").orderBy("_pos").rowsBetween(-before, after)
    return spread.withColumn(out, value(over)).where(F.floor(F.col("_pos") / cut) == F.col("_stretch")).drop("_pos", "_stretch")


def with_next(rows: DataFrame, out: str, column: str, order: list[str], *keys: str, **sizes: int) -> DataFrame:
    """Adds a column of the next row in order (null for the last), for keys with any number of rows."""
    following = lambda over: F.nth_value(F.struct(F.col(column)), 2).over(over)[column]
    return with_neighbours(rows, out, following, order, *keys, after=1, **sizes)


def clamp_to_next(rows: DataFrame, start: str, end: str, *keys: str, tie: str | None = None, **sizes: int) -> DataFrame:
    """Ends cut at the next start."""
    out = with_next(rows, "_next", start, [start, *([tie] if tie else [])], *keys, **sizes)
    return out.withColumn("clamped_end", F.least(F.col(end), F.coalesce("_next", F.col(end)))).drop("_next")


def fit_length(values: Column, expected: Column) -> Column:
    """Arrays cut, or filled with their last value, to the expected length."""
    short = F.concat(values, F.array_repeat(F.element_at(values, -1), F.greatest(expected - F.size(values), F.lit(0)).cast("int")))
    return F.when(F.size(values) == 0, values).when(F.size(values) >= expected, F.slice(values, 1, expected.cast("int"))).otherwise(short)


def discontinuities(blocks: DataFrame, start: str, n: Column, rate: Column, tolerance_us: Column, *keys: str) -> DataFrame:
    """Marks blocks that begin later than the block before ends."""
    over = Window.partitionBy(*keys).orderBy(start)
    rows = blocks.withColumn("expected", F.lag(F.col(start) + n / rate * F.lit(1e6)).over(over))
    return rows.withColumn("discontinuous", F.col("expected").isNull() | (F.abs(F.col(start) - F.col("expected")) > tolerance_us))


def dense_ids(rows: DataFrame, on: Column, order: str, *keys: str, out: str = "index_id") -> DataFrame:
    """Numbers the rows that are on from 0 in order; the others get -1."""
    over = Window.partitionBy(*keys, "_on").orderBy(order)
    return rows.withColumn("_on", on).withColumn(out, F.when(F.col("_on"), F.row_number().over(over) - 1).otherwise(-1).cast("long")).drop("_on")
