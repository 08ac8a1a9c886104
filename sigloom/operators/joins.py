"""Interval, as-of and tolerance joins without nested loops."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def overlapping(a: DataFrame, b: DataFrame, *keys: str, carry: tuple[str, ...] = (), bucket: int | None = None) -> DataFrame:
    """Pairs of half-open [lo, hi) of equal keys that overlap; b's bounds come as b_lo and b_hi, its carried columns under their names.

    Both sides are cut into buckets of time and joined on (keys, bucket); a pair is
    kept only in the bucket where the later of the two begins, so once. A bucket is as wide as two
    intervals are on average, unless it is given: then cutting adds about half a row for each interval, whatever their lengths.
    """
    if bucket is None:
        length = a.select((F.col("hi") - F.col("lo")).alias("n")).unionByName(b.select((F.col("hi") - F.col("lo")).alias("n")))
        bucket = max(1, int(2 * (length.agg(F.avg("n").alias("n")).first()["n"] or 0)))
    width = F.lit(bucket)

    def cut(df: DataFrame) -> DataFrame:
        first, last = F.floor(F.col("lo") / width), F.floor((F.greatest(F.col("hi") - 1, F.col("lo"))) / width)
        return df.withColumn("_b", F.explode(F.sequence(first.cast("long"), last.cast("long"))))

    right = cut(b.select(*keys, "lo", "hi", *carry)).withColumnRenamed("lo", "b_lo").withColumnRenamed("hi", "b_hi")
    pairs = cut(a).join(right, [*keys, "_b"]).where((F.col("lo") < F.col("b_hi")) & (F.col("b_lo") < F.col("hi")))
    return pairs.where(F.floor(F.greatest("lo", "b_lo") / width) == F.col("_b")).drop("_b")


def last_at_or_before(points: DataFrame, blocks: DataFrame, at: str, start: str, carry: list[str], *keys: str, width: int = 86_400_000_000) -> DataFrame:
    """Each point with the carried columns of the last block that starts at or before it (null before the first; of equal starts the greatest carry).

    Windows run within buckets of `width`; what a bucket has from those before it comes from a
    summary of one row per bucket.
    """
    bucket = F.floor(F.col("_t") / width).alias("_b")
    left = points.select(*keys, F.col(at).alias("_t"), F.lit(1).alias("_k"), F.struct(*points.columns).alias("_p"))
    right = blocks.select(*keys, F.col(start).alias("_t"), F.lit(0).alias("_k"), F.struct(*carry).alias("_c"))
    both = left.unionByName(right, allowMissingColumns=True).select("*", bucket)
    last = F.max(F.when(F.col("_k") == 0, F.struct("_t", "_c")))
    buckets = both.groupBy(*keys, "_b").agg(last["_c"].alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.select(*keys, "_b", F.last("_last", ignorenulls=True).over(before).alias("_before"))
    over = Window.partitionBy(*keys, "_b").orderBy("_t", "_k", "_c").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("_own", F.last("_c", ignorenulls=True).over(over)).where("_k = 1").join(buckets, [*keys, "_b"])
    found = F.coalesce("_own", "_before")
    return out.select("_p.*", *[found[c].alias(f"block_{c}") for c in carry])


def sample_at(t: Column, block_start: Column, block_first: Column, block_n: Column, rate: Column) -> Column:
    """Sample number of a time within its block; times after the block's end count to the next block's first sample."""
    n = F.round((t - block_start) / F.lit(1e6) * rate).cast("long")
    return block_first + F.least(n, block_n)


def time_of(sample: Column, block_start: Column, block_first: Column, rate: Column) -> Column:
    return (block_start + F.round((sample - block_first) / rate * F.lit(1e6))).cast("long")


def intersect(lo: Column, hi: Column, start: Column, end: Column) -> Column:
    """[lo, hi) cut to [start, end); null if nothing is left."""
    a, b = F.greatest(lo, start), F.least(hi, end)
    return F.when(a < b, F.struct(a.alias("lo"), b.alias("hi")))


def match_intervals(rows: DataFrame, value: str, order: str, *keys: str, tolerance: float = 0.02) -> DataFrame:
    """Folds values, in order, into the first known one within the tolerance, else a new one: adds `matched`. A null has none, 0 matches 0 alone.

    The fold depends on the order in which values first occur, and a value that occurs again matches what it did before; so only
    the distinct values of each key are folded, as one group, and joined to the rows again.
    """
    named = [*keys, value]
    values = rows.where(F.col(value).isNotNull()).groupBy(*named).agg(F.min(order).alias("_first"))
    kinds = [values.schema[c] for c in named]

    def fold(table: pa.Table) -> pa.Table:
        table = table.sort_by([("_first", "ascending"), (value, "ascending")])
        known: list[float] = []
        out = []
        for v in table[value].to_pylist():
            hit = next((k for k in known if v == k or (k and abs(v - k) / abs(k) <= tolerance)), None)
            if hit is None:
                known.append(v)
                hit = v
            out.append(float(hit))
        return table.select(named).append_column("_matched", pa.array(out, pa.float64()))

    folded = values.groupBy(*keys).applyInArrow(fold, StructType([*kinds, StructField("_matched", DoubleType())]))
    folded = folded.select(*[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(named)], "_matched")
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(named)]
    return rows.join(folded, same, "left").drop(*[f"_k{i}" for i in range(len(named))]).withColumnRenamed("_matched", "matched")


def merge_ranges(user: DataFrame, file: DataFrame, *keys: str) -> DataFrame:
    """User ranges cut to the file's ranges; a null bound of the user is the file's own."""
    f = file.select(*keys, F.col("lo").alias("f_lo"), F.col("hi").alias("f_hi"))
    both = user.join(f, list(keys))
    lo, hi = F.greatest(F.coalesce("lo", "f_lo"), F.col("f_lo")), F.least(F.coalesce("hi", "f_hi"), F.col("f_hi"))
    return both.select(*keys, lo.alias("lo"), hi.alias("hi")).where("lo < hi")


def unknown_channels(asked: DataFrame, known: DataFrame, key: str = "channel") -> DataFrame:
    return asked.select(key).distinct().join(known.select(key), key, "left_anti")


def require_known(asked: DataFrame, known: DataFrame, key: str = "channel") -> DataFrame:
    """The asked rows; fails on a channel that isn't known."""
    marked = asked.join(known.select(key).distinct().withColumn("_k", F.lit(1)), key, "left")
    return marked.withColumn(key, F.when(F.col("_k") == 1, F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no such channel: "), F.col(key).cast("string"))).cast("string"))).select(asked.columns)
