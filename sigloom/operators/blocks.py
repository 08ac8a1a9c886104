"""Tables of a recording's blocks: contiguous chunks, and how many samples of each block there is time for.

A block has its start t_us, its number `block`, n samples and a mark `discontinuous` where a gap comes before it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sigloom.operators import sequence

#: Blocks that are read at once, so the most in a chunk.
CYCLE = 2000


def with_chunk(blocks: DataFrame, *keys: str, cycle: int = CYCLE) -> DataFrame:
    """Adds `chunk`, from 1: a new one begins at every discontinuity and after `cycle` blocks of the recording.

    Chunks are counted by cycle, and a cycle's first chunk follows the last one of all cycles before it, so no key is one task.
    """
    begins = (F.col("discontinuous") | (F.col("block") % cycle == 0)).cast("long")
    rows = blocks.withColumn("_cycle", F.floor(F.col("block") / cycle).cast("long"))
    sums = rows.groupBy(*keys, "_cycle").agg(F.sum(begins).alias("_s"))
    earlier = Window.partitionBy(*keys).orderBy("_cycle").rowsBetween(Window.unboundedPreceding, -1)
    named = [*keys, "_cycle"]
    base = sums.select(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(named)], F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_base"))
    local = Window.partitionBy(*named).orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    out = rows.withColumn("_local", F.sum(begins).over(local)).join(base, [F.col(f"`{k}`").eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(named)])
    return out.withColumn("chunk", F.col("_local") + F.col("_base")).drop("_cycle", "_local", "_base", *[f"_k{i}" for i in range(len(named))])


def chunk_table(blocks: DataFrame, *keys: str, cycle: int = CYCLE) -> DataFrame:
    """One row per chunk: its start, which is its first block's, its number of blocks and of samples."""
    first = F.min(F.struct("block", "t_us"))["t_us"]
    return with_chunk(blocks, *keys, cycle=cycle).groupBy(*keys, "chunk").agg(first.alias("start"), F.count("*").alias("blocks"), F.sum("n").alias("samples"))


def block_times(chunks: DataFrame, blocks: DataFrame, *keys: str) -> DataFrame:
    """Each chunk with the number of the block that begins when it does (of several the first)."""
    starts = blocks.groupBy(*keys, F.col("t_us").alias("start")).agg(F.min("block").alias("block"))
    return chunks.join(starts, [*keys, "start"])


def fitted(blocks: DataFrame, rate: str, *keys: str, **sizes: int) -> DataFrame:
    """Adds for each block when it ends (at the next one's start, if that comes first), what follows it, and how its samples are fitted.

    follows: `next` (the next block begins at the end), `gap`, `overlap` or `last`. change: so many
    samples are cut off (negative) or the last one is repeated so many times, to fill the time that there is.
    """
    rows = sequence.with_next(blocks, "next_us", "t_us", ["block"], *keys, **sizes)
    own = (F.col("t_us") + F.col("n") / F.col(rate) * F.lit(1e6)).cast("long")
    follows = F.when(F.col("next_us").isNull(), "last").when(F.col("next_us") < own, "overlap").when(F.col("next_us") > own, "gap").otherwise("next")
    rows = rows.withColumn("follows", follows).withColumn("end_us", F.least(own, F.coalesce("next_us", own)))
    change = F.round((F.col("end_us") - F.col("t_us")) / F.lit(1e6) * F.col(rate) - F.col("n")).cast("long")
    return rows.withColumn("change", F.when(F.col("follows") == "last", F.lit(0)).otherwise(change))
