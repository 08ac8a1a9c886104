"""Recordings of several files: which files belong together, and their channels, units and spike trains joined.

files: recording, member, path; channels: recording, member, channel_id and what headers say; spikes: recording, channel_id, unit, t_us.
One electrode may have most of the spikes: they are counted before their shuffle, and only semi-joined with small tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What an override may replace, and the members it stands for.
OVERRIDES = {"nsx": ("ns1", "ns2", "ns3", "ns4", "ns5", "ns6"), "nev": ("nev",), "sif": ("sif",), "ccf": ("ccf",)}


def member_kind(member: Column) -> Column:
    return F.when(member.startswith("ns"), F.lit("nsx")).otherwise(member)


def file_sets(files: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """recording, member, source, path: the files each recording takes.

    overrides (recording, kind, source): a kind of OVERRIDES that a recording takes from another one's files instead of its own,
    whether these exist or not. A source with a member's suffix counts without it.
    """
    own = files.select("recording", "member", F.col("recording").alias("source"), "path")
    if overrides is None:
        return own
    base = F.regexp_replace("source", r"\.(ns[1-6]|nev|sif|ccf)$", "")
    change = overrides.select("recording", "kind", base.alias("source")).distinct()
    kept = own.withColumn("kind", member_kind(F.col("member"))).join(change.select("recording", "kind"), ["recording", "kind"], "left_anti").drop("kind")
    theirs = files.select(F.col("recording").alias("source"), "member", "path", member_kind(F.col("member")).alias("kind"))
    return kept.unionByName(theirs.join(change, ["source", "kind"]).select("recording", "member", "source", "path"))


def available(sets: DataFrame) -> DataFrame:
    """One row a recording: which analog files it has, as numbers, and whether there are spikes, a patient's file and settings."""
    has = lambda m: F.count_if(F.col("member") == m) > 0
    numbers = F.sort_array(F.collect_set(F.when(F.col("member").startswith("ns"), F.substring("member", 3, 1).cast("int"))))
    return sets.groupBy("recording").agg(numbers.alias("nsx"), has("nev").alias("nev"), has("sif").alias("sif"), has("ccf").alias("ccf"))


def through_sets(rows: DataFrame, sets: DataFrame, *keys: str) -> DataFrame:
    """rows of files (recording is the file's own) as rows of the recordings that take these files."""
    taken = sets.select(F.col("recording").alias("_r"), F.col("source").alias("recording"), "member")
    return rows.join(taken.distinct(), ["recording", *keys]).drop("recording").withColumnRenamed("_r", "recording")


def units(spikes: DataFrame) -> DataFrame:
    """One row a unit of an electrode that has spikes: their number, first and last time."""
    return spikes.groupBy("recording", "channel_id", "unit").agg(F.count("*").alias("spikes"), F.min("t_us").alias("first_us"), F.max("t_us").alias("last_us"))


def existing(asked: DataFrame, found: DataFrame) -> DataFrame:
    """Asked units (recording, channel_id, unit) that have spikes."""
    return asked.join(found.select("recording", "channel_id", "unit"), ["recording", "channel_id", "unit"], "left_semi")


def spike_trains(spikes: DataFrame, asked: DataFrame, segments: DataFrame) -> DataFrame:
    """One row a unit and segment (recording, segment, lo, hi: half-open): the train of its spikes' times, for asked units; a segment without its spikes has no row.

    A recording's segments travel with its spikes as one array: they are the few stretches between its pauses.
    """
    chosen = spikes.join(asked.select("recording", "channel_id", "unit").distinct(), ["recording", "channel_id", "unit"], "left_semi")
    held = F.sort_array(F.collect_list(F.struct("lo", "hi", "segment"))).alias("_s")
    placed = chosen.join(segments.groupBy("recording").agg(held), "recording")
    of = F.filter("_s", lambda s: (s["lo"] <= F.col("t_us")) & (F.col("t_us") < s["hi"]))
    return placed.withColumn("_in", F.explode(of)).groupBy("recording", "channel_id", "unit", F.col("_in.segment").alias("segment")).agg(F.count("*").alias("spikes"), F.min("t_us").alias("first_us"), F.max("t_us").alias("last_us"))


def channel_groups(channels: DataFrame, found: DataFrame) -> DataFrame:
    """One row an electrode of a recording: its name (the NEV file's, else an analog file's), its analog signals by file and its units with their spikes."""
    keys = ["recording", "channel_id"]
    analog = channels.where("member <> 'nev'").groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("member", "label", "rate", "unit", "samples"))).alias("analog"))
    spiking = channels.where("member = 'nev'").groupBy(*keys).agg(F.min("label").alias("label"), F.min("sorted_units").alias("sorted_units"))
    own = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("unit", "spikes", "first_us", "last_us"))).alias("units"))
    rows = spiking.join(analog, keys, "full").join(own, keys, "full")
    name = F.coalesce("label", F.element_at(F.col("analog.label"), 1), F.concat(F.lit("Channel "), F.col("channel_id").cast("string")))
    return rows.withColumn("label", name)
