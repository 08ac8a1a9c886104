"""Sets of files, their channels and units joined, against plain lists."""

from sigloom.operators import filesets

FILES = [("d/a", m, f"d/a.{m}") for m in ("ns2", "ns5", "nev")] + [("d/b", m, f"d/b.{m}") for m in ("ns1", "ccf")] + [("d/c", "sif", "d/c.sif")]


def test_sets_and_overrides(spark):
    files = spark.createDataFrame(FILES, "recording string, member string, path string")
    rows = {r["recording"]: tuple(r)[1:] for r in filesets.available(filesets.file_sets(files)).collect()}
    assert rows == {"d/a": ([2, 5], True, False, False), "d/b": ([1], False, False, True), "d/c": ([], False, True, False)}
    change = spark.createDataFrame([("d/b", "nsx", "d/a.ns2"), ("d/b", "nev", "d/a"), ("d/a", "ccf", "d/b.ccf"), ("d/c", "sif", "d/nothing"), ("d/b", "nev", "d/a.nev")], "recording string, kind string, source string")
    sets = filesets.file_sets(files, change)
    got = sorted((r["recording"], r["member"], r["source"]) for r in sets.collect())
    assert got == [("d/a", "ccf", "d/b"), ("d/a", "nev", "d/a"), ("d/a", "ns2", "d/a"), ("d/a", "ns5", "d/a"), ("d/b", "ccf", "d/b"), ("d/b", "nev", "d/a"), ("d/b", "ns2", "d/a"), ("d/b", "ns5", "d/a")]
    channels = spark.createDataFrame([("d/a", "ns2", 7), ("d/a", "nev", 7)], "recording string, member string, channel_id int")
    assert sorted((r["recording"], r["member"]) for r in filesets.through_sets(channels, sets, "member").collect()) == [("d/a", "nev"), ("d/a", "ns2"), ("d/b", "nev"), ("d/b", "ns2")]


SPIKES = [("a", c, u, t) for c, u, ts in ((1, 0, (5, 15, 25)), (1, 2, (9, 10)), (2, 2, (0, 30)), (3, 255, (40,))) for t in ts] + [("b", 1, 2, 12)]


def test_units_trains_and_groups(spark):
    spikes = spark.createDataFrame(SPIKES, "recording string, channel_id int, unit int, t_us long").repartition(3)
    found = filesets.units(spikes)
    assert {tuple(r) for r in found.collect()} == {("a", 1, 0, 3, 5, 25), ("a", 1, 2, 2, 9, 10), ("a", 2, 2, 2, 0, 30), ("a", 3, 255, 1, 40, 40), ("b", 1, 2, 1, 12, 12)}
    asked = spark.createDataFrame([("a", 1, 2), ("a", 1, 7), ("a", 2, 2), ("c", 1, 2), ("a", 1, 2)], "recording string, channel_id int, unit int")
    there = filesets.existing(asked, found)
    assert sorted(tuple(r) for r in there.collect()) == [("a", 1, 2), ("a", 1, 2), ("a", 2, 2)]
    segments = spark.createDataFrame([("a", 0, 0, 10), ("a", 1, 10, 30), ("a", 2, 5, 31), ("b", 0, 0, 99)], "recording string, segment long, lo long, hi long")
    got = sorted(tuple(r) for r in filesets.spike_trains(spikes, there, segments).collect())
    assert got == [("a", 1, 2, 0, 1, 9, 9), ("a", 1, 2, 1, 1, 10, 10), ("a", 1, 2, 2, 2, 9, 10), ("a", 2, 2, 0, 1, 0, 0), ("a", 2, 2, 2, 1, 30, 30)]
    channels = spark.createDataFrame([("a", "nev", 1, "e1", "uV", 3e4, None, 2), ("a", "ns2", 1, "x1", "uV", 1e3, 90, None), ("a", "ns5", 1, "y1", "mV", 3e4, 91, None), ("a", "ns2", 4, "x4", "uV", 1e3, 90, None)], "recording string, member string, channel_id int, label string, unit string, rate double, samples long, sorted_units int")
    rows = {(r["recording"], r["channel_id"]): r.asDict(recursive=True) for r in filesets.channel_groups(channels, found).collect()}
    assert {k: v["label"] for k, v in rows.items()} == {("a", 1): "e1", ("a", 2): "Channel 2", ("a", 3): "Channel 3", ("a", 4): "x4", ("b", 1): "Channel 1"}
    assert [x["label"] for x in rows["a", 1]["analog"]] == ["x1", "y1"] and [u["unit"] for u in rows["a", 1]["units"]] == [0, 2] and rows["a", 4]["units"] is None and rows["a", 2]["analog"] is None
    none = spikes.limit(0)
    assert filesets.units(none).count() == 0 and filesets.spike_trains(none, there, segments).count() == 0
