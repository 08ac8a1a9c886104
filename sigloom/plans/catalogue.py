"""Registered queries of the signal operators, with the SQL that states their results.

events stand for samples (channel = event_type), lineitem for wide signals and packets,
orders for block indexes, embeddings for waveforms.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sigloom.functions import labels, red, scale, timeaxis
from sigloom.operators import export, joins, sequence, signal, store, wire
from sigloom.session import materialise, scratch, ship, table
from sigloom.sources import plain
from sigloom.streaming import ingest

HOUR = 3_600_000_000
DAY = 24 * HOUR
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Samples in SQL.
S = "SELECT event_type AS channel_id, epoch_us(ts) AS t_us, value, event_id FROM events"
#: Segments in SQL: gaps of over an hour.
SEG = f"""s AS ({S}), d AS (SELECT *, t_us - lag(t_us) OVER (PARTITION BY channel_id ORDER BY t_us, event_id) AS dt FROM s),
    g AS (SELECT *, sum(CASE WHEN dt IS NULL OR dt > {HOUR} THEN 1 ELSE 0 END) OVER (PARTITION BY channel_id ORDER BY t_us, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS seg FROM d),
    r AS (SELECT channel_id, seg, min(t_us) AS lo, max(t_us) + 1 AS hi, count(*) AS n FROM g GROUP BY channel_id, seg)"""


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("event_type").alias("channel_id"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"), "value", "event_id")


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequence.segments(samples(spark, sf_dir), F.lit(HOUR), tie="event_id", bucket_us=DAY)


@query(f"WITH {SEG} SELECT channel_id, seg, lo, hi, n FROM r")
def gap_segments(spark, sf_dir):
    return _segments(spark, sf_dir)


@query(f"SELECT channel_id, median(dt) AS period_us, 1e6::DOUBLE / median(dt) AS rate FROM (SELECT channel_id, t_us - lag(t_us) OVER w AS dt, row_number() OVER w AS rn FROM ({S}) WINDOW w AS (PARTITION BY channel_id ORDER BY t_us)) WHERE rn BETWEEN 2 AND 10 GROUP BY channel_id")
def infer_rate(spark, sf_dir):
    return sequence.infer_rate(samples(spark, sf_dir))


@query(f"SELECT channel_id, abs(rate - 0.001::DOUBLE) / 0.001::DOUBLE AS error, abs(rate - 0.001::DOUBLE) / 0.001::DOUBLE <= 0.02::DOUBLE AS ok FROM (SELECT channel_id, 1e6::DOUBLE / median(dt) AS rate FROM (SELECT channel_id, t_us - lag(t_us) OVER w AS dt, row_number() OVER w AS rn FROM ({S}) WINDOW w AS (PARTITION BY channel_id ORDER BY t_us)) WHERE rn BETWEEN 2 AND 10 GROUP BY channel_id)")
def rate_check(spark, sf_dir):
    error = sequence.rate_error(F.col("rate"), F.lit(0.001))
    return sequence.infer_rate(samples(spark, sf_dir)).select("channel_id", error.alias("error"), (error <= 0.02).alias("ok"))


@query(f"SELECT channel_id, (rn - 1) // 512 AS batch, min(t_us) AS lo, max(t_us) AS hi, count(*) AS n FROM (SELECT channel_id, t_us, row_number() OVER (PARTITION BY channel_id ORDER BY t_us, event_id) AS rn FROM ({S})) GROUP BY ALL")
def batch_ranges(spark, sf_dir):
    rows = sequence.running_count(sequence.bucketed(samples(spark, sf_dir), "t_us", DAY), F.lit(True), "rn", tie="event_id")
    return rows.withColumn("batch", store.batch_number(F.col("rn"), 512)).groupBy("channel_id", "batch").agg(F.min("t_us").alias("lo"), F.max("t_us").alias("hi"), F.count("*").alias("n"))


@query(f"""WITH {SEG} SELECT r.channel_id, seg, pos, lo + pos * 250000.0::DOUBLE AS t FROM r, unnest(range(0, n)) AS p(pos)""")
def range_expand(spark, sf_dir):
    r = _segments(spark, sf_dir).withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return r.select("channel_id", "seg", "pos", timeaxis.time_at(F.col("lo"), F.col("pos"), F.lit(4.0)).alias("t"))


@query(f"""WITH s AS ({S}), d AS (SELECT *, t_us - lag(t_us) OVER (PARTITION BY channel_id ORDER BY t_us) AS dt FROM s), g AS (SELECT *, sum(CASE WHEN dt IS NULL OR dt > 2e6::DOUBLE / 0.002::DOUBLE THEN 1 ELSE 0 END) OVER (PARTITION BY channel_id ORDER BY t_us) AS seg FROM d),
    n AS (SELECT *, row_number() OVER (PARTITION BY channel_id, seg ORDER BY t_us) - 1 AS rn FROM g)
    SELECT channel_id, min(t_us) AS lo, trunc(min(t_us) + (count(*) - 1) * 1e6::DOUBLE / 0.002::DOUBLE + 1.0::DOUBLE)::BIGINT AS hi, count(*) AS n, round(sum(value), 4) AS total FROM n GROUP BY channel_id, seg, rn // 64""")
def store_ranges(spark, sf_dir):
    s = samples(spark, sf_dir)
    rates = s.select("channel_id").distinct().withColumn("rate", F.lit(0.002))
    r = store.to_ranges(s.select("channel_id", "t_us", "value"), rates, 64, DAY)
    return r.select("channel_id", "lo", "hi", F.size("values").cast("long").alias("n"), F.round(F.aggregate("values", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@query(f"WITH c AS (SELECT channel_id, min(t_us) AS lo, max(t_us) AS hi, count(*) AS n FROM ({S}) GROUP BY 1) SELECT channel_id, pos, trunc(lo + pos * ((hi - lo) / (n - 1)::DOUBLE))::BIGINT AS t FROM c, unnest(range(0, n)) AS p(pos)")
def linspace_incl(spark, sf_dir):
    c = samples(spark, sf_dir).groupBy("channel_id").agg(F.min("t_us").alias("lo"), F.max("t_us").alias("hi"), F.count("*").alias("n"))
    return c.withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select("channel_id", "pos", timeaxis.linspace_at(F.col("lo"), F.col("hi"), F.col("n"), F.col("pos")).alias("t"))


@query(f"WITH c AS (SELECT channel_id, min(t_us) AS lo, count(*) AS n FROM ({S}) GROUP BY 1) SELECT channel_id, pos, lo + pos * (2.5::DOUBLE * 1e6::DOUBLE) / n AS t FROM c, unnest(range(0, n)) AS p(pos)")
def linspace_excl(spark, sf_dir):
    c = samples(spark, sf_dir).groupBy("channel_id").agg(F.min("t_us").alias("lo"), F.count("*").alias("n"))
    return c.withColumn("pos", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1))).select("channel_id", "pos", timeaxis.linspace_open_at(F.col("lo"), F.lit(2.5), F.col("n"), F.col("pos")).alias("t"))


@query(f"WITH {SEG}, old AS (SELECT channel_id, lo, hi FROM r WHERE seg % 2 = 0), new AS (SELECT channel_id, seg, lo - 5400000000 AS lo, hi + 5400000000 AS hi FROM r WHERE seg % 2 = 1) SELECT * FROM new WHERE NOT EXISTS (SELECT 1 FROM old WHERE old.channel_id = new.channel_id AND old.lo < new.hi AND new.lo < old.hi)")
def append_skip_overlap(spark, sf_dir):
    r = _segments(spark, sf_dir)
    new = r.where("seg % 2 = 1").select("channel_id", "seg", (F.col("lo") - 5_400_000_000).alias("lo"), (F.col("hi") + 5_400_000_000).alias("hi"))
    return store.append(r.where("seg % 2 = 0").select("channel_id", "lo", "hi"), new).select("channel_id", "seg", "lo", "hi")


@query(f"WITH {SEG} SELECT a.channel_id, a.seg, b.seg AS other FROM r a JOIN r b ON a.channel_id < b.channel_id AND a.lo < b.hi AND b.lo < a.hi")
def interval_overlap(spark, sf_dir):
    r = _segments(spark, sf_dir).withColumn("all", F.lit(1))
    other = r.select("all", "lo", "hi", F.col("channel_id").alias("c2"), F.col("seg").alias("other"))
    return joins.overlapping(r, other, "all", carry=("c2", "other"), bucket=DAY).where("channel_id < c2").select("channel_id", "seg", "other")


@query(f"SELECT min(lo) AS session_start, max(hi) AS session_end FROM (SELECT min(t_us) AS lo, max(t_us) AS hi FROM ({S}) GROUP BY channel_id)")
def session_bounds(spark, sf_dir):
    c = samples(spark, sf_dir).groupBy("channel_id").agg(F.min("t_us").alias("start"), F.max("t_us").alias("end"))
    return export.session_bounds(c)


@query(f"SELECT event_id, (t_us - (SELECT min(t_us) FROM ({S}))) / 1e6::DOUBLE AS seconds FROM ({S})")
def relative_seconds(spark, sf_dir):
    s = samples(spark, sf_dir)
    first = s.agg(F.min("t_us").alias("session_start"))
    return s.join(F.broadcast(first)).select("event_id", timeaxis.relative_seconds(F.col("t_us"), F.col("session_start")).alias("seconds"))


@query("SELECT l_orderkey, l_linenumber, channel, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, CASE WHEN l_discount > 0.05 THEN l_discount END AS l_discount FROM lineitem) ON l_quantity, l_extendedprice, l_discount INTO NAME channel VALUE value)")
def channel_long(spark, sf_dir):
    w = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("l_discount"))
    return w.unpivot(["l_orderkey", "l_linenumber"], ["l_quantity", "l_extendedprice", "l_discount"], "channel", "value").where("value is not null and not isnan(value)")


@query("SELECT l_orderkey, l_linenumber, (100.0::DOUBLE - -50.0::DOUBLE) / (40.0::DOUBLE - -20.0::DOUBLE) * ((100.0::DOUBLE / ((100.0::DOUBLE - -50.0::DOUBLE) / (40.0::DOUBLE - -20.0::DOUBLE)) - 40.0::DOUBLE) + l_quantity) AS physical FROM lineitem")
def digital_to_physical(spark, sf_dir):
    p = scale.digital_to_physical(F.col("l_quantity"), F.lit(-50.0), F.lit(100.0), F.lit(-20.0), F.lit(40.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", p.alias("physical"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN (l_quantity::FLOAT * (50::FLOAT / 32767::FLOAT)::FLOAT)::FLOAT ELSE ((l_quantity::FLOAT - 0::FLOAT) * ((10::FLOAT - 2::FLOAT)::FLOAT / 100::FLOAT)::FLOAT + 2::FLOAT)::FLOAT END::DOUBLE AS analog FROM lineitem")
def affine_scale(spark, sf_dir):
    even = F.col("l_linenumber") % 2 == 0
    pick = lambda a, b: F.when(even, F.lit(a)).otherwise(F.lit(b))
    a = scale.analog(F.col("l_quantity"), pick(-32767, 0), pick(32767, 100), pick(-50, 2), pick(50, 10))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", a.cast("double").alias("analog"))


@query("WITH k AS (SELECT l_orderkey, l_linenumber, (l_orderkey * 7919 + l_partkey) & 16777215 AS x FROM lineitem) SELECT l_orderkey, l_linenumber, CASE WHEN x & 8388608 <> 0 THEN x - 16777216 ELSE x END AS v24, CASE WHEN x >= 65536 THEN x - 16777216 ELSE x END AS v24_wide, CASE WHEN (x & 65535) & 32768 <> 0 THEN (x & 65535) - 65536 ELSE x & 65535 END AS v16, (x & 32) > 0 AS bit5 FROM k")
def bit_ops24(spark, sf_dir):
    x = F.col("x")
    k = table(spark, sf_dir, "lineitem").withColumn("x", (F.col("l_orderkey") * 7919 + F.col("l_partkey")).bitwiseAND(16777215))
    return k.select("l_orderkey", "l_linenumber", scale.sign_extend_24(x).alias("v24"), scale.sign_extend_24(x, True).alias("v24_wide"), scale.twos_complement(x.bitwiseAND(65535), 16).alias("v16"), scale.is_set(x, 5).alias("bit5"))


@query("SELECT vec_id, pos - 1 AS pos, embedding[pos]::DOUBLE AS value FROM embeddings, unnest(range(1, len(embedding) + 1)) AS p(pos)")
def waveform_explode(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "value")).select("vec_id", F.col("pos").cast("long").alias("pos"), F.col("value").cast("double").alias("value"))


@query("SELECT vec_id, part, w FROM (SELECT vec_id, part, list_transform(embedding[part * 16 + 1:part * 16 + 16], lambda x: x::DOUBLE) AS w FROM embeddings, unnest(range(0, (len(embedding) + 15) // 16)) AS p(part))")
def waveform_reshape(spark, sf_dir):
    parts = F.when(F.size("embedding") > 0, F.transform(F.sequence(F.lit(0), F.ceil(F.size("embedding") / 16).cast("int") - 1), lambda i: F.slice("embedding", i * 16 + 1, 16)))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(parts).alias("part", "w")).select("vec_id", F.col("part").cast("long").alias("part"), F.col("w").cast("array<double>").alias("w"))


@query(f"WITH {SEG} SELECT p.event_id, b.seg AS block_seg, b.lo AS block_lo FROM (SELECT event_id, t_us + 60000000 AS t FROM s WHERE channel_id = 'click') p ASOF LEFT JOIN (SELECT * FROM r WHERE channel_id = 'view') b ON p.t >= b.lo")
def asof_sample(spark, sf_dir):
    s = samples(spark, sf_dir).where("channel_id = 'click'").select("event_id", (F.col("t_us") + 60_000_000).alias("t")).withColumn("k", F.lit(0))
    b = _segments(spark, sf_dir).where("channel_id = 'view'").withColumn("k", F.lit(0))
    return joins.last_at_or_before(s, b, "t", "lo", ["seg", "lo"], "k").select("event_id", "block_seg", "block_lo")


@query(f"WITH {SEG}, f AS (SELECT *, sum(n) OVER (PARTITION BY channel_id ORDER BY lo) - n AS first FROM r), q AS (SELECT s.channel_id, s.event_id, s.t_us, f.lo, f.first, f.n FROM s ASOF JOIN f ON s.channel_id = f.channel_id AND s.t_us >= f.lo) SELECT channel_id, event_id, (first + least(round((t_us - lo) / 1e6::DOUBLE * 0.5::DOUBLE)::BIGINT, n))::BIGINT AS sample, (lo + round((first + least(round((t_us - lo) / 1e6::DOUBLE * 0.5::DOUBLE)::BIGINT, n) - first) / 0.5::DOUBLE * 1e6::DOUBLE))::BIGINT AS back FROM q")
def sample_time_maps(spark, sf_dir):
    r = _segments(spark, sf_dir)
    r = r.withColumn("first", F.sum("n").over(Window.partitionBy("channel_id").orderBy("lo")) - F.col("n"))
    q = joins.last_at_or_before(samples(spark, sf_dir), r, "t_us", "lo", ["lo", "first", "n"], "channel_id")
    n = joins.sample_at(F.col("t_us"), F.col("block_lo"), F.col("block_first"), F.col("block_n"), F.lit(0.5))
    return q.select("channel_id", "event_id", n.alias("sample"), joins.time_of(n, F.col("block_lo"), F.col("block_first"), F.lit(0.5)).alias("back"))


@query(f"WITH s AS ({S}), h AS (SELECT *, sum(CASE WHEN value < 20 THEN 1 ELSE 0 END) OVER (PARTITION BY channel_id ORDER BY t_us, event_id ROWS UNBOUNDED PRECEDING)::BIGINT AS hole FROM s) SELECT channel_id, hole, min(t_us) AS lo, max(t_us) AS hi, count(*) AS n FROM h WHERE value >= 20 GROUP BY channel_id, hole")
def nan_islands(spark, sf_dir):
    return sequence.islands(samples(spark, sf_dir), F.col("value") >= 20, tie="event_id", bucket_us=DAY).withColumnRenamed("_hole", "hole")


@query("SELECT o_custkey, o_orderkey, coalesce(lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey), 10000000) - o_orderkey AS length FROM orders")
def block_lengths(spark, sf_dir):
    return sequence.block_lengths(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey"), "o_orderkey", F.lit(10_000_000), "o_custkey")


@query("SELECT o_custkey, o_orderkey, trunc(sum(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING))::BIGINT AS offset_end FROM orders")
def cum_offsets(spark, sf_dir):
    return sequence.cumulative_offsets(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), "o_totalprice", ["o_orderkey"], "o_custkey").drop("o_totalprice")


@query("SELECT o_custkey, min(i)::BIGINT AS first_index FROM (SELECT o_custkey, row_number() OVER w - 1 AS i, sum(o_totalprice) OVER w AS c FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING)) WHERE c >= 200000 GROUP BY o_custkey")
def first_ge(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    w = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    c = o.withColumn("i", (F.row_number().over(w) - 1).cast("long")).withColumn("c", F.sum("o_totalprice").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return sequence.first_reaching(c, F.col("c"), F.lit(200000), "i", "o_custkey")


@query(f"SELECT channel_id, event_id, least(t_us + 900000000, coalesce(lead(t_us) OVER (PARTITION BY channel_id ORDER BY t_us, event_id), t_us + 900000000)) AS clamped_end FROM ({S})")
def clamp_next_start(spark, sf_dir):
    s = samples(spark, sf_dir).withColumn("e", F.col("t_us") + 900_000_000)
    return sequence.clamp_to_next(s, "t_us", "e", "channel_id", tie="event_id", bucket=DAY).select("channel_id", "event_id", "clamped_end")


@query(f"WITH {SEG}, c AS (SELECT channel_id, lo, lag(lo + n / 0.001::DOUBLE * 1e6::DOUBLE) OVER (PARTITION BY channel_id ORDER BY lo) AS expected FROM r) SELECT channel_id, lo, expected, expected IS NULL OR abs(lo - expected) > 1800000000.0::DOUBLE AS discontinuous FROM c")
def discontinuities(spark, sf_dir):
    d = sequence.discontinuities(_segments(spark, sf_dir), "lo", F.col("n"), F.lit(0.001), F.lit(1_800_000_000.0), "channel_id")
    return d.select("channel_id", "lo", "expected", "discontinuous")


@query("SELECT o_custkey, CASE WHEN len(v) >= 8 THEN v[1:8] ELSE list_concat(v, list_transform(range(0, 8 - len(v)), lambda i: v[len(v)])) END AS fitted FROM (SELECT o_custkey, list(o_orderkey ORDER BY o_orderkey) AS v FROM orders GROUP BY 1)")
def fit_length(spark, sf_dir):
    v = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("v"))
    return v.select("o_custkey", sequence.fit_length(F.col("v"), F.lit(8)).alias("fitted"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 20 = 0 THEN 'unclassified' WHEN l_suppkey % 20 <= 16 THEN (l_suppkey % 20)::VARCHAR ELSE 'noise' END AS unit FROM lineitem WHERE l_linenumber = 2 AND l_suppkey % 20 <> 18")
def unit_filter(spark, sf_dir):
    u = F.col("l_suppkey") % 20
    rows = table(spark, sf_dir, "lineitem").where((F.col("l_linenumber") == 2) & (u != 18))
    return rows.select("l_orderkey", "l_linenumber", labels.unit_class(F.when(u > 16, 255).otherwise(u)).alias("unit"))


@query("SELECT kind, count(*) AS n FROM (SELECT CASE WHEN p = 0 THEN 'event' WHEN p BETWEEN 1 AND 512 THEN 'spike' WHEN p = 65535 THEN 'continuation' WHEN p = 65531 THEN 'comment' ELSE 'unknown' END AS kind FROM (SELECT CASE WHEN event_id % 50 = 0 THEN 65535 WHEN event_id % 51 = 0 THEN 65531 ELSE user_id % 600 END AS p FROM events)) GROUP BY kind")
def packet_class(spark, sf_dir):
    p = F.when(F.col("event_id") % 50 == 0, 65535).when(F.col("event_id") % 51 == 0, 65531).otherwise(F.col("user_id") % 600)
    return table(spark, sf_dir, "events").select(labels.packet_class(p, 512).alias("kind")).groupBy("kind").agg(F.count("*").alias("n"))


@query("WITH a AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'O'), b AS (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') SELECT 'both' AS part, o_custkey FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT 'open', o_custkey FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'any', o_custkey FROM (SELECT * FROM a UNION SELECT * FROM b)")
def channel_setops(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a, b = (o.where(F.col("o_orderstatus") == s).select("o_custkey") for s in "OF")
    mark = lambda d, name: d.select(F.lit(name).alias("part"), "o_custkey")
    return mark(a.intersect(b), "both").unionByName(mark(a.subtract(b), "open")).unionByName(mark(a.union(b).distinct(), "any"))


@query("SELECT n_nationkey, CASE n_regionkey WHEN 0 THEN 'zero' WHEN 1 THEN 'one' WHEN 2 THEN 'two' ELSE 'UNKNOWN' END AS label, CASE WHEN n_nationkey * 10 < 129 THEN 'chan' || (n_nationkey * 10) ELSE 'ainp' || (n_nationkey * 10 - 128) END AS electrode FROM nation")
def label_lookup(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", labels.named(F.col("n_regionkey").cast("string"), {"0": "zero", "1": "one", "2": "two"}).alias("label"), labels.default_label(F.col("n_nationkey") * 10).alias("electrode"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 100 + 1900 < 1985 THEN o_orderkey % 100 + 2000 ELSE o_orderkey % 100 + 1900 END::INTEGER AS y, trunc(((40000 + o_custkey / 7.0::DOUBLE) * 86400.0::DOUBLE - 2209161600.0::DOUBLE) * 1e6::DOUBLE)::BIGINT AS ole_us FROM orders")
def header_dates(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", timeaxis.two_digit_year(F.col("o_orderkey") % 100).alias("y"), timeaxis.ole_to_micros(F.lit(40000) + F.col("o_custkey") / F.lit(7.0)).alias("ole_us"))


@query("SELECT event_id, upper('{' || h[7:8] || h[5:6] || h[3:4] || h[1:2] || '-' || h[11:12] || h[9:10] || '-' || h[15:16] || h[13:14] || '-' || h[17:20] || '-' || h[21:32] || '}') AS guid FROM (SELECT event_id, md5(event_id::VARCHAR) AS h FROM events)")
def guid_format(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", labels.guid(F.md5(F.col("event_id").cast("string"))).alias("guid"))


@query(f"SELECT channel_id, round(regr_slope(value, event_id), 9) AS slope, round(regr_intercept(value, event_id), 6) AS intercept FROM ({S}) GROUP BY channel_id")
def detrend(spark, sf_dir):
    d = signal.detrend(samples(spark, sf_dir), "event_id", "value", "channel_id")
    return d.select("channel_id", F.round("slope", 9).alias("slope"), F.round("intercept", 6).alias("intercept")).distinct()


@query(f"""WITH s AS ({S}), m AS (SELECT channel_id, avg(value) AS m, stddev_pop(value) AS d FROM s GROUP BY 1), b AS (SELECT channel_id, greatest(0, least(61, floor(((value - m) / d + 3.1::DOUBLE) * 10)::INTEGER)) AS bin FROM s JOIN m USING (channel_id)),
    c AS (SELECT channel_id, bin, count(*) AS n FROM b GROUP BY 1, 2), g AS (SELECT channel_id, bin FROM m, unnest(range(0, 62)) AS p(bin)),
    f AS (SELECT g.channel_id, g.bin, sum(coalesce(n, 0)) OVER (PARTITION BY g.channel_id ORDER BY g.bin)::DOUBLE AS c, (g.bin + 1) / 10.0::DOUBLE - 3.1::DOUBLE AS x FROM g LEFT JOIN c USING (channel_id, bin))
    SELECT channel_id, round(corr(c, 1.0::DOUBLE / (1.0::DOUBLE + exp(-1.5976::DOUBLE * x - 0.07056::DOUBLE * x * x * x))), 6) AS normality FROM f GROUP BY channel_id""")
def normality_corr(spark, sf_dir):
    return signal.normality(samples(spark, sf_dir), "value", "channel_id").select("channel_id", F.round("normality", 6).alias("normality"))


@query(f"SELECT channel_id, t_us // {DAY} AS block, min(value) AS min_value, max(value) AS max_value, count(*) AS n FROM ({S}) GROUP BY ALL")
def minmax_block(spark, sf_dir):
    return signal.block_extremes(samples(spark, sf_dir), F.floor(F.col("t_us") / F.lit(DAY)), "value", "channel_id")


@query(f"SELECT channel_id, event_id, quantile_cont(value, 0.5) OVER (PARTITION BY channel_id ORDER BY t_us, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS q FROM ({S})")
def running_quantile(spark, sf_dir):
    return signal.running_quantile(samples(spark, sf_dir), "value", ["t_us", "event_id"], "channel_id", span=4, bucket=DAY).select("channel_id", "event_id", "q")


@query(f"SELECT channel_id, round(coalesce(avg(CASE WHEN value <> 0 THEN abs((value - round(value / 7.0::DOUBLE) * 7.0::DOUBLE) / value) END), 0), 9) AS ratio FROM ({S}) GROUP BY channel_id")
def residual_ratio(spark, sf_dir):
    s = samples(spark, sf_dir)
    decoded = scale.lossy_unscale(scale.lossy_scale(F.col("value"), F.lit(7.0)), F.lit(7.0))
    return s.groupBy("channel_id").agg(F.round(signal.residual_ratio(F.col("value"), decoded), 9).alias("ratio"))


@query("SELECT o_orderkey, regexp_extract('seg-' || lpad((o_orderkey % 1000000)::VARCHAR, 6, '0'), '-([0-9]{6})', 1)::INTEGER AS segment, o_orderkey AS start, (o_custkey % 2)::INTEGER AS flag, 'raw' AS suffix FROM orders")
def file_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    c = labels.chunk_parts(F.concat(F.lit("a_b_"), F.col("o_orderkey").cast("string"), F.lit("_"), (F.col("o_custkey") % 2).cast("string"), F.lit("_raw.raw32")))
    return o.select("o_orderkey", labels.segment_number(F.concat(F.lit("seg-"), F.lpad((F.col("o_orderkey") % 1_000_000).cast("string"), 6, "0"))).alias("segment"), c["start"].alias("start"), c["flag"].alias("flag"), c["suffix"].alias("suffix"))


@query("SELECT event_id, 'c' || user_id AS channel, (user_id * 10)::INTEGER AS rate FROM events")
def header_fields(spark, sf_dir):
    h = F.concat(F.lit("header.format = 'Open';\nheader.channel = 'c"), F.col("user_id").cast("string"), F.lit("';\nheader.sampleRate = "), (F.col("user_id") * 10).cast("string"), F.lit(";\n"))
    m = labels.header_map(h)
    return table(spark, sf_dir, "events").select("event_id", m["channel"].alias("channel"), m["sampleRate"].cast("int").alias("rate"))


@query("SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'dir/' || event_id ELSE coalesce(CASE WHEN user_id % 3 = 1 THEN 'u' || user_id END, 'j' || event_id % 7) || '/exports/j' || event_id % 7 || '/' || event_id END AS key FROM events")
def upload_key(spark, sf_dir):
    u = F.col("user_id")
    s = lambda x: x.cast("string")
    key = labels.upload_key(F.when(u % 3 == 0, F.lit("dir")), F.when(u % 3 == 1, F.concat(F.lit("u"), s(u))), F.concat(F.lit("j"), s(F.col("event_id") % 7)), s(F.col("event_id")))
    return table(spark, sf_dir, "events").select("event_id", key.alias("key"))


@query(f"SELECT event_id, t_us + event_id / 30000.0::DOUBLE * 1e6::DOUBLE AS spike, t_us + 5 / 30000.0::DOUBLE * 1e6::DOUBLE * 1 + event_id * (1e6::DOUBLE / 30000.0::DOUBLE) AS record, CASE WHEN event_id % 2 = 0 THEN t_us ELSE -(-t_us - 1000) END AS plain, t_us + event_id / 4294967296.0::DOUBLE AS clock FROM ({S})")
def stamped_times(spark, sf_dir):
    t, i = F.col("t_us"), F.col("event_id")
    return samples(spark, sf_dir).select("event_id", timeaxis.stamp_time(t, i, F.lit(30000.0)).alias("spike"), timeaxis.record_time(t, F.lit(5), i, F.lit(30000.0)).alias("record"), timeaxis.remove_offset(F.when(i % 2 == 0, t).otherwise(-t), F.lit(1000)).alias("plain"), timeaxis.fraction_clock(t, i).alias("clock"))


@query("SELECT vec_id, (pos - 1) % 4 AS channel, (pos - 1) // 4 AS i, embedding[pos]::DOUBLE AS value FROM embeddings, unnest(range(1, len(embedding) + 1)) AS p(pos)")
def deinterleave(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "value"))
    return e.select("vec_id", (F.col("pos") % 4).cast("long").alias("channel"), F.floor(F.col("pos") / 4).alias("i"), F.col("value").cast("double").alias("value"))


@query("SELECT prefix, count(*) AS n, count(DISTINCT kind) AS kinds FROM (SELECT 'p' || user_id AS prefix, event_type AS kind FROM events) GROUP BY prefix")
def group_by_prefix(spark, sf_dir):
    f = table(spark, sf_dir, "events").select(F.concat_ws(",", F.concat(F.lit("p"), F.col("user_id").cast("string")), "event_type").alias("f"))
    return f.groupBy(F.substring_index("f", ",", 1).alias("prefix")).agg(F.count("*").alias("n"), F.countDistinct(F.substring_index("f", ",", -1)).alias("kinds"))


@query(f"SELECT channel_id, (rn - 1) // 100 AS batch, min(t_us) AS lo, max(t_us) + 1 AS hi, count(*) AS count FROM (SELECT channel_id, t_us, row_number() OVER (PARTITION BY channel_id ORDER BY t_us) AS rn FROM ({S})) GROUP BY ALL")
def unit_batches(spark, sf_dir):
    s = samples(spark, sf_dir).select("channel_id", "t_us", (F.col("event_id") % 3).cast("short").alias("unit"), F.array("value").alias("waveform"))
    u = store.to_unit_ranges(s, 100)
    over = Window.partitionBy("channel_id").orderBy("lo")
    return u.select("channel_id", (F.row_number().over(over) - 1).cast("long").alias("batch"), "lo", "hi", "count")


@query(f"WITH {SEG} SELECT channel_id, lo, hi, n FROM r")
def gap_sessions(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("channel_id"), F.col("ts").cast("timestamp").alias("ts"))
    return ingest.gap_sessions(e, "ts", "1 hour", "channel_id")


@query("SELECT c_nationkey AS k, greatest(coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_custkey END, 10), 10) AS lo, least(coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_custkey + 30 END, 900), 900) AS hi FROM customer WHERE greatest(coalesce(CASE WHEN c_custkey % 3 > 0 THEN c_custkey END, 10), 10) < least(coalesce(CASE WHEN c_custkey % 5 > 0 THEN c_custkey + 30 END, 900), 900)")
def merge_ranges(spark, sf_dir):
    c, i = table(spark, sf_dir, "customer"), F.col("c_custkey")
    user = c.select(F.col("c_nationkey").alias("k"), F.when(i % 3 > 0, i).alias("lo"), F.when(i % 5 > 0, i + 30).alias("hi"))
    file = c.select(F.col("c_nationkey").alias("k")).distinct().withColumn("lo", F.lit(10)).withColumn("hi", F.lit(900))
    return joins.merge_ranges(user, file, "k")


@query("SELECT DISTINCT o_custkey::VARCHAR AS channel FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 > 0)")
def unknown_channels(spark, sf_dir):
    asked = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("channel"))
    known = table(spark, sf_dir, "customer").where("c_custkey % 4 > 0").select(F.col("c_custkey").cast("string").alias("channel"))
    return joins.unknown_channels(asked, known)


@query(f"SELECT channel_id, event_id, rn FROM (SELECT channel_id, event_id, row_number() OVER (PARTITION BY channel_id ORDER BY t_us, event_id) AS rn FROM ({S})) WHERE rn <= 10")
def first_ten(spark, sf_dir):
    over = Window.partitionBy("channel_id").orderBy("t_us", "event_id")
    return samples(spark, sf_dir).withColumn("rn", F.row_number().over(over).cast("long")).where("rn <= 10").select("channel_id", "event_id", "rn")


@query("""WITH RECURSIVE c AS (SELECT c_nationkey, c_custkey, 100.0::DOUBLE + c_custkey % 17 AS v, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS r FROM customer),
    f AS (SELECT c_nationkey, c_custkey, v, r, v AS matched, [v] AS known FROM c WHERE r = 1
        UNION ALL SELECT n.c_nationkey, n.c_custkey, n.v, n.r, coalesce(n.hit, n.v), CASE WHEN n.hit IS NULL THEN list_append(n.known, n.v) ELSE n.known END
        FROM (SELECT c.*, f.known, list_filter(f.known, lambda k: abs(c.v - k) / k <= 0.02::DOUBLE)[1] AS hit FROM f JOIN c ON c.c_nationkey = f.c_nationkey AND c.r = f.r + 1) n)
    SELECT c_nationkey AS source, c_custkey AS i, v AS interval, matched FROM f""")
def match_intervals(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("source"), F.col("c_custkey").alias("i"), (F.lit(100.0) + F.col("c_custkey") % 17).alias("interval"))
    return joins.match_intervals(c, "interval", "i", "source")


#: The filter of butterworth_lowpass in SQL, from its closed form; a recursion goes a sample further in all stretches at once, forwards and then backwards.
LOWPASS = f"""WITH RECURSIVE {SEG},
    k AS (SELECT tan(pi() * 0.1) AS k), c AS (SELECT k * k / (1 + sqrt(2) * k + k * k) AS b0, 2 * (k * k - 1) / (1 + sqrt(2) * k + k * k) AS a1, (1 - sqrt(2) * k + k * k) / (1 + sqrt(2) * k + k * k) AS a2 FROM k),
    x AS (SELECT channel_id, seg, list(value ORDER BY t_us, event_id) AS x, count(*) AS n, least(6, count(*) - 1) AS pad FROM g GROUP BY channel_id, seg),
    w AS MATERIALIZED (SELECT channel_id, seg, pad, list_concat(list_concat(list_transform(range(pad, 0, -1), lambda i: 2 * x[1] - x[i + 1]), x), list_transform(range(1, pad + 1), lambda i: 2 * x[n] - x[n - i])) AS w FROM x),
    forward AS (SELECT channel_id, seg, 1 AS i, w[1] AS y, (b0 * 2 * w[1] - a1 * w[1] + (b0 - a2) * w[1]) AS z1, (b0 - a2) * w[1] AS z2 FROM w, c
        UNION ALL SELECT f.channel_id, f.seg, f.i + 1, b0 * w.w[f.i + 1] + z1, 2 * b0 * w.w[f.i + 1] - a1 * (b0 * w.w[f.i + 1] + z1) + z2, b0 * w.w[f.i + 1] - a2 * (b0 * w.w[f.i + 1] + z1) FROM forward f JOIN w USING (channel_id, seg), c WHERE f.i < len(w.w)),
    v AS MATERIALIZED (SELECT channel_id, seg, list(y ORDER BY i DESC) AS w FROM forward GROUP BY channel_id, seg),
    backward AS (SELECT channel_id, seg, 1 AS i, w[1] AS y, (b0 * 2 * w[1] - a1 * w[1] + (b0 - a2) * w[1]) AS z1, (b0 - a2) * w[1] AS z2 FROM v, c
        UNION ALL SELECT f.channel_id, f.seg, f.i + 1, b0 * v.w[f.i + 1] + z1, 2 * b0 * v.w[f.i + 1] - a1 * (b0 * v.w[f.i + 1] + z1) + z2, b0 * v.w[f.i + 1] - a2 * (b0 * v.w[f.i + 1] + z1) FROM backward f JOIN v USING (channel_id, seg), c WHERE f.i < len(v.w)),
    y AS (SELECT channel_id, seg, list(y ORDER BY i DESC) AS y FROM backward GROUP BY channel_id, seg),
    n AS (SELECT *, row_number() OVER (PARTITION BY channel_id, seg ORDER BY t_us, event_id) AS i FROM g)
    SELECT n.channel_id, n.seg, n.t_us, n.value, n.event_id, round(CASE WHEN w.pad = 0 THEN n.value ELSE y.y[w.pad + n.i] END, 6) AS filtered
    FROM n JOIN w USING (channel_id, seg) JOIN y USING (channel_id, seg)"""


@query(LOWPASS)
def butterworth_lowpass(spark, sf_dir):
    """Every contiguous stretch as a whole, in buckets of a day."""
    rows = sequence.find_gaps(samples(spark, sf_dir), F.lit(HOUR), tie="event_id", bucket_us=DAY).select("channel_id", "seg", "t_us", "value", "event_id")
    out = signal.filter_segments(rows, 2, (10.0,), 100.0, "lowpass", "channel_id", "seg", tie="event_id", bucket_rows=DAY // 10_000)
    return out.withColumn("filtered", F.round("filtered", 6))


@query(f"""WITH s AS (SELECT *, event_id % 20 AS phase, event_id // 400 AS stretch FROM ({S})), m AS (SELECT channel_id, stretch, phase, median(value) AS m FROM s GROUP BY ALL),
    l AS (SELECT channel_id, stretch, avg(m) AS l FROM m GROUP BY ALL) SELECT channel_id, t_us, value, event_id, round(value - (m - l), 6) AS cleaned FROM s JOIN m USING (channel_id, stretch, phase) JOIN l USING (channel_id, stretch)""")
def line_noise(spark, sf_dir):
    out = signal.remove_line_noise_adaptive(samples(spark, sf_dir), 20, "event_id", "value", "channel_id")
    return out.select("channel_id", "t_us", "value", "event_id", F.round("cleaned", 6).alias("cleaned"))


@query("SELECT c_nationkey, c_custkey, CASE WHEN c_custkey % 3 > 0 THEN row_number() OVER (PARTITION BY c_nationkey, c_custkey % 3 > 0 ORDER BY c_custkey) - 1 ELSE -1 END AS index_id FROM customer")
def dense_channel_ids(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey")
    return sequence.dense_ids(c, F.col("c_custkey") % 3 > 0, "c_custkey", "c_nationkey")


@query("SELECT n_nationkey, n_name AS unit, 'integer' AS type, 0.5::DOUBLE AS factor, CASE WHEN n_nationkey % 2 = 0 THEN 4 ELSE 3 END AS width, n_nationkey % 2 = 1 AS composite FROM nation")
def xml_settings(spark, sf_dir):
    n = table(spark, sf_dir, "nation")
    xml = F.concat(F.lit("<r><Units>"), F.col("n_name"), F.lit("</Units><C><E type='integer'/><E type='integer'/></C></r>"))
    code = F.when(F.col("n_nationkey") % 2 == 0, 0x04).otherwise(0x85)
    factor = scale.conversion(F.lit(-10.0), F.lit(10.0), F.lit(-5.0), F.lit(5.0))
    return n.select("n_nationkey", labels.xml_text(xml, "r/Units").alias("unit"), labels.all_equal(xml, "r/C/E/@type").alias("type"), factor.alias("factor"), labels.sample_format(code).alias("width"), labels.is_composite(code).alias("composite"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'skip' WHEN 1 THEN 'continuous' WHEN 2 THEN 'spike' ELSE 'event' END AS kind, CASE WHEN o_orderkey % 2 = 0 THEN 'int24' ELSE 'float32' END AS type FROM orders")
def file_kinds(spark, sf_dir):
    k = F.col("o_orderkey") % 4
    name = F.when(k == 0, F.lit("a.events")).otherwise(F.lit("a.dat"))
    text = F.when(k == 1, F.lit("Continuous data")).when(k == 2, F.lit("spike records")).otherwise(F.lit("event records"))
    even = F.col("o_orderkey") % 2 == 0
    kind = labels.value_type(F.when(even, F.lit("int")).otherwise(F.lit("float")), F.when(even, 3).otherwise(4))
    return table(spark, sf_dir, "orders").select("o_orderkey", labels.file_kind(name, text).alias("kind"), kind.alias("type"))


# gains, times and names that files give


@query("SELECT l_orderkey, l_linenumber, l_quantity * 0.25::DOUBLE AS gained, (l_partkey % 65536 - 32768) / l_quantity / 1000 AS volts, l_extendedprice * 0.195::DOUBLE AS bits, 2.0::DOUBLE AS factor FROM lineitem")
def gains(spark, sf_dir):
    x = table(spark, sf_dir, "lineitem")
    factor = scale.conversion(F.lit(-4.0), F.lit(4.0), F.lit(-8.0), F.lit(8.0))
    return x.select("l_orderkey", "l_linenumber", scale.gain(F.col("l_quantity"), F.lit(0.25)).alias("gained"), scale.spike_volts(F.col("l_partkey") % 65536, F.col("l_quantity")).alias("volts"), scale.bit_volts(F.col("l_extendedprice"), F.lit(0.195)).alias("bits"), factor.alias("factor"))


@query("SELECT l_orderkey, l_linenumber, 5000.0::DOUBLE + l_linenumber * 100.0::DOUBLE AS arange, 1e6::DOUBLE * (l_partkey / 250.0::DOUBLE) + 5000.0::DOUBLE AS by_index, 5000.0::DOUBLE + l_suppkey / 250.0::DOUBLE * 1e6::DOUBLE AS stamped, 5000.0::DOUBLE + (l_partkey - 1) / 250.0::DOUBLE * 1e6::DOUBLE AS last FROM lineitem")
def time_axes(spark, sf_dir):
    x, start, rate = table(spark, sf_dir, "lineitem"), F.lit(5000.0), F.lit(250.0)
    return x.select("l_orderkey", "l_linenumber", timeaxis.arange_at(start, F.lit(100.0), F.col("l_linenumber")).alias("arange"), timeaxis.time_from_index(start, F.col("l_partkey"), rate).alias("by_index"), timeaxis.stamp_time(start, F.col("l_suppkey"), rate).alias("stamped"), timeaxis.last_sample_time(start, F.col("l_partkey"), rate).alias("last"))


@query("SELECT o_orderkey, CASE WHEN o_custkey < 129 THEN 'chan' || o_custkey ELSE 'ainp' || (o_custkey - 128) END AS label, 'c' || o_custkey || '-250' AS key, (CASE WHEN 1900 + o_orderkey % 100 < 1985 THEN 2000 + o_orderkey % 100 ELSE 1900 + o_orderkey % 100 END)::INTEGER AS year, trunc(o_totalprice * 1e6::DOUBLE)::BIGINT AS micros FROM orders")
def channel_names(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    name = F.concat(F.lit(" c"), F.col("o_custkey").cast("string"), F.lit("  "))
    return o.select("o_orderkey", labels.default_label(F.col("o_custkey")).alias("label"), labels.channel_key(name, F.lit(250)).alias("key"), timeaxis.two_digit_year(F.col("o_orderkey") % 100).alias("year"), timeaxis.scaled_micros(F.col("o_totalprice")).alias("micros"))


# stores and files: written from a table, read back


@query(f"SELECT channel_id, t_us, value FROM ({S})")
def blob_round_trip(spark, sf_dir):
    """Samples as gzip blobs of big-endian doubles, one for each hour, and expanded again."""
    ship(spark)
    seg = _ranges(spark, sf_dir)
    back = wire.from_blobs(materialise(wire.to_blobs(seg.select("channel_id", "rate", "lo", "hi", "location", "values")), "blobs"))
    times = seg.select("channel_id", "lo", "times")
    both = back.join(times, ["channel_id", "lo"]).select("channel_id", F.explode(F.arrays_zip("times", "values")).alias("p"))
    return both.select("channel_id", F.col("p.times").alias("t_us"), F.col("p.values").alias("value"))


def _ranges(spark, sf_dir):
    """Blocks of events in which time runs, by hour: a bounded array of values and their times."""
    s = samples(spark, sf_dir).withColumn("hour", F.floor(F.col("t_us") / HOUR))
    r = s.groupBy("channel_id", "hour").agg(F.sort_array(F.collect_list(F.struct("t_us", "event_id", "value"))).alias("x"))
    return r.select("channel_id", F.lit(1.0).alias("rate"), F.element_at("x.t_us", 1).alias("lo"), (F.element_at("x.t_us", -1) + 1).alias("hi"), F.concat_ws("/", "channel_id", "hour").alias("location"), F.col("x.value").alias("values"), F.col("x.t_us").alias("times"))


def _coded(encode, decode):
    """The query of a block coder: blocks of orders' keys by customer, encoded and decoded."""

    def run(spark, sf_dir):
        ship(spark)
        o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list((F.col("o_orderkey") % 4_000_000).cast("int"))).alias("x"), F.min("o_orderkey").alias("t"))

        def code(batches):
            for b in batches:
                blocks = pa.array([encode(t.as_py(), np.asarray(x.values, np.int32)) for x, t in zip(b.column(1), b.column(2))], pa.binary())
                yield pa.RecordBatch.from_arrays([b.column(0), blocks], names=["o_custkey", "block"])

        def back(batches):
            for b in batches:
                got = [decode(x.as_py()) for x in b.column(1)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([g[0] for g in got], pa.int64()), pa.array([np.asarray(g[1]).tolist() for g in got], pa.list_(pa.int64()))], names=["o_custkey", "t", "x"])

        blocks = materialise(o.mapInArrow(code, "o_custkey long, block binary"), "red")
        out = blocks.mapInArrow(back, "o_custkey long, t long, x array<long>")
        return out.select("o_custkey", "t", F.posexplode("x").alias("pos", "value")).select("o_custkey", "t", F.col("pos").cast("long").alias("pos"), "value")

    return run


RED = "SELECT o_custkey, min(o_orderkey) OVER (PARTITION BY o_custkey) AS t, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey % 4000000) - 1 AS pos, (o_orderkey % 4000000)::BIGINT AS value FROM orders"


@query(RED)
def red_blocks_mef2(spark, sf_dir):
    return _coded(red.encode_mef2, red.decode_mef2)(spark, sf_dir)


@query(RED)
def red_blocks_mef3(spark, sf_dir):
    return _coded(red.encode_mef3, red.decode_mef3)(spark, sf_dir)


def _customer_blocks(spark, sf_dir):
    """A block for every customer, of the keys and prices of their orders."""
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", F.round("o_totalprice").cast("long").alias("p")))).alias("x"))
    return o.select("o_custkey", F.element_at("x.o_orderkey", 1).alias("t"), F.col("x.p").alias("x"))


@query("SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos, (round(round(round(o_totalprice) / 7.0::DOUBLE) * 7.0::DOUBLE))::BIGINT AS value FROM orders")
def red_fixed_scale(spark, sf_dir):
    """Blocks coded by a fixed scale, written and read back."""
    ship(spark)
    coded = materialise(wire.to_red(_customer_blocks(spark, sf_dir), "t", "x", scale=7.0).select("o_custkey", "block"), "red")
    return wire.from_red(coded).select("o_custkey", F.posexplode("values").alias("pos", "value")).select("o_custkey", F.col("pos").cast("long").alias("pos"), "value")


@query("SELECT o_custkey, count(*) AS n, TRUE AS within, TRUE AS as_measured FROM orders GROUP BY o_custkey")
def red_residual_goal(spark, sf_dir):
    """Blocks coded for a mean residual ratio of 0.03 without their trend: whether what is read back is as near to the originals, and as far, as the coder says."""
    ship(spark)
    coded = materialise(wire.to_red(_customer_blocks(spark, sf_dir), "t", "x", residual=0.03, detrend=True, least_normality=None), "red")
    pairs = wire.from_red(coded).select("o_custkey", "residual", F.explode(F.arrays_zip("x", "values")).alias("p"))
    got = pairs.groupBy("o_custkey").agg(F.count("*").alias("n"), signal.residual_ratio(F.col("p.x").cast("double"), F.col("p.values").cast("double")).alias("r"), F.first("residual").alias("s"))
    return got.select("o_custkey", "n", (F.col("r") <= 0.03 + 1e-12).alias("within"), (F.abs(F.col("r") - F.col("s")) < 1e-9).alias("as_measured"))


@query("SELECT 'price' AS channel, 'uV' AS unit, o_orderkey * 1000 AS t_us, o_totalprice AS value FROM orders UNION ALL SELECT 'customer', 'uV', o_orderkey * 1000, o_custkey::DOUBLE FROM orders WHERE o_custkey % 3 > 0")
def csv_series(spark, sf_dir):
    """A CSV series of two channels, one with missing values, written from orders and read by its source."""
    path = scratch(spark, "csv")
    o = table(spark, sf_dir, "orders")
    o.select((F.col("o_orderkey") * 1000).alias("time"), F.col("o_totalprice").alias("price"), F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias(" customer")).write.csv(path, header=True)
    return plain.read_csv_series(spark, path).select("channel", "unit", "t_us", "value")
