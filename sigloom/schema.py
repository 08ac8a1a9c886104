"""The data model: explicit schemas of every table."""

from pyspark.sql import types as T

CHANNELS = T.StructType([
    T.StructField("channel_id", T.StringType(), False), T.StructField("package_id", T.StringType()), T.StructField("name", T.StringType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("unit", T.StringType()), T.StructField("rate", T.DoubleType()),
    T.StructField("type", T.StringType()), T.StructField("group", T.StringType()), T.StructField("last_annotation", T.LongType()),
    T.StructField("properties", T.ArrayType(T.MapType(T.StringType(), T.StringType()))), T.StructField("created_at", T.StringType()),
])
#: One row per sample; t_us counts microseconds since 1970.
SAMPLES = T.StructType([T.StructField("channel_id", T.StringType(), False), T.StructField("t_us", T.LongType(), False), T.StructField("value", T.DoubleType())])
#: One row per stored stretch of contiguous samples, half-open [lo, hi).
RANGES = T.StructType([
    T.StructField("channel_id", T.StringType(), False), T.StructField("rate", T.DoubleType(), False), T.StructField("lo", T.LongType(), False), T.StructField("hi", T.LongType(), False),
    T.StructField("location", T.StringType()), T.StructField("follows_gap", T.BooleanType()), T.StructField("values", T.ArrayType(T.DoubleType())),
])
SPIKES = T.StructType([T.StructField("channel_id", T.StringType(), False), T.StructField("t_us", T.LongType(), False), T.StructField("unit", T.ShortType()), T.StructField("waveform", T.ArrayType(T.DoubleType()))])
UNIT_RANGES = T.StructType([
    T.StructField("channel_id", T.StringType(), False), T.StructField("lo", T.LongType(), False), T.StructField("hi", T.LongType(), False), T.StructField("count", T.LongType()),
    T.StructField("tsindex", T.StringType()), T.StructField("tsblob", T.StringType()), T.StructField("times", T.ArrayType(T.LongType())), T.StructField("units", T.ArrayType(T.ShortType())), T.StructField("waveforms", T.ArrayType(T.ArrayType(T.DoubleType()))),
])
ANNOTATIONS = T.StructType([T.StructField("source", T.StringType()), T.StructField("type", T.StringType()), T.StructField("t_us", T.LongType()), T.StructField("duration_us", T.LongType()), T.StructField("label", T.StringType()), T.StructField("props", T.MapType(T.StringType(), T.StringType()))])
#: What every continuous source yields: samples with the channel's name, unit and nominal rate.
SOURCE = "channel string, unit string, rate double, t_us long, value double"
SOURCE_SPIKES = "channel string, t_us long, unit short, waveform array<double>"
