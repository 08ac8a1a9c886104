"""Time axes as column arithmetic: position times step, never a generated sequence of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1e6


def sample_period(rate: Column) -> Column:
    """Microseconds between samples."""
    return F.lit(MICROS) / rate


def time_at(lo: Column, pos: Column, rate: Column, drift: bool = False) -> Column:
    """Time of the pos-th sample of a range. drift: the step rounded at the magnitude of lo, as adding doubles one by one gives."""
    period = sample_period(rate)
    start = lo.cast("double")
    return start + pos * (((start + period) - start) if drift else period)


def range_end(lo: Column, n: Column, rate: Column) -> Column:
    """Exclusive end of a range of n samples: lo + (n - 1) periods + 1, truncated."""
    return (lo + (n - 1) * F.lit(MICROS) / rate + F.lit(1.0)).cast("long")


def range_count(lo: Column, hi: Column, rate: Column) -> Column:
    """Samples that fit into [lo, hi) at the rate."""
    return F.ceil((hi - lo) / sample_period(rate)).cast("long")


def linspace_at(start: Column, end: Column, n: Column, pos: Column) -> Column:
    """The pos-th of n evenly spaced times with both ends, truncated to whole microseconds."""
    return F.when(n <= 1, start.cast("long")).otherwise((start + pos * ((end - start) / (n - 1).cast("double"))).cast("long"))


def linspace_open_at(start: Column, duration_s: Column, n: Column, pos: Column) -> Column:
    """The pos-th of n evenly spaced times over a record, without its end."""
    return start + pos * (duration_s * F.lit(MICROS)) / n


def arange_at(start: Column, step: Column, pos: Column) -> Column:
    return start + pos * step


def time_from_index(start: Column, pos: Column, rate: Column) -> Column:
    return F.lit(MICROS) * (pos / rate) + start


def record_time(start: Column, first_stamp: Column, pos: Column, rate: Column, twice: bool = False) -> Column:
    """Times of a recording whose stamps count samples. twice: the first stamp's offset is added a second time."""
    offset = first_stamp / rate * F.lit(MICROS)
    return start + offset * (2 if twice else 1) + pos * sample_period(rate)


def stamp_time(start: Column, stamp: Column, rate: Column, first_stamp: Column | None = None) -> Column:
    """Time of an event whose stamp counts samples. With first_stamp, the recording's own offset is added on top."""
    t = start + stamp / rate * F.lit(MICROS)
    return t if first_stamp is None else t + first_stamp / rate * F.lit(MICROS)


def last_sample_time(start: Column, n: Column, rate: Column) -> Column:
    return start + (n - 1) / rate * F.lit(MICROS)


def span_from_increment(n: Column, increment_s: Column) -> Column:
    """Whole microseconds from the first to the last of n samples, halves away from zero."""
    return F.round((n - 1) * increment_s * F.lit(MICROS)).cast("long")


def relative_seconds(t_us: Column, session_start: Column) -> Column:
    return (t_us - session_start) / F.lit(MICROS)


def fraction_clock(whole: Column, fraction: Column) -> Column:
    """An interval kept as whole microseconds and a 32-bit binary fraction."""
    return whole + fraction / F.lit(2.0**32)


def remove_offset(t: Column, offset: Column) -> Column:
    """Negative recording times carry an offset: -(t - offset); others stay."""
    return F.when(t < 0, -(t - offset)).otherwise(t)


def apply_offset(t: Column, offset: Column) -> Column:
    return F.when(t > 0, -t + offset).otherwise(t)


def ole_to_micros(days: Column) -> Column:
    """Microseconds since 1970 of an OLE date, in UTC."""
    return ((days * F.lit(86400.0) - F.lit(2209161600.0)) * F.lit(MICROS)).cast("long")


def scaled_micros(seconds: Column) -> Column:
    """Seconds to microseconds, truncated."""
    return (seconds * F.lit(MICROS)).cast("long")


def two_digit_year(yy: Column) -> Column:
    """1985 to 2084."""
    y = yy.cast("int") + 1900
    return F.when(y < 1985, y + 100).otherwise(y)
