"""Raw samples to physical units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def twos_complement(v: Column, bits: int) -> Column:
    """An unsigned reading of `bits` bits as signed."""
    sign = 1 << (bits - 1)
    return F.when(v.bitwiseAND(sign) != 0, v - (1 << bits)).otherwise(v)


def sign_extend_24(v: Column, wide_mask: bool = False) -> Column:
    """24-bit two's complement in an int. wide_mask: any value of 0x010000 or more counts as negative, as some old decoders have it."""
    low = v.bitwiseAND(0xFFFFFF)
    negative = low >= 0x010000 if wide_mask else low.bitwiseAND(0x800000) != 0
    return F.when(negative, low - (1 << 24)).otherwise(low)


def digital_to_physical(d: Column, pmin: Column, pmax: Column, dmin: Column, dmax: Column) -> Column:
    """Header-calibrated samples: gain * (pmax / gain - dmax + d)."""
    gain = (pmax - pmin) / (dmax - dmin)
    return gain * ((pmax / gain - dmax) + d)


def analog(x: Column, min_dig: Column, max_dig: Column, min_ana: Column, max_ana: Column) -> Column:
    """Symmetric ranges scale by a factor, others by an affine map, in single precision."""
    f = lambda c: c.cast("float")
    symmetric = (min_dig == -max_dig) & (min_ana == -max_ana)
    affine = f((f(x) - f(min_dig)) * f(f(max_ana - min_ana) / f(max_dig - min_dig))) + f(min_ana)
    return F.when(symmetric, f(f(x) * f(f(max_ana) / f(max_dig)))).otherwise(f(affine))


def gain(x: Column, factor: Column) -> Column:
    """Calibration, resolution, voltage and unit factors: one multiplication."""
    return x * factor


def conversion(input_lo: Column, input_hi: Column, output_lo: Column, output_hi: Column) -> Column:
    """Factor of a symmetric conversion; fails where the low ends give another."""
    up, down = output_hi / input_hi, output_lo / input_lo
    return F.when(up == down, up).otherwise(F.raise_error(F.lit("the conversion isn't symmetric")).cast("double"))


def spike_volts(u16: Column, gain_: Column, truncate: bool = False) -> Column:
    """Waveform counts around 32768 to volts. truncate: to whole unsigned numbers, as storing them in 16 bits gives."""
    v = (u16 - 32768) / gain_ / 1000
    return F.pmod(v.cast("long"), F.lit(65536)) if truncate else v


def bit_volts(raw: Column, factor: Column, apply: bool = True) -> Column:
    return raw * factor if apply else raw.cast("double")


def is_set(flag: Column, pos: int) -> Column:
    return flag.bitwiseAND(1 << pos) > 0


def lossy_scale(x: Column, factor: Column) -> Column:
    """Divide and round, halves away from zero."""
    return F.round(x / factor)


def lossy_unscale(x: Column, factor: Column) -> Column:
    return F.round(x * factor)
