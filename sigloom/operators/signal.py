"""Signal statistics and filters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sigloom.operators import sequence
from sigloom.session import materialise


def detrend(samples: DataFrame, index: str, value: str, *keys: str) -> DataFrame:
    """Per key the least-squares slope and intercept over the index, and each value less the line."""
    line = samples.groupBy(*keys).agg(F.regr_slope(value, index).alias("slope"), F.regr_intercept(value, index).alias("intercept"))
    return samples.join(line, list(keys)).withColumn("residual", F.col(value) - (F.col("slope") * F.col(index) + F.col("intercept")))


def retrend(residual: Column, index: Column, slope: Column, intercept: Column) -> Column:
    return residual + (slope * index + intercept)


def residual_ratio(original: Column, decoded: Column) -> Column:
    """Mean of |(original - decoded) / original| over non-zero originals, 0 without any (an aggregate)."""
    return F.coalesce(F.avg(F.when(original != 0, F.abs((original - decoded) / original))), F.lit(0.0))


def block_extremes(samples: DataFrame, block: Column, value: str, *keys: str) -> DataFrame:
    return samples.withColumn("block", block).groupBy(*keys, "block").agg(F.min(value).alias("min_value"), F.max(value).alias("max_value"), F.count("*").alias("n"))


def z_bins(samples: DataFrame, value: str, *keys: str, scale: int = 10, offset: float = 3.1, bins: int = 62) -> DataFrame:
    """Counts of standardised values by bin floor((z + offset) * scale), ends clipped."""
    stats = samples.groupBy(*keys).agg(F.avg(value).alias("_m"), F.stddev_pop(value).alias("_s"))
    z = (F.col(value) - F.col("_m")) / F.col("_s")
    b = F.floor((z + offset) * scale).cast("int")
    b = F.when(b < 0, 0).when(b >= bins, bins - 1).otherwise(b)
    return samples.join(stats, list(keys)).where("_s > 0").withColumn("bin", b).groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def normality(samples: DataFrame, value: str, *keys: str) -> DataFrame:
    """Correlation of the cumulative distribution of standardised values with the normal one (logistic approximation of the latter)."""
    counts = z_bins(samples, value, *keys)
    grid = counts.select(*keys).distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(61))))
    over = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    cdf = grid.join(counts, [*keys, "bin"], "left").withColumn("c", F.sum(F.coalesce("n", F.lit(0))).over(over).cast("double"))
    x = (F.col("bin") + 1) / F.lit(10.0) - F.lit(3.1)
    normal = F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(-1.5976) * x - F.lit(0.07056) * x * x * x))
    return cdf.groupBy(*keys).agg(F.corr("c", normal).alias("normality"))


def running_quantile(rows: DataFrame, value: str, order: list[str], *keys: str, span: int = 5, q: float = 0.5, out: str = "q", **sizes: int) -> DataFrame:
    """Quantile over an odd span centred on each row (an even span is one more), for keys with any number of rows."""
    half = (span if span % 2 else span + 1) // 2
    return sequence.with_neighbours(rows, out, lambda over: F.percentile(value, F.lit(q)).over(over), order, *keys, before=half, after=half, **sizes)


def _poly(roots) -> np.ndarray:
    return np.real(np.poly(roots))


def butterworth(order: int, cutoffs: tuple[float, ...], rate: float, kind: str = "lowpass") -> tuple[np.ndarray, np.ndarray]:
    """Coefficients (b, a) by the bilinear transform of the analogue prototype; kind: lowpass, highpass, bandpass, bandstop."""
    warped = [2 * rate * np.tan(np.pi * f / rate) for f in cutoffs]
    k = np.arange(1, order + 1)
    poles = np.exp(1j * np.pi * (2 * k + order - 1) / (2 * order))
    zeros, gain_ = np.zeros(0, complex), 1.0
    if kind == "lowpass":
        poles, gain_ = poles * warped[0], warped[0] ** order
    elif kind == "highpass":
        poles, zeros = warped[0] / poles, np.zeros(order, complex)
    else:
        width, centre = warped[1] - warped[0], np.sqrt(warped[0] * warped[1])
        half = (poles if kind == "bandpass" else 1 / poles) * width / 2
        root = np.sqrt(half * half - centre * centre)
        poles = np.concatenate([half + root, half - root])
        if kind == "bandpass":
            zeros, gain_ = np.zeros(order, complex), width**order
        else:
            zeros = np.concatenate([np.full(order, 1j * centre), np.full(order, -1j * centre)])
    fs2 = 2 * rate
    zd, pd_ = (fs2 + zeros) / (fs2 - zeros), (fs2 + poles) / (fs2 - poles)
    gain_ = gain_ * np.real(np.prod(fs2 - zeros) / np.prod(fs2 - poles))
    zd = np.concatenate([zd, -np.ones(len(poles) - len(zeros))])
    return gain_ * _poly(zd), _poly(pd_)


class Recurrence:
    """A rational filter (b, a) in direct form II transposed: y = z[0] + b0 x, then z = step z + push x."""

    def __init__(self, b: np.ndarray, a: np.ndarray, block: int = 128):
        n = max(len(a), len(b))
        b, a = np.pad(b, (0, n - len(b))) / a[0], np.pad(a, (0, n - len(a))) / a[0]
        self.b, self.a, self.size, self.block = b, a, n - 1, block
        self.step = np.zeros((n - 1, n - 1))
        if n > 1:
            self.step[:, 0] = -a[1:]
            self.step[:-1, 1:] += np.eye(n - 2)
        self.push = b[1:] - a[1:] * b[0]
        #: The state in which a constant input of one stays one.
        self.settled = np.linalg.solve(np.eye(n - 1) - self.step, self.push) if n > 1 else np.zeros(0)
        self.pad = 3 * (n - 1)
        self.powers = [np.eye(n - 1)]
        for _ in range(block):
            self.powers.append(self.step @ self.powers[-1])

    def run(self, x: np.ndarray, state: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The output and the state after it, a block at a time: what a block's input gives by itself is one matrix product over all blocks; only the state goes from block to block."""
        x, z = np.asarray(x, float), np.zeros(self.size) if state is None else np.asarray(state, float)
        if not self.size or not len(x):
            return self.b[0] * x, z
        block, powers = self.block, self.powers
        seen = np.stack([p[0] for p in powers[:block]])
        impulse = np.r_[self.b[0], seen[: block - 1] @ self.push]
        lag = np.subtract.outer(np.arange(block), np.arange(block))
        own = np.where(lag >= 0, impulse[np.maximum(lag, 0)], 0.0)
        carry = np.stack([powers[block - 1 - j] @ self.push for j in range(block)], axis=1)
        rest = len(x) % block
        rows = np.pad(x, (0, -len(x) % block)).reshape(-1, block)
        out, pushed = rows @ own.T, rows @ carry.T
        for r in range(len(rows)):
            out[r] += seen @ z
            if rest and r == len(rows) - 1:
                z = powers[rest] @ z + carry[:, block - rest :] @ rows[r, :rest]
            else:
                z = powers[block] @ z + pushed[r]
        return out.ravel()[: len(x)], z

    def over(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """For a stretch of n samples: its power P = step^n, and G, the sum of step^i push [1 0 ..] step^i over i < n.

        A state s before the stretch adds P s to the state after it. What s adds to
        the outputs adds G s to the state after filtering these backwards. Both by doubling.
        """
        power, gram = np.eye(self.size), np.zeros((self.size, self.size))
        once = np.zeros((self.size, self.size))
        once[:, :1] = self.push[:, None]
        for bit in bin(n)[2:]:
            power, gram = power @ power, gram + power @ gram @ power
            if bit == "1":
                power, gram = power @ self.step, gram + power @ once @ power
        return power, gram


def lfilter(b: np.ndarray, a: np.ndarray, x: np.ndarray, state: np.ndarray | None = None, block: int = 128) -> np.ndarray:
    """The filter's output, from a state."""
    return Recurrence(b, a, block).run(x, state)[0]


def extensions(head: np.ndarray, tail: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd reflections of pad samples before the first and after the last sample; head and tail hold pad + 1."""
    return 2 * head[0] - head[pad:0:-1], 2 * tail[-1] - tail[-2 : -pad - 2 : -1]


def filtfilt(b: np.ndarray, a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Zero-phase filtering: forwards and backwards, ends extended by odd reflection, with settled initial states."""
    f, x = Recurrence(b, a), np.asarray(x, float)
    pad = min(f.pad, len(x) - 1)
    if pad <= 0:
        return x.copy()
    before, after = extensions(x[: pad + 1], x[-pad - 1 :], pad)
    wide = np.concatenate([before, x, after])
    y, _ = f.run(wide, f.settled * wide[0])
    y, _ = f.run(y[::-1], f.settled * y[-1])
    return y[::-1][pad : len(y) - pad]


#: Samples of a bucket at the channel's rate.
BUCKET_ROWS = 1 << 20


def filter_segments(samples: DataFrame, order: int, cutoffs: tuple[float, ...], rate: float, kind: str, *keys: str, t: str = "t_us", value: str = "value", tie: str | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Butterworth, zero-phase, over contiguous stretches (one for each of keys) of any length: adds `filtered`.

    A stretch is cut into buckets of as much time as bucket_rows samples take. A filter's
    state goes through a bucket by an affine map, and so does the state of the filter that then goes
    backwards over its output. Buckets are filtered by themselves from a state of zero, which gives
    both maps' constants; the maps of a stretch, a row for each bucket, are composed from its first bucket
    to its last and back again; then every bucket is filtered from the states that reach it. So the result is that
    of filtering the whole stretch at once, whatever the buckets, and no task holds more than one.

    A stretch of one sample stays as it is; a null or NaN makes its whole stretch NaN, as at once; samples of equal
    times count in the order of tie. The samples are written once, and read for both passes.
    """
    f = Recurrence(*butterworth(order, cutoffs, rate, kind))
    ordered = [(c, "ascending") for c in ([t, tie] if tie else [t])]
    width = max(1, round(1e6 / rate * bucket_rows))
    rows = materialise(samples.withColumn("_bucket", F.floor(F.col(t) / F.lit(width)).cast("long")), "stretches")
    named = {c: rows.schema[c].dataType for c in keys}
    key_fields = ", ".join(f"`{c}` {d.simpleString()}" for c, d in named.items())
    edge = f.pad + 1

    def values(table: pa.Table) -> np.ndarray:
        return table[value].cast(pa.float64()).to_numpy()

    def summary(table: pa.Table) -> pa.Table:
        x = values(table.sort_by(ordered))
        y, ahead = f.run(x)
        _, behind = f.run(y[::-1])
        one = table.select([*keys, "_bucket"]).slice(0, 1)
        for name, item in (("head", x[:edge]), ("tail", x[-edge:]), ("ahead", ahead), ("behind", behind)):
            one = one.append_column(name, pa.array([item], pa.list_(pa.float64())))
        return one.append_column("n", pa.array([len(x)], pa.int64()))

    def compose(table: pa.Table) -> pa.Table:
        table = table.sort_by("_bucket")
        n = table["n"].to_pylist()
        parts = lambda c, of: [np.asarray(x) for x in of[c].to_pylist()]
        enough = min(len(n), edge)
        head, tail = np.concatenate(parts("head", table.slice(0, enough)))[:edge], np.concatenate(parts("tail", table.slice(len(n) - enough)))[-edge:]
        pad = min(f.pad, sum(n) - 1)
        out = table.select([*keys, "_bucket"])
        if pad <= 0:
            return out.append_column("ahead", pa.nulls(len(n), pa.list_(pa.float64()))).append_column("behind", pa.nulls(len(n), pa.list_(pa.float64())))
        before, after = extensions(head[: pad + 1], tail[-pad - 1 :], pad)
        maps = {m: f.over(m) for m in set(n)}
        ahead, behind = [f.run(before, f.settled * before[0])[1]], []
        for m, e in zip(n, parts("ahead", table)):
            ahead.append(maps[m][0] @ ahead[-1] + e)
        y, _ = f.run(after, ahead.pop())
        behind.append(f.run(y[::-1], f.settled * y[-1])[1])
        for m, e, s in zip(n[:0:-1], parts("behind", table)[:0:-1], ahead[:0:-1]):
            behind.append(maps[m][0] @ behind[-1] + e + maps[m][1] @ s)
        return out.append_column("ahead", pa.array(ahead, pa.list_(pa.float64()))).append_column("behind", pa.array(behind[::-1], pa.list_(pa.float64())))

    def finish(table: pa.Table, states: pa.Table) -> pa.Table:
        table = table.sort_by(ordered)
        x, (state,) = values(table), states.to_pylist()
        if state["ahead"] is not None:
            y, _ = f.run(x, state["ahead"])
            x = f.run(y[::-1], state["behind"])[0][::-1]
        return table.drop_columns(["_bucket"]).append_column("filtered", pa.array(x))

    lists = "ahead array<double>, behind array<double>"
    buckets = rows.groupBy(*keys, "_bucket").applyInArrow(summary, f"{key_fields}, _bucket long, head array<double>, tail array<double>, {lists}, n long")
    states = buckets.groupBy(*keys).applyInArrow(compose, f"{key_fields}, _bucket long, {lists}")
    return rows.groupBy(*keys, "_bucket").cogroup(states.groupBy(*keys, "_bucket")).applyInArrow(finish, StructType([*samples.schema.fields, StructField("filtered", DoubleType())]))


def remove_line_noise(samples: DataFrame, per_cycle: int, position: str, value: str, *keys: str) -> DataFrame:
    """Subtracts the median of each phase of the line cycle, centred on zero: the template of the noise."""
    phase = F.pmod(F.col(position), F.lit(per_cycle))
    rows = samples.withColumn("_phase", phase)
    template = rows.groupBy(*keys, "_phase").agg(F.median(value).alias("_m"))
    level = template.groupBy(*keys).agg(F.avg("_m").alias("_l"))
    return rows.join(template, [*keys, "_phase"]).join(level, list(keys)).withColumn("cleaned", F.col(value) - (F.col("_m") - F.col("_l"))).drop("_phase", "_m", "_l")


def remove_line_noise_adaptive(samples: DataFrame, per_cycle: int, position: str, value: str, *keys: str, cycles: int = 20) -> DataFrame:
    """The same with a template for each stretch of so many cycles."""
    stretch = F.floor(F.col(position) / F.lit(per_cycle * cycles)).alias("_stretch")
    return remove_line_noise(samples.withColumn("_stretch", stretch), per_cycle, position, value, *keys, "_stretch").drop("_stretch")
