"""Lossy RED blocks: lines taken off, scales chosen for a goal, many blocks at a time.

Blocks lie side by side in one array; `ptr` has where each begins and the last ends. What a block's header stores
as single-precision numbers is used as such from the start, so that what is measured here is what a reader gets.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from sigloom.functions.red import encode_mef3, round_away

#: Classes of a tenth of a standard deviation from -3.1, and their number.
CLASSES, LEAST_Z, STEP = 61, 3.1, 10.0
NORMAL = np.asarray([0.5 * (1 + math.erf(((k + 1) / STEP - LEAST_Z) / math.sqrt(2))) for k in range(CLASSES)])
#: Rounds of a search.
ROUNDS = 20


def owner(ptr: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))


def totals(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of each block; 0 of an empty one."""
    return np.bincount(owner(ptr), x, len(ptr) - 1) if len(ptr) > 1 else np.zeros(0)


def lines(x: np.ndarray, ptr: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least-squares slope and intercept of each block over 1 to n, in single precision; a block of one sample has no slope."""
    n, i = np.diff(ptr).astype(float), place(ptr)
    mean_i, mean_x = (n + 1) / 2, totals(x, ptr) / np.maximum(n, 1)
    d = i - mean_i[owner(ptr)]
    below = totals(d * d, ptr)
    slope = np.where(below > 0, totals(d * (x - mean_x[owner(ptr)]), ptr) / np.where(below > 0, below, 1), 0.0).astype(np.float32)
    return slope, (mean_x - slope * mean_i).astype(np.float32)


def place(ptr: np.ndarray) -> np.ndarray:
    """Each sample's place in its block, from 1."""
    return np.arange(1, ptr[-1] + 1) - ptr[:-1][owner(ptr)]


def line_at(slope: np.ndarray, intercept: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    b = owner(ptr)
    return slope.astype(float)[b] * place(ptr) + intercept.astype(float)[b]


def normality(x: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Correlation of each block's cumulative distribution of standardised values with the normal one; 0 without variance."""
    n, b = np.diff(ptr), owner(ptr)
    mean = totals(x, ptr) / np.maximum(n, 1)
    spread = np.sqrt(totals((x - mean[b]) ** 2, ptr) / np.maximum(n, 1))
    z = (x - mean[b]) / np.where(spread > 0, spread, 1)[b]
    k = np.maximum(((z + LEAST_Z) * STEP).astype(np.int64), 0)
    inside = k < CLASSES
    counts = np.bincount(b[inside] * CLASSES + k[inside], minlength=len(n) * CLASSES).reshape(-1, CLASSES)
    cdf = counts.cumsum(axis=1) / np.maximum(n, 1)[:, None]
    c, normal = cdf - cdf.mean(axis=1, keepdims=True), NORMAL - NORMAL.mean()
    below = np.sqrt((c * c).sum(axis=1) * (normal * normal).sum())
    return np.where((spread > 0) & (below > 0), (c * normal).sum(axis=1) / np.where(below > 0, below, 1), 0.0)


def decoded(levelled: np.ndarray, trend: np.ndarray, scale: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """What a reader gets back of blocks without their trend, divided by their scales and rounded."""
    s = scale.astype(np.float32).astype(float)[owner(ptr)]
    back = np.where(s > 1, round_away(round_away(levelled / s) * s), levelled)
    return round_away(back + trend)


def residuals(x: np.ndarray, back: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Mean of |(x - back) / x| over each block's samples other than 0; 0 without any."""
    there = x != 0
    error = np.where(there, np.abs((x - back) / np.where(there, x, 1)), 0.0)
    n = totals(there.astype(float), ptr)
    return np.where(n > 0, totals(error, ptr) / np.maximum(n, 1), 0.0)


@dataclass
class Plan:
    """How each block is encoded, and the residual ratio that follows."""

    slope: np.ndarray
    intercept: np.ndarray
    scale: np.ndarray
    normality: np.ndarray
    residual: np.ndarray


def for_residual(x: np.ndarray, ptr: np.ndarray, goal: float, detrend: bool = False, least_normality: float | None = 0.5, tolerance: float = 0.005, rounds: int = ROUNDS) -> Plan:
    """Each block's greatest scale found whose residual ratio is the goal at most.

    All blocks halve their own bracket in each round. A bracket begins at 1 and where scales no longer matter, and
    keeps its lower end under the goal; a block is done within the tolerance below the goal. Blocks less normal than
    least_normality, and such as no scale over 1 keeps under the goal, stay lossless.
    """
    x = x.astype(float)
    zero = np.zeros(len(ptr) - 1, np.float32)
    slope, intercept = lines(x, ptr) if detrend else (zero, zero)
    trend = line_at(slope, intercept, ptr)
    levelled = round_away(x - trend)
    normal = normality(levelled, ptr)
    low = np.ones(len(ptr) - 1, np.float32)
    ratio = residuals(x, decoded(levelled, trend, low, ptr), ptr)
    peak = np.zeros(len(ptr) - 1)
    np.maximum.at(peak, owner(ptr), np.abs(levelled))
    high = (2 * peak + 2).astype(np.float32)
    able = np.ones(len(low), bool) if least_normality is None else normal >= least_normality
    for _ in range(rounds):
        open_ = able & (ratio < goal - tolerance) & (high - low > 0.005)
        if not open_.any():
            break
        middle = np.where(open_, (low + high) / 2, low).astype(np.float32)
        tried = residuals(x, decoded(levelled, trend, middle, ptr), ptr)
        under = tried <= goal
        ratio = np.where(open_ & under, tried, ratio)
        low = np.where(open_ & under, middle, low)
        high = np.where(open_ & ~under, middle, high)
    return Plan(slope, intercept, low, normal, ratio)


def encode_block(t: int, x: np.ndarray, gap: bool = False, scale: float = 1.0, slope: float = 0.0, intercept: float = 0.0) -> bytes:
    """A block with its trend taken off and its scale applied."""
    scale, slope, intercept = (float(np.float32(v)) for v in (scale, slope, intercept))
    line = slope * np.arange(1, len(x) + 1) + intercept
    levelled = round_away(np.asarray(x, float) - line)
    return encode_mef3(t, (round_away(levelled / scale) if scale > 1 else levelled).astype(np.int64), gap, scale, slope, intercept)


def encode_for_ratio(t: int, x: np.ndarray, goal: float, gap: bool = False, tolerance: float = 0.005, rounds: int = ROUNDS) -> tuple[bytes, float]:
    """A block of the goal's size in relation to four bytes a sample, within the tolerance, if a scale gives that; lossless if that is small enough. Also its scale."""
    scale, size = 1.0, max(4 * len(x), 1)
    block = encode_block(t, x, gap)
    for _ in range(rounds):
        ratio = len(block) / size
        following = float(np.float32(scale * ratio / goal))
        if goal - tolerance <= ratio <= goal + tolerance or (scale == 1 and ratio <= goal) or following <= 1 or abs(following - scale) <= 1e-6:
            break
        scale = following
        block = encode_block(t, x, gap, scale)
    return block, scale
