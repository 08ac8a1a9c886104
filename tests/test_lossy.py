"""Lossy blocks: a search block by block in plain steps, and what a reader gets back."""

import math

import numpy as np
import pytest

from sigloom.functions import lossy, red
from sigloom.operators import wire


def blocks(seed=0):
    rng = np.random.default_rng(seed)
    out = [np.rint(rng.normal(0, 400, n)) for n in (2000, 500, 64)] + [np.rint(rng.normal(0, 90, 800) + 3 * np.arange(800) + 5000)]
    return out + [np.zeros(40), np.full(30, 7.0), np.asarray([5.0]), np.tile([0.0, 1.0], 50), np.where(rng.random(400) < 0.02, 30000.0, 3.0), np.asarray([-2147480000.0, 2147480000.0])]


def side_by_side(xs):
    return np.concatenate(xs), np.r_[0, np.cumsum([len(x) for x in xs])]


def half_away(v):
    return math.floor(v + 0.5) if v >= 0 else -math.floor(-v + 0.5)


def test_halves_go_away_from_zero():
    assert red.round_away(np.asarray([0.5, -0.5, 1.5, -1.5, 2.4, -2.6, 0.0])).tolist() == [1, -1, 2, -2, 2, -3, 0]


def test_lines_and_normality_are_those_of_each_block():
    xs = blocks()
    x, ptr = side_by_side(xs)
    slope, intercept = lossy.lines(x, ptr)
    normal = lossy.normality(x, ptr)
    for k, v in enumerate(xs):
        if len(v) > 1:
            a, b = np.polyfit(np.arange(1, len(v) + 1), v, 1)
            assert abs(slope[k] - a) <= 1e-6 * max(1, abs(a)) and abs(intercept[k] - b) <= 2e-3 * max(1, abs(b))
        if v.std() > 0:
            z = [max(int(((y - v.mean()) / v.std() + 3.1) * 10), 0) for y in v]
            cdf = np.cumsum([z.count(c) for c in range(61)]) / len(v)
            assert abs(normal[k] - np.corrcoef(cdf, lossy.NORMAL)[0, 1]) < 1e-9
        else:
            assert normal[k] == 0
    assert normal[0] > 0.99 and normal[8] < 0.95


@pytest.mark.parametrize("detrend", [False, True])
@pytest.mark.parametrize("goal", [0.01, 0.05, 0.3])
def test_scales_keep_the_goal_and_are_the_greatest(goal, detrend):
    xs = blocks(int(goal * 100))
    x, ptr = side_by_side(xs)
    plan = lossy.for_residual(x, ptr, goal, detrend, None, tolerance=0.0, rounds=60)
    for k, v in enumerate(xs):
        s = float(plan.scale[k])
        block = lossy.encode_block(9, v, scale=s, slope=plan.slope[k], intercept=plan.intercept[k])
        t, back, _ = red.decode_mef3(block, validate=True)
        ratio = lambda b: float(np.mean(np.abs((v - b) / np.where(v == 0, 1, v))[v != 0])) if v.any() else 0.0
        assert t == 9 and abs(ratio(back) - plan.residual[k]) < 1e-12
        assert ratio(back) <= goal or s == 1
        line = float(plan.slope[k]) * np.arange(1, len(v) + 1) + float(plan.intercept[k])
        again = [half_away(half_away(half_away(half_away(a - b) / s) * s) + b) if s > 1 else half_away(half_away(a - b) + b) for a, b in zip(v, line)]
        assert back.tolist() == again
        if 1 < s < np.abs(v).max() and k < 3:  # a noisy block: a scale somewhat greater fails
            more = lossy.decoded(red.round_away(v - line), line, np.asarray([s * 1.3]), np.asarray([0, len(v)]))
            assert ratio(more) > goal
    assert plan.scale[:3].min() > 2


def test_blocks_that_are_not_normal_stay_lossless():
    x, ptr = side_by_side(blocks())
    plan = lossy.for_residual(x, ptr, 0.1, False, 0.95)
    assert plan.scale[0] > 1 and plan.scale[8] == 1 and plan.residual[8] == 0 and (plan.scale[plan.normality < 0.95] == 1).all()


def test_size_goals():
    x = blocks()[0]
    whole = len(lossy.encode_block(0, x)) / (4 * len(x))
    block, scale = lossy.encode_for_ratio(0, x, 0.25)
    assert whole > 0.3 and scale > 1 and abs(len(block) / (4 * len(x)) - 0.25) <= 0.006
    assert lossy.encode_for_ratio(0, x, 0.9)[1] == 1.0 and red.decode_mef3(lossy.encode_for_ratio(0, x, 0.9)[0])[1].tolist() == x.tolist()


def test_blocks_of_a_table(spark):
    xs = [x.astype(int).tolist() for x in blocks()]
    rows = [(k, 1000 * k, x) for k, x in enumerate(xs)] + [(90, 5, []), (91, 6, None)]
    d = spark.createDataFrame(rows, "k long, t long, x array<long>").repartition(3)
    for options in ({}, {"scale": 5.0}, {"residual": 0.05, "detrend": True}, {"ratio": 0.3}):
        coded = wire.to_red(d, "t", "x", **options)
        back = {r["k"]: (r["values"], r["residual"], r["scale"]) for r in wire.from_red(coded).collect()}
        assert back[90] == back[91] == (None, None, None)
        for k, x in enumerate(xs):
            v, (values, residual, scale) = np.asarray(x, float), back[k]
            if not options:
                assert values == x and scale == 1
            ratio = float(np.mean(np.abs((v - values) / np.where(v == 0, 1, v))[v != 0])) if v.any() else 0.0
            assert abs(ratio - residual) < 1e-9 and len(values) == len(x)
            assert "residual" not in options or ratio <= 0.05 or scale == 1
    assert wire.to_red(d.limit(0), "t", "x", residual=0.1).count() == 0
