"""The cycle indicators against a loop over single bars and single numbers, written from the published method."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import hilbert as H


def loop(price, begins):
    """period, in-phase, quadrature, phase, mean and the smoothed price of each bar, by plain lists."""
    w = [None] * 3 + [(4 * price[t] + 3 * price[t - 1] + 2 * price[t - 2] + price[t - 3]) / 10 for t in range(3, len(price))]
    series = {k: {} for k in ("s", "d", "q", "i")}

    def transform(k, t, gain):
        x = series[k]
        return (0.0962 * x.get(t, 0) + 0.5769 * x.get(t - 2, 0) - 0.5769 * x.get(t - 4, 0) - 0.0962 * x.get(t - 6, 0)) * gain

    out, period, smooth, i2, q2, re, im = {}, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0
    for t in range(begins, len(price)):
        gain = 0.075 * period + 0.54
        series["s"][t] = w[t]
        series["d"][t] = transform("s", t, gain)
        series["q"][t] = transform("d", t, gain)
        series["i"][t] = series["d"].get(t - 3, 0)
        ni, nq = 0.2 * (series["i"][t] - transform("q", t, gain)) + 0.8 * i2, 0.2 * (series["q"][t] + transform("i", t, gain)) + 0.8 * q2
        re, im = 0.2 * (ni * i2 + nq * q2) + 0.8 * re, 0.2 * (ni * q2 - nq * i2) + 0.8 * im
        i2, q2 = ni, nq
        p = 360 / math.degrees(math.atan(im / re)) if im != 0 and re != 0 else period
        if p > 1.5 * period:
            p = 1.5 * period
        if p < 0.67 * period:
            p = 0.67 * period
        p = min(max(p, 6), 50)
        period = 0.2 * p + 0.8 * period
        smooth = 0.33 * period + 0.67 * smooth
        out[t] = (smooth, series["i"][t], series["q"][t])
    return w, out


def long_loop(price):
    w, found = loop(price, 37)
    out, phase, sine, lead, days, means = {}, 0.0, 0.0, 0.0, 0, [0.0, 0.0, 0.0]
    for t, (period, _, _) in found.items():
        n = int(period + 0.5)
        real = sum(math.sin(math.radians(360 * j / n)) * (w[t - j] if t - j >= 37 else 0) for j in range(n))
        imag = sum(math.cos(math.radians(360 * j / n)) * (w[t - j] if t - j >= 37 else 0) for j in range(n))
        was, was_sine, was_lead = phase, sine, lead
        phase = math.degrees(math.atan(real / imag)) if imag else phase + (90 if real > 0 else -90 if real < 0 else 0)
        phase += 90 + 360 / period + (180 if imag < 0 else 0)
        phase -= 360 if phase > 315 else 0
        sine, lead = math.sin(math.radians(phase)), math.sin(math.radians(phase + 45))
        mean = sum(price[t - j] for j in range(n)) / n if n else 0.0
        line = (4 * mean + 3 * means[0] + 2 * means[1] + means[2]) / 10
        means = [mean, *means[:2]]
        trend = 1
        if (sine > lead and was_sine <= was_lead) or (sine < lead and was_sine >= was_lead):
            days, trend = 0, 0
        days += 1
        if days < 0.5 * period:
            trend = 0
        if 0.67 * 360 / period < phase - was < 1.5 * 360 / period:
            trend = 0
        if line and abs((w[t] - line) / line) >= 0.015:
            trend = 1
        out[t] = (phase, sine, lead, line, trend)
    return out


def walks():
    rng = np.random.default_rng(3)
    t = np.arange(400)
    return [
        np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.02, 400))), 2),
        np.round(100 + 10 * np.sin(2 * np.pi * t / 20), 2),
        np.round(50 + 0.1 * t + 3 * np.sin(2 * np.pi * t / 33) + rng.normal(0, 0.3, 400), 2),
        np.round(80 * np.exp(np.cumsum(rng.normal(0, 0.01, 150))), 2),
        np.array([10.0] * 90),
        np.array([5.0, 6.0, 7.0]),
    ]


def test_equals_loops(spark):
    prices = walks()
    rows = [(s, t, float(c)) for s, p in enumerate(prices) for t, c in enumerate(p)]
    df = spark.createDataFrame(rows, "symbol long, t long, close double").withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t").cast("int")))
    for groups in (1, 3):
        got = H.cycles(df, groups).toPandas().sort_values(["symbol", "date"])
        assert len(got) == len(rows)
        for s, p in enumerate(prices):
            g = got[got["symbol"] == s].reset_index(drop=True)
            p = p.tolist()
            _, short = loop(p, 12)
            mean = follow = before = 0.0
            for t, (period, inner, quad) in short.items():
                angle = math.degrees(math.atan(quad / inner)) if inner else 0.0
                turn = max(before - angle, 1)
                before = angle
                weight = max(0.5 / turn, 0.05)
                mean = weight * p[t] + (1 - weight) * mean
                follow = weight / 2 * mean + (1 - weight / 2) * follow
                if t >= 32:
                    assert g.loc[t, H.SHORT].tolist() == pytest.approx([period, inner, quad, mean, follow], rel=1e-7, abs=1e-7)
            for t, want in long_loop(p).items():
                if t >= 63 and s != 4:  # of a flat line the parts are noise
                    assert g.loc[t, H.LONG].tolist() == pytest.approx([float(v) for v in want], rel=1e-6, abs=1e-6)
            assert g.loc[: min(31, len(g) - 1), H.SHORT].isna().all().all() and g.loc[: min(62, len(g) - 1), H.LONG].isna().all().all()


def test_finds_the_period(spark):
    t = np.arange(300)
    for length in (12, 20, 30):
        found = H.short_functions((100 + 5 * np.sin(2 * np.pi * t / length))[:, None])["ta_HT_DCPERIOD"][-50:]
        assert abs(found.mean() - length) < 1.5


def test_empty(spark):
    df = spark.createDataFrame([], "symbol long, date date, t long, close double")
    assert H.cycles(df).count() == 0
