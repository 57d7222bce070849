"""Swing points and chart patterns against a bar-by-bar walk and templates read off drawn charts."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import charts


def walked(high, low, threshold):
    """What is known at each bar, told one bar after the other: (side of the newest extreme, its bar, confirmed points)."""
    up = None
    points, top, bottom = [], 0, 0
    out = []
    for t in range(len(high)):
        if up is None:
            top = t if high[t] > high[top] else top
            bottom = t if low[t] < low[bottom] else bottom
            if high[top] - low[bottom] >= threshold[t]:
                up = top > bottom
                points.append(bottom if up else top)
        elif up:
            if high[t] > high[top]:
                top = t
            elif high[top] - low[t] >= threshold[t]:
                points.append(top)
                up, bottom = False, t
        elif low[t] < low[bottom]:
            bottom = t
        elif high[t] - low[bottom] >= threshold[t]:
            points.append(bottom)
            up, top = True, t
        out.append((0, -1, []) if up is None else (1 if up else -1, top if up else bottom, list(points)))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_known_points(seed):
    rng = np.random.default_rng(seed)
    close = 100 + np.cumsum(rng.integers(-3, 4, 700)).astype(float)
    high, low = close + rng.integers(0, 3, 700), close - rng.integers(0, 3, 700)
    threshold = np.where(np.arange(700) < 14, np.nan, rng.integers(4, 9, 700).astype(float))
    now = walked(high, low, threshold)
    want = set()
    for t, (_, _, points) in enumerate(now):  # confirmed points alone, from the bar that confirms them
        if points:
            want.add((t, tuple(points[:-7:-1])))
    for t in range(1, 700):  # with the extreme as it was a bar before
        side, x, points = now[t - 1]
        if side and x > points[-1]:
            want.add((t, (x, *points[:-6:-1])))
    got = [(t, tuple(at)) for _, first, last, at, _ in charts.known_points(high, low, threshold) for t in range(first, last + 1)]
    assert set(got) == want  # at the bar that confirms an extreme both stretches hold it
    for side, _, _, at, _ in charts.known_points(high, low, threshold):
        assert all((high[a] > low[b]) if side * (-1) ** j > 0 else (low[a] < high[b]) for j, (a, b) in enumerate(zip(at, at[1:], strict=False)))


def drawn(spark, corners):
    close = np.concatenate([np.linspace(a, b, 20, endpoint=False) for a, b in zip(corners, corners[1:], strict=False)])
    rows = [("A", i, float(c - 0.1), float(c + 0.5), float(c - 0.5), float(c), 1000.0) for i, c in enumerate(close)]
    df = spark.createDataFrame(rows, "symbol string, t int, open double, high double, low double, close double, volume double")
    return df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("t")))


@pytest.mark.parametrize(("corners", "name", "side"), [
    ([100, 130, 100, 112, 100.5, 125, 120], "Double bottom", 1),
    ([130, 100, 130, 118, 129.5, 105, 110], "Double top", -1),
    ([100, 140, 105, 118, 106, 117, 105, 135, 130], "Triple bottom", 1),
    ([100, 140, 110, 120, 100, 120, 110, 135, 130], "Inverse head & shoulders", 1),
    ([130, 90, 120, 110, 130, 110, 120, 95, 100], "Head & shoulders top", -1),
])
def test_drawn(spark, corners, name, side):
    got = charts.chart_patterns(drawn(spark, corners)).collect()
    assert (name, side) in {(r["pattern"], r["dir"]) for r in got}
    assert len({(r["pattern"], r["scale"], r["start"]) for r in got}) == len(got)


def test_empty(spark):
    assert charts.chart_patterns(drawn(spark, [100, 101]).filter("t < 0")).count() == 0
    assert charts.pipes_and_horns(drawn(spark, [100, 101]).filter("t < 0")).count() == 0
