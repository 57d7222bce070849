"""Every chart template against a plain walk: what is known at each bar, tested bar by bar, over random walks and drawn charts."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_charts import walked
from tickloom.operators import charts

SYMBOLS, BARS = 40, 520
SCHEMA = "symbol long, t long, open double, high double, low double, close double, volume double"


def rows_of(symbol, close, rng):
    n = len(close)
    open_ = np.concatenate([close[:1], close[:-1]])
    high = np.round(np.maximum(open_, close) * (1 + rng.random(n) / 150), 2)
    low = np.round(np.minimum(open_, close) * (1 - rng.random(n) / 150), 2)
    return [(symbol, t, float(open_[t]), float(high[t]), float(low[t]), float(close[t]), 1.0) for t in range(n)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    out = []
    for s in range(SYMBOLS):
        steps = rng.normal(0.0003 * (s % 3), 0.008 + 0.0015 * (s % 8), BARS)
        swing = 0.01 * np.sin(np.arange(BARS) * 2 * math.pi / (12 + 3 * (s % 9))) * (s % 2)
        out += rows_of(s, np.round(100 * np.exp(np.cumsum(steps + swing)), 2), rng)
    return out


def smooth(x, n):
    """Wilder's mean of values from the second one on."""
    out = np.full(len(x), np.nan)
    if len(x) > n:
        out[n] = np.mean(x[1 : n + 1])
        for t in range(n + 1, len(x)):
            out[t] = out[t - 1] + (x[t] - out[t - 1]) / n
    return out


def fit(xs, ys):
    if len(xs) == 2:
        slope = (ys[1] - ys[0]) / (xs[1] - xs[0])
        return ys[0] - slope * xs[0], slope, 0.0
    slope, level = np.polyfit(np.array(xs, float), np.array(ys, float), 1)
    return level, slope, max(abs(y - level - slope * x) for x, y in zip(xs, ys, strict=True))


def close_to(x, low, high, slack=0.03):
    return low - slack <= x <= high + slack


class View:
    """Points in bullish orientation, oldest first, and what templates ask of the bars. Yields name pairs with line, height, stop, start, target, expiry, variant."""

    def __init__(self, x, y, scale, close, low, a, b, stacked, real):
        self.x, self.y, self.scale, self.c, self.l, self.a, self.b, self.stacked, self.real = x, y, scale, close, low, a, b, stacked, real
        self.k, self.least, self.most, self.wide = charts.SCALES[scale]

    def last(self, n):
        return (self.x[-n:], self.y[-n:]) if len(self.x) >= n else (None, None)

    def found(self):
        for n in (2, 3, 4, 5, 6):
            x, y = self.last(n)
            if x:
                yield from getattr(self, f"of{n}")(x, y)

    def of2(self, x, y):
        fall = y[0] - y[1]
        if x[1] > x[0] and fall >= 2 * self.k * self.a[x[1]] and fall / (x[1] - x[0]) >= 0.5 * self.a[x[1]]:
            yield "V-bottom|V-top (spike)", (y[1] + 0.618 * fall, 0), fall, y[1], x[0], y[0], x[1] + max(x[1] - x[0], 5), ""

    def of3(self, x, y):
        depth = y[1] - y[2]
        if depth > 1e-12 and 0.12 <= depth / abs(y[1]) <= 0.5 and y[0] < y[1] - 0.3 * depth and 12 <= x[2] - x[1] <= 200:
            inside = self.c[x[1] : x[2] + 1]
            if sum(inside <= y[2] + depth / 3) >= 0.45 * len(inside):
                yield "Cup (no handle) breakout|Inverted cup breakdown", (y[1], 0), depth, y[2], x[1], None, x[1] + 4 * (x[2] - x[1]), ""
        rise = y[1] - y[0]
        if rise > 1.5 * self.k * self.a[x[1]] and y[2] > y[0] and close_to((y[1] - y[2]) / rise, 0.382, 0.786):
            yield "Wave-3 / ABC breakout up|Wave-3 / ABC breakdown", (y[1], 0), rise, y[2], x[0], y[2] + rise, None, ""

    def of4(self, x, y):
        apart, height = x[3] - x[1], y[2] - min(y[1], y[3])
        if height > 0 and self.least <= apart <= self.most and y[0] > y[2] and abs(y[1] - y[3]) <= 0.2 * height:
            reach = max(2, apart // 2)
            shape = []
            for j in (1, 3):
                near = self.l[max(0, x[j] - reach) : x[j] + reach + 1]
                shape.append("Adam" if sum(near <= y[j] + 0.25 * height) <= max(3, 0.12 * apart) else "Eve")
            yield "Double bottom|Double top", (y[2], 0), height, min(y[1], y[3]), x[1], None, None, " & ".join(shape)
        depth = min(y[0], y[2]) - y[1]
        long, short = x[2] - x[0], x[3] - x[2]
        if depth > 0 and 0.12 <= depth / abs(y[0]) <= 0.5 and abs(y[2] - y[0]) <= 0.15 * depth and 25 <= long <= 325 and 3 <= short <= max(5, 0.4 * long) and y[2] - y[3] <= 0.4 * depth and y[3] >= y[1] + 0.5 * depth:
            inside = self.c[x[0] : x[2] + 1]
            if sum(inside <= y[1] + depth / 3) >= 0.4 * len(inside):
                yield "Cup & handle|Inverse cup & handle", (y[2], 0), depth, y[3], x[0], None, None, ""
        if y[2] < y[0] and y[3] > y[1] and abs(y[3] - y[1]) > 0.2 * (y[2] - min(y[1], y[3])):
            yield "Dow trend reversal up|Dow trend reversal down", (y[2], 0), y[2] - y[3], y[3], x[0], None, None, ""
        first, back, second = y[0] - y[1], y[2] - y[1], y[2] - y[3]
        if min(first, back, second) > 0 and y[3] < y[1] and close_to(back / first, 0.382, 0.886) and close_to(second / first, 0.9, 1.1, 0) and close_to(second / back, 1.13, 2.618):
            yield "Bullish AB=CD|Bearish AB=CD", (y[3] + self.b[x[3]], 0), y[0] - y[3], y[3] - 0.5 * self.b[x[3]], x[0], y[3] + 0.618 * (y[0] - y[3]), x[3] + 10, "AB=CD"
        if y[2] < y[0] and x[2] - x[0] >= self.least:
            level, slope, _ = fit([x[0], x[2]], [y[0], y[2]])
            if not any(self.c[t] > level + slope * t + 0.25 * self.a[x[3]] for t in range(x[0] + 1, x[3] + 1)):
                yield "Downtrend-line breakout|Uptrend-line breakdown", (level, slope), level + slope * x[3] - y[3], y[3], x[0], None, None, ""

    def of5(self, x, y):
        lengths = [y[1] - y[0], y[1] - y[2], y[3] - y[2], y[3] - y[4]]
        line = (y[4] + self.b[x[4]], 0)
        if min(lengths) > 0:
            xa, ab, bc, cd = lengths
            for name, ratios in charts.HARMONICS.items():
                if all(close_to(v, *r, s) for v, r, s in zip((ab / xa, bc / ab, cd / bc, (y[1] - y[4]) / xa), ratios, (0.03, 0.03, 0.03, 0.02), strict=True)):
                    yield f"Bullish {name}|Bearish {name}", line, y[1] - y[4], min(y[4], y[0]) - 0.5 * self.b[x[4]], x[0], y[4] + 0.618 * (y[1] - y[4]), x[4] + 10, name
            xc = y[3] - y[0]
            if xc > 0 and close_to(ab / xa, 0.382, 0.618) and close_to(xc / xa, 1.13, 1.414) and close_to(cd / xc, 0.72, 0.85):
                yield "Bullish Cypher|Bearish Cypher", line, cd, y[0], x[0], y[4] + 0.618 * cd, x[4] + 10, "Cypher"
        if y[2] < y[0] and y[3] < y[1] and y[4] < y[2] and y[3] > y[0]:
            low13, high24, aim = (fit([x[i], x[j]], [y[i], y[j]]) for i, j in ((0, 2), (1, 3), (0, 3)))
            if high24[1] < low13[1] and y[4] < low13[0] + low13[1] * x[4]:
                yield "Bullish Wolfe wave|Bearish Wolfe wave", low13[:2], abs(y[3] - y[4]), y[4] - 0.5 * self.b[x[4]], x[0], aim[0] + aim[1] * (x[4] + 0.5 * (x[4] - x[0])), x[4] + 15, ""
        if y[2] < y[0] and y[3] > y[1] and y[4] > y[2] and abs(y[4] - y[0]) <= 0.35 * (y[3] - y[2]):
            yield "Bullish Quasimodo|Bearish Quasimodo", line, y[3] - y[4], y[2], x[0], y[3], x[4] + 15, ""

    def of6(self, x, y):
        tops, bottoms = y[0::2], y[1::2]
        level, height = max(tops[1:]), max(tops[1:]) - min(bottoms)
        if height > 0 and self.wide <= x[5] - x[1] <= 1.5 * self.most and tops[0] > level and max(bottoms) - min(bottoms) <= 0.2 * height and abs(tops[1] - tops[2]) <= 0.4 * height:
            yield "Triple bottom|Triple top", (level, 0), height, min(bottoms), x[1], None, None, ""
        a, s, _ = fit([x[2], x[4]], [y[2], y[4]])
        neck = lambda t: a + s * t
        h = neck(x[3]) - y[3]
        if h > 0 and y[3] < min(y[1], y[5]) - 0.1 * h and min(neck(x[1]) - y[1], neck(x[5]) - y[5]) >= 0.3 * h and abs(y[1] - y[5]) <= 0.6 * h and abs(y[2] - y[4]) <= 0.6 * h and 0.33 <= (x[3] - x[1]) / (x[5] - x[3]) <= 3 and self.wide <= x[5] - x[1] <= 1.5 * self.most and y[0] > level:
            yield "Inverse head & shoulders|Head & shoulders top", (a, s), h, y[5], x[1], None, None, ""
        if tops == sorted(tops, reverse=True) and bottoms == sorted(bottoms, reverse=True) and len({*tops}) == len({*bottoms}) == 3:
            drives = [(y[2] - y[3]) / (y[2] - y[1]), (y[4] - y[5]) / (y[4] - y[3])]
            backs = [(y[2] - y[1]) / (y[0] - y[1]), (y[4] - y[3]) / (y[2] - y[3])]
            if all(close_to(v, 1.13, 1.9) for v in drives) and all(close_to(v, 0.382, 0.786) for v in backs):
                yield "Three drives bottom|Three drives top", (y[4], 0), y[0] - y[5], y[5], x[0], y[5] + 0.618 * (y[0] - y[5]), None, ""
        w1, w3, w5 = y[0] - y[1], y[2] - y[3], y[4] - y[5]
        if y[2] < y[0] and y[3] < y[1] and y[4] < y[1] and y[5] < y[3] and w3 >= min(w1, w5):
            yield "Elliott 5-wave decline complete|Elliott 5-wave advance complete", (y[5] + 0.5 * w5, 0), y[0] - y[5], y[5], x[0], y[5] + 0.382 * (y[0] - y[5]), x[5] + 30, ""
        if self.real and self.scale == "minor" and self.stacked[x[5]]:
            for n in (6, 4):
                tops, bottoms = y[-n::2], y[-n + 1 :: 2]
                falls = [(t - b) / t for t, b in zip(tops, bottoms, strict=True)]
                if all(b <= 0.8 * a for a, b in zip(falls, falls[1:], strict=False)) and falls[-1] <= 0.12 and 0.08 <= falls[0] <= 0.35 and max(tops[1:]) <= 1.03 * tops[0] and all(b > a for a, b in zip(bottoms, bottoms[1:], strict=False)):
                    yield "VCP breakout|-", (tops[-1], 0), tops[0] - bottoms[0], bottoms[-1], x[-n], None, None, f"{n // 2} contractions"
                    break


def of_two_lines(x, y, kinds, least, most, a, close):
    """Two lines in real prices: name, upper and lower line, height, start, expiry, variant."""
    for n in (6, 5, 4):
        if len(x) < n:
            continue
        xs, ys, ks = x[-n:], y[-n:], kinds[-n:]
        side = lambda kind: ([v for v, k in zip(xs, ks, strict=True) if k == kind], [v for v, k in zip(ys, ks, strict=True) if k == kind])  # noqa: B023, E731
        (ua, ub, ue), (la, lb, le) = fit(*side(1)), fit(*side(-1))
        width = xs[-1] - xs[0]
        gap = [ua + ub * t - la - lb * t for t in (xs[0], xs[-1])]
        if not least <= width <= most or max(xs[1] - xs[0], xs[-1] - xs[-2]) > 0.45 * width or min(gap) <= 0:
            continue
        slack = max(0.5 * a[xs[-1]], 0.12 * max(gap))
        if max(ue, le) > slack or sum(close[t] > ua + ub * t + slack or close[t] < la + lb * t - slack for t in range(xs[0], xs[-1] + 1)) > 1:
            continue
        word = lambda s: "flat" if abs(s * width / max(gap)) < 0.2 else "up" if s > 0 else "down"  # noqa: B023, E731
        form = "conv" if gap[1] / gap[0] < 0.8 else "div" if gap[1] / gap[0] > 1.25 else "par"
        name = charts.TWO_LINES.get((word(ub), word(lb), form))
        if name is None or (n == 4 and name not in charts.FOUR_POINTS):
            continue
        end = int((ua - la) / (lb - ub)) if form == "conv" and lb > ub else xs[-1] + width
        return name, (ua, ub), (la, lb), max(gap), xs[0], end, f"{n} pivots"
    return None


def of_diamond(x, y, kinds, least, most):
    if len(x) < 6:
        return None
    top, bottom = ([(a, b) for a, b, k in zip(x[-6:], y[-6:], kinds[-6:], strict=True) if k == s] for s in (1, -1))
    span = top[1][1] - bottom[1][1]
    middle = (top[1][0] + bottom[1][0]) / 2
    peak = top[1][1] > max(top[0][1], top[2][1]) and bottom[1][1] < min(bottom[0][1], bottom[2][1])
    if not peak or not least <= x[-1] - x[-6] <= most or max(abs(top[0][1] - top[2][1]), abs(bottom[0][1] - bottom[2][1])) > 0.5 * span or min(top[0][1] - bottom[0][1], top[2][1] - bottom[2][1]) < 0.25 * span:
        return None
    if not 0.5 <= (middle - x[-6]) / max(x[-1] - middle, 1) <= 2:
        return None
    lines = [fit([p[1][0], p[2][0]], [p[1][1], p[2][1]])[:2] for p in (top, bottom)]
    return "Diamond", *lines, span, x[-6], x[-1] + x[-1] - x[-6], ""


def expected(rows):
    out = {}
    for symbol in sorted({r[0] for r in rows}):
        own = [r for r in rows if r[0] == symbol]
        high, low, close = (np.array([r[j] for r in own]) for j in (3, 4, 5))
        n = len(own)
        before = np.concatenate([[np.nan], close[:-1]])
        tr = np.fmax(high - low, np.fmax(abs(high - before), abs(low - before)))
        b = smooth(tr, 14)
        a = smooth(tr, 50)
        a = np.where(np.isnan(a), b, a)
        mean = {k: np.array([round(close[t - k + 1 : t + 1].mean(), 8) if t >= k - 1 else np.nan for t in range(n)]) for k in (50, 150, 200)}
        stacked = (close > mean[50]) & (mean[50] > mean[150]) & (mean[150] > mean[200])
        for scale, (k, least, most, _) in charts.SCALES.items():
            need = charts.threshold(k, a)
            now = walked(high, low, np.where(np.isnan(need), np.inf, need))
            lives = []  # points known, whether the newest runs, first and last bar
            for t in range(n):
                points = now[t][2]
                if points and (t == 0 or len(points) > len(now[t - 1][2])):
                    lives.append((points, False, t, t))
                elif points:
                    kept = [i for i, s in enumerate(lives) if not s[1]][-1]
                    lives[kept] = (*lives[kept][:3], t)
                if t and now[t - 1][0] and now[t - 1][1] > now[t - 1][2][-1]:
                    known = [*now[t - 1][2], now[t - 1][1]]
                    if lives and lives[-1][1] and lives[-1][0] == known and lives[-1][3] == t - 1:
                        lives[-1] = (known, True, lives[-1][2], t)
                    elif lives and not lives[-1][1] and len(lives) > 1 and lives[-2][1] and lives[-2][0] == known and lives[-2][3] == t - 1:
                        lives[-2] = (known, True, lives[-2][2], t)
                    else:
                        at = len(lives) - (not lives[-1][1] and lives[-1][2] == t)
                        lives.insert(at, (known, True, t, t))
            for points, running, first, until in lives:
                newest = points[-1]
                kind = now[first - 1][0] if running else -now[first][0]
                x = points[-6:]
                kinds = [kind * (-1) ** (len(x) - 1 - j) for j in range(len(x))]
                real = [high[v] if s > 0 else low[v] for v, s in zip(x, kinds, strict=True)]
                up = -kind
                view = View(x, [up * v for v in real], scale, up * close, low if up > 0 else -high, a, b, stacked, up > 0)
                found = [(c[0].split("|")[0 if up > 0 else 1], up, (up * c[1][0], up * c[1][1]), c[2], up * c[3], c[4], None if c[5] is None else up * c[5], c[6], c[7], None) for c in view.found()]
                for got in (of_two_lines(x, real, kinds, least, most, a, close), of_diamond(x, real, kinds, least, most)):
                    if got:
                        name, upper, lower, height, start, end, variant = got
                        for way, line, other in ((1, upper, lower), (-1, lower, upper)):
                            if not running or way == up:
                                found.append((f"{name} - {'up' if way > 0 else 'down'} breakout", way, line, height, None, start, None, end, variant, other))
                for name, way, (level, slope), height, stop, start, target, end, variant, other in found:
                    if (symbol, scale, name, start) in out:
                        continue
                    stretch = min([until, newest + max(15, newest - start)] + ([] if end is None else [end]))
                    for t in range(max(first, 1), stretch + 1):
                        line = level + slope * t
                        if way * (close[t] - line) > 0 and not way * (close[t - 1] - (line - slope)) > 0:
                            aim = target if target is not None else line + way * height
                            out[symbol, scale, name, start] = (t, way, line, aim, stop if other is None else other[0] + other[1] * t, variant)
                            break
    return out


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).withColumn("date", F.date_add(F.lit("2015-01-01").cast("date"), F.col("t").cast("int")))


def test_templates_equal_a_walk(spark, rows):
    want = expected(rows)
    got = {(r["symbol"], r["scale"], r["pattern"], r["start"]): (r["t"], r["dir"], r["level"], r["target"], r["stop"], r["variant"]) for r in charts.chart_patterns(frame(spark, rows)).collect()}
    assert set(got) == set(want)
    for k, (t, way, *prices, variant) in want.items():
        g = got[k]
        assert (g[0], g[1], g[5]) == (t, way, variant), (k, g, want[k])
        assert all(abs(x - y) < 1e-4 for x, y in zip(g[2:5], prices, strict=True)), (k, g, want[k])
    seen = {k[2] for k in want}
    assert len(seen) > 45, sorted(seen)


X = 100.0


def corners_of(name):
    """Corners of a bullish drawn chart, from the ratios."""
    leg = lambda ab, bc, ad: [X, X + 40, X + 40 - 40 * ab, X + 40 - 40 * ab + 40 * ab * bc, X + 40 - 40 * ad]
    return {
        "Bullish Gartley": leg(0.618, 0.6, 0.786), "Bullish Bat": leg(0.45, 0.6, 0.886), "Bullish Butterfly": leg(0.786, 0.6, 1.3), "Bullish Crab": leg(0.5, 0.886, 1.618), "Bullish Deep crab": leg(0.886, 0.6, 1.618),
        "Bullish Cypher": [X, X + 40, X + 20, X + 51, X + 51 - 0.786 * 51], "Bullish AB=CD": [X + 60, X + 20, X + 44, X + 4], "Bullish Wolfe wave": [X, X + 24, X - 12, X + 6, X - 26], "Bullish Quasimodo": [X, X + 24, X - 20, X + 36, X + 2],
        "Elliott 5-wave decline complete": [X + 90, X + 60, X + 75, X + 20, X + 40, X + 8], "Three drives bottom": [X + 60, X + 30, X + 48, X + 22, X + 37, X + 13], "Downtrend-line breakout": [X + 80, X + 30, X + 62, X + 25],
        "Rectangle - up breakout": [X, X + 30, X, X + 30, X, X + 30, X], "Ascending triangle - up breakout": [X - 6, X + 36, X + 7, X + 36, X + 14, X + 36, X + 21], "Diamond - up breakout": [X + 20, X + 5, X + 35, X - 15, X + 20, X + 5],
        "Cup & handle": [X + 40, X + 12, X + 17, X + 12, X + 17, X + 12, X + 40, X + 32],
    }[name]


DRAWN = ["Bullish Gartley", "Bullish Bat", "Bullish Butterfly", "Bullish Crab", "Bullish Deep crab", "Bullish Cypher", "Bullish AB=CD", "Bullish Wolfe wave", "Bullish Quasimodo", "Elliott 5-wave decline complete", "Three drives bottom", "Downtrend-line breakout", "Rectangle - up breakout", "Ascending triangle - up breakout", "Diamond - up breakout"]


def test_drawn_charts(spark):
    """Each of these charts, and the mirrored one, shows its pattern; the walk says so too."""
    rows = []
    for s, name in enumerate(DRAWN):
        corners = corners_of(name)
        corners = [corners[0] + (30 if corners[0] < corners[1] else -30), *corners, corners[-1] + 70]
        path = np.concatenate([np.linspace(a, b, 16, endpoint=False) for a, b in zip(corners, corners[1:], strict=False)])
        for mirror in (0, 1):
            close = np.round(path if not mirror else 400 - path, 2)
            rows += [(2 * s + mirror, t, float(c), float(c + 0.2), float(c - 0.2), float(c), 1.0) for t, c in enumerate(close)]
    got = {}
    for r in charts.chart_patterns(frame(spark, rows)).collect():
        got.setdefault(r["symbol"], set()).add(r["pattern"])
    want = {}
    for symbol, _, name, _ in expected(rows):
        want.setdefault(symbol, set()).add(name)
    assert got == want
    mirrored = {n: n.replace("Bullish", "Bearish") for n in DRAWN} | {"Elliott 5-wave decline complete": "Elliott 5-wave advance complete", "Three drives bottom": "Three drives top", "Downtrend-line breakout": "Uptrend-line breakdown", "Ascending triangle - up breakout": "Descending triangle - down breakout"}
    missing = [n for s, n in enumerate(DRAWN) if n not in got.get(2 * s, ())] + [n for s, n in enumerate(DRAWN) if mirrored[n].replace("Rectangle - up", "Rectangle - down").replace("Diamond - up", "Diamond - down") not in got.get(2 * s + 1, ())]
    assert not missing
