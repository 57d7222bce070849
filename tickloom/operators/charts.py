"""Chart patterns over swing points, and weekly pipes and horns.

A small kernel walks a symbol's bars from swing to swing and gives the last six swing points as they were known in each stretch of
bars (`tips`). Templates are declared conditions over them, in one orientation: a tip that is a high is mirrored. Some also count
bars between their points (closes in the lower third of a cup, closes beyond a line). The walk gives one row a symbol with its prices
as arrays, in which candidates look up the bars of their points and of their stretch; the first close that crosses the trigger line makes the event.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators import indicators
from tickloom.operators.patterns import emit
from tickloom.operators.tables import rma, rolled

#: Fixed values of each scale: mean true ranges to turn, least and most width, least width of patterns of six points.
SCALES = {"minor": (1.5, 8, 150, 15), "intermediate": (3.0, 15, 300, 25), "major": (6.0, 30, 600, 40)}
POINTS, BLOCK = 6, 64
PRICES = ("closes", "highs", "lows")


def threshold(k: float, a: np.ndarray) -> np.ndarray:
    """k mean true ranges, less what the order of a sum leaves, so that a range of just as much turns in every engine."""
    return np.round(k * a, 6) - 1e-7


def turn(best: float, up: np.ndarray, back: np.ndarray, threshold: np.ndarray) -> tuple[int, np.ndarray]:
    """Of the bars after an extreme: the first that comes back by the threshold and is no new extreme (their number if none), new extremes."""
    n, size = len(up), 64
    while True:
        run = np.maximum.accumulate(np.concatenate(([best], up[:size])))
        new = run[1:] > run[:-1]
        hit = np.flatnonzero(~new & (run[1:] - back[:size] >= threshold[:size]))
        if len(hit) or size >= n:
            end = int(hit[0]) if len(hit) else n
            return end, np.flatnonzero(new[:end])
        size *= 2


@dataclass
class Leg:
    """The swing after a confirmed point: its extremes so far, and the bar that ends it."""

    side: int
    confirmed: int
    extremes: list[int]
    end: int


def legs(high: np.ndarray, low: np.ndarray, threshold: np.ndarray) -> tuple[int, list[Leg]]:
    """The bar of the first swing point and the swings from there; a swing's last extreme is the next point, confirmed at its end."""
    threshold = np.where(np.isnan(threshold), np.inf, threshold)
    wide = np.flatnonzero(np.maximum.accumulate(high) - np.minimum.accumulate(low) >= threshold)
    if not len(wide):
        return -1, []
    t = int(wide[0])
    top, bottom = int(np.argmax(high[: t + 1])), int(np.argmin(low[: t + 1]))
    side, first, at, out = (1, bottom, top, []) if top > bottom else (-1, top, bottom, [])
    while True:
        up, back = (high, low) if side > 0 else (-low, -high)
        n, new = turn(up[at], up[t + 1 :], back[t + 1 :], threshold[t + 1 :])
        out.append(Leg(side, t, [at, *(new + t + 1).tolist()], t + 1 + n))
        t += 1 + n
        if t >= len(high):
            return first, out
        side, at = -side, t


def known_points(high: np.ndarray, low: np.ndarray, threshold: np.ndarray) -> Iterator[tuple[int, int, int, list[int], bool]]:
    """Side of the newest point, first and last bar of the stretch in which it is the newest, the bars of the last points, newest first, and whether it isn't confirmed yet."""
    first, swings = legs(high, low, threshold)
    points, last = [first], len(high) - 1
    for leg in swings:
        yield -leg.side, leg.confirmed, min(leg.end - 1, last), points[: -POINTS - 1 : -1], False
        for x, following in zip(leg.extremes, [*leg.extremes[1:], min(leg.end, last)], strict=True):
            begin = max(x, leg.confirmed) + 1
            if x > points[-1] and following >= begin:
                yield leg.side, begin, following, [x, *points[: -POINTS : -1]], True
        points.append(leg.extremes[-1])


def walks(bars: DataFrame) -> DataFrame:
    """One row a symbol: its dates, closes, highs and lows in order of t, and the last points in each stretch of bars, as arrays (see `tips`)."""
    df = bars.withColumn("tr", F.expr(indicators.COLUMNS["tr"])).select("symbol", "date", "t", "high", "low", "close", "tr")
    many = {n: T.ArrayType(k) for n, k in {"scale": T.StringType(), **dict.fromkeys(("place", "side", "first", "last"), T.LongType()), **dict.fromkeys(("running", "stacked"), T.BooleanType()), "i": T.ArrayType(T.LongType()), **dict.fromkeys("pab", T.ArrayType(T.DoubleType()))}.items()}
    own = {"dates": T.ArrayType(df.schema["date"].dataType), **dict.fromkeys(PRICES, T.ArrayType(T.DoubleType()))}
    schema = T.StructType([df.schema["symbol"], *(T.StructField(n, k) for n, k in (own | many).items())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t")
        high, low, close = (pdf[c].to_numpy(float) for c in ("high", "low", "close"))
        b, a = (rma("tr", n).series(pdf["tr"]) for n in (14, 50))
        a, b = np.where(np.isnan(a), b, a), np.round(b, 8)
        m50, m150, m200 = (np.round(rolled("mean", n, n)(close)[0], 8) for n in (50, 150, 200))
        stack, rows = (close > m50) & (m50 > m150) & (m150 > m200), []
        known = lambda x: [None if v != v else v for v in x.tolist()]
        for scale, (k, *_) in SCALES.items():
            for place, (side, first, last, at, running) in enumerate(known_points(high, low, threshold(k, a))):
                kinds = [side * (-1) ** j for j in range(len(at))]
                prices = [-side * float(high[x] if kind > 0 else low[x]) for x, kind in zip(at, kinds, strict=True)]
                rows.append((scale, place, side, first, last, running, bool(stack[at[0]]), at, prices, known(a[at]), known(b[at])))
        found = [list(x) for x in zip(*rows, strict=True)] or [[]] * len(many)
        return pd.DataFrame([(pdf["symbol"].iat[0], list(pdf["date"]), pdf["close"].tolist(), high.tolist(), low.tolist(), *found)], columns=schema.names)

    return df.groupBy("symbol").applyInPandas(run, schema)


def stretches(walked: DataFrame, *kept: str) -> DataFrame:
    """A row for each stretch of a symbol's walk. What is kept of the walk's arrays begins at bar `zero`, and has all that templates look at."""
    names = [c for c in walked.columns if c not in ("symbol", "dates", *PRICES)]
    df = walked.select("symbol", *kept, F.explode(F.arrays_zip(*names)).alias("x"))
    if not kept:
        return df.select("symbol", "x.*")
    around = "2 + coalesce(get(x.i, 0) - get(x.i, 2), 0)"  # bars looked at beyond the points
    zero, end = f"greatest(0L, get(x.i, size(x.i) - 1) - ({around}))", f"greatest(x.last, get(x.i, 0) + {around})"
    return df.select("symbol", "x.*", F.expr(zero).alias("zero"), *[F.expr(f"slice({c}, CAST({zero} AS int) + 1, CAST({end} - {zero} AS int) + 1)").alias(c) for c in kept])


def tips(bars: DataFrame) -> DataFrame:
    """The last points in each stretch of bars: symbol, scale, place, side, first and last bar, running, stacked, and arrays, newest first.

    i: bars, p: prices times -side, a and b: mean true ranges of 50 and 14 bars. stacked: whether at the newest point the close is above its
    averages of 50, 150 and 200 bars, in that order.
    """
    return stretches(walks(bars))


@dataclass(frozen=True)
class Template:
    """A pattern in bullish orientation over points p0 (newest), p1 ... at bars i0, i1 ...; `line` is the trigger at bar {x}.

    `bull` and `bear` are names, or SQL text of names if `named`. way -1: the close must fall below the line. `counted`: first and last bar and
    a number for each bar between them from its oriented close c and low l; `share` is a condition on their sum n and the bars' number m.
    `pick` ranks templates of which a stretch takes the first one only.
    """

    bull: str
    bear: str
    family: str
    points: int
    when: str
    line: str
    height: str
    stop: str
    start: str
    target: str | None = None
    expires: str | None = None
    way: int = 1
    counted: tuple[str, str, str] | None = None
    share: str = "true"
    variant: str = "''"
    named: bool = False
    pick: int | None = None


def within(x: str, low: float, high: float, slack: float = 0.03) -> str:
    return f"{x} BETWEEN {low - slack!r} AND {high + slack!r}"


def through(j: int, k: int) -> str:
    """The line through points j and k at bar {x}."""
    return f"(p{j} + (p{k} - p{j}) / nullif(i{k} - i{j}, 0) * ({{x}} - i{j}))"


def at(line: str, x: str) -> str:
    return line.replace("{x}", x)


NECK = through(3, 1)
_hs = f"({at(NECK, 'i2')} - p2)"
_low3, _top2 = "least(p4, p2, p0)", "greatest(p3, p1)"
_cup, _rim = "p2 + h / 3", "least(p3, p1)"
_near = "CASE WHEN n {f} <= greatest(3, 0.12 * (i0 - i2)) THEN 'Adam' ELSE 'Eve' END"
_around = lambda j: f"(CASE WHEN abs(t - i{j}) <= greatest(2, (i0 - i2) div 2) AND l <= p{j} + 0.25 * h THEN 1 ELSE 0 END)"
#: How far a leg goes of the leg before it, AB of XA, BC of AB, CD of BC, AD of XA, in each harmonic pattern.
HARMONICS = {
    "Gartley": ((0.55, 0.68), (0.382, 0.886), (1.13, 1.618), (0.72, 0.85)),
    "Bat": ((0.35, 0.55), (0.382, 0.886), (1.618, 2.618), (0.83, 0.93)),
    "Butterfly": ((0.72, 0.85), (0.382, 0.886), (1.618, 2.618), (1.20, 1.618)),
    "Crab": ((0.382, 0.618), (0.382, 0.886), (2.24, 3.618), (1.55, 1.70)),
    "Deep crab": ((0.83, 0.93), (0.382, 0.886), (2.0, 3.618), (1.55, 1.70)),
}
_legs5 = "p3 > p4 AND p3 > p2 AND p1 > p2 AND p1 > p0"


def harmonic(name: str) -> Template:
    ab, bc, cd, ad = HARMONICS[name]
    ratios = [within("(p3 - p2) / nullif(p3 - p4, 0)", *ab), within("(p1 - p2) / nullif(p3 - p2, 0)", *bc), within("(p1 - p0) / nullif(p1 - p2, 0)", *cd), within("(p3 - p0) / nullif(p3 - p4, 0)", *ad, 0.02)]
    return Template(f"Bullish {name}", f"Bearish {name}", "Harmonic", 5, " AND ".join([_legs5, *ratios]), "p0 + b0", "p3 - p0", "least(p0, p4) - 0.5 * b0", "i4", "p0 + 0.618 * (p3 - p0)", "i0 + 10", variant=f"'{name}'")


def contraction(points: int) -> str:
    """Falls from high to low that shrink by a fifth each, under highs that don't rise, over rising lows; in an uptrend."""
    falls = [f"(p{j} - p{j - 1}) / p{j}" for j in range(points - 1, 0, -2)]
    shrink = " AND ".join(f"{b} <= 0.8 * {a}" for a, b in zip(falls, falls[1:], strict=False))
    lows = " AND ".join(f"p{j - 2} > p{j}" for j in range(points - 2, 1, -2))
    highs = ", ".join(f"p{j}" for j in range(points - 3, 0, -2))
    return f"side < 0 AND scale = 'minor' AND stacked AND {shrink} AND {falls[-1]} <= 0.12 AND {falls[0]} BETWEEN 0.08 AND 0.35 AND greatest({highs}, {highs}) <= p{points - 1} * 1.03 AND {lows}"


#: Names, families and limits are fixed values.
TEMPLATES = [
    Template("Double bottom", "Double top", "Double bottom/top", 4, "h > 0 AND i0 - i2 BETWEEN least_width AND most_width AND p3 > p1 AND abs(p2 - p0) <= 0.2 * h", "p1", "p1 - least(p2, p0)", "least(p2, p0)", "i2",
             counted=("i2 - greatest(2, (i0 - i2) div 2)", "i0 + greatest(2, (i0 - i2) div 2)", f"{_around(2)} + 1000000 * {_around(0)}"), variant=f"concat({_near.format(f='% 1000000')}, ' & ', {_near.format(f='div 1000000')})"),
    Template("Triple bottom", "Triple top", "Triple bottom/top", 6, f"h > 0 AND i0 - i4 BETWEEN wider AND most_width * 1.5 AND p5 > {_top2} AND greatest(p4, p2, p0) - {_low3} <= 0.2 * h AND abs(p3 - p1) <= 0.4 * h", _top2, f"{_top2} - {_low3}", _low3, "i4"),
    Template("Inverse head & shoulders", "Head & shoulders top", "Head & shoulders", 6, f"h > 0 AND p2 < least(p4, p0) - 0.1 * h AND {at(NECK, 'i4')} - p4 >= 0.3 * h AND {at(NECK, 'i0')} - p0 >= 0.3 * h AND abs(p4 - p0) <= 0.6 * h AND abs(p1 - p3) <= 0.6 * h AND (i2 - i4) / nullif(i0 - i2, 0) BETWEEN 0.33 AND 3.0 AND i0 - i4 BETWEEN wider AND most_width * 1.5 AND p5 > {_top2}", NECK, _hs, "p0", "i4"),
    Template("Cup & handle", "Inverse cup & handle", "Cup & handle", 4, "h > 0 AND h / abs(p3) BETWEEN 0.12 AND 0.50 AND abs(p1 - p3) <= 0.15 * h AND i1 - i3 BETWEEN 25 AND 325 AND i0 - i1 BETWEEN 3 AND greatest(5, 0.4 * (i1 - i3)) AND p1 - p0 <= 0.4 * h AND p0 >= p2 + 0.5 * h", "p1", f"{_rim} - p2", "p0", "i3",
             counted=("i3", "i1", f"CASE WHEN c <= {_cup} THEN 1 ELSE 0 END"), share="n >= 0.4 * m"),
    Template("Cup (no handle) breakout", "Inverted cup breakdown", "Cup (no handle)", 3, "h > 0 AND h / abs(p1) BETWEEN 0.12 AND 0.50 AND p2 < p1 - 0.3 * h AND i0 - i1 BETWEEN 12 AND 200", "p1", "p1 - p0", "p0", "i1", None, "i1 + 4 * (i0 - i1)",
             counted=("i1", "i0", "CASE WHEN c <= p0 + h / 3 THEN 1 ELSE 0 END"), share="n >= 0.45 * m"),
    Template("V-bottom", "V-top (spike)", "V reversal", 2, "i0 > i1 AND h >= 2 * k * a0 AND h / nullif(i0 - i1, 0) >= 0.5 * a0", "p0 + 0.618 * (p1 - p0)", "p1 - p0", "p0", "i1", "p1", "i0 + greatest(i0 - i1, 5)"),
    Template("Wave-3 / ABC breakout up", "Wave-3 / ABC breakdown", "Wave-3 / ABC measured move", 3, f"h > 1.5 * k * a1 AND p0 > p2 AND {within('(p1 - p0) / h', 0.382, 0.786)}", "p1", "p1 - p2", "p0", "i2", "p0 + p1 - p2"),
    Template("Dow trend reversal up", "Dow trend reversal down", "Dow theory reversal", 4, "p1 < p3 AND p0 > p2 AND abs(p0 - p2) > 0.2 * (p1 - least(p2, p0))", "p1", "p1 - p0", "p0", "i3"),
    Template("Three drives bottom", "Three drives top", "Three drives", 6, "p4 > p2 AND p2 > p0 AND p5 > p3 AND p3 > p1 AND " + " AND ".join([within("(p3 - p2) / nullif(p3 - p4, 0)", 1.13, 1.9), within("(p1 - p0) / nullif(p1 - p2, 0)", 1.13, 1.9), within("(p3 - p4) / nullif(p5 - p4, 0)", 0.382, 0.786), within("(p1 - p2) / nullif(p3 - p2, 0)", 0.382, 0.786)]), "p1", "p5 - p0", "p0", "i5", "p0 + 0.618 * (p5 - p0)"),
    *map(harmonic, HARMONICS),
    Template("Bullish Cypher", "Bearish Cypher", "Harmonic", 5, " AND ".join([_legs5, "p1 > p4", within("(p3 - p2) / nullif(p3 - p4, 0)", 0.382, 0.618), within("(p1 - p4) / nullif(p3 - p4, 0)", 1.13, 1.414), within("(p1 - p0) / nullif(p1 - p4, 0)", 0.72, 0.85)]), "p0 + b0", "p1 - p0", "p4", "i4", "p0 + 0.618 * (p1 - p0)", "i0 + 10", variant="'Cypher'"),
    Template("Bullish AB=CD", "Bearish AB=CD", "Harmonic", 4, " AND ".join(["p3 > p2 AND p1 > p2 AND p1 > p0 AND p0 < p2", within("(p1 - p2) / nullif(p3 - p2, 0)", 0.382, 0.886), within("(p1 - p0) / nullif(p3 - p2, 0)", 0.9, 1.1, 0.0), within("(p1 - p0) / nullif(p1 - p2, 0)", 1.13, 2.618)]), "p0 + b0", "p3 - p0", "p0 - 0.5 * b0", "i3", "p0 + 0.618 * (p3 - p0)", "i0 + 10", variant="'AB=CD'"),
    Template("Bullish Wolfe wave", "Bearish Wolfe wave", "Wolfe wave", 5, f"p2 < p4 AND p1 < p3 AND p0 < p2 AND p1 > p4 AND (p1 - p3) / nullif(i1 - i3, 0) < (p2 - p4) / nullif(i2 - i4, 0) AND p0 < {at(through(4, 2), 'i0')}", through(4, 2), "abs(p1 - p0)", "p0 - 0.5 * b0", "i4", at(through(4, 1), "(i0 + (i0 - i4) * 0.5)"), "i0 + 15"),
    Template("Bullish Quasimodo", "Bearish Quasimodo", "Quasimodo", 5, "p2 < p4 AND p1 > p3 AND p0 > p2 AND p1 > p2 AND abs(p0 - p4) <= 0.35 * (p1 - p2)", "p0 + b0", "p1 - p0", "p2", "i4", "p1", "i0 + 15"),
    Template("Elliott 5-wave decline complete", "Elliott 5-wave advance complete", "Elliott wave", 6, "p3 < p5 AND p2 < p4 AND p1 < p4 AND p0 < p2 AND p3 - p2 >= least(p5 - p4, p1 - p0)", "p0 + 0.5 * (p1 - p0)", "p5 - p0", "p0", "i5", "p0 + 0.382 * (p5 - p0)", "i0 + 30"),
    Template("Downtrend-line breakout", "Uptrend-line breakdown", "Trendline break", 4, "p1 < p3 AND i1 - i3 >= least_width", NECK, f"{at(NECK, 'i0')} - p0", "p0", "i3", counted=("i3 + 1", "i0", f"CASE WHEN c > {at(NECK, 't')} + 0.25 * a0 THEN 1 ELSE 0 END"), share="n = 0"),
    *[Template("VCP breakout", "VCP breakout", "VCP", 6, contraction(n) + (f" AND NOT coalesce({contraction(6)}, false)" if n < 6 else ""), "p1", f"p{n - 1} - p{n - 2}", "p0", f"i{n - 1}", variant=f"'{n // 2} contractions'") for n in (6, 4)],
]

#: The name of two lines by the slopes of the upper and the lower one, and how their distance goes.
TWO_LINES = {
    ("flat", "flat", "par"): "Rectangle",
    ("flat", "up", "conv"): "Ascending triangle",
    ("down", "flat", "conv"): "Descending triangle",
    ("down", "up", "conv"): "Symmetrical triangle",
    ("up", "up", "conv"): "Rising wedge",
    ("down", "down", "conv"): "Falling wedge",
    ("up", "up", "par"): "Channel up",
    ("down", "down", "par"): "Channel down",
    ("up", "down", "div"): "Broadening formation",
    ("up", "flat", "div"): "Right-angled broadening (ascending)",
    ("flat", "down", "div"): "Right-angled broadening (descending)",
    ("up", "up", "div"): "Ascending broadening wedge",
    ("down", "down", "div"): "Descending broadening wedge",
}
#: Names that four points are enough for.
FOUR_POINTS = ("Rectangle", "Ascending triangle", "Descending triangle", "Symmetrical triangle")


def fitted(points: list[int]) -> tuple[str, str, str]:
    """Level at bar 0, slope and largest error of the least squares line through points."""
    n = len(points)
    x, y = (f"({' + '.join(f'{c}{j}' for j in points)}) / CAST({n} AS double)" for c in "ip")
    top, bottom = (" + ".join(f"(i{j} - {x}) * ({c}{j} - {m})" for j in points) for c, m in (("p", y), ("i", x)))
    slope = f"(({top}) / nullif({bottom}, 0))"
    return f"{y} - {slope} * ({x})", slope, "greatest(" + ", ".join(f"abs(p{j} - {y} - {slope} * (i{j} - {x}))" for j in points) + ")"


def line_columns(n: int) -> list[dict[str, str]]:
    """Columns of the upper and lower line through the last n points, level by level, each named with n at its end."""
    lines = {}
    for c, odd in (("u", 1), ("d", 0)):
        lines |= dict(zip((f"level_{c}{n}", f"slope_{c}{n}", f"error_{c}{n}"), fitted([j for j in range(n) if j % 2 == odd]), strict=True))
    gap = lambda x: f"level_u{n} + slope_u{n} * {x} - level_d{n} - slope_d{n} * {x}"
    width = f"(i0 - i{n - 1})"
    rise = lambda c: f"slope_{c}{n} * {width} / nullif(greatest(gap_a{n}, gap_z{n}), 0)"
    kind = lambda x: f"CASE WHEN abs({x}) < 0.2 THEN 'flat' WHEN {x} > 0 THEN 'up' ELSE 'down' END"
    known = [f"WHEN u{n} = '{u}' AND d{n} = '{d}' AND form{n} = '{f}' THEN '{name}'" for (u, d, f), name in TWO_LINES.items() if n > 4 or name in FOUR_POINTS]
    return [
        lines,
        {f"gap_a{n}": gap(f"i{n - 1}"), f"gap_z{n}": gap("i0")},
        {  # a mirrored upper line is the lower one
            f"u{n}": f"CASE WHEN side < 0 THEN {kind(rise('u'))} ELSE {kind('-' + rise('d'))} END", f"d{n}": f"CASE WHEN side < 0 THEN {kind(rise('d'))} ELSE {kind('-' + rise('u'))} END",
            f"form{n}": f"CASE WHEN gap_z{n} / nullif(gap_a{n}, 0) < 0.8 THEN 'conv' WHEN gap_z{n} / nullif(gap_a{n}, 0) > 1.25 THEN 'div' ELSE 'par' END", f"slack{n}": f"greatest(0.5 * a0, 0.12 * greatest(gap_a{n}, gap_z{n}))",
        },
        {f"name{n}": f"CASE WHEN gap_a{n} > 0 AND gap_z{n} > 0 THEN CASE {' '.join(known)} END END"},
    ]


def two_lines(n: int, way: int) -> Template:
    width = f"(i0 - i{n - 1})"
    when = f"name{n} IS NOT NULL AND {width} BETWEEN least_width AND most_width AND i{n - 2} - i{n - 1} <= 0.45 * {width} AND i0 - i1 <= 0.45 * {width} AND greatest(error_u{n}, error_d{n}) <= slack{n}"
    upper, lower = (f"(level_{c}{n} + slope_{c}{n} * {{x}})" for c in "ud")
    line, other = (upper, lower) if way > 0 else (lower, upper)
    out = f"CASE WHEN c > {at(upper, 't')} + slack{n} OR c < {at(lower, 't')} - slack{n} THEN 1 ELSE 0 END"
    apex = f"CASE WHEN form{n} = 'conv' AND slope_d{n} > slope_u{n} THEN CAST((level_u{n} - level_d{n}) / nullif(slope_d{n} - slope_u{n}, 0) AS long) ELSE i0 + {width} END"
    name = lambda up: f"concat(name{n}, '{' - up breakout' if up else ' - down breakout'}')"
    if way < 0:
        when += " AND NOT running"  # a point that isn't confirmed can only be turned from
    return Template(name(way > 0), name(way < 0), f"name{n}", n, when, line, f"greatest(gap_a{n}, gap_z{n})", at(other, "t"), f"i{n - 1}", None, apex, way, (f"i{n - 1}", "i0", out), "n <= 1", f"'{n} pivots'", True, 6 - n)


_span, _middle = "(p3 - p2)", "((i3 + i2) / 2)"
_diamond = f"p3 > greatest(p5, p1) AND p2 < least(p4, p0) AND i0 - i5 BETWEEN least_width AND most_width AND greatest(abs(p5 - p1), abs(p4 - p0)) <= 0.5 * {_span} AND least(p5 - p4, p1 - p0) >= 0.25 * {_span} AND ({_middle} - i5) / greatest(i0 - {_middle}, 1) BETWEEN 0.5 AND 2.0"
for _way in (1, -1):
    TEMPLATES += [two_lines(n, _way) for n in (6, 5, 4)]
    _up, _down = "'Diamond - up breakout'", "'Diamond - down breakout'"
    TEMPLATES.append(Template(_up if _way > 0 else _down, _down if _way > 0 else _up, "'Diamond'", 6, _diamond + (" AND NOT running" if _way < 0 else ""), through(3, 1) if _way > 0 else through(2, 0), _span, at(through(2, 0) if _way > 0 else through(3, 1), "t"), "i5", None, "i0 + i0 - i5", _way, named=True))


def candidates(known: DataFrame) -> DataFrame:
    """The templates that the points of a stretch meet: one row each, with the template's number; what they count isn't looked at yet."""
    limits = lambda j: F.expr("CASE scale " + " ".join(f"WHEN '{s}' THEN {v[j]}" for s, v in SCALES.items()) + " END")
    df = known.withColumns({f"{x}{j}": F.get(x, F.lit(j)) for x in "ipab" for j in range(POINTS)})
    df = df.withColumns({n: limits(j) for j, n in enumerate(("k", "least_width", "most_width", "wider"))})
    for level in zip(*(line_columns(n) for n in (6, 5, 4)), strict=True):
        df = df.withColumns({k: F.expr(v) for part in level for k, v in part.items()})
    df = df.withColumns({f"_h{n}": F.expr(f"CASE WHEN size(p) >= {x.points} THEN {x.height} END") for n, x in enumerate(TEMPLATES)})
    found = []
    for n, x in enumerate(TEMPLATES):
        h = f"_h{n}"
        cond = re.sub(r"\bh\b", h, x.when) + f" AND {h} IS NOT NULL"
        end = f"least(last, i0 + greatest(15, i0 - {x.start})" + (f", {x.expires})" if x.expires else ")")
        found.append(F.expr(f"CASE WHEN {cond} THEN struct({n} AS template, CAST({x.start} AS long) AS start, CAST({end} AS long) AS until, CAST({h} AS double) AS h) END"))
    c = F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("c")
    return df.select("*", c).select("*", "c.*").drop("c", *[f"_h{n}" for n in range(len(TEMPLATES))]).withColumn("up", -F.col("side"))


def choose(texts: Iterable[str | None], otherwise: str = "NULL") -> str:
    """SQL text that gives each template its own; templates of one text share a branch."""
    whose: dict[str, list[str]] = {}
    for n, x in enumerate(texts):
        if x is not None:
            whose.setdefault(x, []).append(str(n))
    return "CASE " + " ".join(f"WHEN template IN ({', '.join(ns)}) THEN {x}" for x, ns in whose.items()) + f" ELSE {otherwise} END"


#: Columns of two lines by what their names begin with; a candidate's own are chosen once, not for each bar that it looks at.
TWO_LINE_COLUMNS = ("level_u", "slope_u", "level_d", "slope_d", "slack")


def own_lines(text: str) -> str:
    return re.sub(rf"\b({'|'.join(TWO_LINE_COLUMNS)})\d\b", r"\1_", text)


def of(prices: str, x: str) -> str:
    """SQL text of the value at bar x."""
    return f"get({prices}, CAST({x} - zero AS int))"


def once(df: DataFrame, name: str, text: str) -> DataFrame:
    """df with a column that no filter after it computes again, as a filter on a plain column would."""
    return df.select("*", F.explode(F.array(F.expr(text))).alias(name))


def count_text(x: Template) -> str:
    """SQL text of a template's sum over its bars: what differs by template is chosen for a candidate, not for each of its bars."""
    number = re.sub(r"\bt\b", "(from_ + j)", re.sub(r"\b[cl]\b", "(up * y)", own_lines(x.counted[2])))
    prices = "closes" if not re.search(r"\bl\b", x.counted[2]) else "CASE WHEN up > 0 THEN lows ELSE highs END"
    return f"aggregate(transform(slice({prices}, CAST(from_ - zero AS int) + 1, CAST(to_ - from_ AS int) + 1), (y, j) -> {number}), 0L, (s, y) -> s + y)"


def crossing_text(x: Template) -> str:
    """SQL text of the first bar whose close is beyond a template's line and the close before isn't."""
    beyond = lambda bar: f"{x.way} * up * {of('closes', bar)} > {x.way} * {at(own_lines(x.line), bar)}"
    return f"get(filter(sequence(greatest(first, 1L), until), x -> {beyond('x')} AND NOT {beyond('(x - 1)')}), 0)"


def counted(c: DataFrame) -> DataFrame:
    """Candidates (with their symbol's prices) whose bars between their points are as their templates ask, with the count n among m bars."""
    bounds = {"from_": F.expr(choose(x.counted and f"CAST(greatest(0, {x.counted[0]}) AS long)" for x in TEMPLATES)), "to_": F.expr(f"least(zero + size(closes) - 1, {choose(x.counted and f'CAST({x.counted[1]} AS long)' for x in TEMPLATES)})")}
    some = "from_ <= to_"  # null without a count
    two = {f"{k}_": F.expr(choose(f"{k}{x.points}" if x.named and x.pick is not None else None for x in TEMPLATES)) for k in TWO_LINE_COLUMNS}
    c = c.withColumns(bounds | two | {"rank": F.expr(choose((None if x.pick is None else str(x.pick) for x in TEMPLATES)))}).filter("until >= first OR rank IS NOT NULL")  # one that has expired still outranks others
    c = once(c, "n", f"CASE WHEN {some} THEN {choose(x.counted and count_text(x) for x in TEMPLATES)} END").withColumn("m", F.expr(f"CASE WHEN {some} THEN to_ - from_ + 1 END"))
    return c.filter(F.expr(choose((x.share if x.counted else "true" for x in TEMPLATES), "true")))


def tie_up(x: Column) -> Column:
    """Rounded half up to six decimals; what lies a tenth of a billionth below a tie is one, as lines leave that much noise."""
    return F.floor(F.round(x, 9) * 1e6 + 0.5001) / 1e6


def chart_patterns(bars: DataFrame) -> DataFrame:
    """Events (symbol, date, t, pattern, family, dir, level) with scale, target, stop, start and variant; a name and start once in a scale.

    Candidates look at the bars in their symbol's arrays, so that only what crosses its line is shuffled, with the ranks that it competes with.
    """
    c = counted(candidates(stretches(walks(bars), "dates", *PRICES))).withColumn("way", F.expr(choose(str(x.way) for x in TEMPLATES)))
    line = lambda x: f"({choose(at(own_lines(y.line), x) for y in TEMPLATES)})"
    c = once(c, "t", f"CASE WHEN until >= greatest(first, 1L) THEN {choose(crossing_text(x) for x in TEMPLATES)} END").filter("t IS NOT NULL OR rank IS NOT NULL")
    name = lambda f: F.expr(choose(getattr(x, f) if x.named else f"'{getattr(x, f)}'" for x in TEMPLATES))
    c = c.withColumns({"pattern": F.when(F.col("up") > 0, name("bull")).otherwise(name("bear")), "family": name("family"), "variant": F.expr(choose(x.variant for x in TEMPLATES))})
    c = c.withColumns({"date": F.expr(of("dates", "t")), "_line": F.expr(line("t"))})
    c = c.withColumns({"target": F.expr(choose(x.target or f"_line + way * ({x.height})" for x in TEMPLATES)), "stop": F.expr(choose(x.stop for x in TEMPLATES))})
    event = F.struct(F.col("t").cast("int").alias("t"), "date", (F.col("_line") * F.col("up")).alias("level"), (F.col("target") * F.col("up")).alias("target"), (F.col("stop") * F.col("up")).alias("stop"), "family", "variant", (F.col("up") * F.col("way")).alias("dir"))
    c = c.select("symbol", "scale", "place", "template", "pattern", "start", "rank", F.when(F.col("t").isNotNull(), event).alias("e"))
    best = F.min("rank").over(Window.partitionBy("symbol", "scale", "place"))  # of ranked templates the first of a stretch
    c = c.repartition("symbol").withColumn("best", best).filter("e IS NOT NULL AND (rank IS NULL OR rank = best)")
    kept = c.groupBy("symbol", "scale", "pattern", "start").agg(F.min_by("e", F.struct("place", "template")).alias("e"))
    return kept.select("symbol", "e.date", "e.t", "pattern", "e.family", F.col("e.dir").cast("int").alias("dir"), *[tie_up(F.col(f"e.{x}")).alias(x) for x in ("level", "target", "stop")], "scale", "start", "e.variant")


WEEKLY = ("Pipe bottom (weekly)", "Pipe top (weekly)", "Horn bottom (weekly)", "Horn top (weekly)")


def weeks(bars: DataFrame) -> DataFrame:
    """Weeks that end on Friday: extremes, last close, and the date and number of the last bar."""
    week = F.date_trunc("week", F.date_add("date", 2))
    return bars.groupBy("symbol", week.alias("week")).agg(F.max("high").alias("high"), F.min("low").alias("low"), F.max_by("close", "t").alias("close"), F.max("t").alias("t"), F.max("date").alias("date"))


def pipes_and_horns(bars: DataFrame) -> DataFrame:
    """Two long weeks side by side, or with a smaller one between, that stand out from the weeks before; 20 weeks at least."""
    c, w = F.col, Window.partitionBy("symbol").orderBy("week")
    span = lambda a, b: w.rowsBetween(-a, -b)
    df = weeks(bars).withColumn("rng", F.round(c("high") - c("low"), 6))
    df = df.withColumns({"n": F.row_number().over(w) - 1, "total": F.count("*").over(Window.partitionBy("symbol")), "usual": F.round(F.avg("rng").over(span(11, 2)), 8)})
    back = {f"{x}{k}": F.lag(x, k).over(w) for x in ("high", "low", "rng") for k in (1, 2)}
    df = df.withColumns({**back, "l5": F.min("low").over(span(6, 2)), "h5": F.max("high").over(span(6, 2)), "l6": F.min("low").over(span(7, 3)), "h6": F.max("high").over(span(7, 3))})
    above = F.round(c("close") - (c("high") + c("low")) / 2, 8)
    near = lambda x, k: F.round(F.abs(c(x) - c(f"{x}{k}")) - 0.25 * c(f"rng{k}"), 8) <= 0
    long = lambda k, f: F.round(F.least("rng", f"rng{k}") - f * c("usual"), 8) > 0
    known, later = (c("total") >= 20) & (c("n") >= 12), (c("total") >= 20) & (c("n") >= 13)
    pipe_low = known & long(1, 1.5) & near("low", 1) & (F.round(F.greatest("low", "low1") - c("l5") + 0.3 * c("usual"), 8) < 0) & (above > 0)
    pipe_high = known & long(1, 1.5) & near("high", 1) & (F.round(F.least("high", "high1") - c("h5") - 0.3 * c("usual"), 8) > 0) & (above < 0)
    horn_low = later & (F.greatest("low2", "low") < c("low1")) & near("low", 2) & long(2, 1.3) & (above > 0) & (F.greatest("low2", "low") < c("l6"))
    horn_high = later & (F.least("high2", "high") > c("high1")) & near("high", 2) & long(2, 1.3) & (above < 0) & (F.least("high2", "high") > c("h6"))
    family = "Pipes & horns"
    return emit(df, [("Pipe bottom (weekly)", family, 1, pipe_low, "close"), ("Pipe top (weekly)", family, -1, pipe_high, "close"), ("Horn bottom (weekly)", family, 1, horn_low, "close"), ("Horn top (weekly)", family, -1, horn_high, "close")])
