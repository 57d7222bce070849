"""Bar patterns: each emits dated events (symbol, date, t, pattern, family, dir, level).

A pattern's rules read a symbol's bars as arrays, a column at once, in one Arrow grouped map for all patterns that are due; only what the
rules hit leaves it. A symbol's history is bounded by the calendar.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from functools import cached_property, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.exprs import r6
from tickloom.operators import indicators
from tickloom.operators.tables import Column as Derived
from tickloom.operators.tables import derive, rma, rolled

Rule = tuple[str, str, int, Column, Column | str]
EVENT = ["symbol", "date", "t", "pattern", "family", "dir", "level"]


def hits(df: DataFrame, rules: list[Rule], kept: list[str]) -> DataFrame:
    """Columns of df and `e`, an array of what the rules that hold say of a bar."""
    df = df.withColumns({f"_hit{i}": cond for i, (_, _, _, cond, _) in enumerate(rules)})
    said = [F.when(F.col(f"_hit{i}"), F.struct(F.lit(name).alias("pattern"), F.lit(family).alias("family"), F.lit(d).alias("dir"), r6(level).alias("level"))) for i, (name, family, d, _, level) in enumerate(rules)]
    return df.select(*kept, F.filter(F.array(*said), lambda x: x.isNotNull()).alias("e"))


def emit(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """The events of all rules, by one pass: an array of the rules that hold, exploded."""
    return hits(df, rules, ["symbol", "date", "t"]).withColumn("e", F.explode("e")).select("symbol", "date", "t", "e.*")


#: Mean true range of 14 bars, Wilder's.
ATR: dict[str, Derived] = {"tr": indicators.COLUMNS["tr"], "atr": rma("tr", 14)}


def with_atr(bars: DataFrame) -> DataFrame:
    return bars if "atr" in bars.columns else derive(bars, ATR, ["atr"])


#: What rules find: name, family, direction, where they hold, and the level of each bar.
Found = tuple[str, str, int, np.ndarray, np.ndarray]
PRICES = ("open", "high", "low", "close", "volume")


class Bars:
    """A symbol's bars in order of date as arrays, NaN where null; `t` are the bars' numbers."""

    def __init__(self, rows: pa.Table):
        for c in PRICES:
            setattr(self, c, rows[c].cast(pa.float64()).to_numpy() if c in rows.column_names else np.full(len(rows), np.nan))
        self.t = rows["t"].to_numpy()
        self.pc, self.ph, self.pl = lag(self.close), lag(self.high), lag(self.low)
        if "atr" in rows.column_names:
            self.atr = rows["atr"].to_numpy()
        else:
            tr = np.fmax(self.high - self.low, np.fmax(np.abs(self.high - self.pc), np.abs(self.low - self.pc)))
            self.atr = rma("tr", 14).series(pd.Series(np.where(np.isnan(self.pc), np.nan, tr)))

    @cached_property
    def times_usual(self) -> np.ndarray:
        """Volume as a multiple of its mean of 50 bars."""
        return np.round(self.volume / np.maximum(mean(self.volume, 50), 1.0), 8)


def lag(x: np.ndarray, n: int = 1) -> np.ndarray:
    """x of n bars before: NaN, or False, where there is none."""
    none = np.full(min(n, len(x)), False if x.dtype == bool else np.nan)
    return np.concatenate((none, x[: max(0, len(x) - n)])) if n else x


def last(how: str, x: np.ndarray, n: int, least: int | None = None) -> np.ndarray:
    """The extreme of the last n bars, the present one included, from extremes of twice as many bars at a step; NaN with fewer than `least` (n) values."""
    out, size, f = x, 1, np.fmax if how == "max" else np.fmin
    while size < n:
        step = min(size, n - size)
        out, size = f(out, lag(out, step)), size + step
    seen = np.concatenate((np.zeros(n, np.int64), np.cumsum(~np.isnan(x))))
    return np.where(seen[n:] - seen[: len(x)] >= (least or n), out, np.nan)


def before(how: str, x: np.ndarray, n: int, least: int | None = None) -> np.ndarray:
    """The extreme of the n bars before this one."""
    return lag(last(how, x, n, least))


def mean(x: np.ndarray, n: int) -> np.ndarray:
    return rolled("mean", n, n)(x)[0]


def ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a / b, NaN unless |b| > 1e-12."""
    return np.where(np.abs(b) > 1e-12, a / b, np.nan)


def change(x: np.ndarray, n: int) -> np.ndarray:
    return np.round(ratio(x, lag(x, n)) - 1, 8)


class Pattern:
    """Rules over a symbol's bars: called on a table of bars, they give their events."""

    def __init__(self, names: tuple[str, ...], rules: Callable[..., list[Found]]):
        self.names, self.rules, self.__doc__ = names, rules, rules.__doc__

    def __call__(self, bars: DataFrame, **how) -> DataFrame:
        return found(bars, [lambda b: self.rules(b, **how)])


def pattern(*names: str) -> Callable[[Callable], Pattern]:
    return lambda rules: Pattern(names, rules)


def found(bars: DataFrame, due: list[Callable[[Bars], list[Found]]]) -> DataFrame:
    """The events of rules, by one grouped map."""
    kinds = {"pattern": T.StringType(), "family": T.StringType(), "dir": T.IntegerType(), "level": T.DoubleType()}
    schema = T.StructType([*(bars.schema[c] for c in EVENT[:3]), *(T.StructField(c, k) for c, k in kinds.items())])

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.take(pc.sort_indices(rows["date"]))
        bar, said, level = [], [], []
        with np.errstate(all="ignore"):
            b = Bars(rows)
            for name, family, d, cond, at in (x for rules in due for x in rules(b)):
                hit = np.flatnonzero(cond)
                bar.append(hit)
                level.append(at[hit])
                said += [(name, family, d)] * len(hit)
        out = rows.select(EVENT[:3]).take(pa.array(np.concatenate(bar)))
        for k, c in enumerate(EVENT[3:6]):
            out = out.append_column(c, pa.array([x[k] for x in said], pa.int32() if c == "dir" else pa.string()))
        return out.append_column("level", pa.array(np.concatenate(level), pa.float64(), from_pandas=True))

    kept = [c for c in (*EVENT[:3], *PRICES, "atr") if c in bars.columns]
    return bars.select(*kept).groupBy("symbol").applyInArrow(run, schema).withColumn("level", r6("level"))


@pattern("52-week high breakout", "52-week low breakdown", "Multi-year high breakout (since 2016)")
def new_highs(b: Bars) -> list[Found]:
    """Breaks of the 52-week and all-time extremes that no bar of the last 20 had."""
    hi, lo, ath = before("max", b.high, 252, 200), before("min", b.low, 252, 200), lag(np.fmax.accumulate(b.high))

    def first(x: np.ndarray) -> np.ndarray:
        so_far = np.concatenate((np.zeros(21, np.int64), np.cumsum(x)))
        some = so_far[20 : 20 + len(x)] > so_far[: len(x)]  # of the 20 bars before
        return x & ~(some & (np.arange(len(x)) >= 20))

    family = "New highs / lows"
    return [("52-week high breakout", family, 1, first(b.close > hi), hi), ("52-week low breakdown", family, -1, first(b.close < lo), lo), ("Multi-year high breakout (since 2016)", family, 1, first(b.close > ath) & (b.t >= 500), ath)]


@pattern("Key reversal day (bullish)", "Key reversal day (bearish)")
def key_reversals(b: Bars) -> list[Found]:
    ll, hh = before("min", b.low, 20), before("max", b.high, 20)
    bull, bear = (b.low < ll) & (b.close > b.pc) & (b.high > b.ph), (b.high > hh) & (b.close < b.pc) & (b.low < b.pl)
    return [("Key reversal day (bullish)", "Reversal bars", 1, bull, b.close), ("Key reversal day (bearish)", "Reversal bars", -1, bear, b.close)]


@pattern("2B bottom / Turtle soup", "2B top / Turtle soup")
def turtle_soup(b: Bars) -> list[Found]:
    """A false break of a 20-bar extreme that is at least three bars old, within two bars; only its first bar."""

    def false_break(x: np.ndarray, sign: int) -> tuple[np.ndarray, np.ndarray]:
        edge, age = before("min", sign * x, 20), np.full(len(x), np.nan)
        if len(x) > 20:
            first = np.lib.stride_tricks.sliding_window_view(sign * x, 20)[:-1].argmin(axis=1)  # of equal ones the oldest
            age[20:] = b.t[20:] - 1 - b.t[np.arange(len(first)) + first]
        each = [(lag(sign * x, k) < lag(edge, k)) & (sign * b.close > lag(edge, k)) & (lag(age, k) >= 3) for k in range(3)]
        some = reduce(np.logical_or, each)
        return some & ~lag(some), sign * edge

    return [("2B bottom / Turtle soup", "False breakout", 1, *false_break(b.low, 1)), ("2B top / Turtle soup", "False breakout", -1, *false_break(b.high, -1))]


@pattern("Wyckoff spring", "Wyckoff upthrust")
def wyckoff(b: Bars) -> list[Found]:
    """False breaks of a narrow 40-bar range."""
    hi, lo, atr8 = before("max", b.high, 40), before("min", b.low, 40), np.round(b.atr, 8)
    narrow = np.round(ratio(hi - lo, b.close), 8) < 0.20
    spring = narrow & (b.low < lo) & (b.low > np.round(lo - 1.5 * atr8, 8)) & (b.close > lo)
    thrust = narrow & (b.high > hi) & (b.high < np.round(hi + 1.5 * atr8, 8)) & (b.close < hi)
    return [("Wyckoff spring", "Wyckoff", 1, spring, lo), ("Wyckoff upthrust", "Wyckoff", -1, thrust, hi)]


@pattern("NR7 breakout up", "NR7 breakout down", "Inside day breakout up", "Inside day breakout down")
def contraction_breaks(b: Bars) -> list[Found]:
    """First close beyond a narrow-range or inside bar within three bars; of several such bars the latest sets the level."""
    rng = np.round(b.high - b.low, 2)
    bases = {"NR7": rng <= last("min", rng, 7), "Inside day": (b.high <= b.ph) & (b.low >= b.pl)}
    out: list[Found] = []
    for kind, base in bases.items():
        for d, x in ((1, b.high), (-1, b.low)):
            level = np.full(len(x), np.nan)
            for k in (3, 2, 1):  # the latest base last, so that it wins
                edge = lag(x, k)
                held = [(d * lag(b.close, j) <= d * edge) for j in range(1, k)]
                cond = reduce(np.logical_and, held, lag(base, k) & (d * b.close > d * edge))
                level[cond] = edge[cond]
            out.append((f"{kind} breakout {'up' if d > 0 else 'down'}", "Range contraction", d, ~np.isnan(level), level))
    return out


@pattern("Pocket pivot", "Selling climax (reversal)", "Buying climax (reversal)")
def volume_patterns(b: Bars) -> list[Found]:
    """Pocket pivots, and selling and buying climaxes."""
    sma50, sma200, volx, ret10 = np.round(mean(b.close, 50), 8), np.round(mean(b.close, 200), 8), b.times_usual, change(b.close, 10)
    dv10 = before("max", np.where(b.close < b.pc, b.volume, 0.0), 10)
    pivot = (b.close > b.pc) & (b.volume > dv10) & (b.close > sma50) & (np.round(np.abs(ratio(b.close, sma50) - 1), 8) < 0.10) & (sma50 > sma200)
    wide, middle = np.round((b.high - b.low) - 2 * b.atr, 8) > 0, np.round((b.high + b.low) / 2, 8)
    sell = (volx >= 3) & wide & (b.low <= before("min", b.low, 20)) & (b.close > middle) & (ret10 < -0.10)
    buy = (volx >= 3) & wide & (b.high >= before("max", b.high, 20)) & (b.close < middle) & (ret10 > 0.10)
    return [("Pocket pivot", "Volume patterns", 1, pivot, b.close), ("Selling climax (reversal)", "Volume patterns", 1, sell, b.close), ("Buying climax (reversal)", "Volume patterns", -1, buy, b.close)]


@pattern("Flat base breakout (25d)", "Flat base breakout (40d)", "Flat base breakout (60d)")
def flat_bases(b: Bars) -> list[Found]:
    """First close above a base of 25, 40 or 60 bars with a range of 15% at most after a rise of 20%."""
    out: list[Found] = []
    r60 = change(b.close, 60)
    for w in (25, 40, 60):
        hi, lo = before("max", b.high, w), before("min", b.low, w)
        cond = (np.round(ratio(hi, lo) - 1, 8) <= 0.15) & (b.close > hi) & (b.pc <= hi) & (lag(r60, w) >= 0.20)
        out.append((f"Flat base breakout ({w}d)", "IBD bases", 1, cond, hi))
    return out


@pattern("Breakaway gap up", "Breakaway gap down", "Runaway gap up", "Runaway gap down")
def gaps(b: Bars) -> list[Found]:
    """Breakaway and runaway gaps."""
    hi, lo, ret20 = before("max", b.high, 40), before("min", b.low, 40), change(b.close, 20)
    big = np.round(np.abs(b.open - b.pc) - 0.5 * b.atr, 8) >= 0
    up, down = (b.low > b.ph) & big, (b.high < b.pl) & big
    quiet = (np.round((hi - lo) / b.close, 8) < 0.25) & (b.times_usual >= 1.5)
    above, below = b.close > hi, b.close < lo
    return [("Breakaway gap up", "Gaps", 1, up & above & quiet, b.ph), ("Breakaway gap down", "Gaps", -1, down & below & quiet, b.pl), ("Runaway gap up", "Gaps", 1, up & (ret20 > 0.15) & ~above, b.ph), ("Runaway gap down", "Gaps", -1, down & (ret20 < -0.15) & ~below, b.pl)]


@pattern("Exhaustion gap (up, filled)", "Exhaustion gap (down, filled)")
def exhaustion_gaps(b: Bars, within: int = 5) -> list[Found]:
    """Gaps after a run of 25% in 20 bars that a close fills within `within` bars: the first such close, once for each gap."""
    r20, big = change(b.close, 20), np.round(np.abs(b.open - b.pc) - 0.5 * b.atr, 8) >= 0
    up, down = (b.low > b.ph) & big & (r20 > 0.25), (b.high < b.pl) & big & (r20 < -0.25)
    out: list[Found] = []
    for gap, edge, name, d in ((up, b.ph, "Exhaustion gap (up, filled)", -1), (down, b.pl, "Exhaustion gap (down, filled)", 1)):
        for k in range(1, within + 1):  # the gap was k bars ago
            level = lag(edge, k)
            open_yet = [d * lag(b.close, j) <= d * level for j in range(1, k)]
            out.append((name, "Gaps", d, reduce(np.logical_and, open_yet, lag(gap, k) & (d * b.close > d * level)), level))
    return out


@pattern("Rounding bottom (saucer)", "Rounding top")
def roundings(b: Bars, widths: tuple[int, ...] = (60, 120, 250)) -> list[Found]:
    """Closes that cross the left rim of a parabola fitted to the closes before: least squares by differences of running sums, places counted from the middle.

    A parabola explains 75% of the variance, has its vertex in the middle 40% of the window and is 10% deep; an event for each width.
    """
    out: list[Found] = []
    sums = [np.nancumsum(x) for x in (b.close, b.t * b.close, b.t * b.t * b.close, b.close * b.close, np.where(np.isnan(b.close), 0.0, 1.0))]
    for w in widths:
        s2 = w * (w * w - 1) / 12  # sums of the squared and fourth powers of places
        s4 = s2 * (3 * w * w - 7) / 20
        y, fty, ftty, yys, k = (lag(x) - np.nan_to_num(lag(x, w + 1)) for x in sums)  # of the w bars before this one
        m, few = b.t - (w + 1) / 2, max(3, w // 10)
        uy, uuy = fty - m * y, ftty - 2 * m * fty + m * m * y
        y = np.where(k == w, y, np.nan)
        top, bottom = (lag(last(how, b.close, few, 1), w - few + 1) for how in ("max", "min"))
        a, slope = np.round((uuy - s2 * y / w) / (s4 - s2 * s2 / w), 12), uy / s2
        vertex, total, rim = np.where(a != 0, -slope / (2 * a), np.nan), yys - y * y / w, np.where(a > 0, top, bottom)
        low = y / w - a * s2 / w + slope * vertex / 2
        explained = (uy * uy / s2 + a * (uuy - s2 * y / w)) / total
        place = np.round(vertex + (w - 1) / 2, 6)
        fits = (place >= 0.3 * w) & (place <= 0.7 * w) & (total > 1e-9) & (np.round(explained, 8) >= 0.75) & (np.round(np.abs(rim - low) / np.abs(rim), 8) >= 0.10)
        out.append(("Rounding bottom (saucer)", "Rounding", 1, fits & (a > 0) & (b.close > rim) & (b.pc <= rim), rim))
        out.append(("Rounding top", "Rounding", -1, fits & (a < 0) & (b.close < rim) & (b.pc >= rim), rim))
    return out


@pattern("Event decline (>=15% in 2 days)")
def event_declines(b: Bars) -> list[Found]:
    """A fall of 15% or more in two days that wasn't already one the day before."""
    d2 = change(b.close, 2)
    return [("Event decline (>=15% in 2 days)", "Event decline", 1, (d2 <= -0.15) & (lag(d2) > -0.15), b.close)]


@pattern("Island bottom", "Island top")
def islands(b: Bars, most: int = 15) -> list[Found]:
    """Bars cut off by gaps on both sides: 1 to `most` bars whose extremes leave the bar before and this bar apart."""
    kind, high, low = np.zeros(len(b.t)), b.ph, b.pl
    for k in range(1, most + 1):
        high, low = np.fmax(high, lag(b.high, k)), np.fmin(low, lag(b.low, k))
        bottom, top = (high < lag(b.low, k + 1)) & (high < b.low), (low > lag(b.high, k + 1)) & (low > b.high)
        kind = np.where(kind != 0, kind, np.where(bottom, 1, np.where(top, -1, 0)))  # the shortest island counts
    return [("Island bottom", "Island reversal", 1, kind == 1, b.low), ("Island top", "Island reversal", -1, kind == -1, b.high)]


PATTERNS = (new_highs, key_reversals, turtle_soup, wyckoff, contraction_breaks, volume_patterns, flat_bases, gaps, exhaustion_gaps, roundings, event_declines, islands)


def all_events(bars: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    """The events of the bar patterns, or of those that have the names, by one grouped map."""
    wanted = None if names is None else set(names)
    due = [p for p in PATTERNS if wanted is None or wanted & set(p.names)] or [event_declines]
    out = found(bars, [p.rules for p in due])
    return out if wanted is None else out.filter(F.col("pattern").isin(*wanted))


def pattern_features(events: DataFrame, bars: DataFrame, names: Iterable[str] = ()) -> DataFrame:
    """Bullish and bearish events of each symbol in its last 5 and 20 bars, the classic families apart, the net, and the decays of names.

    Everything is aggregated together, so that the events are computed once.
    """
    n = bars.groupBy("symbol").agg(F.max("t").alias("n"))
    df = events.join(n, "symbol", "right").withColumn("age", F.col("n") - F.col("t"))
    classic = ~F.col("family").isin("Range contraction", "Divergence", "Reversal bars", "Volume patterns")
    count = lambda cond: F.count_if(cond)
    side = {"bull": F.col("dir") > 0, "bear": F.col("dir") < 0}
    cols = [count(c & (F.col("age") < k)).alias(f"{s}_{k}") for s, c in side.items() for k in (5, 20)] + [count(c & classic & (F.col("age") < k)).alias(f"{s}_classic_{k}") for s, c in side.items() for k in (5, 20)]
    youngest = {p: F.min(F.when(F.col("pattern") == p, F.col("age"))) for p in names}
    decays = [F.round(F.when(age <= 30, F.exp(-age / 10)).otherwise(0.0), 6).alias(pattern_id(p)) for p, age in youngest.items()]
    return df.groupBy("symbol").agg(*cols, *decays).withColumn("net_20", F.col("bull_20") - F.col("bear_20"))


def pattern_counts(events: DataFrame, bars: DataFrame) -> DataFrame:
    """Bullish and bearish events of each symbol in its last 5 and 20 bars, the classic families apart, and the net."""
    return pattern_features(events, bars)


def pattern_id(name: str) -> str:
    return "pat_" + re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")[:60]


def pattern_decay(events: DataFrame, bars: DataFrame, names: list[str]) -> DataFrame:
    """For each symbol and pattern name, exp(-age / 10) of its latest event, 0 from 31 bars on."""
    n = bars.groupBy("symbol").agg(F.max("t").alias("n"))
    last = events.filter(F.col("pattern").isin(names)).groupBy("symbol").pivot("pattern", names).agg(F.max("t"))
    df = n.join(last, "symbol", "left")
    age = lambda p: F.col("n") - F.col(f"`{p}`")
    ids = {p: pattern_id(p) for p in names}
    return df.select("symbol", *[F.round(F.when(age(p) <= 30, F.exp(-age(p) / 10)).otherwise(0.0), 6).alias(ids[p]) for p in names])


