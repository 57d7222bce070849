"""Point and figure columns, Darvas boxes, and flags: events of price figures that run on their own clock or search over lengths.

Columns of boxes and Darvas boxes depend on their own past, so a small kernel walks a symbol's bars from turn to turn; what the
events are is then windows over columns. Flags are searched over pole and flag lengths by shifted arrays, all bars at once.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.exprs import r6
from tickloom.operators.charts import turn
from tickloom.operators.patterns import with_atr

#: The height of a box in percent, boxes of a reversal.
BOX, REVERSAL = 2.0, 3
#: Bars of the high that opens a box, least of them, and bars that a top or bottom must stand.
HIGH_BARS, LEAST_HIGH, STANDS = 252, 120, 3
#: Fixed values of flags: bars of poles and flags, mean true ranges of a pole, how far a flag may top it and give back of it, and the
#: gain of a high tight flag.
POLES, FLAGS, POLE_RANGES, TOPS, GIVES, TIGHT_GAIN = (5, 10, 15), range(3, 16), 5, 0.25, 0.5, 0.9
#: Fixed values of the other high tight flag: bars of the rise and the flag, the rise, what is left at its low, and its target.
RISE_BARS, TIGHT_FLAGS, RISE, LEFT, TIGHT_TARGET = 40, (10, 15, 20, 25), 1.9, 0.75, 1.2


def box_numbers(high: np.ndarray, low: np.ndarray, percent: float = BOX) -> tuple[np.ndarray, np.ndarray]:
    """The highest box that each bar reaches up to and the lowest it reaches down to, on a logarithmic grid."""
    size = np.log(1 + percent / 100)
    grid = lambda x: np.round(np.log(x) / size, 9)
    return np.floor(grid(high)).astype(np.int64), np.ceil(grid(low)).astype(np.int64)


def figure_columns(high: np.ndarray, low: np.ndarray, reversal: int = REVERSAL) -> list[tuple[int, int, list[int], list[int]]]:
    """Direction, first bar, bars of the column's new extremes and the boxes (times direction) that they reach, of each column."""
    up, down = box_numbers(high, low)
    side, at, out = 1, 0, []
    while at < len(up):
        ahead, back = (up, down) if side > 0 else (-down, -up)
        n, new = turn(ahead[at], ahead[at + 1 :], back[at + 1 :], np.full(len(up) - at - 1, reversal))
        bars = [at, *(new + at + 1).tolist()]
        out.append((side, at, bars, ahead[bars].tolist()))
        side, at = -side, at + 1 + n
    return out


def point_figure(bars: DataFrame) -> DataFrame:
    """The first bar of each column that goes beyond the last column of its direction; from the fifth column on."""
    many = T.ArrayType(T.LongType())
    schema = T.StructType([bars.schema["symbol"], *(T.StructField(c, T.LongType()) for c in ("k", "side", "first")), T.StructField("at", many), T.StructField("date", T.ArrayType(T.DateType())), T.StructField("box", many)])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", ignore_index=True)
        dates = pdf["date"].to_numpy()
        found = figure_columns(pdf["high"].to_numpy(float), pdf["low"].to_numpy(float))
        return pd.DataFrame([(pdf["symbol"].iat[0], k, side, first, at, list(dates[at]), box) for k, (side, first, at, box) in enumerate(found)], columns=schema.names)

    columns = bars.select("symbol", "t", "date", "high", "low").groupBy("symbol").applyInPandas(run, schema)
    w = Window.partitionBy("symbol").orderBy("k")
    reach = F.element_at("box", -1)
    d = columns.withColumn("reach", reach).withColumns({f"r{j}": F.lag("reach", j).over(w) for j in (1, 2, 3, 4)} | {"start": F.lag("first", 4).over(w)})
    beyond = F.filter(F.arrays_zip("at", "date", "box"), lambda x: x["box"] > F.col("r2"))
    d = d.filter("r4 IS NOT NULL").withColumn("e", F.get(beyond, F.lit(0))).filter("e IS NOT NULL")
    kind = F.when(F.col("r2") == F.col("r4"), F.lit(0)).when((F.col("r2") > F.col("r4")) & (F.col("r1") < F.col("r3")), 1).otherwise(2)
    names = {1: ("P&F triple-top buy", "P&F bullish ascending breakout", "P&F double-top buy"), -1: ("P&F triple-bottom sell", "P&F bearish descending breakdown", "P&F double-bottom sell")}
    text = lambda s: F.element_at(F.array(*map(F.lit, names[s])), kind + 1)
    price = lambda box: F.pow(F.lit(1 + BOX / 100), box)
    side = F.col("side")
    return d.select(
        "symbol", "e.date", F.col("e.at").alias("t"), F.when(side > 0, text(1)).otherwise(text(-1)).alias("pattern"), F.lit("Point & figure").alias("family"), side.cast("int").alias("dir"),
        r6(price(side * F.col("r2"))).alias("level"), F.lit(None).cast("double").alias("target"), r6(price(side * (1 - F.col("r1")))).alias("stop"), F.lit("bar").alias("scale"), "start",
    )


def darvas_boxes(high: np.ndarray, low: np.ndarray, close: np.ndarray, opening: np.ndarray) -> list[tuple[int, int, float, float, int]]:
    """Bar, direction, top, bottom and first bar of each break of a box. opening: bars at a high that opens a box.

    A top stands when the next three bars don't top it; then a bottom when three bars don't go below it. The bar that completes
    a stage isn't looked at for the next one.
    """
    n, out, starts = len(high), [], np.flatnonzero(opening)
    t = 3

    def next_box(t: int) -> int:
        j = int(np.searchsorted(starts, t))
        return int(starts[j]) if j < len(starts) else n

    top_bar = next_box(t)
    while top_bar < n:
        top, t = high[top_bar], top_bar + 1
        above = np.flatnonzero(high[t : t + STANDS] > top)
        if len(above):
            top_bar = t + int(above[0])
            continue
        if top_bar + STANDS >= n:
            break
        lowest = top_bar + 1 + int(np.argmin(low[t : t + STANDS]))
        t = top_bar + STANDS + 1
        moved = False
        while t < n:  # the bottom
            if high[t] > top:
                moved = True
                break
            if low[t] < low[lowest]:
                lowest = t
            if t - lowest >= STANDS:
                break
            t += 1
        if moved:
            top_bar = t
            continue
        bottom = low[lowest]
        ends = np.flatnonzero((close[t + 1 :] > top) | (close[t + 1 :] < bottom)) if t < n else ()
        if not len(ends):
            break
        t += 1 + int(ends[0])
        side = 1 if close[t] > top else -1
        out.append((t, side, float(top), float(bottom), top_bar))
        top_bar = t if side > 0 else next_box(t + 1)
    return out


FOUND = [T.StructField("t", T.LongType()), T.StructField("date", T.DateType()), T.StructField("pattern", T.StringType()), T.StructField("family", T.StringType()), T.StructField("dir", T.IntegerType()), *(T.StructField(c, T.DoubleType()) for c in ("level", "target", "stop")), T.StructField("scale", T.StringType()), T.StructField("start", T.LongType())]


def shown(found: DataFrame) -> DataFrame:
    return found.select("symbol", "date", "t", "pattern", "family", "dir", *[r6(c).alias(c) for c in ("level", "target", "stop")], "scale", "start")


def darvas(bars: DataFrame) -> DataFrame:
    """Closes above a Darvas box, whose height is the target, and below one."""
    df = bars.select("symbol", "t", "date", "high", "low", "close")
    schema = T.StructType([bars.schema["symbol"], *FOUND])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", ignore_index=True)
        dates, rows = pdf["date"].to_numpy(), []
        high, low, close = (pdf[c].to_numpy(float) for c in ("high", "low", "close"))
        opens = high >= pd.Series(high).rolling(HIGH_BARS, min_periods=LEAST_HIGH).max().to_numpy()
        for t, side, top, bottom, first in darvas_boxes(high, low, close, opens):
            name, line, other = ("Darvas box breakout", top, bottom) if side > 0 else ("Darvas box breakdown", bottom, top)
            rows.append((pdf["symbol"].iat[0], t, dates[t], name, "Darvas box", side, line, line + side * (top - bottom), other, "bar", first))
        return pd.DataFrame(rows, columns=schema.names)

    found = df.groupBy("symbol").applyInPandas(run, schema)
    kept = found.groupBy("symbol", "pattern", "start").agg(F.min_by(F.struct(*[c.name for c in FOUND if c.name not in ("pattern", "start")]), "t").alias("e"))
    return shown(kept.select("symbol", "pattern", "start", "e.*"))


def back(x: np.ndarray, n: int) -> np.ndarray:
    """x of n bars before."""
    return np.concatenate([np.full(min(n, len(x)), np.nan), x[: max(0, len(x) - n)]])


def extreme(x: np.ndarray, n: int, how: str) -> np.ndarray:
    """The extreme of the last n bars, the present one included."""
    r = pd.Series(x).rolling(n)
    return (r.max() if how == "max" else r.min()).to_numpy()


def slope(x: np.ndarray, n: int) -> np.ndarray:
    """Least squares slope of the last n values, times a positive number."""
    place = np.arange(n) - (n - 1) / 2
    out = np.full(len(x), np.nan)
    if len(x) >= n:
        out[n - 1 :] = np.lib.stride_tricks.sliding_window_view(x, n) @ place
    return np.round(out, 9)


def flag_breaks(high: np.ndarray, low: np.ndarray, close: np.ndarray, atr: np.ndarray) -> dict[str, np.ndarray]:
    """For bars of one direction (prices times -1 for falls): pole and flag length of the shortest flag, then pole, that breaks here (0: none), and its numbers."""
    n = len(close)
    out = {k: np.zeros(n, np.int64) for k in ("pole", "flag")} | {k: np.full(n, np.nan) for k in ("top", "low", "height", "base")} | {"pennant": np.zeros(n, bool)}
    for flag in FLAGS:
        top, bottom, peak, a = back(extreme(high, flag, "max"), 1), back(extreme(low, flag, "min"), 1), back(high, flag), back(atr, flag)
        breaks = (close > top) & (back(close, 1) <= top) & (np.arange(n) >= 60) & (out["flag"] == 0)
        narrow = np.zeros(n, bool)
        if flag >= 4:
            narrow = (back(slope(high, flag - 1), 1) < 0) & (back(slope(low, flag - 1), 1) > 0)
        for pole in POLES:
            base = back(low, flag + pole)
            height = np.round(peak - base, 9)
            fits = breaks & (out["flag"] == 0) & (np.arange(n) - flag - pole >= 1) & (np.round(height - POLE_RANGES * a, 8) >= 0) & (peak >= back(extreme(high, pole + 1, "max"), flag) - 1e-9)
            fits &= (np.round(top - peak - TOPS * a, 8) <= 0) & (np.round(top - bottom - GIVES * height, 8) <= 0)
            for k, v in (("top", top), ("low", bottom), ("height", height), ("base", base), ("pennant", narrow)):
                out[k][fits] = v[fits]
            out["pole"][fits], out["flag"][fits] = pole, flag
    return out


def tight_flags(high: np.ndarray, low: np.ndarray, close: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Length of the shortest high tight flag that breaks at each bar (0: none), its top and low."""
    n = len(close)
    length, tops, lows = np.zeros(n, np.int64), np.full(n, np.nan), np.full(n, np.nan)
    for flag in TIGHT_FLAGS:
        base = back(pd.Series(close).rolling(RISE_BARS + 1, min_periods=1).min().to_numpy(), flag)
        top, bottom = back(extreme(high, flag + 5, "max"), 1), back(extreme(low, flag, "min"), 1)
        fits = (length == 0) & (np.arange(n) >= 80) & (base > 0) & (np.round(back(close, flag) - RISE * base, 8) >= 0) & (np.round(bottom - LEFT * top, 8) >= 0) & (close > top) & (back(close, 1) <= top)
        length[fits], tops[fits], lows[fits] = flag, top[fits], bottom[fits]
    return length, tops, lows


def flags(bars: DataFrame) -> DataFrame:
    """Flags, pennants and high tight flags; a name and the first bar of its pole once."""
    df = with_atr(bars).select("symbol", "t", "date", "high", "low", "close", "atr")
    schema = T.StructType([bars.schema["symbol"], T.StructField("rank", T.LongType()), *FOUND])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", ignore_index=True)
        high, low, close, atr = (pdf[c].to_numpy(float) for c in ("high", "low", "close", "atr"))
        dates, rows, symbol = pdf["date"].to_numpy(), [], pdf["symbol"].iat[0]
        for side in (1, -1):
            f = flag_breaks(*((high, low, close) if side > 0 else (-low, -high, -close)), atr)
            for t in np.flatnonzero(f["flag"]).tolist():
                gain = f["height"][t] / abs(f["base"][t]) if f["base"][t] else 0.0
                name = "High tight flag" if side > 0 and round(gain - TIGHT_GAIN, 9) >= 0 else ("Bull " if side > 0 else "Bear ") + ("pennant" if f["pennant"][t] else "flag")
                rows.append((symbol, (0 if side > 0 else 1), t, dates[t], name, "Flag / pennant", side, side * f["top"][t], side * (f["top"][t] + f["height"][t]), side * f["low"][t], "bar", t - f["flag"][t] - f["pole"][t]))
        length, tops, lows = tight_flags(high, low, close)
        for t in np.flatnonzero(length).tolist():
            rows.append((symbol, 2, t, dates[t], "High tight flag", "Flag / pennant", 1, tops[t], tops[t] * TIGHT_TARGET, lows[t], "bar", t - length[t] - RISE_BARS))
        return pd.DataFrame(rows, columns=schema.names)

    found = df.groupBy("symbol").applyInPandas(run, schema)
    kept = found.groupBy("symbol", "pattern", "start").agg(F.min_by(F.struct(*[c.name for c in FOUND if c.name not in ("pattern", "start")]), F.struct("rank", "t")).alias("e"))
    return shown(kept.select("symbol", "pattern", "start", "e.*"))
