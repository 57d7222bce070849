"""Events on confirmed swing points: divergences, tested support and resistance, Fibonacci pullbacks.

`swing_points` gives each swing point once, with the bar that confirms it and what its own bar had in other columns, from one walk
over a symbol's bars for all scales. The rest is windows over points: pairs of points of a kind, the last nine of a kind, and the
last points of the major scale as of a minor one's confirmation. A point counts from its confirmation, never earlier.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.exprs import by_symbol, r6
from tickloom.operators import indicators
from tickloom.operators.charts import BLOCK, SCALES, legs, threshold
from tickloom.operators.tables import derive, rma

RANGES = {"tr": indicators.COLUMNS["tr"], "atr": rma("tr", 14), "atr50": rma("tr", 50)}
#: The oscillators' names in event names, and their columns.
OSCILLATORS = {"RSI": "rsi14", "MACD hist": "ta_MACD_macdhist", "OBV": "ta_OBV", "MFI": "ta_MFI"}
#: Scales that divergences and levels are sought in, least bars between the points of a pair, points and bars that a
#: level looks back, in mean true ranges how near they lie, touches, and bars that it lives.
SHORT_SCALES, LEAST_APART = ("minor", "intermediate"), 5
LOOK_BACK, LOOK_BARS, NEAR, TOUCHES, LIVES = 8, 250, 0.5, 3, 120
#: The zone of a pullback, and where its stop lies in the swing.
ZONE, STOP = (0.382 - 0.02, 0.618 + 0.02), 0.214
EVENT = ["symbol", "date", "t", "pattern", "family", "dir", "level", "target", "stop", "scale", "start"]


def swing_points(bars: DataFrame, values: Iterable[str] = (), scales: Iterable[str] = tuple(SCALES)) -> DataFrame:
    """symbol, scale, n, side (1: a high), i and px of each swing point, a and the values at its bar, and t, date and close of the bar that confirms it."""
    values = list(values)
    df = derive(bars, RANGES, ["atr", "atr50"]).select("symbol", "t", "date", "high", "low", "close", F.coalesce("atr50", "atr").alias("a"), *values)
    field = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([T.StructField("symbol", field["symbol"]), T.StructField("scale", T.StringType()), *(T.StructField(c, T.LongType()) for c in ("n", "side", "i", "t")), T.StructField("date", field["date"]), *(T.StructField(c, T.DoubleType()) for c in ("px", "close", "a", *values))])
    wanted = {s: SCALES[s] for s in scales}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", ignore_index=True)
        high, low, a = (pdf[c].to_numpy(float) for c in ("high", "low", "a"))
        out = []
        for scale, (k, *_) in wanted.items():
            first, swings = legs(high, low, threshold(k, a))
            found = [(first, -swings[0].side, swings[0].confirmed)] if swings else []
            found += [(x.extremes[-1], x.side, x.end) for x in swings if x.end < len(high)]
            i, side, at = (np.array(v, np.int64) for v in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 3
            own = pdf.iloc[i]
            part = {"symbol": pdf["symbol"].iat[0], "scale": scale, "n": np.arange(len(i)), "side": side, "i": own["t"].to_numpy(), "t": pdf["t"].to_numpy()[at], "date": pdf["date"].to_numpy()[at], "px": np.where(side > 0, high[i], low[i]), "close": pdf["close"].to_numpy(float)[at], "a": a[i]}
            out.append(pd.DataFrame(part | {v: own[v].to_numpy(float) for v in values}))
        return pd.concat(out, ignore_index=True)

    return df.groupBy("symbol").applyInPandas(run, schema)


def event(df: DataFrame, pattern: Column, family: str, side: Column, level: Column, target: Column, stop: Column, start: Column) -> DataFrame:
    shown = dict(zip(("level", "target", "stop"), (r6(x) for x in (level, target, stop)), strict=True))
    return df.select("symbol", "date", "t", pattern.alias("pattern"), F.lit(family).alias("family"), side.cast("int").alias("dir"), *[c.alias(n) for n, c in shown.items()], "scale", start.alias("start"))


def divergences(bars: DataFrame) -> DataFrame:
    """Two swings of a kind, one after the other, of which price and an oscillator tell different things; known when the second is confirmed."""
    df = derive(bars, indicators.COLUMNS, OSCILLATORS.values())
    points = swing_points(df.withColumns({c: F.round(c, 8) for c in OSCILLATORS.values()}), OSCILLATORS.values(), SHORT_SCALES)
    w = Window.partitionBy("symbol", "scale", "side").orderBy("n")
    before = {f"{c}_": F.lag(c).over(w) for c in ("i", "px", *OSCILLATORS.values())}
    widest = F.expr("CASE scale " + " ".join(f"WHEN '{s}' THEN {SCALES[s][2]}" for s in SHORT_SCALES) + " END")
    pairs = points.withColumns(before).filter((F.col("i") - F.col("i_")).between(LEAST_APART, widest))
    each = F.array(*[F.struct(F.lit(n).alias("name"), F.col(c).alias("x"), F.col(f"{c}_").alias("was")) for n, c in OSCILLATORS.items()])
    e = pairs.withColumn("o", F.explode(each)).select("*", "o.*")
    out, back = F.col("side") * (F.col("px") - F.col("px_")), F.col("side") * (F.col("x") - F.col("was"))  # above 0: further out than the last swing
    hidden = (out < 0) & (back > 0)
    e = e.filter(((out > 0) & (back < 0)) | hidden)
    kind = F.when(F.col("side") < 0, F.when(hidden, "Hidden bullish divergence (").otherwise("Bullish divergence (")).otherwise(F.when(hidden, "Hidden bearish divergence (").otherwise("Bearish divergence ("))
    none = F.lit(None).cast("double")
    return event(e, F.concat(kind, "name", F.lit(")")), "Divergence", -F.col("side"), F.col("close"), none, F.col("px"), F.col("i_"))


def first_crossing(lines: DataFrame, bars: DataFrame, key: list[str]) -> DataFrame:
    """lines (symbol, key, first, until, dir, line) with t and date of the first close beyond its line, of which the close before wasn't.

    Lines and bars meet by symbol and block of bars, so a line meets the bars of its life and no others.
    """
    price = bars.select("symbol", "date", "t", "close", F.lag("close").over(by_symbol()).alias("before"), F.floor(F.col("t") / BLOCK).alias("block"))
    held = lines.filter("until >= first").withColumn("block", F.explode(F.expr(f"sequence(first div {BLOCK}, until div {BLOCK})")))
    met = held.join(price, ["symbol", "block"]).filter("t BETWEEN greatest(first, 1) AND until AND (close - line) * dir > 0 AND NOT (before - line) * dir > 0")
    others = [c for c in lines.columns if c not in ("symbol", *key)]
    return met.groupBy("symbol", *key).agg(F.min(F.struct("t", "date")).alias("e"), *[F.first(c).alias(c) for c in others]).select("symbol", *key, *others, "e.t", "e.date")


def tested_levels(bars: DataFrame) -> DataFrame:
    """Closes beyond a level that three swing points of a kind have touched; the level lives until the next such point is confirmed."""
    points = swing_points(bars, (), SHORT_SCALES)
    w = Window.partitionBy("symbol", "scale", "side").orderBy("n")
    near = F.filter(F.collect_list(F.struct("i", "px")).over(w.rowsBetween(-LOOK_BACK, 0)), lambda p: (F.round(F.abs(p["px"] - F.col("px")), 8) <= F.round(NEAR * F.col("a"), 8)) & (F.col("i") - p["i"] <= LOOK_BARS))
    df = points.withColumns({"near": near, "k": F.row_number().over(w), "next": F.lead("t").over(w)}).filter((F.col("k") >= TOUCHES) & (F.size("near") >= TOUCHES))
    prices = F.transform("near", lambda p: p["px"])
    line = F.when(F.col("side") > 0, F.array_max(prices)).otherwise(F.array_min(prices))
    lines = df.select("symbol", "scale", "side", "n", F.col("side").alias("dir"), line.alias("line"), F.element_at("near", 1)["i"].alias("start"), F.col("t").alias("first"), F.least(F.col("i") + LIVES, "next").alias("until"))
    hit = first_crossing(lines, bars, ["scale", "side", "n"])
    kept = hit.groupBy("symbol", "scale", "side", "start").agg(F.min_by(F.struct("t", "date", "line", "dir"), "n").alias("e")).select("symbol", "scale", "start", "e.*")  # a name and start once
    name = F.when(F.col("dir") > 0, "Horizontal resistance breakout (3+ touches)").otherwise("Horizontal support breakdown (3+ touches)")
    none = F.lit(None).cast("double")
    return event(kept, name, "Support / resistance", F.col("dir"), F.col("line"), none, none, F.col("start"))


def fibonacci(bars: DataFrame) -> DataFrame:
    """Minor swing points that end a pullback of 38 to 62% of the last major swing, as it was known when they were confirmed."""
    points = swing_points(bars, (), ("minor", "major"))
    major = F.col("scale") == "major"
    order = Window.partitionBy("symbol").orderBy("t", F.when(major, 0).otherwise(1), "n")
    own = Window.partitionBy("symbol", "scale").orderBy("n")
    leg = F.struct(F.col("i").alias("i"), F.col("px").alias("px"), F.col("side").alias("side"), F.lag("i").over(own).alias("from_i"), F.lag("px").over(own).alias("from_px"))
    df = points.withColumn("leg", leg).withColumn("m", F.last(F.when(major, F.col("leg")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    df = df.filter(~major & F.col("m.from_i").isNotNull() & (F.col("i") > F.col("m.i")) & (F.col("side") == -F.col("m.side")))
    swing = F.col("m.px") - F.col("m.from_px")
    df = df.withColumns({"swing": swing, "part": F.round((F.col("m.px") - F.col("px")) / swing, 8)}).filter((F.col("swing") * F.col("m.side") > 0) & F.col("part").between(*ZONE))
    first = Window.partitionBy("symbol", "side", "m.from_i").orderBy("n")
    df = df.withColumn("place", F.row_number().over(first)).filter("place = 1")  # a name and start once
    name = F.when(F.col("m.side") > 0, "Fibonacci 38-62% pullback bounce (uptrend)").otherwise("Fibonacci 38-62% rally failure (downtrend)")
    return event(df, name, "Fibonacci", F.col("m.side"), F.col("close"), F.col("m.px"), F.col("m.from_px") + STOP * F.col("swing"), F.col("m.from_i"))
