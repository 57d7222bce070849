"""Where each symbol stands in a session: what the day's ranks read, rank shares by counts, the market's own series by index."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import r6
from tickloom.functions.sqltext import dist, div, lag, roll
from tickloom.operators import features as Fe
from tickloom.operators.tables import Column, Kernel, Smooth, derive

# The columns that are ranked across the day.
RANKED = """ret_21 ret_63 ret_126 mom_12_1 excess_ret_63 dist_52w_high atr_pct_14 vol_ratio_20 deliv_pct_z60 log_turnover_20 mansfield_rs dist_sma200 ta_RSI hv_60 beta_60 deliv_pct_5_minus_20 updown_vol_50
linreg_slope_100 idio_vol_60 maxdd_252 ta_ADX ret_1""".split()
#: Ranges of values that a day's ranks are dealt by.
RANGES = 256


def deepest_fall(close: np.ndarray, n: int = 252, least: int = 201) -> tuple[np.ndarray, ...]:
    """The deepest fall from a running high within the last n bars, in percent; a block of windows at once."""
    out = np.full(len(close), np.nan)
    padded = np.concatenate((np.full(n - 1, np.nan), close))
    view = np.lib.stride_tricks.sliding_window_view(padded, n)
    for a in range(0, len(close), 2048):
        w = view[a : a + 2048]
        with np.errstate(invalid="ignore"):
            fall = w / np.fmax.accumulate(w, axis=1) - 1
        out[a : a + 2048] = np.where((~np.isnan(w)).sum(1) >= least, 100 * np.fmin.reduce(fall, axis=1), np.nan)
    return (out,)


COLUMNS: dict[str, Column] = Fe.COLUMNS | {
    **{f"ret_{n}": dist("close", lag("close", n)) for n in (21, 63, 126)}, "mom_12_1": dist(lag("close", 21), lag("close", 252)),
    "excess_ret_63": f"ret_63 - ({dist('bench', lag('bench', 63))})", "lret": f"ln({div('close', 'pc')})", "hv_60": f"({roll('std', 'lret', 60, 48)}) * {math.sqrt(252) * 100!r}", "beta_60": "beta60",
    "up_v": "CASE WHEN close > pc THEN volume ELSE 0.0 END", "dn_v": "CASE WHEN close < pc THEN volume ELSE 0.0 END", "updown_vol_50": div(roll("sum", "up_v", 50), roll("sum", "dn_v", 50)),
    "lnc": "ln(close)", "bar": "t * 1.0e0", "linreg_slope_100": "CASE WHEN count(lnc) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) >= 100 THEN 100 * regr_slope(lnc, bar) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) END",
    "maxdd_252": Kernel(("close",), deepest_fall),
}

#: The market: an index (bench) with the small and the mid caps' ones beside it, a bar a session.
MARKET: dict[str, Column] = {
    **{f"n50_ret_{k}": dist("bench", lag("bench", k)) for k in (1, 5, 21, 63, 126)}, **{f"n50_dist_sma{n}": dist("bench", roll("mean", "bench", n)) for n in (50, 200)},
    "move": f"bench - {lag('bench')}", "up": "CASE WHEN move > 0 THEN move WHEN move IS NOT NULL THEN 0.0 END", "down": "CASE WHEN move < 0 THEN -move WHEN move IS NOT NULL THEN 0.0 END",
    "up_": Smooth("up", 1 / 14), "down_": Smooth("down", 1 / 14), "n50_rsi14": f"100 - 100 / (1 + ({div('up_', 'down_')}))",
    "lr": f"ln({div('bench', lag('bench'))})", "n50_hv20": f"({roll('std', 'lr', 20)}) * {math.sqrt(252) * 100!r}", "n50_dd252": dist("bench", roll("max", "bench", 252, 100)),
    **{f"{tag}_vs_n50_{k}": f"100 * (({div(tag, lag(tag, k))}) - ({div('bench', lag('bench', k))}))" for tag in ("sc", "mc") for k in (21, 63)},
}
MARKET_SHOWN = [n for n in MARKET if n.startswith(("n50_", "sc_", "mc_"))]


def rank_shares(rows: DataFrame, columns: list[str], by: list[str], keys: list[str]) -> DataFrame:
    """keys and, for each column, the value's rank among those of its group `by` as a share: ties share their mean rank, nulls have none.

    Equal values are counted first. Their counts are summed within ranges of values and over the ranges, so no task orders a whole
    day: the result is exact whatever the distribution, and a group may hold any number of rows.
    """
    value = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).cast("double").alias("v")) for i, c in enumerate(columns)])).alias("e")
    long = rows.select(*by, *keys, value).select(*by, *keys, "e.*").filter("v IS NOT NULL")
    group = [*by, "i"]
    counts = long.groupBy(*group, "v").agg(F.count("*").alias("n"))
    spread = counts.groupBy(*group).agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"), F.sum("n").alias("_all"))
    at = F.when(F.col("_hi") > F.col("_lo"), F.floor((F.col("v") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (RANGES - 1))).otherwise(F.lit(0))
    counts = counts.join(spread, group).withColumn("_r", at)
    totals = counts.groupBy(*group, "_r").agg(F.sum("n").alias("_n"))  # at most RANGES a group
    before = Window.partitionBy(*group).orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*group, "_r", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_below"))
    within = Window.partitionBy(*group, "_r").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.join(totals, [*group, "_r"]).withColumn("_below", F.col("_below") + F.coalesce(F.sum("n").over(within), F.lit(0)))
    ranked = ranked.select(*group, "v", ((F.col("_below") + (F.col("n") + 1) / 2) / F.col("_all")).alias("share"))
    shares = long.join(ranked, [*group, "v"]).groupBy(*by, *keys).agg(*[F.max(F.when(F.col("i") == i, F.col("share"))).alias(c) for i, c in enumerate(columns)])
    return rows.select(*by, *keys).join(shares, [*by, *keys], "left")


def standing(bars: DataFrame) -> DataFrame:
    """symbol, date, t and the ranked columns of bars with a benchmark, rounded so that ties are ties in any order of addition."""
    return derive(bars, COLUMNS, RANKED).select("symbol", "date", "t", *[F.round(c, 8).alias(c) for c in RANKED])


def day_ranks(rows: DataFrame) -> DataFrame:
    """symbol, date, xs_rank_ of each ranked column."""
    got = rank_shares(rows, RANKED, ["date"], ["symbol"])
    return got.select("symbol", "date", *[r6(c).alias(f"xs_rank_{c}") for c in RANKED])


def cap_indices(bars: DataFrame, sizes: DataFrame) -> DataFrame:
    """date, bench, sc, mc: the mean close of all symbols, of the small and of the mid ones; sizes: symbol, cap. The last known one is carried forward."""
    ticks = F.round(F.col("close") * 100).cast("long")
    some = lambda where: F.when(F.count_if(where) > 0, F.floor(F.sum(F.when(where, ticks)) / F.greatest(F.count_if(where), F.lit(1)) / 100 * 1e4 + 0.5) / 1e4)
    day = bars.join(sizes, "symbol", "left").groupBy("date").agg(some(F.lit(True)).alias("bench"), some(F.col("cap") == "small").alias("sc"), some(F.col("cap") == "mid").alias("mc"))
    sofar = Window.partitionBy(F.lit(0)).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)  # a row a session
    return reduce(lambda d, c: d.withColumn(c, F.last(c, ignorenulls=True).over(sofar)), ("sc", "mc"), day)


def market_features(indices: DataFrame) -> DataFrame:
    """Returns, distances, strength, volatility and drawdown of the index, small and mid caps against it, and the regime."""
    series = indices.withColumn("symbol", F.lit(0))
    df = derive(series, MARKET | {"s50": f"round({roll('mean', 'bench', 50)}, 8)", "s200": f"round({roll('mean', 'bench', 200)}, 8)"}, [*MARKET_SHOWN, "s50", "s200"])
    regime = F.when((F.col("bench") > F.col("s50")) & (F.col("bench") > F.col("s200")), 1).when((F.col("bench") < F.col("s50")) & (F.col("bench") < F.col("s200")), -1).otherwise(0)
    return df.select("date", *[r6(c).alias(c) for c in MARKET_SHOWN], regime.alias("regime"))
