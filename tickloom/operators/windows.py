"""Window features of each symbol. Every function takes bars (symbol, date, open, high, low, close, volume, ..., t).

All windows are over (symbol, date), so one exchange and one sort serve every column of a call.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

import numpy as np
from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickloom.functions.exprs import by_symbol, flag, frame, lag, pct_dist, r6, rolling, safe_div, week_end
from tickloom.operators.tables import Kernel, recursions

RETURNS = (1, 2, 3, 5, 21, 42, 63, 126, 189, 252)
def so_far() -> WindowSpec:
    return by_symbol().rowsBetween(Window.unboundedPreceding, 0)


def _out(df: DataFrame, cols: dict) -> DataFrame:
    return df.select("symbol", "date", *[r6(c).alias(n) for n, c in cols.items()])


def moments(df: DataFrame, **kernels: tuple[tuple[str, ...], Callable, int, str]) -> DataFrame:
    """df with rolling moments: each name has input columns, a function of arrays by windows, bars of a window, and the names of its outputs.

    Spark sums every frame anew for each bar; here a symbol's windows are one strided array, of which numpy takes the moments. A window with
    a null, or one that isn't full, has none. Deviations are from the window's first value and then from their mean, so equal values have none.
    """
    columns = {o: Kernel(inputs, windowed(f, n), i) for inputs, f, n, outs in kernels.values() for i, o in enumerate(outs.split())}
    return recursions(df, columns, list(columns))


def windowed(f: Callable, n: int) -> Callable[..., tuple[np.ndarray, ...]]:
    """f of the full windows of n values (first values, and deviations from them) over whole columns."""

    def run(*columns: np.ndarray) -> tuple[np.ndarray, ...]:
        size = len(columns[0])
        if size < n:
            return tuple(np.full(size, np.nan) for _ in range(2))
        views = [np.lib.stride_tricks.sliding_window_view(c, n) for c in columns]
        with np.errstate(all="ignore"):
            got = f(*[(v[:, 0], v - v[:, :1]) for v in views])
        return tuple(np.concatenate((np.full(n - 1, np.nan), g)) for g in got)

    return run


def centred(d: np.ndarray) -> np.ndarray:
    return d - d.mean(1, keepdims=True)


def mean_var(x) -> tuple[np.ndarray, np.ndarray]:
    """Mean, and variance of a sample."""
    c = centred(x[1])
    return x[0] + x[1].mean(1), (c * c).sum(1) / (c.shape[1] - 1)


def line_fit(y, x) -> tuple[np.ndarray, np.ndarray]:
    """Slope of y over x, and the fit's share of y's variance, 1 where y doesn't vary."""
    a, b = centred(y[1]), centred(x[1])
    xx, xy, yy = (b * b).sum(1), (a * b).sum(1), (a * a).sum(1)
    xx = np.where(xx > 0, xx, np.nan)
    return xy / xx, np.where(yy == 0, np.where(np.isnan(xx), np.nan, 1.0), xy * xy / (xx * yy))


def skew_kurtosis(x) -> tuple[np.ndarray, np.ndarray]:
    """Moment coefficients of the population; none where x doesn't vary."""
    c, n = centred(x[1]), x[1].shape[1]
    c2 = c * c
    m2 = np.where((x[1] != 0).any(1), c2.sum(1), np.nan)
    return math.sqrt(n) * (c2 * c).sum(1) / np.sqrt(m2**3), n * (c2 * c2).sum(1) / m2**2 - 3


def correlation(y, x) -> tuple[np.ndarray]:
    """Null where the product of the deviations is 1e-12 or less."""
    a, b = centred(y[1]), centred(x[1])
    sd = np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)) / (a.shape[1] - 1)
    return (np.where(sd > 1e-12, (a * b).sum(1) / (a.shape[1] - 1) / sd, np.nan),)


def returns(bars: DataFrame) -> DataFrame:
    out = {f"ret_{n}": pct_dist("close", lag("close", n)) for n in RETURNS}
    return _out(bars, out | {"mom_12_1": pct_dist(lag("close", 21), lag("close", 252)), "mom_6_1": pct_dist(lag("close", 21), lag("close", 126))})


def sma_stack(bars: DataFrame) -> DataFrame:
    """Distances to moving averages, their slopes and order."""
    sma = {n: f"sma{n}" for n in (10, 20, 50, 100, 150, 200)}
    df = bars.withColumns({v: rolling("mean", "close", n) for n, v in sma.items()})
    out = {f"dist_sma{n}": pct_dist("close", v) for n, v in sma.items()}
    out |= {f"slope_sma{n}": pct_dist(sma[n], lag(sma[n], k)) / k for n, k in ((20, 5), (50, 10), (150, 20), (200, 20))}
    above = lambda a, b: F.round(F.col(a) - F.col(b), 8) > 0  # noqa: E731  equal means are equal, whatever the order of a sum leaves
    steps = [("close", "sma20"), ("sma20", "sma50"), ("sma50", "sma150"), ("sma150", "sma200")]
    out["sma50_gt_sma200"] = flag(above("sma50", "sma200"))
    out["stack_up"] = flag(reduce(and_, [above(a, b) for a, b in steps]))
    out["stack_down"] = flag(reduce(and_, [above(b, a) for a, b in steps]))
    return _out(df, out)


def bollinger(bars: DataFrame) -> DataFrame:
    df = moments(bars.select("symbol", "date", "close"), **{f"w{n}": (("close",), mean_var, n, f"m{n} v{n}") for n in (20, 50)})
    out = {}
    for n, dev in ((20, 2), (50, 2), (20, 1)):
        mid, sd = F.col(f"m{n}"), F.sqrt(F.col(f"v{n}") * (n - 1) / n)  # population deviation
        low, high = mid - dev * sd, mid + dev * sd
        out[f"bb_pctb_{n}_{dev}"] = safe_div(F.col("close") - low, high - low)
        out[f"bb_width_{n}_{dev}"] = 100 * safe_div(high - low, mid)
    return _out(df, out)


def donchian(bars: DataFrame) -> DataFrame:
    df = bars.withColumns({f"{x}{n}": rolling(how, y, n) for n in (10, 20, 55) for x, how, y in (("dh", "max", "high"), ("dl", "min", "low"))})
    out = {f"donch_pos_{n}": safe_div(F.col("close") - F.col(f"dl{n}"), F.col(f"dh{n}") - F.col(f"dl{n}")) for n in (10, 20, 55)}
    out |= {f"donch_break_{n}": flag(F.col("close") > lag(f"dh{n}")) - flag(F.col("close") < lag(f"dl{n}")) for n in (10, 20, 55)}
    return _out(df, out)


def log_return(df: DataFrame) -> DataFrame:
    return df.withColumn("lr", F.ln(safe_div("close", lag("close"))))


def historic_volatility(bars: DataFrame) -> DataFrame:
    df = log_return(bars)
    out = {f"hv_{n}": rolling("std", "lr", n, int(n * 0.8)) * math.sqrt(252) * 100 for n in (10, 20, 60, 252)}
    return _out(df, out | {"hv_ratio_10_60": safe_div(out["hv_10"], out["hv_60"])})


def _rank_last(x: str, n: int, least: int) -> F.Column:
    """Rank of the current value in its frame as a share, ties sharing their mean rank."""
    f = F.collect_list(x).over(frame(n))  # n values at most
    now = F.col(x)
    less, same = F.size(F.filter(f, lambda v: v < now)), F.size(F.filter(f, lambda v: v == now))
    return F.when((F.size(f) >= least) & now.isNotNull(), (less + (same + 1) / 2) / F.size(f))


def percentile_ranks(bars: DataFrame) -> DataFrame:
    w = bars.withColumn("bw", rolling("std", "close", 20) / rolling("mean", "close", 20))
    return _out(w.withColumn("bw", F.round("bw", 10)), {"price_pctile_252": _rank_last("close", 252, 200), "width_pctile_120": _rank_last("bw", 120, 60)})


def days_since_extremes(bars: DataFrame) -> DataFrame:
    """Bars since the 252-bar high and low; of equal ones the first counts."""
    n = 252

    def since(x: str, pick) -> F.Column:
        f = F.collect_list(x).over(frame(n))
        return F.when(F.size(f) == n, n - F.array_position(f, pick(f))).cast("double")

    return _out(bars, {"days_since_52w_high": since("high", F.array_max), "days_since_52w_low": since("low", F.array_min)})


def with_bench(bars: DataFrame, bench: DataFrame) -> DataFrame:
    """The benchmark on the symbol's own dates, the last known one carried forward; bench has a row a session."""
    df = bars.join(F.broadcast(bench), "date", "left")
    return df.withColumn("bench", F.last("bench", ignorenulls=True).over(so_far()))


def beta_and_corr(n: int) -> Callable[..., tuple[np.ndarray, ...]]:
    """Slope of y over x and their correlation over the last n rows, with at least 0.8 n pairs; null where x (or either side) doesn't vary."""

    def run(y: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
        windows = lambda v: np.lib.stride_tricks.sliding_window_view(np.concatenate((np.full(n - 1, np.nan), v)), n)
        ys, xs = windows(y), windows(x)
        both, xk = ~(np.isnan(ys) | np.isnan(xs)), ~np.isnan(xs)
        pairs, known = both.sum(1), xk.sum(1)

        def apart(v: np.ndarray, where: np.ndarray, count: np.ndarray) -> np.ndarray:
            mean = np.where(where, v, 0.0).sum(1) / count
            return np.where(where, v - mean[:, None], 0.0)

        with np.errstate(all="ignore"):
            a, b, c = apart(ys, both, pairs), apart(xs, both, pairs), apart(xs, xk, known)
            covar, var = (a * b).sum(1) / (pairs - 1), (c * c).sum(1) / (known - 1)
            sd = np.sqrt((a * a).sum(1) / (pairs - 1)) * np.sqrt((b * b).sum(1) / (pairs - 1))
            enough = pairs >= int(0.8 * n)
            return np.where(enough & (var > 1e-12), covar / var, np.nan), np.where(enough & (sd > 1e-12), covar / sd, np.nan)

    return run


def beta_corr(bars: DataFrame, bench: DataFrame) -> DataFrame:
    df = with_bench(bars, bench)
    df = df.select("symbol", "date", (100 * (safe_div("bench", lag("bench")) - 1)).alias("x"), (100 * (safe_div("close", lag("close")) - 1)).alias("y"))
    kernels = {n: beta_and_corr(n) for n in (60, 250)}
    columns = {f"{name}_{n}": Kernel(("y", "x"), kernels[n], i) for n in kernels for i, name in enumerate(("beta", "corr"))}
    return _out(recursions(df, columns, list(columns)), {c: F.col(c) for c in columns})


def relative_strength(bars: DataFrame, bench: DataFrame) -> DataFrame:
    """Mansfield strength, excess returns and the rotation quadrant against the benchmark."""
    df = with_bench(bars, bench).withColumn("rs", safe_div("close", "bench"))
    df = df.withColumns({"rr": 100 * safe_div("rs", rolling("mean", "rs", 50)), "rs250": rolling("mean", "rs", 250)}).withColumn("rm", 100 * safe_div("rr", lag("rr", 10)))
    df = df.withColumns({"rr": F.round("rr", 6), "rm": F.round("rm", 6)})
    high = (F.col("rr") > 100), (F.col("rm") > 100)
    quadrant = F.when(high[0] & high[1], 2.0).when(high[0], 1.0).when(high[1], -1.0).otherwise(-2.0)
    out = {"mansfield_rs": pct_dist("rs", "rs250"), "rrg_ratio": F.col("rr"), "rrg_momentum": F.col("rm"), "rrg_quadrant": quadrant}
    out |= {f"excess_ret_{n}": pct_dist("close", lag("close", n)) - pct_dist("bench", lag("bench", n)) for n in (21, 63, 126, 252)}
    return _out(df, out)


def linear_regression(bars: DataFrame) -> DataFrame:
    """Slope (percent a bar) and fit of the log price against time."""
    df = bars.select("symbol", "date", F.ln("close").alias("y"), F.col("t").cast("double").alias("x"))
    df = moments(df, **{f"w{n}": (("y", "x"), line_fit, n, f"slope{n} fit{n}") for n in (50, 100, 200)})
    return _out(df, {k: v for n in (50, 100, 200) for k, v in ((f"linreg_slope_{n}", 100 * F.col(f"slope{n}")), (f"linreg_r2_{n}", F.col(f"fit{n}")))})


def skew_kurt(bars: DataFrame, n: int = 60) -> DataFrame:
    """Bias-corrected moments of log returns and their first autocorrelation."""
    df = log_return(bars).withColumn("lr1", lag("lr")).select("symbol", "date", "lr", "lr1")
    df = moments(df, own=(("lr",), skew_kurtosis, n, "g1 g2"), auto=(("lr", "lr1"), correlation, n, "auto"))
    skew = math.sqrt(n * (n - 1)) / (n - 2) * F.col("g1")
    kurt = (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * F.col("g2") + 6)
    return _out(df, {"skew_60": skew, "kurt_60": kurt, "autocorr1_60": F.col("auto")})


def max_drawdown(bars: DataFrame) -> DataFrame:
    """The deepest fall from a running high within 60 bars, in percent."""
    f = F.collect_list("close").over(frame(60))
    state = F.struct(F.lit(0.0).alias("peak"), F.lit(0.0).alias("worst"))
    step = lambda s, v: F.struct(F.greatest(s["peak"], v).alias("peak"), F.least(s["worst"], v / F.greatest(s["peak"], v) - 1).alias("worst"))
    return _out(bars, {"maxdd_60": F.when(F.size(f) >= 48, 100 * F.aggregate(f, state, step, lambda s: s["worst"]))})


def alma(bars: DataFrame, n: int = 9, offset: float = 0.85, sigma: float = 6.0) -> DataFrame:
    weights = [math.exp(-((i - offset * (n - 1)) ** 2) / (2 * (n / sigma) ** 2)) for i in range(n)]
    total = sum(weights)
    x = sum((F.lit(w / total) * lag("close", n - 1 - i) for i, w in enumerate(weights)), F.lit(0.0))
    return _out(bars, {"alma9": x, "dist_alma9": pct_dist("close", x)})


def connors_rank(bars: DataFrame) -> DataFrame:
    """Share of the previous 100 daily returns below today's, in percent."""
    df = bars.withColumn("ret", F.round(safe_div("close", lag("close")) - 1, 12))
    f = F.collect_list("ret").over(frame(101))
    return _out(df, {"connors_rank": F.when(F.size(f) == 101, F.size(F.filter(F.slice(f, 1, 100), lambda v: v < F.col("ret"))).cast("double"))})


def highs_lows(bars: DataFrame) -> DataFrame:
    """52-week and all-time extremes."""
    df = bars.withColumns({"hi": rolling("max", "high", 252, 200), "lo": rolling("min", "low", 252, 200), "ath": F.max("high").over(so_far())})
    return _out(
        df,
        {
            "dist_52w_high": pct_dist("close", "hi"), "dist_52w_low": pct_dist("close", "lo"), "pos_52w_range": safe_div(F.col("close") - F.col("lo"), F.col("hi") - F.col("lo")),
            "new_52w_high": flag(F.col("high") >= F.col("hi")), "new_52w_low": flag(F.col("low") <= F.col("lo")), "dist_multi_year_high": pct_dist("close", "ath"),
        },
    )


def anchored_vwap(bars: DataFrame) -> DataFrame:
    """Volume-weighted price since the year's first bar."""
    year = Window.partitionBy("symbol", F.year("date")).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    tp = (F.col("high") + F.col("low") + F.col("close")) / 3
    return _out(bars, {"avwap_ytd": safe_div(F.sum(tp * F.col("volume")).over(year), F.sum("volume").over(year)), "dist_avwap_ytd": pct_dist("close", safe_div(F.sum(tp * F.col("volume")).over(year), F.sum("volume").over(year)))})


def run_lengths(bars: DataFrame) -> DataFrame:
    """Signed age of the 10/30 average cross, from 0, and signed streaks of up and down closes."""
    df = bars.withColumns({"d": F.signum(F.round(rolling("mean", "close", 10) - rolling("mean", "close", 30), 8)), "s": F.signum(F.col("close") - lag("close"))})
    df = df.withColumns({"_cross": F.sum((~F.col("d").eqNullSafe(lag("d"))).cast("int")).over(so_far()), "_streak": F.sum((~F.col("s").eqNullSafe(lag("s"))).cast("int")).over(so_far())})
    place = lambda c: F.row_number().over(Window.partitionBy("symbol", c).orderBy("date"))
    return _out(df, {"cross_age": F.least(place("_cross") - 1, F.lit(500)) * F.col("d"), "updown_streak": F.coalesce(place("_streak") * F.col("s"), F.lit(0.0))})


def calendar(bars: DataFrame) -> DataFrame:
    """Month, weekday, day, place of the session in its month, business days left in it, results season."""
    month = Window.partitionBy("symbol", F.trunc("date", "MM")).orderBy("date")
    left = F.size(F.filter(F.sequence(F.date_add("date", 1), F.date_add(F.last_day("date"), 1)), lambda d: (F.weekday(d) < 5) & (d <= F.last_day("date"))))
    md = F.month("date") * 100 + F.dayofmonth("date")
    season = md.between(110, 215) | md.between(410, 520) | md.between(710, 815) | md.between(1010, 1115)
    return bars.select(
        "symbol", "date", F.month("date").alias("cal_month"), F.weekday("date").alias("cal_weekday"), F.dayofmonth("date").alias("cal_dom"), F.row_number().over(month).alias("cal_tdom"),
        left.alias("cal_tdays_to_mend"), season.cast("int").alias("cal_results_season"),
    )


def fresh_breaks(bars: DataFrame) -> DataFrame:
    """Closes above the previous 50-bar high that no bar of the last 20 had."""
    df = bars.withColumn("hit", flag(F.col("close") > F.max("high").over(by_symbol().rowsBetween(-50, -1))))
    before = F.coalesce(F.max("hit").over(by_symbol().rowsBetween(-20, -1)), F.lit(0.0))
    return df.select("symbol", "date", "close", (F.col("hit") * (before == 0).cast("double")).alias("fresh")).filter("fresh > 0").drop("fresh")


def relative_vigor(bars: DataFrame, n: int = 10) -> DataFrame:
    sym = lambda x: col_sum(x)
    df = bars.withColumns({"body": F.col("close") - F.col("open"), "range": F.col("high") - F.col("low")})
    df = df.withColumns({"num": sym("body"), "den": sym("range")})
    df = df.withColumn("rvi", safe_div(rolling("mean", "num", n), rolling("mean", "den", n)))
    return _out(df, {"rvgi": F.col("rvi"), "rvgi_minus_sig": F.col("rvi") - col_sum("rvi") / 6})


def col_sum(x: str) -> F.Column:
    """x + 2 * the last two + the third last."""
    return F.col(x) + 2 * lag(x, 1) + 2 * lag(x, 2) + lag(x, 3)


def ichimoku(bars: DataFrame) -> DataFrame:
    mid = lambda n: (rolling("max", "high", n) + rolling("min", "low", n)) / 2
    df = bars.withColumns({"tenkan": mid(9), "kijun": mid(26), "span_b_now": mid(52)}).withColumn("span_a_now", (F.col("tenkan") + F.col("kijun")) / 2)
    df = df.withColumns({"span_a": lag("span_a_now", 25), "span_b": lag("span_b_now", 25)})
    top, bottom = F.greatest("span_a", "span_b"), F.least("span_a", "span_b")
    both = F.col("span_a").isNotNull() & F.col("span_b").isNotNull()
    top, bottom = F.when(both, top), F.when(both, bottom)
    return _out(
        df,
        {
            "tk_diff": F.col("tenkan") - F.col("kijun"), "close_kijun": F.col("close") - F.col("kijun"), "above_cloud": F.col("close") - top, "below_cloud": bottom - F.col("close"),
            "in_cloud": flag((F.col("close") <= top) & (F.col("close") >= bottom)), "cloud_thick_pct": 100 * safe_div(top - bottom, "close"),
            "future_cloud_bull": flag(F.col("span_a_now") > F.col("span_b_now")), "chikou": pct_dist("close", lag("close", 25)),
        },
    )


def true_range(prev: F.Column | None = None) -> F.Column:
    prev = lag("close") if prev is None else prev
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev), F.abs(F.col("low") - prev))


def squeeze(bars: DataFrame) -> DataFrame:
    """Whether the Bollinger band lies within a channel of the mean true range, and for how many bars, from 0."""
    df = bars.withColumn("tr", true_range())
    mid, sd = rolling("mean", "close", 20), F.sqrt(rolling("var", "close", 20) * 19 / 20)
    df = df.withColumn("on", flag(2 * sd < 1.5 * rolling("mean", "tr", 20)))
    df = df.withColumn("_i", F.sum((~F.col("on").eqNullSafe(lag("on"))).cast("int")).over(so_far()))
    length = (F.row_number().over(Window.partitionBy("symbol", "_i").orderBy("date")) - 1) * F.col("on")
    return _out(df.withColumn("mid", mid), {"squeeze_on": F.col("on"), "squeeze_len": length})


def kst(bars: DataFrame) -> DataFrame:
    roc = {n: f"roc{n}" for n in (10, 15, 20, 30)}
    df = bars.withColumns({v: pct_dist("close", lag("close", n)) for n, v in roc.items()})
    df = df.withColumn("kst", sum((w * rolling("mean", f"roc{n}", k) for n, k, w in ((10, 10, 1), (15, 10, 2), (20, 10, 3), (30, 15, 4))), F.lit(0.0)))
    return _out(df, {"kst": F.col("kst"), "kst_minus_sig": F.col("kst") - rolling("mean", "kst", 9)})


def range_volatility(bars: DataFrame, n: int = 20) -> DataFrame:
    """Parkinson, Garman-Klass, Rogers-Satchell and Yang-Zhang volatility, ulcer and choppiness."""
    ln = lambda a, b: F.ln(safe_div(a, b))
    df = bars.withColumns({"hl": ln("high", "low"), "co": ln("close", "open"), "oc": ln("open", lag("close")), "hc": ln("high", "close"), "ho": ln("high", "open"), "lc": ln("low", "close"), "lo": ln("low", "open")})
    df = df.withColumns({
        "pk": F.col("hl") * F.col("hl"), "gk": 0.5 * F.col("hl") * F.col("hl") - (2 * math.log(2) - 1) * F.col("co") * F.col("co"), "rs": F.col("hc") * F.col("ho") + F.col("lc") * F.col("lo"),
        "tr": true_range(), "dd": F.pow(100 * (F.col("close") / rolling("max", "close", 14) - 1), 2),
    })
    year = lambda x: F.sqrt(F.greatest(x, F.lit(0.0)) * 252) * 100
    k = 0.34 / (1.34 + (n + 1) / (n - 1))
    yz = rolling("var", "oc", n) + k * rolling("var", "co", n) + (1 - k) * rolling("mean", "rs", n)
    keep = lambda guard, x: F.when(guard.isNotNull(), x)
    full = rolling("mean", "pk", n)
    chop = 100 * F.log10(safe_div(rolling("sum", "tr", 14), rolling("max", "high", 14) - rolling("min", "low", 14))) / math.log10(14)
    return _out(df, {"vol_parkinson_20": keep(full, year(full / (4 * math.log(2)))), "vol_garman_klass_20": keep(full, year(rolling("mean", "gk", n))), "vol_rogers_satchell_20": keep(full, year(rolling("mean", "rs", n))), "vol_yang_zhang_20": keep(rolling("var", "oc", n), year(yz)), "ulcer_14": F.sqrt(rolling("mean", "dd", 14)), "chop_14": chop})


def variance_ratio(bars: DataFrame) -> DataFrame:
    df = log_return(bars)
    df = df.withColumn("lr10", F.when(lag("close", 10).isNotNull(), F.ln(safe_div("close", lag("close", 10)))))
    df = moments(df.select("symbol", "date", "lr", "lr10"), **{x: ((x,), mean_var, 120, f"{x}_mean {x}_var") for x in ("lr", "lr10")})
    vr = safe_div("lr10_var", 10 * F.col("lr_var"))
    return _out(df, {"variance_ratio_10": vr, "hurst_vr": 0.5 + 0.5 * F.ln(F.when(vr.isNotNull(), F.greatest(vr, F.lit(1e-6)))) / math.log(10)})


def pivots(bars: DataFrame, period: str) -> DataFrame:
    """Pivot levels of the previous week or month that the symbol traded in; one aggregation, lag, and a join back."""
    key = week_end("date") if period == "week" else F.trunc("date", "MM")
    df = bars.withColumn("_p", key)
    agg = df.groupBy("symbol", "_p").agg(F.max("high").alias("h"), F.min("low").alias("l"), F.max_by("close", "date").alias("c"))
    w = Window.partitionBy("symbol").orderBy("_p")
    agg = agg.select("symbol", "_p", *[F.lag(x).over(w).alias(x) for x in "hlc"])
    p, rng = (F.col("h") + F.col("l") + F.col("c")) / 3, F.col("h") - F.col("l")
    out = {"p": p, "r1": 2 * p - F.col("l"), "s1": 2 * p - F.col("h"), "ch4": F.col("c") + 1.1 * rng / 2, "cl4": F.col("c") - 1.1 * rng / 2}
    return _out(df.join(agg, ["symbol", "_p"]), out)


def gap_drift(bars: DataFrame, least_atr: float = 1.5, least_volume: float = 3.0) -> DataFrame:
    """Days since the last large opening gap on heavy volume (60 at most), its direction and size, and the return since."""
    df = bars.withColumns({"tr": true_range(), "prev": lag("close"), "vr": safe_div("volume", rolling("mean", "volume", 50))}).withColumn("atr", lag(rolling("mean", "tr", 14)))
    df = df.withColumn("gap", F.round(safe_div(F.col("open") - F.col("prev"), "atr"), 8))
    big = (F.abs("gap") >= least_atr) & (F.round("vr", 8) >= least_volume)
    df = df.withColumn("e", F.when(big, F.struct("t", "gap", F.col("prev").alias("c"))))
    df = df.withColumn("e", F.last("e", ignorenulls=True).over(by_symbol().rowsBetween(-60, 0)))
    return _out(df, {"evgap_days_since": F.col("t") - F.col("e.t"), "evgap_dir": F.signum("e.gap"), "evgap_size_atr": F.col("e.gap"), "evgap_ret_since": pct_dist("close", "e.c")})


def candle_parts(bars: DataFrame) -> DataFrame:
    """Two-bar and range candles, and body and shadows as shares of the range."""
    o, h, lo, c = (F.col(x) for x in ("open", "high", "low", "close"))
    rng, body = h - lo, F.abs(c - o)
    up, dn = h - F.greatest(o, c), F.least(o, c) - lo
    df = bars.withColumn("rng", F.round(rng, 2))
    outside = (h > lag("high")) & (lo < lag("low"))
    least_body = F.greatest(body, F.lit(1e-9))
    return _out(
        df,
        {
            "inside_bar": flag((h <= lag("high")) & (lo >= lag("low"))), "outside_bull": flag(outside & (c > lag("high"))), "outside_bear": flag(outside & (c < lag("low"))),
            "pin_bull": flag((dn >= 2 * least_body) & (dn >= 0.6 * rng) & (up <= 0.2 * rng)), "pin_bear": flag((up >= 2 * least_body) & (up >= 0.6 * rng) & (dn <= 0.2 * rng)),
            "nr4": flag(F.col("rng") <= rolling("min", "rng", 4)), "nr7": flag(F.col("rng") <= rolling("min", "rng", 7)), "wr7": flag(F.col("rng") >= rolling("max", "rng", 7)), "ibs": safe_div(c - lo, rng),
        },
    )


def volume_features(bars: DataFrame) -> DataFrame:
    df = bars.withColumns({"up": F.when(F.col("close") > lag("close"), F.col("volume")).otherwise(0.0), "down": F.when(F.col("close") < lag("close"), F.col("volume")).otherwise(0.0), "pct": 100 * safe_div("deliv_qty", "volume"), "tp": (F.col("high") + F.col("low") + F.col("close")) / 3})
    df = df.withColumn("tpv", F.col("tp") * F.col("volume"))
    out = {f"vol_ratio_{n}": safe_div("volume", rolling("mean", "volume", n)) for n in (20, 50)}
    out |= {f"updown_vol_{n}": safe_div(rolling("sum", "up", n), rolling("sum", "down", n)) for n in (20, 50)}
    out |= {"vol_dryup_10_50": safe_div(rolling("mean", "volume", 10), rolling("mean", "volume", 50)), "deliv_pct": F.col("pct"), "deliv_pct_5": rolling("mean", "pct", 5, 3), "deliv_pct_20": rolling("mean", "pct", 20, 10)}
    out |= {f"dist_vwap_{n}": pct_dist("close", safe_div(rolling("sum", "tpv", n), rolling("sum", "volume", n))) for n in (20, 50)}
    out["trades_ratio_20"] = safe_div("trades", rolling("mean", "trades", 20, 10))
    return _out(df, out)


