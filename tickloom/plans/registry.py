"""Queries over the test tables, by operator, and the same results in SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.exprs import r6
from tickloom.functions.sqltext import S, dist, div, flag, lag, r, roll
from tickloom.operators import windows as W
from tickloom.sources import bars as B

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, bars: bool = True, dates: tuple[str, ...] = ("date",)):
    """Registers a query; sql follows the common tables (b: bars, u: universe, m: benchmark) if bars is true. Dates become text."""

    def add(f):
        def run(spark, sf_dir):
            df = f(spark, sf_dir)
            return df.withColumns({c: F.col(c).cast("string") for c, t in df.dtypes if t == "date"})

        QUERIES[name] = run
        if sql is not None:
            sql_ = (B.BARS_SQL if bars else "") + sql
            ORACLE_SQL[name] = f"SELECT * REPLACE ({', '.join(f'CAST({d} AS VARCHAR) AS {d}' for d in dates)}) FROM ({sql_})" if dates else sql_
        return f

    return add


def cols(d: dict[str, str], keys: str = "symbol, date") -> str:
    return keys + ", " + ", ".join(f"{r(e)} AS {n}" for n, e in d.items())


# ---- windows ----------------------------------------------------------------------------------------------------
def simple(name: str, f: Callable[[DataFrame], DataFrame], sql: str | None) -> None:
    query(name, sql)(lambda spark, sf: f(B.walk(spark, sf)))


simple("w1_returns", W.returns, "SELECT " + cols({f"ret_{n}": dist("close", lag("close", n)) for n in W.RETURNS} | {"mom_12_1": dist(lag("close", 21), lag("close", 252)), "mom_6_1": dist(lag("close", 21), lag("close", 126))}) + " FROM b")
SMA = ", x AS (SELECT *, " + ", ".join(f"{roll('mean', 'close', n)} AS sma{n}" for n in (10, 20, 50, 100, 150, 200)) + " FROM b)"
simple(
    "w2_sma_stack", W.sma_stack,
    SMA + " SELECT " + cols({f"dist_sma{n}": dist("close", f"sma{n}") for n in (10, 20, 50, 100, 150, 200)} | {f"slope_sma{n}": f"{dist(f'sma{n}', lag(f'sma{n}', k))} / {k}" for n, k in ((20, 5), (50, 10), (150, 20), (200, 20))}
    | {"sma50_gt_sma200": flag("sma50 > sma200"), "stack_up": flag("close > sma20 AND sma20 > sma50 AND sma50 > sma150 AND sma150 > sma200"), "stack_down": flag("close < sma20 AND sma20 < sma50 AND sma50 < sma150 AND sma150 < sma200")}) + " FROM x",
)
simple(
    "w2_bbands", W.bollinger,
    ", x AS (SELECT *, " + ", ".join(f"{roll('mean', 'close', n)} AS m{n}, sqrt(({roll('var', 'close', n)}) * {n - 1} / {n}) AS s{n}" for n in (20, 50)) + " FROM b) SELECT "
    + cols({f"bb_pctb_{n}_{k}": div(f"close - (m{n} - {k} * s{n})", f"(m{n} + {k} * s{n}) - (m{n} - {k} * s{n})") for n, k in ((20, 2), (50, 2), (20, 1))} | {f"bb_width_{n}_{k}": f"100 * {div(f'(m{n} + {k} * s{n}) - (m{n} - {k} * s{n})', f'm{n}')}" for n, k in ((20, 2), (50, 2), (20, 1))}) + " FROM x",
)
simple(
    "w2_donchian", W.donchian,
    ", x AS (SELECT *, " + ", ".join(f"{roll('max', 'high', n)} AS dh{n}, {roll('min', 'low', n)} AS dl{n}" for n in (10, 20, 55)) + " FROM b) SELECT "
    + cols({f"donch_pos_{n}": div(f"close - dl{n}", f"dh{n} - dl{n}") for n in (10, 20, 55)} | {f"donch_break_{n}": f"({flag(f'close > {lag(f'dh{n}')}')}) - ({flag(f'close < {lag(f'dl{n}')}')})" for n in (10, 20, 55)}) + " FROM x",
)
LR = f", x AS (SELECT *, ln({div('close', lag('close'))}) AS lr FROM b)"
simple("w2_hist_vol", W.historic_volatility, LR + ", y AS (SELECT *, " + ", ".join(f"({roll('std', 'lr', n, int(n * 0.8))}) * sqrt(252) * 100 AS hv_{n}" for n in (10, 20, 60, 252)) + " FROM x) SELECT " + cols({f"hv_{n}": f"hv_{n}" for n in (10, 20, 60, 252)} | {"hv_ratio_10_60": div("hv_10", "hv_60")}) + " FROM y")


def pctile(x: str, n: int, least: int, table: str) -> str:
    """Rank of each value among its last n by a join on bar numbers."""
    return f"(SELECT a.symbol, a.date, CASE WHEN count(c.{x}) >= {least} AND a.{x} IS NOT NULL THEN (count(*) FILTER (WHERE c.{x} < a.{x}) + (count(*) FILTER (WHERE c.{x} = a.{x}) + 1) / 2.0) / count(c.{x}) END AS v FROM {table} a JOIN {table} c ON c.symbol = a.symbol AND c.t BETWEEN a.t - {n - 1} AND a.t GROUP BY a.symbol, a.date, a.{x})"


simple("w4_pctile_252", W.percentile_ranks, f", x AS MATERIALIZED (SELECT *, round(({roll('std', 'close', 20)}) / ({roll('mean', 'close', 20)}), 10) AS bw FROM b) SELECT p.symbol, p.date, round(p.v, 6) AS price_pctile_252, round(w.v, 6) AS width_pctile_120 FROM {pctile('close', 252, 200, 'x')} p JOIN {pctile('bw', 120, 60, 'x')} w USING (symbol, date)")


def since(x: str, how: str) -> str:
    w = f"({S} ROWS BETWEEN 251 PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {w} = 252 THEN t - {how}(t, {x}) OVER {w} END"


simple("w5_days_since_52w", W.days_since_extremes, f"SELECT symbol, date, ({since('high', 'arg_max')})::DOUBLE AS days_since_52w_high, ({since('low', 'arg_min')})::DOUBLE AS days_since_52w_low FROM b")


def with_m(name: str, f, sql: str) -> None:
    def run(spark, sf):
        bars = B.walk(spark, sf)
        return f(bars, B.benchmark(bars))

    query(name, sql)(run)


def fr(f: str, n: int) -> str:
    return f"{f} OVER ({S} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


BM = ", bm AS (SELECT b.*, bench FROM b JOIN m USING (date))"
with_m(
    "w6_beta_corr", W.beta_corr,
    BM + f", x AS (SELECT *, 100 * (({div('bench', lag('bench'))}) - 1) AS bx, 100 * (({div('close', lag('close'))}) - 1) AS y FROM bm) SELECT "
    + cols({k: v for n in (60, 250) for k, v in {f"beta_{n}": f"CASE WHEN {fr('count(bx)', n)} >= {int(0.8 * n)} THEN {fr('covar_samp(y, bx)', n)} / {fr('var_samp(bx)', n)} END", f"corr_{n}": f"CASE WHEN {fr('count(bx)', n)} >= {int(0.8 * n)} THEN {fr('corr(y, bx)', n)} END"}.items()}) + " FROM x",
)
with_m(
    "sig_rs_rrg", W.relative_strength,
    BM + f", x AS (SELECT *, {div('close', 'bench')} AS rs FROM bm), y AS (SELECT *, round(100 * {div('rs', roll('mean', 'rs', 50))}, 6) AS rr, {roll('mean', 'rs', 250)} AS rs250, 100 * {div('rs', roll('mean', 'rs', 50))} AS rr0 FROM x)"
    + f", z AS (SELECT *, round(100 * {div('rr0', lag('rr0', 10))}, 6) AS rm FROM y) SELECT "
    + cols({"mansfield_rs": dist("rs", "rs250"), "rrg_ratio": "rr", "rrg_momentum": "rm", "rrg_quadrant": "CASE WHEN rr > 100 AND rm > 100 THEN 2.0 WHEN rr > 100 THEN 1.0 WHEN rm > 100 THEN -1.0 ELSE -2.0 END"} | {f"excess_ret_{n}": f"{dist('close', lag('close', n))} - {dist('bench', lag('bench', n))}" for n in (21, 63, 126, 252)}) + " FROM z",
)
with_m("j1_bench_align", lambda bars, m: W.with_bench(bars, m).select("symbol", "date", F.round("bench", 6).alias("bench")), BM + " SELECT symbol, date, round(bench, 6) AS bench FROM bm")
simple("w7_linreg", W.linear_regression, ", x AS (SELECT *, ln(close) AS y, t::DOUBLE AS tt FROM b) SELECT " + cols({k: v for n in (50, 100, 200) for k, v in {f"linreg_slope_{n}": f"CASE WHEN {fr('count(y)', n)} >= {n} THEN 100 * {fr('regr_slope(y, tt)', n)} END", f"linreg_r2_{n}": f"CASE WHEN {fr('count(y)', n)} >= {n} THEN {fr('regr_r2(y, tt)', n)} END"}.items()}) + " FROM x")
simple("w8_skew_kurt", W.skew_kurt, LR + f", y AS (SELECT *, {lag('lr')} AS lr1 FROM x) SELECT " + cols({"skew_60": f"CASE WHEN {fr('count(lr)', 60)} >= 60 THEN {fr('skewness(lr)', 60)} END", "kurt_60": f"CASE WHEN {fr('count(lr)', 60)} >= 60 THEN {fr('kurtosis(lr)', 60)} END", "autocorr1_60": f"CASE WHEN {fr('count(lr1)', 60)} >= 60 THEN {fr('corr(lr, lr1)', 60)} END"}) + " FROM y")
simple("w9_maxdd", W.max_drawdown, ", x AS (SELECT a.symbol, a.date, a.t, c.t AS ct, c.close AS c, max(c.close) OVER (PARTITION BY a.symbol, a.t ORDER BY c.t) AS peak FROM b a JOIN b c ON c.symbol = a.symbol AND c.t BETWEEN a.t - 59 AND a.t) SELECT symbol, date, " + r("CASE WHEN count(*) >= 48 THEN 100 * min(c / peak - 1) END") + " AS maxdd_60 FROM x GROUP BY symbol, date")
_w = [2.718281828459045 ** (-((i - 6.8) ** 2) / (2 * 1.5**2)) for i in range(9)]
_alma = " + ".join(f"{w / sum(_w)!r} * {lag('close', 8 - i)}" if i < 8 else f"{w / sum(_w)!r} * close" for i, w in enumerate(_w))
simple("w10_alma", W.alma, f", x AS (SELECT *, {_alma} AS a FROM b) SELECT " + cols({"alma9": "a", "dist_alma9": dist("close", "a")}) + " FROM x")
simple("w11_connors_rank", W.connors_rank, f", x AS MATERIALIZED (SELECT *, round(({div('close', lag('close'))}) - 1, 12) AS ret FROM b) SELECT a.symbol, a.date, CASE WHEN a.t >= 101 THEN count(*) FILTER (WHERE c.t < a.t AND c.ret < a.ret)::DOUBLE END AS connors_rank FROM x a JOIN x c ON c.symbol = a.symbol AND c.t BETWEEN a.t - 100 AND a.t GROUP BY a.symbol, a.date, a.t")
simple("w12_highs_lows", W.highs_lows, f", x AS (SELECT *, {roll('max', 'high', 252, 200)} AS hi, {roll('min', 'low', 252, 200)} AS lo, max(high) OVER ({S}) AS ath FROM b) SELECT " + cols({"dist_52w_high": dist("close", "hi"), "dist_52w_low": dist("close", "lo"), "pos_52w_range": div("close - lo", "hi - lo"), "new_52w_high": flag("high >= hi"), "new_52w_low": flag("low <= lo"), "dist_multi_year_high": dist("close", "ath")}) + " FROM x")
simple("w13_anchored_vwap", W.anchored_vwap, ", x AS (SELECT *, sum((high + low + close) / 3 * volume) OVER w / sum(volume) OVER w AS v FROM b WINDOW w AS (PARTITION BY symbol, year(date) ORDER BY date)) SELECT " + cols({"avwap_ytd": "v", "dist_avwap_ytd": dist("close", "v")}) + " FROM x")
simple(
    "w17_run_length", W.run_lengths,
    f", x AS (SELECT *, sign(round(({roll('mean', 'close', 10)}) - ({roll('mean', 'close', 30)}), 8)) AS d, sign(close - {lag('close')}) AS s FROM b), y AS (SELECT *, CASE WHEN d IS DISTINCT FROM {lag('d')} THEN 1 ELSE 0 END AS dc, CASE WHEN s IS DISTINCT FROM {lag('s')} THEN 1 ELSE 0 END AS sc FROM x), "
    f"z AS (SELECT *, sum(dc) OVER ({S}) AS di, sum(sc) OVER ({S}) AS si FROM y) SELECT " + cols({"cross_age": "least(row_number() OVER (PARTITION BY symbol, di ORDER BY date) - 1, 500) * d::DOUBLE", "updown_streak": "coalesce(row_number() OVER (PARTITION BY symbol, si ORDER BY date) * s::DOUBLE, 0.0)"}) + " FROM z",
)
simple(
    "w19_calendar", W.calendar,
    "SELECT symbol, date, month(date)::INT AS cal_month, (isodow(date) - 1)::INT AS cal_weekday, day(date)::INT AS cal_dom, row_number() OVER (PARTITION BY symbol, date_trunc('month', date) ORDER BY date)::INT AS cal_tdom, "
    "(SELECT count(*) FROM range(date::TIMESTAMP + INTERVAL 1 DAY, last_day(date)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY) r(d) WHERE isodow(d) < 6)::INT AS cal_tdays_to_mend, "
    "CASE WHEN month(date) * 100 + day(date) BETWEEN 110 AND 215 OR month(date) * 100 + day(date) BETWEEN 410 AND 520 OR month(date) * 100 + day(date) BETWEEN 710 AND 815 OR month(date) * 100 + day(date) BETWEEN 1010 AND 1115 THEN 1 ELSE 0 END AS cal_results_season FROM b",
)
simple("w22_fresh_break", W.fresh_breaks, f", x AS (SELECT *, CASE WHEN close > max(high) OVER ({S} ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS hit FROM b), y AS (SELECT *, coalesce(max(hit) OVER ({S} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), 0) AS old FROM x) SELECT symbol, date, close FROM y WHERE hit = 1 AND old = 0")
simple("n8_rvgi", W.relative_vigor, f", x AS (SELECT *, close - open AS body, high - low AS rng FROM b), y AS (SELECT *, body + 2 * {lag('body')} + 2 * {lag('body', 2)} + {lag('body', 3)} AS num, rng + 2 * {lag('rng')} + 2 * {lag('rng', 2)} + {lag('rng', 3)} AS den FROM x), z AS (SELECT *, {div(roll('mean', 'num', 10), roll('mean', 'den', 10))} AS r FROM y) SELECT " + cols({"rvgi": "r", "rvgi_minus_sig": f"r - (r + 2 * {lag('r')} + 2 * {lag('r', 2)} + {lag('r', 3)}) / 6"}) + " FROM z")
simple(
    "n22_ichimoku", W.ichimoku,
    ", x AS (SELECT *, " + ", ".join(f"(({roll('max', 'high', n)}) + ({roll('min', 'low', n)})) / 2 AS k{n}" for n in (9, 26, 52)) + f" FROM b), y AS (SELECT *, (k9 + k26) / 2 AS an FROM x), z AS (SELECT *, {lag('an', 25)} AS sa, {lag('k52', 25)} AS sb FROM y), "
    "v AS (SELECT *, CASE WHEN sa IS NOT NULL AND sb IS NOT NULL THEN greatest(sa, sb) END AS top, CASE WHEN sa IS NOT NULL AND sb IS NOT NULL THEN least(sa, sb) END AS bot FROM z) SELECT "
    + cols({"tk_diff": "k9 - k26", "close_kijun": "close - k26", "above_cloud": "close - top", "below_cloud": "bot - close", "in_cloud": flag("close <= top AND close >= bot"), "cloud_thick_pct": "100 * (top - bot) / close", "future_cloud_bull": flag("an > k52"), "chikou": dist("close", lag("close", 25))}) + " FROM v",
)
TR = f", tr AS (SELECT *, greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) AS tr FROM b)"
simple(
    "n23_squeeze", W.squeeze,
    TR + f", x AS (SELECT *, CASE WHEN 2 * sqrt(({roll('var', 'close', 20)}) * 19 / 20) < 1.5 * ({roll('mean', 'tr', 20)}) THEN 1.0 ELSE 0.0 END AS sq FROM tr), y AS (SELECT *, CASE WHEN sq IS DISTINCT FROM {lag('sq')} THEN 1 ELSE 0 END AS c FROM x), z AS (SELECT *, sum(c) OVER ({S}) AS i FROM y) "
    "SELECT symbol, date, sq::DOUBLE AS squeeze_on, ((row_number() OVER (PARTITION BY symbol, i ORDER BY date) - 1) * sq)::DOUBLE AS squeeze_len FROM z",
)
simple("n24_kst", W.kst, ", x AS (SELECT *, " + ", ".join(f"{dist('close', lag('close', n))} AS r{n}" for n in (10, 15, 20, 30)) + f" FROM b), y AS (SELECT *, ({roll('mean', 'r10', 10)}) + 2 * ({roll('mean', 'r15', 10)}) + 3 * ({roll('mean', 'r20', 10)}) + 4 * ({roll('mean', 'r30', 15)}) AS k FROM x) SELECT " + cols({"kst": "k", "kst_minus_sig": f"k - ({roll('mean', 'k', 9)})"}) + " FROM y")
_yr = lambda x: f"sqrt(greatest({x}, 0.0) * 252) * 100"
_k = 0.34 / (1.34 + 21 / 19)
simple(
    "n25_vol_estimators", W.range_volatility,
    TR + f", x AS (SELECT *, ln(high / low) AS hl, ln(close / open) AS co, ln(open / {lag('close')}) AS oc, ln(high / close) AS hc, ln(high / open) AS ho, ln(low / close) AS lc, ln(low / open) AS lo, pow(100 * (close / ({roll('max', 'close', 14)}) - 1), 2) AS dd FROM tr), "
    "y AS (SELECT *, hl * hl AS pk, 0.5 * hl * hl - (2 * ln(2) - 1) * co * co AS gk, hc * ho + lc * lo AS rs FROM x) SELECT "
    + cols({"vol_parkinson_20": f"CASE WHEN ({roll('mean', 'pk', 20)}) IS NOT NULL THEN {_yr(f'({roll("mean", "pk", 20)}) / (4 * ln(2))')} END", "vol_garman_klass_20": f"CASE WHEN ({roll('mean', 'gk', 20)}) IS NOT NULL THEN {_yr(roll('mean', 'gk', 20))} END", "vol_rogers_satchell_20": f"CASE WHEN ({roll('mean', 'rs', 20)}) IS NOT NULL THEN {_yr(roll('mean', 'rs', 20))} END",
            "vol_yang_zhang_20": f"CASE WHEN ({roll('var', 'oc', 20)}) IS NOT NULL THEN {_yr(f'({roll("var", "oc", 20)}) + {_k!r} * ({roll("var", "co", 20)}) + {1 - _k!r} * ({roll("mean", "rs", 20)})')} END",
            "ulcer_14": f"sqrt({roll('mean', 'dd', 14)})", "chop_14": f"100 * log10(({roll('sum', 'tr', 14)}) / (({roll('max', 'high', 14)}) - ({roll('min', 'low', 14)}))) / log10(14)"}) + " FROM y",
)
simple("n26_variance_ratio", W.variance_ratio, LR + f", y AS (SELECT *, ln(close / {lag('close', 10)}) AS lr10 FROM x), z AS (SELECT *, {div(roll('var', 'lr10', 120), f'10 * ({roll("var", "lr", 120)})')} AS vr FROM y) SELECT " + cols({"variance_ratio_10": "vr", "hurst_vr": "0.5 + 0.5 * ln(CASE WHEN vr IS NOT NULL THEN greatest(vr, 1e-6) END) / ln(10)"}) + " FROM z")
for _p, _key in (("week", "(date_trunc('week', date + INTERVAL 2 DAY) + INTERVAL 4 DAY)"), ("month", "date_trunc('month', date)")):
    query(
        f"n18_pivots_{_p}",
        f", x AS (SELECT *, {_key} AS p FROM b), g AS (SELECT symbol, p, max(high) AS h, min(low) AS l, arg_max(close, date) AS c FROM x GROUP BY 1, 2), k AS (SELECT symbol, p, lag(h) OVER w AS h, lag(l) OVER w AS l, lag(c) OVER w AS c FROM g WINDOW w AS (PARTITION BY symbol ORDER BY p)) SELECT "
        + cols({"p": "(h + l + c) / 3", "r1": "2 * (h + l + c) / 3 - l", "s1": "2 * (h + l + c) / 3 - h", "ch4": "c + 1.1 * (h - l) / 2", "cl4": "c - 1.1 * (h - l) / 2"}) + " FROM x JOIN k USING (symbol, p)",
    )(lambda spark, sf, p=_p: W.pivots(B.walk(spark, sf), p))
simple(
    "n27_candle_parts", W.candle_parts,
    ", x AS (SELECT *, round(high - low, 2) AS rng, greatest(abs(close - open), 1e-9) AS body, high - greatest(open, close) AS us, least(open, close) - low AS ls, " + f"{lag('high')} AS ph, {lag('low')} AS pl FROM b) SELECT "
    + cols({"inside_bar": flag("high <= ph AND low >= pl"), "outside_bull": flag("high > ph AND low < pl AND close > ph"), "outside_bear": flag("high > ph AND low < pl AND close < pl"), "pin_bull": flag("ls >= 2 * body AND ls >= 0.6 * (high - low) AND us <= 0.2 * (high - low)"), "pin_bear": flag("us >= 2 * body AND us >= 0.6 * (high - low) AND ls <= 0.2 * (high - low)"), "nr4": flag(f"rng <= ({roll('min', 'rng', 4)})"), "nr7": flag(f"rng <= ({roll('min', 'rng', 7)})"), "wr7": flag(f"rng >= ({roll('max', 'rng', 7)})"), "ibs": div("close - low", "high - low")}) + " FROM x",
)
simple(
    "sig_volume", W.volume_features,
    f", x AS (SELECT *, CASE WHEN close > {lag('close')} THEN volume ELSE 0.0 END AS up, CASE WHEN close < {lag('close')} THEN volume ELSE 0.0 END AS dn, 100 * {div('deliv_qty', 'volume')} AS pct, (high + low + close) / 3 * volume AS tpv FROM b) SELECT "
    + cols({f"vol_ratio_{n}": div("volume", roll("mean", "volume", n)) for n in (20, 50)} | {f"updown_vol_{n}": div(roll("sum", "up", n), roll("sum", "dn", n)) for n in (20, 50)} | {"vol_dryup_10_50": div(roll("mean", "volume", 10), roll("mean", "volume", 50)), "deliv_pct": "pct", "deliv_pct_5": roll("mean", "pct", 5, 3), "deliv_pct_20": roll("mean", "pct", 20, 10)} | {f"dist_vwap_{n}": dist("close", div(roll("sum", "tpv", n), roll("sum", "volume", n))) for n in (20, 50)} | {"trades_ratio_20": div("trades", roll("mean", "trades", 20, 10))}) + " FROM x",
)
DAILY = """
WITH RECURSIVE b AS (
    SELECT symbol, date, arg_min(px, o) AS open, max(px) AS high, min(px) AS low, arg_max(px, o) AS close, sum(l_quantity) AS volume, count(*)::DOUBLE AS trades, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0.0 END) AS deliv_qty
    FROM (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice / l_quantity AS px, (l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice) AS o, l_quantity, l_returnflag FROM lineitem) GROUP BY 1, 2
)
"""


@query("bars_daily", DAILY + "SELECT " + cols({c: c for c in ("open", "high", "low", "close")}) + ", volume, trades, deliv_qty FROM b", bars=False)
def bars_daily(spark, sf):
    return B.daily_bars(B.table(spark, sf, "lineitem")).select("symbol", "date", *[r6(c).alias(c) for c in ("open", "high", "low", "close")], "volume", "trades", "deliv_qty")


@query("bars_hourly", "SELECT event_type AS symbol, date_trunc('hour', ts) AS hour, round(arg_min(value, (ts, event_id)), 6) AS open, round(max(value), 6) AS high, round(min(value), 6) AS low, round(arg_max(value, (ts, event_id)), 6) AS close, count(*) AS volume FROM events GROUP BY 1, 2", bars=False, dates=())
def bars_hourly(spark, sf):
    h = B.hourly_bars(B.table(spark, sf, "events"))
    return h.select("symbol", F.col("hour").cast("timestamp_ntz").alias("hour"), *[F.round(c, 6).alias(c) for c in ("open", "high", "low", "close")], "volume")


@query("bars_walk", "SELECT symbol, date, open, high, low, close, volume, deliv_qty, trades, t FROM b")
def bars_walk(spark, sf):
    return B.walk(spark, sf)


GAP = DAILY + f", t0 AS (SELECT *, row_number() OVER ({S}) - 1 AS t FROM b), tr AS (SELECT *, {lag('close')} AS pc, greatest(high - low, abs(high - {lag('close')}), abs(low - {lag('close')})) AS tr, {div('volume', roll('mean', 'volume', 50))} AS vr FROM t0), a AS (SELECT *, {roll('mean', 'tr', 14)} AS a0 FROM tr), "


@query(
    "n20_gap_drift",
    GAP + f"g AS (SELECT *, round({div('open - pc', lag('a0'))}, 8) AS gap FROM a), e AS (SELECT *, CASE WHEN abs(gap) >= 1.0 AND round(vr, 8) >= 1.5 THEN {{'t': t, 'g': gap, 'c': pc}} END AS e0 FROM g), "
    f"l AS (SELECT *, last_value(e0 IGNORE NULLS) OVER ({S} ROWS BETWEEN 60 PRECEDING AND CURRENT ROW) AS e FROM e) SELECT symbol, date, (t - e.t)::DOUBLE AS evgap_days_since, sign(e.g)::DOUBLE AS evgap_dir, {r('e.g')} AS evgap_size_atr, {r(dist('close', 'e.c'))} AS evgap_ret_since FROM l",
    bars=False,
)
def n20_gap_drift(spark, sf):
    bars = B.daily_bars(B.table(spark, sf, "lineitem"))
    from tickloom.functions.exprs import by_symbol

    return W.gap_drift(bars.withColumn("t", F.row_number().over(by_symbol()) - 1), 1.0, 1.5).withColumn("evgap_days_since", F.col("evgap_days_since").cast("double"))
