"""Further queries: cross-section, recursive indicators, patterns, joins, ledger, decisions, reports, set operations."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import by_symbol, crosses_down, crosses_up, ordinal, pct_dist, r6, rolling, slug
from tickloom.operators import actions as A
from tickloom.operators import crosssection as X
from tickloom.operators import patterns as P
from tickloom.operators import charts
from tickloom.operators import events as Ev
from tickloom.operators import scans as K
from tickloom.operators.tables import derive_sql
from tickloom.plans import decide as D
from tickloom.plans import ledger as L
from tickloom.functions.sqltext import S, dist, div, flag, lag, prev, r, roll
from tickloom.plans.registry import DAILY, TR, cols, query
from tickloom.plans.registry5 import PIPES_SQL
from tickloom.plans.registry6 import DARVAS, FIBONACCI
from tickloom.sources import bars as B
from tickloom.sources import files as Fi

# ---- cross-section -----------------------------------------------------------------------------------------------
PANEL = (
    f", pa AS (SELECT *, {roll('mean', 'close', 50)} AS s50, {roll('mean', 'close', 200)} AS s200, {roll('max', 'high', 252, 200)} AS hi, {roll('min', 'low', 252, 200)} AS lo FROM b), panel AS (SELECT symbol, date, close, t, "
    + ", ".join(f"round({dist('close', lag('close', n))}, 8) AS ret_{n}" for n in (1, 21, 63, 126, 189, 252))
    + f", {flag('round(close - s50, 8) > 0')} AS above50, {flag('round(close - s200, 8) > 0')} AS above200, {flag('high >= hi')} AS nh, {flag('low <= lo')} AS nl FROM pa)"
)
BREADTH = (
    PANEL + ", day AS (SELECT date, " + ", ".join(f"{r(e)} AS {n}" for n, e in {"pct_above50": "avg(above50)", "pct_above200": "avg(above200)", "nh_nl": "avg(nh) - avg(nl)", "ad_ratio": "sum(CASE WHEN ret_1 > 0 THEN 1 ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN ret_1 <> 0 THEN 1 ELSE 0 END), 0)", "median_ret21": "median(ret_21)", "dispersion21": "stddev_samp(ret_21)"}.items())
    + ", count(*) AS n_symbols FROM panel GROUP BY date)"
)
LASTP = PANEL + ", la AS (SELECT panel.*, industry FROM panel JOIN u USING (symbol) QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1), lp AS (SELECT * REPLACE (DATE '2001-12-31' AS date) FROM la)"


def pct_rank(x: str, by: str) -> str:
    return f"CASE WHEN {x} IS NOT NULL THEN (rank() OVER (PARTITION BY {by} ORDER BY {x} ASC NULLS LAST) + (count(*) OVER (PARTITION BY {by}, {x}) - 1) / 2.0) / count({x}) OVER (PARTITION BY {by}) END"


def panel(spark, sf) -> DataFrame:
    return X.core_panel(B.walk(spark, sf))


def last_rows(spark, sf) -> DataFrame:
    """Each symbol's last row as one session, with its industry."""
    return X.latest(panel(spark, sf)).withColumn("date", F.lit("2001-12-31").cast("date")).join(B.universe(spark, sf), "symbol")


@query("a1_market_breadth", BREADTH + " SELECT * FROM day")
def a1_market_breadth(spark, sf):
    return X.breadth(panel(spark, sf))


@query(
    "a2_sector",
    LASTP + ", st AS (SELECT industry, round(median(ret_63), 8) AS m FROM lp GROUP BY 1), sr AS (SELECT industry, " + pct_rank("m", "1") + " AS v FROM st) SELECT date, symbol, industry, "
    + ", ".join(f"{r(e)} AS {n}" for n, e in {"sec_ret21_med": "median(ret_21) OVER i", "sec_ret63_med": "median(ret_63) OVER i", "rel_sec_ret21": "ret_21 - median(ret_21) OVER i", "rel_sec_ret63": "ret_63 - median(ret_63) OVER i", "sec_breadth50": "avg(above50) OVER i", "sec_rs_rank": "sr.v"}.items())
    + ", count(*) OVER i AS sec_size FROM lp JOIN sr USING (industry) WINDOW i AS (PARTITION BY industry)",
)
def a2_sector(spark, sf):
    return X.sectors(last_rows(spark, sf))


_W = {"ret_63": 0.4, "ret_126": 0.2, "ret_189": 0.2, "ret_252": 0.2}
_num, _den = " + ".join(f"{w} * coalesce({k}, 0.0)" for k, w in _W.items()), " + ".join(f"CASE WHEN {k} IS NOT NULL THEN {w} ELSE 0.0 END" for k, w in _W.items())


@query("c1_rs_rating", LASTP + f", x AS (SELECT *, round(CASE WHEN ({' + '.join(f'CASE WHEN {k} IS NOT NULL THEN 1 ELSE 0 END' for k in _W)}) >= 3 THEN (({_num}) / ({_den}))::DOUBLE END, 8) AS raw FROM lp), y AS (SELECT *, {pct_rank('raw', '1')} AS v FROM x) SELECT date, symbol, {r('raw')} AS rs_raw, greatest(1, least(99, round_even(99 * v, 0)))::DOUBLE AS rs_rating FROM y")
def c1_rs_rating(spark, sf):
    return X.rs_rating(last_rows(spark, sf))


@query("c2_xs_ranks", LASTP + " SELECT date, symbol, " + ", ".join(f"{r(pct_rank(c, '1'))} AS xs_rank_{c}" for c in ("ret_1", "ret_21", "ret_63", "ret_126", "ret_252")) + " FROM lp")
def c2_xs_ranks(spark, sf):
    return X.ranks(last_rows(spark, sf), ("ret_1", "ret_21", "ret_63", "ret_126", "ret_252"))


def ewm_sql(src: str, x: str, alphas: dict[str, str]) -> str:
    """Recursive smoothing of src (i, x): from the first known value on; nulls change nothing."""
    return f"k AS (SELECT i, " + ", ".join(f"{x} AS {n}" for n in alphas) + f", CASE WHEN {x} IS NULL THEN 0 ELSE 1 END AS n FROM {src} WHERE i = 0 UNION ALL SELECT s.i, " + ", ".join(f"CASE WHEN s.{x} IS NULL THEN k.{n} WHEN k.{n} IS NULL THEN s.{x} ELSE (1 - {a}) * k.{n} + {a} * s.{x} END" for n, a in alphas.items()) + f", k.n + CASE WHEN s.{x} IS NULL THEN 0 ELSE 1 END FROM k JOIN {src} s ON s.i = k.i + 1)"


@query("c4_mcclellan", BREADTH + ", net AS MATERIALIZED (SELECT date, row_number() OVER (ORDER BY date) - 1 AS i, 1000 * (2 * ad_ratio - 1) AS x FROM day), " + ewm_sql("net", "x", {"f": "(2 / 20.0::DOUBLE)", "s": "(2 / 40.0::DOUBLE)"}) + f" SELECT date, {r('CASE WHEN n >= 39 THEN f - s END')} AS mcclellan FROM net JOIN k USING (i)")
def c4_mcclellan(spark, sf):
    return X.mcclellan(X.breadth(panel(spark, sf)))


DB = "ORDER BY date"


@query(
    "c5_market",
    f", x AS (SELECT *, round({roll('mean', 'bench', 50, by=DB)}, 8) AS s50, round({roll('mean', 'bench', 200, by=DB)}, 8) AS s200, ln(bench / lag(bench) OVER ({DB})) AS lr FROM m) SELECT "
    + cols({f"ret_{k}": dist("bench", f"lag(bench, {k}) OVER ({DB})") for k in (1, 5, 21, 63, 126)} | {"dist_sma50": dist("bench", "s50"), "dist_sma200": dist("bench", "s200"), "hv20": f"({roll('std', 'lr', 20, by=DB)}) * sqrt(252) * 100", "dd252": dist("bench", roll("max", "bench", 252, 100, by=DB))}, "date")
    + ", CASE WHEN bench > s50 AND bench > s200 THEN 1 WHEN bench < s50 AND bench < s200 THEN -1 ELSE 0 END AS regime FROM x",
)
def c5_market(spark, sf):
    return X.market(B.benchmark(B.walk(spark, sf)))


# ---- recursive indicators ----------------------------------------------------------------------------------------
def rec(name: str, states: dict[str, tuple[str, str]], outs: dict[str, str], f, inputs: str = "SELECT * FROM b", pre: str = "") -> None:
    """A query whose SQL steps through each symbol's bars: states name: (first, next with k. the old state and x. the bar)."""
    first = ", ".join(f"{a} AS {n}" for n, (a, _) in states.items())
    after = ", ".join(b for _, b in states.values())
    sql = pre + f", x AS MATERIALIZED ({inputs}), k AS (SELECT symbol, t, {first} FROM x WHERE t = 0 UNION ALL SELECT x.symbol, x.t, {after} FROM k JOIN x ON x.symbol = k.symbol AND x.t = k.t + 1) SELECT " + cols(outs).replace("symbol, date", "x.symbol, x.date", 1) + " FROM x JOIN k ON x.symbol = k.symbol AND x.t = k.t"
    query(name, sql)(f)


def seeded(x: str, n: int, weight: str, name: str) -> tuple[str, str]:
    """The mean of the first n values (sums before), then smoothing; bars are counted by t."""
    return x, f"CASE WHEN x.t < {n - 1} THEN k.{name} + x.{x} WHEN x.t = {n - 1} THEN (k.{name} + x.{x}) / {n} ELSE k.{name} + {weight} * (x.{x} - k.{name}) END"


rec(
    "n2_ema", {f"e{n}": seeded("close", n, f"(2 / {n + 1}::DOUBLE)", f"e{n}") for n in (9, 20, 21)},
    {f"ema{n}": f"CASE WHEN x.t >= {n - 1} THEN e{n} END" for n in (9, 20, 21)} | {"dist_ema20": f"CASE WHEN x.t >= 19 THEN 100 * (close / e20 - 1) END"},
    lambda spark, sf: (lambda d: d.select("symbol", "date", *[r6(f"ema{n}").alias(f"ema{n}") for n in (9, 20, 21)], r6(pct_dist("close", "ema20")).alias("dist_ema20")))(K.scan(B.walk(spark, sf), [(K.ema(n), ("close",), (f"ema{n}",)) for n in (9, 20, 21)])),
)
WIL = lambda x, n, name: ("0.0::DOUBLE", f"CASE WHEN x.t < {n} THEN k.{name} + x.{x} WHEN x.t = {n} THEN (k.{name} + x.{x}) / {n} ELSE k.{name} + (1 / {n}::DOUBLE) * (x.{x} - k.{name}) END")
RSI_IN = f"SELECT *, greatest(close - {lag('close')}, 0.0) AS up, greatest({lag('close')} - close, 0.0) AS dn FROM tr"
rec(
    "n1_rma_rsi_atr", {"u": WIL("up", 14, "u"), "d": WIL("dn", 14, "d"), "a": WIL("tr", 14, "a")}, {"rsi14": "CASE WHEN x.t >= 14 THEN CASE WHEN u + d > 0 THEN 100 * u / (u + d) ELSE 0.0 END END", "atr14": "CASE WHEN x.t >= 14 THEN a END"},
    lambda spark, sf: K.scan(B.walk(spark, sf), [(K.rsi(14), ("close",), ("rsi14",)), (K.atr(14), ("high", "low", "close"), ("atr14",))]).select("symbol", "date", r6("rsi14").alias("rsi14"), r6("atr14").alias("atr14")),
    RSI_IN, TR,
)
rec(
    "n2_macd",
    {"f": seeded("close", 12, "(2 / 13::DOUBLE)", "f"), "s": seeded("close", 26, "(2 / 27::DOUBLE)", "s")}, {"macd": "CASE WHEN x.t >= 25 THEN f - s END"},
    lambda spark, sf: K.scan(B.walk(spark, sf), [(K.macd(), ("close",), ("macd", "sig", "hist"))]).select("symbol", "date", r6("macd").alias("macd")),
)
rec("w14_ewm", {"e": ("close", "(1 - 2 / 11::DOUBLE) * k.e + (2 / 11::DOUBLE) * x.close")}, {"ewm10": "CASE WHEN x.t >= 9 THEN e END"}, lambda spark, sf: K.scan(B.walk(spark, sf), [(K.ewm(2 / 11, 10), ("close",), ("ewm10",))]).select("symbol", "date", r6("ewm10").alias("ewm10")))
rec("w15_ewm_wilder", {"e": ("close", "(1 - 1 / 14::DOUBLE) * k.e + (1 / 14::DOUBLE) * x.close")}, {"ewm14": "e"}, lambda spark, sf: K.scan(B.walk(spark, sf), [(K.ewm(1 / 14), ("close",), ("ewm14",))]).select("symbol", "date", r6("ewm14").alias("ewm14")))
rec("n10_mcginley", {"m": ("close", "k.m + (x.close - k.m) / (14 * pow(x.close / k.m, 4))")}, {"mcginley14": "CASE WHEN x.t >= 14 THEN m END"}, lambda spark, sf: K.scan(B.walk(spark, sf), [(K.mcginley(), ("close",), ("m",))]).select("symbol", "date", r6("m").alias("mcginley14")))
rec(
    "n15_kagi",
    {"tr": ("1", "CASE WHEN k.tr = 1 AND x.close <= k.e * 0.96 THEN -1 WHEN k.tr = -1 AND x.close >= k.e * 1.04 THEN 1 ELSE k.tr END"), "e": ("close", "CASE WHEN (x.close - k.e) * k.tr > 0 OR (k.tr = 1 AND x.close <= k.e * 0.96) OR (k.tr = -1 AND x.close >= k.e * 1.04) THEN x.close ELSE k.e END"),
     "sh": ("close", "CASE WHEN k.tr = 1 AND x.close <= k.e * 0.96 THEN k.e ELSE k.sh END"), "wa": ("close", "CASE WHEN k.tr = -1 AND x.close >= k.e * 1.04 THEN k.e ELSE k.wa END"),
     "st": ("1.0::DOUBLE", "CASE WHEN x.close > CASE WHEN k.tr = 1 AND x.close <= k.e * 0.96 THEN k.e ELSE k.sh END THEN 1.0 WHEN x.close < CASE WHEN k.tr = -1 AND x.close >= k.e * 1.04 THEN k.e ELSE k.wa END THEN -1.0 ELSE k.st END")},
    {"kagi_state": "st"}, lambda spark, sf: K.scan(B.walk(spark, sf), [(K.kagi(), ("close",), ("s",))]).select("symbol", "date", r6("s").alias("kagi_state")),
)
rec("n3_heikin_ashi", {"ho": ("(open + close) / 2", "(k.ho + k.hc) / 2"), "hc": ("(open + high + low + close) / 4", "(x.open + x.high + x.low + x.close) / 4")}, {"ha_open": "ho", "ha_close": "hc", "ha_body_pct": "100 * (hc - ho) / ho"}, lambda spark, sf: K.scan(B.walk(spark, sf).withColumns({"bo": F.col("open"), "bc": F.col("close")}), [(K.heikin_ashi, ("bo", "high", "low", "bc"), ("ha_o", "ha_c", "ha_k"))]).select("symbol", "date", r6("ha_o").alias("ha_open"), r6("ha_c").alias("ha_close"), r6(100 * (F.col("ha_c") - F.col("ha_o")) / F.col("ha_o")).alias("ha_body_pct")))


def kernels(name: str, ks, prepare=lambda b: b) -> None:
    """A query without SQL: kernels over prepared bars; the tests hold them against plain loops."""
    outs = [o for _, _, os in ks for o in os]
    query(name)(lambda spark, sf: K.scan(prepare(B.walk(spark, sf)), ks).select("symbol", "date", *[r6(o).alias(o) for o in outs]))


mid = lambda b: b.withColumn("mid", (F.col("high") + F.col("low")) / 2)
kernels("n4_laguerre", [(K.laguerre(), ("close",), ("laguerre_rsi",))])
kernels("n6_fisher", [(K.fisher, ("mid", "lo10", "hi10"), ("fisher_10",))], lambda b: mid(b).withColumns({"lo10": rolling("min", "mid", 10), "hi10": rolling("max", "mid", 10)}))
kernels("n9_klinger", [(K.klinger_force, ("high", "low", "close", "volume"), ("force",)), (K.ema(34), ("force",), ("fast",)), (K.ema(55), ("force",), ("slow",))])
kernels("n12_volstop", [(K.atr(14), ("high", "low", "close"), ("atr",)), (K.volatility_stop(), ("close", "atr"), ("volstop_dir", "volstop"))])
kernels("n13_renko", [(K.atr(14), ("high", "low", "close"), ("atr",)), (K.renko, ("close", "atr"), ("renko_dir", "renko_run"))])
kernels("n14_tlb", [(K.three_line_break(), ("close",), ("tlb_dir",))])
kernels("n30_zigzag", [(K.atr(50), ("high", "low", "close"), ("atr50",)), (K.zigzag, ("high", "low", "atr50"), ("zz_dir", "zz_extreme", "zz_bar", "zz_confirmed"))])
kernels("ta_sar", [(K.parabolic(), ("high", "low"), ("sar", "sar_dir"))])
kernels("ta_supertrend", [(K.atr(10), ("high", "low", "close"), ("atr",)), (K.supertrend(), ("high", "low", "close", "atr"), ("supertrend", "supertrend_dir"))])
kernels("ta_adx", [(K.directional(), ("high", "low", "close"), ("plus_di", "minus_di", "adx"))])
kernels("ta_kama", [(K.kaufman(), ("close",), ("kama",))])


@query("sig_macd_rsi")
def sig_macd_rsi(spark, sf):
    df = K.scan(B.walk(spark, sf), [(K.rsi(14), ("close",), ("rsi",)), (K.macd(), ("close",), ("macd", "sig", "hist"))]).withColumns({c: F.round(c, 8) for c in ("rsi", "macd", "hist")})
    rules = [("MACD crosses above signal", "MACD", 1, crosses_up("hist"), "hist"), ("MACD crosses below signal", "MACD", -1, crosses_down("hist"), "hist"), ("MACD crosses above zero", "MACD", 1, crosses_up("macd"), "macd"), ("MACD crosses below zero", "MACD", -1, crosses_down("macd"), "macd")]
    rules += [(f"RSI(14) {what}", "RSI", d, f("rsi", lvl), "rsi") for what, d, f, lvl in (("rises back above 30", 1, crosses_up, 30.0), ("falls back below 70", -1, crosses_down, 70.0), ("crosses above 50", 1, crosses_up, 50.0), ("crosses below 50", -1, crosses_down, 50.0))]
    return P.emit(df, rules)


def ma_cross(bars: DataFrame) -> DataFrame:
    df = bars.withColumns({f"d{n}": F.round(pct_dist("close", rolling("mean", "close", n)), 8) for n in (50, 200)} | {"g": F.round(rolling("mean", "close", 50) - rolling("mean", "close", 200), 8)})
    up, dn = crosses_up, crosses_down
    return P.emit(df, [("Golden cross (50 > 200 DMA)", "Moving averages", 1, up("g"), "close"), ("Death cross (50 < 200 DMA)", "Moving averages", -1, dn("g"), "close"), *[(f"Close crosses {w} {n} DMA", "Moving averages", d, f(f"d{n}"), "close") for n in (200, 50) for w, d, f in (("above", 1, up), ("below", -1, dn))]])


def events_sql(src: str, rules: list[tuple[str, str, int, str, str]]) -> str:
    return " UNION ALL ".join(f"SELECT symbol, date, t, '{n}' AS pattern, '{f}' AS family, {d} AS dir, {r(lv)} AS level FROM {src} WHERE {c}" for n, f, d, c, lv in rules)


up_, dn_ = (lambda x, lv=0: f"{x} > {lv} AND p_{x} <= {lv}"), (lambda x, lv=0: f"{x} < {lv} AND p_{x} >= {lv}")
MA = f", x AS (SELECT *, round({dist('close', roll('mean', 'close', 50))}, 8) AS d50, round({dist('close', roll('mean', 'close', 200))}, 8) AS d200, round(({roll('mean', 'close', 50)}) - ({roll('mean', 'close', 200)}), 8) AS g FROM b), y AS (SELECT *, {lag('d50')} AS p_d50, {lag('d200')} AS p_d200, {lag('g')} AS p_g FROM x) "
query("sig_ma_cross", MA + events_sql("y", [("Golden cross (50 > 200 DMA)", "Moving averages", 1, up_("g"), "close"), ("Death cross (50 < 200 DMA)", "Moving averages", -1, dn_("g"), "close"), *[(f"Close crosses {w} {n} DMA", "Moving averages", d, f(f"d{n}"), "close") for n in (200, 50) for w, d, f in (("above", 1, up_), ("below", -1, dn_))]]))(lambda spark, sf: ma_cross(B.walk(spark, sf)))

# ---- patterns ----------------------------------------------------------------------------------------------------
PATTERN_SQL: dict[str, str] = {}
_no20 = lambda c: f"NOT (coalesce(max({c}) OVER ({S} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING), false) AND count({c}) OVER ({S} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) >= 20)"
HIGHS = f", x AS (SELECT *, {prev('max', 'high', 252, 200)} AS hi, {prev('min', 'low', 252, 200)} AS lo, max(high) OVER ({S} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS ath FROM b), y AS (SELECT *, coalesce(close > hi, false) AS bh, coalesce(close < lo, false) AS bl, coalesce(close > ath, false) AS ba FROM x), z AS (SELECT *, bh AND {_no20('bh')} AS fh, bl AND {_no20('bl')} AS fl, ba AND {_no20('ba')} AS fa FROM y) "
PATTERN_SQL["pat_new_highs"] = HIGHS + events_sql("z", [("52-week high breakout", "New highs / lows", 1, "fh", "hi"), ("52-week low breakdown", "New highs / lows", -1, "fl", "lo"), ("Multi-year high breakout (since 2016)", "New highs / lows", 1, "fa AND t >= 500", "ath")])
query("pat_new_highs", PATTERN_SQL["pat_new_highs"])(lambda spark, sf: P.new_highs(B.walk(spark, sf)))
KEYR = f", x AS (SELECT *, {prev('min', 'low', 20)} AS ll, {prev('max', 'high', 20)} AS hh, {lag('close')} AS pc, {lag('high')} AS ph, {lag('low')} AS pl FROM b) "
PATTERN_SQL["pat_key_reversal"] = KEYR + events_sql("x", [("Key reversal day (bullish)", "Reversal bars", 1, "low < ll AND close > pc AND high > ph", "close"), ("Key reversal day (bearish)", "Reversal bars", -1, "high > hh AND close < pc AND low < pl", "close")])
query("pat_key_reversal", PATTERN_SQL["pat_key_reversal"])(lambda spark, sf: P.key_reversals(B.walk(spark, sf)))
_p20 = f"({S} ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING)"
TS = f", x AS (SELECT *, {prev('min', 'low', 20)} AS ll, {prev('max', 'high', 20)} AS hh, CASE WHEN count(low) OVER {_p20} = 20 THEN t - 1 - arg_min(t, low) OVER {_p20} END AS la, CASE WHEN count(low) OVER {_p20} = 20 THEN t - 1 - arg_max(t, high) OVER {_p20} END AS ha FROM b), y AS (SELECT *, " + " OR ".join(f"coalesce({lag('low', k) if k else 'low'} < {lag('ll', k) if k else 'll'} AND close > {lag('ll', k) if k else 'll'} AND {lag('la', k) if k else 'la'} >= 3, false)" for k in range(3)) + " AS bull, " + " OR ".join(f"coalesce({lag('high', k) if k else 'high'} > {lag('hh', k) if k else 'hh'} AND close < {lag('hh', k) if k else 'hh'} AND {lag('ha', k) if k else 'ha'} >= 3, false)" for k in range(3)) + f" AS bear FROM x), z AS (SELECT *, coalesce({lag('bull')}, false) AS pb, coalesce({lag('bear')}, false) AS pr FROM y) "
PATTERN_SQL["pat_turtle_soup"] = TS + events_sql("z", [("2B bottom / Turtle soup", "False breakout", 1, "bull AND NOT pb", "ll"), ("2B top / Turtle soup", "False breakout", -1, "bear AND NOT pr", "hh")])
query("pat_turtle_soup", PATTERN_SQL["pat_turtle_soup"])(lambda spark, sf: P.turtle_soup(B.walk(spark, sf)))
FB = f", x0 AS (SELECT *, {lag('close')} AS pc, round(({div('close', lag('close', 60))}) - 1, 8) AS r60 FROM b), x AS (SELECT *, " + ", ".join(f"{prev('max', 'high', w)} AS bh{w}, {prev('min', 'low', w)} AS bl{w}, {lag('r60', w)} AS pr{w}" for w in (25, 40, 60)) + " FROM x0) "
PATTERN_SQL["pat_flat_base"] = FB + events_sql("x", [(f"Flat base breakout ({w}d)", "IBD bases", 1, f"round(bh{w} / bl{w} - 1, 8) <= 0.15 AND close > bh{w} AND pc <= bh{w} AND pr{w} >= 0.20", f"bh{w}") for w in (25, 40, 60)])
query("pat_flat_base", PATTERN_SQL["pat_flat_base"])(lambda spark, sf: P.flat_bases(B.walk(spark, sf)))
ED = f", x AS (SELECT *, round(({div('close', lag('close', 2))}) - 1, 8) AS d2 FROM b), y AS (SELECT *, {lag('d2')} AS p FROM x) "
PATTERN_SQL["pat_event_decline"] = ED + events_sql("y", [("Event decline (>=15% in 2 days)", "Event decline", 1, "d2 <= -0.15 AND p > -0.15", "close")])
_nr = ", x AS (SELECT *, round(high - low, 2) AS rng FROM b), y AS (SELECT *, rng <= (" + roll("min", "rng", 7) + f") AS nr, high <= {lag('high')} AND low >= {lag('low')} AS ins FROM x), "
_nr += "e AS (SELECT a.symbol, c.date, c.t, a.t AS bt, kind, d, CASE WHEN d > 0 THEN a.high ELSE a.low END AS level FROM (SELECT *, unnest(['NR7', 'Inside day']) AS kind FROM y) a JOIN b c ON c.symbol = a.symbol AND c.t BETWEEN a.t + 1 AND a.t + 3, (VALUES (1), (-1)) v(d) WHERE (CASE WHEN kind = 'NR7' THEN a.nr ELSE a.ins END) AND (c.close - CASE WHEN d > 0 THEN a.high ELSE a.low END) * d > 0), "
_nr += "f AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY symbol, bt, kind, d ORDER BY t) = 1) SELECT symbol, date, t, kind || ' breakout ' || CASE WHEN d > 0 THEN 'up' ELSE 'down' END AS pattern, 'Range contraction' AS family, d AS dir, floor(round(arg_max(level, bt), 9) * 1e6 + 0.5) / 1e6 AS level FROM f GROUP BY symbol, date, t, kind, d"
query("pat_nr7_inside", _nr)(lambda spark, sf: P.contraction_breaks(B.walk(spark, sf)))


def with_atr_sql(src: str) -> tuple[str, str]:
    return derive_sql(src, P.ATR, ["atr"], "wa")


_atr, _last = with_atr_sql("b")
_narrow = f"round({div('hi - lo', 'close')}, 8) < 0.20"
WY = _atr + f", x AS (SELECT * REPLACE (round(atr, 8) AS atr), {prev('max', 'high', 40)} AS hi, {prev('min', 'low', 40)} AS lo FROM {_last}) "
WY += events_sql("x", [("Wyckoff spring", "Wyckoff", 1, f"{_narrow} AND low < lo AND low > round(lo - 1.5 * atr, 8) AND close > lo", "lo"), ("Wyckoff upthrust", "Wyckoff", -1, f"{_narrow} AND high > hi AND high < round(hi + 1.5 * atr, 8) AND close < hi", "hi")])
query("pat_wyckoff", WY)(lambda spark, sf: P.wyckoff(B.walk(spark, sf)))
VO = _atr + f", x AS (SELECT *, {lag('close')} AS pc, round({roll('mean', 'close', 50)}, 8) AS s50, round({roll('mean', 'close', 200)}, 8) AS s200, {roll('mean', 'volume', 50)} AS v50, {prev('min', 'low', 20)} AS ll, {prev('max', 'high', 20)} AS hh, {lag('close', 10)} AS c10 FROM {_last}), "
VO += f"y AS (SELECT *, CASE WHEN close < pc THEN volume ELSE 0.0 END AS dv, round(volume / greatest(v50, 1.0), 8) AS volx, round(({div('close', 'c10')}) - 1, 8) AS r10, round(high - low - 2 * atr, 8) > 0 AS wide, round((high + low) / 2, 8) AS middle FROM x), z AS (SELECT *, {prev('max', 'dv', 10)} AS dv10 FROM y) "
VO += events_sql("z", [("Pocket pivot", "Volume patterns", 1, f"close > pc AND volume > dv10 AND close > s50 AND round(abs(({div('close', 's50')}) - 1), 8) < 0.10 AND s50 > s200", "close"), ("Selling climax (reversal)", "Volume patterns", 1, "volx >= 3 AND v50 IS NOT NULL AND wide AND low <= ll AND close > middle AND r10 < -0.10", "close"), ("Buying climax (reversal)", "Volume patterns", -1, "volx >= 3 AND v50 IS NOT NULL AND wide AND high >= hh AND close < middle AND r10 > 0.10", "close")])
query("pat_volume", VO)(lambda spark, sf: P.volume_patterns(B.walk(spark, sf)))


def gaps_sql(src: str) -> str:
    atr, last = with_atr_sql(src)
    sql = atr + f", x AS (SELECT *, {lag('close')} AS pc, {lag('high')} AS ph, {lag('low')} AS pl, {prev('max', 'high', 40)} AS hi, {prev('min', 'low', 40)} AS lo, {roll('mean', 'volume', 50)} AS v50, {lag('close', 20)} AS c20 FROM {last}), "
    sql += f"y AS (SELECT *, round(abs(open - pc) - 0.5 * atr, 8) >= 0 AS big, round((hi - lo) / close, 8) < 0.25 AND v50 IS NOT NULL AND round(volume / greatest(v50, 1.0), 8) >= 1.5 AS tight, round(({div('close', 'c20')}) - 1, 8) AS r20 FROM x) "
    return sql + events_sql("y", [("Breakaway gap up", "Gaps", 1, "low > ph AND big AND close > hi AND tight", "ph"), ("Breakaway gap down", "Gaps", -1, "high < pl AND big AND close < lo AND tight", "pl"), ("Runaway gap up", "Gaps", 1, "low > ph AND big AND r20 > 0.15 AND coalesce(NOT close > hi, true)", "ph"), ("Runaway gap down", "Gaps", -1, "high < pl AND big AND r20 < -0.15 AND coalesce(NOT close < lo, true)", "pl")])


def exhaustion_sql(src: str) -> str:
    atr, last = with_atr_sql(src)
    sql = atr + f", x AS (SELECT *, {lag('close')} AS pc, {lag('high')} AS ph, {lag('low')} AS pl, {lag('close', 20)} AS c20 FROM {last}), y AS (SELECT *, round(abs(open - pc) - 0.5 * atr, 8) >= 0 AS big, round(({div('close', 'c20')}) - 1, 8) AS r20 FROM x), "
    sql += "g AS (SELECT symbol, t, ph AS edge, -1 AS d FROM y WHERE low > ph AND big AND r20 > 0.25 UNION ALL SELECT symbol, t, pl, 1 FROM y WHERE high < pl AND big AND r20 < -0.25), "
    sql += "f AS (SELECT g.symbol, y.date, y.t, g.d, g.edge FROM g JOIN y ON y.symbol = g.symbol AND y.t BETWEEN g.t + 1 AND g.t + 5 AND (y.close - g.edge) * g.d > 0 QUALIFY row_number() OVER (PARTITION BY g.symbol, g.t, g.d ORDER BY y.t) = 1) "
    return sql + "SELECT symbol, date, t, CASE WHEN d < 0 THEN 'Exhaustion gap (up, filled)' ELSE 'Exhaustion gap (down, filled)' END AS pattern, 'Gaps' AS family, d AS dir, floor(round(edge, 9) * 1e6 + 0.5) / 1e6 AS level FROM f"


def rounding_sql(src: str) -> str:
    """The fits by regressions: the closes' slope over places, and that over squared places, which the middle makes independent."""
    parts = []
    for w in (60, 120, 250):
        full, rim = f"({S} ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)", f"({S} ROWS BETWEEN {w} PRECEDING AND {w - max(3, w // 10) + 1} PRECEDING)"
        parts.append(f"SELECT symbol, date, t, close, {lag('close')} AS pc, {w} AS w, count(close) OVER {full} AS k, list(close) OVER {full} AS ys, max(close) OVER {rim} AS top, min(close) OVER {rim} AS bottom FROM {src}")
    sql = ", rx AS (SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE k = w AND ((close > top AND pc <= top) OR (close < bottom AND pc >= bottom))), "
    sql += "rp AS (SELECT symbol, date, t, close, pc, w, top, bottom, unnest(ys) AS y, generate_subscripts(ys, 1) - 1 - (w - 1) / 2.0 AS u FROM rx), "
    sql += "rq AS (SELECT symbol, date, t, w, any_value(close) AS close, any_value(pc) AS pc, any_value(top) AS top, any_value(bottom) AS bottom, regr_slope(y, u) AS b, regr_slope(y, u * u) AS a, regr_intercept(y, u * u) AS c0, regr_r2(y, u) + regr_r2(y, u * u) AS r2 FROM rp GROUP BY symbol, date, t, w), "
    sql += "rv AS (SELECT *, CASE WHEN a > 0 THEN top ELSE bottom END AS rim, -b / (2 * a) AS uv FROM rq WHERE round(a, 12) <> 0), rz AS (SELECT *, c0 + b * uv / 2 AS low FROM rv WHERE round(uv + (w - 1) / 2.0, 6) BETWEEN 0.3 * w AND 0.7 * w AND round(r2, 8) >= 0.75) "
    return sql + "SELECT symbol, date, t, CASE WHEN a > 0 THEN 'Rounding bottom (saucer)' ELSE 'Rounding top' END AS pattern, 'Rounding' AS family, CASE WHEN a > 0 THEN 1 ELSE -1 END AS dir, floor(round(rim, 9) * 1e6 + 0.5) / 1e6 AS level FROM rz WHERE round(abs(rim - low) / abs(rim), 8) >= 0.10 AND ((a > 0 AND close > rim AND pc <= rim) OR (a < 0 AND close < rim AND pc >= rim))"


def islands_sql(src: str) -> str:
    frame = lambda k: f"({S} ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING)"
    kinds = ", ".join(f"CASE WHEN max(high) OVER {frame(k)} < {lag('low', k + 1)} AND max(high) OVER {frame(k)} < low THEN 1 WHEN min(low) OVER {frame(k)} > {lag('high', k + 1)} AND min(low) OVER {frame(k)} > high THEN -1 END" for k in range(1, 16))
    return f", x AS (SELECT *, coalesce({kinds}) AS kind FROM {src}) " + events_sql("x", [("Island bottom", "Island reversal", 1, "kind = 1", "low"), ("Island top", "Island reversal", -1, "kind = -1", "high")])


def noisy(spark, sf) -> DataFrame:
    return B.daily_bars(B.table(spark, sf, "lineitem")).withColumn("t", F.row_number().over(by_symbol()) - 1)


_t0 = DAILY + f", b0 AS (SELECT *, row_number() OVER ({S}) - 1 AS t FROM b)"
query("pat_gaps", _t0 + gaps_sql("b0"), bars=False)(lambda spark, sf: P.gaps(noisy(spark, sf)))
query("pat_exhaustion_gaps", _t0 + exhaustion_sql("b0"), bars=False)(lambda spark, sf: P.exhaustion_gaps(noisy(spark, sf)))
query("pat_event_decline", _t0 + PATTERN_SQL["pat_event_decline"].replace("FROM b)", "FROM b0)"), bars=False)(lambda spark, sf: P.event_declines(noisy(spark, sf)))
query("pat_roundings", rounding_sql("b"))(lambda spark, sf: P.roundings(B.walk(spark, sf)))
query("pat_islands", _t0 + islands_sql("b0"), bars=False)(lambda spark, sf: P.islands(noisy(spark, sf)))
#: The SQL of every bar pattern, each with its own tables over b.
EVENTS = ", ev AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT * FROM (WITH RECURSIVE {q.removeprefix(', ')})" for q in (PATTERN_SQL["pat_new_highs"], PATTERN_SQL["pat_key_reversal"], PATTERN_SQL["pat_turtle_soup"], WY, _nr, VO, PATTERN_SQL["pat_flat_base"], gaps_sql("b"), exhaustion_sql("b"), rounding_sql("b"), PATTERN_SQL["pat_event_decline"], islands_sql("b"), PIPES_SQL)) + "), n AS (SELECT symbol, max(t) AS n FROM b GROUP BY 1)"


def some_events(spark, sf) -> DataFrame:
    """The events of bars and weeks."""
    b = B.walk(spark, sf)
    return P.all_events(b).unionByName(charts.pipes_and_horns(b))


query("u2_event_union", EVENTS + " SELECT symbol, date, pattern, dir FROM ev")(lambda spark, sf: some_events(spark, sf).select("symbol", "date", "pattern", "dir"))
_cnt = {f"{s}{c}_{k}": f"count(ev.t) FILTER (WHERE dir {o} 0 AND n - ev.t < {k}{cl})" for s, o in (("bull", ">"), ("bear", "<")) for k in (5, 20) for c, cl in (("", ""), ("_classic", " AND family NOT IN ('Range contraction', 'Divergence', 'Reversal bars', 'Volume patterns')"))}
query("a4_pattern_counts", EVENTS + ", c AS (SELECT n.symbol, " + ", ".join(f"{e} AS {k}" for k, e in _cnt.items()) + " FROM n LEFT JOIN ev USING (symbol) GROUP BY n.symbol) SELECT *, bull_20 - bear_20 AS net_20 FROM c", dates=())(lambda spark, sf: P.pattern_counts(some_events(spark, sf), B.walk(spark, sf)))
_names = {p: P.pattern_id(p) for p in re.findall(r"'([^']*)' AS pattern", EVENTS)} | {p: P.pattern_id(p) for k in ("NR7", "Inside day") for w in ("up", "down") for p in [f"{k} breakout {w}"]}
query("a5_pattern_decay", EVENTS + " SELECT n.symbol, " + ", ".join(f"round(coalesce(max(CASE WHEN pattern = '{p}' AND n - ev.t <= 30 THEN exp(-(n - ev.t) / 10.0) END), 0.0), 6) AS {i}" for p, i in _names.items()) + " FROM n LEFT JOIN ev USING (symbol) GROUP BY n.symbol", dates=())(lambda spark, sf: P.pattern_decay(some_events(spark, sf), B.walk(spark, sf), list(_names)))


@query("w27_session_age", EVENTS + ", ses AS (SELECT date, dense_rank() OVER (ORDER BY date) AS k FROM (SELECT DISTINCT date FROM b)) SELECT symbol, ev.date, pattern, (SELECT max(k) FROM ses) - k AS age FROM ev JOIN ses USING (date)")
def w27_session_age(spark, sf):
    e = some_events(spark, sf)
    ses = B.walk(spark, sf).select("date").distinct().withColumn("k", F.dense_rank().over(Window.orderBy("date")))  # a row a session
    return e.join(F.broadcast(ses), "date").crossJoin(F.broadcast(ses.agg(F.max("k").alias("last")))).select("symbol", "date", "pattern", (F.col("last") - F.col("k")).cast("long").alias("age"))


# ---- joins, ledger ------------------------------------------------------------------------------------------------
TF = "(VALUES " + ", ".join(f"('{n}', {s}::DOUBLE, {t}::DOUBLE, {c}::DOUBLE, {h})" for n, s, t, c, h in L.TIMEFRAMES) + ") tf(tf, sm, tm, cm, hold)"
CALLS = (
    TR + f", c0 AS (SELECT *, round(({roll('mean', 'close', 5)}) - ({roll('mean', 'close', 20)}), 8) AS d, round({roll('mean', 'tr', 14)}, 4) AS atr FROM tr), c1 AS (SELECT *, {lag('d')} AS p_d FROM c0), c2 AS (SELECT *, CASE WHEN {up_('d')} THEN 1 WHEN {dn_('d')} THEN -1 END AS side FROM c1), "
    f"calls AS MATERIALIZED (SELECT symbol, date AS signal_date, t AS t0, tf, CASE WHEN side > 0 THEN 'BUY' ELSE 'SHORT' END AS kind, side, close, atr, floor((close + side * cm * atr) * 1e2 + 0.5) / 1e2 AS entry_limit, floor((close + side * tm * atr) * 1e2 + 0.5) / 1e2 AS target, floor((close - side * sm * atr) * 1e2 + 0.5) / 1e2 AS stop, hold AS max_days FROM c2, {TF} WHERE side IS NOT NULL AND atr IS NOT NULL)"
)


def calls(spark, sf) -> DataFrame:
    return L.crossover_calls(B.walk(spark, sf))


query("p16_trade_levels", CALLS + " SELECT symbol, signal_date, tf, kind, entry_limit, target, stop FROM calls", dates=("signal_date",))(lambda spark, sf: calls(spark, sf).select("symbol", "signal_date", "tf", "kind", "entry_limit", "target", "stop"))
query("j6_forward_bars", CALLS + " SELECT c.symbol, signal_date, tf, kind, count(*) AS n, max(b.date) AS last_date, round(max(b.high), 6) AS top FROM calls c JOIN b ON b.symbol = c.symbol AND b.t > t0 AND b.t <= t0 + max_days GROUP BY 1, 2, 3, 4", dates=("signal_date", "last_date"))(
    lambda spark, sf: (lambda bars: L.forward_bars(L.crossover_calls(bars), bars).groupBy("symbol", "signal_date", "tf", "kind").agg(F.count("*").alias("n"), F.max("bar_date").alias("last_date"), F.round(F.max("h"), 6).alias("top")))(B.walk(spark, sf))
)
EVAL = (
    CALLS + ", fw AS (SELECT c.*, b.t - t0 AS day, b.date AS bd, b.open AS o, b.high AS h, b.low AS l, b.close AS cl FROM calls c JOIN b ON b.symbol = c.symbol AND b.t > t0 AND b.t <= t0 + max_days), "
    "f2 AS (SELECT *, CASE WHEN day > 1 AND (o - stop) * side <= 0 THEN 'Stop hit' WHEN day > 1 AND (o - target) * side >= 0 THEN 'Target hit' WHEN (CASE WHEN side > 0 THEN l ELSE h END - stop) * side <= 0 THEN 'Stop hit' WHEN (CASE WHEN side > 0 THEN h ELSE l END - target) * side >= 0 THEN 'Target hit' WHEN day = max_days THEN 'Time exit' END AS s, "
    "CASE WHEN day > 1 AND ((o - stop) * side <= 0 OR (o - target) * side >= 0) THEN o WHEN (CASE WHEN side > 0 THEN l ELSE h END - stop) * side <= 0 THEN stop WHEN (CASE WHEN side > 0 THEN h ELSE l END - target) * side >= 0 THEN target WHEN day = max_days THEN cl END AS p FROM fw), "
    "g AS (SELECT symbol, signal_date, tf, kind, side, entry_limit, stop, arg_min(o, day) AS entry, min(day) FILTER (WHERE s IS NOT NULL) AS xd, arg_min(s, day) FILTER (WHERE s IS NOT NULL) AS xs, arg_min(p, day) FILTER (WHERE s IS NOT NULL) AS xp, arg_min(bd, day) FILTER (WHERE s IS NOT NULL) AS xdate, max(day) AS n, arg_max(cl, day) AS last FROM f2 GROUP BY ALL), "
    "h AS (SELECT *, (entry - entry_limit) * side <= 0 AND (entry - stop) * side > 0 AS taken, (coalesce(xp, last) / entry - 1) * side AS gross FROM g), "
    f"led AS MATERIALIZED (SELECT symbol, signal_date, tf, kind, CASE WHEN NOT taken THEN 'Not triggered' ELSE coalesce(xs, 'Open') END AS status, CASE WHEN taken THEN entry END AS entry_price, CASE WHEN taken THEN xdate END AS exit_date, CASE WHEN taken THEN xp END AS exit_price, (CASE WHEN taken THEN coalesce(xd, n) END)::INT AS days_held, {r('CASE WHEN taken THEN 100 * (gross - 0.003) END')} AS result_pct, CASE WHEN taken AND xd IS NOT NULL THEN CASE WHEN round(gross - 0.003, 10) > 0 THEN 'Win' ELSE 'Loss' END END AS outcome FROM h)"
)


def ledger(spark, sf) -> DataFrame:
    bars = B.walk(spark, sf)
    return L.evaluate_trades(L.crossover_calls(bars), bars)


query("c9_trade_eval", EVAL + " SELECT * FROM led", dates=("signal_date", "exit_date"))(ledger)
query(
    "c10_avoid_eval",
    CALLS + ", fw AS (SELECT c.symbol, signal_date, tf, c.close, max_days, max(b.t - t0)::INT AS n, max(b.date) AS d1, arg_max(b.close, b.t) AS c1 FROM calls c JOIN b ON b.symbol = c.symbol AND b.t > t0 AND b.t <= t0 + max_days WHERE kind = 'SHORT' GROUP BY ALL), "
    "mk AS (SELECT d0, d1, avg(y.close / x.close - 1) AS mkt FROM (SELECT DISTINCT signal_date AS d0, d1 FROM fw) s JOIN b x ON x.date = d0 JOIN b y ON y.date = d1 AND y.symbol = x.symbol GROUP BY 1, 2), "
    f"e AS (SELECT fw.*, mkt, c1 / close - 1 AS stock, round(c1 / close - 1 - mkt, 10) AS ex FROM fw JOIN mk ON d0 = signal_date AND mk.d1 = fw.d1) SELECT symbol, signal_date, tf, CASE WHEN n < max_days THEN 'Open' WHEN ex < 0 THEN 'Correct' ELSE 'Wrong' END AS status, n AS days_held, {r('100 * stock')} AS stock_ret_pct, {r('100 * mkt')} AS mkt_ret_pct, {r('100 * ex')} AS excess_pct FROM e",
    dates=("signal_date",),
)(lambda spark, sf: (lambda bars: L.evaluate_avoids(L.crossover_calls(bars).filter("kind = 'SHORT'"), bars))(B.walk(spark, sf)))
_rate = lambda a, b: f"round(count_if({a})::DOUBLE / nullif(count_if({b}), 0), 6)"
SUCCESS = (
    EVAL + ", l2 AS (SELECT *, status IN ('Target hit', 'Stop hit', 'Time exit', 'Correct', 'Wrong') AS closed, status IN ('Pending', 'Open') AS run, max(status IN ('Pending', 'Open')) OVER (PARTITION BY signal_date, tf, kind) AS anyopen, strftime(signal_date, '%Y-%m') AS month, coalesce(outcome = 'Win', false) AS win FROM led), l3 AS (SELECT *, closed AND NOT anyopen AS mature FROM l2) "
    ", sc0 AS ("
    "SELECT CASE WHEN grouping(month) = 0 THEN 'MONTH' WHEN grouping(tf) = 0 THEN 'GROUP' WHEN grouping(kind) = 0 THEN 'KIND' ELSE 'OVERALL' END AS level, kind, tf, month, count(*) AS calls, count_if(closed)::BIGINT AS closed, count_if(run)::BIGINT AS running, count_if(mature)::BIGINT AS mature, count_if(status = 'Not triggered')::BIGINT AS not_triggered, "
    f"{_rate('closed AND win', 'closed')} AS success_rate, {_rate('mature AND win', 'mature')} AS success_rate_mature, {_rate("closed AND status = 'Target hit'", 'closed')} AS target_hit_rate, round(sum(CASE WHEN closed THEN round(1e6 * result_pct) END) / count(CASE WHEN closed THEN result_pct END)) / 1e6 AS avg_result_pct FROM l3 GROUP BY GROUPING SETS ((), (kind), (kind, tf), (month))"
    ")"
)
query(
    "c11_success_groups",
    SUCCESS + " SELECT * FROM sc0",
    dates=(),
)(lambda spark, sf: L.success(ledger(spark, sf)))
query("j12_mature_groups", EVAL + " SELECT signal_date, tf, kind, count(*) AS n FROM led GROUP BY 1, 2, 3 HAVING count_if(status IN ('Pending', 'Open')) = 0", dates=("signal_date",))(
    lambda spark, sf: (lambda led: led.groupBy("signal_date", "tf", "kind").agg(F.count("*").alias("n")).join(led.filter(F.col("status").isin(L.OPEN)).select("signal_date", "tf", "kind").distinct(), ["signal_date", "tf", "kind"], "left_anti"))(ledger(spark, sf))
)
ACT = ", act AS (SELECT symbol, date AS ex_date, CASE WHEN t % 2 = 0 THEN 0.5 ELSE 0.8 END AS f FROM b WHERE t % 97 = 13)"


def factors(spark, sf) -> DataFrame:
    return B.walk(spark, sf).filter("t % 97 = 13").select("symbol", F.col("date").alias("ex_date"), F.when(F.col("t") % 2 == 0, 0.5).otherwise(0.8).alias("factor"))


query("j5_ca_product", CALLS + ACT + " SELECT c.symbol, signal_date, tf, kind, round(coalesce(product(f), 1.0), 9) AS factor FROM calls c LEFT JOIN act a ON a.symbol = c.symbol AND ex_date > signal_date GROUP BY 1, 2, 3, 4", dates=("signal_date",))(
    lambda spark, sf: L.ca_factor(calls(spark, sf), factors(spark, sf)).select("symbol", "signal_date", "tf", "kind", F.round("factor", 9).alias("factor"))
)
query("c13_split_adjust", ACT + f", pj AS (SELECT b.*, coalesce((SELECT product(f) FROM act a WHERE a.symbol = b.symbol AND a.ex_date > b.date), 1.0) AS adj FROM b) SELECT symbol, date, round(adj, 9) AS adj, {r('close * adj')} AS close, {r('volume / adj')} AS volume, trades FROM pj")(
    lambda spark, sf: A.adjust(B.walk(spark, sf), factors(spark, sf)).select("symbol", "date", F.round("adj", 9).alias("adj"), r6("close").alias("close"), r6("volume").alias("volume"), "trades")
)
query("c15_rename", " SELECT CASE WHEN symbol % 10 = 3 THEN symbol + 1000000 WHEN symbol % 10 = 4 THEN symbol ELSE symbol END AS symbol, count(*) AS bars FROM b GROUP BY 1", dates=())(
    lambda spark, sf: A.rename(B.walk(spark, sf), B.walk(spark, sf).select(F.col("symbol").alias("old_symbol")).distinct().filter("old_symbol % 10 in (3, 4)").select("old_symbol", F.when(F.col("old_symbol") % 10 == 3, F.col("old_symbol") + 1000000).otherwise(F.col("old_symbol") - 1).alias("new_symbol"))).groupBy("symbol").agg(F.count("*").alias("bars"))
)
query("u5_universe_diff", " SELECT symbol, 'added' AS change FROM u WHERE symbol % 2 = 1 UNION ALL SELECT symbol, 'removed' FROM u WHERE symbol % 2 = 0 AND symbol % 3 <> 0", dates=())(lambda spark, sf: (lambda u: A.universe_diff(u.filter("symbol % 2 = 0"), u.filter("symbol % 3 = 0 OR symbol % 2 = 1")))(B.universe(spark, sf)))
query("u9_upsert", " SELECT symbol, CASE WHEN symbol % 3 = 0 OR symbol % 2 = 1 THEN upper(industry) ELSE industry END AS industry FROM u", dates=())(lambda spark, sf: (lambda u: L.upsert(u.filter("symbol % 2 = 0"), u.filter("symbol % 3 = 0 OR symbol % 2 = 1").withColumn("industry", F.upper("industry")), ["symbol"]))(B.universe(spark, sf).select("symbol", "industry")))
query("j2_industry", " SELECT symbol, company, industry FROM u", dates=())(B.universe)
query("j13_pending_sessions", " SELECT DISTINCT date FROM b WHERE date NOT IN (SELECT date FROM b WHERE symbol % 7 = 0)")(lambda spark, sf: L.sessions_pending(B.walk(spark, sf), B.walk(spark, sf).filter("symbol % 7 = 0")))
query("a10_modal_date", " SELECT date, n FROM (SELECT date, count(*) AS n FROM b GROUP BY 1) ORDER BY n DESC, date LIMIT 1")(lambda spark, sf: Fi.modal_date(B.walk(spark, sf)))
query("a11_store_stats", " SELECT symbol, min(date) AS first, max(date) AS last, count(*) AS bars FROM b GROUP BY 1", dates=("first", "last"))(lambda spark, sf: B.walk(spark, sf).groupBy("symbol").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count("*").alias("bars")))
query("p21_slug", " SELECT DISTINCT p_type, 'pat_' || substring(trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '_'), 1, 60) AS id, p_size, p_size || CASE WHEN p_size % 100 BETWEEN 11 AND 13 THEN 'th' WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END AS place FROM part", dates=())(
    lambda spark, sf: B.table(spark, sf, "part").select("p_type", slug("p_type").alias("id"), "p_size", ordinal("p_size").alias("place")).distinct()
)


@query("s1_bhav_parse", " SELECT symbol::VARCHAR AS symbol, CASE WHEN t % 3 = 0 THEN 'BE' ELSE 'EQ' END AS series, date, open, high, low, close, volume FROM b")
def s1_bhav_parse(spark, sf):
    b = B.walk(spark, sf)
    money = lambda c: F.concat(F.lit('"'), F.format_number(c, 2), F.lit('"'))

    def lines(series):
        return F.concat_ws(", ", F.col("symbol").cast("string"), series, F.date_format("date", "dd-MMM-yyyy"), money("open"), money("open"), money("high"), money("low"), money("close"), money("close"), money("close"), F.col("volume").cast("decimal(20,2)").cast("string"), F.lit("0"), F.lit("-"), F.lit(""), F.lit("x"))

    first = b.select(F.when(F.col("t") % 3 == 0, lines(F.lit("BE"))).otherwise(lines(F.lit("EQ"))).alias("value"))
    worse = b.filter("t % 3 <> 0").select(lines(F.lit("BZ")).alias("value"))
    other = b.select(lines(F.lit("GS")).alias("value"))
    return Fi.parse_bhav(first.unionByName(worse).unionByName(other)).select("symbol", "series", "date", "open", "high", "low", "close", "volume")


@query("s3_history_repair", " SELECT symbol::VARCHAR AS symbol, date, CASE WHEN t % 5 = 0 THEN close ELSE open END AS open, CASE WHEN t % 7 = 0 THEN greatest(close, low, CASE WHEN t % 5 = 0 THEN 0 ELSE open END) ELSE high END AS high, low, close, volume, round(100 * deliv_qty / volume, 6) AS deliv_per FROM b WHERE date >= DATE '1996-06-01'")
def s3_history_repair(spark, sf):
    b = B.walk(spark, sf).withColumns({"open": F.when(F.col("t") % 5 == 0, 0.0).otherwise(F.col("open")), "high": F.when(F.col("t") % 7 == 0, 0.0).otherwise(F.col("high"))})
    text = lambda seq, close: F.concat_ws(",", F.col("symbol").cast("string"), F.col("date").cast("string"), *[F.col(c).cast("decimal(20,2)").cast("string") for c in ("open", "high", "low")], close, *[F.col(c).cast("decimal(20,2)").cast("string") for c in ("volume", "deliv_qty")], F.lit(str(seq)))
    good, old, bad = text(2, F.col("close").cast("decimal(20,2)").cast("string")), text(1, F.lit("1.00")), text(3, F.lit("n/a"))
    lines = b.select(F.explode(F.array(good, old, bad)).alias("value"))
    return Fi.parse_history(lines, "1996-06-01").select("symbol", "date", "open", "high", "low", "close", "volume", F.round("deliv_per", 6).alias("deliv_per"))


# ---- decisions, reports ---------------------------------------------------------------------------------------------
def session_rows(spark, sf) -> DataFrame:
    """Scores of the last rows: the return ranks stand in for the model."""
    rows = last_rows(spark, sf)
    return rows.select("symbol", "close", F.round(F.col("close") * 0.02, 4).alias("atr"), (F.col("t") >= 209).alias("eligible"), F.col("ret_63").alias("p_long"), (-F.col("ret_21")).alias("p_short"))


#: A documented stand-in for the proven effects, which aren't public: timeframe, pattern, direction, effect, excess return and hit rate.
PROVEN_ROWS = [(tf, "52-week high breakout", 1, 1.0, 0.6, 0.02) for tf in ("ST", "MT", "LT")] + [("ST", "Key reversal day (bearish)", -1, -1.0, 0.7, 0.03), ("MT", "Key reversal day (bullish)", 1, 1.0, 0.4, 0.01), ("ST", "52-week low breakdown", -1, -1.0, 0.9, 0.2)]
PROVEN_ROWS += [("MT", "Darvas box breakout", 1, 1.0, 0.3, 0.02), ("LT", "Darvas box breakdown", -1, -1.0, 0.5, 0.01), ("ST", "Fibonacci 38-62% pullback bounce (uptrend)", 1, 1.0, 0.2, 0.01), ("MT", "Fibonacci 38-62% rally failure (downtrend)", -1, -1.0, 0.3, 0.02)]


def proven(spark) -> DataFrame:
    return spark.createDataFrame(PROVEN_ROWS, "tf string, pattern string, dir int, eff double, ex double, hx double")


def decisions(spark, sf) -> DataFrame:
    n = B.walk(spark, sf).groupBy("symbol").agg(F.max("t").alias("n"))
    active = Ev.events(B.walk(spark, sf), {r[1] for r in PROVEN_ROWS}).join(n, "symbol").filter("n - t < 60")
    return D.decide(session_rows(spark, sf), D.default_calibration(spark), D.evidence(active, proven(spark)))


CAL = "(VALUES " + ", ".join(f"('{tf}', {k}, '{D.LABELS[k]}', {round(0.15 + 0.05 * i + 0.03 * k, 4)}::DOUBLE, {round(-0.5 + 0.3 * k, 4)}::DOUBLE, {thr}::DOUBLE)" for i, (tf, thr) in enumerate((("ST", 0.5), ("MT", 1.0), ("LT", 2.0))) for k in range(6)) + ") cal(tf, k, label, y, ret, thr)"
PROVEN = "(VALUES " + ", ".join(f"('{tf}', '{p}', {d}, {e}::DOUBLE, {x}::DOUBLE, {h}::DOUBLE)" for tf, p, d, e, x, h in PROVEN_ROWS) + ") pr(tf, pattern, dir, eff, ex, hx)"
_bk = lambda q: "CASE " + " ".join(f"WHEN {q} >= {e} THEN {k}" for k, e in ((5, 0.95), (4, 0.85), (3, 0.7), (2, 0.5), (1, 0.2))) + f" WHEN {q} IS NOT NULL THEN 0 END"
#: Events that the decisions may read: those of bars, boxes and pullbacks.
ACTIVE = "(SELECT symbol, t, pattern, dir FROM ev" + "".join(f" UNION ALL SELECT symbol, t, pattern, dir FROM (WITH RECURSIVE {q.strip().removeprefix(',')})" for q in (DARVAS, FIBONACCI)) + ")"
EVIDENCE = (
    f", evi AS (SELECT DISTINCT ev.symbol, pr.tf, eff > 0 AS pro, ev.pattern, ex, hx FROM {ACTIVE} ev JOIN n USING (symbol) JOIN {PROVEN} ON pr.pattern = ev.pattern AND pr.dir = ev.dir WHERE n - ev.t < 60), es AS (SELECT symbol, tf, sum(CASE WHEN pro THEN ex ELSE -ex END) AS net_ret, sum(CASE WHEN pro THEN hx ELSE -hx END) AS net_hit FROM evi GROUP BY 1, 2)"
)
RATED = (
    f", ro AS (SELECT symbol, close, round(close * 0.02, 4) AS atr, t >= 209 AS el, CASE WHEN t >= 209 THEN ret_63 END AS pl, CASE WHEN t >= 209 THEN -ret_21 END AS ps FROM lp), rk AS (SELECT *, round({pct_rank('pl', '1')}, 8) AS qb, round({pct_rank('ps', '1')}, 8) AS qs FROM ro), "
    f"kk AS (SELECT rk.*, tf.*, {_bk('qb')} AS kl, {_bk('qs')} AS ks FROM rk, {TF})"
)
#: From rows of a session and timeframe (kk: standing, buckets, distances) and evidence (es) to calls.
RULES = (
    f", jj AS (SELECT kk.*, l.label AS l_label, s.label AS s_label, l.y, l.ret, l.thr, net_ret, coalesce(net_hit, 0.0) AS net_hit, ks >= 5 AS s_abs FROM kk LEFT JOIN {CAL.replace('cal(', 'l(')} ON l.tf = kk.tf AND l.k = kl LEFT JOIN {CAL.replace('cal(', 's(')} ON s.tf = kk.tf AND s.k = ks LEFT JOIN es ON es.symbol = kk.symbol AND es.tf = kk.tf), "
    "nn AS (SELECT *, round(least(greatest(coalesce(net_ret, 0.0), -3 * thr), 3 * thr), 8) AS net, greatest(-0.10, least(0.10, net_hit)) AS hit, kl >= 4 AS lm, ks >= 4 AS am FROM jj), "
    "ty AS (SELECT *, CASE WHEN NOT el OR qb IS NULL OR qs IS NULL THEN 'Not rated' WHEN kl = 5 AND net >= 0 AND NOT am THEN 'Strong Buy' WHEN ((lm AND net >= 0) OR (net >= thr AND kl > 0)) AND NOT am THEN CASE WHEN tf = 'LT' THEN 'Accumulate (buy on dips)' ELSE 'Buy' END WHEN am AND s_abs AND tf <> 'LT' AND net <= 0 AND NOT lm THEN CASE WHEN ks = 5 THEN 'Strong Short Sell' ELSE 'Short Sell' END "
    "WHEN (am AND net <= 0) OR (net <= -thr AND NOT lm) THEN CASE WHEN tf = 'LT' THEN 'Reduce / Avoid' ELSE 'Avoid (likely underperformer)' END WHEN (am AND net >= thr) OR (lm AND net <= -thr) THEN 'Hold (mixed signals)' ELSE 'Hold / No fresh trade' END AS type FROM nn), "
    "sd AS (SELECT *, CASE WHEN type IN ('Strong Buy', 'Buy', 'Accumulate (buy on dips)') THEN 1 WHEN type IN ('Short Sell', 'Strong Short Sell') THEN -1 ELSE 0 END AS side FROM ty), "
    f"dec AS (SELECT symbol, tf, type, side, {r('qb')} AS pct_buy, {r('qs')} AS pct_short, l_label AS bucket_buy, s_label AS bucket_short, CASE WHEN y IS NOT NULL THEN {r('greatest(0.01, least(0.99, y + hit))')} END AS conf_buy, {r('ret + net')} AS exp_ret_buy, {r('net')} AS net_evidence, "
    "CASE WHEN side <> 0 THEN floor((close + side * cm * atr) * 1e2 + 0.5) / 1e2 END AS entry_limit, CASE WHEN side <> 0 THEN floor((close + side * tm * atr) * 1e2 + 0.5) / 1e2 END AS target, CASE WHEN side <> 0 THEN floor((close - side * sm * atr) * 1e2 + 0.5) / 1e2 END AS stop FROM sd)"
)
DECIDE = EVENTS + LASTP + EVIDENCE + RATED + RULES
query("c7_decision", DECIDE + " SELECT * FROM dec", dates=())(decisions)
query("d4_top_picks", DECIDE + " SELECT tf, place, symbol, type, exp_ret_buy, pct_buy FROM (SELECT *, row_number() OVER (PARTITION BY tf ORDER BY CASE WHEN type = 'Strong Buy' THEN 0 ELSE 1 END, exp_ret_buy DESC, pct_buy DESC, symbol)::INT AS place FROM dec WHERE side > 0) WHERE place <= 5", dates=())(lambda spark, sf: D.top_picks(decisions(spark, sf)))
query("d5_top_avoid", DECIDE + " SELECT tf, place, symbol, pct_short FROM (SELECT *, row_number() OVER (PARTITION BY tf ORDER BY pct_short DESC, symbol)::INT AS place FROM dec WHERE type IN ('Avoid (likely underperformer)', 'Reduce / Avoid')) WHERE place <= 10", dates=())(lambda spark, sf: D.top_avoids(decisions(spark, sf)))
_sc = "CASE type WHEN 'Strong Buy' THEN 0 WHEN 'Buy' THEN 1 WHEN 'Accumulate (buy on dips)' THEN 1 WHEN 'Hold (mixed signals)' THEN 2 WHEN 'Hold / No fresh trade' THEN 3 WHEN 'Avoid (likely underperformer)' THEN 4 WHEN 'Reduce / Avoid' THEN 4 WHEN 'Short Sell' THEN 5 WHEN 'Strong Short Sell' THEN 6 END"
query("r3_by_stock", DECIDE + " SELECT symbol, " + ", ".join(f"max(CASE WHEN tf = '{x}' THEN type END) AS {x}" for x in ("ST", "MT", "LT")) + f", {r(f'avg({_sc})')} AS score, max(pct_buy) AS best_rank FROM dec GROUP BY symbol", dates=())(lambda spark, sf: D.by_symbol_report(decisions(spark, sf)))
query("a13_call_counts", DECIDE + " SELECT tf, type, count(*) AS n FROM dec GROUP BY 1, 2", dates=())(lambda spark, sf: decisions(spark, sf).groupBy("tf", "type").agg(F.count("*").alias("n")))


@query("c8_ledger_insert", EVAL + ", old AS (SELECT symbol, tf, kind, signal_date, status, 0 AS rep, signal_date AS seen FROM led WHERE signal_date < DATE '2000-01-01'), td AS (SELECT symbol, tf, kind, max(signal_date) AS s FROM calls WHERE signal_date >= DATE '2000-01-01' GROUP BY 1, 2, 3), o2 AS (SELECT old.symbol, old.tf, old.kind, signal_date, status, CASE WHEN status = 'Open' AND s > seen THEN 1 ELSE 0 END AS repeat_count, CASE WHEN status = 'Open' AND s > seen THEN s ELSE seen END AS last_seen FROM old LEFT JOIN td USING (symbol, tf, kind)) SELECT * FROM o2 UNION ALL SELECT symbol, tf, kind, signal_date, 'Pending', 0, signal_date FROM calls WHERE signal_date >= DATE '2000-01-01' AND (symbol, tf, kind) NOT IN (SELECT (symbol, tf, kind) FROM old WHERE status = 'Open')", dates=("signal_date", "last_seen"))
def c8_ledger_insert(spark, sf):
    c = calls(spark, sf)
    old = ledger(spark, sf).filter("signal_date < DATE '2000-01-01'").select("symbol", "tf", "kind", "signal_date", "status", F.lit(0).alias("repeat_count"), F.col("signal_date").alias("last_seen"))
    return L.insert_calls(old, c.filter("signal_date >= DATE '2000-01-01'").select("symbol", "tf", "kind", "signal_date"))


@query("j9_market_average", CALLS + ", s AS (SELECT DISTINCT signal_date AS d0, b.date AS d1 FROM calls JOIN b ON b.symbol = calls.symbol AND b.t = t0 + max_days) SELECT d0, d1, floor(round(avg(y.close / x.close - 1), 9) * 1e6 + 0.5) / 1e6 AS mkt FROM s JOIN b x ON x.date = d0 JOIN b y ON y.date = d1 AND y.symbol = x.symbol GROUP BY 1, 2", dates=("d0", "d1"))
def j9_market_average(spark, sf):
    bars = B.walk(spark, sf)
    c = L.crossover_calls(bars).withColumn("t1", F.col("t0") + F.col("max_days"))
    end = c.join(bars.select("symbol", F.col("t").alias("t1"), F.col("date").alias("d1")), ["symbol", "t1"])
    return L.market_average(end.withColumn("d0", F.col("signal_date")), bars).select("d0", "d1", r6("mkt").alias("mkt"))


@query("t4_late_bench", ", se AS (SELECT date FROM m), k AS (SELECT date, CASE WHEN (row_number() OVER (ORDER BY date)) % 5 <> 0 OR (row_number() OVER (ORDER BY date)) % 10 = 0 THEN bench END AS v FROM m) SELECT 'NIFTY50' AS key, date, round(last_value(v IGNORE NULLS) OVER (ORDER BY date), 6) AS bench, v IS NULL AS is_placeholder FROM k")
def t4_late_bench(spark, sf):
    m = B.benchmark(B.walk(spark, sf)).withColumns({"n": F.row_number().over(Window.orderBy("date")), "key": F.lit("NIFTY50")})  # a row a session
    known, late = m.filter("n % 5 <> 0").select("key", "date", "bench"), m.filter("n % 10 = 0").select("key", "date", "bench")
    return A.fill_late(known, m.select("key", "date"), late).withColumn("bench", F.round("bench", 6))



@query("t1_stream_bars", "SELECT event_type AS symbol, date_trunc('hour', ts) AS hour, round(arg_min(value, (ts, event_id)), 6) AS open, round(max(value), 6) AS high, round(min(value), 6) AS low, round(arg_max(value, (ts, event_id)), 6) AS close, count(*) AS volume FROM events GROUP BY 1, 2", bars=False, dates=())
def t1_stream_bars(spark, sf):
    from tickloom.streaming import jobs

    schema = B.table(spark, sf, "events").schema
    got = jobs.run_hourly(spark, sf, "events.parquet", schema)
    return got.select("symbol", F.col("hour").cast("timestamp_ntz").alias("hour"), *[F.round(c, 6).alias(c) for c in ("open", "high", "low", "close")], "volume")
