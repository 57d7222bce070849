"""Queries of a session's decisions on model scores, all ranks of the day, the market's features, trends and remarks, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exprs import r6
from tickloom.functions.sqltext import div, r
from tickloom.operators import candles as C
from tickloom.operators import charts
from tickloom.operators import crosssection as X
from tickloom.operators import events as Ev
from tickloom.operators import features as Fe
from tickloom.operators import model as M
from tickloom.operators import patterns as P
from tickloom.operators import standing as St
from tickloom.operators.tables import derive, derive_sql
from tickloom.operators.windows import with_bench
from tickloom.plans import decide as D
from tickloom.plans import registry2 as Q
from tickloom.plans import registry4 as G4
from tickloom.plans import remarks as Rm
from tickloom.plans import reports as R
from tickloom.plans.registry import ORACLE_SQL, query
from tickloom.sources import bars as B
from tickloom.streaming import jobs

W = B.walk
nested = lambda q: f"(WITH RECURSIVE {q.strip().removeprefix(',')})"
registered = lambda name: ORACLE_SQL[name].split(B.BARS_SQL, 1)[1].removesuffix(")")


def written(spark, df: DataFrame, kind: str) -> DataFrame:
    """A session's rows in the shared folder, since several steps read them: a row a symbol."""
    path = jobs.state_folder(spark, kind)
    df.write.parquet(path)
    return spark.read.parquet(path)


# ---- ranks of the day ---------------------------------------------------------------------------------------------
_text = [c for c in St.RANKED if c != "maxdd_252"]
_sb, _sl = derive_sql("bq", St.COLUMNS, _text, "sd")
STANDING = (
    ", bq AS (SELECT b.*, bench FROM b JOIN m USING (date))" + _sb + f", sl AS (SELECT symbol, t, {', '.join(_text)} FROM {_sl} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1), "
    "fl AS (SELECT symbol, CASE WHEN count(*) >= 201 THEN 100 * min(c / peak - 1) END AS maxdd_252 FROM (SELECT b.symbol, b.close AS c, max(b.close) OVER (PARTITION BY b.symbol ORDER BY b.t) AS peak FROM b JOIN sl ON sl.symbol = b.symbol AND b.t > sl.t - 252) GROUP BY 1), "
    f"ss AS (SELECT symbol, DATE '2001-12-31' AS date, {', '.join(f'round({c}, 8) AS {c}' for c in St.RANKED)} FROM sl JOIN fl USING (symbol))"
)


def session_standing(spark, sf) -> DataFrame:
    bars = W(spark, sf)
    return written(spark, X.latest(St.standing(with_bench(bars, B.benchmark(bars)))).withColumn("date", F.lit("2001-12-31").cast("date")), "standing")


query("c2_all_ranks", STANDING + " SELECT symbol, date, " + ", ".join(f"{r(Q.pct_rank(c, '1'))} AS xs_rank_{c}" for c in St.RANKED) + " FROM ss")(lambda s, f: St.day_ranks(session_standing(s, f)))

# ---- the market -----------------------------------------------------------------------------------------------------
#: Caps of the test tables' symbols: a third each, by the account balance that stands for size.
_cap = lambda x: f"CASE WHEN {x} < 2500 THEN 'small' WHEN {x} < 6500 THEN 'mid' ELSE 'large' END"
_some = lambda cap: f"floor(sum(CASE WHEN cap = '{cap}' THEN round(close * 100)::BIGINT END) / nullif(count_if(cap = '{cap}'), 0) / 100 * 1e4 + 0.5) / 1e4"
_carry = lambda c: f"last_value({c} IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
_shown = [n for n in St.MARKET_SHOWN]
_mb, _ml = derive_sql("ix", St.MARKET, _shown, "mk")
_s = {n: f"round(CASE WHEN count(bench) OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) >= {n} THEN avg(bench) OVER (ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) END, 8)" for n in (50, 200)}
query(
    "c5_market_features",
    f", cp AS (SELECT s_suppkey AS symbol, {_cap('s_acctbal')} AS cap FROM supplier), i0 AS (SELECT b.date, {_some('small')} AS sc, {_some('mid')} AS mc FROM b LEFT JOIN cp USING (symbol) GROUP BY 1), "
    f"ix AS MATERIALIZED (SELECT 0 AS symbol, row_number() OVER (ORDER BY date) - 1 AS t, date, bench, {_carry('sc')} AS sc, {_carry('mc')} AS mc FROM i0 JOIN m USING (date))"
    + _mb + f", rg AS (SELECT *, {_s[50]} AS s50, {_s[200]} AS s200 FROM {_ml}) SELECT date, " + ", ".join(f"{r(c)} AS {c}" for c in _shown) + ", CASE WHEN bench > s50 AND bench > s200 THEN 1 WHEN bench < s50 AND bench < s200 THEN -1 ELSE 0 END AS regime FROM rg",
)(lambda s, f: St.market_features(St.cap_indices(W(s, f), B.table(s, f, "supplier").select(F.col("s_suppkey").alias("symbol"), F.expr(_cap("s_acctbal")).alias("cap")))))

# ---- decisions on scores ----------------------------------------------------------------------------------------------
FACTS = ["dist_ema20", "slope_sma50", "dist_sma200", "slope_sma200", "dist_52w_high", "deliv_pct_5_minus_20"]
#: The floor of turnover for the test tables, whose prices and volumes are made up: the published one is 10.
FLOOR = 0.00022
_fb, _fl = derive_sql("b", Fe.COLUMNS, [*M.FEATURES, "atr14", "turn20", *FACTS], "fx")
_kept = [*M.FEATURES, *FACTS]
LAST = _fb + f", fa AS MATERIALIZED (SELECT symbol, t, close, round(atr14, 4) AS atr, round(turn20, 9) AS turnover, {', '.join(f'round({c}, 8) AS {c}' for c in _kept)} FROM {_fl} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1)"
_tags = ", ".join(f"1 / (1 + exp(-({bias!r}::DOUBLE + {' + '.join(M.tree_sql(x) for x in trees)}))) AS {tag}" for tag, (bias, trees) in M.stand_in().items())
_el = f"(t >= 209 AND coalesce(turnover >= {FLOOR}, false) AND atr IS NOT NULL)"
SCORED = (
    Q.EVENTS + LAST + f", sm AS (SELECT *, {_tags} FROM fa)" + Q.EVIDENCE + ", ro AS (" + " UNION ALL ".join(f"SELECT symbol, '{tf}' AS tf, close, atr, {_el} AS el, CASE WHEN {_el} THEN round({tf}_L, 8) END AS pl, CASE WHEN {_el} THEN round({tf}_S, 8) END AS ps FROM sm" for tf in M.AHEAD)
    + f"), rk AS (SELECT *, round({Q.pct_rank('pl', 'tf')}, 8) AS qb, round({Q.pct_rank('ps', 'tf')}, 8) AS qs FROM ro), kk AS (SELECT rk.*, sm, tm, cm, hold, {Q._bk('qb')} AS kl, {Q._bk('qs')} AS ks FROM rk JOIN {Q.TF} USING (tf))" + Q.RULES
)


def session_facts(spark, sf) -> DataFrame:
    """Each symbol's last bar: close, true range, turnover, the model's features and what remarks read."""
    df = X.latest(derive(W(spark, sf), Fe.COLUMNS, [*M.FEATURES, "atr14", "turn20", *FACTS, "t", "close"], only=True))
    df = df.select("symbol", "t", "close", F.round("atr14", 4).alias("atr"), F.round("turn20", 9).alias("turnover"), *[F.round(c, 8).alias(c) for c in _kept])
    return written(spark, df, "facts")


def active_events(spark, sf) -> DataFrame:
    """Events of proven names within the last 60 bars."""
    n = W(spark, sf).groupBy("symbol").agg(F.max("t").alias("n"))
    return Ev.events(W(spark, sf), {x[1] for x in Q.PROVEN_ROWS}).join(n, "symbol").filter("n - t < 60")


def scored_decisions(spark, sf, facts: DataFrame | None = None) -> DataFrame:
    facts = session_facts(spark, sf) if facts is None else facts
    scores = M.scores(facts.select("symbol", *M.FEATURES), M.read_model(M.write_model(M.FEATURES, M.stand_in()))).select("symbol", *M.TAGS)
    return D.decide(D.scored_rows(scores, facts.select("symbol", "close", "atr", "t", "turnover"), least_turnover=FLOOR), D.default_calibration(spark), D.evidence(active_events(spark, sf), Q.proven(spark)))


query("c7_scored_decision", SCORED + " SELECT * FROM dec", dates=())(scored_decisions)
query("p7_eligible", LAST + f" SELECT symbol, t + 1 AS bars, {_el} AS eligible FROM fa", dates=())(lambda s, f: session_facts(s, f).select("symbol", (F.col("t") + 1).alias("bars"), ((F.col("t") >= 209) & F.coalesce(F.col("turnover") >= FLOOR, F.lit(False)) & F.col("atr").isNotNull()).alias("eligible")))
query("d5_scored_avoid", SCORED + " SELECT tf, place, symbol, pct_short FROM (SELECT dec.*, row_number() OVER (PARTITION BY tf ORDER BY pct_short DESC, turnover DESC NULLS LAST, symbol)::INT AS place FROM dec JOIN fa USING (symbol) WHERE type IN ('Avoid (likely underperformer)', 'Reduce / Avoid')) WHERE place <= 10", dates=())(
    lambda s, f: (lambda x: D.top_avoids(scored_decisions(s, f, x), turnover=x))(session_facts(s, f))
)
query("p15_call_kinds", SCORED + " SELECT symbol, tf, CASE WHEN type IN ('Strong Buy', 'Buy', 'Accumulate (buy on dips)') THEN 'BUY' WHEN type IN ('Short Sell', 'Strong Short Sell') THEN 'SHORT' WHEN type IN ('Avoid (likely underperformer)', 'Reduce / Avoid') THEN 'AVOID' END AS kind FROM dec", dates=())(
    lambda s, f: scored_decisions(s, f).select("symbol", "tf", D.call_kind("type").alias("kind"))
)
query(
    "j16_scores_against_ranks",
    f", d1 AS MATERIALIZED (SELECT * FROM {nested(Q.DECIDE + ' SELECT * FROM dec')}), d2 AS MATERIALIZED (SELECT * FROM {nested(SCORED + ' SELECT * FROM dec')}) SELECT count(*) AS n, count_if(a.type IS DISTINCT FROM b.type)::BIGINT AS n_types, "
    + ", ".join(f"{r(f'max(abs(a.{c} - b.{c}))')} AS d_{c}" for c in ("pct_buy", "net_evidence", "target")) + " FROM d1 a JOIN d2 b USING (symbol, tf)", dates=(),
)(lambda s, f: R.compare(Q.decisions(s, f), scored_decisions(s, f), ["symbol", "tf"], ["pct_buy", "net_evidence", "target"]))

# ---- trends, remarks, verdicts ------------------------------------------------------------------------------------------
_tb, _tl = derive_sql("b", Fe.COLUMNS, ["dist_ema20", "atr10"], "tx")
SUPERTREND = _tb + (
    f", sx AS MATERIALIZED (SELECT symbol, date, t, close, dist_ema20, (high + low) / 2 + 3 * atr10 AS ub, (high + low) / 2 - 3 * atr10 AS lb, atr10 FROM {_tl}), s0 AS (SELECT symbol, min(t) AS t FROM sx WHERE atr10 IS NOT NULL GROUP BY 1), "
    "sr AS (SELECT sx.symbol, sx.t, close AS c, ub AS hi, lb AS lo, true AS up FROM sx JOIN s0 ON s0.symbol = sx.symbol AND s0.t = sx.t UNION ALL "
    "SELECT symbol, t, close, hi, lo, CASE WHEN up THEN close >= lo ELSE close > hi END FROM (SELECT x.symbol, x.t, x.close, k.up, CASE WHEN x.ub < k.hi OR k.c > k.hi THEN x.ub ELSE k.hi END AS hi, CASE WHEN x.lb > k.lo OR k.c < k.lo THEN x.lb ELSE k.lo END AS lo FROM sr k JOIN sx x ON x.symbol = k.symbol AND x.t = k.t + 1))"
)
query("p14_short_trend", SUPERTREND + " SELECT sx.symbol, sx.date, CASE WHEN round(dist_ema20, 8) > 0 AND up THEN 'Up' WHEN round(dist_ema20, 8) < 0 AND NOT up THEN 'Down' ELSE 'Sideways' END AS trend_st FROM sx LEFT JOIN sr ON sr.symbol = sx.symbol AND sr.t = sx.t")(
    lambda s, f: derive(W(s, f), Fe.COLUMNS, ["dist_ema20", "ta_SUPERTREND_trend"]).select("symbol", "date", Rm.short_trend(F.round("dist_ema20", 8), F.col("ta_SUPERTREND_trend")).alias("trend_st"))
)

_w = lambda e: f"floor(({e}) + 0.5)::BIGINT::VARCHAR"
_top = lambda q: f"greatest(1, floor(100 * (1 - {q}) + 0.5)::INT)::VARCHAR"
_sg = lambda e, k: f"CASE WHEN floor({e} * 1e{k} + 0.5) >= 0 THEN '+' ELSE '' END || " + (f"(floor({e} * 1e{k} + 0.5) / 1e{k})::VARCHAR" if k else _w(e))
_hz = "CASE tf WHEN 'ST' THEN '2 weeks' WHEN 'MT' THEN '3 months' ELSE '1 year' END"
_rank = f"'Ranked in the top ' || {_top('pct_buy')} || '% for the next ' || {_hz} || '.'"
_odds = f"'Confidence ' || {_w('100 * conf_buy')} || '%, expected ' || {_sg('exp_ret_buy', 1)} || '% a trade after costs.'"
_high = f"CASE WHEN pct_buy >= 0.85 THEN {_rank} END"
_ord = "greatest(1, floor(100 * pct_buy + 0.5)::INT)"
_nth = f"{_ord}::VARCHAR || CASE WHEN {_ord} % 100 BETWEEN 11 AND 13 THEN 'th' WHEN {_ord} % 10 = 1 THEN 'st' WHEN {_ord} % 10 = 2 THEN 'nd' WHEN {_ord} % 10 = 3 THEN 'rd' ELSE 'th' END"
_way = lambda d: f"CASE WHEN {d} > 0 THEN 'above' ELSE 'below' END"
_avg = lambda n: f"{_way(f'dist_sma{n}')} || ' a ' || CASE WHEN slope_sma{n} > 0 THEN 'rising' ELSE 'falling' END || ' {n}-bar average'"
REMARK = (
    f"CASE WHEN type = 'Not rated' AND t + 1 < 210 THEN 'Not rated: ' || (t + 1) || ' sessions of history, 210 are needed.' WHEN type = 'Not rated' THEN 'Not rated: turnover is below the floor.' WHEN type = 'Strong Buy' THEN concat_ws(' ', {_rank}, {_odds}) "
    f"WHEN type IN ('Buy', 'Accumulate (buy on dips)') THEN concat_ws(' ', {_high}, 'Setups at work: ' || evidence || '.', {_odds}, CASE WHEN type <> 'Buy' THEN 'Build the position on dips.' END) "
    f"WHEN type IN ('Short Sell', 'Strong Short Sell') THEN 'Among the weakest for the next ' || {_hz} || ' (top ' || {_top('pct_short')} || '% on the short side).' "
    f"WHEN type IN ('Avoid (likely underperformer)', 'Reduce / Avoid') THEN concat_ws(' ', CASE WHEN pct_short >= 0.85 THEN 'Likely to lag over ' || {_hz} || ' (top ' || {_top('pct_short')} || '% on the short side).' END, 'Signals: ' || evidence || '.', CASE WHEN tf = 'ST' THEN 'No new purchase.' ELSE 'No new purchase; holders tighten stops.' END) "
    f"WHEN type = 'Hold (mixed signals)' THEN 'Model and signals disagree' || coalesce(': ' || evidence, '') || '. No new trade.' ELSE 'No edge either way over ' || {_hz} || ' (' || {_nth} || ' percentile). No new trade.' END || ' Technicals: ' || "
    f"concat_ws('; ', 'RSI ' || {_w('rsi14')}, 'RS rating ' || rs_rating::INT, {_w('dist_52w_high')} || '% from the 52-week high', CASE tf WHEN 'ST' THEN {_way('dist_ema20')} || ' the 20-bar average' WHEN 'MT' THEN {_avg(50)} ELSE {_avg(200)} END, "
    f"CASE WHEN abs(deliv_pct_5_minus_20) >= 5 THEN 'delivery ' || CASE WHEN deliv_pct_5_minus_20 > 0 THEN 'rising' ELSE 'falling' END || ' (' || {_sg('deliv_pct_5_minus_20', 0)} || ' points)' END, CASE WHEN atr_pct_14 > 5 THEN 'volatile (' || (floor(atr_pct_14 * 10 + 0.5) / 10)::VARCHAR || '% a day)' END) || '.'"
)


def session_remarks(spark, sf, facts: DataFrame, calls: DataFrame | None = None) -> DataFrame:
    calls = scored_decisions(spark, sf, facts) if calls is None else calls
    rated = facts.withColumn("bars", F.col("t") + 1).join(X.rs_rating(Q.last_rows(spark, sf)).select("symbol", "rs_rating"), "symbol")
    return Rm.remarks(calls, rated, R.evidence_list(active_events(spark, sf), Q.proven(spark)))


_evt = f", ej AS (SELECT ev.symbol, tf, ev.pattern, eff > 0 AS pro, ex, ev.t FROM {Q.ACTIVE} ev JOIN n USING (symbol) JOIN {Q.PROVEN} ON pr.pattern = ev.pattern AND pr.dir = ev.dir WHERE n - ev.t < 60), eo AS (SELECT symbol, tf, pro, pattern, arg_max(ex, t) AS ex FROM ej GROUP BY ALL), ep AS (SELECT *, row_number() OVER (PARTITION BY symbol, tf, pro ORDER BY ex DESC, pattern) AS k FROM eo), et AS (SELECT symbol, tf, substring(string_agg(CASE WHEN pro THEN '+ ' ELSE '- ' END || pattern, '; ' ORDER BY NOT pro, k), 1, 500) AS evidence FROM ep WHERE k <= 2 GROUP BY 1, 2)"
query("p25_remarks", SCORED + _evt + f", rr AS (SELECT symbol, rs_rating FROM {nested(registered('c1_rs_rating'))}) SELECT symbol, tf, type, {REMARK} AS remark FROM dec JOIN fa USING (symbol) JOIN rr USING (symbol) LEFT JOIN et USING (symbol, tf)", dates=())(
    lambda s, f: session_remarks(s, f, session_facts(s, f))
)

# The card of gaps, declines and islands of line items' daily prices, where declines occur.
_t = "(tstat_60 * CASE WHEN dir < 0 THEN -1 ELSE 1 END)"
_raw = f"CASE WHEN n_60 < {Rm.LEAST_EVENTS} OR tstat_60 IS NULL THEN 'Too few events' WHEN {_t} >= {Rm.SURE} THEN 'Works (significant)' WHEN {_t} <= -{Rm.SURE} THEN 'Works in reverse (fade it)' WHEN {_t} >= {Rm.LIKELY} THEN 'Weak edge' WHEN {_t} <= -{Rm.LIKELY} THEN 'Weak - tends to fail' ELSE 'No reliable edge' END"
_word = "CASE verdict " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in Rm.SHORT_VERDICT.items()) + " END"
_names = ", ".join(f"'{n}'" for n in Rm.ILLUSIONS)
_ev = " UNION ALL ".join(f"SELECT symbol, t, pattern, family, dir FROM {nested(q)}" for q in (Q.gaps_sql("b0"), Q.PATTERN_SQL["pat_event_decline"].replace("FROM b)", "FROM b0)"), Q.islands_sql("b0")))
_stats = ", ".join(f"count(c{n}) AS n_{n}, {r(div(f'avg(100 * (c{n} / c - 1))', f'(stddev_samp(100 * (c{n} / c - 1)) / sqrt(count(c{n})))'))} AS tstat_{n}" for n in (10, 60))
query(
    "p24_verdicts",
    Q._t0 + f", ev AS ({_ev}), fw AS (SELECT symbol, t, close AS c, lead(close, 10) OVER (PARTITION BY symbol ORDER BY date) AS c10, lead(close, 60) OVER (PARTITION BY symbol ORDER BY date) AS c60 FROM b0), "
    f"card AS (SELECT pattern, family, dir, count(*) AS n, {_stats} FROM ev JOIN fw USING (symbol, t) GROUP BY 1, 2, 3), v AS (SELECT *, {_raw} AS raw FROM card), w AS (SELECT *, CASE WHEN pattern IN ({_names}) AND raw NOT IN ('No reliable edge', 'Too few events', '') THEN 'Survivorship illusion' ELSE raw END AS verdict FROM v) "
    f"SELECT pattern, family, dir, n, raw, verdict, {_word} AS word FROM w", bars=False, dates=(),
)(lambda s, f: (lambda b: Rm.verdicts(R.report_card(P.gaps(b).unionByName(P.event_declines(b)).unionByName(P.islands(b)), b)))(Q.noisy(s, f)))


# ---- the sheet and the catalogue ------------------------------------------------------------------------------------------
@query(
    "r2_session_sheet",
    SCORED + _evt + f", rr AS (SELECT symbol, rs_rating FROM {nested(registered('c1_rs_rating'))}), st AS (SELECT symbol, trend_st FROM {nested(registered('p14_short_trend'))} QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) = 1), "
    f"sc AS (SELECT symbol, avg({G4._std}) AS score, max(CASE WHEN tf = 'ST' THEN pct_buy END) AS best FROM dec GROUP BY 1), pl AS (SELECT symbol, row_number() OVER (ORDER BY round(score, 8), -coalesce(best, -1.0), symbol) AS place FROM sc) "
    "SELECT place, symbol, company, industry, tf, type, CASE WHEN type IN ('Strong Buy', 'Buy', 'Accumulate (buy on dips)') THEN 'BUY' WHEN type IN ('Short Sell', 'Strong Short Sell') THEN 'SHORT' WHEN type IN ('Avoid (likely underperformer)', 'Reduce / Avoid') THEN 'AVOID' END AS kind, pct_buy, pct_short, bucket_buy, bucket_short, conf_buy, exp_ret_buy, net_evidence, "
    f"close AS price, atr, entry_limit, target, stop, {r('CASE WHEN side <> 0 THEN abs(target - close) / close END')} AS profit, {r('CASE WHEN side <> 0 THEN abs(close - stop) / close END')} AS loss, CASE WHEN side <> 0 THEN CASE tf " + " ".join(f"WHEN '{x[0]}' THEN {x[4]}" for x in Q.L.TIMEFRAMES) + " END END AS days, "
    f"CASE tf WHEN 'ST' THEN trend_st WHEN 'MT' THEN {G4._way(50)} ELSE {G4._way(200)} END AS trend, evidence, {REMARK} AS remark FROM dec JOIN fa USING (symbol) JOIN rr USING (symbol) JOIN st USING (symbol) JOIN pl USING (symbol) JOIN u USING (symbol) LEFT JOIN et USING (symbol, tf)", dates=(),
)
def r2_session_sheet(spark, sf):
    facts = session_facts(spark, sf)
    calls = written(spark, scored_decisions(spark, sf, facts), "calls")
    short = X.latest(derive(W(spark, sf), Fe.COLUMNS, ["dist_ema20", "ta_SUPERTREND_trend"], only=True)).select("symbol", Rm.short_trend(F.round("dist_ema20", 8), F.col("ta_SUPERTREND_trend")).alias("trend_st"))
    return R.session_sheet(calls, facts.join(short, "symbol"), B.universe(spark, sf), R.evidence_list(active_events(spark, sf), Q.proven(spark)), session_remarks(spark, sf, facts, calls))


#: Columns of the catalogue: what the features and candles have SQL for.
_listed = {"Indicator": Fe.WINDOWED + Fe.LEVELS, "Candlestick": C.NAMES}
_known = ", ".join(f"count({n}) AS {n}" for n in _listed["Indicator"])
_cb, _cl = derive_sql("b", Fe.COLUMNS, _listed["Indicator"], "cf")
_kb, _kl = derive_sql("b", C.COLUMNS, C.NAMES, "ck")
_model = ", ".join(f"'{n}'" for n in M.FEATURES)
query(
    "r8_catalogue",
    Q.EVENTS + _cb + _kb + f", c1 AS (SELECT {_known} FROM {_cl}), c2 AS (SELECT {', '.join(f'count_if({n} <> 0)::BIGINT AS {n}' for n in C.NAMES)} FROM {_kl}), ct AS (SELECT 'Indicator' AS type, '' AS family, name, n FROM (UNPIVOT c1 ON COLUMNS(*) INTO NAME name VALUE n) UNION ALL SELECT 'Candlestick', '', name, n FROM (UNPIVOT c2 ON COLUMNS(*) INTO NAME name VALUE n) "
    f"UNION ALL SELECT 'Pattern', family, pattern, count(*) FROM ev GROUP BY 1, 2, 3) SELECT type, family, name, n, name IN ({_model}) AS in_model FROM ct", dates=(),
)(lambda s, f: R.catalogue(derive(W(s, f), Fe.COLUMNS, _listed["Indicator"], only=True), _listed["Indicator"], derive(W(s, f), C.COLUMNS, C.NAMES, only=True), C.NAMES, Q.some_events(s, f), M.FEATURES))


# ---- last-bar pattern features of every pattern of bars and weeks ------------------------------------------------------------
VOCABULARY = sorted({n for p in P.PATTERNS for n in p.names} | set(charts.WEEKLY))
query(
    "c18_all_patterns",
    Q.EVENTS + " SELECT n.symbol, " + ", ".join(f"{e} AS {k}" for k, e in Q._cnt.items() if k != "net_20") + ", " + ", ".join("round(coalesce(max(CASE WHEN pattern = '{}' AND n - ev.t <= 30 THEN exp(-(n - ev.t) / 10.0) END), 0.0), 6) AS {}".format(p.replace("'", "''"), P.pattern_id(p)) for p in VOCABULARY) + " FROM n LEFT JOIN ev USING (symbol) GROUP BY n.symbol", dates=(),
)(lambda s, f: P.pattern_features(Q.some_events(s, f), W(s, f), VOCABULARY).select("symbol", *[k for k in Q._cnt if k != "net_20"], *[P.pattern_id(p) for p in VOCABULARY]))
