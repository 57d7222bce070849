"""Queries over the whole event table, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.exprs import r6, safe_div
from tickloom.functions.sqltext import S, div, r
from tickloom.operators import events as Ev
from tickloom.operators import features as Fe
from tickloom.operators import hilbert as H
from tickloom.operators import model as M
from tickloom.operators import patterns as P
from tickloom.operators import signals as Sg
from tickloom.operators import windows as W
from tickloom.operators.tables import derive, derive_sql
from tickloom.plans import registry2 as Q
from tickloom.plans import registry6 as R
from tickloom.plans.registry import ORACLE_SQL, query
from tickloom.sources import bars as B

_parts = [R.DIVERGENCES, R.LEVELS, R.FIBONACCI, R.BOXES, R.DARVAS, R.FLAGS, R.CHARTS + "SELECT symbol, date, t, pattern, family, dir FROM ev", Q.PIPES_SQL]
_cols = ", ".join(Ev.COLUMNS)
ALL_PATTERNS = Q.EVENTS + ", pe AS MATERIALIZED (SELECT " + _cols + " FROM ev UNION ALL " + " UNION ALL ".join(f"SELECT {_cols} FROM (WITH RECURSIVE {q.strip().removeprefix(',')})" for q in _parts[:-1]) + ")"
_signals = [ORACLE_SQL[n].split(B.BARS_SQL, 1)[1].removesuffix(")") for n in ("sig_smoothed", "sig_candles")]
ALL_EVENTS = ALL_PATTERNS + ", ae AS (SELECT " + _cols + " FROM pe UNION ALL " + " UNION ALL ".join(f"SELECT {_cols} FROM (WITH RECURSIVE {q.strip().removeprefix(',')})" for q in _signals) + ")"
#: Signals with SQL.
_with_sql = [s for s, rules in zip(Ev.SIGNALS, (Sg.SMOOTH_RULES, Sg.CANDLE_RULES, Sg.KERNEL_RULES), strict=True) if rules is not Sg.KERNEL_RULES]

query("u2_all_events", ALL_EVENTS + " SELECT symbol, date, pattern, dir FROM ae")(lambda spark, sf: Ev.events(B.walk(spark, sf), sources=[*Ev.PATTERNS, *_with_sql]).select("symbol", "date", "pattern", "dir"))
_cnt = Q._cnt
query("a4_all_pattern_counts", ALL_PATTERNS + ", c AS (SELECT n.symbol, " + ", ".join(f"{e.replace('ev.', 'pe.')} AS {k}" for k, e in _cnt.items()) + " FROM n LEFT JOIN pe USING (symbol) GROUP BY n.symbol) SELECT *, bull_20 - bear_20 AS net_20 FROM c", dates=())(
    lambda spark, sf: (lambda b: P.pattern_counts(Ev.events(b), b))(B.walk(spark, sf))
)


@query("ta_hilbert")
def ta_hilbert(spark, sf):
    return H.cycles(B.walk(spark, sf)).select("symbol", "date", *[r6(c).alias(c) for c in (*H.SHORT, *H.LONG)])

_model = M.stand_in()
_fb, _fl = derive_sql("b", Fe.COLUMNS, M.FEATURES, "mf")
_shown = ", ".join(f"round({c}, 8) AS {c}" for c in M.FEATURES)
SCORES = _fb + f", mx AS (SELECT symbol, date, t, {_shown} FROM {_fl}), ms AS MATERIALIZED (SELECT symbol, date, t, " + ", ".join(f"1 / (1 + exp(-({bias!r}::DOUBLE + {' + '.join(M.tree_sql(x) for x in trees)}))) AS {tag}" for tag, (bias, trees) in _model.items()) + " FROM mx)"
AUC = SCORES + ", mr AS (SELECT symbol, t, year(date) AS year, " + ", ".join(f"lead(close, {n}) OVER ({S}) / close - 1 AS r_{tf}" for tf, n in M.AHEAD.items()) + " FROM b), ml AS (" + " UNION ALL ".join(f"SELECT '{t[:2]}' AS tf, '{t[3:]}' AS side, year, round({t}, 4) AS score, round(r_{t[:2]}, 9) * {1 if t.endswith('L') else -1} > 0 AS y FROM ms JOIN mr USING (symbol, t)" for t in M.TAGS) + ")"


def model_scores(spark, sf):
    rows = derive(B.walk(spark, sf), Fe.COLUMNS, M.FEATURES).select("symbol", "date", "t", *[F.round(c, 8).alias(c) for c in M.FEATURES])
    return M.scores(rows, M.read_model(M.write_model(M.FEATURES, _model)))


def validation(spark, sf, by):
    return M.discrimination(M.labelled(model_scores(spark, sf), B.walk(spark, sf)), by)


def auc_sql(by: str) -> str:
    """By ranks: the sum of the ranks of what came true, ties sharing their mean rank."""
    ranked = f"SELECT *, rank() OVER (PARTITION BY {by} ORDER BY score) + (count(*) OVER (PARTITION BY {by}, score) - 1) / 2.0 AS rk FROM ml WHERE y IS NOT NULL"
    p, q = "count_if(y)", "count_if(NOT y)"
    return AUC + f", mk AS ({ranked}) SELECT {by}, count(*) AS n, {r(f'{p} / count(*)')} AS base_rate, {r(f'(sum(CASE WHEN y THEN rk END) - {p} * ({p} + 1) / 2.0) / nullif({p} * {q}, 0)')} AS auc FROM mk GROUP BY {by}"


query("c6_model_score", SCORES + " SELECT symbol, date, " + ", ".join(f"{r(t)} AS {t}" for t in M.TAGS) + " FROM ms")(lambda spark, sf: model_scores(spark, sf).select("symbol", "date", *[r6(t).alias(t) for t in M.TAGS]))
query("a16_auc_by_year", auc_sql("tf, side, year"), dates=())(lambda spark, sf: validation(spark, sf, ["tf", "side", "year"]))
query("r7_model_validation", auc_sql("tf, side"), dates=())(lambda spark, sf: validation(spark, sf, ["tf", "side"]))

#: Levels by the name that their columns bear.
PIVOTS = {"P": "p", "R1": "r1", "S1": "s1", "CH4": "ch4", "CL4": "cl4"}
_periods = {"w": "week", "m": "month"}


def pivot_distances(bars):
    """How far the close is from the levels of the last week and month, in mean true ranges of 14 bars."""
    df = P.with_atr(bars).select("symbol", "date", "close", "atr")
    for tag, period in _periods.items():
        df = df.join(W.pivots(bars, period).select("symbol", "date", *[F.col(c).alias(f"{tag}_{n}") for n, c in PIVOTS.items()]), ["symbol", "date"])
    return df.select("symbol", "date", *[r6(safe_div(F.col("close") - F.col(f"{tag}_{n}"), "atr")).alias(f"piv_{tag}_{n}_atr") for tag in _periods for n in PIVOTS])


_pa, _pl = derive_sql("b", P.ATR, ["atr"], "pa")
_joins = "".join(f" JOIN (SELECT symbol, CAST(date AS DATE) AS date, {', '.join(f'{c} AS {tag}_{n}' for n, c in PIVOTS.items())} FROM (WITH RECURSIVE {ORACLE_SQL[f'n18_pivots_{period}'].split(B.BARS_SQL, 1)[1].removesuffix(')').strip().removeprefix(',')})) USING (symbol, date)" for tag, period in _periods.items())
query("piv_distances", _pa + "SELECT symbol, date, " + ", ".join(f"{r(div(f'close - {tag}_{n}', 'atr'))} AS piv_{tag}_{n}_atr" for tag in _periods for n in PIVOTS) + f" FROM {_pl}{_joins}")(lambda spark, sf: pivot_distances(B.walk(spark, sf)))
