"""Queries of reports, orders, set operations, sinks and ingest rules, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tickloom.functions.sqltext import div, r
from tickloom.operators import crosssection as X
from tickloom.operators import features as Fe
from tickloom.operators import patterns as P
from tickloom.operators.tables import derive_sql
from tickloom.plans import decide as D
from tickloom.plans import ledger as L
from tickloom.plans import registry2 as Q
from tickloom.plans import reports as R
from tickloom.plans.registry import query
from tickloom.sources import bars as B
from tickloom.streaming import jobs

W = B.walk
CASES = "CASE kind WHEN 'BUY' THEN 0 WHEN 'SHORT' THEN 1 ELSE 2 END, CASE tf WHEN 'ST' THEN 0 WHEN 'MT' THEN 1 ELSE 2 END"
query("p8_universe", ", x AS (SELECT b.*, count(*) OVER (PARTITION BY symbol) AS n FROM b SEMI JOIN u USING (symbol) WHERE date <= DATE '1997-12-31') SELECT symbol, date, close FROM x WHERE n >= 60")(lambda s, f: R.as_of(W(s, f), "1997-12-31", B.universe(s, f)).select("symbol", "date", "close"))
query("j11_laggards", " SELECT symbol, last, session FROM (SELECT symbol, max(date) AS last FROM b GROUP BY 1), (SELECT max(date) AS session FROM b) WHERE last < session", dates=("last", "session"))(lambda s, f: R.laggards(W(s, f)))
_card = ", ".join(f"count(c{n}) AS n_{n}, {r(f'avg(100 * (c{n} / c - 1))')} AS mean_{n}, {r(div(f'avg(100 * (c{n} / c - 1))', f'(stddev_samp(100 * (c{n} / c - 1)) / sqrt(count(c{n})))'))} AS tstat_{n}" for n in (10, 60))
CARD = Q.EVENTS + ", fw AS (SELECT symbol, t, close AS c, lead(close, 10) OVER (PARTITION BY symbol ORDER BY date) AS c10, lead(close, 60) OVER (PARTITION BY symbol ORDER BY date) AS c60 FROM b), " + f"card AS (SELECT pattern, family, dir, count(*) AS n, {_card} FROM ev JOIN fw USING (symbol, t) GROUP BY 1, 2, 3) "
query("r5_report_card", CARD + "SELECT *, row_number() OVER (ORDER BY tstat_60 DESC NULLS LAST, pattern, dir) AS place FROM card", dates=())(lambda s, f: R.report_card(Q.some_events(s, f), W(s, f)))
query("a15_card_totals", Q.EVENTS + " SELECT family, dir, count(*) AS n, count(DISTINCT pattern) AS patterns FROM ev GROUP BY 1, 2", dates=())(lambda s, f: Q.some_events(s, f).groupBy("family", "dir").agg(F.count("*").alias("n"), F.countDistinct("pattern").alias("patterns")))
query("r6_active_patterns", Q.EVENTS + ", ds AS (SELECT DISTINCT date FROM b ORDER BY date DESC LIMIT 10) SELECT ev.symbol, company, date, pattern, family, dir, level, row_number() OVER (ORDER BY date DESC, ev.symbol, pattern, dir, level) AS place FROM ev SEMI JOIN ds USING (date) LEFT JOIN u ON u.symbol = ev.symbol WHERE family <> 'Range contraction'")(lambda s, f: R.active_patterns(Q.some_events(s, f), W(s, f), B.universe(s, f)))
query("d8_newest_patterns", Q.EVENTS + ", o AS (SELECT symbol, pattern, max(t) AS t, arg_max(dir, t * 2 + dir) AS dir FROM ev WHERE family <> 'Range contraction' GROUP BY 1, 2), pp AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY t DESC, pattern) AS k FROM o) SELECT symbol, string_agg(CASE WHEN dir > 0 THEN '+ ' ELSE '- ' END || pattern, '; ' ORDER BY k) AS patterns FROM pp WHERE k <= 4 GROUP BY 1", dates=())(lambda s, f: R.newest_patterns(Q.some_events(s, f)))
query("d12_chart_events", Q.EVENTS + ", o AS (SELECT symbol, pattern, CASE WHEN family IN ('Divergence', 'Reversal bars', 'Volume patterns') THEN 1 ELSE 0 END AS low, max(t) AS t FROM ev JOIN n USING (symbol) WHERE t > n - 20 AND family <> 'Range contraction' GROUP BY 1, 2, 3) SELECT symbol, place, pattern, t FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY low, t DESC, pattern) AS place FROM o) WHERE place <= 3", dates=())(lambda s, f: R.chart_events(Q.some_events(s, f), W(s, f)))
query("d16_tail_events", Q.EVENTS + " SELECT symbol, date, ev.t, pattern, dir FROM ev JOIN n USING (symbol) WHERE ev.t > n - 60")(lambda s, f: Q.some_events(s, f).join(W(s, f).groupBy("symbol").agg(F.max("t").alias("n")), "symbol").filter("t > n - 60").select("symbol", "date", "t", "pattern", "dir"))


@query("d6_ledger_order", Q.EVAL + f" SELECT symbol, signal_date, tf, kind, status, row_number() OVER (ORDER BY signal_date DESC, {CASES}, symbol) AS place FROM led", dates=("signal_date",))
def d6_ledger_order(spark, sf):
    """The ledger is written in the shared folder, since its order reads it twice."""
    path = jobs.state_folder(spark, "ledger_order")
    Q.ledger(spark, sf).select("symbol", "signal_date", "tf", "kind", "status").write.parquet(path)
    return R.ledger_order(spark.read.parquet(path))


query("a16_wins_by_year", Q.EVAL + " SELECT tf, kind, " + ", ".join(f"{r(f'''avg(CASE WHEN outcome = 'Win' THEN 1.0::DOUBLE WHEN outcome = 'Loss' THEN 0.0 END) FILTER (WHERE year(signal_date) = {y})''')} AS y{y}" for y in range(1995, 2002)) + " FROM led WHERE outcome IS NOT NULL GROUP BY 1, 2", dates=())(lambda s, f: R.by_year(Q.ledger(s, f), list(range(1995, 2002))))
query("a17_call_dates", Q.CALLS + " SELECT DISTINCT signal_date FROM calls", dates=("signal_date",))(lambda s, f: Q.calls(s, f).select("signal_date").distinct())
query("a18_status_counts", Q.EVAL + " SELECT status, count(*) AS n FROM led GROUP BY 1", dates=())(lambda s, f: Q.ledger(s, f).groupBy("status").agg(F.count("*").alias("n")))
_std = "CASE type " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in R.STANDING.items()) + " ELSE 3.0 END"
query("r2_signals", Q.DECIDE + f", sc AS (SELECT symbol, avg({_std}) AS score, max(CASE WHEN tf = 'ST' THEN pct_buy END) AS best FROM dec GROUP BY 1), pl AS (SELECT symbol, {r('score')} AS score, row_number() OVER (ORDER BY round(score, 8), -coalesce(best, -1.0), symbol) AS place FROM sc) SELECT place, symbol, company, industry, tf, type, pct_buy, pct_short, conf_buy, entry_limit, target, stop, score FROM dec JOIN u USING (symbol) JOIN pl USING (symbol)", dates=())(lambda s, f: R.signal_sheet(Q.decisions(s, f), B.universe(s, f)))
query("r1_call_counts", Q.DECIDE + " SELECT tf, count(*) AS n, count_if(side > 0)::BIGINT AS buys, count_if(side < 0)::BIGINT AS shorts, count_if(type = 'Not rated')::BIGINT AS unrated FROM dec GROUP BY 1", dates=())(lambda s, f: Q.decisions(s, f).groupBy("tf").agg(F.count("*").alias("n"), F.count_if(F.col("side") > 0).alias("buys"), F.count_if(F.col("side") < 0).alias("shorts"), F.count_if(F.col("type") == "Not rated").alias("unrated")))
query("j16_golden_compare", Q.DECIDE + f" SELECT count(*) AS n, count_if(a.type IS DISTINCT FROM b.type)::BIGINT AS n_types, {r('max(abs(a.pct_buy - round(b.pct_buy, 3)))')} AS d_pct_buy, {r('max(abs(a.target - b.target))')} AS d_target FROM dec a JOIN dec b USING (symbol, tf)", dates=())(lambda s, f: (lambda d: R.compare(d, d.withColumn("pct_buy", F.round("pct_buy", 3)), ["symbol", "tf"], ["pct_buy", "target"]))(Q.decisions(s, f)))
_cols = ["dist_sma50", "slope_sma50", "dist_sma200", "slope_sma200"]
_body, _last = derive_sql("b", Fe.COLUMNS, _cols)
_way = lambda n: f"CASE WHEN round(dist_sma{n}, 8) > 0 AND round(slope_sma{n}, 8) > 0 THEN 'Up' WHEN round(dist_sma{n}, 8) < 0 AND round(slope_sma{n}, 8) < 0 THEN 'Down' ELSE 'Sideways' END"
query("p14_trend", _body + f"SELECT symbol, date, {_way(50)} AS trend_mt, {_way(200)} AS trend_lt FROM {_last}")(lambda s, f: R.trends(W(s, f)))
query("p22_evidence", Q.EVENTS + f", j AS (SELECT ev.symbol, tf, ev.pattern, eff > 0 AS pro, ex, hx, ev.t, ev.dir FROM ev JOIN {Q.PROVEN} ON pr.pattern = ev.pattern AND pr.dir = ev.dir), o AS (SELECT symbol, tf, pro, pattern, arg_max(ex, t) AS ex FROM j GROUP BY ALL), pp AS (SELECT *, row_number() OVER (PARTITION BY symbol, tf, pro ORDER BY ex DESC, pattern) AS k FROM o) SELECT symbol, tf, substring(string_agg(CASE WHEN pro THEN '+ ' ELSE '- ' END || pattern, '; ' ORDER BY NOT pro, k), 1, 500) AS evidence FROM pp WHERE k <= 2 GROUP BY 1, 2", dates=())(lambda s, f: R.evidence_list(Q.some_events(s, f), Q.proven(s)))
query("c18_last_bar_patterns", Q.EVENTS + " SELECT n.symbol, count(ev.t) FILTER (WHERE dir > 0 AND n - ev.t < 20) - count(ev.t) FILTER (WHERE dir < 0 AND n - ev.t < 20) AS net_20, round(coalesce(max(CASE WHEN pattern = '52-week high breakout' AND n - ev.t <= 30 THEN exp(-(n - ev.t) / 10.0) END), 0.0), 6) AS pat_52_week_high_breakout FROM n LEFT JOIN ev USING (symbol) GROUP BY 1", dates=())(
    lambda s, f: P.pattern_features(Q.some_events(s, f), W(s, f), ["52-week high breakout"]).select("symbol", "net_20", P.pattern_id("52-week high breakout"))
)
_succ = lambda s, f: L.success(Q.ledger(s, f))
query("r11_success_rows", Q.SUCCESS + ", ss AS (SELECT * FROM sc0), k AS (SELECT *, row_number() OVER (PARTITION BY level ORDER BY kind NULLS FIRST, tf NULLS FIRST, month NULLS FIRST) AS place FROM ss) SELECT level, CASE level WHEN 'OVERALL' THEN 'ALL' WHEN 'KIND' THEN kind WHEN 'GROUP' THEN kind || '|' || tf ELSE month END AS key, (CASE level WHEN 'OVERALL' THEN 1 WHEN 'KIND' THEN 2 WHEN 'GROUP' THEN 10 ELSE 500 END + place - 1)::BIGINT AS sort_order, calls, closed, success_rate FROM k", dates=())(lambda s, f: R.success_rows(_succ(s, f)))
query("c12_daily_success", Q.SUCCESS + ", old AS (SELECT '1999-01-01' AS as_of_date, 0::BIGINT AS calls, 0::BIGINT AS completed, 0.5::DOUBLE AS success_rate UNION ALL SELECT '2001-12-31', 1, 1, 0.25) SELECT * FROM old WHERE as_of_date <> '2001-12-31' UNION ALL SELECT '2001-12-31', calls, closed, success_rate FROM sc0 WHERE level = 'OVERALL'", dates=())(
    lambda s, f: L.upsert(s.createDataFrame([("1999-01-01", 0, 0, 0.5), ("2001-12-31", 1, 1, 0.25)], "as_of_date string, calls long, completed long, success_rate double"), _succ(s, f).filter("level = 'OVERALL'").select(F.lit("2001-12-31").alias("as_of_date"), "calls", F.col("closed").alias("completed"), "success_rate"), ["as_of_date"])
)
query("c14_manual_actions", Q.ACT + ", lg AS (SELECT symbol, ex_date, f AS factor, 'file' AS source FROM act), mn AS (SELECT symbol, date AS ex_date, 0.25::DOUBLE AS factor, 'manual' AS source FROM b WHERE t % 97 IN (13, 14)) SELECT * FROM lg UNION ALL SELECT * FROM mn ANTI JOIN lg USING (symbol, ex_date)", dates=("ex_date",))(
    lambda s, f: R.manual_actions(Q.factors(s, f).withColumn("source", F.lit("file")), W(s, f).filter("t % 97 IN (13, 14)").select("symbol", F.col("date").alias("ex_date"), F.lit(0.25).alias("factor"), F.lit("manual").alias("source")))
)
query("c16_market_lines", Q.BREADTH + " SELECT date, n_symbols || ' stocks traded; ' || format('{:.1f}', floor(100 * pct_above50 * 1e1 + 0.5) / 1e1) || '% above their 50-day average' AS line FROM day")(lambda s, f: R.market_line(X.breadth(X.core_panel(W(s, f)))))
query("u6_sessions", " SELECT date FROM b WHERE symbol % 2 = 0 UNION SELECT date FROM b WHERE symbol % 2 = 1")(lambda s, f: W(s, f).filter("symbol % 2 = 0").select("date").union(W(s, f).filter("symbol % 2 = 1").select("date")).distinct())
query("u7_common_sessions", " SELECT date FROM b WHERE symbol % 2 = 0 INTERSECT SELECT date FROM b WHERE symbol % 2 = 1")(lambda s, f: W(s, f).filter("symbol % 2 = 0").select("date").intersect(W(s, f).filter("symbol % 2 = 1").select("date")))
query("u4_append_actions", Q.ACT + " SELECT symbol, ex_date, f AS factor FROM act UNION ALL SELECT symbol, max(date) AS ex_date, 0.5::DOUBLE FROM b GROUP BY symbol", dates=("ex_date",))(lambda s, f: Q.factors(s, f).unionByName(W(s, f).groupBy("symbol").agg(F.max("date").alias("ex_date"), F.lit(0.5).alias("factor"))))
query("j17_mirror_fill", " SELECT date, bench FROM m")(lambda s, f: (lambda m: m.select("date", F.when(F.dayofmonth("date") % 3 != 0, F.col("bench")).alias("_own")).join(m.withColumnRenamed("bench", "_mirror"), "date", "left").select("date", F.coalesce("_own", "_mirror").alias("bench")))(B.benchmark(W(s, f))))
query("s8_preferred_source", " SELECT symbol, date, CASE WHEN t % 3 = 0 THEN 'incoming' WHEN t % 3 = 1 THEN 'cache' ELSE 'network' END AS source FROM b")(
    lambda s, f: (lambda b: R.preferred(b.filter("t % 3 = 0").withColumn("source", F.lit("incoming")), b.filter("t % 3 <> 2").withColumn("source", F.lit("cache")), b.withColumn("source", F.lit("network")), keys=["symbol", "date"]).select("symbol", "date", "source"))(W(s, f))
)
query("t2_gap_rule", ", se AS (SELECT DISTINCT date FROM b), st AS (SELECT date, CASE WHEN year(date) = 2000 AND month(date) = 6 AND day(date) = 15 THEN 'error' WHEN day(date) % 7 = 0 THEN 'missing' ELSE 'ok' END AS state FROM se), x AS (SELECT *, coalesce(max(CASE WHEN state = 'ok' THEN 1 ELSE 0 END) OVER (ORDER BY date ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0) = 1 AS later FROM st), y AS (SELECT *, max(CASE WHEN state = 'error' AND later THEN 1 ELSE 0 END) OVER (ORDER BY date) = 1 AS stop FROM x) SELECT date, state, CASE WHEN stop THEN 'stop' WHEN state = 'ok' THEN 'ingest' WHEN state = 'missing' AND later THEN 'holiday' ELSE 'wait' END AS action FROM y")(
    lambda s, f: (lambda d: R.gap_rule(d, d.filter(F.dayofmonth("date") % 7 != 0).select("date", F.when((F.year("date") == 2000) & (F.month("date") == 6) & (F.dayofmonth("date") == 15), "error").otherwise("ok").alias("state"))))(W(s, f).select("date").distinct())
)
query("t7_catch_up", " SELECT e.d AS as_of, count(*) AS bars, max(date) AS last FROM b, (VALUES (DATE '1996-06-28'), (DATE '1998-06-30'), (DATE '2000-06-30')) e(d) WHERE date <= e.d GROUP BY 1", dates=("as_of", "last"))(
    lambda s, f: (lambda b: b.crossJoin(F.broadcast(s.createDataFrame([("1996-06-28",), ("1998-06-30",), ("2000-06-30",)], "d string").select(F.col("d").cast("date").alias("as_of")))).filter("date <= as_of").groupBy("as_of").agg(F.count("*").alias("bars"), F.max("date").alias("last")))(W(s, f))  # three sessions to catch up
)
query("k3_json_rows", " SELECT '[' || symbol || ',\"' || company || '\",\"' || industry || '\"]' AS row FROM u", dates=())(lambda s, f: R.json_rows(B.universe(s, f), ["symbol", "company", "industry"]))


def _written(spark, df, kind: str):
    """df written in the shared folder and read again, with its schema."""
    path = jobs.state_folder(spark, kind)
    w = df.write.option("header", True) if kind == "csv" else df.write
    getattr(w, kind)(path)
    return getattr(spark.read.schema(df.schema).option("header", True), kind)(path)


for _kind in ("csv", "json", "orc"):
    query(f"k2_{_kind}_round_trip", " SELECT symbol, date, close, volume, t FROM b")(lambda s, f, k=_kind: _written(s, W(s, f).select("symbol", "date", "close", "volume", F.col("t").cast("int").alias("t")), k))


@query("k6_run_bundle", " SELECT symbol, date, close FROM b WHERE date IN (SELECT DISTINCT date FROM b ORDER BY date DESC LIMIT 5)")
def k6_run_bundle(spark, sf):
    """Bundles partitioned by session; the newest five stay."""
    path = jobs.state_folder(spark, "bundle")
    bars = W(spark, sf).select("symbol", "date", "close")
    last = [r["date"] for r in bars.select("date").distinct().orderBy(F.col("date").desc()).limit(8).collect()]  # eight sessions
    bars.filter(F.col("date").isin(last)).write.partitionBy("date").parquet(path)
    kept = spark.read.parquet(path)
    newest = kept.select("date").distinct().orderBy(F.col("date").desc()).limit(5)
    return kept.join(newest, "date", "left_semi").select("symbol", "date", "close")
