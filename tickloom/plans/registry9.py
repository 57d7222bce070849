"""Queries of sources and sinks: bars, ledger and universe written in another format, read again, with the SQL of what they hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.exprs import by_symbol, finite_float, half_up, r6
from tickloom.functions.sqltext import dist, lag, r
from tickloom.operators import actions as A
from tickloom.plans import registry2 as Q
from tickloom.plans.registry import query
from tickloom.sources import bars as B
from tickloom.sources import columnar as Co
from tickloom.sources import files as Fi
from tickloom.sources import formats as Fo
from tickloom.streaming import jobs

W = B.walk
NAMES = {"NIFTY50": "Nifty 50", "NIFTY500": "NIFTY 500", "MIDCAP150": "Nifty Midcap 150"}


def _lines(df: DataFrame, spark, kind: str) -> str:
    """A column `value` written as text files in the shared folder; its path."""
    path = jobs.state_folder(spark, kind)
    df.select("value").write.text(path)
    return path


@query("s2_index_close", " SELECT k AS index_key, date, CASE WHEN day(date) % 4 = 0 THEN bench ELSE floor(bench * 0.99 * 1e2 + 0.5) / 1e2 END AS open, bench AS high, bench AS low, bench AS close, CASE WHEN day(date) % 5 = 0 THEN 0.0::DOUBLE ELSE 1234567.0::DOUBLE END AS volume FROM (SELECT date, floor(bench * 1e2 + 0.5) / 1e2 AS bench FROM m), (VALUES ('NIFTY50'), ('NIFTY500'), ('MIDCAP150')) x(k)")
def s2_index_close(spark, sf):
    """Index files of every session: three known indices, one unknown, one closed at 0, opens and volumes missing on some days."""
    m = B.benchmark(W(spark, sf)).withColumn("v", half_up("bench", 2))
    d, money = F.date_format("date", "dd-MM-yyyy"), lambda c: F.concat(F.lit('"'), F.format_number(c, 2), F.lit('"'))
    opened = F.when(F.dayofmonth("date") % 4 == 0, "-").otherwise(money(half_up(F.col("v") * 0.99, 2)))
    volume = F.when(F.dayofmonth("date") % 5 == 0, "").otherwise('"1,234,567"')
    line = lambda name, close: F.concat_ws(",", F.lit(name), d, opened, money(F.col("v")), F.lit("-"), close, F.lit("0.1"), F.lit("0.1"), volume)
    rows = [line(n, money(F.col("v"))) for n in NAMES.values()] + [line("Nifty Next 50", F.lit("0")), line("Some Other Index", money(F.col("v")))]
    return Fi.parse_index_close(spark.read.text(_lines(m.select(F.explode(F.array(*rows)).alias("value")), spark, "index")))


@query("s4_constituents", " SELECT company, industry, 'X' || symbol AS symbol FROM u", dates=())
def s4_constituents(spark, sf):
    u = B.universe(spark, sf)
    line = u.select(F.concat_ws(",", F.concat(F.lit('"'), "company", F.lit('"')), F.concat("industry", F.lit(" ")), F.concat(F.lit(" x"), F.col("symbol").cast("string")), F.lit("EQ"), F.lit("ISIN")).alias("value"))
    head = spark.createDataFrame([("Company Name,Industry,Symbol,Series,ISIN Code",)], "value string")
    return Fi.parse_constituents(spark.read.text(_lines(line.unionByName(head), spark, "members")), least=1)


@query("s5_manual_actions", " SELECT symbol::VARCHAR AS symbol, date AS ex_date, CASE WHEN t % 2 = 0 THEN 0.5::DOUBLE ELSE 0.25::DOUBLE END AS factor, 'split' AS note FROM b WHERE t % 97 = 13", dates=("ex_date",))
def s5_manual_actions(spark, sf):
    due = W(spark, sf).filter("t % 97 = 13")
    lines = F.array(F.lit("# a comment, with commas"), F.concat_ws(", ", F.col("symbol").cast("string"), F.col("date").cast("string"), F.when(F.col("t") % 2 == 0, "0.5").otherwise("0.25"), F.lit("split")))
    return Fi.read_actions(spark, _lines(due.select(F.explode(lines).alias("value")), spark, "actions"), header=False)


@query("s6_symbol_changes", " SELECT 'OLD' || symbol AS old_symbol, symbol::VARCHAR AS new_symbol FROM u", dates=())
def s6_symbol_changes(spark, sf):
    u = B.universe(spark, sf).select(F.concat_ws(",", F.concat(F.lit("OLD"), F.col("symbol").cast("string")), F.col("symbol").cast("string")).alias("value"))
    return Fi.read_symbol_changes(spark, _lines(u, spark, "changes"), header=False)


@query("s7_pickled_parts", " SELECT symbol, date, open, high, low, close, volume FROM b")
def s7_pickled_parts(spark, sf):
    """Bars as pickled parts of 20 symbols; an older part of every symbol, with other prices, gives way to the newer one."""
    b = W(spark, sf).select("symbol", "date", "open", "high", "low", "close", "volume")
    part = F.floor(F.col("symbol") / 20)
    new = b.withColumn("part", F.concat(F.lit("2-"), part.cast("string")))
    old = b.withColumn("part", F.concat(F.lit("1-"), part.cast("string"))).withColumn("close", F.col("close") + 1)
    content = Fo.pickle_files(old.unionByName(new), "part")
    return Fo.pickled_frames(content, "symbol long, date date, open double, high double, low double, close double, volume double")


@query("s10_json_objects", " SELECT 'S' || symbol AS symbol, company, industry, CASE WHEN symbol % 3 = 0 THEN NULL ELSE symbol END AS size FROM u", dates=())
def s10_json_objects(spark, sf):
    """Documents of 50 members each, written over several lines."""
    u = B.universe(spark, sf).withColumn("doc", F.floor(F.col("symbol") / 50))
    member = F.concat(F.lit('\n "S'), F.col("symbol").cast("string"), F.lit('": '), F.to_json(F.struct("company", "industry", F.when(F.col("symbol") % 3 != 0, F.col("symbol")).alias("size"), F.lit("ignored").alias("other"))))
    docs = u.select("doc", member.alias("m")).groupBy("doc").agg(F.concat(F.lit("{"), F.concat_ws(",", F.collect_list("m")), F.lit("\n}")).alias("value"))
    return Fo.json_objects(docs, "company STRING, industry STRING, size BIGINT", "symbol")


@query("s11_static_tables", " SELECT symbol, year(date) AS year, count(*) AS bars, max(close) AS high FROM b GROUP BY 1, 2", dates=())
def s11_static_tables(spark, sf):
    path = jobs.state_folder(spark, "static")
    W(spark, sf).groupBy("symbol", F.year("date").alias("year")).agg(F.count("*").alias("bars"), F.max("close").alias("high")).write.option("header", True).csv(path)
    return Fo.read_static(spark, path, "symbol long, year int, bars long, high double")


@query("s12_sqlite_ledger", Q.EVAL + " SELECT symbol, signal_date, tf, kind, status, result_pct FROM led WHERE status <> 'Not triggered'", dates=("signal_date",))
def s12_sqlite_ledger(spark, sf):
    """The ledger as databases of one symbol each, read by a query that runs in them."""
    led = Q.ledger(spark, sf).select("symbol", F.col("symbol").alias("file"), "signal_date", "tf", "kind", "status", "result_pct")
    content = Fo.sqlite_files(led, "ledger", "file")
    return Fo.sqlite_rows(content, "SELECT symbol, signal_date, tf, kind, status, result_pct FROM ledger WHERE status <> 'Not triggered'", "symbol long, signal_date date, tf string, kind string, status string, result_pct double")


@query("s14_session_states", ", x AS (SELECT date AS session, count(*) AS n FROM b GROUP BY 1) SELECT session, n, CASE WHEN day(session) % 7 = 0 THEN session - 1 WHEN day(session) % 11 = 0 THEN session + 1 ELSE session END AS day, CASE WHEN n < 3 THEN 'short' WHEN day(session) % 7 = 0 THEN 'stale' WHEN day(session) % 11 = 0 THEN 'wrong' ELSE 'ok' END AS state FROM x", dates=("session", "day"))
def s14_session_states(spark, sf):
    """Files of every session, of which some hold the day before or after."""
    d = F.dayofmonth("date")
    held = F.when(d % 7 == 0, F.date_sub("date", 1)).when(d % 11 == 0, F.date_add("date", 1)).otherwise(F.col("date"))
    return Fi.session_states(W(spark, sf).select(F.col("date").alias("session"), held.alias("date")), least=3)


@query("k3_columnar_round_trip", Q.EVAL + " SELECT symbol, signal_date, tf, kind, status, outcome, result_pct FROM led", dates=("signal_date",))
def k3_columnar_round_trip(spark, sf):
    path = jobs.state_folder(spark, "columnar")
    Co.write(Q.ledger(spark, sf).select("symbol", "signal_date", "tf", "kind", "status", "outcome", "result_pct"), path, "calls", session_date="2001-12-31")
    return Co.read(spark, path)


_ret = dist("close", lag("close"))
query("p5_finite_features", f", x AS (SELECT *, CASE WHEN t % 50 = 7 THEN 'inf'::DOUBLE WHEN t % 50 = 8 THEN '-inf'::DOUBLE WHEN t % 50 = 9 THEN 'nan'::DOUBLE ELSE round({_ret}, 8) END AS v FROM b) SELECT symbol, date, {r('CASE WHEN isfinite(v) THEN v::FLOAT::DOUBLE END')} AS ret FROM x")(
    lambda s, f: W(s, f).selectExpr("*", f"CASE WHEN t % 50 = 7 THEN double('Infinity') WHEN t % 50 = 8 THEN double('-Infinity') WHEN t % 50 = 9 THEN double('NaN') ELSE round({_ret}, 8) END AS v").select("symbol", "date", r6(finite_float("v").cast("double")).alias("ret"))
)


def raw_bars(spark, sf) -> DataFrame:
    """Bars as an exchange states them, with a split or bonus on every bar 13 of 97: earlier prices unadjusted, the previous close adjusted on the day."""
    b = W(spark, sf)
    raw = A.adjust(b, Q.factors(spark, sf).withColumn("factor", 1 / F.col("factor"))).drop("adj")
    due = F.when(F.col("t") % 97 == 13, F.when(F.col("t") % 2 == 0, 0.5).otherwise(0.8)).otherwise(1.0)
    return raw.withColumn("prev_close", F.lag("close").over(by_symbol()) * due)


query("c13_detect", Q.ACT + " SELECT symbol, ex_date, round(f, 8)::DOUBLE AS factor FROM act", dates=("ex_date",))(lambda s, f: A.detect_actions(raw_bars(s, f)).select("symbol", "ex_date", F.round("factor", 8).alias("factor")))
query("c13_detect_and_adjust", " SELECT symbol, date, round(close, 6) AS close, round(high, 6) AS high, round(volume, 6) AS volume FROM b")(
    lambda s, f: (lambda b: A.adjust(b, A.detect_actions(b)).select("symbol", "date", *[F.round(c, 6).alias(c) for c in ("close", "high", "volume")]))(raw_bars(s, f))
)


@query("c14_apply_manual", ", mn AS (SELECT symbol, date + 1 AS ex, 0.5::DOUBLE AS f FROM b WHERE t % 89 = 7 UNION ALL SELECT symbol, date, 2.0 FROM b WHERE t % 89 = 40), x AS (SELECT b.symbol, b.date, b.close, b.volume, coalesce((SELECT product(f) FROM mn WHERE mn.symbol = b.symbol AND mn.ex > b.date), 1.0) AS adj FROM b) SELECT symbol, date, round(close * adj, 6) AS close, round(volume / adj, 6) AS volume FROM x")
def c14_apply_manual(spark, sf):
    """Manual rows twice over, on days with and without a bar, some applied before, some unreadable, some of unknown symbols; applied a second time too."""
    b = W(spark, sf)
    row = lambda where, day, factor: b.filter(where).select(F.col("symbol").cast("string").alias("symbol"), day.cast("string").alias("ex_date"), F.lit(factor).alias("factor"))
    due = row("t % 89 = 7", F.date_add("date", 1), "0.5").unionByName(row("t % 89 = 40", F.col("date"), " 2.0"))
    done = row("t % 89 = 60", F.col("date"), "0.1")
    other = row("t % 89 = 61", F.col("date"), "half").unionByName(row("t % 89 = 62", F.lit("soon"), "0.5")).unionByName(row("t % 89 = 63", F.col("date"), "0.5").withColumn("symbol", F.lit("none such")))
    manual = due.unionByName(due).unionByName(done).unionByName(other)
    once, applied = A.apply_manual(b, manual, done)
    twice, _ = A.apply_manual(once.drop("adj"), manual, applied)
    return twice.select("symbol", "date", F.round("close", 6).alias("close"), F.round("volume", 6).alias("volume"))
