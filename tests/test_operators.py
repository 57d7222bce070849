import datetime
import math

import pytest

from tickloom.operators import actions as A
from tickloom.operators import scans as K
from tickloom.plans import ledger as L
from tickloom.sources import files as Fi
from tickloom.streaming import jobs

DAY = datetime.date(2026, 9, 1)
DAYS = [d for d in (DAY + datetime.timedelta(i) for i in range(40)) if d.weekday() < 5]


def trade(spark, bars, side=1, limit=101.0, target=106.0, stop=97.0, hold=10):
    call = spark.createDataFrame([("A", DAYS[0], 0, "ST", "BUY" if side > 0 else "SHORT", side, 100.0, 1.0, limit, target, stop, hold)], "symbol string, signal_date date, t0 long, tf string, kind string, side int, close double, atr double, entry_limit double, target double, stop double, max_days int")
    rows = [("A", DAYS[i], i, *map(float, b)) for i, b in enumerate([(100, 100, 100, 100), *bars])]
    df = spark.createDataFrame(rows, "symbol string, date date, t long, open double, high double, low double, close double")
    return L.evaluate_trades(call, df).first()


FLAT = (100, 101, 99, 100)


def test_trades(spark):
    r = trade(spark, [FLAT, FLAT, (104, 107, 103, 106)])
    assert (r.status, r.exit_price, r.days_held, r.outcome) == ("Target hit", 106.0, 3, "Win")
    r = trade(spark, [FLAT, (96, 97, 95, 96)])
    assert (r.status, r.exit_price, r.outcome) == ("Stop hit", 96.0, "Loss")
    assert trade(spark, [(102, 103, 101, 102)]).status == "Not triggered"
    assert trade(spark, [(96, 103, 95, 102)]).status == "Not triggered"
    r = trade(spark, [FLAT] * 9 + [(100, 101, 100, 100.9)])
    assert (r.status, r.exit_price, r.days_held) == ("Time exit", 100.9, 10)
    r = trade(spark, [FLAT, FLAT])
    assert (r.status, r.days_held, r.outcome) == ("Open", 2, None)
    r = trade(spark, [FLAT, (100, 107, 96, 100)])
    assert (r.status, r.exit_price) == ("Stop hit", 97.0)  # both on one bar: the stop counts
    r = trade(spark, [FLAT, (99, 99, 93, 94)], -1, 99.0, 94.0, 103.0)
    assert (r.status, r.exit_price, r.outcome) == ("Target hit", 94.0, "Win")
    r = trade(spark, [(100, 107, 99, 101)])
    assert (r.status, r.days_held) == ("Target hit", 1)


def test_avoid(spark):
    rows = [(s, DAYS[i], i, 0.0, 0.0, 0.0, 100.0 + d * i) for s, d in (("A", -1), ("B", 1), ("C", 0.5)) for i in range(12)]
    bars = spark.createDataFrame(rows, "symbol string, date date, t long, open double, high double, low double, close double")
    calls = spark.createDataFrame([(s, DAYS[0], 0, "ST", 100.0, 10) for s in "AB"], "symbol string, signal_date date, t0 long, tf string, close double, max_days int")
    got = {r.symbol: r for r in L.evaluate_avoids(calls, bars).collect()}
    assert got["A"].status == "Correct" and got["A"].excess_pct < 0 and got["B"].status == "Wrong"


def test_files(spark):
    lines = ["SYMBOL, SERIES, DATE1, PREV_CLOSE, OPEN_PRICE, HIGH_PRICE, LOW_PRICE, LAST_PRICE, CLOSE_PRICE, AVG_PRICE, TTL_TRD_QNTY, TURNOVER_LACS, NO_OF_TRADES, DELIV_QTY, DELIV_PER", 'abc, BE, 11-Sep-2026, 1, 2, 3, 1, 2, 2, 2, "1,000", 1, 5, -, -', "ABC, EQ, 11-SEP-2026, 1, 2.5, 3, 1, 2, 2, 2, 10, 1, 5, 7, 70", "XYZ, GS, 11-Sep-2026, 1, 2, 3, 1, 2, 2, 2, 10, 1, 5, 7, 70"]
    df = Fi.parse_bhav(spark.createDataFrame([(x,) for x in lines], "value string"))
    r = df.collect()
    assert len(r) == 1 and (r[0].symbol, r[0].series, r[0].open, r[0].date) == ("ABC", "EQ", 2.5, datetime.date(2026, 9, 11))
    with pytest.raises(ValueError):
        Fi.check_session(df, "2026-09-14")
    Fi.check_session(df, "2026-09-11", least=1)
    index = ["Index Name,Index Date,Open,High,Low,Closing,Points,Change,Volume", "Nifty 50,11-09-2026,23100.1,23200,23000,23140.50,1,1,5", "NIFTY MIDCAP 150,11-09-2026,-,-,-,19500.25,1,1,-", "Nifty Auto,11-09-2026,1,1,1,1,1,1,1"]
    got = {r.index_key: r for r in Fi.parse_index_close(spark.createDataFrame([(x,) for x in index], "value string")).collect()}
    assert set(got) == {"NIFTY50", "MIDCAP150"} and got["NIFTY50"].close == 23140.5 and (got["MIDCAP150"].open, got["MIDCAP150"].volume) == (19500.25, 0.0)
    with pytest.raises(ValueError):
        Fi.parse_constituents(spark.createDataFrame([("A Ltd,Steel,AAA,EQ,X",)], "value string"))


def test_actions_csv_and_split(spark, tmp_path):
    (tmp_path / "a.csv").write_text("symbol, ex_date, factor, note\n# a comment\nABC, 2026-09-03, 0.5, split\n")
    acts = Fi.read_actions(spark, str(tmp_path / "a.csv"))
    bars = spark.createDataFrame([("ABC", DAYS[i], 102.0, 102.0, 102.0, c, 1000.0, 10.0, p) for i, (c, p) in enumerate([(102.0, 102.0), (102.0, 102.0), (51.0, 51.0)])], "symbol string, date date, open double, high double, low double, close double, volume double, deliv_qty double, prev_close double")
    found = A.detect_actions(bars).collect()
    assert [(r.symbol, r.factor) for r in found] == [("ABC", 0.5)]
    got = A.adjust(bars, acts.select("symbol", "ex_date", "factor")).orderBy("date").collect()
    assert [round(r.close, 6) for r in got] == [51.0, 51.0, 51.0] and [round(r.volume) for r in got] == [2000, 2000, 1000]


def drive(kernel, *columns):
    step = kernel()
    return [step(*row) for row in zip(*columns, strict=True)]


def test_kernels_against_plain_loops():
    c = [100 + 10 * math.sin(i / 3) + i / 10 for i in range(80)]
    e = drive(K.ema(5), c)
    want = sum(c[:5]) / 5
    assert e[:4] == [None] * 4 and abs(e[4] - want) < 1e-12
    for i in range(5, 80):
        want += (c[i] - want) / 3
    assert abs(e[-1] - want) < 1e-9
    gains = [max(b - a, 0) for a, b in zip(c, c[1:], strict=False)]
    losses = [max(a - b, 0) for a, b in zip(c, c[1:], strict=False)]
    u, d = sum(gains[:14]) / 14, sum(losses[:14]) / 14
    for g, x in zip(gains[14:], losses[14:], strict=True):
        u, d = u + (g - u) / 14, d + (x - d) / 14
    assert abs(drive(K.rsi(14), c)[-1] - 100 * u / (u + d)) < 1e-9
    assert all(0 <= x <= 100 for x in drive(K.laguerre(), c)[20:])
    assert drive(K.three_line_break(), [1, 2, 3, 4, 5, 1]) == [0, 1, 1, 1, 1, -1]
    assert drive(K.kagi(), [100, 110, 104, 111, 100, 90]) == [1, 1, 1, 1, -1, -1]
    assert drive(lambda: K.renko(), [10, 11, 12.5, 10.4, 10.2, 9.9], [1] * 6) == [(0, 0), (1, 1), (1, 2), (1, 2), (1, 2), (-1, -1)]
    z = drive(lambda: K.zigzag(), [1, 2, 5, 4, 2, 3, 6], [1, 2, 4, 3, 1, 2, 5], [2.0] * 7)
    assert [x[0] for x in z] == [0, 0, 1, -1, -1, 1, 1]


def test_streams(spark, tmp_path):
    old = spark.createDataFrame([("A", DAYS[0], 1.0)], "symbol string, date date, close double")
    new = spark.createDataFrame([("A", DAYS[0], 9.0), ("A", DAYS[1], 2.0)], "symbol string, date date, close double")
    assert sorted(r.close for r in jobs.append_sessions(old, new).collect()) == [1.0, 2.0]
    schema = "symbol long, tf string, kind string, signal_date date"
    for i, rows in enumerate([[(1, "ST", "BUY"), (2, "ST", "BUY")], [(1, "ST", "BUY"), (3, "LT", "SHORT")], [(1, "ST", "BUY")]]):
        spark.createDataFrame([(*r, DAYS[i]) for r in rows], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "calls"))
    got = jobs.run_ledger(spark, str(tmp_path / "calls"), spark.read.parquet(str(tmp_path / "calls")).schema, str(tmp_path / "ledger"))
    assert sorted((r.symbol, r.repeat_count, r.last_seen) for r in got.collect()) == [(1, 2, DAYS[2]), (2, 0, DAYS[0]), (3, 0, DAYS[1])]
