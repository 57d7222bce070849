"""Adjusting by actions on any day, and manual actions applied once, against loops over the bars."""

import datetime as dt

import pytest

from tickloom.operators import actions as A

DAYS = [dt.date(2020, 1, d) for d in (1, 2, 3, 6, 7, 8)]


@pytest.fixture(scope="module")
def bars(spark):
    rows = [(s, d, 10.0, 12.0, 9.0, 11.0, 100.0, 50.0, 7.0, t) for s in (1, 2) for t, d in enumerate(DAYS)]
    return spark.createDataFrame(rows, "symbol long, date date, open double, high double, low double, close double, volume double, deliv_qty double, trades double, t int")


def closes(df, symbol=1):
    return [(round(r["close"], 9), round(r["volume"], 6), r["trades"]) for r in df.filter(f"symbol = {symbol}").orderBy("date").collect()]


@pytest.mark.parametrize("actions", [[], [(3, 0.5)], [(4, 0.5)], [(5, 0.5), (5, 0.2)], [(1, 0.5)], [(30, 0.5), (2, 4.0)]])
def test_adjust_equals_loop(spark, bars, actions):
    due = spark.createDataFrame([(1, dt.date(2020, 1, d), f) for d, f in actions], "symbol long, ex_date date, factor double")
    got = A.adjust(bars, due)
    want = []
    for d in DAYS:
        f = 1.0
        for day, factor in actions:
            if d < dt.date(2020, 1, day):
                f *= factor
        want.append((round(11 * f, 9), round(100 / f, 6), 7.0))
    assert closes(got) == want and closes(got, 2) == [(11.0, 100.0, 7.0)] * len(DAYS)
    assert got.count() == bars.count()


def test_manual_actions_apply_once_and_can_be_undone(spark, bars):
    schema = "symbol string, ex_date string, factor string"
    none = spark.createDataFrame([], schema)
    first = spark.createDataFrame([("1", "2020-01-04", "0.5"), (" 1", "2020-01-04 ", "0.5"), ("1", "soon", "0.5"), ("1", "2020-01-04", "x"), ("1", "2020-01-04", "-1"), ("9", "2020-01-04", "0.5"), (None, "2020-01-04", "0.5")], schema)
    once, done = A.apply_manual(bars, first, none)
    assert done.collect() == [("1", "2020-01-04", "0.5")]
    assert [c for c, *_ in closes(once)] == [5.5] * 3 + [11.0] * 3
    again, same = A.apply_manual(once.drop("adj"), first, done)
    assert closes(again) == closes(once) and same.count() == 1
    back, both = A.apply_manual(once.drop("adj"), spark.createDataFrame([("1", "2020-01-04", "2")], schema), done)
    assert closes(back) == closes(bars) and both.count() == 2


def test_a_stated_previous_close_gives_the_factor(spark, bars):
    from pyspark.sql import functions as F

    split = bars.withColumn("prev_close", F.when(F.col("t") == 3, 5.5).when(F.col("t") == 4, 11.02).when(F.col("t") > 0, 11.0)).filter("symbol = 1")
    assert [(r["ex_date"], r["factor"]) for r in A.detect_actions(split).collect()] == [(DAYS[3], 0.5)]
    assert [c for c, *_ in closes(A.adjust(split, A.detect_actions(split)))] == [5.5] * 3 + [11.0] * 3
