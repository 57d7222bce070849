"""Rank shares, deepest falls, verdicts and texts against plain pandas and loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators import standing as St
from tickloom.plans import remarks as Rm


@pytest.mark.parametrize("kind", ["normal", "ties", "hot", "one", "wide"])
def test_rank_shares_equal_pandas(spark, kind):
    rng = np.random.default_rng(3)
    n = 900
    x = {"normal": rng.normal(size=n), "ties": rng.integers(0, 7, n).astype(float), "hot": np.where(rng.random(n) < 0.4, 5.0, rng.normal(size=n)), "one": np.full(n, 2.5), "wide": np.exp(rng.normal(size=n) * 20)}[kind]
    pdf = pd.DataFrame({"date": rng.integers(0, 3, n), "symbol": np.arange(n), "a": x, "b": np.where(rng.random(n) < 0.2, np.nan, -x)})
    df = spark.createDataFrame(pdf).withColumn("b", F.when(~F.isnan("b"), F.col("b")))
    got = St.rank_shares(df, ["a", "b"], ["date"], ["symbol"]).toPandas().sort_values("symbol")
    for c in "ab":
        want = pdf.groupby("date")[c].rank(pct=True)
        assert np.allclose(got[c].to_numpy(float), want.to_numpy(), equal_nan=True, atol=1e-12)


def test_rank_shares_of_nothing(spark):
    df = spark.createDataFrame([(1, 7, None)], "date int, symbol int, a double")
    assert St.rank_shares(df, ["a"], ["date"], ["symbol"]).collect() == [(1, 7, None)]
    assert St.rank_shares(df.limit(0), ["a"], ["date"], ["symbol"]).count() == 0


@pytest.mark.parametrize("n,least", [(5, 3), (252, 201)])
def test_deepest_fall_equals_loop(n, least):
    close = np.exp(np.cumsum(np.random.default_rng(5).normal(0, 0.02, 3000)))
    close[7] = np.nan
    (got,) = St.deepest_fall(close, n, least)
    for i in range(len(close)):
        w = [v for v in close[max(0, i - n + 1) : i + 1] if v == v]
        if len(w) < least:
            assert np.isnan(got[i])
            continue
        peak, worst = 0.0, 0.0
        for v in w:
            peak = max(peak, v)
            worst = min(worst, v / peak - 1)
        assert got[i] == pytest.approx(100 * worst, abs=1e-9)


def test_market_strength_starts_with_the_first_move(spark):
    closes = [100.0, 101.0, 100.5, 100.5, 103.0, 102.0]
    df = spark.createDataFrame([(f"2020-01-{d + 1:02d}", c, None, None) for d, c in enumerate(closes)], "date string, bench double, sc double, mc double").withColumn("date", F.col("date").cast("date"))
    got = [r["n50_rsi14"] for r in St.market_features(df).orderBy("date").collect()]
    up = down = None
    want = [None]
    for a, b in zip(closes, closes[1:]):
        u, d = max(b - a, 0), max(a - b, 0)
        up, down = (u, d) if up is None else (up + (u - up) / 14, down + (d - down) / 14)
        want.append(None if abs(down) <= 1e-12 else 100 - 100 / (1 + up / down))
    assert [v is None for v in got] == [v is None for v in want]
    assert all(a == pytest.approx(b, abs=1e-5) for a, b in zip(got, want) if b is not None)


def test_verdicts(spark):
    rows = [("Flag", 1, 40, 3.5), ("Flag", -1, 40, 3.5), ("Dead-cat bounce breakdown", -1, 40, -2.0), ("Dead-cat bounce breakdown", -1, 10, -9.0), ("Cup", 1, 40, 0.2), ("Cup", 1, 40, None)]
    card = spark.createDataFrame([(p, "f", d, n, n, t) for p, d, n, t in rows], "pattern string, family string, dir int, n long, n_60 long, tstat_60 double")
    got = [(r["raw"], r["verdict"], r["word"]) for r in Rm.verdicts(card).collect()]
    assert got == [
        ("Works (significant)",) * 2 + ("works",), ("Works in reverse (fade it)",) * 2 + ("works in reverse",), ("Weak edge", "Survivorship illusion", "survivorship illusion"),
        ("Too few events",) * 2 + ("rare",), ("No reliable edge",) * 2 + ("no edge",), ("Too few events",) * 2 + ("rare",),
    ]


def test_every_type_has_a_text(spark):
    types = ["Not rated", "Strong Buy", "Buy", "Accumulate (buy on dips)", "Short Sell", "Strong Short Sell", "Avoid (likely underperformer)", "Reduce / Avoid", "Hold (mixed signals)", "Hold / No fresh trade"]
    calls = spark.createDataFrame([(1, tf, t, 0.96, 0.9, 0.4, 1.25) for t in types for tf in ("ST", "MT", "LT")], "symbol int, tf string, type string, pct_buy double, pct_short double, conf_buy double, exp_ret_buy double")
    facts = spark.createDataFrame([(1, 500, 55.5, None, -3.2, 1.0, 1.0, -1.0, -1.0, 1.0, -6.4, 7.04)], "symbol int, bars int, rsi14 double, rs_rating double, dist_52w_high double, dist_ema20 double, dist_sma50 double, slope_sma50 double, dist_sma200 double, slope_sma200 double, deliv_pct_5_minus_20 double, atr_pct_14 double")
    evidence = spark.createDataFrame([(1, "ST", "+ Cup")], "symbol int, tf string, evidence string")
    got = {(r["type"], r["tf"]): r["remark"] for r in Rm.remarks(calls, facts, evidence).collect()}
    assert len(got) == 30 and all(got.values())
    assert got["Strong Buy", "ST"] == "Ranked in the top 4% for the next 2 weeks. Confidence 40%, expected +1.3% a trade after costs. Technicals: RSI 56; -3% from the 52-week high; above the 20-bar average; delivery falling (-6 points); volatile (7.0% a day)."
    assert "Setups at work: + Cup." in got["Buy", "ST"] and "Setups" not in got["Buy", "MT"]
