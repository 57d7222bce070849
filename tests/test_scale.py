"""Plans that keep shuffles and sorts in proportion to the input."""

from tickloom.operators import charts, figures, patterns
from tickloom.operators import indicators as I
from tickloom.operators.tables import derive
from tickloom.plans import ledger as L
from tickloom.plans import registry, registry3, registry4, registry8  # noqa: F401  the others add to registry
from tickloom.sources import bars as B

SF = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    """Shuffles, without what is sent to all workers."""
    return sum("Exchange hashpartitioning" in x for x in plan_of(df).splitlines())


def test_bars_need_one_exchange(spark):
    assert exchanges(B.walk(spark, SF)) == 1


def test_trades_are_not_sorted_by_call(spark):
    """A call meets its bars where the symbol's bars are, and the pairs are aggregated by hash."""
    df = registry.QUERIES["c9_trade_eval"](spark, SF)
    assert "SortAggregate" not in plan_of(df)
    assert exchanges(df) <= 2  # of the lines, for calls and for bars


def test_market_average_shuffles_no_pairs(spark):
    """Pairs of a symbol and a span are joined with broadcast spans only, and averaged before the exchange."""
    bars = B.walk(spark, SF)
    calls = spark.createDataFrame([("1995-03-01", "1995-03-09"), ("1995-03-01", "1995-03-09"), ("1996-01-02", "2001-01-01")], "d0 string, d1 string").selectExpr("date(d0) AS d0", "date(d1) AS d1")
    df = L.market_average(calls, bars)
    assert "SortMergeJoin" not in plan_of(df)
    got = {(str(r.d0), str(r.d1)): round(r.mkt, 9) for r in df.collect()}
    closes = {(r.symbol, str(r.date)): r.close for r in bars.collect()}
    want = {}
    for d0, d1 in {("1995-03-01", "1995-03-09"), ("1996-01-02", "2001-01-01")}:
        both = [closes[s, d1] / c - 1 for (s, d), c in closes.items() if d == d0 and (s, d1) in closes]
        if both:
            want[d0, d1] = round(sum(both) / len(both), 9)
    assert got == want


def test_features_of_patterns_compute_events_once(spark):
    """One grouped map (of true ranges) in the whole plan: counts and decays come from one aggregation."""
    df = registry.QUERIES["c18_last_bar_patterns"](spark, SF)
    assert sum("FlatMapGroups" in x and "+-" in x for x in plan_of(df).splitlines()) == 1


def test_grouped_maps_take_what_is_due(spark):
    """Columns that nothing later reads don't pass through Python and its exchange; values stay as they are with all columns."""
    bars = B.walk(spark, SF).filter("symbol < 3")
    few, all_ = (derive(bars, I.COLUMNS, ["rsi14"], only=only) for only in (True, False))
    assert "deliv_qty" not in few.columns and "high" not in few.columns and "deliv_qty" in all_.columns
    rows = lambda df: sorted((r.symbol, r.date, r.rsi14) for r in df.collect() if r.rsi14 is not None)
    assert rows(few) == rows(all_) != []


def test_chart_patterns_shuffle_no_candidates(spark):
    """Candidates meet their bars in arrays: the walk's exchange, and one of what crosses or ranks, and no join."""
    plan = plan_of(charts.chart_patterns(B.walk(spark, SF)))
    assert "Join" not in plan
    assert sum("Exchange hashpartitioning" in x for x in plan.splitlines()) == 2
    assert sum("FlatMapGroups" in x and "+-" in x for x in plan.splitlines()) == 1


def test_facts_of_a_session_pass_python_what_is_due(spark, monkeypatch):
    seen, real = [], registry8.derive
    monkeypatch.setattr(registry8, "derive", lambda *a, **how: seen.append(how.get("only")) or real(*a, **how))
    registry8.session_facts(spark, SF)
    registry.QUERIES["r8_catalogue"](spark, SF)
    assert seen == [True] * 3


def windows(df) -> int:
    return sum("Window [" in x for x in plan_of(df).splitlines())


def test_bar_patterns_share_one_grouped_map(spark):
    """All bar patterns read a symbol's bars in one map, with no windows but those that make the bars."""
    bars = B.walk(spark, SF)
    df = patterns.all_events(bars)
    assert sum("FlatMapGroups" in x for x in plan_of(df).splitlines()) == 1
    assert windows(df) <= windows(bars)


def test_darvas_boxes_need_no_window(spark):
    assert "max(high" not in figures.darvas(B.walk(spark, SF))._jdf.queryExecution().optimizedPlan().toString()


def test_templates_are_chosen_for_candidates_not_for_bars(spark):
    """What a candidate counts is computed once, not again by the filter on it, and by its own template's text."""
    c = charts.candidates(charts.stretches(charts.walks(B.walk(spark, SF)), "dates", *charts.PRICES))
    plan = charts.counted(c)._jdf.queryExecution().optimizedPlan().toString()
    assert "aggregate(" in plan
    assert not any("Filter" in x and "aggregate(" in x for x in plan.splitlines())
    assert all("template" not in charts.crossing_text(x) for x in charts.TEMPLATES)


def test_columns_that_shown_texts_read_stay(spark):
    """Texts over the wanted columns may read the bars' own too, which no grouped map drops then."""
    assert "ta_SMA" in registry.QUERIES["ta_features"](spark, SF).columns


def test_kernels_keep_the_partitions(spark):
    """Kernels between windows, several times over, need no exchange but that of the bars."""
    for name in ("ta_momentum", "feat_kernels", "sig_candles", "sig_smoothed"):
        assert exchanges(registry.QUERIES[name](spark, SF)) == 1


def test_divergences_exchange_bars_and_points_only(spark):
    """The oscillators and ranges that swing points read are made where the bars are."""
    assert exchanges(registry.QUERIES["g20_divergences"](spark, SF)) <= 2


def test_the_catalogue_exchanges_no_features(spark):
    """An exchange of each walk over the bars, and those of weeks and of events; none between levels of columns."""
    assert exchanges(registry.QUERIES["r8_catalogue"](spark, SF)) <= 5
