"""Rolling moments against plain loops, and averages that are equal but summed in another order."""

import math
import statistics

import numpy as np
import pytest

from tickloom.functions.sqltext import roll
from tickloom.operators import windows as W
from tickloom.operators.tables import derive
from tickloom.plans import registry, registry3  # noqa: F401  the other adds to registry

SF = "/root/testdata/sf0.001"


def rows_of(spark, values):
    return spark.createDataFrame([("a", k, *v) for k, v in enumerate(values)], "symbol string, date int, x double, y double")


def by_loop(values, n, f):
    out = []
    for k in range(len(values)):
        w = values[max(0, k - n + 1) : k + 1]
        out.append(f(w) if len(w) == n and not any(v is None for row in w for v in row) else None)
    return out


def fit(w):
    ys, xs = [v[0] for v in w], [v[1] for v in w]
    my, mx = statistics.mean(ys), statistics.mean(xs)
    xx, xy, yy = sum((x - mx) ** 2 for x in xs), sum((x - mx) * (y - my) for x, y in zip(xs, ys, strict=True)), sum((y - my) ** 2 for y in ys)
    return (None, None) if len(set(xs)) == 1 else (xy / xx, 1.0 if len(set(ys)) == 1 else xy * xy / xx / yy)


def shape(w):
    xs = [v[0] for v in w]
    if len(set(xs)) == 1:
        return None, None
    m, n = statistics.mean(xs), len(xs)
    m2, m3, m4 = (sum((x - m) ** p for x in xs) / n for p in (2, 3, 4))
    return m3 / m2**1.5, m4 / m2**2 - 3


def corr(w):
    xs, ys = [v[0] for v in w], [v[1] for v in w]
    sd = statistics.stdev(xs) * statistics.stdev(ys)
    mx, my = statistics.mean(xs), statistics.mean(ys)
    return (sum((x - mx) * (y - my) for x, y in w) / (len(w) - 1) / sd if sd > 1e-12 else None,)


CASES = {
    "mean_var": (("x",), W.mean_var, lambda w: (statistics.mean(v[0] for v in w), statistics.variance([v[0] for v in w]))),
    "line_fit": (("x", "y"), W.line_fit, fit),
    "skew_kurtosis": (("x",), W.skew_kurtosis, shape),
    "correlation": (("x", "y"), W.correlation, corr),
}


@pytest.mark.parametrize("name", CASES)
def test_moments_are_those_of_a_loop(spark, name):
    inputs, f, plain = CASES[name]
    values = [(100 + math.sin(k) * (k % 7), float(k * k % 11)) for k in range(20)]
    values[9] = (None, 1.0)
    values += [(5.1, 2.0)] * 6 + [(5.1, float(k)) for k in range(5)]  # what doesn't vary
    for n in (3, 5, 40):
        got = W.moments(rows_of(spark, values), w=(inputs, f, n, "p q" if name != "correlation" else "p")).orderBy("date").collect()
        want = by_loop([tuple(v[: len(inputs)]) for v in values], n, plain)
        for g, w in zip(got, want, strict=True):
            for c, v in zip(("p", "q"), w or (None, None)):
                if c in g:
                    assert g[c] == (None if v is None else pytest.approx(v, rel=1e-9, abs=1e-12)), (n, g)


@pytest.mark.parametrize("name", ["w2_bbands", "w7_linreg", "n26_variance_ratio", "w8_skew_kurt"])
def test_no_frame_is_summed_anew_for_each_bar(spark, name):
    """Windows of these queries look back at single bars only; moments come from one grouped map, without an exchange of its own."""
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(f in plan for f in ("regr_", "var_samp", "skewness", "kurtosis", "covar_samp"))
    assert sum("Exchange hashpartitioning" in x for x in plan.splitlines()) == 1


def test_equal_averages_are_equal(spark):
    """Every average of a price that stays is that price, but sums of 0.09 in floating point put that of 50 bars above that of 200."""
    bars = spark.createDataFrame([("a", k, 0.09) for k in range(260)], "symbol string, date int, close double")
    got = W.sma_stack(bars).collect()
    assert len(got) == 260 and {r.sma50_gt_sma200 for r in got} == {0.0}
    assert {(r.stack_up, r.stack_down) for r in got} == {(0.0, 0.0)}


def test_long_frames_of_columns_are_added_once(spark):
    """Declared rolling aggregates over more than 16 bars are no windows, and give a window's values to the last bit, nulls and short starts included."""
    values = [(None if k % 13 == 5 else 100 + math.sin(k) * (k % 7), 1.0) for k in range(90)] + [(0.09, 1.0)] * 40
    df = rows_of(spark, values)
    columns = {f"{how}_{n}_{few}": roll(how, "x", n, few) for how in ("mean", "sum", "std", "var", "pvar", "max", "min") for n, few in ((17, 17), (20, 1), (60, 30), (200, 120))}
    columns["apart"] = f"x - ({roll('mean', 'x', 50, 10)})"
    got = derive(df, columns, list(columns))
    assert "-19, currentrow" not in got._jdf.queryExecution().executedPlan().toString()
    want = df.selectExpr("*", *[f"({c}) AS {n}" for n, c in columns.items()])
    assert "-19, currentrow" in want._jdf.queryExecution().executedPlan().toString()
    rows = lambda d: [tuple(r) for r in d.select("date", *columns).orderBy("date").collect()]
    assert rows(got) == rows(want)


@pytest.mark.parametrize("name", ["feat_levels", "feat_averages", "sig_smoothed", "sig_kernels"])
def test_no_long_average_is_a_window(spark, name):
    plan = registry.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(f"RowFrame, -{n - 1}, currentrow" in plan for n in (20, 50, 150, 200, 252))


def test_beta_is_that_of_a_loop_and_no_frame(spark):
    """Windows that aren't full count from 0.8 of their bars on; values that don't vary give none; nothing is summed anew for each bar."""
    values = [(float(k * k % 11), math.sin(k) * (k % 7)) for k in range(90)] + [(1.5, 2.0)] * 70
    values[3], values[30] = (None, 1.0), (2.0, None)
    y, x = (np.array([math.nan if v[i] is None else v[i] for v in values]) for i in (0, 1))
    got = list(zip(*W.beta_and_corr(60)(y, x), strict=True))
    for k, (beta, both) in enumerate(got):
        w = values[max(0, k - 59) : k + 1]
        pairs = [v for v in w if None not in v]
        xs = [v[1] for v in w if v[1] is not None]
        if len(pairs) < 48 or statistics.variance(xs) <= 1e-12:
            assert math.isnan(beta) and math.isnan(both), k
            continue
        my, mx = (statistics.mean(v[i] for v in pairs) for i in (0, 1))
        covar = sum((y - my) * (x - mx) for y, x in pairs) / (len(pairs) - 1)
        assert beta == pytest.approx(covar / statistics.variance(xs), rel=1e-9, abs=1e-12), k
        assert both == pytest.approx(corr(pairs)[0], rel=1e-9, abs=1e-12), k
    plan = registry.QUERIES["w6_beta_corr"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "covar_samp" not in plan and "var_samp" not in plan
