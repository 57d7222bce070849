"""Queries of the declared columns: indicators, candlesticks, features and signals, each with its SQL where it has one."""

from __future__ import annotations

from tickloom.functions.sqltext import r
from tickloom.operators import candles as C
from tickloom.operators import features as Fe
from tickloom.operators import indicators as I
from tickloom.operators import signals as Sg
from tickloom.operators.tables import Columns, derive, derive_sql, needs
from tickloom.operators.windows import with_bench
from tickloom.plans.registry import query
from tickloom.sources import bars as B


def columns_query(name: str, columns: Columns, wanted: list[str], shown: dict[str, str] | None = None, sql: bool = True, bench: bool = False) -> None:
    """A query of wanted columns, rounded; shown: texts of other columns over the wanted ones."""
    shown = shown or {c: c for c in wanted}
    text = None
    if sql:
        src = "bq" if bench else "b"
        body, last = derive_sql(src, columns, wanted)
        start = ", bq AS (SELECT b.*, bench FROM b JOIN m USING (date))" if bench else ""
        text = start + body + "SELECT symbol, date, " + ", ".join(f"{r(e)} AS {n}" for n, e in shown.items()) + f" FROM {last}"

    def run(spark, sf):
        bars = B.walk(spark, sf)
        if bench:
            bars = with_bench(bars, B.benchmark(bars))
        read = set().union(*[needs(e, bars.columns) for e in shown.values()])
        return derive(bars, columns, [*wanted, *sorted(read)], only=True).selectExpr("symbol", "date", *[f"{r(e)} AS {n}" for n, e in shown.items()])

    query(name, text)(run)


for _group, _names in I.GROUPS.items():
    _has = [n for n in _names if n not in I.PATHS]
    columns_query(f"ta_{_group}", I.COLUMNS, _has)
columns_query("ta_paths", I.COLUMNS, I.PATHS, sql=False)
columns_query("ta_prices", I.COLUMNS, ["ta_AVGPRICE", "ta_MEDPRICE", "ta_TYPPRICE", "ta_WCLPRICE"])
_all = [n for g in I.GROUPS.values() for n in g if n not in I.PATHS]
columns_query("ta_features", I.COLUMNS | {"close_": "close"}, [*_all, "vol20"], {n: I.normalised(n) for n in _all})
columns_query("candles", C.COLUMNS, C.NAMES)
columns_query("feat_averages", Fe.COLUMNS, Fe.WINDOWED)
columns_query("feat_levels", Fe.COLUMNS, Fe.LEVELS)
columns_query("feat_relative", Fe.COLUMNS, Fe.RELATIVE, bench=True)
columns_query("feat_kernels", Fe.COLUMNS, Fe.KERNELS, sql=False)


def signals_query(name: str, rules: list[Sg.Rule], sql: bool = True, bench: bool = False) -> None:
    text = None
    if sql:
        columns, names = Sg.flags(rules)
        body, last = derive_sql("bq" if bench else "b", columns, names)
        start = ", bq AS (SELECT b.*, bench FROM b JOIN m USING (date))" if bench else ""
        text = start + body + "SELECT symbol, date, t, pattern, family, dir FROM (" + " UNION ALL ".join(f"SELECT symbol, date, t, '{p}' AS pattern, '{f}' AS family, {d} AS dir FROM {last} WHERE {n} = 1" for n, (p, f, d, _) in zip(names, rules, strict=True)) + ")"

    def run(spark, sf):
        bars = B.walk(spark, sf)
        return Sg.signals(with_bench(bars, B.benchmark(bars)) if bench else bars, rules)

    query(name, text)(run)


signals_query("sig_smoothed", Sg.SMOOTH_RULES)
signals_query("sig_relative", Sg.RELATIVE_RULES, bench=True)
signals_query("sig_kernels", Sg.KERNEL_RULES, sql=False)
signals_query("sig_candles", Sg.CANDLE_RULES)
