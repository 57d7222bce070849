"""Column expressions that the operators share. Missing numbers are NULL, never NaN; booleans become 0.0 or 1.0."""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

def by_symbol() -> WindowSpec:
    return Window.partitionBy("symbol").orderBy("date")


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_up(x: str | Column, digits: int) -> Column:
    """Rounded half up in double arithmetic, which gives the same number in every engine; never a negative zero."""
    return F.floor(col(x) * 10.0**digits + 0.5) / 10.0**digits


def r6(x: str | Column) -> Column:
    """Rounded to six decimals, as results are compared; to nine first, which drops what the order of a sum leaves."""
    return half_up(F.round(col(x), 9), 6)


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b, null unless |b| > 1e-12."""
    return F.when(F.abs(col(b)) > 1e-12, col(a) / col(b))


def pct_dist(a: str | Column, b: str | Column) -> Column:
    """How far a is above b, in percent."""
    return 100 * (safe_div(a, b) - 1)


def flag(cond: Column) -> Column:
    """1.0 where cond holds, else 0.0, also where it is null."""
    return F.coalesce(cond, F.lit(False)).cast("double")


def finite_float(x: str | Column) -> Column:
    """Null for NaN and infinities, then 32-bit."""
    x = col(x)
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x).cast("float")


def lag(x: str | Column, n: int = 1, over: WindowSpec | None = None) -> Column:
    return F.lag(col(x), n).over(over or by_symbol())


def frame(n: int, over: WindowSpec | None = None) -> WindowSpec:
    """The current row and the n - 1 before it."""
    return (over or by_symbol()).rowsBetween(-(n - 1), 0)


def rolling(how: str, x: str | Column, n: int, least: int | None = None, over: WindowSpec | None = None) -> Column:
    """An aggregate over the last n rows, null with fewer than `least` (n) values."""
    w = frame(n, over)
    x = col(x)
    f = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp, "var": F.var_samp, "max": F.max, "min": F.min}[how]
    return F.when(F.count(x).over(w) >= (least or n), f(x).over(w))


def rank_pct(x: str | Column, by: list[str], where: Column | None = None) -> Column:
    """Rank among the values of a group as a share of them: ties share their mean rank, nulls have none."""
    x = col(x)
    if where is not None:
        x = F.when(where, x)
    rank = F.rank().over(Window.partitionBy(*by).orderBy(x.asc_nulls_last()))
    ties = F.count(F.lit(1)).over(Window.partitionBy(*by, x))
    return F.when(x.isNotNull(), (rank + (ties - 1) / 2) / F.count(x).over(Window.partitionBy(*by)))


def crosses_up(x: str | Column, level: float | Column = 0.0, over: WindowSpec | None = None) -> Column:
    level = level if isinstance(level, Column) else F.lit(level)
    return F.coalesce((col(x) > level) & (lag(x, 1, over) <= level), F.lit(False))


def crosses_down(x: str | Column, level: float | Column = 0.0, over: WindowSpec | None = None) -> Column:
    level = level if isinstance(level, Column) else F.lit(level)
    return F.coalesce((col(x) < level) & (lag(x, 1, over) >= level), F.lit(False))


def flips_to(x: str | Column, value: float, over: WindowSpec | None = None) -> Column:
    """x becomes value, having been another, known one."""
    return F.coalesce((col(x) == value) & (lag(x, 1, over) != value), F.lit(False))


def clip(x: str | Column, low: float, high: float) -> Column:
    return F.when(col(x).isNotNull(), F.least(F.greatest(col(x), F.lit(low)), F.lit(high)))


def bucket(x: str | Column, edges: list[float]) -> Column:
    """k with edges[k] <= x < edges[k + 1], within 0 and the last bucket."""
    x, out = col(x), F.lit(0)
    for k in range(1, len(edges) - 1):
        out = F.when(x >= edges[k], F.lit(k)).otherwise(out)
    return F.when(x.isNotNull(), out)


def slug(x: str | Column, prefix: str = "pat_", most: int = 60) -> Column:
    words = F.regexp_replace(F.lower(col(x)), "[^a-z0-9]+", "_")
    return F.concat(F.lit(prefix), F.substring(F.regexp_replace(words, "^_+|_+$", ""), 1, most))


def ordinal(x: str | Column) -> Column:
    """1st, 2nd, 3rd, 4th, 11th ..."""
    x = col(x)
    last = F.when((x % 100).between(11, 13), "th").when(x % 10 == 1, "st").when(x % 10 == 2, "nd").when(x % 10 == 3, "rd").otherwise("th")
    return F.concat(x.cast("string"), last)


def week_end(date: str | Column) -> Column:
    """The Friday that ends the date's week."""
    return F.next_day(F.date_sub(col(date), 1), "FRI")
