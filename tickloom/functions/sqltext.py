"""Pieces of SQL text over bars, valid in Spark SQL and in ANSI engines alike."""

from __future__ import annotations

S = "PARTITION BY symbol ORDER BY date"
#: What `roll` has written over plain columns: how, column, bars and least values, by the text.
ROLLS: dict[str, tuple[str, str, int, int]] = {}


def over(f: str, n: int, by: str = S) -> str:
    """An aggregate call over the current row and the n - 1 before it."""
    return f"{f} OVER ({by} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def roll(how: str, x: str, n: int, least: int | None = None, by: str = S) -> str:
    """A rolling aggregate, null with fewer than `least` (n) values."""
    f = {"mean": "avg", "sum": "sum", "std": "stddev_samp", "var": "var_samp", "max": "max", "min": "min", "pvar": "var_pop"}[how]
    text = f"CASE WHEN {over(f'count({x})', n, by)} >= {least or n} THEN {over(f'{f}({x})', n, by)} END"
    if by == S and x.isidentifier():
        ROLLS[text] = (how, x, n, least or n)
    return text


def prev(how: str, x: str, n: int, least: int | None = None) -> str:
    """A rolling aggregate of the n rows before the current one."""
    w = f"({S} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"
    return f"CASE WHEN count({x}) OVER {w} >= {least or n} THEN {how}({x}) OVER {w} END"


def lag(x: str, n: int = 1, by: str = S) -> str:
    return f"lag({x}, {n}) OVER ({by})"


def so_far(f: str) -> str:
    return f"{f} OVER ({S} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def div(a: str, b: str) -> str:
    return f"CASE WHEN abs({b}) > 1e-12 THEN ({a}) / ({b}) END"


def dist(a: str, b: str) -> str:
    return f"100 * (({div(a, b)}) - 1)"


def half_up(e: str, digits: int) -> str:
    """Rounded half up, by the same arithmetic in every engine."""
    return f"floor(({e}) * 1e{digits} + 0.5) / 1e{digits}"


def r(e: str) -> str:
    """Rounded to six decimals, as results are compared; to nine first, which drops what the order of a sum leaves."""
    return half_up(f"round({e}, 9)", 6)


def flag(c: str) -> str:
    return f"CASE WHEN {c} THEN 1.0 ELSE 0.0 END"


def weighted(x: str, weights: list[float]) -> str:
    """Sum of weights[k] * the value k bars ago; null while one is missing."""
    return " + ".join(f"{w!r} * {lag(x, k) if k else x}" for k, w in enumerate(weights))


def wma(x: str, n: int) -> str:
    return f"({weighted(x, [float(n - k) for k in range(n)])}) / {n * (n + 1) / 2!r}"


def up(x: str, level: str | float = 0) -> str:
    """x crosses above a level."""
    return f"({x} > {level} AND {lag(x)} <= {level})"


def dn(x: str, level: str | float = 0) -> str:
    return f"({x} < {level} AND {lag(x)} >= {level})"


def flip(x: str, value: float) -> str:
    """x becomes value, having been another, known one."""
    return f"({x} = {value} AND {lag(x)} <> {value})"
