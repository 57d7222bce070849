"""Derived columns declared by name: SQL text over other columns, recursive smoothings, or small kernels.

`derive` computes what the wanted columns need and nothing else. Text columns go level by level into Spark's windows over
(symbol, date), which share one exchange; smoothings and kernels that are due together share one Arrow aggregate over a symbol's
arrays, where pandas and numpy do a column at once. A symbol's history is bounded by the calendar.

Spark adds every frame anew for each bar; rolling aggregates over more than SHORT bars that `roll` wrote are kernels too, which add
all frames at once, each in its order.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.sqltext import ROLLS

#: Frames up to this many bars stay windows.
SHORT = 16
BASE = ("symbol", "date", "open", "high", "low", "close", "volume", "deliv_qty", "trades", "t", "bench")


@dataclass(frozen=True)
class Smooth:
    """x smoothed with a weight for the newest value. The first `seed` values make the start: their sum over `over`.

    With `seed` = `over` = n that is the mean of the first n. Null before `first` (`seed`) values; later nulls change nothing.
    """

    x: str
    weight: float
    seed: int = 1
    over: int | None = None
    first: int | None = None

    def series(self, x: pd.Series) -> np.ndarray:
        v = x.to_numpy(dtype=float)
        known = np.flatnonzero(~np.isnan(v))
        first = self.first or self.seed
        out = np.full(len(v), np.nan)
        if len(known) < self.seed:
            return out
        y = v.copy()
        y[: known[self.seed - 1] + 1] = np.nan
        y[known[self.seed - 1]] = v[known[: self.seed]].sum() / (self.over or self.seed)
        out = pd.Series(y).ewm(alpha=self.weight, adjust=False, ignore_na=True).mean().to_numpy().copy()
        if len(known) < first:
            out[:] = np.nan
        else:
            out[: known[first - 1]] = np.nan
        return out


@dataclass(frozen=True)
class Kernel:
    """Outputs of a function of one symbol's columns (arrays in order of date, NaN where null): a tuple of arrays."""

    inputs: tuple[str, ...]
    run: Callable[..., tuple[np.ndarray, ...]]
    place: int = 0


def ema(x: str, n: int) -> Smooth:
    return Smooth(x, 2 / (n + 1), n)


def rma(x: str, n: int) -> Smooth:
    return Smooth(x, 1 / n, n)


Column = str | Smooth | Kernel
Columns = Mapping[str, Column]


def needs(c: Column, known: Iterable[str]) -> set[str]:
    if isinstance(c, Smooth):
        return {c.x}
    return set(c.inputs) if isinstance(c, Kernel) else set(re.findall(r"[A-Za-z_]\w*", c)) & set(known)


def plan(columns: Columns, wanted: Iterable[str]) -> list[list[str]]:
    """The wanted columns and what they need, as levels: each level needs earlier ones only (a pass of recursions, its own too)."""
    known, open_, todo = set(columns), set(), list(wanted)
    while todo:
        n = todo.pop()
        if n in known and n not in open_:
            open_.add(n)
            todo += needs(columns[n], known)
    done: set[str] = set()
    levels: list[list[str]] = []
    ordered = [n for n in columns if n in open_]
    while len(done) < len(ordered):
        text = [n for n in ordered if n not in done and isinstance(columns[n], str) and needs(columns[n], known) <= done]
        level = text
        if not text:
            level = []
            while True:
                more = [n for n in ordered if n not in done and n not in level and not isinstance(columns[n], str) and needs(columns[n], known) & known <= done | set(level)]
                if not more:
                    break
                level += more
        if not level:
            raise ValueError(f"columns need one another: {sorted(set(ordered) - done)[:5]}")
        levels.append(level)
        done |= set(level)
    return levels


@lru_cache(maxsize=None)
def rolled(how: str, n: int, least: int) -> Callable[[np.ndarray], tuple[np.ndarray, ...]]:
    """A rolling aggregate as `roll` writes it: values enter from the oldest of each frame to the newest, so sums are a frame's own to the last bit."""

    def run(x: np.ndarray) -> tuple[np.ndarray, ...]:
        size, known = len(x), ~np.isnan(x)
        seen = np.concatenate((np.zeros(n, np.int64), np.cumsum(known)))
        count = seen[n:] - seen[:size]
        if how in ("max", "min"):
            out = getattr(pd.Series(x).rolling(n, min_periods=1), how)().to_numpy()
        else:
            value, there = np.concatenate((np.zeros(n - 1), np.where(known, x, 0.0))), np.concatenate((np.zeros(n - 1, bool), known))
            total, mean, square, k = np.zeros(size), np.zeros(size), np.zeros(size), np.zeros(size)
            for i in range(max(0, n - size), n):
                v = value[i : i + size]
                if how in ("mean", "sum"):
                    total += v
                    continue
                k += there[i : i + size]
                apart = np.where(there[i : i + size], v - mean, 0.0)
                step = apart / np.maximum(k, 1)
                mean += step
                square += apart * (apart - step)
            with np.errstate(all="ignore"):
                out = {"sum": lambda: total, "mean": lambda: total / count, "pvar": lambda: square / count, "var": lambda: square / (count - 1), "std": lambda: np.sqrt(square / (count - 1))}[how]()
        return (np.where((count >= least) & (count > (how in ("var", "std"))), out, np.nan),)

    return run


def unrolled(columns: Columns, least: int = SHORT) -> dict[str, Column]:
    """columns with kernels for the rolling aggregates over more than `least` bars in their texts."""
    long = {text: spec for text, spec in ROLLS.items() if spec[2] > least}
    out: dict[str, Column] = {}
    for name, c in columns.items():
        for text, (how, x, n, few) in long.items() if isinstance(c, str) and "PRECEDING" in c else ():
            if text not in c:
                continue
            kernel = Kernel((x,), rolled(how, n, few))
            if text == c:
                c = kernel
                break
            helper = f"_{how}_{x}_{n}_{few}"
            out[helper] = kernel
            c = c.replace(text, helper)
        out[name] = c
    return out


def recursions(df: DataFrame, columns: Columns, names: list[str]) -> DataFrame:
    """df with smoothings and kernels, in order, each over a symbol's whole columns.

    A symbol's bars become one row of arrays, over which an Arrow aggregate gives the columns, and rows again. All of it keeps the
    partitions by symbol, so later windows need no other exchange, and only what the kernels read passes through Python.
    """
    specs = [(n, columns[n]) for n in names]
    read = sorted({c for _, spec in specs for c in needs(spec, ())} - set(names))
    schema = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType()) for n in names]))

    def run(*inputs: pa.Array) -> pa.ListScalar:
        got = {c: x.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) for c, x in zip(read, inputs, strict=True)}
        kept = {}
        for n, spec in specs:
            if isinstance(spec, Smooth):
                got[n] = spec.series(pd.Series(got[spec.x]))
            else:
                key = (spec.run, spec.inputs)
                if key not in kept:
                    kept[key] = spec.run(*[got[c] for c in spec.inputs])
                got[n] = kept[key][spec.place]
        made = pa.StructArray.from_arrays([pa.array(np.asarray(got[n], float), from_pandas=True) for n in names], names)
        return pa.ListArray.from_arrays(pa.array([0, len(made)], pa.int32()), made)[0]

    others = [c for c in df.columns if c not in ("symbol", "date")]
    rows = df.groupBy("symbol").agg(F.sort_array(F.collect_list(F.struct("date", *others))).alias("rows"))
    made = F.arrow_udf(run, schema)(*[F.col(f"rows.{c}") for c in read]).over(Window.partitionBy("symbol"))
    rows = rows.withColumn("made", made).select("symbol", F.inline(F.arrays_zip("rows", "made")))
    return rows.select(*[c if c == "symbol" else f"rows.{c}" for c in df.columns], "made.*")


def derive(df: DataFrame, columns: Columns, wanted: Iterable[str], only: bool = False) -> DataFrame:
    """df (symbol, date and what the columns read) with the wanted columns and those they need; with `only`, no others become arrays."""
    wanted, columns = list(wanted), unrolled(columns)
    levels = plan(columns, wanted)
    for k, level in enumerate(levels):
        if isinstance(columns[level[0]], str):
            df = df.selectExpr("*", *[f"({columns[n]}) AS {n}" for n in level])
        else:
            if only:
                due = {"symbol", "date", *wanted}.union(*[needs(columns[n], df.columns) for later in levels[k:] for n in later])
                df = df.select(*[c for c in df.columns if c in due])
            df = recursions(df, columns, level)
    return df


def derive_sql(src: str, columns: Columns, wanted: Iterable[str], last: str = "derived") -> str:
    """The same in SQL, as common tables after `src` (which has t, a bar's number): a recursive one for each smoothing of a level."""
    out, now, k = [], src, 0

    def table(body: str) -> None:
        nonlocal now, k
        k += 1
        now = f"{last}_{k}"
        out.append(f"{now} AS MATERIALIZED ({body})")

    for level in plan(columns, wanted):
        if isinstance(columns[level[0]], str):
            table("SELECT *, " + ", ".join(f"(({columns[n]}))::DOUBLE AS {n}".replace("percentile(", "quantile_cont(") for n in level) + f" FROM {now}")
            continue
        left = list(level)
        while left:
            due = [n for n in left if not set(left) & {columns[n].x}]
            left = [n for n in left if n not in due]
            first, after, shown = [], [], []
            for n in due:
                c: Smooth = columns[n]
                over_, least = c.over or c.seed, c.first or c.seed
                value = lambda acc, cnt, x, c=c, o=over_: f"CASE WHEN {x} IS NULL THEN {acc} WHEN {cnt} + 1 < {c.seed} THEN {acc} + {x} WHEN {cnt} + 1 = {c.seed} THEN ({acc} + {x}) / {o}::DOUBLE ELSE {acc} + {c.weight!r}::DOUBLE * ({x} - {acc}) END"
                first += [f"{value('0.0::DOUBLE', '0', f'x.{c.x}')} AS {n}", f"CASE WHEN x.{c.x} IS NULL THEN 0 ELSE 1 END AS {n}_n"]
                after += [value(f"k.{n}", f"k.{n}_n", f"x.{c.x}"), f"k.{n}_n + CASE WHEN x.{c.x} IS NULL THEN 0 ELSE 1 END"]
                shown.append(f"CASE WHEN k.{n}_n >= {least} THEN k.{n} END AS {n}")
            rec = f"{now}_r"
            out.append(f"{rec} AS (SELECT x.symbol, x.t, {', '.join(first)} FROM {now} x WHERE t = 0 UNION ALL SELECT x.symbol, x.t, {', '.join(after)} FROM {rec} k JOIN {now} x ON x.symbol = k.symbol AND x.t = k.t + 1)")
            table(f"SELECT x.*, {', '.join(shown)} FROM {now} x JOIN {rec} k ON x.symbol = k.symbol AND x.t = k.t")
    return ", " + ", ".join(out) + " ", now
