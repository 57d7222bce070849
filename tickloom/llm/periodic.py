"""Periodic run detection (operator 13): stretches of words that repeat with a fixed period, four times or more.

Method: block matching. A run of period q and of at least 4 q words holds, for the power of two B with B <= q < 2 B, an aligned
block of B words (its start divisible by B) that comes again q words later. So at each scale B the aligned blocks of a document
become keys of an Aho-Corasick automaton over word numbers, which is searched across the document; an occurrence of a block
between B and 2 B - 1 words after it, a distance that fits the scale, is a seed, and a seed is extended word by word in both
directions as far as words at that distance stay equal. A stretch found so is maximal; it is a run if it is long enough, and of
the distances that give one stretch the smallest is its period (the others are its multiples).

Blocks that can't seed are left out before the search: in a run each word comes again after q < 2 B words, so a block with a word
that doesn't is in no run of this scale. Blocks inside a run of a smaller scale would only find its multiples. Both are exact.

Documents are independent, so nothing is shuffled. Work is the document's words times the scales at which blocks are left, and
memory a few arrays of its length.

Nulls and edges: a null or blank text has no words and no runs, its collapsed text is empty; repeated rows are found each for
itself; columns of the input pass through, those named like an added one are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import add_columns

#: A run has at least so many words, and so many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
WORD = r"[^\x20\x09-\x0D]+"


def gaps(words: np.ndarray) -> np.ndarray:
    """How many words later each word comes again; the number of words where it doesn't."""
    order = np.argsort(words, kind="stable")
    again = words[order[1:]] == words[order[:-1]]
    out = np.full(len(words), len(words), np.int64)
    out[order[:-1][again]] = np.diff(order)[again]
    return out


def stretches(at: np.ndarray, before: int, after: int) -> Iterator[tuple[int, int]]:
    """The union of the ranges [x, x + before) of sorted x, cut to [0, after)."""
    cuts = np.flatnonzero(np.diff(at) > before) + 1
    for part in np.split(at, cuts):
        yield int(part[0]), min(after, int(part[-1]) + before)


def seeds(words: np.ndarray, starts: np.ndarray, block: int) -> Iterator[tuple[int, int]]:
    """(start, distance) of each later occurrence of the aligned blocks at starts, at distances from block to 2 * block - 1."""
    keys: dict[tuple[int, ...], int] = {}
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    of = []
    for b in starts.tolist():
        key = tuple(words[b : b + block].tolist())
        of.append(keys.setdefault(key, len(keys)))
        automaton.add_word(key, of[-1])
    automaton.make_automaton()
    places: list[list[int]] = [[] for _ in keys]
    for a, e in stretches(starts, 3 * block - 1, len(words)):
        for end, key in automaton.iter(tuple(words[a:e].tolist())):
            places[key].append(a + end + 1 - block)
    for b, key in zip(starts.tolist(), of, strict=True):
        here = places[key]
        for i in range(bisect_left(here, b + block), len(here)):
            if here[i] >= b + 2 * block:
                break
            yield b, here[i] - b


def extend(words: np.ndarray, at: int, distance: int) -> tuple[int, int]:
    """The longest range [a, e) around at in which each word equals the one that distance later."""
    e, width, last = at, 64, len(words) - distance
    while e < last:
        unlike = words[e : min(last, e + width)] != words[e + distance : min(last, e + width) + distance]
        if unlike.any():
            e += int(unlike.argmax())
            break
        e, width = min(last, e + width), width * 4
    a, width = at, 64
    while a > 0:
        unlike = words[max(0, a - width) : a] != words[max(0, a - width) + distance : a + distance]
        if unlike.any():
            a -= int(unlike[::-1].argmax())
            break
        a, width = max(0, a - width), width * 4
    return a, e


def find(words: np.ndarray, min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and then period; periods is 4 at least, as a block must fit in twice."""
    n, block, runs = len(words), 1, {}
    again = gaps(words) if n >= min_words else None
    covered = np.zeros(n, np.int64)  # the furthest end of a run of a smaller scale that holds the word
    while n >= max(min_words, periods * block):
        fits = again[: n // block * block].reshape(-1, block).max(1) < 2 * block
        starts = np.flatnonzero(fits) * block
        starts = starts[covered[starts] < np.minimum(n, starts + 3 * block - 1)]
        done: dict[int, int] = {}
        new = []
        for b, d in seeds(words, starts, block) if len(starts) else ():
            if b < done.get(d, 0) or b + d + block <= covered[b]:
                continue
            a, e = extend(words, b, d)
            done[d] = e
            if e - a + d >= max(min_words, periods * d):
                runs[a, e + d] = min(d, runs.get((a, e + d), d))
                new.append((a, e + d))
        for a, e in new:
            np.maximum(covered[a:e], e, out=covered[a:e])
        block *= 2
    return sorted((a, e - a, p) for (a, e), p in runs.items())


def numbers(words: list[bytes]) -> np.ndarray:
    ids: dict[bytes, int] = {}
    return np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))


RUN = T.StructType([T.StructField(c, T.LongType(), False) for c in ("start", "length", "period")])
ADDED = [T.StructField("runs", T.ArrayType(RUN, False)), T.StructField("collapsed", T.StringType())]


def periodic_runs(docs: DataFrame, min_words: int = MIN_WORDS, periods: int = MIN_PERIODS) -> DataFrame:
    """docs with runs (start, length, period in words) and collapsed: the words, joined by one space, of which each run keeps its first period."""
    if periods < 4:
        raise ValueError("a run needs four periods or more")

    def step(_rows, texts):
        runs, collapsed = [], []
        for text in texts:
            words = text.split()
            found = find(numbers(words), min_words, periods)
            if found:
                edge = np.zeros(len(words) + 1, np.int64)
                for a, length, p in found:
                    edge[a + p] += 1
                    edge[a + length] -= 1
                words = [w for w, gone in zip(words, np.cumsum(edge).tolist(), strict=False) if not gone]
            runs.append([{"start": a, "length": n, "period": p} for a, n, p in found])
            collapsed.append(b" ".join(words).decode())
        return {"runs": runs, "collapsed": pa.array(collapsed, pa.string())}

    return add_columns(docs, "text", ADDED, step)


def planted(docs: DataFrame) -> DataFrame:
    """docs in which a tenth of the texts, chosen by a hash of doc_id, goes on with a period of its words from some place to its end; a null doc_id is never chosen."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, words, n = F.floor(h / 10).cast("long"), F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.col("_n")
    a = F.expr("_g % _n")
    p = F.expr("1 + (_n - _g % _n) div (3 + _g % 8)")
    at = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    cycle = F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.element_at("_words", (at(i) + 1).cast("int"))), " ")
    d = docs.select("doc_id", "text", (h % 10 == 0).alias("_on"), g.alias("_g"))
    d = d.withColumn("_words", F.when(F.col("_on"), words)).withColumn("_n", F.coalesce(F.size("_words"), F.lit(0)).cast("long"))
    d = d.withColumn("_a", F.when(n > 0, a)).withColumn("_p", F.when(n > 0, p))
    return d.select("doc_id", F.when(F.col("_on") & (n > 0), cycle).otherwise(F.col("text")).alias("text"))


def longest(runs: Column) -> Column:
    """Of runs the one with the most periods; the first one by start and period of those that tie; null without runs."""
    none = F.lit(None).cast(RUN)
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def digests(found: DataFrame) -> DataFrame:
    """The columns of the query from periodic_runs' output."""
    best = longest(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    d = found.select("doc_id", "runs", "collapsed", best.alias("best"))
    return d.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
