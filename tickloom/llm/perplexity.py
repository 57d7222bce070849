"""Quality rules (operator 11): plain counts of words, symbols, lines and repeats, and bands of n-gram perplexity by language.

Method: a modified Kneser-Ney model of order `ORDER` over UTF-8 bytes, with blanks run together to one space. Spark counts the
n-grams of all documents (each task counts its own before the shuffle); the lower orders count the distinct bytes before an n-gram,
the discounts follow from the counts of counts of each order, and one window by context (256 rows at most) and one join by suffix
give an order's interpolated probabilities from those of the order below. Costs are whole millionths of a bit, so sums don't depend
on their order.

The model is stored in sorted arrays of hashed n-grams, with an array of costs, and the same for contexts and their weights; a
lookup is a binary search. Arrays of at most `model_bytes` are sent to all workers. A larger model stays a table: each document's distinct n-grams are
joined with it, order by order, an n-gram that an order lacks going on to the next lower one with its context's weight.

A document has a perplexity a byte and one a word, 2 to the power of its bits over its bytes or words. For either each language has
a lower and an upper band, `SPREAD` times the range between its documents' quartiles below the first and above the third, wider
for short texts, whose bits vary more, by sqrt(1 + SHORT / bytes). Documents outside a band of their language are rejected:
repetitive or templated ones lie below, garbled ones above; noise that hangs on words is cheap by the byte and dear by the word.

Nulls and edges: a null or blank text has no words and fails the base rules; a null language is a language of its own; a language
of few documents has the narrowest band or wider, so a single document is kept; repeated rows are rated each and count each;
columns of the input pass through, those named like an added one are replaced; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import ODD, SPACE, STEP_BYTES, add_columns, keep, map_texts, mix, numbered, small_batches, steps, word_hashes

#: Bytes of the longest n-gram, as many as a long holds beside the order's number at most six.
ORDER = 5
#: Distinct n-grams that a task holds before it passes them on.
TASK_GRAMS = 2_000_000
MODEL_BYTES = 64 << 20
UNIT = 1_000_000
#: Bands: times the quartiles' range, bytes of a text whose band is 1.4 times as wide, and the least ranges in thousandths of a bit.
SPREAD, SHORT, LEAST_RANGE = 2.5, 1000, {"millibits": 20, "word_millibits": 200}
MIN_WORDS, MAX_REPEATED, WINDOW = 10, 20, 5
SYMBOL = np.isin(np.arange(256), list(b"#*$%&|<>"))
NO_ZERO = bytes([1]) + bytes(range(1, 256))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of ORDER bytes that end at each byte of the texts (zeros stand before a text, a space after it), and where each text's begin."""
    bodies = [b" ".join(t.translate(NO_ZERO).split()) for t in texts]
    bodies = [t + b" " if t else t for t in bodies]
    raw = np.frombuffer(b"".join(b"\0" * (ORDER - 1) + t for t in bodies), np.uint8)
    packed = np.zeros(max(0, len(raw) - ORDER + 1), np.int64)
    for j in range(ORDER if len(packed) else 0):
        packed = packed << 8 | raw[j : j + len(packed)]
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in bodies], out=at[1:])
    return packed[raw[ORDER - 1 :] != 0], at


def low(k: int) -> int:
    """A mask for the last k bytes."""
    return (1 << 8 * k) - 1


def counted(docs: DataFrame) -> DataFrame:
    """g, n: the n-grams of all documents, counted within each task."""
    small_batches(docs.sparkSession)
    names = ["g", "n"]

    def merged(parts):
        g = np.concatenate([p[0] for p in parts])
        found, at = np.unique(g, return_inverse=True)
        return found, np.bincount(at, np.concatenate([p[1] for p in parts]), len(found)).astype(np.int64)

    def run(batches):
        held, size = [], 0
        for batch in batches:
            texts = [x.encode("utf-8") if x else b"" for x in batch.column(0).to_pylist()]
            for a, b in steps([len(t) for t in texts]):
                held.append(np.unique(grams(texts[a:b])[0], return_counts=True))
                size += len(held[-1][0])
                if size > TASK_GRAMS:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > TASK_GRAMS // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in held[0]], names=names)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in merged(held)], names=names)

    return docs.select("text").mapInArrow(run, "g long, n long")


def discounts(n: dict[int, int]) -> list[float]:
    """What counts of 0, 1, 2 and 3 or more are less by, from how many n-grams occur once to four times."""
    n1, n2 = n.get(1, 0), n.get(2, 0)
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    return [0.0] + [min(c - 0.05, max(0.05, c - (c + 1) * y * n.get(c + 1, 0) / n[c])) if n.get(c) else 0.5 for c in (1, 2, 3)]


def fit(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The model of all documents: costs (k, g, cost) of n-grams and (k, g, cost) of contexts' weights, in millionths of a bit."""
    level = {}
    level[ORDER], _ = keep(counted(docs).groupBy("g").agg(F.sum("n").alias("c")), "grams")
    for k in range(ORDER - 1, 0, -1):
        level[k], _ = keep(level[k + 1].groupBy(F.col("g").bitwiseAND(low(k)).alias("g")).agg(F.count("*").alias("c")), "grams")
    few = None
    for k, d in level.items():
        part = d.filter("c <= 4").groupBy(F.lit(k).alias("k"), "c").agg(F.count("*").alias("n"))
        few = part if few is None else few.unionByName(part)
    found = few.collect()  # four numbers for each order
    probs, all_probs, weights = None, None, None
    bits = lambda p: F.round(-F.log2(p) * UNIT).cast("int")
    for k in range(1, ORDER + 1):
        d = discounts({r["c"]: r["n"] for r in found if r["k"] == k})
        w = Window.partitionBy("h")
        rows = level[k].withColumn("h", F.shiftright("g", 8))
        less = F.when(F.col("c") == 1, d[1]).when(F.col("c") == 2, d[2]).otherwise(d[3])
        n = lambda c, w=w: F.sum((F.least(F.col("c"), F.lit(3)) == c).cast("long")).over(w)
        total = F.sum("c").over(w)
        rows = rows.select("g", "h", ((F.col("c") - less) / total).alias("own"), ((n(1) * d[1] + n(2) * d[2] + n(3) * d[3]) / total).alias("weight"))
        if k == 1:
            now = rows.withColumn("p", F.col("own") + F.col("weight") / 256)
        else:
            now = rows.withColumn("low", F.col("g").bitwiseAND(low(k - 1))).join(probs.select(F.col("g").alias("low"), F.col("p").alias("lower")), "low").withColumn("p", F.expr("own + weight * lower"))
        now, _ = keep(now.select("g", "h", "p", "weight"), "probabilities")
        probs = now
        p = now.select(F.lit(k).alias("k"), "g", bits(F.col("p")).alias("cost"))
        c = now.groupBy("h").agg(F.min("weight").alias("weight")).select(F.lit(k).alias("k"), F.col("h").alias("g"), bits(F.col("weight")).alias("cost"))
        all_probs, weights = (p, c) if k == 1 else (all_probs.unionByName(p), weights.unionByName(c))
    return all_probs, weights


def hashed(k: int, g: np.ndarray) -> np.ndarray:
    return mix(g.astype(np.uint64) | np.uint64(k << 56))


@dataclass
class Model:
    """Sorted arrays of hashed n-grams and contexts (the hash is a bijection), each with its costs."""

    grams: np.ndarray
    costs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, probs: DataFrame, weights: DataFrame) -> Model:
        arrays = []
        for d in (probs, weights):
            t = d.toArrow()
            k, g, cost = (t.column(c).to_numpy() for c in ("k", "g", "cost"))
            key = mix(g.astype(np.uint64) | k.astype(np.uint64) << np.uint64(56))
            order = np.argsort(key)
            arrays += [key[order], cost[order].astype(np.int32)]
        return cls(*arrays)

    @staticmethod
    def find(keys: np.ndarray, sought: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each key sought would be, and whether it is there."""
        at = np.searchsorted(keys, sought)
        at[at == len(keys)] = 0
        return at, keys[at] == sought if len(keys) else np.zeros(len(sought), bool)

    def cost(self, g: np.ndarray) -> np.ndarray:
        """Cost of the last byte of each n-gram after the others, in millionths of a bit."""
        out = np.zeros(len(g), np.int64)
        left = np.arange(len(g))
        for k in range(ORDER, 0, -1):
            part = g[left] & low(k)
            at, there = self.find(self.grams, hashed(k, part))
            out[left[there]] += self.costs[at[there]]
            left, part = left[~there], part[~there]
            if not len(left):
                return out
            at, there = self.find(self.contexts, hashed(k, part >> 8))
            out[left[there]] += self.weights[at[there]]
        out[left] += 8 * UNIT
        return out


def base_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    sums = lambda flags: np.diff(np.concatenate(([0], np.concatenate(([0], np.cumsum(flags)))[ends])))
    h, at = word_hashes(texts, lower=False)
    doc = np.repeat(np.arange(len(texts)), np.diff(at))
    rolled = np.zeros(max(0, len(h) - WINDOW + 1), np.uint64)
    for j in range(WINDOW if len(rolled) else 0):
        rolled = rolled * np.uint64(ODD) + h[j : j + len(rolled)]
    own = np.flatnonzero(doc[: len(rolled)] == doc[WINDOW - 1 :]) if len(rolled) else np.zeros(0, np.int64)
    _, which, n = np.unique(mix(mix(rolled[own]) + doc[own].astype(np.uint64) * np.uint64(ODD)), return_inverse=True, return_counts=True)
    twice = own[n[which] > 1]
    edge = np.bincount(twice, minlength=len(h) + WINDOW + 1) - np.bincount(twice + WINDOW, minlength=len(h) + WINDOW + 1)
    covered = np.concatenate(([0], np.cumsum(np.cumsum(edge[: len(h)]) > 0)))
    lines = [[x for x in t.split(b"\n") if x.strip()] for t in texts]
    return {
        "n_words": np.diff(at),
        "word_chars": sums(~SPACE[raw] & (raw & 0xC0 != 0x80)),
        "n_symbols": sums(SYMBOL[raw]),
        "n_dup_lines": np.array([len(x) - len(set(x)) for x in lines], np.int64),
        "n_repeat_words": np.diff(covered[at]),
    }


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
BASE = [T.StructField(c, T.LongType()) for c in COUNTS]
SCORED = [*BASE, T.StructField("n_bytes", T.LongType()), T.StructField("millibits", T.LongType()), T.StructField("word_millibits", T.LongType())]


def millibits(total: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whole thousandths of a bit a byte or a word from millionths of bits in all; 0 for none."""
    return total // (np.maximum(n, 1) * (UNIT // 1000))


def score(docs: DataFrame, probs: DataFrame, weights: DataFrame, model_bytes: int = MODEL_BYTES, text: bool = True) -> DataFrame:
    """docs with the base counts, n_bytes (bytes that the model sees), millibits and word_millibits (thousandths of a bit a byte and a word); without text if so asked."""
    spark = docs.sparkSession
    rows = probs.count() + weights.count()
    if 12 * rows <= model_bytes:
        sent = spark.sparkContext.broadcast(Model.of(probs, weights))

        def step(_rows, texts):
            g, at = grams(texts)
            total = np.diff(np.concatenate(([0], np.cumsum(sent.value.cost(g))))[at])
            base = base_counts(texts)
            return base | {"n_bytes": np.diff(at), "millibits": millibits(total, np.diff(at)), "word_millibits": millibits(total, base["n_words"])}

        return _added(docs, SCORED, step, text)
    inner, new, back = numbered(docs)
    rated = add_columns(inner.withColumn("row", F.monotonically_increasing_id()), new["text"], BASE, lambda _rows, texts: base_counts(texts))
    kept, _ = keep(rated, "numbered")

    def distinct(batch, texts):
        g, at = grams(texts)
        doc = np.repeat(np.arange(len(texts)), np.diff(at))
        order = np.lexsort((g, doc))
        first = np.flatnonzero(np.concatenate(([True], (np.diff(g[order]) != 0) | (np.diff(doc[order]) != 0)))[: len(g)])
        return {"row": batch.column("row").to_numpy()[doc[order[first]]], "g": g[order[first]], "n": np.diff(np.append(first, len(g)))}

    todo = map_texts(kept.select("row", F.col(new["text"]).alias("text")), "text", T.StructType([T.StructField(c, T.LongType()) for c in ("row", "g", "n")]), distinct).withColumn("spent", F.lit(0).cast("long"))
    parts = None
    for k in range(ORDER, 0, -1):
        p = probs.filter(F.col("k") == k).select(F.col("g").alias("part"), F.col("cost").alias("found"))
        c = weights.filter(F.col("k") == k).select(F.col("g").alias("context"), F.col("cost").alias("more"))
        met, _ = keep(todo.withColumn("part", F.col("g").bitwiseAND(low(k))).join(p, "part", "left"), "looked-up")
        done = met.filter("found IS NOT NULL").select("row", F.expr("n * (spent + found)").alias("cost"), "n")
        rest = met.filter("found IS NULL").drop("found").withColumn("context", F.shiftright("part", 8)).join(c, "context", "left")
        todo = rest.select("row", "g", "n", (F.col("spent") + F.coalesce("more", F.lit(0))).alias("spent"))
        parts = done if parts is None else parts.unionByName(done)
    parts = parts.unionByName(todo.select("row", F.expr(f"n * (spent + {8 * UNIT})").alias("cost"), "n"))
    sums = parts.groupBy("row").agg(F.sum("cost").alias("cost"), F.sum("n").alias("n"))
    each = lambda n: F.expr(f"coalesce(cost div ({n} * {UNIT // 1000}), 0)")
    joined = kept.join(sums, "row", "left").withColumn("millibits", each("n")).withColumn("word_millibits", each("n_words")).withColumn("n_bytes", F.coalesce("n", F.lit(0)))
    gone = {f.name for f in SCORED} | (set() if text else {"text"})
    return joined.select(*[b for b, c in zip(back, docs.columns, strict=True) if c.lower() not in gone], *[f.name for f in SCORED])


def _added(docs: DataFrame, fields: list[T.StructField], step, text: bool) -> DataFrame:
    """add_columns, or the same without the text, which then never leaves the worker."""
    if text:
        return add_columns(docs, "text", fields, step, STEP_BYTES)
    names = {f.name.lower() for f in fields} | {"text"}
    passed = [f for f in docs.schema.fields if f.name.lower() not in names]

    def both(rows, texts):
        return {f.name: rows.column(rows.schema.get_field_index(f.name)) for f in passed} | step(rows, texts)

    return map_texts(docs, "text", T.StructType([*passed, *fields]), both, STEP_BYTES)


def bands(scored: DataFrame) -> DataFrame:
    """lang, measure, first, third: quartiles of either measure over all of a language's documents that have any bytes; two rows for each language."""
    each = F.explode(F.create_map(*[x for m in LEAST_RANGE for x in (F.lit(m), F.col(m))])).alias("measure", "value")
    bins = scored.filter("n_bytes > 0").select("lang", each).groupBy("lang", "measure", "value").agg(F.count("*").alias("n"))
    w = Window.partitionBy("lang", "measure")
    bins = bins.withColumn("upto", F.sum("n").over(w.orderBy("value"))).withColumn("total", F.sum("n").over(w))
    at = lambda q: F.min(F.when(F.col("upto") * 4 >= F.col("total") * q, F.col("value")))
    return bins.groupBy("lang", "measure").agg(at(1).alias("first"), at(3).alias("third"))


def verdicts(scored: DataFrame, spread: float = SPREAD, short: int = SHORT) -> DataFrame:
    """scored with perplexity, word_perplexity, base_failed and kept. The table is read twice: for the bands, and for the verdicts."""
    limits, _ = keep(bands(scored).groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("measure", F.struct("first", "third")))).alias("band")), "bands", 1)  # two entries
    inner, new, back = numbered(scored)
    col = lambda c: F.col(new[c])
    failed = (col("n_words") < MIN_WORDS) | (100 * col("n_repeat_words") > MAX_REPEATED * col("n_words"))
    inside = F.lit(True)
    for measure, least in LEAST_RANGE.items():
        first, third = (F.col("band")[measure][x] for x in ("first", "third"))
        wide: Column = spread * F.greatest(third - first, F.lit(least)) * F.sqrt(1 + F.lit(short) / F.greatest(col("n_bytes"), F.lit(1)))
        inside &= (col(measure) >= first - wide) & (col(measure) <= third + wide)
    added = {"perplexity": _power(col("millibits")), "word_perplexity": _power(col("word_millibits")), "base_failed": failed, "kept": ~failed & F.coalesce(inside, F.lit(False))}
    out = inner.join(limits.withColumnRenamed("lang", "of"), col("lang").eqNullSafe(F.col("of")), "left")
    return out.select(*[b for b, n in zip(back, scored.columns, strict=True) if n.lower() not in added], *[c.alias(n) for n, c in added.items()])


def _power(millibits: Column) -> Column:
    return F.round(F.pow(F.lit(2.0), millibits / 1000), 6)


def rate(docs: DataFrame, model_bytes: int = MODEL_BYTES) -> DataFrame:
    """docs with the base counts, perplexity and verdicts, by a model of the same documents."""
    return verdicts(score(docs, *fit(docs), model_bytes))


def rate_without_text(docs: DataFrame) -> DataFrame:
    """rate() without the text, which lets the scores be kept as a small table and not be worked out twice."""
    scored, _ = keep(score(docs, *fit(docs), text=False), "scored")
    return verdicts(scored)
