"""Line dedup (operator 3): lines that many documents share go.

Method: every document gives the 128-bit hashes of its distinct line keys, which are counted with a partial aggregation. The
keys that reach the limit are dealt into shards by hash; each shard becomes a minimal perfect hash (levels of bit arrays) over
its keys with an array of 64-bit fingerprints and an array of counts. The documents are then read again, and each line probes
the arrays: its slot's fingerprint says whether the line is the indexed one, its count whether it goes. Keys below the limit
need no slot, as the fingerprint rejects them. No line text is shuffled, and no lines are joined.

An index of at most `index_bytes` is sent to all workers. A larger one stays in shards: the documents' line hashes are then
dealt to the shards, salted by document so that a frequent line is spread, and probe them there.

Nulls and edges: a null or empty text is one empty line; a key is the line without blanks (bytes 32 and 9 to 13) at its ends and
with A-Z lower-cased; keys shorter than `min_chars` code points stay; repeated rows are documents of their own; columns of the
input pass through, those named like an added one are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import LOWER, MASK, add_columns, keep, map_texts, mix, numbered, remove

MIN_DOCS, MIN_CHARS = 10, 1
SHARD_KEYS = 1 << 16
INDEX_BYTES = 64 << 20
PROBES_A_TASK = 500_000
BLANKS = b" \t\n\x0b\x0c\r"


class MinimalHash:
    """A minimal perfect hash: keys that fall alone into a level's bit array own that bit; the others go to the next level."""

    LEVELS = 40

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        self.ranks, n = [], 0
        for bits in levels:
            r = np.cumsum(bits, dtype=np.int64) - bits + n
            n += int(bits.sum())
            self.ranks.append(r)

    @staticmethod
    def places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return mix(keys + np.uint64((level * 0xA0761D6478BD642F) & MASK)) % np.uint64(size)

    @classmethod
    def build(cls, keys: np.ndarray) -> tuple[MinimalHash, np.ndarray]:
        """The hash, and the keys that no level could tell apart (equal ones)."""
        levels = []
        while len(keys) and len(levels) < cls.LEVELS:
            size = max(64, 2 * len(keys))
            at = cls.places(keys, len(levels), size)
            hits = np.bincount(at, minlength=size)
            levels.append(hits == 1)
            keys = keys[hits[at] > 1]
        return cls(levels), keys

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for each key, -1 for keys that are surely foreign; other foreign keys get someone's slot."""
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks, strict=True)):
            at = self.places(keys[todo], level, len(bits))
            own = bits[at]
            out[todo[own]] = ranks[at[own]]
            todo = todo[~own]
        return out


class Shard:
    """Minimal perfect hash, fingerprints and counts of one shard's keys."""

    def __init__(self, blob: bytes):
        import pickle

        sizes, packed, self.prints, self.counts, self.rest = pickle.loads(blob)
        self.hash = MinimalHash([np.unpackbits(p, count=n).astype(bool) for p, n in zip(packed, sizes, strict=True)])

    @staticmethod
    def build(hi: np.ndarray, lo: np.ndarray, counts: np.ndarray) -> bytes:
        import pickle

        h, equal = MinimalHash.build(hi)
        odd = np.isin(hi, equal)
        rest = {(int(a), int(b)): int(c) for a, b, c in zip(hi[odd], lo[odd], counts[odd], strict=True)}
        hi, lo, counts = hi[~odd], lo[~odd], counts[~odd]
        slot = h.slots(hi)
        prints, n = np.zeros(len(hi), np.uint64), np.zeros(len(hi), np.int64)
        prints[slot], n[slot] = lo, counts
        return pickle.dumps(([len(b) for b in h.levels], [np.packbits(b) for b in h.levels], prints, n, rest))

    def count(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """How many documents have each key; 0 for a key that isn't indexed."""
        out = np.zeros(len(hi), np.int64)
        if len(self.prints):
            slot = self.hash.slots(hi)
            hit = (slot >= 0) & (self.prints[slot] == lo)
            out[hit] = self.counts[slot[hit]]
        for k in range(len(hi)) if self.rest else ():
            out[k] = self.rest.get((int(hi[k]), int(lo[k])), out[k])
        return out


def line_keys(text: bytes, min_chars: int) -> tuple[list[bytes], list[int]]:
    """A text's lines, and the 128-bit hash of each one's key, -1 for a key that is too short."""
    lines = text.split(b"\n")
    keys = [x.strip(BLANKS) for x in text.translate(LOWER).split(b"\n")]
    long = lambda k: len(k) >= 4 * min_chars or len(k.decode("utf-8")) >= min_chars
    return lines, [xxhash.xxh3_128_intdigest(k) if long(k) else -1 for k in keys]


def halves(keys: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([k >> 64 for k in keys], np.uint64), np.array([k & MASK for k in keys], np.uint64)


KEYS = T.StructType([T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType())])


def line_counts(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """hi, lo, n_docs of each distinct line key."""

    def step(_rows, texts):
        hi, lo = halves([k for t in texts for k in set(line_keys(t, min_chars)[1]) - {-1}])
        return {"hi": hi.view(np.int64), "lo": lo.view(np.int64)}

    return map_texts(docs.select("text"), "text", KEYS, step).groupBy("hi", "lo").agg(F.count("*").alias("n_docs"))


def build_index(keys: DataFrame, shards: int) -> DataFrame:
    """shard, blob: the arrays of each shard of the keys (hi, lo, n_docs)."""

    def build(t: pa.Table) -> pa.Table:
        of = lambda c: t.column(c).to_numpy()
        blob = Shard.build(of("hi").view(np.uint64), of("lo").view(np.uint64), of("n_docs"))
        return pa.table({"shard": pa.array([t.column("shard")[0].as_py()], pa.int32()), "blob": pa.array([blob], pa.binary())})

    return keys.withColumn("shard", F.pmod("hi", F.lit(shards)).cast("int")).groupBy("shard").applyInArrow(build, "shard int, blob binary")


ADDED = [T.StructField("text", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())]


def _without(texts: list[bytes], gone: list[list[bool]], lines: list[list[bytes]]) -> dict:
    kept = [b"\n".join([x for x, g in zip(ls, gs, strict=True) if not g]) for ls, gs in zip(lines, gone, strict=True)]
    return {"text": pa.array([k.decode("utf-8") for k in kept], pa.string()), "n_lines": [len(ls) for ls in lines], "n_dropped": [sum(gs) for gs in gone]}


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS, index_bytes: int = INDEX_BYTES, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """docs with text without the lines whose key is in at least min_docs documents, and n_lines (before) and n_dropped."""
    spark = docs.sparkSession
    keys, keys_path = keep(line_counts(docs, min_chars).filter(F.col("n_docs") >= min_docs), "lines")
    n = keys.count()
    shards = max(1, -(-n // shard_keys))
    index, _ = keep(build_index(keys, shards), "index")
    size = index.agg(F.coalesce(F.sum(F.length("blob")), F.lit(0))).first()[0]
    remove(spark, keys_path)
    if size > index_bytes:
        return _routed(docs, index, shards, min_docs, min_chars)
    sent = spark.sparkContext.broadcast({r["shard"]: r["blob"] for r in index.collect()})  # at most index_bytes
    ready: dict[int, Shard] = {}

    def step(_rows, texts):
        if not ready:
            ready.update({k: Shard(b) for k, b in sent.value.items()})
        split = [line_keys(t, min_chars) for t in texts]
        flat = [k for _, ks in split for k in ks]
        hi, lo = halves([max(k, 0) for k in flat])
        shard = (hi.view(np.int64) % shards).astype(np.int64)
        hot = np.zeros(len(flat), bool)
        for s in np.unique(shard).tolist():
            if s in ready:
                own = np.flatnonzero(shard == s)
                hot[own] = ready[s].count(hi[own], lo[own]) >= min_docs
        hot &= np.array([k >= 0 for k in flat], bool)
        gone, at = [], 0
        for _, ks in split:
            gone.append(hot[at : at + len(ks)].tolist())
            at += len(ks)
        return _without(texts, gone, [ls for ls, _ in split])

    return add_columns(docs, "text", ADDED, step)


def _routed(docs: DataFrame, index: DataFrame, shards: int, min_docs: int, min_chars: int) -> DataFrame:
    """The same by dealing line hashes to the shards: for an index too large to send to every worker."""
    lines = docs.agg(F.coalesce(F.sum(F.regexp_count("text", F.lit("\n")) + 1), F.lit(0))).first()[0]
    salts = max(1, -(-lines // (shards * PROBES_A_TASK)))
    added = {f.name for f in ADDED}
    inner, named, back = numbered(docs)
    back = [c for c, n in zip(back, docs.columns, strict=True) if n.lower() not in added]
    own = inner.withColumn("_text_hash", F.xxhash64(named["text"]))
    probe = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("_text_hash", T.LongType()), *KEYS.fields])

    def give(rows, texts):
        keys = [list(set(line_keys(t, min_chars)[1]) - {-1}) for t in texts]
        hi, lo = halves([k for ks in keys for k in ks])
        each = [len(ks) for ks in keys]
        again = lambda c: pa.array([x for x, n in zip(rows.column(c).to_pylist(), each, strict=True) for _ in range(n)], pa.int64())
        return {"doc_id": again("doc_id"), "_text_hash": again("_text_hash"), "hi": hi.view(np.int64), "lo": lo.view(np.int64)}

    probes = map_texts(own.select(F.col(named["doc_id"]).cast("long").alias("doc_id"), "_text_hash", F.col(named["text"]).alias("text")), "text", probe, give)
    probes = probes.withColumns({"shard": F.pmod("hi", F.lit(shards)).cast("int"), "salt": F.pmod(F.xxhash64("doc_id", "_text_hash"), F.lit(salts)).cast("int")})
    dealt = index.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def look(a: pa.Table, b: pa.Table) -> pa.Table:
        if not (a.num_rows and b.num_rows):
            return a.select(probe.names).slice(0, 0)
        of = lambda c: a.column(c).to_numpy().view(np.uint64)
        hit = Shard(b.column("blob")[0].as_py()).count(of("hi"), of("lo")) >= min_docs
        return a.select(probe.names).filter(pa.array(hit))

    hits = probes.groupBy("shard", "salt").cogroup(dealt.groupBy("shard", "salt")).applyInArrow(look, probe)
    gone = hits.distinct().groupBy("doc_id", "_text_hash").agg(F.collect_list(F.struct("hi", "lo")).alias("_gone"))
    gone = gone.select(F.col("doc_id").alias("_d"), F.col("_text_hash").alias("_h"), "_gone")
    joined = own.join(gone, F.col(named["doc_id"]).cast("long").eqNullSafe(F.col("_d")) & F.col("_text_hash").eqNullSafe(F.col("_h")), "left").drop("_d", "_h", "_text_hash")

    def cut(rows, texts):
        split = [line_keys(t, min_chars) for t in texts]
        sets = [{((g["hi"] & MASK) << 64) | (g["lo"] & MASK) for g in gs or ()} for gs in rows.column("_gone").to_pylist()]
        return _without(texts, [[k in s for k in ks] for (_, ks), s in zip(split, sets, strict=True)], [ls for ls, _ in split])

    return add_columns(joined, named["text"], ADDED, cut).select(*back, *[f.name for f in ADDED])
