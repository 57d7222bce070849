"""MinHash near-dedup with odd sketches (operator 5).

Method: a document's set of hashed word shingles gives `BANDS * ROWS` MinHash samples by as many permutations. Bands of ROWS
samples are the buckets; two documents of similarity 0.8 share no bucket with probability (1 - 0.8**5)**25 = 5e-5. The bottom
`BOTTOM` hashes of the set, a MinHash sample by one permutation, are folded into an odd sketch: a bitmap in which each sampled
hash flips one bit. The population count of two sketches' XOR is never more than the number of hashes that only one of them
has, which a link limits; for sets of up to BOTTOM shingles the sketch therefore rejects without error, for larger ones
beyond six standard deviations of the sample, one link in 10**9. What the sketches allow is confirmed on the full sets, counted exactly, before it
links. Texts with equal sets are one node from the start.

Buckets are not expanded into all pairs. First every member meets only its bucket's hub, the member that shares most bucket
places with others, which in a group of near copies is the one that the others were made from; confirmed links give components.
Then a bucket yields pairs of its members only across different components, the `PER_ROUND` most similar of each pair of
components (more in each further round), and rounds go on until no pair that the sketches allow is left unconfirmed between two
components. Thus a large group of near copies costs links in proportion to its size, and no link between components is lost.

Nulls and edges: a null or empty text, or one without words, has an empty set and links with nothing; fewer words than a
shingle's make one shingle; documents with the same doc_id share its component; a null doc_id links with nothing; repeated rows
give a row each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import MASK, keep, map_texts, mix, numbered, shingle_sets
from tickloom.llm.components import connected_components

WIDTH, PERCENT, BANDS, ROWS, WORDS, BOTTOM = 4, 80, 25, 5, 16, 1024
SAMPLES = BANDS * ROWS
PER_ROUND = 16
#: Documents up to which their numbers (16 bytes each) are broadcast to find their rows; beyond, rows are shuffled.
BROADCAST_IDS = 1_000_000
_FACTORS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019)) | np.uint64(1)
_SALTS = mix(np.arange(1, SAMPLES + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def samples(shingles: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set that isn't empty."""
    out = np.full(SAMPLES, MASK, np.uint64)
    for a in range(0, len(shingles), 2048):
        x = (shingles[a : a + 2048] ^ (shingles[a : a + 2048] >> np.uint64(32)))[None, :] * _FACTORS[:, None]
        np.minimum(out, (x ^ _SALTS[:, None]).min(1), out=out)
    return out


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """64 * WORDS bits of a sorted set: bit j is the parity of the BOTTOM least hashes that fall on j."""
    at = mix(shingles[:BOTTOM] + np.uint64(3)) % np.uint64(64 * WORDS)
    bits = (np.bincount(at.astype(np.int64), minlength=64 * WORDS) & 1).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def band_keys(mins: np.ndarray) -> np.ndarray:
    k = np.arange(1, BANDS + 1, dtype=np.uint64)
    for row in mins.reshape(BANDS, ROWS).T:
        k = mix(k * np.uint64(0x9E3779B97F4A7C15) + row)
    return k.view(np.int64)


def most_odd_bits(a: F.Column, b: F.Column, percent: int) -> F.Column:
    """How many bits the sketches of linked sets of sizes a and b differ in at most.

    Linked sets share percent / (100 + percent) of a + b at least. Up to BOTTOM, that limits the hashes on one side alone; of a
    larger set's sample that share is drawn, less six standard deviations. That many flips leave fewer odd bits on average.
    """
    shared = percent / (100 + percent) * (a + b)
    most = F.greatest(a, b).cast("double")
    q = F.least(shared / most, F.lit(1.0))
    drawn = F.lit(float(BOTTOM)) * q - 6 * F.sqrt(BOTTOM * q * (1 - q))
    sizes = F.least(a, F.lit(BOTTOM)) + F.least(b, F.lit(BOTTOM))
    flips = sizes - 2 * F.when(most <= BOTTOM, shared).otherwise(drawn)
    n = 64 * WORDS
    odd = n / 2 * (1 - F.exp(-2 * flips / n)) + 6 * F.sqrt(n / 4 * (1 - F.exp(-4 * flips / n)))
    return F.least(flips + 1e-6, odd + 1)


SKETCH = [f"k{i}" for i in range(WORDS)]
SIGNATURE = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("th", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("set_a", T.LongType()),
        T.StructField("set_b", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
        *(T.StructField(k, T.LongType()) for k in SKETCH),
    ]
)


def signatures(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Of each row of docs (doc_id, th, text): the size of its set, two hashes of the whole set, band keys and odd sketch (null for an empty set)."""

    def step(rows, texts):
        sets = list(shingle_sets(texts, width))
        mins = [samples(s) if len(s) else None for s in sets]
        sketch = [odd_sketch(s).tolist() if len(s) else None for s in sets]
        return {
            "doc_id": rows.column("doc_id"),
            "th": rows.column("th"),
            "n_shingles": [len(s) for s in sets],
            "set_a": [int(np.bitwise_xor.reduce(mix(s + np.uint64(1))).view(np.int64)) if len(s) else None for s in sets],
            "set_b": [int(np.add.reduce(mix(s + np.uint64(2))).view(np.int64)) if len(s) else None for s in sets],
            "bands": [None if m is None else band_keys(m) for m in mins],
        } | {k: [None if x is None else x[i] for x in sketch] for i, k in enumerate(SKETCH)}

    return map_texts(docs.select("doc_id", "th", "text"), "text", SIGNATURE, step)


ENDS = ["src", "src_th", "dst", "dst_th"]
PAIR = T.StructType([*(T.StructField(c, T.LongType()) for c in ENDS), T.StructField("linked", T.BooleanType())])


def confirm(pairs: DataFrame, texts: DataFrame, width: int, percent: int, parts: int) -> DataFrame:
    """The pairs (ENDS, a table) with linked: whether 100 * intersection >= percent * union on the full sets of texts (doc_id, th, text)."""
    name = lambda c: pairs.select(F.col(c).alias("doc_id"), F.col(f"{c}_th").alias("th"))
    ids, _ = keep(name("src").unionByName(name("dst")).distinct(), "ids", parts)
    small = ids.count() <= BROADCAST_IDS
    texts, _ = keep(texts.join(F.broadcast(ids) if small else ids, ["doc_id", "th"], "left_semi"), "texts")
    end = lambda c, text: texts.select(F.col("doc_id").alias(c), F.col("th").alias(f"{c}_th"), F.col("text").alias(text))
    both = pairs.join(end("src", "_left"), ["src", "src_th"]).join(end("dst", "_right"), ["dst", "dst_th"])

    def step(rows, right):
        left = [x.encode() if x else b"" for x in rows.column("_left").to_pylist()]
        linked, last, own = [], None, None
        for a, t in zip(shingle_sets(left, width), right, strict=True):
            if t != last:  # neighbours often have the same right side
                last, own = t, next(shingle_sets([t], width))
            common = len(np.intersect1d(a, own, assume_unique=True))
            linked.append(common > 0 and 100 * common >= percent * (len(a) + len(own) - common))
        return {c: rows.column(rows.schema.get_field_index(c)) for c in ENDS} | {"linked": pa.array(linked, pa.bool_())}

    return map_texts(both.select(*ENDS, "_left", "_right"), "_right", PAIR, step)


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of each row of docs (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    found, _ = keep(signatures(docs, width), "signatures")
    parts = max(8, found.count() // 50_000)
    whole = found.filter("doc_id IS NOT NULL AND n_shingles > 0")
    # one node for each set: its smallest document, and the hash of that one's text
    nodes = whole.groupBy("set_a", "set_b").agg(F.min_by(F.struct("doc_id", "th", "n_shingles", "bands", *SKETCH), F.struct("doc_id", "th")).alias("s"))
    nodes, _ = keep(nodes.select("set_a", "set_b", F.col("s.doc_id").alias("node"), "s.th", "s.n_shingles", "s.bands", *[f"s.{k}" for k in SKETCH]), "nodes", parts)
    same = whole.select("doc_id", "set_a", "set_b").join(nodes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
    same, _ = keep(same.filter("doc_id <> node").select(F.col("doc_id").alias("src"), F.col("node").alias("dst")).distinct(), "same", parts)

    buckets = nodes.select(F.explode("bands").alias("band"), "node", "th")
    counts = buckets.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    shared, _ = keep(buckets.join(counts, "band"), "buckets", 4 * parts)
    score = shared.groupBy("node", "th").agg(F.sum("n").alias("score"))
    best = F.struct("score", -F.col("node"), "th")
    hubs = shared.join(score, ["node", "th"]).groupBy("band").agg(F.max_by(F.struct("node", "th"), best).alias("hub"))
    info = nodes.select("node", "th", "n_shingles", *SKETCH)
    texts = docs.filter("doc_id IS NOT NULL")

    def side(name: str) -> DataFrame:
        return info.select(F.col("node").alias(name), F.col("th").alias(f"{name}_th"), F.col("n_shingles").alias(f"{name}_n"), *[F.col(k).alias(f"{name}_{k}") for k in SKETCH])

    def alike(a: str, b: str) -> tuple[F.Column, F.Column]:
        """How many bits of the sketches differ, and whether that and the sizes allow a link."""
        odd = sum((F.bit_count(F.col(f"{a}_{k}").bitwiseXOR(F.col(f"{b}_{k}"))) for k in SKETCH), F.lit(0))
        n = F.col(f"{a}_n"), F.col(f"{b}_n")
        return odd, (odd <= most_odd_bits(*n, percent)) & (100 * F.least(*n) >= percent * F.greatest(*n))

    with_hub = shared.join(hubs, "band").filter("node <> hub.node").select(F.col("node").alias("src"), F.col("th").alias("src_th"), F.col("hub.node").alias("dst"), F.col("hub.th").alias("dst_th")).distinct()
    pairs = with_hub.join(side("src"), ["src", "src_th"]).join(side("dst"), ["dst", "dst_th"]).filter(alike("src", "dst")[1]).select(*ENDS)
    pairs, _ = keep(pairs, "with-hub", parts)
    tried, links, rank = None, same, PER_ROUND
    while True:
        new, _ = keep(confirm(pairs, texts, width, percent, parts), "pairs", parts)
        tried = new if tried is None else tried.unionByName(new)
        links = links.unionByName(new.filter("linked").select("src", "dst"))
        labels, _ = keep(connected_components(links, parts), "labels", parts)
        named = shared.select("band", "node", "th").join(labels.withColumnRenamed("id", "node"), "node", "left").withColumn("c", F.coalesce("component", "node"))
        sizes = named.groupBy("band", "c").count()
        main = sizes.groupBy("band").agg(F.max_by("c", F.struct("count", "c")).alias("main"), F.count("*").alias("n")).filter("n > 1").drop("n")
        mixed, _ = keep(named.join(main, "band").select("band", "main", "c", "node", "th"), "mixed", 4 * parts)
        if mixed.isEmpty():
            break
        left = mixed.filter("c <> main").select("band", "main", F.col("c").alias("c_a"), F.col("node").alias("a"), F.col("th").alias("a_th")).join(side("a"), ["a", "a_th"])
        right = mixed.select("band", F.col("c").alias("c_b"), F.col("node").alias("b"), F.col("th").alias("b_th")).join(side("b"), ["b", "b_th"])
        odd, fits = alike("a", "b")
        across = left.join(right, (left["band"] == right["band"]) & (F.col("c_a") != F.col("c_b")) & ((F.col("c_b") == F.col("main")) | (F.col("c_a") < F.col("c_b"))) & fits)
        ends = [F.struct(F.col(x).alias("node"), F.col(f"{x}_th").alias("th")) for x in "ab"]
        high, low = F.greatest(*ends), F.least(*ends)
        across = across.select(high.alias("h"), low.alias("l"), F.least("c_a", "c_b").alias("c_a"), F.greatest("c_a", "c_b").alias("c_b"), odd.alias("odd")).distinct()
        across = across.select(F.col("h.node").alias("src"), F.col("h.th").alias("src_th"), F.col("l.node").alias("dst"), F.col("l.th").alias("dst_th"), "c_a", "c_b", "odd").join(tried.select(*ENDS), ENDS, "left_anti")
        best = across.withColumn("_r", F.row_number().over(Window.partitionBy("c_a", "c_b").orderBy("odd", *ENDS))).filter(F.col("_r") <= rank)
        pairs, _ = keep(best.select(*ENDS), "across", parts)
        if pairs.isEmpty():
            break
        rank *= 8
    out = found.join(labels.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """docs without all but one document of each group: the smallest doc_id stays, once; documents without one all stay."""
    found, _ = keep(near_duplicates(docs, width, percent).filter("doc_id IS NOT NULL").select("doc_id", "kept"), "found")
    gone, _ = keep(found.filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    few = gone.count() <= BROADCAST_IDS
    inner, own, back = numbered(docs)
    doc_id, text = F.col(own["doc_id"]), F.col(own["text"])
    stay = inner.join(F.broadcast(gone) if few else gone, doc_id == F.col("_gone"), "left_anti")
    twice, _ = keep(found.filter("kept").groupBy("doc_id").count().filter("count > 1").select(F.col("doc_id").alias("_twice")), "twice")
    if not twice.isEmpty():
        near = F.broadcast(twice) if twice.count() <= BROADCAST_IDS else twice
        again = stay.join(near, doc_id == F.col("_twice"), "left_semi")
        again = again.withColumn("_n", F.row_number().over(Window.partitionBy(doc_id).orderBy(F.xxhash64(text), text))).filter("_n = 1").drop("_n")
        stay = stay.join(near, doc_id == F.col("_twice"), "left_anti").unionByName(again)
    return stay.select(*back)
