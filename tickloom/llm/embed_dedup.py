"""Embedding near-dedup with product quantisation (operator 1).

Method: a bounded sample (`SAMPLE` vectors, a parameter) fits coarse centroids and, on the residuals to them, `PARTS` codebooks of
`CODES` words. Every vector is stored in the inverted list of its nearest centroid as a code of PARTS bytes with its exact vector
and the error of the code; it asks every list that can hold a vector within the threshold: by the list's radius, and as a list's
vectors lie on its side of the plane midway to any other centroid. In a list, asymmetric distances of queries to all codes come from
a product with what the codes stand for. As the code's error is known, the triangle inequality bounds the true distance from
below. Only pairs that cannot reach the threshold are left out, so neither lists nor quantisation lose a link; what goes on is
reranked by the exact cosine in double precision. The result is exact; what the bounds leave depends on the data, and where they
leave all lists (vectors without clusters) the work grows with the square of the distinct vectors.

Equal vectors are one node with a count before anything else, so a frequent vector costs one row. Neighbouring lists are put together
up to about `BLOCK` rows, longer ones are cut by a hash, and a task compares two such blocks, so no list meets in one task and a row is
sent once for each block that it can reach. A task gives back link counts and a spanning forest of its links, never all pairs; each
pair meets in one task. Components come from the forests.

Nulls and edges: vectors that are null, empty, zero or hold null or non-finite components link with nothing; vectors of different
lengths don't link; repeated rows link with each other; a null vec_id is a vector without number: it counts for others but has no
component; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import keep, mix, small_batches
from tickloom.llm.components import connected_components

COSINE, SAMPLE, LIST_ROWS, LISTS, PARTS, CODES, BLOCK = 0.9, 16384, 512, 1024, 8, 64, 4096


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = nearest(x, centres, 1)[:, 0]
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def nearest(x: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """The k nearest centres of each row, nearest first."""
    out = np.zeros((len(x), k), np.int32)
    for a in range(0, len(x), 2048):
        d = (centres**2).sum(1) - 2 * x[a : a + 2048] @ centres.T
        part = np.argpartition(d, k - 1, axis=1)[:, :k] if k < len(centres) else np.tile(np.arange(len(centres)), (len(d), 1))
        out[a : a + 2048] = np.take_along_axis(part, np.argsort(np.take_along_axis(d, part, 1), 1), 1)
    return out


@dataclass
class Quantiser:
    """Coarse centroids, and codebooks of the residuals: parts x codes x width, the vectors filled up to parts * width."""

    centres: np.ndarray
    books: np.ndarray

    @classmethod
    def fit(cls, sample: np.ndarray, lists: int) -> Quantiser:
        centres = kmeans(sample, max(1, min(lists, len(sample))))
        rest = cls.split(sample - centres[nearest(sample, centres, 1)[:, 0]])
        return cls(centres, np.stack([kmeans(rest[:, p], min(CODES, len(sample)), seed=p + 1) for p in range(PARTS)]))

    @staticmethod
    def split(x: np.ndarray) -> np.ndarray:
        width = -(-x.shape[1] // PARTS)
        full = np.zeros((len(x), PARTS * width), x.dtype)
        full[:, : x.shape[1]] = x
        return full.reshape(len(x), PARTS, width)

    def encode(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes, and how far each vector is from what its code stands for."""
        rest = self.split(x - self.centres[lists])
        codes = np.stack([nearest(rest[:, p], self.books[p], 1)[:, 0] for p in range(PARTS)], 1).astype(np.uint8)
        stands = np.stack([self.books[p][codes[:, p]] for p in range(PARTS)], 1)
        return codes, np.sqrt(((rest - stands) ** 2).sum((1, 2)))

    def distances(self, queries: np.ndarray, of_list: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric distances of queries to what the codes of one list stand for."""
        to = self.stands(of_list, codes)
        rest = queries - self.centres[of_list]
        out = (rest**2).sum(1)[:, None] + (to**2).sum(1)[None, :] - 2 * rest @ to.T
        return np.sqrt(np.maximum(out, 0))

    def stands(self, of_list: int, codes: np.ndarray) -> np.ndarray:
        """What the codes of one list stand for, less its centroid."""
        full = np.concatenate([self.books[p][codes[:, p]] for p in range(PARTS)], 1)
        return full[:, : self.centres.shape[1]]

#: Pairs whose exact cosines are worked out at a time.
PAIRS = 1 << 15


class Forest:
    """A spanning forest of links between positions below n. roots[i] is the tree of i after each add()."""

    def __init__(self, n: int):
        self.roots = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        """In rounds, one link of each tree: what is within a tree by then is dropped at once, so many links cost no loop."""
        while True:
            x, y = self.roots[a], self.roots[b]
            open_ = x != y
            a, b, x, y = a[open_], b[open_], x[open_], y[open_]
            if not len(a):
                return
            first = np.union1d(np.unique(x, return_index=True)[1], np.unique(y, return_index=True)[1])
            parent = {}
            for i, u, v in zip(first.tolist(), x[first].tolist(), y[first].tolist(), strict=True):
                while (p := parent.get(u, u)) != u:
                    u, parent[u] = p, parent.get(p, p)
                while (p := parent.get(v, v)) != v:
                    v, parent[v] = p, parent.get(p, p)
                if u != v:
                    parent[max(u, v)] = min(u, v)
                    self.links.append((int(a[i]), int(b[i])))
            to = np.arange(len(self.roots))
            to[list(parent)] = list(parent.values())
            while (to[to] != to).any():
                to = to[to]
            self.roots = to[self.roots]


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def pack(x: np.ndarray) -> list[bytes]:
    """Rows as single floats where these are exact, else as doubles."""
    with np.errstate(over="ignore"):
        short = x.astype(np.float32)
    return [(f if e else d).tobytes() for f, d, e in zip(short, x, (short == x).all(1).tolist(), strict=True)]


def unpack(rows: list[bytes], width: int) -> np.ndarray:
    return np.array([np.frombuffer(r, np.float32 if len(r) == 4 * width else np.float64) for r in rows], np.float64).reshape(len(rows), width)


@dataclass
class Reach:
    """Which lists can hold a vector within `far` of a vector, and how the lists make blocks."""

    centres: np.ndarray
    radius: np.ndarray  # of each list; -1 where it is empty
    far: float
    group: np.ndarray  # of each list: neighbouring lists of about a block of rows
    cuts: np.ndarray  # blocks of each group: more than one if it is a long list

    @classmethod
    def fit(cls, centres: np.ndarray, rows: np.ndarray, radius: np.ndarray, far: float, block: int) -> Reach:
        left, at, order = np.ones(len(centres), bool), 0, []
        while left.any():  # a chain from each list to the nearest one that isn't in it
            order.append(at)
            left[at] = False
            at = int(np.where(left, ((centres - centres[at]) ** 2).sum(1), np.inf).argmin())
        group, sums = np.zeros(len(centres), int), [0]
        for l in order:
            if sums[-1] and sums[-1] + rows[l] > block:
                sums.append(0)
            group[l] = len(sums) - 1
            sums[-1] += int(rows[l])
        return cls(centres, radius, far, group, np.maximum(1, -(-np.array(sums) // block)))

    def lists(self, x: np.ndarray, home: np.ndarray) -> np.ndarray:
        """Rows by lists: the ball about the centroid, and the plane midway between it and the own centroid, are both in reach."""
        c = self.centres
        d2 = np.maximum((x**2).sum(1)[:, None] + (c**2).sum(1) - 2 * x @ c.T, 0)
        to = c[home]
        between = np.sqrt(np.maximum((to**2).sum(1)[:, None] + (c**2).sum(1) - 2 * to @ c.T, 0))
        plane = d2 - d2[np.arange(len(x)), home][:, None] <= 2 * self.far * between + 1e-6
        return plane & (np.sqrt(d2) - self.radius <= self.far + 1e-6) & (self.radius >= 0)

    def blocks(self, x: np.ndarray, home: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each row's own block and all blocks that it can reach, its own among them."""
        first = np.cumsum(self.cuts) - self.cuts
        g = self.group[home]
        own = first[g] + (mix(node.astype(np.uint64)) % self.cuts[g].astype(np.uint64)).astype(np.int64)
        reached = np.zeros((len(x), len(self.cuts)), bool)
        lists = self.lists(x, home)
        for l in range(len(self.centres)):
            reached[:, self.group[l]] |= lists[:, l]
        reached[np.arange(len(x)), g] = True
        of_block = np.repeat(np.arange(len(self.cuts)), self.cuts)
        return own, [np.flatnonzero(r[of_block]) for r in reached]


def near_vectors(vectors: DataFrame, cosine: float = COSINE, sample: int = SAMPLE, probes: int | None = None, list_rows: int = LIST_ROWS, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of each row of vectors (vec_id, embedding).

    probes: without effect, for callers that still give it; every list in reach is asked.
    """
    spark = vectors.sparkSession
    small_batches(spark, 2000)
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    ok = "v IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"
    own, _ = keep(own.withColumn("v", F.expr(f"CASE WHEN {ok} THEN transform(v, x -> x + 0.0D) END")), "vectors")
    # equal vectors are one node: named by a hash of the vector, with the smallest number and the count
    nodes = own.filter("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    nodes, _ = keep(nodes.select(F.xxhash64("v").alias("node"), "v", F.size("v").alias("dim"), "first", "n"), "nodes")
    total = nodes.count()
    widest = nodes.agg(F.max("dim")).first()[0]
    lists = max(1, min(LISTS, total // list_rows))
    rows = nodes.filter(F.col("dim") == widest).orderBy(F.hash("node"), "node").limit(sample).select("v").toArrow() if total else None
    model = Quantiser.fit(unit(dense(rows.column("v").combine_chunks(), widest)), lists) if rows is not None and rows.num_rows else None
    if model is None:
        labels, counts = None, None
    else:
        sent = spark.sparkContext.broadcast(model)  # lists * widest + CODES * widest numbers

        def place(batches):
            for b in batches:
                if b.num_rows:
                    raw = dense(b.column("v"), widest)
                    x = unit(raw)
                    at = nearest(x, sent.value.centres, 1)[:, 0]
                    codes, error = sent.value.encode(x, at)
                    off = np.linalg.norm(x - sent.value.centres[at], axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("node"), b.column("n"), b.column("dim"), pa.array(pack(raw), pa.binary()), pa.array(at, pa.int32()), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(off)],
                        names=["node", "n", "dim", "v", "list", "codes", "error", "off"],
                    )

        placed, _ = keep(nodes.mapInArrow(place, "node long, n long, dim int, v binary, list int, codes binary, error double, off double"), "placed")
        n_rows, radius = np.zeros(len(model.centres), np.int64), np.full(len(model.centres), -1.0)
        for r in placed.groupBy("list").agg(F.count("*").alias("s"), F.max("off").alias("radius")).collect():  # a row a list: LISTS at most
            n_rows[r["list"]], radius[r["list"]] = r["s"], r["radius"]
        reach = spark.sparkContext.broadcast(Reach.fit(model.centres, n_rows, radius, np.sqrt(max(0.0, 2 - 2 * cosine)) + 1e-9, block))

        def deal(batches):
            for b in batches:
                if b.num_rows:
                    x = unit(unpack(b.column("v").to_pylist(), widest))
                    own_, all_ = reach.value.blocks(x, b.column("list").to_numpy(), b.column("node").to_numpy())
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own_, pa.int32()), pa.array(all_, pa.list_(pa.int32()))], names=[*b.schema.names, "own", "all"])

        dealt = placed.drop("off").mapInArrow(deal, "node long, n long, dim int, v binary, list int, codes binary, error double, own int, all array<int>")
        dealt = dealt.withColumn("other", F.explode("all")).select(
            F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), (F.col("own") > F.col("other")).alias("asks"), "node", "n", "dim", "v", "list", "codes", "error"
        )
        found = dealt.groupBy("p", "q").applyInArrow(_matcher(sent, reach, cosine, widest), "a long, b long, n_a long")
        found, _ = keep(found, "found")
        # rows with b are links of the forests; rows without are counts
        counts = found.filter("b IS NULL").groupBy(F.col("a").alias("node")).agg(F.sum("n_a").alias("more"))
        labels = connected_components(found.filter("b IS NOT NULL").select(F.col("a").alias("src"), F.col("b").alias("dst")))
    named = nodes.select("node", "v", "first", "n")
    if labels is None:
        named = named.withColumns({"more": F.lit(0).cast("long"), "c": F.col("node")})
    else:
        named = named.join(labels.select(F.col("id").alias("node"), "component"), "node", "left").join(counts, "node", "left").withColumns({"more": F.coalesce("more", F.lit(0)), "c": F.coalesce("component", "node")})
    named, _ = keep(named.select("node", "first", "n", "more", "c"), "named")
    smallest = named.groupBy("c").agg(F.min("first").alias("component_id"))
    named = named.join(smallest, "c").select("node", (F.col("n") - 1 + F.col("more")).alias("n_links"), "component_id")
    out = own.withColumn("node", F.when(F.col("v").isNotNull(), F.xxhash64("v"))).drop("v").join(named, "node", "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def dense(rows: pa.Array, width: int) -> np.ndarray:
    """Vectors of one width: shorter ones are filled with zeros, which keeps their cosines; links ask for equal lengths."""
    if not all(len(r) == width for r in rows):
        rows = pa.array([[*r.as_py(), *[0.0] * (width - len(r))] for r in rows], pa.list_(pa.float64()))
    return np.stack(rows.to_numpy(zero_copy_only=False)).astype(np.float64)


def _matcher(sent, reach, cosine: float, width: int):
    """Links between the rows of two blocks, or within one."""

    def match(key, t):
        t = t.take(pa.compute.sort_indices(t, [("list", "ascending")]))
        of = lambda c: t.column(c).to_numpy()
        ids, n, dim, home, asks, error = (of(c) for c in ("node", "n", "dim", "list", "asks", "error"))
        within = key[0].as_py() == key[1].as_py()
        x = unit(unpack(t.column("v").to_pylist(), width))
        single = x.astype(np.float32)
        codes = np.frombuffer(b"".join(t.column("codes").to_pylist()), np.uint8).reshape(t.num_rows, -1)
        asked = reach.value.lists(x, home)
        asked[np.arange(len(x)), home] = True
        mixed = (dim != dim[0]).any()
        more, tree = np.zeros(len(x), np.int64), Forest(len(x))
        for here in np.unique(home if within else home[~asks]):
            s = np.flatnonzero((home == here) if within else (home == here) & ~asks)
            q = np.flatnonzero(asked[:, here] if within else asked[:, here] & asks)
            if within:
                q = q[q > s[0]]
            for m in (s[c : c + 4096] for c in range(0, len(s), 4096)):
                # the codes' distances in single precision by one product: 1e-4 is far more than its rounding, and only lets more through
                to = sent.value.stands(here, codes[m]) + sent.value.centres[here]
                least = (((to**2).sum(1) + 1 - (reach.value.far + error[m]) ** 2) / 2 - 1e-4).astype(np.float32)
                to = to.T.astype(np.float32)
                for j in (q[c : c + 512] for c in range(0, len(q), 512)):
                    near = single[j] @ to >= least[None, :]
                    if within:
                        near &= m[None, :] < j[:, None]  # once each
                    if mixed:
                        near &= dim[m][None, :] == dim[j][:, None]
                    u, v = np.nonzero(near)
                    # one formula however full the block is, some pairs at a time
                    parts = [np.einsum("ij,ij->i", x[j[u[c : c + PAIRS]]], x[m[v[c : c + PAIRS]]]) >= cosine for c in range(0, len(u), PAIRS)]
                    hit = np.concatenate(parts) if parts else np.zeros(0, bool)
                    u, v = u[hit], v[hit]
                    if len(u):
                        more[j] += np.bincount(u, n[m[v]], len(j)).astype(np.int64)
                        more[m] += np.bincount(v, n[j[u]], len(m)).astype(np.int64)
                        tree.add(j[u], m[v])
        a, b = (np.array(e, np.int64) for e in (zip(*tree.links, strict=True) if tree.links else ((), ())))
        null = np.arange(len(a) + (more > 0).sum()) >= len(a)
        return pa.table({
            "a": pa.array(np.concatenate([ids[a], ids[more > 0]]), pa.int64()),
            "b": pa.array(np.concatenate([ids[b], np.zeros((more > 0).sum(), np.int64)]), pa.int64(), mask=null),
            "n_a": pa.array(np.concatenate([np.zeros(len(a), np.int64), more[more > 0]]), pa.int64()),
        })

    return match
