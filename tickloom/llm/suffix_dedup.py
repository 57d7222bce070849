"""Suffix-array dedup (operator 6): bytes covered by a string of `LENGTH` bytes that also starts elsewhere go.

Method: a common-prefix-aware distributed merge sort of suffixes. Sorting every suffix would move the corpus a hundred times over, so
the suffix array is sparse: of every window of LENGTH bytes the position of its least hashed `GRAM`-byte string is an anchor, and
only suffixes at anchors are sorted. Equal windows choose equal anchors at equal places, so two equal windows always meet among the
suffixes that share their first GRAM bytes; about one position in 90 is an anchor, and every window belongs to exactly one.

A task sorts the anchored suffixes of its texts, each cut where the last window of its anchor ends, and writes them front-coded: for
each suffix how long its common prefix with the one before is, and what follows. The runs are exchanged by a hash of the first GRAM
bytes and merged by a loser tree that carries each run's common prefix with the last output: two suffixes are compared only
beyond what they are known to share, and the tree yields the common prefixes of neighbours in the merged order. These bound how
far to the right an anchor's windows can be repeated; the same bound to the left comes from sorting what precedes the anchors. A
window within both bounds is looked up among its group's windows by its bytes, so a removal never rests on a hash.

Equal suffixes with equal left sides are one entry, whose places are passed on as soon as there are two of them, so groups of
copies stay small. What one task holds is an entry for each distinct context of its groups' strings. A string that is an anchor in
more than `HOT` contexts (counted over the whole table by a partial aggregation, a context once for each run of RUN_BYTES,
and not at all where the run has no other, so that one context for each run may go uncounted) is dealt more finely:
its windows by ranges of `PIECES`-th of their places around the anchor, each range with the bytes that all its windows share, and
where such a longer string is in more than HOT contexts as well, by whole windows, of which equal ones are one entry. Equal windows
meet at every level. What is hot is sent to the tasks as a bitmap of fixed size; a false hit there deals a string more finely than needed.

Nulls and edges: a null text is empty; texts shorter than LENGTH lose nothing; rows that repeat number and text are copies of each
other; an empty table gives no rows; columns of the input pass through, those named like an added one are replaced.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import ODD_INVERSE, add_columns, arrow_schema, mix, numbered, powers, prefix_sums, small_batches

LENGTH, GRAM = 200, 24
RUN_BYTES, PART_BYTES, CHUNK_BYTES = 12 << 20, 8 << 20, 1 << 20
#: Contexts of one string that a task may hold, the parts that a hotter string's windows are dealt in, bits of the hot strings' bitmap.
HOT, PIECES, HOT_BITS = 20_000, 8, 22
#: Stands for the places of an entry that have been passed on already.
PASSED = [(None, 0, -1)] * 2


def anchors(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end (ends: where each one ends): position, hash, first and last window start of each anchor."""
    n, wide = len(raw) - gram + 1, length - gram + 1
    none = np.zeros(0, np.int64)
    if n < wide:
        return none, none.view(np.uint64), none, none
    s = prefix_sums(raw)
    h = mix((s[gram:] - s[:n]) * powers(ODD_INVERSE, n))
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    # the least key in each window: the least of the end of one block and the start of the next
    full = np.full(-(-n // wide) * wide, 0xFFFFFFFFFFFFFFFF, np.uint64)
    full[:n] = key
    blocks = full.reshape(-1, wide)
    head = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    tail = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    windows = n - wide + 1
    least = np.minimum(tail[:windows], head[wide - 1 : wide - 1 + windows])
    inside = np.zeros(windows + 1, np.int32)  # windows that end in their own text
    begins = np.concatenate(([0], ends[:-1]))
    last = ends - length + 1
    ok = last > begins
    np.add.at(inside, begins[ok], 1)
    np.add.at(inside, last[ok], -1)
    at = np.flatnonzero(np.cumsum(inside[:-1]) > 0)
    place = (least[at] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.diff(place, prepend=-1))
    return place[new], h[place[new]], at[new], at[np.append(new[1:], len(at)) - 1] if len(at) else none


def span_hash(s: np.ndarray, first: np.ndarray, past: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from first to past, by prefix sums of all bytes."""
    return mix((s[past] - s[first]) * powers(ODD_INVERSE, len(s))[first])


Spans = tuple[np.ndarray, np.ndarray, np.ndarray]  # of entries: where what precedes begins, where the suffix does, where it ends


def split(spans: Spans, width: int, length: int) -> tuple[Spans, np.ndarray]:
    """Entries whose windows lie in one range of width places each, beginning at the bytes that a range's windows share; where these end."""
    first, root, past = spans
    near, far = root + length - past, root - first  # how far before the root the last and the first window begin
    n = far // width - near // width + 1
    of = np.repeat(np.arange(len(n)), n)
    low = (np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n) + (near // width)[of]) * width
    at = root[of]
    return (at - np.minimum(low + width - 1, far[of]), at - low, at - np.maximum(low, near[of]) + length), at + length - (low + width - 1)


def is_hot(bitmap: np.ndarray | None, h: np.ndarray) -> np.ndarray:
    if bitmap is None:
        return np.zeros(len(h), bool)
    slot = (h >> np.uint64(64 - HOT_BITS)).astype(np.int64)
    return (bitmap[slot >> 6] >> (slot & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


def entry_spans(raw: np.ndarray, ends: np.ndarray, length: int, gram: int, hot: list[np.ndarray]) -> list[tuple[np.ndarray, Spans]]:
    """Hash and spans of the texts' entries at each level; hot has a bitmap for each level that is known, and levels beyond have no entry."""
    at, h, low, high = anchors(raw, ends, length, gram)
    spans, levels = (low, at, high + length), []
    sums = prefix_sums(raw) if hot else None
    for bitmap, width in zip(hot, (max(1, (length - gram + 1) // PIECES), 1), strict=False):
        finer = is_hot(bitmap, h)
        levels.append((h[~finer], tuple(x[~finer] for x in spans)))
        spans, shared = split(tuple(x[finer] for x in spans), width, length)
        h = span_hash(sums, spans[1], shared)
    return [*levels, (h, spans)]


def grams(length: int, gram: int) -> list[int]:
    """How many first bytes the entries of a group share, at each level."""
    return [gram, length + 1 - max(1, (length - gram + 1) // PIECES), length]


def common_prefix(a: bytes, b: bytes, known: int = 0) -> int:
    """How many first bytes a and b share, of which `known` are known."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


Entry = tuple[bytes, bytes, list]  # suffix, what precedes it, places (doc_id, text hash, position)


def encode_run(entries: list[Entry]) -> bytes:
    """Front-codes entries that are sorted by suffix."""
    shared, last = [], b""
    for suffix, _, _ in entries:
        shared.append(common_prefix(last, suffix))
        last = suffix
    tails = [e[0][k:] for e, k in zip(entries, shared, strict=True)]
    counts = np.array([[k, len(t), len(e[1]), len(e[2])] for k, t, e in zip(shared, tails, entries, strict=True)], "<u4")
    places = np.array([[0 if d is None else d, int(d is None), t, p] for e in entries for d, t, p in e[2]], "<i8").reshape(-1, 4)
    parts = [np.array([len(entries), len(places)], "<u4").tobytes(), counts.T.tobytes(), np.ascontiguousarray(places.T).tobytes(), *tails, *[e[1] for e in entries]]
    return zstandard.ZstdCompressor(level=6).compress(b"".join(parts))


def decode_run(blob: bytes) -> Iterator[tuple[int, bytes, bytes, list]]:
    """Entries in order, each with its common prefix with the one before."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, m = np.frombuffer(raw, "<u4", 2).tolist()
    shared, tails, lefts, each = np.frombuffer(raw, "<u4", 4 * n, 8).reshape(4, n).tolist()
    docs, nulls, hashes, positions = np.frombuffer(raw, "<i8", 4 * m, 8 + 16 * n).reshape(4, m).tolist()
    at = 8 + 16 * n + 32 * m
    left_at = at + sum(tails)
    suffix, k = b"", 0
    for i in range(n):
        suffix = suffix[: shared[i]] + raw[at : at + tails[i]]
        at += tails[i]
        left = raw[left_at : left_at + lefts[i]]
        left_at += lefts[i]
        e = each[i]
        yield shared[i], suffix, left, [(None if nulls[j] else docs[j], hashes[j], positions[j]) for j in range(k, k + e)]
        k += e


def merge_runs(runs: list[Iterator[tuple[int, bytes, bytes, list]]]) -> Iterator[tuple[int, bytes, bytes, list]]:
    """Merges sorted front-coded runs by a loser tree; yields entries in order with their common prefix with the one before."""
    n = len(runs)
    if n == 1:
        yield from runs[0]
        return
    head: list = [next(r, None) for r in runs]
    known = [0 if x else -1 for x in head]  # the common prefix with the last output; -1 when a run has ended
    tree = [-1] * n  # losers; tree[0] is the winner

    def play(c: int, at: int) -> None:
        while at:
            o = tree[at]
            if o < 0:  # still to be filled
                tree[at] = c
                return
            if known[o] > known[c]:
                tree[at], c = c, o
            elif known[o] == known[c] >= 0:
                a, b, k = head[o][1], head[c][1], known[o]
                x = common_prefix(a, b, k)
                if a[x : x + 1] < b[x : x + 1] or (a[x : x + 1] == b[x : x + 1] and o < c):
                    known[c] = x
                    tree[at], c = c, o
                else:
                    known[o] = x
            at >>= 1
        tree[0] = c

    for i in range(n):
        play(i, (i + n) >> 1)
    while known[w := tree[0]] >= 0:
        _, suffix, left, places = head[w]
        yield known[w], suffix, left, places
        head[w] = x = next(runs[w], None)
        known[w] = x[0] if x else -1
        play(w, (w + n) >> 1)


def repeated(group: list[tuple[int, bytes, bytes, list]], length: int) -> Iterator[tuple[list, list[tuple[int, int]]]]:
    """Of a group's distinct entries in order: places, and the runs of repeated windows as (bytes before the anchor, bytes from it on)."""
    reach = [max(group[i][0] if i else 0, group[i + 1][0] if i + 1 < len(group) else 0) for i in range(len(group))]
    entries = [(suffix, left, places, r) for (_, suffix, left, places), r in zip(group, reach, strict=True)]
    back = sorted(range(len(entries)), key=lambda i: entries[i][1][::-1])
    left_reach = [0] * len(entries)
    for i, j in zip(back, back[1:], strict=False):
        x = common_prefix(entries[i][1][::-1], entries[j][1][::-1])
        left_reach[i], left_reach[j] = max(left_reach[i], x), max(left_reach[j], x)
    by_offset: dict[int, list[int]] = defaultdict(list)
    hits: dict[int, list[int]] = defaultdict(list)
    for i, (suffix, left, places, r) in enumerate(entries):
        least = length - len(suffix)
        if len(places) > 1:
            hits[i] = list(range(least, len(left) + 1))
            r = len(suffix)  # all of it is repeated; others may still find it
        for a in range(max(least, length - r), min(left_reach[i], len(left)) + 1):
            by_offset[a].append(i)
    for a, who in by_offset.items():
        if len(who) > 1:
            seen: dict[bytes, list[int]] = defaultdict(list)
            for i in who:
                suffix, left = entries[i][0], entries[i][1]
                seen[left[len(left) - a :] + suffix[: length - a]].append(i)
            for found in seen.values():
                if len(found) > 1:
                    for i in found:
                        if len(entries[i][2]) == 1:
                            hits[i].append(a)
    for i, offsets in hits.items():
        spans: list[tuple[int, int]] = []
        for a in sorted(offsets, reverse=True):  # window starts from left to right
            if spans and -a <= spans[-1][1]:
                spans[-1] = spans[-1][0], length - a
            else:
                spans.append((-a, length - a))
        yield entries[i][2], spans


RUN = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("run", T.BinaryType())])
SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "th", "first", "past")])


def hot_strings(docs: DataFrame, length: int, gram: int, hot: list[np.ndarray]) -> np.ndarray | None:
    """A bitmap of the strings of the level after those of hot that are in more than HOT contexts, or None if there are none."""
    small_batches(docs.sparkSession)

    def counts(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        h, context = (np.concatenate(x) for x in zip(*found, strict=True))
        h, n = np.unique(h[np.unique(context, return_index=True)[1]], return_counts=True)
        h, n = h[n > 1], n[n > 1]
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["h", "n"])

    def find(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        raw = np.frombuffer(b"".join(texts), np.uint8)
        h, (first, _, past) = entry_spans(raw, np.cumsum([len(t) for t in texts]), length, gram, hot)[-1]
        return h, span_hash(prefix_sums(raw), first, past)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, texts, size, total = [], [], 0, 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                raw = text.encode("utf-8") if text else b""
                if len(raw) < length:
                    continue
                texts.append(raw)
                size += len(raw)
                if size >= CHUNK_BYTES:
                    found.append(find(texts))
                    total, size, texts = total + size, 0, []
                    if total >= RUN_BYTES:
                        yield counts(found)
                        total, found = 0, []
        if texts:
            found.append(find(texts))
        if found:
            yield counts(found)

    slot = F.shiftrightunsigned("h", 64 - HOT_BITS)
    many = docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter(F.col("n") > HOT)
    words = many.select((slot / 64).cast("long").alias("word"), F.expr(f"shiftleft(1L, CAST(shiftrightunsigned(h, {64 - HOT_BITS}) & 63 AS INT))").alias("bit"))
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()  # 2**(HOT_BITS - 6) rows at most
    if not rows:
        return None
    out = np.zeros(1 << (HOT_BITS - 6), np.int64)
    out[[r["word"] for r in rows]] = [r["bits"] for r in rows]
    return out.view(np.uint64)


def sorted_runs(docs: DataFrame, parts: int, length: int = LENGTH, gram: int = GRAM, hot: list[np.ndarray] | None = None) -> DataFrame:
    """part, run: front-coded sorted runs of the anchored suffixes of docs (doc_id, th, text); each level has parts of its own."""
    small_batches(docs.sparkSession)
    schema = arrow_schema(RUN)

    def sort(rows: list[tuple]) -> pa.RecordBatch:
        rows.sort()
        out_parts, blobs, i = [], [], 0
        while i < len(rows):
            part, entries = rows[i][0], []
            while i < len(rows) and rows[i][0] == part:
                _, suffix, left, doc, null, th, p = rows[i]
                place = (None if null else doc, th, p)
                if entries and entries[-1][0] == suffix and entries[-1][1] == left:
                    entries[-1][2].append(place)
                else:
                    entries.append((suffix, left, [place]))
                i += 1
            out_parts.append(part)
            blobs.append(encode_run(entries))
        return pa.RecordBatch.from_arrays([pa.array(out_parts, pa.int32()), pa.array(blobs, pa.binary())], schema=schema)

    def find(texts: list[tuple], rows: list[tuple]) -> None:
        joined = b"".join(t for _, _, t in texts)
        ends = np.cumsum([len(t) for _, _, t in texts])
        begin = np.concatenate(([0], ends[:-1]))
        for level, (h, (first, root, past)) in enumerate(entry_spans(np.frombuffer(joined, np.uint8), ends, length, gram, hot or [])):
            doc = np.searchsorted(ends, root, "right")
            part = (h % np.uint64(parts)).astype(np.int64) + level * parts
            for a, p, b, k, d, s in zip(first.tolist(), root.tolist(), past.tolist(), part.tolist(), doc.tolist(), begin[doc].tolist(), strict=True):
                doc_id, th, _ = texts[d]
                rows.append((k, joined[p:b], joined[a:p], doc_id or 0, doc_id is None, th, p - s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        texts: list[tuple] = []
        size = total = 0
        for batch in batches:
            for doc, th, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                raw = text.encode("utf-8") if text else b""
                if len(raw) < length:
                    continue
                texts.append((doc, th, raw))
                size += len(raw)
                if size >= CHUNK_BYTES:
                    find(texts, rows)
                    total, size, texts = total + size, 0, []
                    if total >= RUN_BYTES:
                        yield sort(rows)
                        total, rows = 0, []
        if texts:
            find(texts, rows)
        if rows:
            yield sort(rows)

    return docs.select("doc_id", "th", "text").mapInArrow(run, RUN)


def repeated_spans(runs: DataFrame, parts: int, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """doc_id, th, first, past: bytes that repeated windows cover, from the runs of all suffixes."""
    schema = arrow_schema(SPAN)

    shares = grams(length, gram)

    def merged(blobs: list[bytes], shared: int) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        group: list[list] = []
        same: dict[bytes, list] = {}  # the entries of the last suffix, by what precedes

        def end() -> None:
            if len(group) > 1:
                for places, spans in repeated(group, length):
                    out.extend((d, t, p + a, p + b) for d, t, p in places if p >= 0 for a, b in spans)
            group.clear()

        for known, suffix, left, places in merge_runs([decode_run(b) for b in blobs]):
            if known < shared:
                end()
            if group and known == len(suffix) == len(group[-1][1]):
                entry = same.get(left)
            else:
                same, entry = {}, None
            if entry is None:
                entry = same[left] = [known, suffix, left, []]
                group.append(entry)
            entry[3] = entry[3] + places
            if len(entry[3]) > 1:  # all its windows are repeated
                out.extend((d, t, p - len(left), p + len(suffix)) for d, t, p in entry[3] if p >= 0)
                entry[3] = PASSED
            if len(out) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)
                out.clear()
        end()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, blobs = None, []
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now and blobs:
                    yield from merged(blobs, shares[now // parts])
                    blobs = []
                now = part
                blobs.append(blob)
        if blobs:
            yield from merged(blobs, shares[now // parts])

    return runs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, SPAN)


ADDED = [T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()), T.StructField("kept", T.BinaryType())]


def cut(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """The bytes outside the spans, and the number of maximal runs that go."""
    kept, at, runs = [], 0, 0
    last = -1
    for first, past in sorted(spans):
        if first > last:
            runs += 1
            kept.append(text[max(at, 0) : first])
        last = max(last, past)
        at = last
    kept.append(text[at:])
    return b"".join(kept), runs


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, part_bytes: int = PART_BYTES) -> DataFrame:
    """docs (doc_id, text) with n_bytes, n_removed, n_spans and kept, the remaining bytes."""
    spark = docs.sparkSession
    added = {f.name for f in ADDED}
    rows, named, back = numbered(docs.drop(*[c for c in docs.columns if c.lower() in added]))
    own = rows.withColumns({"_doc": F.col(named["doc_id"]).cast("long"), "_th": F.xxhash64(named["text"])})
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // part_bytes))
    texts = own.select(F.col("_doc").alias("doc_id"), F.col("_th").alias("th"), F.col(named["text"]).alias("text"))
    hot: list[np.ndarray] = []
    while len(hot) < 2 and (more := hot_strings(texts, length, gram, hot)) is not None:
        hot.append(more)
    runs = sorted_runs(texts, parts, length, gram, hot)
    spans = repeated_spans(runs, parts, length, gram)
    spans = spans.groupBy(F.col("doc_id").alias("_d"), F.col("th").alias("_t")).agg(F.collect_list(F.struct("first", "past")).alias("_spans"))
    joined = own.join(spans, F.col("_doc").eqNullSafe(F.col("_d")) & (F.col("_th") == F.col("_t")), "left").drop("_d", "_t", "_doc", "_th")

    def step(rows, texts):
        out: dict[str, list] = {f.name: [] for f in ADDED}
        for text, found in zip(texts, rows.column("_spans").to_pylist(), strict=True):
            kept, n = cut(text, [(s["first"], s["past"]) for s in found or ()])
            for c, v in zip(out, (len(text), len(text) - len(kept), n, kept), strict=True):
                out[c].append(v)
        return out

    return add_columns(joined, named["text"], ADDED, step).select(*back, *[f.name for f in ADDED])
