"""Best-fit packing of token sequences (operator 9).

Method: best fit by classes. Documents are tokenised where they lie and cut into pieces of at most `capacity` ids;
only (document, piece, length, checksum) rows are shuffled. The driver sweeps over the classes of lengths, longest first, one after
another; nothing is range-sorted and no sweep is distributed. Pieces of one length are interchangeable, and so are sequences with one gap, so a sweep treats a whole class
of pieces and a whole class of gaps in one step: every piece of the class asks for the smallest gap that holds it (its
successor in gap order), a gap that more pieces ask for than it has sequences goes to the lowest ranks, the gaps that were
taken shrink, and the sweep repeats with the rest until the class is placed or opens new sequences. There are at most
`capacity` classes on either side however large the corpus is, so the state of the sweeps is the length histogram; the
ranks within the classes and the placement of every piece are distributed (no piece passes through the driver).

Nulls and edges: a null or empty text is the closing id alone; a null doc_id is a document like any other; repeated rows are
packed each; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import arrow_schema, keep, small_batches, steps

CAPACITY = 2048
#: Rows of one length that are ranked together at most, on average.
RANK_ROWS = 50_000
#: Parts of words kept by a worker, about 50 MB; a fuller cache starts anew.
CACHE_PARTS = 300_000
#: Bytes of text that a worker tokenises at a time, and words whose ids it gathers at a time.
TOKEN_STEP, GATHER_WORDS = 2 << 20, 1 << 18
#: Letters that the tokenizer keeps together and lower-cases one by one. A capital I with a dot isn't: it becomes two characters.
LETTERS = "^[A-Za-zÀ-ÖØ-öø-įı-ɏ]+$"
#: Marks that the tokenizer splits off a word's end as one run.
MARKS = '!"#$%&()*+,-./:;=>?@[\\]^_`{|}~'


class WordIds:
    """Token ids of texts from a cache of parts of words: runs of letters, runs of marks after them, and words of any other kind.

    The tokenizer must split at blanks and line feeds and drop them, split between letters and marks, and lower-case, as
    word_bpe_49k does; its ids of a text are then the ids of the text's parts one after another. Words are told apart in Arrow
    and ids are gathered in numpy, so only distinct words of a step pass through Python.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.slots: dict[str, int] = {"": 0}
        self.ids: list[np.ndarray] = [np.zeros(0, "<u4")]
        self.lengths: list[np.ndarray] = [np.zeros(1, np.int64)]

    def _add(self, names: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        first = len(self.slots)
        self.slots.update(zip(names, range(first, first + len(names)), strict=True))
        self.ids.append(ids)
        self.lengths.append(lengths)

    def _learn(self, runs: list[str], whole: list[str]) -> None:
        """Ids of runs (of letters or of marks, one pre-token each) and of whole words, none known yet."""
        if runs:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(runs)], add_special_tokens=False)[0].ids, "<u4")
            ends = np.flatnonzero(self.ends[ids]) + 1  # a run's last token, and no other, has the mark of a word's end
            if len(ends) == len(runs) and ends[-1] == len(ids):
                self._add(runs, ids, np.diff(ends, prepend=0))
            else:
                whole = whole + runs
        if whole:
            each = [x.ids for x in self.tokenizer.encode_batch(whole, add_special_tokens=False)]
            self._add(whole, np.array([i for ids in each for i in ids], "<u4"), np.array([len(ids) for ids in each], np.int64))

    def _parts(self, words: pa.Array) -> np.ndarray:
        """Slots of each distinct word's two parts; the second is empty for most."""
        base = pc.utf8_rtrim(words, characters=MARKS)
        plain = pc.match_substring_regex(base, LETTERS)
        heads = pc.if_else(plain, pc.utf8_lower(base), words).dictionary_encode()
        tails = pc.if_else(plain, pc.replace_substring_regex(words, LETTERS.strip("$"), ""), "").dictionary_encode()
        simple = pc.match_substring_regex(heads.dictionary, LETTERS).to_numpy(zero_copy_only=False).tolist()
        names, marks = (x.dictionary.to_numpy(zero_copy_only=False).tolist() for x in (heads, tails))
        if len(self.slots) + len(names) + len(marks) > CACHE_PARTS:
            self._clear()
        slots = self.slots
        new = [m for m in marks if m not in slots]
        new += [x for x, p in zip(names, simple, strict=True) if p and x not in slots]
        own = set(new)
        self._learn(new, [x for x, p in zip(names, simple, strict=True) if not p and x not in slots and x not in own])
        at = [np.fromiter(map(slots.__getitem__, x), np.int64, len(x))[c.indices.to_numpy()] for x, c in ((names, heads), (marks, tails))]
        return np.stack(at, 1)

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text (none null), as little-endian 32-bit numbers."""
        lists = pc.split_pattern(pc.replace_substring(texts, pattern="\n", replacement=" "), " ")
        coded = lists.flatten().dictionary_encode()
        parts = self._parts(coded.dictionary)
        self.ids, self.lengths = [np.concatenate(self.ids)], [np.concatenate(self.lengths)]
        ids, lengths = self.ids[0], self.lengths[0]
        starts = np.cumsum(lengths) - lengths
        index, ends = coded.indices.to_numpy(), np.cumsum(pc.list_value_length(lists).to_numpy())
        sums, out = np.zeros(len(index) + 1, np.int64), []
        np.cumsum(lengths[parts].sum(1)[index], out=sums[1:])
        for a in range(0, len(index), GATHER_WORDS):
            slots = parts[index[a : a + GATHER_WORDS]].ravel()
            n = lengths[slots]
            out.append(ids[np.repeat(starts[slots] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        flat = np.concatenate(out) if out else ids[:0]
        return np.split(flat, sums[ends[:-1]]) if len(ends) else []


_tokenizers: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    if path not in _tokenizers:
        _tokenizers[path] = WordIds(path)
    return _tokenizers[path]


PIECES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("ids", T.BinaryType())])


def pieces(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Token pieces of documents (doc_id, text): piece from 0, start, length, ids_crc32, and ids if asked for.

    tokenizer_path None: word_bpe_49k of public_tokenizers. A document's ids end with id 0.
    """
    fields = PIECES.fields if with_ids else PIECES.fields[:-1]
    small_batches(docs.sparkSession)
    schema = arrow_schema(T.StructType(fields))

    def cut(doc_ids: list, all_ids: list[np.ndarray]) -> pa.RecordBatch:
        out: dict[str, list] = {f.name: [] for f in fields}
        for doc, ids in zip(doc_ids, all_ids, strict=True):
            raw = ids.tobytes() + b"\0\0\0\0"
            for k, a in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[a : a + 4 * capacity]
                row = (doc, k, a // 4, len(part) // 4, zlib.crc32(part), part)
                for name, value in zip(out, row, strict=False):
                    out[name].append(value)
        return pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer_path
        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("word_bpe_49k.json")
        for batch in batches:
            texts = batch.column(1).fill_null("")
            for a, b in steps(pc.binary_length(texts).to_pylist(), TOKEN_STEP):
                yield cut(batch.column(0).slice(a, b - a).to_pylist(), word_ids(path)(texts.slice(a, b - a)))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, T.StructType(fields))


def sweeps(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Best fit over classes: rows (length, first rank, number, first sequence, offset), and the number of sequences.

    Pieces of ranks first to first + number - 1 of that length go to the sequences from first sequence on, at offset.
    """
    plan: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap: runs (first sequence, number)
    order: list[int] = []
    total = 0

    def put(gap: int, first: int, n: int) -> None:
        if gap:
            if gap not in gaps:
                gaps[gap] = []
                bisect.insort(order, gap)
            gaps[gap].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            k = bisect.bisect_left(order, length)  # the successor: the smallest gap that holds the class
            if k < len(order):
                gap = order[k]
                first, n = gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap], order[k]
                take = min(n, left)  # by rank: the lowest ranks win
                if take < n:
                    put(gap, first + take, n - take)
            else:
                gap, first = capacity, total
                take = max(1, -(-left // (capacity // length)))
                total += take
            plan.append((length, rank, take, first, capacity - gap))
            put(gap - length, first, take)
            rank, left = rank + take, left - take
    return plan, total


def pack(lengths: DataFrame, capacity: int = CAPACITY, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Adds sequence_id and offset to rows with a `length` of 1 to capacity; order names columns that tell rows apart."""
    spark: SparkSession = lengths.sparkSession
    lengths, _ = keep(lengths, "pieces")
    n = lengths.count()
    salts = max(16, n // RANK_ROWS)
    salted = lengths.withColumn("_salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    parts = salted.groupBy("length", "_salt").count()
    before = parts.select("length", "_salt", (F.sum("count").over(Window.partitionBy("length").orderBy("_salt")) - F.col("count")).alias("_before"))
    counts = {int(r["length"]): int(r["count"]) for r in lengths.groupBy("length").count().collect()}  # at most `capacity` rows
    plan, _ = sweeps(counts, capacity)
    ranked = salted.withColumn("_n", F.row_number().over(Window.partitionBy("length", "_salt").orderBy(*order)) - 1).join(before, ["length", "_salt"]).withColumn("_rank", F.col("_before") + F.col("_n"))
    by_length: dict[int, tuple[list[int], list[int], list[int]]] = {}
    for length, rank, _take, first, offset in plan:
        ranks, firsts, offsets = by_length.setdefault(length, ([], [], []))
        ranks.append(rank)
        firsts.append(first)
        offsets.append(offset)
    # the plan: one row a length, bounded by capacity
    rows = [(k, *v) for k, v in by_length.items()]
    plan_df = spark.createDataFrame(rows, "length long, _ranks array<long>, _firsts array<long>, _offsets array<long>")
    k = F.expr("aggregate(_ranks, 0, (n, r) -> n + if(r <= _rank, 1, 0))") - 1
    placed = ranked.join(F.broadcast(plan_df), "length").withColumn("_k", k)
    get = lambda c: F.element_at(c, F.col("_k") + 1)
    return placed.withColumn("sequence_id", get("_firsts") + F.col("_rank") - get("_ranks")).withColumn("offset", get("_offsets")).select(*[c for c in lengths.columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of documents (doc_id, text)."""
    return pack(pieces(docs, tokenizer_path, capacity), capacity)


def sequences(docs: DataFrame, tokenizer_path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The packed sequences: sequence_id, length, ids (little-endian 32-bit numbers in order of offset)."""
    packed = pack(pieces(docs, tokenizer_path, capacity, with_ids=True), capacity)
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select("sequence_id", "length", F.expr("aggregate(parts, cast('' as binary), (a, p) -> concat(a, p.ids))").alias("ids"))
