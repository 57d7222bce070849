"""Helpers that the corpus operators share: shared-folder tables, Arrow batches, hashing of bytes and words."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that one step of a Python worker handles at a time; a longer text is a step of its own.
STEP_BYTES = 1 << 20
#: Rows in an Arrow batch. Spark's default of 10,000 whole documents is too many for a small worker.
BATCH_ROWS = 500

_own_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where it is unset and all run on one machine (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    app = spark.sparkContext.applicationId
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = _own_dirs.setdefault(app, "file://" + tempfile.mkdtemp(prefix="tickloom-"))
    return f"{base.rstrip('/')}/tickloom-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str, parts: int | None = None) -> tuple[DataFrame, str]:
    """Writes df as Parquet in the shared folder, which cuts its lineage, and returns the table and its path.

    parts: the most tasks and files to write it with, for a table that is known to be small. What only the written plan used is
    then garbage; collecting it lets Spark delete its shuffle files now and not at some later time.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    (df.coalesce(parts) if parts else df).write.option("compression", "zstd").parquet(path)
    schema = df.schema
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a table that keep() wrote, on whatever file system it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Lowers the session's Arrow batch to rows, unless the user has lowered it further."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def steps(sizes: list[int], limit: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges [a, b) of rows of about limit bytes together, one row at least."""
    a = total = 0
    for i, n in enumerate(sizes):
        if i > a and total + n > limit:
            yield a, i
            a, total = i, 0
        total += n
    if len(sizes) > a:
        yield a, len(sizes)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def map_texts(df: DataFrame, text: str, schema: T.StructType, step: Callable[[pa.RecordBatch, list[bytes]], dict | None], limit: int = STEP_BYTES) -> DataFrame:
    """mapInArrow over df in steps of bounded text: step(rows, texts as UTF-8, null as empty) returns columns by name."""
    small_batches(df.sparkSession)
    out = arrow_schema(schema)

    def run(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            texts = [x.encode("utf-8") if isinstance(x, str) else x or b"" for x in column.to_pylist()]
            for a, b in steps([len(x) for x in texts], limit):
                got = step(batch.slice(a, b - a), texts[a:b])
                if got is not None:
                    yield pa.RecordBatch.from_arrays([x if isinstance(x := got[f.name], pa.Array) and x.type == f.type else pa.array(x, f.type) for f in out], schema=out)

    return df.mapInArrow(run, schema)


def add_columns(df: DataFrame, text: str, added: list[T.StructField], step: Callable[[pa.RecordBatch, list[bytes]], dict], limit: int = STEP_BYTES) -> DataFrame:
    """df with columns added by map_texts; a column of df that has the name of an added one is replaced."""
    names = {f.name.lower() for f in added}
    passed = [f for f in df.schema.fields if f.name.lower() not in names]
    schema = T.StructType([*(T.StructField(f.name, f.dataType, True) for f in passed), *added])

    def both(rows, texts):
        return {f.name: rows.column(rows.schema.get_field_index(f.name)) for f in passed} | step(rows, texts)

    return map_texts(df, text, schema, both, limit)


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """df with its columns named d0, d1 ..., which no other name clashes with; the new name of each old one in lower case; and the way back."""
    inner = [f"d{i}" for i in range(len(df.columns))]
    return df.toDF(*inner), {n.lower(): d for n, d in zip(df.columns, inner, strict=True)}, [F.col(d).alias(n) for n, d in zip(df.columns, inner, strict=True)]


LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: True for the bytes 32 and 9 to 13.
SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
MASK = (1 << 64) - 1
ODD = 0x9E3779B97F4A7C13
ODD_INVERSE = pow(ODD, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of unsigned 64-bit numbers that spreads every bit (splitmix64's finisher)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**i mod 2**64 for i below n, kept up to 2**21 of them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(16, (n - 1).bit_length()), base, np.uint64)
        have[0] = 1
        np.cumprod(have, out=have)
        if len(have) <= 1 << 21:
            _powers[base] = have
    return have[:n]


def prefix_sums(raw: np.ndarray) -> np.ndarray:
    """s[i]: sum of value(raw[j]) * ODD**j for j below i. (s[b] - s[a]) * ODD**-a depends on the bytes a to b alone."""
    s = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[raw] * powers(ODD, len(raw)), out=s[1:])
    return s


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs without SPACE) of texts, lower-cased unless told not to, in order, and where each text's words begin (one more at the end)."""
    joined = b" ".join(texts) + b" "
    raw = np.frombuffer(joined.translate(LOWER) if lower else joined, np.uint8)
    blank = SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    s = prefix_sums(raw)
    h = mix((s[ends] - s[starts]) * powers(ODD_INVERSE, len(raw))[starts] + (ends - starts).astype(np.uint64))
    at = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=at[1:])
    return h, np.searchsorted(starts, at)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """Each text's set of hashed word shingles, sorted: distinct runs of width words; fewer words make one shingle, none an empty set."""
    h, at = word_hashes(texts)
    n = len(h)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width):
        rolled = rolled * np.uint64(ODD) + h[j : n - width + 1 + j] if n >= width else rolled
    rolled = mix(rolled)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= width:
            yield np.unique(rolled[a : b - width + 1])
        elif b > a:
            x = b - a
            for w in h[a:b].tolist():
                x = (x * ODD + w) & MASK
            yield mix(np.array([x ^ 0x5851F42D4C957F2D], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
