"""Readers of other formats than exchange files: JSON documents, static CSV tables, SQLite databases and pickled frames.

SQLite and pickle files come as a table of (path, content), as Spark's binaryFile source gives them from any file system; a file is a
unit of work that one task reads in batches, so many files are read at once and no path need be local to an executor.
"""

from __future__ import annotations

import io
import pickle
import sqlite3
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows that a reader of a database holds at once.
BATCH = 20_000
#: What a pickled frame of numbers, texts and dates names; a pickle that names anything else is refused.
FRAME_PARTS = frozenset({
    ("__builtin__", "slice"), ("builtins", "slice"), ("_codecs", "encode"), ("numpy", "dtype"), ("numpy", "ndarray"), ("numpy._core.multiarray", "_reconstruct"), ("numpy.core.multiarray", "_reconstruct"),
    ("numpy._core.numeric", "_frombuffer"), ("numpy.core.numeric", "_frombuffer"), ("numpy._core.multiarray", "scalar"), ("numpy.core.multiarray", "scalar"),
    ("pandas._libs.arrays", "__pyx_unpickle_NDArrayBacked"), ("pandas._libs.internals", "_unpickle_block"), ("pandas.core.arrays.datetimes", "DatetimeArray"), ("pandas.core.frame", "DataFrame"),
    ("pandas.core.indexes.base", "Index"), ("pandas.core.indexes.base", "_new_Index"), ("pandas.core.indexes.datetimes", "DatetimeIndex"), ("pandas.core.indexes.datetimes", "_new_DatetimeIndex"),
    ("pandas.core.internals.managers", "BlockManager"), ("pandas._libs.tslibs.offsets", "Day"), ("pandas._libs.tslibs.offsets", "BusinessDay"),
})


class WrongFile(ValueError):
    """A file isn't what its reader was told."""


def files(spark: SparkSession, path: str) -> DataFrame:
    """path and content of each file of a folder or glob; a file over 2 GB is an error of the source."""
    return spark.read.format("binaryFile").load(path).select("path", "content")


def read_static(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV table whose header must name the schema's columns in order; a value that isn't of its type fails the read."""
    return spark.read.csv(path, schema=schema, header=True, enforceSchema=False, mode="FAILFAST")


def json_objects(documents: DataFrame, schema: str, key: str = "key") -> DataFrame:
    """A row for each member of JSON objects: key and the fields of its object. documents: a whole JSON object in `value`.

    A document that isn't an object of objects fails the read; null documents and empty objects have no rows.
    """
    parsed = F.from_json("value", f"MAP<STRING, STRUCT<{schema}>>", {"mode": "FAILFAST"})
    return documents.select(F.explode(parsed).alias(key, "_o")).select(key, "_o.*")


def read_json_objects(spark: SparkSession, path: str, schema: str, key: str = "key") -> DataFrame:
    """json_objects of whole files."""
    return json_objects(spark.read.text(path, wholetext=True), schema, key)


def sqlite_rows(content: DataFrame, query: str, schema: str) -> DataFrame:
    """The rows of a query in each database file (path, content), with the schema's columns in the query's order; the first null content is an error.

    A file is opened from memory and read in batches of BATCH rows; dates and timestamps are stored as ISO texts.
    """
    fields = T.StructType.fromDDL(schema)
    arrow = pa.schema([pa.field(f.name, pa.string()) if isinstance(f.dataType, T.DateType | T.TimestampType) else pa.field(f.name, _arrow(f.dataType)) for f in fields])
    raw = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, T.DateType | T.TimestampType) else f.dataType) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, data in zip(b.column("path").to_pylist(), b.column("content").to_pylist(), strict=True):
                if data is None or not data.startswith(b"SQLite format 3\0"):
                    raise WrongFile(f"{path} isn't a database")
                db = sqlite3.connect(":memory:")
                try:
                    db.deserialize(data)
                    cursor = db.execute(query)
                    if len(cursor.description) != len(arrow):
                        raise WrongFile(f"{path}: {len(cursor.description)} columns; wanted {len(arrow)}")
                    while rows := cursor.fetchmany(BATCH):
                        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)
                finally:
                    db.close()

    got = content.select("path", "content").mapInArrow(run, raw)
    return got.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])


def _arrow(t: T.DataType) -> pa.DataType:
    kinds = {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(), T.StringType: pa.string(), T.BinaryType: pa.binary()}
    if type(t) not in kinds:
        raise ValueError(f"{t.simpleString()} isn't a type of a database's column")
    return kinds[type(t)]


def sqlite_files(rows: DataFrame, table: str, by: str) -> DataFrame:
    """path and content of a database for each value of `by`, with a table of its rows: a group must fit in a task's memory."""
    names = [f.name for f in rows.schema if f.name != by]

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        db = sqlite3.connect(":memory:")
        try:
            db.execute(f"CREATE TABLE {table} ({', '.join(names)})")
            cell = lambda v: None if pd.isna(v) else v.isoformat() if hasattr(v, "isoformat") else v.item() if hasattr(v, "item") else v
            db.executemany(f"INSERT INTO {table} VALUES ({', '.join('?' * len(names))})", ([cell(v) for v in row] for row in pdf[names].itertuples(index=False, name=None)))
            db.commit()
            return pd.DataFrame({"path": [f"{pdf[by].iloc[0]}.db"], "content": [bytes(db.serialize())]})
        finally:
            db.close()

    return rows.groupBy(by).applyInPandas(run, "path string, content binary")


class _FrameUnpickler(pickle.Unpickler):
    """Loads frames and arrays only."""

    def find_class(self, module: str, name: str):
        if (module, name) not in FRAME_PARTS:
            raise WrongFile(f"{module}.{name} isn't part of a frame")
        return super().find_class(module, name)


def pickled_frames(content: DataFrame, schema: str, key: str = "symbol") -> DataFrame:
    """The rows of pickled dicts of frames by key (path, content), as one store: of a key that several parts hold, the part with the last name wins whole.

    The index of a frame is its date. The pickles are read one key at a time and may hold frames and arrays only.
    """
    fields = T.StructType.fromDDL(schema)
    out = T.StructType([T.StructField("_part", T.StringType()), *fields])
    names = [f.name for f in fields]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for path, data in zip(pdf["path"], pdf["content"], strict=True):
                if data is None:
                    raise WrongFile(f"{path} is empty")
                parts = _FrameUnpickler(io.BytesIO(data)).load()
                if not isinstance(parts, dict):
                    raise WrongFile(f"{path} isn't a dict of frames")
                for k, frame in parts.items():
                    frame = frame.rename_axis("date").reset_index()
                    yield frame.assign(**{"date": pd.to_datetime(frame["date"]).dt.date, key: k, "_part": path}).reindex(columns=["_part", *names])

    got = content.select("path", "content").mapInPandas(run, out)
    last = F.max("_part").over(Window.partitionBy(key))
    return got.withColumn("_last", last).filter("_part = _last").drop("_part", "_last")


def pickle_files(rows: DataFrame, by: str, key: str = "symbol") -> DataFrame:
    """path and content of a pickled dict of frames by key for each value of `by`, dates as the index: a group must fit in a task's memory."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        store = {k: g.drop(columns=[key, by]).assign(date=pd.to_datetime(g["date"])).set_index("date").sort_index() for k, g in pdf.groupby(key)}
        return pd.DataFrame({"path": [f"prices_part{pdf[by].iloc[0]}.pkl"], "content": [pickle.dumps(store)]})

    return rows.groupBy(by).applyInPandas(run, "path string, content binary")
