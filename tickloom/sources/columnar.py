"""Compact columnar JSON: rows as JSON lists in part files, and a manifest that says what they are.

A list of rows grows with the data, so it lies in as many parts as Spark writes; the manifest is written last and names the columns,
their types and the number of rows. A folder without a manifest is an export that was cut short.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = 1


class NotWhole(ValueError):
    """An export without a manifest, or with other rows than it says."""


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def cells(df: DataFrame) -> DataFrame:
    """Each row as a JSON list of its columns, in order; a missing value is null, dates are ISO texts."""
    one = lambda f: F.coalesce(F.regexp_extract(F.to_json(F.array(F.col(f.name).cast("string") if isinstance(f.dataType, T.DateType | T.TimestampType | T.TimestampNTZType) else F.col(f.name)), {"ignoreNullFields": "false"}), r"(?s)^\[(.*)\]$", 1), F.lit("null"))
    return df.select(F.concat(F.lit("["), F.concat_ws(",", *[one(f) for f in df.schema]), F.lit("]")).alias("value"))


def write(df: DataFrame, folder: str, kind: str, **head) -> dict:
    """Writes the rows and the manifest (kind, count, columns and what `head` says); returns the manifest."""
    spark = df.sparkSession
    cells(df).write.mode("errorifexists").text(f"{folder}/rows")
    manifest = {"schema": SCHEMA, "kind": kind, **head, "count": spark.read.text(f"{folder}/rows").count(), "columns": df.columns, "types": [f.dataType.simpleString() for f in df.schema]}
    path, fs = _fs(spark, f"{folder}/manifest.json")
    out = fs.create(path, False)
    try:
        out.write(bytearray(json.dumps(manifest, ensure_ascii=False, separators=(",", ":")).encode()))
    finally:
        out.close()
    return manifest


def manifest(spark: SparkSession, folder: str) -> dict:
    path, fs = _fs(spark, f"{folder}/manifest.json")
    if not fs.exists(path):
        raise NotWhole(f"{folder} has no manifest")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def read(spark: SparkSession, folder: str, check: bool = True) -> DataFrame:
    """The rows of an export with their types; fails where their number isn't the manifest's, unless check is false."""
    m = manifest(spark, folder)
    lines = spark.read.text(f"{folder}/rows")
    if check and lines.count() != m["count"]:
        raise NotWhole(f"{folder} has other rows than the {m['count']} of its manifest")
    # A list's members have types of their own, so they come as JSON texts first: from_json leaves numbers as they were written.
    members = F.from_json("value", "ARRAY<STRING>")
    return lines.select(members.alias("r")).select(*[F.col("r")[i].cast(t).alias(n) for i, (n, t) in enumerate(zip(m["columns"], m["types"], strict=True))])
