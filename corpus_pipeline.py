"""The corpus pipeline: quality, line dedup, near-dedup, source mixing, packing, one stage after the other over documents.

Each stage is a function of (spark, docs, sf_dir) and returns a DataFrame; run() writes each one's result as Parquet in the shared
folder and reads it again as the next one's docs, so a lost executor costs a stage's tasks and never an earlier stage. All but
the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import line_dedup, minhash, mixing, packing, quality
from tickloom.llm.common import keep

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Words of a shingle in the near-duplicate stage.
WIDTH = 5


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject; its labels are the table beside documents."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.classify(docs, labels).filter("predicted = 1").select(*COLUMNS)


def without_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them share; n_chars is counted anew."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest number, of each group of near duplicates."""
    return minhash.keep_one(docs, WIDTH).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources again until the weights are met, twice at most."""
    return mixing.mix(docs).select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token pieces, packed."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", good_documents),
    ("line dedup", without_common_lines),
    ("minhash near-dedup", one_of_each_group),
    ("source mixing", mixed_sources),
    ("best-fit packing", packed),
]
#: SQL can express neither the classifier nor the packing; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline's result over documents of sf_dir."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs, _ = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
