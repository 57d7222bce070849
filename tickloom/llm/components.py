"""Connected components of a link table by alternating large and small stars.

A large star links every larger neighbour of a node to the smallest node in reach of one step, a small star does the same with the
smaller neighbours; both keep what is connected and never add links. Rounds go on until all links are stars, a logarithmic number in
practice; each round's links are kept as a table in the shared folder. Links that are stars already need no round. The smallest neighbour is a partial aggregation, and the
join back can be split where a node has very many links (AQE's skew join), so no group meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import keep, remove


def connected_components(links: DataFrame, parts: int | None = None) -> DataFrame:
    """id, component (the smallest id in reach) of every id in links (src, dst); links to itself and null ends don't count.

    parts: the most files of a round's table, for links that are known to be few.
    """
    spark = links.sparkSession
    links = links.filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v"))
    now, path = keep(links.distinct(), "links", parts)
    while not _stars(now):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        new, new_path = keep(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links", parts)
        remove(spark, path)
        now, path = new, new_path
    roots = now.select("v").distinct()
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots.select(F.col("v").alias("id"), F.col("v").alias("component")))


def _stars(links: DataFrame) -> bool:
    """Whether each node has one smaller neighbour at most, which has none: then the links are the components."""
    ends = links.groupBy("u").agg(F.count("*").alias("n")).select(F.col("u").alias("x"), "n").unionByName(links.select(F.col("v").alias("x"), F.lit(1 << 40).alias("n")).distinct())
    return ends.groupBy("x").agg(F.sum("n").alias("n")).filter(f"n > 1 AND n <> {1 << 40}").isEmpty()
