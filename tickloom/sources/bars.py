"""Daily and hourly bars, universe and benchmark derived from the order and event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import by_symbol, half_up


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def daily_bars(lines: DataFrame) -> DataFrame:
    """Bars of unit prices: open and close by the order of the lines, high, low, volume, trades, delivered quantity."""
    px = F.col("l_extendedprice") / F.col("l_quantity")
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return (
        lines.select(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date"), px.alias("px"), "l_quantity", "l_returnflag", order.alias("o"))
        .groupBy("symbol", "date")
        .agg(
            F.min_by("px", "o").alias("open"), F.max("px").alias("high"), F.min("px").alias("low"), F.max_by("px", "o").alias("close"), F.sum("l_quantity").alias("volume"),
            F.count("*").cast("double").alias("trades"), F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0.0)).alias("deliv_qty"),
        )
    )


def walk_bars(lines: DataFrame) -> DataFrame:
    """Bars of a price path in ticks of 0.01: each day's log return is the mean discount less 0.05.

    symbol, date, open, high, low, close, volume, deliv_qty, trades, and t, the bar's number from 0.
    """
    # One exchange, by symbol, serves the days' groups and every window after them.
    day = lines.repartition("l_suppkey").groupBy(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("date")).agg(
        F.round(F.avg("l_discount") - 0.05, 8).alias("r"), F.round(F.avg("l_tax"), 8).alias("tax"), F.sum("l_quantity").alias("volume"), F.count("*").cast("double").alias("trades"),
        F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0.0)).alias("deliv_qty"),
    )
    sofar = by_symbol().rowsBetween(Window.unboundedPreceding, 0)
    day = day.withColumn("close", F.round(100 * F.exp(F.sum("r").over(sofar)), 2))
    day = day.withColumn("open", F.coalesce(F.lag("close").over(by_symbol()), "close"))
    return day.select(
        "symbol", "date", "open", half_up(F.greatest("open", "close") * (1 + F.col("tax") / 10), 2).alias("high"),
        half_up(F.least("open", "close") * (1 - F.col("tax") / 10), 2).alias("low"), "close", "volume", "deliv_qty", "trades",
        (F.row_number().over(by_symbol()) - 1).alias("t"),
    )


def walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return walk_bars(table(spark, sf_dir, "lineitem"))


def hourly_bars(events: DataFrame) -> DataFrame:
    """symbol (event type), hour, open, high, low, close and volume (events) of each hour."""
    order = F.struct("ts", "event_id")
    return events.groupBy(F.col("event_type").alias("symbol"), F.date_trunc("hour", F.col("ts")).alias("hour")).agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("volume")
    )


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """symbol, company, industry of each symbol; a symbol without industry is OTHER."""
    s, n = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    return s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey, "left").select(F.col("s_suppkey").alias("symbol"), F.col("s_name").alias("company"), F.coalesce("n_name", F.lit("OTHER")).alias("industry"))


def benchmark(bars: DataFrame) -> DataFrame:
    """date, bench: the mean close of the day over all symbols, from the sum in ticks, which no order of addition changes; a row a session."""
    ticks = F.sum(F.round(F.col("close") * 100).cast("long"))
    return bars.groupBy("date").agg(half_up(ticks / F.count("*") / 100, 4).alias("bench"))


#: The same tables in SQL, as the start of a query.
BARS_SQL = """
WITH RECURSIVE d AS (
    SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS date, round(avg(l_discount) - 0.05, 8) AS r, round(avg(l_tax), 8) AS tax, sum(l_quantity) AS volume,
        count(*)::DOUBLE AS trades, sum(CASE WHEN l_returnflag = 'N' THEN l_quantity ELSE 0.0 END) AS deliv_qty
    FROM lineitem GROUP BY 1, 2
),
p AS (SELECT *, round(100 * exp(sum(r) OVER (PARTITION BY symbol ORDER BY date)), 2) AS close FROM d),
q AS (SELECT *, coalesce(lag(close) OVER (PARTITION BY symbol ORDER BY date), close) AS open FROM p),
b AS MATERIALIZED (
    SELECT symbol, date, open, floor(greatest(open, close) * (1 + tax / 10) * 1e2 + 0.5) / 1e2 AS high, floor(least(open, close) * (1 - tax / 10) * 1e2 + 0.5) / 1e2 AS low, close, volume,
        deliv_qty, trades, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS t
    FROM q
),
u AS (SELECT s_suppkey AS symbol, s_name AS company, coalesce(n_name, 'OTHER') AS industry FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey),
m AS (SELECT date, floor(sum(round(close * 100)::BIGINT) / count(*) / 100 * 1e4 + 0.5) / 1e4 AS bench FROM b GROUP BY date)
"""
