"""Parsers of exchange files: lines of text, wherever they were read from, to typed rows.

Files come in by spark.read.text or spark.read.csv; a parser takes the table of lines (value), so gzip, folders and globs are the reader's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The columns of a daily price file, and the names of the indices that are kept.
BHAV = ["SYMBOL", "SERIES", "DATE1", "PREV_CLOSE", "OPEN_PRICE", "HIGH_PRICE", "LOW_PRICE", "LAST_PRICE", "CLOSE_PRICE", "AVG_PRICE", "TTL_TRD_QNTY", "TURNOVER_LACS", "NO_OF_TRADES", "DELIV_QTY", "DELIV_PER"]
SERIES = ["EQ", "BE", "BZ"]
INDICES = {"nifty 50": "NIFTY50", "nifty 500": "NIFTY500", "nifty midcap 150": "MIDCAP150", "nifty smallcap 250": "SMALLCAP250", "nifty next 50": "NEXT50"}
HISTORY_START = "2016-06-01"


def number(x: Column) -> Column:
    """A number with thousands commas, null for anything else."""
    return F.regexp_replace(F.trim(x), ",", "").try_cast("double")


def _fields(lines: DataFrame, names: list[str]) -> DataFrame:
    """Lines of comma-separated values (quoted ones may hold commas) as trimmed text columns."""
    row = F.from_csv("value", ", ".join(f"`{n}` STRING" for n in names), {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"})
    return lines.select(row.alias("r")).select("r.*")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def parse_bhav(lines: DataFrame) -> DataFrame:
    """One row a symbol and day: series EQ before BE before BZ, other series dropped, numbers without commas, dates as dd-MMM-yyyy."""
    df = _fields(lines, BHAV).filter(F.col("SYMBOL") != "SYMBOL").filter(F.col("SERIES").isin(SERIES))
    df = df.select(
        F.upper("SYMBOL").alias("symbol"), F.col("SERIES").alias("series"), F.to_date(F.initcap(F.lower("DATE1")), "dd-MMM-yyyy").alias("date"),
        *[number(F.col(c)).alias(n) for c, n in (("PREV_CLOSE", "prev_close"), ("OPEN_PRICE", "open"), ("HIGH_PRICE", "high"), ("LOW_PRICE", "low"), ("CLOSE_PRICE", "close"), ("TTL_TRD_QNTY", "volume"), ("NO_OF_TRADES", "trades"), ("DELIV_QTY", "deliv_qty"))],
    )
    return keep_first(df, ["symbol", "date"], [F.array_position(F.array(*map(F.lit, SERIES)), F.col("series"))])


def parse_index_close(lines: DataFrame) -> DataFrame:
    """index_key, date, open, high, low, close, volume of the known indices; a missing open, high or low is the close, a missing volume 0."""
    names = ["name", "day", "open", "high", "low", "close", "change", "change_pct", "volume"]
    key = F.create_map(*[F.lit(x) for kv in INDICES.items() for x in kv])
    df = _fields(lines, names).withColumn("index_key", F.try_element_at(key, F.lower("name"))).filter("index_key IS NOT NULL")
    n = {c: number(F.col(c)) for c in ("open", "high", "low", "close", "volume")}
    df = df.select("index_key", F.to_date("day", "dd-MM-yyyy").alias("date"), *[F.coalesce(n[c], n["close"]).alias(c) for c in ("open", "high", "low")], n["close"].alias("close"), F.coalesce(n["volume"], F.lit(0.0)).alias("volume"))
    return df.filter("close > 0")


def repair(df: DataFrame) -> DataFrame:
    """Open 0 or missing becomes the close; high and low span the positive prices; volume null is 0; shares and turnover derived."""
    positive = F.filter(F.array("open", "high", "low", "close"), lambda x: x > 0)
    df = df.withColumn("open", F.when(F.col("open") > 0, F.col("open")).otherwise(F.col("close"))).withColumns({"_hi": F.array_max(positive), "_lo": F.array_min(positive), "volume": F.coalesce("volume", F.lit(0.0))})
    df = df.drop("high", "low").withColumnsRenamed({"_hi": "high", "_lo": "low"})
    return df.withColumns({"deliv_per": F.when(F.col("volume") > 0, 100 * F.col("deliv_qty") / F.col("volume")), "turnover_cr": F.col("close") * F.col("volume") / 1e7})


def parse_history(lines: DataFrame, start: str = HISTORY_START) -> DataFrame:
    """symbol, date, prices and volumes of history lines (symbol,date,open,high,low,close,volume,deliv_qty,seq): the last of a date wins."""
    names = ["symbol", "date", "open", "high", "low", "close", "volume", "deliv_qty", "seq"]
    df = _fields(lines, names).select("symbol", F.col("date").try_cast("date").alias("date"), *[number(F.col(c)).alias(c) for c in names[2:]])
    df = df.filter((F.col("date") >= start) & (F.col("close") > 0))
    return repair(keep_first(df, ["symbol", "date"], [F.col("seq").desc()]).drop("seq"))


def parse_constituents(lines: DataFrame, least: int = 450) -> DataFrame:
    """company, industry, symbol; raises ValueError with fewer rows than a whole list has."""
    df = _fields(lines, ["company", "industry", "symbol", "series", "isin"]).filter(F.col("symbol").isNotNull() & (F.lower("symbol") != "symbol")).select("company", "industry", F.upper("symbol").alias("symbol"))
    n = df.count()
    if n < least:
        raise ValueError(f"{n} constituents; a whole list has {least} at least")
    return df


def read_actions(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Manual corporate actions: symbol, ex_date, factor, note; lines that begin with # are comments."""
    return spark.read.csv(path, schema="symbol STRING, ex_date DATE, factor DOUBLE, note STRING", header=header, comment="#", ignoreLeadingWhiteSpace=True)


def read_symbol_changes(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return spark.read.csv(path, schema="old_symbol STRING, new_symbol STRING", header=header, comment="#", ignoreLeadingWhiteSpace=True)


def check_session(rows: DataFrame, session: str, least: int = 500) -> None:
    """Raises ValueError unless a day's file has enough rows and its commonest date is the session's."""
    n, day = rows.agg(F.count("*"), F.mode("date")).first()
    if n < least or str(day) != session:
        raise ValueError(f"{n} rows of {day}; wanted {least} at least, of {session}")


def modal_date(rows: DataFrame) -> DataFrame:
    """date: the commonest one, the earliest of equally common ones."""
    n = rows.groupBy("date").count()
    return n.agg(F.min_by("date", F.struct(-F.col("count"), "date")).alias("date"), F.max("count").alias("n"))


def session_states(rows: DataFrame, least: int = 500) -> DataFrame:
    """session, n, day (the commonest date, the earliest of equally common ones) and what each session's file is worth.

    rows: session (the wanted day, the file's) and date (the row's). ok, short (too few rows), stale (of an earlier day), wrong (of a
    later one) or undated; a file is judged in this order.
    """
    by = rows.groupBy("session", "date").agg(F.count("*").alias("_n"))
    one = by.groupBy("session").agg(F.sum("_n").alias("n"), F.min_by("date", F.when(F.col("date").isNotNull(), F.struct(-F.col("_n"), F.col("date")))).alias("day"))
    state = F.when(F.col("n") < least, "short").when(F.col("day").isNull(), "undated").when(F.col("day") < F.col("session"), "stale").when(F.col("day") > F.col("session"), "wrong").otherwise("ok")
    return one.select("session", "n", "day", state.alias("state"))
