"""Corporate actions, renames and universe changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.exprs import by_symbol

TOLERANCE = 0.003


def detect_actions(bars: DataFrame) -> DataFrame:
    """symbol, ex_date, factor where the stated previous close differs from the last close by more than the tolerance (bars with prev_close)."""
    f = F.col("prev_close") / F.lag("close").over(by_symbol())
    return bars.withColumn("factor", f).filter(F.abs(F.round(F.col("factor") - 1, 10)) > TOLERANCE).select("symbol", F.col("date").alias("ex_date"), "factor")


def adjust(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Bars before an action get its factor: prices times it, volume and delivered quantity divided by it; later factors multiply.

    Actions join the bars as rows of their day, also where no bar has that day, and one window from the newest day back carries the
    product, so a symbol's actions are applied in one pass.
    """
    a = actions.select("symbol", F.col("ex_date").alias("date"), F.ln("factor").alias("_f"))
    df = bars.withColumn("_bar", F.lit(True)).unionByName(a, allowMissingColumns=True).withColumn("_day", F.unix_date("date"))
    later = Window.partitionBy("symbol").orderBy(F.col("_day").desc()).rangeBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("adj", F.exp(F.coalesce(F.sum("_f").over(later), F.lit(0.0)))).filter("_bar")
    return df.withColumns({c: F.col(c) * F.col("adj") for c in ("open", "high", "low", "close")} | {c: F.col(c) / F.col("adj") for c in ("volume", "deliv_qty")}).drop("_f", "_bar", "_day", "prev_close")


KEY = ["symbol", "ex_date", "factor"]


def due_actions(manual: DataFrame, applied: DataFrame, bars: DataFrame) -> DataFrame:
    """Manual actions (symbol, ex_date, factor as texts) that are still to be applied: each text once, none whose text `applied` has.

    A row that can't be read, or of a symbol without bars, isn't due. A factor may be undone by another row with its inverse.
    """
    tidy = manual.select(*[F.trim(c).alias(c) for c in KEY]).dropna().dropDuplicates()
    tidy = tidy.join(applied.select(*KEY), KEY, "left_anti").join(bars.select(F.col("symbol").cast("string").alias("symbol")).distinct(), "symbol", "left_semi")
    read = tidy.withColumns({"day": F.col("ex_date").try_cast("date"), "value": F.col("factor").try_cast("double")})
    return read.filter("day IS NOT NULL AND value > 0 AND value < double('Infinity')")


def apply_manual(bars: DataFrame, manual: DataFrame, applied: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Bars with the manual actions that are due, and the applied ones afterwards: a second call with these changes nothing."""
    due = due_actions(manual, applied, bars)
    factors = due.select(F.col("symbol").cast(bars.schema["symbol"].dataType).alias("symbol"), F.col("day").alias("ex_date"), F.col("value").alias("factor"))
    return adjust(bars, factors), applied.select(*KEY).unionByName(due.select(*KEY))


def rename(bars: DataFrame, changes: DataFrame) -> DataFrame:
    """History of renamed symbols under the new name, unless the new name has a history of its own."""
    taken = bars.select(F.col("symbol").alias("new_symbol")).distinct()
    free = changes.join(taken, "new_symbol", "left_anti").select(F.col("old_symbol").alias("symbol"), "new_symbol")
    return bars.join(free, "symbol", "left").withColumn("symbol", F.coalesce("new_symbol", "symbol")).drop("new_symbol")


def universe_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """symbol, change: added or removed."""
    added = new.select("symbol").join(old.select("symbol"), "symbol", "left_anti").withColumn("change", F.lit("added"))
    removed = old.select("symbol").join(new.select("symbol"), "symbol", "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def fill_late(bench: DataFrame, sessions: DataFrame, late: DataFrame) -> DataFrame:
    """A benchmark row for each session: the known one, else the late one, else the last one carried forward and marked."""
    w = Window.partitionBy("key").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    df = sessions.join(bench, ["key", "date"], "left").join(late.select("key", "date", F.col("bench").alias("_late")), ["key", "date"], "left")
    df = df.withColumn("_known", F.coalesce("bench", "_late"))
    return df.select("key", "date", F.last("_known", ignorenulls=True).over(w).alias("bench"), F.col("_known").isNull().alias("is_placeholder"))
