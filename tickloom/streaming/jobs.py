"""Structured Streaming jobs with file sources. Each runs what is there (availableNow) and keeps its state in a checkpoint."""

from __future__ import annotations

import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from tickloom.plans.ledger import insert_calls


def state_folder(spark: SparkSession, name: str) -> str:
    """A folder that driver and executors share: under spark.checkpoint.dir, or a temporary one where it is unset (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tickloom-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def hourly_stream(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Tumbling hourly bars of streamed events (event_type, ts, event_id, value); an hour is final once `late` has passed."""
    order = F.struct("ts", "event_id")
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", "1 hour").alias("w"), "event_type").agg(
        F.min_by("value", order).alias("open"), F.max("value").alias("high"), F.min("value").alias("low"), F.max_by("value", order).alias("close"), F.count("*").alias("volume")
    ).select(F.col("event_type").alias("symbol"), F.col("w.start").alias("hour"), "open", "high", "low", "close", "volume")


def run_hourly(spark: SparkSession, folder: str, files: str, schema, target: str | None = None, checkpoint: str | None = None) -> DataFrame:
    """Streams the event files of a folder into a table of hourly bars; returns the table.

    Each batch writes the hours that it changed into a folder of its own, which it replaces if it is run again; an hour's newest row
    counts, and hours that are final leave the state. With the same target and checkpoint a later call goes on from there.
    """
    target, checkpoint = target or state_folder(spark, "bars"), checkpoint or state_folder(spark, "state")
    source = spark.readStream.schema(schema).option("pathGlobFilter", files).parquet(folder)

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{target}/batch={batch}")

    query = hourly_stream(source).writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    rows = spark.read.parquet(target)
    values = ["open", "high", "low", "close", "volume"]
    return rows.groupBy("symbol", "hour").agg(F.max_by(F.struct(*values), "batch").alias("r")).select("symbol", "hour", "r.*")


def append_sessions(stored: DataFrame, new: DataFrame) -> DataFrame:
    """stored and the rows of new whose (symbol, date) it doesn't have: a session that comes twice counts once."""
    keys = ["symbol", "date"]
    return stored.unionByName(new.dropDuplicates(keys).join(stored.select(*keys), keys, "left_anti"))


def run_ledger(spark: SparkSession, folder: str, schema, ledger: str) -> DataFrame:
    """Streams files of calls (symbol, tf, kind, signal_date), a session each, into the ledger table; returns it.

    Each batch writes a version of its own, so that a batch that is run again starts from the one before; without new files the newest stays.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    columns = "symbol LONG, tf STRING, kind STRING, signal_date DATE, status STRING, repeat_count INT, last_seen DATE"

    def step(calls: DataFrame, batch: int) -> None:
        old = spark.read.schema(columns).parquet(f"{ledger}/v{batch - 1}") if batch else spark.createDataFrame([], columns)
        insert_calls(old, calls).write.mode("overwrite").parquet(f"{ledger}/v{batch}")

    query = source.writeStream.option("checkpointLocation", f"{ledger}/state").trigger(availableNow=True).foreachBatch(step).start()
    query.awaitTermination()
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{ledger}/v*")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    versions = [int(f.getPath().getName()[1:]) for f in found]
    return spark.read.schema(columns).parquet(f"{ledger}/v{max(versions)}") if versions else spark.createDataFrame([], columns)


CALLS = "symbol LONG, tf STRING, kind STRING, signal_date DATE, status STRING"
LEDGER = "symbol LONG, tf STRING, kind STRING, signal_date DATE, status STRING, repeat_count INT, last_seen DATE"


class OpenCall(StatefulProcessor):
    """The open call of a (symbol, tf, kind): a later call repeats it, an outcome closes it, the next call opens another.

    Emits each call that a batch changed, as it is afterwards. State holds one row a key however long the ledger gets.
    """

    def init(self, handle) -> None:
        self.call = handle.getValueState("call", "signal_date DATE, status STRING, repeat_count INT, last_seen DATE")

    def handleInputRows(self, key, rows, timerValues):
        came = pd.concat(list(rows), ignore_index=True)
        came = came.assign(last=came["status"].notna()).sort_values(["signal_date", "last"], kind="stable")
        now = self.call.get() if self.call.exists() else None
        changed = {}
        for day, status in zip(came["signal_date"], came["status"].where(came["status"].notna(), None), strict=True):
            open_ = now is not None and now[1] == "Pending"
            if status is not None:
                now = (now[0], status, now[2], now[3]) if open_ else now
            elif open_:
                now = (now[0], now[1], now[2] + 1, day) if day > now[3] else now
            elif now is None or day != now[0]:
                now = (day, "Pending", 0, day)
            if now is not None:
                changed[now[0]] = now
        if now is not None:
            self.call.update(now)
        yield pd.DataFrame([(*key, *c) for c in changed.values()], columns=["symbol", "tf", "kind", "signal_date", "status", "repeat_count", "last_seen"])

    def close(self) -> None:
        pass


def run_keyed_ledger(spark: SparkSession, folder: str, ledger: str) -> DataFrame:
    """Streams files of calls and outcomes (symbol, tf, kind, signal_date, status), a session each, through keyed state; returns the ledger.

    Each batch writes the calls that it changed into a folder of its own, which it replaces if it is run again; a call's newest row counts.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source = spark.readStream.schema(CALLS).option("maxFilesPerTrigger", 1).parquet(folder)
    kept = source.groupBy("symbol", "tf", "kind").transformWithStateInPandas(statefulProcessor=OpenCall(), outputStructType=LEDGER, outputMode="Update", timeMode="None")

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{ledger}/changes/batch={batch}")

    try:
        kept.writeStream.outputMode("update").option("checkpointLocation", f"{ledger}/state").trigger(availableNow=True).foreachBatch(write).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
    rows = spark.read.schema(f"{LEDGER}, batch INT").parquet(f"{ledger}/changes")
    keys = ["symbol", "tf", "kind", "signal_date"]
    return rows.groupBy(*keys).agg(F.max_by(F.struct("status", "repeat_count", "last_seen"), "batch").alias("r")).select(*keys, "r.*")
