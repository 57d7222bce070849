"""A versioned store of bars: months as folders, a manifest a version, and a pointer that is swapped when all is written.

A save writes the months that it touches into a folder of its own, then a manifest that names every month's folder, then the
pointer. Readers see the old version or the new one, never parts of both; the version before stays (`previous`). A save that
dies leaves folders that no manifest names. One writer at a time holds the lock.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ["symbol", "date"]
#: Seconds after which a lock counts as left behind.
STALE = 6 * 3600


class Locked(RuntimeError):
    """Another writer holds the store."""


class Store:
    """Bars (symbol, date and others) under a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -- small files -------------------------------------------------------------------------------------------------
    def _text(self, name: str) -> str | None:
        p = self._path(f"{self.folder}/{name}")
        if not self._fs.exists(p):
            return None
        stream = self._fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def _write(self, name: str, text: str, new: bool = False) -> None:
        out = self._fs.create(self._path(f"{self.folder}/{name}"), not new)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _swap(self, version: int) -> None:
        """Points to a version; the pointer there was becomes `previous`."""
        at = lambda n: self._path(f"{self.folder}/{n}")
        self._write("pointer.new", str(version))
        if self._fs.exists(at("current")):
            self._fs.delete(at("previous"), False)
            self._fs.rename(at("current"), at("previous"))
        self._fs.rename(at("pointer.new"), at("current"))

    @contextmanager
    def lock(self, stale: float = STALE) -> Iterator[None]:
        """Held by one writer; one that is older than `stale` seconds is taken over."""
        mine = f"{uuid.uuid4().hex} {time.time()}"
        held = self._text("lock")
        if held is not None:
            began = held.split(" ")[-1] or "0"
            if time.time() - float(began) < stale:
                raise Locked(f"{self.folder} is held by {held}")
            self._fs.delete(self._path(f"{self.folder}/lock"), False)
        try:
            self._write("lock", mine, new=True)
        except Exception as e:
            raise Locked(self.folder) from e
        try:
            yield
        finally:
            if self._text("lock") == mine:
                self._fs.delete(self._path(f"{self.folder}/lock"), False)

    # -- versions ----------------------------------------------------------------------------------------------------
    def manifest(self) -> dict:
        """The current version's; that of the one before if a swap was cut short."""
        now = self._text("current") or self._text("previous")
        return json.loads(self._text(f"manifest-{now}.json")) if now else {"version": 0, "months": {}, "notes": {}}

    def read(self, months: list[str] | None = None) -> DataFrame | None:
        """The bars, of some months only if so asked; None for an empty store."""
        m = self.manifest()["months"]
        folders = sorted(m[k] for k in (m if months is None else months) if k in m)
        return self.spark.read.parquet(*[f"{self.folder}/{f}" for f in folders]) if folders else None

    def _save(self, changed: DataFrame, notes: dict) -> int:
        """Writes whole months and points to them; months that changed has no rows of stay as they are."""
        now = self.manifest()
        version = now["version"] + 1
        while self._fs.exists(self._path(f"{self.folder}/data/v{version}")):  # of a save that died
            version += 1
        changed.withColumn("month", F.date_format("date", "yyyy-MM")).repartition("month").sortWithinPartitions(*KEYS).write.partitionBy("month").parquet(f"{self.folder}/data/v{version}")
        written = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.folder}/data/v{version}")) if s.isDirectory()]
        months = now["months"] | {n.split("=")[1]: f"data/v{version}/{n}" for n in written}
        self._write(f"manifest-{version}.json", json.dumps({"version": version, "months": months, "notes": now["notes"] | notes}))
        self._swap(version)
        return version

    def append(self, bars: DataFrame, notes: dict | None = None) -> int:
        """Adds bars whose (symbol, date) the store lacks, the first of those that come twice; returns the version. Only their months are read and written."""
        months = [r[0] for r in bars.select(F.date_format("date", "yyyy-MM")).distinct().collect()]  # months of the calendar
        stored = self.read(months)
        new = bars.dropDuplicates(KEYS)
        if stored is not None:
            new = stored.unionByName(new.join(stored.select(*KEYS), KEYS, "left_anti").select(*stored.columns))
        return self._save(new, notes or {})

    def ingest(self, folder: str, schema, checkpoint: str, most_files: int = 1) -> int:
        """Streams session files that have come into a folder since the last call into the store, oldest first; returns the version.

        A batch that is run again after a failure is known by its number in the manifest and adds nothing.
        """
        source = self.spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(folder)

        def add(df: DataFrame, batch: int) -> None:
            if batch > self.manifest()["notes"].get(checkpoint, -1):
                with self.lock():
                    self.append(df, {checkpoint: batch})

        source.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(add).start().awaitTermination()
        return self.manifest()["version"]

    def backfill(self, history: DataFrame, least: int = 1) -> int:
        """Adds the history before a member's first stored bar, for members with fewer than `least` stored bars; returns the version."""
        stored = self.read()
        if stored is None:
            return self.append(history)
        known = stored.groupBy("symbol").agg(F.count("*").alias("_n"), F.min("date").alias("_first"))
        due = history.join(known, "symbol", "left").filter(F.col("_n").isNull() | ((F.col("_n") < least) & (F.col("date") < F.col("_first"))))
        return self.append(due.drop("_n", "_first"))

    def once(self, name: str, compute: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A result over the present version, worked out once: a later call reads what the first one wrote."""
        version = self.manifest()["version"]
        path = f"{self.folder}/results/{name}-v{version}"
        if not self._fs.exists(self._path(f"{path}/_SUCCESS")):
            compute(self.read()).write.mode("overwrite").parquet(path)
        return self.spark.read.parquet(path)
