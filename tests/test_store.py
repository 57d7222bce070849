"""The versioned store, its lock, ingest of sessions and the ledger as keyed state, each cut short and started again."""

import datetime as dt
import shutil

import pytest

from tickloom.sources.store import Locked, Store
from tickloom.streaming import jobs

SCHEMA = "symbol string, date date, close double"
DAY = [dt.date(2020, 1, 30) + dt.timedelta(days=k) for k in range(6)]


def bars(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(store):
    return sorted(tuple(r) for r in store.read().select("symbol", "date", "close").collect())


def test_append_keeps_versions(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    assert s.read() is None and s.manifest()["version"] == 0
    assert s.append(bars(spark, [("A", DAY[0], 1.0), ("A", DAY[0], 1.0), ("B", DAY[0], 5.0)])) == 1
    first = s.manifest()["months"]
    assert s.append(bars(spark, [("A", DAY[2], 2.0), ("A", DAY[0], 9.0)])) == 2
    assert content(s) == [("A", DAY[0], 1.0), ("A", DAY[2], 2.0), ("B", DAY[0], 5.0)]
    assert s.append(bars(spark, [("B", DAY[3], 7.0)])) == 3
    assert s.manifest()["months"]["2020-01"].startswith("data/v2/") and s.manifest()["months"]["2020-02"].startswith("data/v3/") and first["2020-01"].startswith("data/v1/")
    assert s._text("previous") == "2"


def test_a_save_that_dies_changes_nothing(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    s.append(bars(spark, [("A", DAY[0], 1.0)]))
    swap, s._swap = s._swap, lambda version: (_ for _ in ()).throw(OSError("lost"))
    with pytest.raises(OSError):
        s.append(bars(spark, [("A", DAY[1], 2.0)]))
    assert content(s) == [("A", DAY[0], 1.0)]
    s._swap = swap
    s.append(bars(spark, [("A", DAY[1], 2.0)]))
    assert content(s) == [("A", DAY[0], 1.0), ("A", DAY[1], 2.0)]
    shutil.move(tmp_path / "store" / "current", tmp_path / "store" / "gone")  # between the two renames
    assert content(s) == [("A", DAY[0], 1.0)]


def test_lock(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    with s.lock():
        with pytest.raises(Locked), Store(spark, str(tmp_path / "store")).lock():
            pass
        with Store(spark, str(tmp_path / "store")).lock(stale=0):  # left behind
            pass
    with s.lock():
        pass


def test_ingest_of_sessions(spark, tmp_path):
    s, inbox, state = Store(spark, str(tmp_path / "store")), str(tmp_path / "inbox"), str(tmp_path / "state")
    for k in range(3):
        bars(spark, [("A", DAY[k], float(k)), ("B", DAY[k], 10.0 + k)]).coalesce(1).write.mode("append").parquet(inbox)
    append, done = s.append, []

    def dies(df, notes=None):
        if len(done) == 1:
            done.append("died")
            raise OSError("lost executor")
        done.append(append(df, notes))
        return done[-1]

    s.append = dies
    with pytest.raises(Exception, match="lost executor"):
        s.ingest(inbox, SCHEMA, state)
    s.append = append
    s.ingest(inbox, SCHEMA, state)
    want = sorted([("A", DAY[k], float(k)) for k in range(3)] + [("B", DAY[k], 10.0 + k) for k in range(3)])
    assert content(s) == want
    version = s.manifest()["version"]
    assert s.ingest(inbox, SCHEMA, state) == version and content(s) == want  # nothing new
    bars(spark, [("A", DAY[2], 99.0), ("A", DAY[4], 4.0)]).coalesce(1).write.mode("append").parquet(inbox)
    s.ingest(inbox, SCHEMA, state)
    assert content(s) == sorted([*want, ("A", DAY[4], 4.0)])


def test_backfill_and_once(spark, tmp_path):
    s = Store(spark, str(tmp_path / "store"))
    s.append(bars(spark, [("A", DAY[3], 3.0), ("A", DAY[4], 4.0), ("B", DAY[4], 8.0)]))
    s.backfill(bars(spark, [("B", d, 1.0) for d in DAY] + [("A", DAY[0], 0.0), ("C", DAY[1], 6.0)]), least=2)
    assert content(s) == sorted([("A", DAY[3], 3.0), ("A", DAY[4], 4.0), ("B", DAY[4], 8.0), ("C", DAY[1], 6.0)] + [("B", d, 1.0) for d in DAY[:4]])
    calls = []

    def count(df):
        calls.append(1)
        return df.groupBy("symbol").count()

    assert s.once("counts", count).count() == s.once("counts", count).count() == 3 and len(calls) == 1
    s.append(bars(spark, [("D", DAY[5], 1.0)]))
    assert s.once("counts", count).count() == 4 and len(calls) == 2


CALLS = "symbol long, tf string, kind string, signal_date date, status string"


def batch_ledger(sessions):
    """The same by a loop: a call of an open (symbol, tf, kind) repeats it; a status closes it."""
    rows, open_ = {}, {}
    for calls in sessions:
        for symbol, tf, kind, day, status in sorted(calls, key=lambda r: (r[3], r[4] is not None)):
            key = (symbol, tf, kind)
            if status is not None:
                if key in open_:
                    rows[open_.pop(key)][0] = status
            elif key in open_:
                r = rows[open_[key]]
                if day > r[2]:
                    r[1], r[2] = r[1] + 1, day
            elif (*key, day) not in rows:
                open_[key] = (*key, day)
                rows[*key, day] = ["Pending", 0, day]
    return sorted((*k, *v) for k, v in rows.items())


def test_ledger_as_keyed_state(spark, tmp_path):
    sessions = [
        [(1, "ST", "BUY", DAY[0], None), (2, "ST", "BUY", DAY[0], None)],
        [(1, "ST", "BUY", DAY[1], None), (3, "LT", "SHORT", DAY[1], None), (2, "ST", "BUY", DAY[1], "Target hit")],
        [(1, "ST", "BUY", DAY[2], None), (2, "ST", "BUY", DAY[2], None), (3, "LT", "SHORT", DAY[2], "Stop hit")],
        [(3, "LT", "SHORT", DAY[3], None), (2, "ST", "BUY", DAY[3], None), (2, "ST", "BUY", DAY[3], None)],
    ]
    inbox, ledger = str(tmp_path / "calls"), str(tmp_path / "ledger")
    shown = lambda df: sorted((r.symbol, r.tf, r.kind, r.signal_date, r.status, r.repeat_count, r.last_seen) for r in df.collect())
    for k, rows in enumerate(sessions):
        spark.createDataFrame(rows, CALLS).coalesce(1).write.mode("append").parquet(inbox)
        if k in (1, 3):  # the stream is stopped and started again between these
            assert shown(jobs.run_keyed_ledger(spark, inbox, ledger)) == batch_ledger(sessions[: k + 1])
    assert shown(jobs.run_keyed_ledger(spark, inbox, ledger)) == batch_ledger(sessions)


def test_hourly_bars_go_on_where_they_stopped(spark, tmp_path):
    schema, at = "event_id long, ts timestamp_ntz, event_type string, value double", lambda h, m: dt.datetime(2020, 1, 1, h, m)
    parts = [[(1, at(9, 5), "a", 1.0), (2, at(9, 50), "a", 4.0), (3, at(10, 1), "b", 7.0)], [(4, at(9, 55), "a", 3.0), (5, at(10, 30), "b", 5.0)], [(6, at(14, 0), "a", 2.0)]]
    inbox, target, state = str(tmp_path / "events"), str(tmp_path / "bars"), str(tmp_path / "state")
    for k, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        got = jobs.run_hourly(spark, inbox, "*.parquet", schema, target, state)
        if k == 1:
            assert {(r.symbol, r.hour.hour): (r.open, r.high, r.low, r.close, r.volume) for r in got.collect()} == {("a", 9): (1.0, 4.0, 1.0, 3.0, 3), ("b", 10): (7.0, 7.0, 5.0, 5.0, 2)}
    assert got.count() == 3


def test_repeated_calls_keep_their_factor(spark):
    from tickloom.plans.ledger import ca_factor

    calls = spark.createDataFrame([("A", DAY[0])] * 2 + [("B", DAY[0])], "symbol string, signal_date date")
    actions = spark.createDataFrame([("A", DAY[1], 0.5)], "symbol string, ex_date date, factor double")
    assert sorted((r.symbol, r.factor) for r in ca_factor(calls, actions).collect()) == [("A", 0.5), ("A", 0.5), ("B", 1.0)]
