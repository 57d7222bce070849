"""Round trips and refusals of the readers of JSON, CSV, SQLite, pickles and columnar files."""

import datetime
import os
import pickle
import sqlite3

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.sources import columnar as Co
from tickloom.sources import files as Fi
from tickloom.sources import formats as Fo


def as_files(spark, **content):
    return spark.createDataFrame([(k, v) for k, v in content.items()], "path string, content binary")


def test_sqlite_files_from_disk(spark, tmp_path):
    for name, rows in (("a", [(1, "x", 0.5, "2020-01-02"), (2, None, None, None)]), ("b", []), ("c", [(i, "y" * 10, i / 2, "2021-12-31") for i in range(50_000)])):
        db = sqlite3.connect(tmp_path / f"{name}.db")
        db.execute("CREATE TABLE calls (id INTEGER, name TEXT, r REAL, d TEXT)")
        db.executemany("INSERT INTO calls VALUES (?, ?, ?, ?)", rows)
        db.commit()
        db.close()
    got = Fo.sqlite_rows(Fo.files(spark, f"file://{tmp_path}/*.db"), "SELECT id, name, r, d FROM calls", "id long, name string, r double, d date")
    assert got.count() == 50_002
    assert sorted(got.filter("id < 3 AND (name IS NULL OR name = 'x')").collect(), key=str) == [(1, "x", 0.5, datetime.date(2020, 1, 2)), (2, None, None, None)]


@pytest.mark.parametrize("content", [b"not a database", b""])
def test_other_files_arent_databases(spark, content):
    with pytest.raises(Exception, match="isn't a database"):
        Fo.sqlite_rows(as_files(spark, x=content), "SELECT 1", "a long").collect()


def test_a_query_must_have_the_columns(spark):
    db = sqlite3.connect(":memory:")
    db.execute("CREATE TABLE t (a)")
    with pytest.raises(Exception, match="1 columns; wanted 2"):
        Fo.sqlite_rows(as_files(spark, x=bytes(db.serialize())), "SELECT a FROM t", "a long, b long").collect()


def frame(*closes):
    return pd.DataFrame({"close": list(closes), "extra": "z"}, index=pd.date_range("2020-01-01", periods=len(closes), name="date"))


def test_the_last_part_of_a_key_wins_whole(spark):
    parts = as_files(spark, part1=pickle.dumps({"A": frame(1.0, 2.0, 3.0), "B": frame(9.0)}), part2=pickle.dumps({"A": frame(7.0), "C": frame()}), part3=pickle.dumps({}))
    got = Fo.pickled_frames(parts, "symbol string, date date, close double, volume double")
    assert sorted(got.collect()) == [("A", datetime.date(2020, 1, 1), 7.0, None), ("B", datetime.date(2020, 1, 1), 9.0, None)]


class Bad:
    def __reduce__(self):
        return os.getcwd, ()


@pytest.mark.parametrize("what", [Bad(), {"A": Bad()}, [1], os.system])
def test_pickles_of_other_things_are_refused(spark, what):
    with pytest.raises(Exception, match="isn't"):
        Fo.pickled_frames(as_files(spark, x=pickle.dumps(what)), "symbol string, date date, close double").collect()


def test_json_objects(spark, tmp_path):
    (tmp_path / "r.json").write_text('{\n "A": {"quarter": "Q1", "n": 3, "more": [1]},\n "B": {"n": null}\n}')
    (tmp_path / "e.json").write_text("{}")
    got = Fo.read_json_objects(spark, f"file://{tmp_path}", "quarter STRING, n BIGINT", "symbol")
    assert sorted(got.collect()) == [("A", "Q1", 3), ("B", None, None)]
    with pytest.raises(Exception):
        Fo.json_objects(spark.createDataFrame([("[1, 2",)], "value string"), "n BIGINT").collect()


def test_static_tables_need_their_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text('universe,events,mean\n"One, with comma",3,0.5\nTwo,,\n')
    assert sorted(Fo.read_static(spark, f"file://{tmp_path}/t.csv", "universe string, events long, mean double").collect()) == [("One, with comma", 3, 0.5), ("Two", None, None)]
    for schema in ("universe string, mean double, events long", "universe string, events long"):
        with pytest.raises(Exception):
            Fo.read_static(spark, f"file://{tmp_path}/t.csv", schema).collect()
    (tmp_path / "w.csv").write_text("a\nx\n")
    with pytest.raises(Exception):
        Fo.read_static(spark, f"file://{tmp_path}/w.csv", "a long").collect()


def test_columnar_round_trip_and_cut_short(spark, tmp_path):
    rows = [(1, 'quote " and \\ and ]', 0.1, datetime.date(2020, 1, 2), True), (2, "", -1e-7, None, False), (None, None, None, None, None), (3, "line\nbreak, é", 1e22, datetime.date(1999, 12, 31), True), (4, "null", 5.0, None, None)]
    df = spark.createDataFrame(rows, "id long, name string, x double, d date, ok boolean")
    folder = f"file://{tmp_path}/out"
    m = Co.write(df, folder, "calls", session_date="2020-01-02")
    assert (m["count"], m["kind"], m["columns"]) == (5, "calls", ["id", "name", "x", "d", "ok"])
    assert sorted(Co.read(spark, folder).collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(Exception):
        Co.write(df, folder, "calls")
    os.remove(tmp_path / "out" / "manifest.json")
    with pytest.raises(Co.NotWhole):
        Co.read(spark, folder)


def test_columnar_of_no_rows(spark, tmp_path):
    df = spark.createDataFrame([], "id long, name string")
    folder = f"file://{tmp_path}/none"
    assert Co.write(df, folder, "calls")["count"] == 0 and Co.read(spark, folder).count() == 0


def test_session_states(spark):
    rows = [("ok", "2020-01-02", ["2020-01-02"] * 3), ("stale", "2020-01-03", ["2020-01-02"] * 2 + ["2020-01-03"]), ("wrong", "2020-01-06", ["2020-01-07"] * 3), ("short", "2020-01-07", ["2020-01-07"]), ("undated", "2020-01-08", [None] * 3), ("stale", "2020-01-09", ["2020-01-08", None, "2020-01-09", None])]
    df = spark.createDataFrame([(s, d) for _, s, ds in rows for d in ds], "session string, date string").select(*[F.col(c).cast("date").alias(c) for c in ("session", "date")])
    assert [r["state"] for r in Fi.session_states(df, 2).orderBy("session").collect()] == [r[0] for r in rows]
