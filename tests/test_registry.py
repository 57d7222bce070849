"""Every query with SQL gives the SQL's rows; test_kernels.py holds the others against plain loops."""

import datetime

import duckdb
import pytest

from tickloom.plans import registry, registry2, registry3, registry4, registry5, registry6, registry7, registry8, registry9  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("region", "nation", "supplier", "part", "lineitem", "events"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    tidy = lambda v: round(float(v), 6) + 0.0 if isinstance(v, int | float) and not isinstance(v, bool) else v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v
    return sorted(str([tidy(r[i]) for i in order]) for r in values)


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_equals_sql(spark, con, name):
    df = registry.QUERIES[name](spark, SF)
    got = rows(df.columns, df.collect())
    cur = con.execute(registry.ORACLE_SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert got == rows(names, cur.fetchall())


#: Queries of events: test_charts.py holds them against walks over the bars.
EVENT_QUERIES = {"g_chart_patterns"}


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL) - EVENT_QUERIES))
def test_covers_every_bar(spark, name):
    df = registry.QUERIES[name](spark, SF)
    assert df.columns[:2] == ["symbol", "date"]
    if not name.startswith("sig_"):
        assert df.count() == registry.QUERIES["bars_walk"](spark, SF).count()
    assert all(v is not None for v in df.agg({c: "max" for c in df.columns[2:]}).first())
