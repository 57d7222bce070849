import base64
import hashlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import warc as W


def brute(rows, min_bytes=0):
    out = []
    raw = [(p, (h or "").encode()) for p, _, h in rows]
    for p, b in raw:
        same = [q for q, c in raw if c == b and q is not None]
        last = max(same) if len([1 for _, c in raw if c == b]) > 1 and same else p
        dup = len(b) >= min_bytes and last != p
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "revisit" if dup else "response", last if dup else None))
    return sorted(map(str, out))


ROWS = [(1, "http://a/", "x"), (2, None, "x"), (3, "http://b/\r\nX: y", None), (4, "u", ""), (5, "é", "é" * 500000), (6, "u", "WARC/1.1\r\n\r\nbody\r\n\r\n"), (7, "u", "x"), (7, "u", "x"), (8, "u", "z" * 3), (9, "u", "z" * 3), *[(100 + i, "hot", "same page") for i in range(300)]]


@pytest.mark.parametrize("min_bytes", [0, 2])
def test_round_trip(spark, min_bytes):
    df = spark.createDataFrame([(*r, "q") for r in ROWS], "page_id long, url string, html string, digest string").repartition(3)
    assert sorted(str(tuple(r)) for r in W.round_trip(df, min_bytes).collect()) == brute(ROWS, min_bytes)


def test_selected_records_by_ranges(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    index = W.write_archives(df.repartition(2), compress=False).filter(F.col("page_id") % 2 == 1)
    got = W.read_records(index).collect()
    assert sorted(r.page_id for r in got) == sorted(p for p, *_ in ROWS if p % 2)
    assert next(r.payload for r in got if r.page_id == 5) == ("é" * 500000).encode()


def test_coalescing():
    rows = [("a", 0, 10), ("a", 10, 5), ("a", 15 + W.GAP_BYTES + 1, 5), ("b", 0, 9), ("b", 9, W.READ_BYTES)]
    assert [(f, b, e, len(i)) for f, b, e, i in W.ranges(iter(rows))] == [("a", 0, 15, 2), ("a", 15 + W.GAP_BYTES + 1, 20 + W.GAP_BYTES + 1, 1), ("b", 0, 9, 1), ("b", 9, 9 + W.READ_BYTES, 1)]


def test_empty_table(spark):
    assert W.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
