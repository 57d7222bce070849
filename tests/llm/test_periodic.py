import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import periodic as P


def brute(words):
    """Every run by its definition: for each period the maximal stretches, of equal stretches the smallest period."""
    n, out = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                out.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted((a, e - a, q) for (a, e), q in out.items())


def expected(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], sha(lines), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 3), st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=12), st.integers(1, 9)), max_size=6))
def test_finds_every_run(letters, parts):
    words = [x % letters for part, k in parts for x in part * k]
    assert P.find(np.array(words, np.int64)) == brute(words)


def test_long_and_nested_periods():
    r = random.Random(3)
    base = [r.randrange(50) for _ in range(700)]
    for words in ([0] * 5000, [0, 1] * 3000 + [0], base * 4, base * 4 + base[:300], (([1] * 7 + [2]) * 5 + [3]) * 6, base + [7, 8, 9] * 40 + base[:650] * 5, base * 3 + base[:699]):
        assert P.find(np.array(words, np.int64)) == brute(words)


def test_query_equals_brute_force(spark):
    r = random.Random(5)
    rows = [(i, " ".join(r.choice("abcdefghijkl") for _ in range(r.choice([3, 11, 40, 200])))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, " \t\n\x0b\f\r "), (None, "x " * 20), (None, None), (903, "a b " * 9), (904, "é\x85 é\x85 " * 7), (905, "A a " * 3), (906, "w " * 40_000 + "v"), (907, "p q " * 4 + "r " * 6), *[(908, "go stop " * 5)] * 2]
    rows += [(i, "") for i in range(910, 960)] + [(i, "one") for i in range(960, 1010)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = P.digests(P.periodic_runs(P.planted(df))).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str(expected(*x)) for x in rows)


def test_real_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {x["doc_id"]: tuple(x) for x in P.digests(P.periodic_runs(P.planted(df))).collect()}
    rows = df.collect()
    assert len(got) == len(rows) and all(got[x["doc_id"]] == expected(x["doc_id"], x["text"]) for x in rows)


def test_empty_table_and_extra_columns(spark):
    assert P.periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(1, "a b " * 4 + "c", "x", 7, "y")], "doc_id long, text string, `runs` string, d0 int, collapsed string")
    assert P.periodic_runs(df).select("doc_id", "runs", "d0", "collapsed").collect() == [(1, [(0, 8, 2)], 7, "a b c")]
