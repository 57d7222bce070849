import random
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import line_dedup as L

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, min_docs=10):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda x: x.strip(BLANK).translate(low)
    n = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (key(x) and n[key(x)] >= min_docs)]
        out.append((d, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def rows():
    r = random.Random(1)
    pool = ["Hot line", "  hot LINE\t", "É line", "é line", "x", "", "rare one", "nine times", " \x0b", "end\r", "\xa0hot line"]
    out = [(i, "\n".join(r.choice(pool) if r.random() < 0.7 else f"own {i} {k}" for k in range(r.randint(1, 12)))) for i in range(60)]
    out += [(None, None), (7, ""), (7, "Hot line"), (100, "word " * 30000 + "\nhot line"), *[(200 + i, "only in nine") for i in range(9)], *[(300 + i, "in ten") for i in range(10)]]
    return out + out[:3]


@pytest.mark.parametrize("index_bytes", [L.INDEX_BYTES, -1])
def test_equals_brute_force(spark, index_bytes):
    data = rows()
    df = spark.createDataFrame([(d, t, "z") for d, t in data], "doc_id long, text string, n_lines string")
    got = L.dedup_lines(df, index_bytes=index_bytes, shard_keys=3).select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute(data)))


def test_empty_table(spark):
    assert L.dedup_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_minimal_hash():
    keys = np.unique(np.random.default_rng(0).integers(0, 1 << 63, 5000).astype(np.uint64))
    h, rest = L.MinimalHash.build(keys)
    assert not len(rest) and sorted(h.slots(keys).tolist()) == list(range(len(keys)))
    lo, n = keys * np.uint64(3), np.arange(len(keys))
    s = L.Shard(L.Shard.build(np.concatenate([keys, keys[:2]]), np.concatenate([lo, lo[:2] + np.uint64(1)]), np.concatenate([n, [5, 6]])))
    assert s.count(keys, lo).tolist() == n.tolist() and s.count(keys[:2], lo[:2] + np.uint64(1)).tolist() == [5, 6]
    assert not s.count(keys + np.uint64(1), lo + np.uint64(7)).any()
