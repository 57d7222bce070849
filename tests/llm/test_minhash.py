import random
import re

import pyarrow.parquet as pq
import pytest

from tickloom.llm import minhash as M

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, width=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def brute(rows, width=4, percent=80):
    sets = [(d, shingles(t, width)) for d, t in rows]
    parent = {d: d for d, _ in sets if d is not None}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    where = {}
    for i, (d, s) in enumerate(sets):
        if d is None:
            continue
        seen = set()
        for g in s:
            for j in where.get(g, ()):
                if j not in seen:
                    seen.add(j)
                    e, o = sets[j]
                    if 100 * len(s & o) >= percent * len(s | o):
                        a, b = find(d), find(e)
                        parent[max(a, b)] = min(a, b)
            where.setdefault(g, []).append(i)
    return sorted(str((d, len(s), find(d) if d is not None else None, d is None or find(d) == d)) for d, s in sets)


def rows():
    r = random.Random(3)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(5))
    out = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "ONE  two"), (6, "one two three"), (None, "one two"), (7, "a b c d"), (8, "A b\x0bc d")]
    n = 10
    for size, edits in ((60, 1), (40, 3), (30, 8), (2, 2), (2, 5)):
        base = [word() for _ in range(100)]
        for _ in range(size):
            t = list(base)
            for _ in range(r.randint(0, edits)):
                t[r.randrange(100)] = word()
            out.append((n, " ".join(t)))
            n += 1
    out += [(n + i, " ".join(word() for _ in range(30))) for i in range(50)]
    return out + out[10:14] + [(12, "another text under a number that is taken already")]


@pytest.mark.parametrize("width", [4, 5])
def test_equals_brute_force(spark, width):
    data = rows()
    df = spark.createDataFrame([(d, t, "z") for d, t in data], "doc_id long, text string, component_id string")
    assert sorted(str(tuple(x)) for x in M.near_duplicates(df, width).collect()) == brute(data, width)


def test_equals_brute_force_on_documents(spark):
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    data = list(zip(t["doc_id"], t["text"], strict=True))
    got = M.near_duplicates(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    assert sorted(str(tuple(x)) for x in got.collect()) == brute(data)


def test_empty_table(spark):
    assert M.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
