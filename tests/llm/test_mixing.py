import math
import random
from collections import defaultdict

import duckdb
import pytest

from tickloom.llm import mixing as M

SCHEMA = "doc_id long, text string, source string, epoch string"


def rows():
    r = random.Random(2)
    out = [(i, " ".join("w" for _ in range(r.randint(0, 40))), r.choice(["a"] * 12 + ["b", "b", "c", None]), "x") for i in range(900)]
    return out + [(None, None, "a", "x"), (5, "", "empty", "x"), (6, None, "empty", "x"), (7, "x\x0by\xa0z", "b", "x"), *out[:5]]


def test_shares_and_limits(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = M.mix(df).collect()
    tokens, mixed, seen = defaultdict(int), defaultdict(int), defaultdict(set)
    for d, t, s, _ in rows():
        tokens[s or ""] += len(M_words(t))
        seen[s or ""].add((d, t))
    copies = defaultdict(int)
    for r in got:
        mixed[r.source or ""] += r.n_tokens
        seen[r.source or ""].discard((r.doc_id, r.text))
        copies[r.source] = max(copies[r.source], r.epoch + 1)
    assert not any(seen.values()) and max(copies.values()) <= 2
    shares = {s: t / sum(tokens.values()) for s, t in tokens.items() if t}
    a = 1 - math.log(2) / math.log(max(shares.values()) / min(shares.values()))
    w = {s: p**a for s, p in shares.items()}
    for s in w:
        assert abs(mixed[s] / sum(mixed.values()) - w[s] / sum(w.values())) < 0.02


def M_words(t):
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def test_equals_sql(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    got = M.mix(df).select("doc_id", "source", "n_tokens", "epoch", "block").collect()
    con = duckdb.connect()
    documents = df.toArrow()
    con.register("documents", documents)
    want = con.execute(M.MIX_SQL.format(documents="documents")).fetchall()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, want))


def test_budget_and_entropy(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    total = sum(len(M_words(t)) for _, t, _, _ in rows())
    got = M.mix(df, budget=total // 2, max_epochs=None).collect()
    assert 0.9 * total / 2 < sum(r.n_tokens for r in got) <= total / 2
    shares = M.source_shares(M.with_tokens(df))
    p = [r.share for r in shares.collect() if r.share]
    for target in (0.2, 1.0):
        a = M.exponent(shares, target_entropy=target, max_epochs=None)
        z = sum(x**a for x in p)
        h = -sum(x**a / z * math.log(x**a / z) for x in p)
        assert abs(h - target) < 1e-4
    assert M.exponent(shares, max_epochs=1.0) == pytest.approx(1.0)


def test_no_python_in_the_plan(spark, capsys):
    M.mix(spark.createDataFrame(rows(), SCHEMA)).explain()
    assert not any(x in capsys.readouterr().out for x in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    assert M.mix(spark.createDataFrame([], SCHEMA)).count() == 0
    one = M.mix(spark.createDataFrame([(1, "", "s", ""), (1, "", "s", "")], SCHEMA)).collect()
    assert [(r.epoch, r.block) for r in one] == [(0, 0), (0, 0)]
