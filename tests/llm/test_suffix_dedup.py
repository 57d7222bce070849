import random
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from tickloom.llm import suffix_dedup as S


def brute(rows, length):
    seen = defaultdict(list)
    raw = [(d, (t or "").encode()) for d, t in rows]
    for i, (_, b) in enumerate(raw):
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]].append((i, s))
    gone = [bytearray(len(b)) for _, b in raw]
    for places in seen.values():
        if len(places) > 1:
            for i, s in places:
                gone[i][s : s + length] = b"\1" * length
    out = []
    for (d, b), g in zip(raw, gone, strict=True):
        kept = bytes(x for x, y in zip(b, g, strict=True) if not y)
        out.append((d, len(b), sum(g), sum(1 for i, y in enumerate(g) if y and not (i and g[i - 1])), kept))
    return sorted(map(str, out))


def rows(seed, length):
    r = random.Random(seed)
    text = lambda n, letters: "".join(r.choice(letters) for _ in range(n))
    passage = [text(r.randint(length - 3, 3 * length), "abcdef ") for _ in range(6)]
    out = [(1, None), (2, ""), (3, "a" * (3 * length)), (4, "ab" * length), (5, "é" * length), (None, passage[0])]
    for i in range(60):
        out.append((10 + i, "".join(r.choice([text(r.randint(0, length), "abcdef "), r.choice(passage), r.choice(passage)[r.randint(0, length) :], text(3, "ab")]) for _ in range(r.randint(1, 6)))))
    return out + out[6:9] + [(11, text(400, "xyz") + passage[1])]


def got(df, **k):
    return sorted(str((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))) for r in S.remove_repeats(df, **k).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept").collect())


@pytest.mark.parametrize(("length", "gram", "run", "hot"), [(40, 8, 2000, 20_000), (40, 8, 2000, 2), (60, 8, 2000, 4), (200, 40, 1 << 20, 3), (30, 30, 1 << 20, 2)])
def test_equals_brute_force(spark, monkeypatch, length, gram, run, hot):
    monkeypatch.setattr(S, "HOT", hot)
    monkeypatch.setattr(S, "RUN_BYTES", run)
    monkeypatch.setattr(S, "CHUNK_BYTES", run)
    data = rows(length, length)
    df = spark.createDataFrame([(d, t, "z") for d, t in data], "doc_id long, text string, n_bytes string").repartition(3)
    assert got(df, length=length, gram=gram) == brute(data, length)


def test_hot_strings_reach_every_level(spark, monkeypatch):
    r = random.Random(1)
    text = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    header, passage = text(35), text(90)
    data = [(i, text(r.randint(20, 60)) + (header if i % 3 else passage) + text(r.randint(20, 60))) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    monkeypatch.setattr(S, "HOT", 5)
    texts = df.selectExpr("doc_id", "doc_id AS th", "text")
    hot = []
    for _ in range(2):
        hot.append(S.hot_strings(texts, 40, 8, hot))
        assert hot[-1] is not None
    levels = {row.part // 4 for row in S.sorted_runs(texts, 4, 40, 8, hot).collect()}
    assert levels == {0, 1, 2}
    assert got(df, length=40, gram=8) == brute(data, 40)


def test_equals_brute_force_on_documents(spark):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    data = list(zip(t["doc_id"], t["text"], strict=True))
    assert got(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(4)) == brute(data, 200)


def test_empty_table(spark):
    assert S.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_loser_tree_gives_order_and_common_prefixes():
    r = random.Random(0)
    for n in (1, 2, 3, 5, 8, 13):
        runs = [sorted((bytes(r.choice(b"ab") for _ in range(r.randint(1, 12))), b"", [(1, 2, 3)]) for _ in range(r.randint(1, 30))) for _ in range(n)]
        merged = list(S.merge_runs([S.decode_run(S.encode_run(x)) for x in runs]))
        assert [m[1] for m in merged] == sorted(e[0] for x in runs for e in x)
        last = b""
        for k, s, _, _ in merged:
            assert k == S.common_prefix(last, s)
            last = s


def test_anchors_cover_every_window_once():
    r = np.random.default_rng(0)
    texts = [r.integers(0, 3, n).astype(np.uint8) for n in (5, 30, 29, 200, 31)]
    ends = np.cumsum([len(t) for t in texts])
    at, _, low, high = S.anchors(np.concatenate(texts), ends, 30, 7)
    starts = [s for a, b in zip(low, high, strict=True) for s in range(a, b + 1)]
    want = [int(e) - len(t) + s for t, e in zip(texts, ends, strict=True) for s in range(len(t) - 29)]
    assert starts == want and all(b <= p <= a + 23 for p, a, b in zip(at, low, high, strict=True))
