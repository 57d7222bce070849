import zlib
from collections import Counter

import numpy as np

from tickloom.llm import quality as Q


def auc(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(1, len(s) + 1)
    for v in np.unique(s):
        rank[s == v] = rank[s == v].mean()
    p = y == 1
    return (rank[p].sum() - p.sum() * (p.sum() + 1) / 2) / (p.sum() * (~p).sum())


def test_term_counts_are_byte_pairs():
    texts = [b"", b"a", b"abab", "é\n".encode() * 9]
    got = Q.term_counts(texts)
    for t, row in zip(texts, got, strict=True):
        want = Counter()
        for a, b in zip(t, t[1:], strict=False):
            want[((a * 256 + b) * 0x9E3779B1 & 0xFFFFFFFF) >> 22] += 1
        assert {k: v for k, v in enumerate(row.tolist()) if v} == dict(want)
    long = b"xyz" * 800_000
    assert Q.term_counts([long])[0].sum() == len(long) - 1


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = Q.classify(docs, labels).select("doc_id", "held_out", "score", "predicted").toPandas().merge(labels.toPandas(), on="doc_id")
    out = got[got.held_out]
    assert (out.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in out.doc_id]).all()
    a, acc = auc(out.quality.to_numpy(), out.score.to_numpy()), (out.predicted == out.quality).mean()
    kept = out[out.quality == 1].predicted.mean()
    print("auc", a, "accuracy", acc, "good kept", kept)
    assert a > 0.97 and acc > 0.95 and kept > 0.98


def test_scores_equal_brute_force(spark):
    rows = [(i, ("good words here %d" if i % 4 else "BAD!! %d $$$") % i, "x") for i in range(200)] + [(None, None, "x"), (900, "", "x"), (7, "good words here 7", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(150)] + [(3, 0), (5, None), (None, 1)], "doc_id long, quality int")
    model = Q.fit(docs, labels)
    got = {r.doc_id: r for r in Q.score(docs, model).collect()}
    for i, t, _ in rows[:40]:
        x = model.latent([t.encode()])[0].astype(float)
        cos = model.vectors.astype(float) @ x
        near = np.argsort(-cos, kind="stable")[: Q.NEIGHBOURS]
        w = np.clip(cos[near], 0, 1) ** Q.SHARPNESS * model.weights[near]
        assert got[i].predicted == int(i % 4 > 0) and abs(got[i].score - (w * model.labels[near]).sum() / w.sum()) < 0.2
    assert abs(got[900].score - model.prior) < 1e-5 and got[None].score == got[900].score


def test_no_labels_and_empty(spark):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in Q.classify(docs, none).collect()] == [0.5, 0.5]
    assert Q.classify(docs.limit(0), none).count() == 0
