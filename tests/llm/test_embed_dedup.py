import glob

import numpy as np
import pyarrow.dataset as ds
import pytest

from tickloom.llm import embed_dedup as D


def brute(rows, cosine=0.9):
    ok = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    scaled = {i: np.array(rows[i][1], np.float64) / np.abs(rows[i][1]).max() for i in ok}
    unit = {i: v / np.linalg.norm(v) for i, v in scaled.items()}
    links = {i: [j for j in ok if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine] for i in ok}
    out = []
    for i, (d, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None) if d is not None else None
        out.append((d, len(links.get(i, ())), c, d is None or c == d))
    return sorted(map(str, out))


def rows():
    rng = np.random.default_rng(5)
    out = [(1, None), (2, []), (3, [0.0] * 16), (4, [float("nan")] * 16), (5, [1.0] * 15 + [None]), (6, [float("inf")] + [1.0] * 15), (None, [1.0] * 16), (7, [1.0] * 8), (8, [2.0] * 8)]
    n = 20
    for size, noise in ((60, 0.02), (40, 0.2), (30, 0.35), (1, 0)):
        base = rng.normal(size=16)
        base /= np.linalg.norm(base)
        for _ in range(size):
            out.append((n, (base + noise * rng.normal(size=16) / 4).tolist()))
            n += 1
    out += [(n + i, rng.normal(size=16).tolist()) for i in range(80)]
    return out + out[20:24] + [(7, [1.0] * 8), (9, [1e200] * 16), (10, [1e-200] * 16)]


@pytest.mark.parametrize(("list_rows", "block"), [(10, 7), (1000, 4096)])
def test_equals_brute_force(spark, list_rows, block):
    data = rows()
    df = spark.createDataFrame([(d, v, 1) for d, v in data], "vec_id long, embedding array<double>, n_links int")
    got = D.near_vectors(df, list_rows=list_rows, block=block, probes=6).collect()
    assert sorted(str(tuple(r)) for r in got) == brute(data)


def test_recall_on_embeddings(spark):
    path = "/root/testdata/sf0.1/embeddings.parquet"
    t = ds.dataset(path).to_table()
    x = np.stack(t.column("embedding").to_numpy()).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = ((x @ x.T) >= 0.9).sum() - len(x)
    got = sum(r.n_links for r in D.near_vectors(spark.read.parquet(path), list_rows=64).select("n_links").collect())
    assert want == 0 or 0.99 <= got / want <= 1.0


def test_empty_tables(spark):
    assert D.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    got = D.near_vectors(spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")).collect()
    assert [(r.n_links, r.component_id, r.kept) for r in sorted(got)] == [(0, 1, True), (0, 2, True)]


def test_quantiser_bounds_distances():
    x = np.random.default_rng(0).normal(size=(500, 12))
    q = D.Quantiser.fit(x, 5)
    at = D.nearest(x, q.centres, 1)[:, 0]
    codes, error = q.encode(x, at)
    own = np.flatnonzero(at == 2)
    true = np.linalg.norm(x[:50, None] - x[own][None], axis=2)
    assert (q.distances(x[:50], 2, codes[own]) - error[own] <= true + 1e-9).all()


def test_all_links_with_many_lists(spark):
    """A group of near copies (cosines of about 0.95) of a third of the rows, and planted pairs at 0.901, in far more lists than a few probes."""
    rng = np.random.default_rng(11)
    base = rng.normal(size=32)
    base /= np.linalg.norm(base)
    group = base + rng.normal(size=(500, 32)) * np.sqrt((1 / 0.95 - 1) / 32)
    one = rng.normal(size=(500, 32))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    side = rng.normal(size=one.shape)
    side -= (side * one).sum(1, keepdims=True) * one
    two = 0.901 * one + np.sqrt(1 - 0.901**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    x = np.vstack([group, one, two])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = ((u @ u.T) >= 0.9).sum(1) - 1
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in D.near_vectors(df, list_rows=15, block=200).collect()}
    assert [got[i].n_links for i in range(len(x))] == want.tolist() and want[:500].sum() > 100_000
    assert all(got[500 + i].component_id == got[1000 + i].component_id for i in range(500))
