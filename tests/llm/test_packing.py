import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tickloom.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [None, "", " ", "a", "Don't STOP 12 été's\x85x\x1cy <|endoftext|> <|startoftext|>abc", "word " * 3000, "same text"] + ["same text"] * 5 + ["É́ İstanbul ΣΑΣ, foo;bar...\t\n\n x"]


def test_ids_equal_the_tokenizers():
    t = Tokenizer.from_file(PATH)
    got = packing.WordIds(PATH)(pa.array([x or "" for x in TEXTS]))
    for text, ids in zip(TEXTS, got, strict=True):
        assert ids.tolist() == t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAbéÉ's.,!<|>İ# \n\t\x1c\x85 ́Σ1²ſ")), max_size=30))
def test_ids_of_odd_texts(text):
    t = packing.word_ids(PATH)
    assert t(pa.array([text]))[0].tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids


def test_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_PARTS", 30)
    t = packing.WordIds(PATH)
    for k in range(20):
        text = " ".join(f"{chr(97 + (i * 7 + k) % 26)}{chr(97 + i)}o&&& &&& x{i}." for i in range(12))
        assert t(pa.array([text]))[0].tolist() == t.tokenizer.encode(text, add_special_tokens=False).ids


def check(rows, capacity=2048):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(seqs)


def test_packs_every_piece_once(spark):
    df = spark.createDataFrame([(i if i else None, t, i) for i, t in enumerate(TEXTS)], "doc_id long, text string, length int")
    rows = packing.pack_documents(df).collect()
    t = Tokenizer.from_file(PATH)
    want = []
    for i, text in enumerate(TEXTS):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        for k, a in enumerate(range(0, len(ids), 2048)):
            part = np.array(ids[a : a + 2048], "<u4").tobytes()
            want.append((i or None, k, a, len(part) // 4, zlib.crc32(part)))
    assert sorted(map(str, want)) == sorted(str(tuple(r)[:5]) for r in rows)
    n = check(rows)
    assert n == -(-sum(r.length for r in rows) // 2048)
    seqs = packing.sequences(df).collect()
    assert sum(len(s.ids) // 4 for s in seqs) == sum(r.length for r in rows)


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.integers(1, 50), st.integers(1, 30), max_size=20))
def test_sweeps_place_all(counts):
    plan, total = packing.sweeps(counts, 50)
    used = defaultdict(list)
    placed = defaultdict(list)
    for length, rank, n, first, offset in plan:
        for i in range(n):
            used[first + i].append((offset, length))
            placed[length].append(rank + i)
    assert {k: sorted(v) for k, v in placed.items()} == {k: list(range(v)) for k, v in counts.items()}
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 50
    assert len(used) == total
    tokens = sum(k * v for k, v in counts.items())
    assert total <= 1.25 * (tokens / 50) + 2 or total <= sum(v for k, v in counts.items() if k > 25) + 2 + 2 * tokens / 50
