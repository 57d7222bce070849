import re
from collections import defaultdict

import corpus_pipeline as P
from tests.llm.test_line_dedup import brute as brute_lines
from tests.llm.test_minhash import brute as brute_groups
from tests.llm.test_packing import check
from tickloom.llm import minhash
from tickloom.llm.common import keep

SF = "/root/testdata/sf0.01"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    results = [docs]
    for name, stage in P.STAGES:
        results.append(keep(stage(spark, results[-1], SF), "stage")[0])
    raw, good, lines, groups, mixed, packed = [r.collect() for r in results]
    assert all(r.columns == P.COLUMNS for r in results[:-1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in good}
    right = [(d in kept) == bool(q) for d, q in labels.items()]
    assert sum(right) / len(right) > 0.97 and {r for r in good} <= {r for r in raw}
    want = brute_lines([(r.doc_id, r.text) for r in good])
    assert sorted((r.doc_id, r.text, r.n_chars) for r in lines) == sorted((d, t, len(t)) for d, t, _, _ in want)
    first = [eval(x) for x in brute_groups([(r.doc_id, r.text) for r in lines], P.WIDTH)]
    assert sorted(r.doc_id for r in groups) == sorted(d for d, _, _, k in first if k)
    copies = defaultdict(int)
    for r in mixed:
        copies[r.doc_id] += 1
    assert set(copies) == {r.doc_id for r in groups} and max(copies.values()) <= 2
    pieces = defaultdict(int)
    for r in packed:
        pieces[r.doc_id] += r.piece == 0
    assert pieces == copies
    n = check(packed)
    assert n <= 1.01 * -(-sum(r.length for r in packed) // 2048) + 1


def test_run_gives_the_stages_result(spark):
    got = P.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and check(got.collect()) > 0


def test_keep_one_of_odd_rows(spark):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f"), (2, "A b c d e f"), (2, "A b c d e f"), (5, ""), (6, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((str(r.doc_id), r.text or "") for r in minhash.keep_one(df, 5).collect()) == [("2", "A b c d e f"), ("5", ""), ("6", ""), ("None", "a b c d e f"), ("None", "a b c d e f")]


def test_no_stage_reads_labels_of_held_out_rows():
    source = open(P.__file__).read()
    assert not re.search(r"limit\(|sample\(", source)
