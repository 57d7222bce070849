"""Columns of the input pass through whatever they are called, those of the operators' own tables included."""

import pytest

from tickloom.llm import line_dedup, minhash, mixing, quality, suffix_dedup

NAMES = [
    "tokens", "weight", "n_docs", "budget", "epochs", "rest", "out_blocks", "share", "total", "_source", "_place", "_block", "_t", "_before", "_sum", "_at", "_copies", "th", "_th", "_doc", "_d",
    "_spans", "_text_hash", "_h", "_gone", "_twice", "_n", "shard", "salt", "hi", "lo", "first", "past", "node", "component", "count", "kept_", "d0", "d1", "D2", "y", "counts",
]
ROWS = [(i, f"a common line\nline of {i % 7} with words one two three four {i % 3}\n" + "x" * (i % 4), "ab"[i % 2]) for i in range(24)] + [(3, "again", "a"), (None, None, None)]
OPERATORS = {
    "mixing": mixing.mix,
    "line_dedup": line_dedup.dedup_lines,
    "line_dedup routed": lambda d: line_dedup.dedup_lines(d, index_bytes=0),
    "suffix_dedup": lambda d: suffix_dedup.remove_repeats(d, length=40),
    "minhash": minhash.keep_one,
    "quality": lambda d: quality.score(d, quality.fit(d, d.sparkSession.createDataFrame([(0, 1), (1, 0)], "doc_id long, quality int"))),
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_extra_columns_pass(spark, name):
    plain = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    extra = spark.createDataFrame([(*r, *[f"{c}{i}" for c in NAMES]) for i, r in enumerate(ROWS)], "doc_id long, text string, source string, " + ", ".join(f"`{c}` string" for c in NAMES))
    want, got = OPERATORS[name](plain), OPERATORS[name](extra)
    assert set(got.columns) == set(want.columns) | set(NAMES)
    key = lambda rows: sorted(str([r[c] for c in want.columns]) for r in rows)
    rows = got.collect()
    assert key(rows) == key(want.collect())
    numbers = {str(r[:3]): {i for i, x in enumerate(ROWS) if x == r} for r in ROWS}
    for r in rows:  # an input row's columns stay together
        i = int(r["tokens"][6:])
        assert all(r[c] == f"{c}{i}" for c in NAMES) and ROWS[i][0] == r["doc_id"] and i in numbers[str(ROWS[i])]
