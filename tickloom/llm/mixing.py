"""Mixing sources to target weights (operator 4), with DataFrame functions alone.

Method: temperature mixing. A source's weight is its token share to the power of an exponent, normalised; 1 keeps the shares, 0
makes all sources equal, more than 1 sharpens. The exponent is found by bisection (cut into `SECTIONS` parts at a time, so that
each pass over the source table is one aggregation) so that the weights reach a target entropy, or as small as a limit of
repetition allows: no source may be read more than `max_epochs` times. Each source then has a budget of tokens, which is realised
by a permutation of its documents in blocks: a hash of the document is its place in the permutation, leading digits of the hash
its block, and token sums before a document come from sums before its block and within it. Whole epochs take every document;
the last, partial epoch takes a prefix of the permutation. Every copy also gets the output block in which it is due, so that each
output block holds the sources in their weights.

Without `budget`, the budget is the smallest with which every source is read at least once, so no document is dropped. With one,
sources above their weight lose the end of their permutation, which is what a budget asks for.

No window spans a source: sums over its blocks see one row for `BLOCK_DOCS` documents, and windows over documents stay in a block.

Nulls and edges: a null source is the source without name (''); a null text has no tokens; a source without tokens keeps its documents
once; if a limit can't be met, the shares are kept (exponent 1); rows that repeat number and text are copies that stand side by
side; columns of the input pass through, those named like an added one are replaced; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import keep, numbered, remove

SECTIONS, PASSES = 32, 7
BLOCK_DOCS, OUT_TOKENS, MAX_EPOCHS = 4096, 1 << 20, 2.0
#: Sources up to which their table, a row each, is broadcast.
BROADCAST_SOURCES = 100_000
ADDED = ["n_tokens", "epoch", "block"]


def with_tokens(docs: DataFrame) -> DataFrame:
    """docs with n_tokens, its words: runs without the bytes 32 and 9 to 13."""
    return docs.withColumn("n_tokens", F.coalesce(F.expr(r"regexp_count(text, '[^\\x20\\x09-\\x0D]+')"), F.lit(0)).cast("long"))


def source_shares(docs: DataFrame) -> DataFrame:
    """_source, n_docs, tokens, share (null without tokens) of docs (source, n_tokens)."""
    sums = docs.groupBy(F.coalesce("source", F.lit("")).alias("_source")).agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("tokens"))
    total = sums.agg(F.sum("tokens").alias("total"))
    return sums.crossJoin(F.broadcast(total)).select("_source", "n_docs", "tokens", F.when(F.col("tokens") > 0, F.col("tokens") / F.col("total")).alias("share"), "total")  # total is one row


def _figures(shares: DataFrame, exponents: list[float], budget: int | None) -> list[tuple[float, float]]:
    """Entropy in nats and largest number of epochs at each exponent, by one aggregation."""
    p = F.col("share")
    cols = []
    for i, a in enumerate(exponents):
        cols += [F.sum(F.pow(p, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(p, F.lit(a)) * F.ln(p)).alias(f"l{i}"), F.max(F.pow(p, F.lit(a - 1))).alias(f"m{i}"), F.max(F.pow(p, F.lit(1 - a))).alias(f"c{i}")]
    r = shares.agg(F.max("total").alias("total"), *cols).first()
    out = []
    for i, a in enumerate(exponents):
        z = r[f"z{i}"]
        scale = budget / (r["total"] * z) if budget is not None else r[f"c{i}"]
        out.append((math.log(z) - a * r[f"l{i}"] / z, scale * r[f"m{i}"]))
    return out


def exponent(shares: DataFrame, target_entropy: float | None = None, max_epochs: float | None = MAX_EPOCHS, budget: int | None = None) -> float:
    """The exponent, rounded up to six decimals: for the entropy (nats), raised as far as the limit of epochs asks for."""
    if shares.filter("share > 0").isEmpty():
        return 1.0

    def bisect(low: float, high: float, reached) -> float:
        """The least exponent at which reached holds, which it does from there on."""
        for _ in range(PASSES):
            grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
            hits = [reached(f) for f in _figures(shares, grid, budget)]
            k = next((i for i, h in enumerate(hits) if h), None)
            if k is None or k == 0:
                return high if k is None else grid[0]
            low, high = grid[k - 1], grid[k]
        return high

    found = 0.0 if max_epochs is None else bisect(0.0, 1.0, lambda f: f[1] <= max_epochs * (1 + 1e-12))
    if target_entropy is not None:
        found = max(found, bisect(0.0, 64.0, lambda f: f[0] <= target_entropy))
    return math.ceil(found * 1e6 - 1e-4) / 1e6


def plan(shares: DataFrame, a: float, budget: int | None = None) -> DataFrame:
    """_source, n_docs, tokens, weight, budget, epochs (whole ones) and rest (tokens of the partial one) of each source."""
    p = F.pow("share", F.lit(a))
    sums = shares.agg(F.sum(p).alias("_z"), F.max(F.pow("share", F.lit(1 - a))).alias("_c"))
    rows = shares.crossJoin(F.broadcast(sums)).withColumn("weight", F.coalesce(p / F.col("_z"), F.lit(0.0)))  # sums is one row
    whole = F.lit(float(budget)) if budget is not None else F.col("total") * F.col("_c") * F.col("_z")
    rows = rows.withColumn("_e", F.when(F.col("share") > 0, F.round(F.col("weight") * whole / F.col("tokens"), 6)).otherwise(F.lit(1.0)))
    return rows.select(
        "_source", "n_docs", "tokens", "weight", F.floor("_e").alias("epochs"),
        F.floor((F.col("_e") - F.floor("_e")) * F.col("tokens")).alias("rest"),
        F.ceil(F.coalesce(whole, F.lit(0.0)) / OUT_TOKENS).alias("out_blocks"),
    )


def mix(docs: DataFrame, target_entropy: float | None = None, max_epochs: float | None = MAX_EPOCHS, budget: int | None = None, seed: str = "mix") -> DataFrame:
    """docs with n_tokens, a row for each copy: epoch from 0, and block, the output block in which the copy is due."""
    docs = with_tokens(docs.drop(*[c for c in docs.columns if c.lower() in ADDED]))
    shares, shares_path = keep(source_shares(docs), "shares")
    a = exponent(shares, target_entropy, max_epochs, budget)
    sources, _ = keep(plan(shares, a, budget), "mix")
    remove(docs.sparkSession, shares_path)
    near = F.broadcast(sources) if sources.count() <= BROADCAST_SOURCES else sources
    rows, own, back = numbered(docs)  # the input's columns can't clash with those of the plan
    doc_id, text, n_tokens = (F.col(own[c]) for c in ("doc_id", "text", "n_tokens"))
    place = F.md5(F.concat_ws("/", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit(""))).cast("binary"))
    rows = rows.withColumns({"_source": F.coalesce(F.col(own["source"]), F.lit("")), "_place": place}).join(near, "_source")
    blocks = F.ceil(F.col("n_docs") / BLOCK_DOCS)
    rows = rows.withColumn("_block", F.floor(F.conv(F.substring("_place", 1, 8), 16, 10).cast("double") / float(1 << 32) * blocks))
    sums = rows.groupBy("_source", "_block").agg(F.sum(n_tokens).alias("_t"))
    # a source's blocks meet in one task: a row for BLOCK_DOCS documents, which is fine up to 10**10 documents of one source
    before = sums.select(F.col("_source"), F.col("_block"), (F.sum("_t").over(Window.partitionBy("_source").orderBy("_block")) - F.col("_t")).alias("_before"))
    within = Window.partitionBy("_source", "_block").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_sum", F.sum(n_tokens).over(within)).join(before, ["_source", "_block"])
    rows = rows.withColumn("_at", F.col("_before") + F.col("_sum") - n_tokens)
    copies = F.col("epochs") + (F.col("_at") + n_tokens <= F.col("rest")).cast("int")
    rows = rows.withColumn("_copies", F.when(F.col("tokens") > 0, copies).otherwise(F.lit(1))).filter("_copies > 0")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_copies").cast("int") - 1)))
    due = (F.col("epoch") * F.col("tokens") + F.col("_at")) / (F.col("epochs") * F.col("tokens") + F.col("rest"))
    block = F.when(F.col("tokens") > 0, F.least(F.floor(due * F.col("out_blocks")), F.col("out_blocks") - 1)).otherwise(F.lit(0))
    return rows.withColumn("block", block.cast("long")).select(*back, "epoch", "block")


#: mix() with its defaults over documents; repetition by whole budgets gives the exponent in closed form.
MIX_SQL = r"""
WITH d AS (
    SELECT doc_id, source, coalesce(source, '') AS s, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_tokens,
        md5('mix/' || coalesce(doc_id::VARCHAR, '') || '/' || coalesce(text, '')) AS place
    FROM {documents}
),
t AS (SELECT s, sum(n_tokens)::BIGINT AS tokens FROM d GROUP BY s),
sh AS (SELECT *, CASE WHEN tokens > 0 THEN tokens / (SELECT sum(tokens)::DOUBLE FROM t) END AS share FROM t),
a AS (
    SELECT CASE WHEN max(share) <= 2 * min(share) THEN 0.0 ELSE ceil((1 - ln(2) / ln(max(share) / min(share))) * 1e6 - 1e-4) / 1e6 END AS a FROM sh
),
z AS (SELECT sum(share ** a) AS z, max(share ** (1 - a)) AS c, sum(tokens) AS total FROM sh, a),
p AS (
    SELECT s, tokens, total * c * z AS whole, CASE WHEN share > 0 THEN round(share ** a / z * (total * c * z) / tokens, 6) ELSE 1.0 END AS e FROM sh, a, z
),
pl AS (
    SELECT *, floor(e)::BIGINT AS epochs, floor((e - floor(e)) * tokens)::BIGINT AS rest, ceil(coalesce(whole, 0.0) / 1048576)::BIGINT AS out_blocks FROM p
),
r AS (
    SELECT d.*, pl.* EXCLUDE (s), coalesce(sum(n_tokens) OVER (PARTITION BY d.s ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
    FROM d JOIN pl ON d.s = pl.s
),
c AS (
    SELECT *, unnest(range(CASE WHEN tokens > 0 THEN epochs + CASE WHEN before + n_tokens <= rest THEN 1 ELSE 0 END ELSE 1 END)) AS epoch FROM r
)
SELECT doc_id, source, n_tokens, epoch::INT AS epoch,
    CASE WHEN tokens > 0 THEN least(floor((epoch * tokens + before) / (epochs * tokens + rest)::DOUBLE * out_blocks)::BIGINT, out_blocks - 1) ELSE 0 END AS block
FROM c
"""
