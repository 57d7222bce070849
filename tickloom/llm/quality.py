"""Quality classifier (operator 10): nearest-neighbour voting in a latent-semantic space.

Method: a text's terms are its byte pairs, hashed to `TERMS` columns, weighted by ln(1 + count) times the inverse document
frequency over all documents; two more columns are the shares of words that equal the word before them or the one before that. A bounded sample of labelled documents (`SAMPLE` of either class at most, chosen by a hash of the
document's number; the bound is this parameter) gives the latent space, the leading eigenvectors of its term matrix, and the
labelled vectors, which are broadcast: SAMPLE * 2 vectors of `LATENT` numbers, a few MB however large the corpus is. Every
document's cosines with all labelled vectors are computed exactly, a block of documents at a time, and the labels of its
`NEIGHBOURS` nearest vote with the cosine's power as weight, corrected so that the classes count as they do among all labels.

Only text is an input of a score. Labels are learnt from rows with crc32(doc_id as text) mod 3 other than 1.

Nulls and edges: an empty or null text, and any text when there are no labels, scores the share of label 1 (0.5 without labels);
null labels don't count; a document that is labelled twice counts with its lower label; a null doc_id is not held out; repeated
rows are scored each; columns of the input pass through, those named like an added one are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import STEP_BYTES, add_columns, map_texts, small_batches, steps, word_hashes

TERMS, LATENT, SAMPLE, NEIGHBOURS, SHARPNESS = 1024, 64, 3000, 25, 8
BLOCK = 256


def term_counts(texts: list[bytes]) -> np.ndarray:
    """How often each hashed byte pair occurs: a row for each text."""
    out = np.zeros((len(texts), TERMS), np.float32)
    for a, b in steps([len(t) for t in texts], STEP_BYTES // 4):
        for at in range(0, max(map(len, texts[a:b])), STEP_BYTES):
            raw = [t[at : at + STEP_BYTES + 1] for t in texts[a:b]]
            joined = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint32)
            if len(joined) < 2:
                continue
            row = np.repeat(np.arange(len(raw)), [len(t) for t in raw])
            pair = joined[:-1] * np.uint32(256) + joined[1:]
            term = (pair * np.uint32(0x9E3779B1)) >> np.uint32(32 - TERMS.bit_length() + 1)
            own = row[1:] == row[:-1]
            out[a:b] += np.bincount((row[:-1] * TERMS + term)[own], minlength=len(raw) * TERMS).reshape(len(raw), TERMS)
    return out


def repeats(texts: list[bytes]) -> np.ndarray:
    """For each text, the share of words that equal the previous one, and the one before that."""
    h, at = word_hashes(texts)
    out = np.zeros((len(texts), 2), np.float32)
    for lag in (1, 2):
        same = np.zeros(len(h) + 1, np.int64)
        np.cumsum(h[lag:] == h[:-lag], out=same[lag + 1 :])
        first = np.minimum(at[:-1] + lag, at[1:])
        out[:, lag - 1] = (same[at[1:]] - same[first]) / np.maximum(1, np.diff(at))
    return out


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many documents each term occurs, and the number of documents; over all of them."""
    small_batches(docs.sparkSession)
    schema = "term int, n long"

    def run(batches):
        total, n = np.zeros(TERMS + 1, np.int64), 0
        for batch in batches:
            texts = [x.encode("utf-8") if x else b"" for x in batch.column(0).to_pylist()]
            for a, b in steps([len(t) for t in texts]):
                total[:TERMS] += (term_counts(texts[a:b]) > 0).sum(0)
            n += len(texts)
        total[TERMS] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(TERMS + 1), pa.int32()), pa.array(total, pa.int64())], names=["term", "n"])

    sums = docs.select("text").mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("n")).collect()  # TERMS + 1 rows
    out = np.zeros(TERMS + 1)
    for r in sums:
        out[r["term"]] = r["n"]
    return out[:TERMS], int(out[TERMS])


@dataclass
class Model:
    idf: np.ndarray
    space: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    prior: float

    def latent(self, texts: list[bytes]) -> np.ndarray:
        return _unit(terms(term_counts(texts), repeats(texts), self.idf) @ self.space)

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        for a in range(0, len(texts) if k else 0, BLOCK):
            x = self.latent(texts[a : a + BLOCK])
            cos = x @ self.vectors.T
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            w = np.clip(np.take_along_axis(cos, near, 1), 0, 1).astype(np.float64) ** SHARPNESS * self.weights[near]
            total = w.sum(1)
            some = total > 1e-12
            out[a : a + len(x)][some] = (w * self.labels[near]).sum(1)[some] / total[some]
        return np.clip(out, 0, 1)


def terms(counts: np.ndarray, shares: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return _unit(np.hstack([_unit(np.log1p(counts) * idf), shares]))


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 1e-12).astype(np.float32)


def held_out(doc_id: F.Column) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(3)) == 1


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Model:
    """The model from all documents' term statistics and a sample of the labels that aren't held out."""
    df, n = document_frequencies(docs)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min(label).alias("y")).filter(~held_out(F.col("doc_id")))
    totals = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    chosen = None
    for y in totals:
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    prior = totals.get(1, 0) / max(1, sum(totals.values())) if totals else 0.5
    rows = []
    if chosen is not None:
        texts = docs.select(F.col("doc_id"), "text").join(F.broadcast(chosen), "doc_id")  # 2 * sample rows at most

        def step(batch, got):
            return {"doc_id": batch.column("doc_id"), "y": batch.column("y"), "counts": [x.tobytes() for x in np.hstack([term_counts(got), repeats(got)]).astype("<f4")]}

        schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("y", T.IntegerType()), T.StructField("counts", T.BinaryType())])
        found = map_texts(texts.select(F.col("doc_id").cast("long"), F.col("y").cast("int").alias("y"), "text"), "text", schema, step)
        # of rows that repeat a number one counts, so 2 * sample rows at most come to the driver
        rows = found.groupBy("doc_id").agg(F.max(F.struct("counts", "y")).alias("r")).select("r.*").collect()
    if not rows:
        none = np.zeros((0, LATENT), np.float32)
        return Model(idf, np.zeros((TERMS + 2, LATENT), np.float32), none, np.zeros(0), np.zeros(0), prior)
    rows.sort(key=lambda r: (r["y"], bytes(r["counts"])))
    y = np.array([r["y"] for r in rows])
    raw = np.stack([np.frombuffer(r["counts"], "<f4") for r in rows])
    x = terms(raw[:, :TERMS], raw[:, TERMS:], idf)
    _, vectors = np.linalg.eigh((x.T @ x).astype(np.float64))
    space = vectors[:, ::-1][:, :LATENT].astype(np.float32)
    drawn = np.array([(y == 0).sum(), (y == 1).sum()])
    weight = np.array([totals.get(c, 0) / max(1, drawn[c]) for c in (0, 1)])
    weight = weight / weight.max()
    return Model(idf, space, _unit(x @ space), y.astype(float), weight[y], prior)


ADDED = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def score(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score (0 to 1, higher: label 1 is likelier) and predicted (1 if the score is at least 0.5)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def step(_rows, texts):
        s = np.round(sent.value.score(texts), 6)
        return {"score": s, "predicted": (s >= 0.5).astype(np.int32)}

    return add_columns(docs, "text", ADDED, step)


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality") -> DataFrame:
    """docs with held_out, score and predicted."""
    return score(docs, fit(docs, labels, label)).withColumn("held_out", held_out(F.col("doc_id")))
