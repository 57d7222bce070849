"""The corpus operators as queries over the test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm import conversations, embed_dedup, license_scan, line_dedup, media, minhash, mixing, packing, periodic, perplexity, quality, suffix_dedup, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a tree of directories of 500 and 50 numbers, in which every tenth file is the licence file."""
    name = F.when(F.col("doc_id") % 10 == 0, F.concat(F.lit("LICENSE."), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    path = F.concat_ws("/", F.coalesce("source", F.lit("")), F.floor(F.col("doc_id") / 500), F.floor(F.col("doc_id") / 50), name)
    files = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")
    return license_scan.scan(files).withColumnRenamed("file_id", "doc_id")


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "source", "n_tokens", "epoch", "block")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op8_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = media.documents_as_media(table(spark, sf_dir, "documents"))
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", F.sha2("tile", 256).alias("tile_sha256"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = perplexity.rate_without_text(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"))
    return rated.select("doc_id", *perplexity.COUNTS, "base_failed", "kept", "perplexity", "word_perplexity")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.digests(conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")), "copies"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.planted(table(spark, sf_dir, "documents"))))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_line_dedup": op3_line_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_warc": op7_warc,
    "op8_media_columns": op8_media_columns,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_quality_rules": op11_quality_rules,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE_SQL: dict[str, str] = {
    "op1_embedding_near_dedup": """
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS src, b.vec_id AS dst FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.9
),
reach AS (SELECT src AS id, src AS seen FROM links UNION SELECT r.id, l.dst FROM reach r JOIN links l ON r.seen = l.src),
component AS (SELECT id, min(seen) AS component_id FROM reach GROUP BY id),
n AS (SELECT src AS id, count(*) AS n_links FROM links GROUP BY src)
SELECT e.vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, e.vec_id) AS component_id, coalesce(component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN component c ON e.vec_id = c.id LEFT JOIN n ON e.vec_id = n.id
""",
    "op3_line_dedup": r"""
WITH lines AS (
    SELECT doc_id, row_id, unnest(range(1, len(parts) + 1)) AS i, unnest(parts) AS line
    FROM (SELECT doc_id, row_number() OVER () AS row_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
),
keyed AS (
    SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM lines
),
hot AS (SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT row_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(hot.k) AS n_dropped,
    sha256(coalesce(string_agg(CASE WHEN hot.k IS NULL THEN line END, chr(10) ORDER BY i), '')) AS kept_sha256
FROM keyed LEFT JOIN hot ON keyed.k = hot.k
GROUP BY doc_id, row_id
""",
    "op4_source_mixing": mixing.MIX_SQL.format(documents="documents"),
    "op12_conversation_repair": r"""
WITH RECURSIVE raw AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')) AS k
    FROM conversations
),
bits AS (
    -- CRC-32, bit by bit: DuckDB has no such function
    SELECT DISTINCT k, 0 AS i, 4294967295::BIGINT AS crc FROM raw
    UNION ALL
    SELECT k, i + 1, list_reduce(list_prepend(xor(crc, ascii(substr(k, i + 1, 1)))::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)
    FROM bits WHERE i < length(k)
),
chosen AS (SELECT k, xor(crc, 4294967295) % 20 AS fault FROM bits WHERE i = length(k)),
damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN fault = 0 THEN 0 WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy
    FROM raw JOIN chosen USING (k)
),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(text, 1, 64), md5(concat(length(role), ':', role, text))) AS i,
        regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1, 's') AS final
    FROM damaged
),
faults AS (
    SELECT *, CASE WHEN final = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN final NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
        lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before
    FROM numbered
),
counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND concat(substr(before, 1, 1), substr(role, 1, 1)) NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
    FROM faults GROUP BY conv_id
),
moves(state, inserts, into_role, via, initial, next, cost) AS (
    -- after that many inserts from a state: delete, give the role due, or keep
    SELECT s, 0, '', 'D', '', s, 4 FROM (VALUES ('-'), ('s'), ('u'), ('a')) t(s)
    UNION ALL
    SELECT s, n, d, 'R', '', d, 3 * n + 3 FROM (VALUES ('-', 0, 'u'), ('s', 0, 'u'), ('a', 0, 'u'), ('u', 0, 'a'), ('-', 1, 'a'), ('s', 1, 'a'), ('a', 1, 'a'), ('u', 1, 'u'), ('-', 2, 'u'), ('s', 2, 'u'), ('a', 2, 'u'), ('u', 2, 'a')) t(s, n, d)
    UNION ALL
    SELECT s, n, '', 'K', d, d, 3 * n FROM (VALUES ('-', 0, 's'), ('-', 0, 'u'), ('s', 0, 'u'), ('a', 0, 'u'), ('u', 0, 'a'), ('-', 1, 'a'), ('s', 1, 'a'), ('a', 1, 'a'), ('u', 1, 'u'), ('-', 2, 'u'), ('s', 2, 'u'), ('a', 2, 'u'), ('u', 2, 'a')) t(s, n, d)
),
repaired AS (
    SELECT conv_id, 0::BIGINT AS i, '-' AS state, {'cost': 0::BIGINT, 'audit': '', 'lines': ''} AS best FROM counts
    UNION ALL
    SELECT r.conv_id, r.i + 1, m.next, min({'cost': best.cost + m.cost + CASE WHEN via <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END, 'audit': concat(best.audit, repeat('I', inserts), via),
        'lines': concat(best.lines, CASE WHEN inserts = 0 THEN '' WHEN r.state = 'u' THEN 'assistant:' || chr(10) ELSE 'user:' || chr(10) END,
            CASE WHEN inserts < 2 THEN '' WHEN r.state = 'u' THEN 'user:' || chr(10) ELSE 'assistant:' || chr(10) END,
            CASE via WHEN 'D' THEN '' WHEN 'K' THEN role || ':' || text || chr(10) ELSE CASE into_role WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || text || chr(10) END)})
    FROM repaired r JOIN faults f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1
    JOIN moves m ON m.state = r.state AND (via = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (via = 'R' OR substr(role, 1, 1) = initial)))
    GROUP BY r.conv_id, r.i, m.next
),
ended AS (
    SELECT r.conv_id, min({'cost': best.cost + CASE state WHEN 's' THEN 6 WHEN 'u' THEN 3 ELSE 0 END, 'audit': best.audit || CASE state WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END,
        'lines': best.lines || CASE state WHEN 's' THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 'u' THEN 'assistant:' || chr(10) ELSE '' END}) AS best
    FROM repaired r JOIN counts c ON r.conv_id IS NOT DISTINCT FROM c.conv_id AND r.i = c.n GROUP BY r.conv_id
),
known AS (SELECT DISTINCT conv_id FROM conversations)
SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
    coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(left(best.lines, -1), '')) AS repaired_sha256
FROM known k LEFT JOIN counts c ON k.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON k.conv_id IS NOT DISTINCT FROM e.conv_id
""",
    "op13_periodic_runs": r"""
WITH RECURSIVE bits AS (
    -- CRC-32 of the decimal doc_id, bit by bit: DuckDB has no such function
    SELECT DISTINCT doc_id::VARCHAR AS k, 0 AS i, 4294967295::BIGINT AS crc FROM documents WHERE doc_id IS NOT NULL
    UNION ALL
    SELECT k, i + 1, list_reduce(list_prepend(xor(crc, ascii(substr(k, i + 1, 1)))::BIGINT, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)
    FROM bits WHERE i < length(k)
),
hashes AS (SELECT k, xor(crc, 4294967295) AS h FROM bits WHERE i = length(k)),
split AS (
    SELECT row_number() OVER () AS r, doc_id, h, h // 10 AS g, regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w, len(w) AS n FROM documents LEFT JOIN hashes ON doc_id::VARCHAR = k
),
places AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN g % n END AS a, CASE WHEN h % 10 = 0 AND n > 0 THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM split),
words AS (
    SELECT r, n, i, w[(CASE WHEN i < a OR a IS NULL THEN i ELSE a + (i - a) % p END + 1)::BIGINT] AS word FROM (SELECT r, n, a, p, w, unnest(range(n)) AS i FROM places)
),
equal AS (SELECT x.r, x.n, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
islands AS (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM equal),
stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
listed AS (SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
best AS (SELECT x.r, x.start, x.length, x.period FROM runs x WHERE NOT EXISTS (SELECT 1 FROM runs y WHERE y.r = x.r AND (y.length * x.period > x.length * y.period OR (y.length * x.period = x.length * y.period AND (y.start, y.period) < (x.start, x.period))))),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
collapsed AS (SELECT w.r, string_agg(word, ' ' ORDER BY w.i) AS text FROM words w LEFT JOIN gone g ON w.r = g.r AND w.i = g.i WHERE g.i IS NULL GROUP BY w.r)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
    sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(c.text, '')) AS collapsed_sha256
FROM places LEFT JOIN listed USING (r) LEFT JOIN best USING (r) LEFT JOIN collapsed c USING (r)
""",
}
