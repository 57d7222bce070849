"""WARC archives with an index of byte ranges (operator 7).

Method: index first. Every task writes its records to an archive of its own in the shared folder, through the file system that
the folder's address names, and returns one index row for each record: file, offset, length, URL, digest. The index is kept as
a table; files of tasks that failed half-way appear in no index row, so a lost executor costs only a new archive. A reader
selects index rows (by URL, type, digest, anything), sorts them by file and offset, coalesces neighbours into byte-range reads of
bounded size, and parses just those bytes.

Records with equal payloads: the one with the largest page_id is the response, the others are revisits that name it; this takes
an aggregation by digest, whose partial sums shrink a frequent payload before the shuffle. A record is a gzip member of its own,
as the WARC standard recommends, so every record can be read alone.

Nulls and edges: a null html is an empty payload; payloads under `min_bytes` are responses whatever they equal; a null URL leaves
the URL header out; a null page_id is a page without number, its digest counts but it is named by nothing; rows that repeat both
the number and the payload of a response are responses too; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import arrow_schema, keep, new_path, small_batches

#: Bytes of one range read, at most, beyond a single longer record; gaps between selected records up to this are read over.
READ_BYTES, GAP_BYTES = 4 << 20, 64 << 10
DATE = "2000-01-01T00:00:00Z"

INDEX = T.StructType(
    [T.StructField(n, t) for n, t in [("file", T.StringType()), ("offset", T.LongType()), ("length", T.LongType()), ("url", T.StringType()), ("digest", T.StringType()), ("record_type", T.StringType()), ("page_id", T.LongType())]]
)
RECORDS = T.StructType(
    [T.StructField(n, t) for n, t in [("page_id", T.LongType()), ("url", T.StringType()), ("record_type", T.StringType()), ("refers_to", T.LongType()), ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("payload", T.BinaryType())]]
)


def file_system(path: str):
    """The pyarrow file system of a shared folder's address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def digest32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, payload: bytes, kind: str, refers_to: int | None, digest: str, compress: bool = True) -> bytes:
    """A response or revisit record. A revisit has the HTTP header alone and says in its own header how long the payload is."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + (payload if kind == "response" else b"")
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    head.append(f"WARC-Payload-Digest: sha1:{digest}")
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>", f"WARC-Payload-Length: {len(payload)}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    raw = b"WARC/1.1\r\n" + "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"
    return gzip.compress(raw, 1, mtime=0) if compress else raw


def parse(raw: bytes) -> dict:
    """The fields of one record; payload is None for a revisit. The digest and length of a response are its payload's own."""
    if raw[:2] == b"\x1f\x8b":
        raw = zlib.decompress(raw, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    field = dict(x.split(": ", 1) for x in lines[1:])
    body = rest[: int(field["Content-Length"])]
    number = lambda name: int(x) if (x := field[name][len("<urn:page:") : -1]) else None
    out = {"page_id": number("WARC-Record-ID"), "url": field.get("WARC-Target-URI"), "record_type": field["WARC-Type"], "refers_to": None}
    if field["WARC-Type"] == "revisit":
        return out | {"refers_to": number("WARC-Refers-To"), "payload_bytes": int(field["WARC-Payload-Length"]), "payload_digest": field["WARC-Payload-Digest"].partition(":")[2], "payload": None}
    payload = body.partition(b"\r\n\r\n")[2]
    return out | {"payload_bytes": len(payload), "payload_digest": digest32(hashlib.sha1(payload).digest()), "payload": payload}


def typed(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, html (null where it isn't needed), n_bytes, sha1, record_type, refers_to."""
    own = pages.select(F.col("page_id").cast("long"), "url", F.coalesce("html", F.lit("")).cast("binary").alias("html"))
    own = own.withColumns({"sha1": F.sha1("html"), "n_bytes": F.length("html").cast("long")})
    last = own.filter(F.col("n_bytes") >= min_bytes).groupBy("sha1").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to")) & (F.col("n_bytes") >= min_bytes)
    joined = own.join(last, "sha1", "left")
    return joined.select("page_id", "url", "html", "n_bytes", "sha1", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("refers_to")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = 0, compress: bool = True) -> DataFrame:
    """Writes pages (page_id, url, html) as archives in a shared folder; returns the index, which is kept as a table."""
    spark = pages.sparkSession
    small_batches(spark)
    to = folder or new_path(spark, "warc")
    schema = arrow_schema(INDEX)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(to)
        out = name = None
        at = 0
        try:
            for batch in batches:
                if out is None:
                    system.create_dir(root, recursive=True)
                    name = f"{root}/{uuid.uuid4().hex}.warc" + ".gz" * compress
                    out = system.open_output_stream(name, compression=None)
                rows = []
                for r in batch.to_pylist():
                    digest = digest32(bytes.fromhex(r["sha1"]))
                    raw = record(r["page_id"], r["url"], r["html"], r["record_type"], r["refers_to"], digest, compress)
                    out.write(raw)
                    rows.append({"file": name.rpartition("/")[2], "offset": at, "length": len(raw), "url": r["url"], "digest": digest, "record_type": r["record_type"], "page_id": r["page_id"]})
                    at += len(raw)
                yield pa.RecordBatch.from_pylist(rows, schema=schema)
        finally:
            if out is not None:
                out.close()

    index, _ = keep(typed(pages, min_bytes).mapInArrow(run, INDEX), "warc-index")
    return index.withColumn("file", F.concat(F.lit(to.rstrip("/") + "/"), "file"))


def ranges(rows: Iterator[tuple[str, int, int]]) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Coalesces (file, offset, length) in order: (file, begin, end, records in it)."""
    file, begin, end, inside = None, 0, 0, []
    for f, o, n in rows:
        if inside and (f != file or o - end > GAP_BYTES or o < begin or max(end, o + n) - begin > READ_BYTES):
            yield file, begin, end, inside
            inside = []
        if not inside:
            file, begin, end = f, o, o
        inside.append((o, n))
        end = max(end, o + n)
    if inside:
        yield file, begin, end, inside


def read_records(index: DataFrame, payloads: bool = True) -> DataFrame:
    """The records that the rows of an index select: RECORDS' columns, payload null for revisits and if not asked for."""
    small_batches(index.sparkSession)
    schema = arrow_schema(RECORDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = None, None

        def rows():
            for b in batches:
                yield from zip(*(b.column(i).to_pylist() for i in range(3)), strict=True)

        for file, begin, end, inside in ranges(rows()):
            if opened[0] != file:
                system, path = file_system(file)
                opened = file, system.open_input_file(path)
            opened[1].seek(begin)
            raw = opened[1].read(end - begin)
            got = [parse(raw[o - begin : o - begin + n]) for o, n in inside]
            yield pa.RecordBatch.from_pylist([r | {"payload": r["payload"] if payloads else None} for r in got], schema=schema)

    chosen = index.select("file", "offset", "length")
    return chosen.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(run, RECORDS)


def round_trip(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Writes the pages and reads all records back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    read = read_records(write_archives(pages, min_bytes=min_bytes), payloads=False)
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
