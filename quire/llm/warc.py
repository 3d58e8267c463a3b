"""WARC archives as a table of chunks.

Writing: every record is one gzip member of an archive file in the shared
folder, streamed piece by piece while its digest grows; equal payloads are
stored once and revisited. Reading: archives are streamed in blocks and come
out as rows (record, chunk number), each with the digest and length so far, so
no reader ever holds a whole record and the last chunk of a record knows its
full digest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import scratch_path

from .common import table, written

CHUNK = 64 << 10
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """Filesystem and path of a folder named as Hadoop does."""
    if uri.startswith("file:"):
        uri = "/" + uri[5:].lstrip("/")
    if uri.startswith("s3a:"):
        uri = "s3:" + uri[4:]
    return pafs.FileSystem.from_uri(uri)


def base32(hexdigest: str) -> str:
    return base64.b32encode(bytes.fromhex(hexdigest)).decode()


def plan_records(pages: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """Per distinct (page_id, payload): payload_bytes, sha1 (hex), record_type
    and refers_to. Of equal payloads of at least ``min_revisit_bytes`` the
    largest page_id is the response. Only digests are shuffled."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    meta = pages.select("page_id", F.octet_length(payload).cast("long").alias("payload_bytes"),
                        F.sha1(payload).alias("sha1"))
    keepers = meta.groupBy("sha1", "payload_bytes").agg(F.max("page_id").alias("_keeper"))
    joined = meta.distinct().join(keepers, ["sha1", "payload_bytes"])
    own = F.col("page_id").eqNullSafe(F.col("_keeper")) | \
        (F.col("payload_bytes") < min_revisit_bytes)
    return joined.select(
        "page_id", "payload_bytes", "sha1",
        F.when(own, "response").otherwise("revisit").alias("record_type"),
        F.when(~own, F.col("_keeper")).alias("refers_to"))


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` (page_id, url, html) and return the manifest of the
    archive files (path, records). Each task attempt writes a file of its own
    name, and only files of finished tasks reach the manifest.

    NULL html is an empty payload, NULL url an empty address; rows that repeat
    a page_id with the same payload are records of the same kind, each written.
    """
    plan = plan_records(pages, min_revisit_bytes).select(
        F.col("page_id").alias("_id"), F.col("sha1").alias("_sha1"), "payload_bytes",
        "record_type", "refers_to")
    source = pages.select("page_id", F.coalesce("url", F.lit("")).alias("url"),
                          F.coalesce("html", F.lit("")).alias("html"))
    source = source.withColumn("sha1", F.sha1(F.encode("html", "UTF-8")))
    records = source.join(plan, F.col("page_id").eqNullSafe(F.col("_id")) &
                          (F.col("sha1") == F.col("_sha1"))).select(
        "page_id", "url", "sha1", "record_type", "refers_to",
        F.when(F.col("record_type") == "response", F.encode("html", "UTF-8")).alias("payload"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n, name = None, 0, f"{uuid.uuid4().hex}.warc.gz"
        try:
            for batch in batches:
                for i in range(batch.num_rows):
                    if out is None:
                        fs, path = filesystem(folder)
                        fs.create_dir(path, recursive=True)
                        out = fs.open_output_stream(f"{path}/{name}", compression=None)
                    row = {c: batch.column(c)[i].as_py() for c in
                           ("page_id", "url", "sha1", "record_type", "refers_to")}
                    value = batch.column("payload")[i]
                    write_record(out, row, value.as_buffer() if value.is_valid else None)
                    n += 1
        finally:
            if out is not None:
                out.close()
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([n], pa.int64())],
                                             names=["file", "records"])

    return written(records.mapInArrow(write, "file string, records long"), "warc-manifest")


def urn(page_id) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def write_record(out, row: dict, payload) -> None:
    """One gzip member. ``payload`` (a buffer; None for a revisit) goes through
    in pieces; its digest is checked against the one announced."""
    lines = ["WARC/1.1", f"WARC-Type: {row['record_type']}",
             f"WARC-Record-ID: {urn(row['page_id'])}",
             f"WARC-Target-URI: {row['url'].encode('unicode_escape').decode()}",
             f"WARC-Payload-Digest: sha1:{base32(row['sha1'])}"]
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {urn(row['refers_to'])}"]
    size = len(http) + (len(payload) if payload is not None else 0)
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}"]
    gz = zlib.compressobj(1, wbits=31)
    out.write(gz.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + http))
    if payload is not None:
        digest, view = hashlib.sha1(), memoryview(payload)
        for a in range(0, len(view), CHUNK):
            piece = view[a:a + CHUNK]
            digest.update(piece)
            out.write(gz.compress(piece))
        if digest.hexdigest() != row["sha1"]:
            raise ValueError(f"payload digest of page {row['page_id']} changed while writing")
    out.write(gz.compress(b"\r\n\r\n"))
    out.write(gz.flush())


class Members:
    """Bytes of an archive, decompressed block by block across gzip members."""

    def __init__(self, stream):
        self.stream, self.z, self.raw, self.plain = stream, zlib.decompressobj(wbits=31), b"", b""

    def more(self) -> bool:
        while True:
            if not self.raw:
                self.raw = self.stream.read(CHUNK)
                if not self.raw:
                    return False
            if self.z.eof:
                self.z = zlib.decompressobj(wbits=31)
            got = self.z.decompress(self.raw, CHUNK)
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if got:
                self.plain += got
                return True

    def until(self, mark: bytes) -> bytes | None:
        while (at := self.plain.find(mark)) < 0:
            if not self.more():
                return None
        head, self.plain = self.plain[:at], self.plain[at + len(mark):]
        return head

    def take(self, n: int) -> bytes:
        while not self.plain and self.more():
            pass
        got, self.plain = self.plain[:n], self.plain[n:]
        return got


CHUNK_SCHEMA = ("record_id string, record_type string, refers_to string, url string, "
                "announced string, chunk_no long, chunk binary, bytes_so_far long, "
                "sha1_so_far string, last boolean")


def record_chunks(stream) -> Iterator[tuple]:
    """Rows of CHUNK_SCHEMA of one archive. A record without payload has one
    empty chunk."""
    data = Members(stream)
    while (head := data.until(b"\r\n\r\n")) is not None:
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        http = data.until(b"\r\n\r\n")
        left = int(fields["Content-Length"]) - len(http) - 4
        digest, done, no = hashlib.sha1(), 0, 0
        while True:
            piece = data.take(min(left, CHUNK)) if left else b""
            if left and not piece:
                raise ValueError(f"truncated record {fields['WARC-Record-ID']}")
            left -= len(piece)
            done += len(piece)
            digest.update(piece)
            yield (fields["WARC-Record-ID"], fields["WARC-Type"], fields.get("WARC-Refers-To"),
                   fields["WARC-Target-URI"], fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                   no, piece, done, base32(digest.hexdigest()), left == 0)
            no += 1
            if not left:
                break
        if data.until(b"\r\n\r\n") is None:
            raise ValueError(f"record {fields['WARC-Record-ID']} has no end")


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """The chunk table (CHUNK_SCHEMA) of the archives in ``manifest``; one file
    is streamed by one task, as a gzip file cannot be split."""
    names = CHUNK_SCHEMA.replace(",", "").split()[::2]
    types = [pa.string()] * 5 + [pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.bool_()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)],
                names=names)

        for batch in batches:
            for file in batch.column("file").to_pylist():
                fs, path = filesystem(folder)
                rows, size = [], 0
                with fs.open_input_stream(f"{path}/{file}", compression=None) as stream:
                    for row in record_chunks(stream):
                        rows.append(row)
                        size += len(row[6]) + 200
                        if size > 4 << 20:
                            yield flush(rows)
                            rows, size = [], 0
                if rows:
                    yield flush(rows)

    n = max(1, int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return manifest.select("file").repartition(n, "file").mapInArrow(read, CHUNK_SCHEMA)


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Write all pages as WARC, read the archives back, and report each page
    from what was read: a response by the digest and length its chunks grew to,
    a revisit by those of the response it refers to."""
    folder = scratch_path(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    chunks = read_archives(manifest, folder)
    page = F.regexp_extract("record_id", r"^<urn:page:(-?\d*)>$", 1)
    target = F.regexp_extract("refers_to", r"^<urn:page:(-?\d*)>$", 1)
    ends = written(chunks.where("last").select(
        F.when(page != "", page.cast("long")).alias("page_id"), "record_type", "announced",
        F.when(target != "", target.cast("long")).alias("refers_to"),
        F.col("bytes_so_far").alias("payload_bytes"), F.col("sha1_so_far").alias("payload_digest")),
        "warc-records")
    responses = ends.where("record_type = 'response'")
    bad = F.raise_error(F.lit("a payload does not have the digest its record announces"))
    direct = responses.select(
        "page_id", "payload_bytes",
        F.when(F.col("payload_digest") == F.col("announced"), F.col("payload_digest"))
        .otherwise(bad).alias("payload_digest"), "record_type", "refers_to")
    stored = responses.select(F.col("page_id").alias("_to"), F.col("payload_digest").alias("_digest"),
                              F.col("payload_bytes").alias("_bytes")).distinct()
    revisits = ends.where("record_type = 'revisit'").join(
        stored, (F.col("refers_to") == F.col("_to")) & (F.col("announced") == F.col("_digest")))
    return direct.unionByName(revisits.select(
        "page_id", F.col("_bytes").alias("payload_bytes"), F.col("_digest").alias("payload_digest"),
        "record_type", "refers_to"))


OP8_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS payload_bytes,
             CAST(CAST(unhex(sha1(h)) AS BIT) AS VARCHAR) AS b FROM p),
k AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
               + 16 * CAST(substr(b, CAST(5 * i + 1 AS BIGINT), 1) AS INT)
               + 8 * CAST(substr(b, CAST(5 * i + 2 AS BIGINT), 1) AS INT)
               + 4 * CAST(substr(b, CAST(5 * i + 3 AS BIGINT), 1) AS INT)
               + 2 * CAST(substr(b, CAST(5 * i + 4 AS BIGINT), 1) AS INT)
               + CAST(substr(b, CAST(5 * i + 5 AS BIGINT), 1) AS INT), 1)), '') AS payload_digest
      FROM d),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS keeper FROM k)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM m
"""
