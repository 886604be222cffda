"""WARC archives: writer and sequential reader.

One gzip member holds one record.  The writer runs in the tasks that hold the
rows and rolls its files at FILE_BYTES; the paths come back through a written
table, so files of failed attempts are never read.  Files are opened through
pyarrow's file systems, by the URI of the shared folder.

The reader inflates a file in pieces of READ_BYTES, frames the block by
Content-Length, checks that the member ends with the record, and compares
block and payload digests.  It holds one record at a time.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fitframe.llm.common import bounded, keep, small_batches, table
from fitframe.session import ensure_checkpoint_dir

FILE_BYTES = 64 << 20    # compressed bytes after which a new file begins
READ_BYTES = 64 << 10
BATCH_BYTES = 8 << 20    # payload bytes handed to Spark at once
SMALLEST_REVISIT = 1000  # shorter payloads are always written in full
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD_SCHEMA = ("path string, offset long, record_id string, record_type string, target_uri string, refers_to string, "
                 "payload_bytes long, payload_digest string, payload binary")


class WarcError(ValueError):
    """A file that breaks the format or a digest, with its path and offset."""


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _one_line(value: str) -> str:
    """A header value: control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in value)


def record_bytes(record_id: str, url: str | None, payload: bytes, refers_to: str | None) -> bytes:
    """One record, not yet compressed; a revisit has the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    headers = [("WARC-Type", "revisit" if refers_to is not None else "response"), ("WARC-Record-ID", f"<{record_id}>"),
               ("WARC-Date", "2000-01-01T00:00:00Z"), ("Content-Type", "application/http;msgtype=response"),
               ("WARC-Payload-Digest", _sha1(payload)), ("WARC-Block-Digest", _sha1(block)), ("Content-Length", str(len(block)))]
    if url is not None:
        headers.insert(2, ("WARC-Target-URI", _one_line(url)))
    if refers_to is not None:
        headers += [("WARC-Refers-To", f"<{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def write(rows: DataFrame, folder: str) -> DataFrame:
    """Write rows (record_id, url, payload, refers_to), ``refers_to`` null for
    a response, below ``folder``; returns the written table (path, n_records)
    of the finished files.  Null payloads count as empty."""
    small_batches(rows.sparkSession)

    def run(batches):
        where, base = _open(folder)
        where.create_dir(base, recursive=True)
        out = None

        def close():
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([n], pa.int64())], names=["path", "n_records"])
        for b in batches:
            for rid, url, payload, refers in zip(*(b.column(i).to_pylist() for i in range(4))):
                if out is None:
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = where.open_output_stream(f"{base}/{name}", compression=None)
                data = _member(record_bytes(rid, url, payload or b"", refers))
                out.write(data)
                size, n = size + len(data), n + 1
                if size >= FILE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()
    made = rows.select("record_id", "url", F.col("payload").cast("binary"), "refers_to")
    return keep(made.mapInArrow(run, "path string, n_records long"), "warc-files")


def _members(stream) -> Iterator[tuple[int, bytes]]:
    """(offset, data) of each gzip member of a stream, inflated in pieces."""
    offset, rest = 0, b""
    while True:
        rest = rest or stream.read(READ_BYTES)
        if not rest:
            return
        unpacker, parts, taken = zlib.decompressobj(31), [], 0
        while not unpacker.eof:
            if not rest:
                rest = stream.read(READ_BYTES)
                if not rest:
                    raise WarcError(f"member at {offset} is cut short")
            try:
                parts.append(unpacker.decompress(rest))
            except zlib.error as e:
                raise WarcError(f"member at {offset}: {e}") from e
            taken += len(rest) - len(unpacker.unused_data)
            rest = unpacker.unused_data
        yield offset, b"".join(parts)
        offset += taken


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises WarcError if the framing or the
    block digest is wrong."""
    end = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/") or end < 0:
        raise WarcError("no record header")
    headers = {}
    for line in data[:end].decode("utf-8").split("\r\n")[1:]:
        k, sign, v = line.partition(":")
        if not sign:
            raise WarcError(f"header line without a colon: {line!r}")
        headers[k.strip().lower()] = v.strip()
    if not headers.get("content-length", "").isdigit():
        raise WarcError("no Content-Length")
    start, size = end + 4, int(headers["content-length"])
    block = data[start:start + size]
    if len(block) != size or data[start + size:] != b"\r\n\r\n":
        raise WarcError("Content-Length doesn't frame the record")
    if "warc-block-digest" in headers and headers["warc-block-digest"] != _sha1(block):
        raise WarcError("block digest differs")
    return headers, block


def read_file(path: str) -> Iterator[tuple]:
    """Records of one file as tuples of RECORD_SCHEMA, digests verified."""
    where, name = _open(path)
    with where.open_input_stream(name, compression=None) as stream:
        try:
            for offset, data in _members(stream):
                headers, block = parse_record(data)
                head, _, payload = block.partition(b"\r\n\r\n")
                told = headers.get("warc-payload-digest")
                size = len(payload)
                if headers["warc-type"] == "revisit":  # the HTTP header tells the length of what it refers to
                    size = next((int(h.split(b":")[1]) for h in head.split(b"\r\n") if h.lower().startswith(b"content-length:")), None)
                elif told is not None and told != _sha1(payload):
                    raise WarcError(f"payload digest differs at {offset}")
                digest = base64.b32decode(told[5:]).hex() if told else hashlib.sha1(payload).hexdigest()
                yield (path, offset, headers.get("warc-record-id", "").strip("<>"), headers["warc-type"], headers.get("warc-target-uri"),
                       headers["warc-refers-to"].strip("<>") if "warc-refers-to" in headers else None, size, digest, payload)
        except WarcError as e:
            raise WarcError(f"{path}: {e}") from e


def read(files: DataFrame, payload: bool = True) -> DataFrame:
    """Records of the files of (path, ...), one task per file at most, as
    RECORD_SCHEMA; without ``payload`` that column is null.  An empty list of
    files gives an empty result; a broken file raises WarcError."""
    spark = files.sparkSession
    small_batches(spark)
    kinds = pa.schema([("path", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
                       ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()),
                       ("payload_digest", pa.string()), ("payload", pa.binary())])

    def run(batches):
        for b in batches:
            for path in b.column(0).to_pylist():
                held, size = [], 0
                for record in read_file(path):
                    held.append(record if payload else (*record[:-1], None))
                    size += 200 + len(record[-1]) * payload
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held), kinds)], schema=kinds)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held), kinds)], schema=kinds)
    n = max(1, min(files.count(), 10 * spark.sparkContext.defaultParallelism))
    return files.select("path").repartition(n).mapInArrow(run, RECORD_SCHEMA)


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """Rows for ``write``: of equal payloads of SMALLEST_REVISIT bytes or more,
    that with the largest id is the response and the others revisit it.

    A null body is an empty payload and a null url leaves out the target.
    Rows that share the largest id are all responses.  A row without an id
    revisits like others and is a response if no copy has an id.
    """
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                       F.coalesce(F.col(body_col), F.lit("")).cast("binary").alias("payload"))
    src = src.withColumn("digest", F.sha1("payload"))
    groups = keep(src.where(F.octet_length("payload") >= SMALLEST_REVISIT).groupBy("digest")
                  .agg(F.max("id").alias("keeper"), F.count("*").alias("n")).where("n > 1").select("digest", "keeper"), "payloads")
    name = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.concat(F.lit("none:"), F.expr("uuid()"))))
    other = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("id"))
    return (src.join(bounded(groups, groups.count()), "digest", "left")
            .select(name(F.col("id")).alias("record_id"), "url", "payload",
                    F.when(other, name(F.col("keeper"))).alias("refers_to")))


def run_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op1: write all ``pages`` and read the archives back."""
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    records = read(write(deduplicated(table(spark, sf_dir, "pages")), folder), payload=False)
    number = lambda c: F.expr(f"try_cast(substring({c}, 10) as bigint)")  # noqa: E731  after urn:page:
    return records.select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                          number("refers_to").alias("refers_to"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS n FROM pages),
k AS (SELECT h, max(page_id) AS keeper FROM p WHERE n >= 1000 GROUP BY h)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, sha1(p.h) AS payload_digest,
  CASE WHEN k.keeper <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN k.keeper <> p.page_id THEN k.keeper END AS refers_to
FROM p LEFT JOIN k ON p.h = k.h
"""
