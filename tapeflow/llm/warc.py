"""WARC archives: written as one gzip stream, normalised to a member per record, indexed.

``write_archives`` makes records and lets Spark's text writer compress each file as a
whole, as careless crawlers do.  ``normalise`` inflates every such file once, as a
stream, writes each record as a gzip member of its own, and gives a sidecar index with the
place of every member.  ``read_records`` reads members back by that index alone.

Files are written below the shared folder under names that follow from their input, first
under a name of their own and then moved, so a task that runs twice does no harm.
An archive holds at most ``RECORDS_PER_ARCHIVE`` records.

Defined cases: a null payload is empty; a null url gives no target; a payload shorter than
``REVISIT_BYTES`` is always stored; rows that share the largest id of equal payloads are all
stored; records without an id refer but are never referred to; equal payloads without any id
are all stored; an empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeflow.scratch import shared_dir

REVISIT_BYTES = 1000
RECORDS_PER_ARCHIVE = 5000
LEVEL = 6
_STEP = 1 << 20
_END = b"\r\n\r\n"

INDEX = "archive string, record long, offset long, length long, record_type string, record_id string, target string"
RECORD = (
    "record_id string, record_type string, target string, refers_to string, payload_bytes long, "
    "payload_digest string, stored_bytes long"
)


def _line(name: str, value: Column) -> Column:
    clean = F.regexp_replace(value, r"[\x00-\x20\x7f]", "%20")
    return F.when(value.isNull(), "").otherwise(F.concat(F.lit(f"{name}: "), clean, F.lit("\r\n")))


def mark_revisits(pages: DataFrame, key: str = "page_id", payload: str = "html") -> DataFrame:
    """(page_key, url, payload, payload_bytes, digest, refers_to) of the pages."""
    body = F.coalesce(payload, F.lit(""))
    rows = pages.select(
        F.col(key).alias("page_key"),
        "url",
        body.alias("payload"),
        F.octet_length(body).cast("long").alias("payload_bytes"),
        F.sha1(body.cast("binary")).alias("digest"),
    )
    large = rows.filter(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("digest", "payload_bytes")
    shared = large.agg(F.max("page_key").alias("first_key"), F.count("*").alias("copies")).filter("copies > 1").drop("copies")
    joined = rows.join(shared, ["digest", "payload_bytes"], "left")
    other = F.col("first_key").isNotNull() & ~F.col("page_key").eqNullSafe(F.col("first_key"))
    return joined.withColumn("refers_to", F.when(other, F.col("first_key"))).drop("first_key")


def write_archives(marked: DataFrame, folder: str, captured_at: str = "1970-01-01T00:00:00Z") -> None:
    """One WARC file, a single gzip stream, per task and ``RECORDS_PER_ARCHIVE`` rows."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    block = F.concat(http, F.when(revisit, "").otherwise(F.col("payload")))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    record = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\n"),
        _line("WARC-Record-ID", F.coalesce(urn(F.col("page_key")), F.lit("<urn:page:>"))),
        _line("WARC-Target-URI", F.col("url")),
        F.lit(f"WARC-Date: {captured_at}\r\n"),
        F.when(revisit, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\n").otherwise(""),
        _line("WARC-Refers-To", urn(F.col("refers_to"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.lit("Content-Type: application/http;msgtype=response\r\nContent-Length: "),
        F.octet_length(block).cast("string"),
        F.lit("\r\n\r\n"),
        block,
        F.lit("\r\n\r"),  # the writer ends each row with the last line feed
    )
    writer = marked.select(record.alias("value")).write.option("compression", "gzip")
    writer.option("lineSep", "\n").option("maxRecordsPerFile", RECORDS_PER_ARCHIVE).text(folder)


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}


def _records(stream: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and whole bytes of each record of an inflated stream."""
    held = bytearray()
    need = -1
    headers: dict[str, str] = {}
    for piece in stream:
        held += piece
        while True:
            if need < 0:
                end = held.find(_END)
                if end < 0:
                    break
                headers = _headers(bytes(held[:end]))
                need = end + 2 * len(_END) + int(headers["content-length"])
            if len(held) < need:
                break
            yield headers, bytes(held[:need])
            del held[:need]
            need = -1
    if held.strip():
        raise ValueError("an archive ends inside a record")


def _inflated(content: memoryview) -> Iterator[bytes]:
    """The stream's bytes in steps; streams that follow one another are read as one."""
    inflate = zlib.decompressobj(31)
    for at in range(0, len(content), _STEP):
        piece = content[at : at + _STEP]
        while piece:
            yield inflate.decompress(piece, _STEP)
            piece = inflate.unconsumed_tail
            if inflate.eof:
                piece = inflate.unused_data
                inflate = zlib.decompressobj(31)


def normalise(spark: SparkSession, folder: str, target: str, level: int = LEVEL) -> DataFrame:
    """Rewrites every archive of ``folder`` into ``target``; gives the sidecar index, which
    is also written, to ``target`` + ``/index``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name = batch.column(0)[i].as_py().rsplit("/", 1)[1]
                archive = f"{target}/{name.split('.')[0]}.warc.gz"
                system, path = pafs.FileSystem.from_uri(archive)
                system.create_dir(path.rsplit("/", 1)[0], recursive=True)
                own = f"{path}.{uuid.uuid4().hex}"
                rows, offset = [], 0
                with system.open_output_stream(own) as out:
                    for headers, record in _records(_inflated(memoryview(batch.column(1)[i].as_buffer()))):
                        member = zlib.compressobj(level, zlib.DEFLATED, 31)
                        packed = member.compress(record) + member.flush()
                        out.write(packed)
                        rows.append(
                            {
                                "archive": archive,
                                "record": len(rows),
                                "offset": offset,
                                "length": len(packed),
                                "record_type": headers["warc-type"],
                                "record_id": headers["warc-record-id"],
                                "target": headers.get("warc-target-uri"),
                            }
                        )
                        offset += len(packed)
                system.move(own, path)
                yield pa.RecordBatch.from_pylist(rows, _INDEX) if rows else pa.RecordBatch.from_pylist([], _INDEX)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "content")
    files.mapInArrow(run, INDEX).write.parquet(f"{target}/index")
    return spark.read.schema(INDEX).parquet(f"{target}/index")


_INDEX = pa.schema(
    [
        ("archive", pa.string()),
        ("record", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target", pa.string()),
    ]
)
_RECORD = pa.schema(
    [
        ("record_id", pa.string()),
        ("record_type", pa.string()),
        ("target", pa.string()),
        ("refers_to", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("stored_bytes", pa.int64()),
    ]
)


def _read(packed: bytes) -> dict:
    record = zlib.decompress(packed, 31)
    head, block = record[: record.index(_END)], record[record.index(_END) + len(_END) : -len(_END)]
    headers = _headers(head)
    http, payload = block[: block.index(_END)], block[block.index(_END) + len(_END) :]
    size, digest = int(_headers(http)["content-length"]), headers["warc-payload-digest"].removeprefix("sha1:")
    if headers["warc-type"] == "response" and (len(payload) != size or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"payload of {headers['warc-record-id']} is not what was written")
    return {
        "record_id": headers["warc-record-id"],
        "record_type": headers["warc-type"],
        "target": headers.get("warc-target-uri"),
        "refers_to": headers.get("warc-refers-to"),
        "payload_bytes": size,
        "payload_digest": digest,
        "stored_bytes": len(payload),
    }


def read_records(index: DataFrame) -> DataFrame:
    """The records an index names, each read at its offset; stored payloads are checked
    against their digests."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file = None, None
        for batch in batches:
            rows = []
            for archive, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if archive != opened:
                    if file:
                        file.close()
                    system, path = pafs.FileSystem.from_uri(archive)
                    opened, file = archive, system.open_input_file(path)
                file.seek(offset)
                rows.append(_read(file.read(length)))
            yield pa.RecordBatch.from_pylist(rows, _RECORD)
        if file:
            file.close()

    return index.select("archive", "offset", "length").mapInArrow(run, RECORD)


def page_id_of(urn: Column) -> Column:
    return F.regexp_extract(urn, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def op6_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    raw, normal = shared_dir(spark, "warc-raw"), shared_dir(spark, "warc")
    write_archives(mark_revisits(pages), raw)
    records = read_records(normalise(spark, raw, normal))
    return records.select(
        page_id_of(F.col("record_id")).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page_id_of(F.col("refers_to")).alias("refers_to"),
    )


OP6_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_bytes, payload_digest)
  ELSE page_id END AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM m"""
