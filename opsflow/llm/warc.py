"""WARC archives: write pages as records, read the archives back in sequence.

Writer. Each page is one record in one gzip member. Members stand back to back;
a file ends at ``records_per_archive`` members or ``archive_bytes`` bytes,
whichever comes first (a larger single member has a file of its own). Payloads of at least ``min_revisit_bytes`` that occur more
than once are stored once, as ``response`` of the smallest page id; the others
become ``revisit`` records that name it. Archives are written by Spark's own
committed file output, so a lost executor leaves no half archive, and any store
Spark can write will do: a file is one row of that output. The row's end is a zero
byte, and so is the end of a gzip member of less than 16 MB, its length's highest
byte; the writer leaves it to the row's end. After a larger member comes an empty
one. So a file is gzip members and nothing else, for any reader. (Spark leaves an
empty file where its first task has no record.)

Reader. Spark lists and reads the files; each is then one sequential scan:
incremental inflation, one member at a time, header lines up to the blank line,
a block framed by Content-Length, and the block and payload digests verified. A
record that fails raises, with its file and offset; nothing is skipped.

Defined cases: a null html is an empty payload; a null id gives a record without
the id field, read back as null; a null url gives none; control characters and
blanks in a url are percent-encoded. Rows that share the smallest id of equal
payloads are all ``response``. An empty table gives an empty archive folder and
no rows. Extra columns are not read.
"""

from __future__ import annotations

import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsflow.llm.bloom import member_filter
from opsflow.llm.common import join_stats, scratch_root, written

CRLF = b"\r\n"
PAD = "\x00"
EMPTY_MEMBER = gzip.compress(b"", mtime=0)
INFLATE_STEP = 1 << 16
READ_BYTES = 8 << 20  # of records that a reader holds at a time
RECORD_SCHEMA = ("archive string, offset long, record_type string, record_id string, page_id long, url string, "
                 "refers_to long, payload_bytes long, payload_digest string, payload binary")
# Fixed values of the WARC format.
REVISIT_PROFILE = "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http;msgtype=response"


def plan_records(pages: DataFrame, min_revisit_bytes: int = 100) -> DataFrame:
    """page_id, url, payload, payload_digest and refers_to (null: response)."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("payload_digest", F.sha2("payload", 256))
    long_enough = F.length("payload") >= min_revisit_bytes
    thin = rows.filter(long_enough).select("page_id", "payload_digest")
    groups = (thin.groupBy("payload_digest").agg(F.count("*").alias("copies"), F.min("page_id").alias("first_id"))
              .filter("copies > 1"))
    groups = written(groups, "repeated")
    # Only pages whose payload may be repeated are shuffled; the filter has no false negatives.
    maybe = member_filter(groups.select(F.xxhash64("payload_digest")), groups.count())
    probed = rows.withColumn("maybe", maybe(F.xxhash64("payload_digest")))
    joined = (join_stats(probed.filter("maybe"), groups, "payload_digest", "copies", thin.count())
              .unionByName(probed.filter(~F.col("maybe")), allowMissingColumns=True))
    later = long_enough & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select("page_id", "url", "payload", "payload_digest",
                         F.when(later, F.col("first_id")).alias("refers_to"))


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
                  date: str) -> bytes:
    """One gzip member holding one record."""
    head = (b"HTTP/1.1 200 OK" + CRLF + b"Content-Type: text/html; charset=utf-8" + CRLF
            + f"Content-Length: {len(payload)}".encode() + CRLF * 2)
    block = head if refers_to is not None else head + payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"),
              ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date),
              ("WARC-Payload-Digest", f"sha256:{digest}"),
              ("WARC-Block-Digest", f"sha256:{hashlib.sha256(block).hexdigest()}"),
              ("Content-Type", HTTP_TYPE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="!#$%&'()*+,/:;=?@[]~")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)),
                   ("X-Refers-To-Page-ID", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    lines = b"".join(f"{k}: {v}".encode() + CRLF for k, v in fields)
    zipper = zlib.compressobj(6, zlib.DEFLATED, 16 + zlib.MAX_WBITS)
    record = b"WARC/1.1" + CRLF + lines + CRLF + block + CRLF * 2
    return zipper.compress(record) + zipper.flush()


def joined(members: list[bytes]) -> bytes:
    """One file's members, without the zero byte that the output adds."""
    data = b"".join(members)
    return (data if data.endswith(b"\x00") else data + EMPTY_MEMBER)[:-1]


def write_archives(pages: DataFrame, path: str, records_per_archive: int = 1000, min_revisit_bytes: int = 100,
                   date: str = "2024-01-01T00:00:00Z", archive_bytes: int = 16 << 20) -> None:
    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for k in range(batch.num_rows):
                r = batch.slice(k, 1).to_pylist()[0]
                member = encode_record(r["page_id"], r["url"], r["payload"], r["payload_digest"], r["refers_to"], date)
                if held and (len(held) == records_per_archive or size + len(member) > archive_bytes):
                    yield pa.RecordBatch.from_arrays([pa.array([joined(held)], pa.binary())], ["archive"])
                    held, size = [], 0
                held.append(member)
                size += len(member)
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([joined(held)], pa.binary())], ["archive"])

    out = plan_records(pages, min_revisit_bytes).mapInArrow(archives, "archive binary")
    (out.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", PAD)
     .option("maxRecordsPerFile", 1).text(path))


def inflate_members(content: memoryview) -> Iterator[tuple[int, bytes]]:
    """(offset, inflated bytes) of each gzip member that is not empty, one at a time."""
    at, end = 0, len(content)
    while at < end:
        if content[at] == 0:  # padding
            at += 1
            continue
        start, zipper, pieces = at, zlib.decompressobj(16 + zlib.MAX_WBITS), []
        while not zipper.eof:
            if at >= end:
                raise ValueError(f"member at byte {start} ends early")
            step = content[at:at + INFLATE_STEP]
            pieces.append(zipper.decompress(step))
            at += len(step) - len(zipper.unused_data)
        if any(pieces):
            yield start, b"".join(pieces)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and the block, framed by Content-Length."""
    head, mark, rest = record.partition(CRLF * 2)
    lines = head.split(CRLF)
    if not mark or not lines[0].startswith(b"WARC/"):
        raise ValueError("no WARC header")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.decode().partition(":")
        fields[name.strip().lower()] = value.strip()
    size = int(fields["content-length"])
    if len(rest) < size + 4 or rest[size:size + 4] != CRLF * 2:
        raise ValueError("the block's length differs from Content-Length")
    return fields, rest[:size]


def decode_record(record: bytes) -> dict:
    fields, block = parse_record(record)
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha256:")
    if hashlib.sha256(block).hexdigest() != fields["warc-block-digest"].removeprefix("sha256:"):
        raise ValueError("block digest")
    head, _, payload = block.partition(CRLF * 2)
    http = dict(line.decode().lower().split(": ", 1) for line in head.split(CRLF)[1:])
    if kind == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(http["content-length"])):
        raise ValueError("payload digest or length")
    number = lambda name: int(fields[name]) if name in fields else None
    return {"record_type": kind, "record_id": fields["warc-record-id"], "page_id": number("x-page-id"),
            "url": fields.get("warc-target-uri"), "refers_to": number("x-refers-to-page-id"),
            "payload_bytes": int(http["content-length"]), "payload_digest": digest,
            "payload": payload if kind == "response" else None}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of every archive under ``path``, digests verified."""
    names = [f.split()[0] for f in RECORD_SCHEMA.split(", ")]
    schema = pa.schema([(n, pa.binary() if n == "payload" else
                         pa.int64() if n in ("offset", "page_id", "refers_to", "payload_bytes") else pa.string())
                        for n in names])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for archive, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, held = [], 0
                for offset, record in inflate_members(memoryview(content.as_buffer())):
                    try:
                        rows.append({"archive": archive, "offset": offset} | decode_record(record))
                    except (ValueError, KeyError) as e:
                        raise ValueError(f"{archive}, record at byte {offset}: {e}") from e
                    held += len(record)
                    if len(rows) == 256 or held > READ_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(records, RECORD_SCHEMA)


def archive_round_trip(pages: DataFrame, records_per_archive: int = 1000, min_revisit_bytes: int = 100) -> DataFrame:
    """Write ``pages`` to archives in the shared folder and return what reading them back gives."""
    spark = pages.sparkSession
    path = f"{scratch_root(spark)}/opsflow-llm/warc-{uuid.uuid4().hex}"
    write_archives(pages, path, records_per_archive, min_revisit_bytes)
    return read_archives(spark, path)
