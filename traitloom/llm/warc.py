"""WARC archives: write and read records, and store every payload once with revisit records for its repeats."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from traitloom.llm.common import ref

# Fixed values of the format (WARC 1.1, ISO 28500).
VERSION = "WARC/1.1"
#: Records of a file at most, bytes of an ordinary file and of any file, bytes of a record's headers, about.
RECORDS, FILE_BYTES, MOST_BYTES, HEAD_BYTES = 20_000, 256 << 20, 1 << 30, 1_024
REVISIT_PROFILE = "http://netpreservation.org/warc/1.1/revisit/identical-payload-digest"
_HEX_BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

RECORD_SCHEMA = (
    "record_id string, record_type string, target_uri string, date string, payload_digest string, "
    "refers_to string, content_length long, payload binary"
)


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1. Five hex digits are four base32 digits."""
    digest = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(digest, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX_BASE32, _BASE32)


def records_of(
    pages: DataFrame, key: str = "page_id", uri: str = "url", body: str = "html", date: str = "2000-01-01T00:00:00Z"
) -> DataFrame:
    """A response record per page: ``record_key, target_uri, date, payload, payload_bytes, payload_digest``.

    A null body is an empty payload, a null address an empty one. Line breaks in an address would end the header
    field, so control characters are percent-encoded. Other columns are not carried. Repeated rows give repeated records.
    """
    payload = F.coalesce(ref(body).cast("string"), F.lit(""))
    address = F.coalesce(ref(uri).cast("string"), F.lit(""))
    for code in (13, 10, 0):
        address = F.replace(address, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return pages.select(
        ref(key).alias("record_key"),
        address.alias("target_uri"),
        F.lit(date).alias("date"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        sha1_base32(payload.cast("binary")).alias("payload_digest"),
    )


def resolve_revisits(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Adds ``record_type`` and ``refers_to``: of equal payloads the smallest key is the response, the others revisit it.

    Only headers (key, digest) are grouped, and combined before the shuffle. What is joined back has one row per digest
    that occurs more than once, so a digest with a third of the rows is a split side of the join, never a group in one
    task. Payloads below ``least_bytes`` are all responses. A null key is never the original; if a digest has no other
    key, its records are all responses. Records with the smallest key twice are responses twice.
    """
    headers = records.filter(F.col("payload_bytes") >= least_bytes).select("record_key", "payload_digest")
    originals = (
        headers.groupBy("payload_digest")
        .agg(F.min("record_key").alias("original"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and original is not null")
        .select(F.col("payload_digest").alias("repeated_digest"), "original")
    )
    joined = records.join(
        originals,
        (F.col("payload_digest") == F.col("repeated_digest")) & (F.col("payload_bytes") >= least_bytes),
        "left",
    )
    revisit = F.col("original").isNotNull() & ~F.col("record_key").eqNullSafe(F.col("original"))
    return joined.select(
        *[ref(name) for name in records.columns],
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("original")).alias("refers_to"),
    )


def _uri(key: Column) -> Column:
    return F.concat(F.lit("<urn:record:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(">"))


def records_per_file(sizes: DataFrame, typical: int = FILE_BYTES, most: int = MOST_BYTES) -> int:
    """How many records a file may hold, by their ``payload_bytes``: ``typical`` bytes of average ones, and never more than
    ``most`` bytes (unpacked, headers included), however large the records are that come together; one at least."""
    found = sizes.agg(F.avg("payload_bytes").alias("mean"), F.max("payload_bytes").alias("largest")).first()
    if found["largest"] is None:
        return RECORDS
    return max(1, min(RECORDS, int(typical // (found["mean"] + HEAD_BYTES)), most // (found["largest"] + HEAD_BYTES)))


def write_archives(records: DataFrame, path: str, records_per_file: int = RECORDS) -> str:
    """WARC files (gzip) below ``path``, each record with fresh headers; a revisit has no block.

    Spark's text writer puts down one record per row and commits files as a whole, so a lost executor leaves no partial
    archive and any file system that Spark can write to will do. The line end it adds is the last byte of the record.
    """
    is_revisit = F.col("record_type") == "revisit"
    block = F.when(is_revisit, F.lit("")).otherwise(F.col("payload"))

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))

    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", _uri(F.col("record_key"))),
        field("WARC-Target-URI", F.col("target_uri")),
        field("WARC-Date", F.col("date")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        F.when(
            is_revisit,
            F.concat(field("WARC-Refers-To", _uri(F.col("refers_to"))), field("WARC-Profile", F.lit(REVISIT_PROFILE))),
        ).otherwise(F.lit("")),
        field("Content-Type", F.lit("text/html")),
        field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    rows = records.select(F.concat(head, block, F.lit("\r\n\r")).alias("value"))
    rows.write.options(compression="gzip", lineSep="\n", maxRecordsPerFile=records_per_file).text(path)
    return path


class _Stream:
    """Bytes of a (possibly multi-member) gzip file, unpacked only as far as they are asked for."""

    def __init__(self, data: memoryview, packed: bool):
        self.data, self.packed, self.at, self.buffer = data, packed, 0, bytearray()
        self.unpack = zlib.decompressobj(31) if packed else None

    def fill(self) -> bool:
        if self.at >= len(self.data):
            return False
        piece = self.data[self.at : self.at + (1 << 18)]
        self.at += len(piece)
        if not self.packed:
            self.buffer += piece
            return True
        while len(piece):
            self.buffer += self.unpack.decompress(piece)
            piece = self.unpack.unused_data
            if self.unpack.eof:
                self.unpack = zlib.decompressobj(31)
        return True

    def until(self, mark: bytes) -> bytes | None:
        seen = 0
        while (end := self.buffer.find(mark, seen)) < 0:
            seen = max(0, len(self.buffer) - len(mark) + 1)
            if not self.fill():
                return None
        out = bytes(self.buffer[:end])
        del self.buffer[: end + len(mark)]
        return out

    def take(self, n: int) -> bytes:
        while len(self.buffer) < n:
            if not self.fill():
                raise ValueError("archive ends within a record")
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out


def parse(data: memoryview) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers (names in small letters) and block of every record; blocks are found by their stated length alone."""
    stream = _Stream(data, bytes(data[:2]) == b"\x1f\x8b")
    while True:
        head = stream.until(b"\r\n\r\n")
        if head is None:
            if bytes(stream.buffer).strip():
                raise ValueError("archive ends within a header")
            return
        lines = head.decode("utf-8").lstrip("\r\n").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a record: {lines[0][:40]!r}")
        fields = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            fields[name.strip().lower()] = value.strip()
        block = stream.take(int(fields["content-length"]))
        if stream.take(4) != b"\r\n\r\n":
            raise ValueError("record does not end where its length says")
        yield fields, block


_ARROW = pa.schema(
    [(name, pa.string()) for name in ("record_id", "record_type", "target_uri", "date", "payload_digest", "refers_to")]
    + [("content_length", pa.int64()), ("payload", pa.binary())]
)


def _bare(uri: str | None) -> str | None:
    return None if uri is None else uri.removeprefix("<urn:record:").removesuffix(">")


def read_archives(spark: SparkSession, path: str, check: bool = True, keep_payload: bool = True) -> DataFrame:
    """Every record below ``path``: ``RECORD_SCHEMA``. One file is one task's work; records stream out in batches.

    With ``check``, the digest of every response is computed anew and must be the one in its header.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for content in batch.column("content"):
                for fields, block in parse(memoryview(content.as_buffer())):
                    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    if check and fields["warc-type"] == "response":
                        if base64.b32encode(hashlib.sha1(block).digest()).decode() != digest:
                            raise ValueError(f"payload of {fields.get('warc-record-id')} does not fit its digest")
                    rows.append(
                        {
                            "record_id": _bare(fields.get("warc-record-id")),
                            "record_type": fields["warc-type"],
                            "target_uri": fields.get("warc-target-uri"),
                            "date": fields.get("warc-date"),
                            "payload_digest": digest,
                            "refers_to": _bare(fields.get("warc-refers-to")),
                            "content_length": len(block),
                            "payload": block if keep_payload else None,
                        }
                    )
                    held += 500 + (len(block) if keep_payload else 0)
                    if held > 1 << 22:
                        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(read, RECORD_SCHEMA)


def with_original(read: DataFrame) -> DataFrame:
    """Joins revisits to the response they name: ``payload_bytes`` of the full payload for every record.

    Responses that are referred to are one row per id; a response with very many revisits is split by the join.
    """
    originals = (
        read.filter("record_type = 'response'")
        .groupBy(F.col("record_id").alias("original_id"))
        .agg(F.max("content_length").alias("original_bytes"))
    )
    joined = read.join(originals, (F.col("refers_to") == F.col("original_id")) & (F.col("record_type") == "revisit"), "left")
    size = F.when(F.col("record_type") == "revisit", F.col("original_bytes")).otherwise(F.col("content_length"))
    return joined.select(*[ref(name) for name in read.columns], size.alias("payload_bytes"))


def deduplicate(pages: DataFrame, path: str, least_bytes: int = 0, **columns: str) -> DataFrame:
    """Pages to deduplicated archives below ``path`` and back; returns what the archives say, without the payloads.

    The lengths of the payloads are looked at first, so that a file is bounded in bytes: readers take a file as a whole.
    """
    records = records_of(pages, **columns)
    write_archives(resolve_revisits(records, least_bytes), path, records_per_file(records.select("payload_bytes")))
    return with_original(read_archives(pages.sparkSession, path, keep_payload=False))

