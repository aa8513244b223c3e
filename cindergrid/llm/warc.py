"""WARC archives written and read by Spark as tables of bounded rows.

Writing: a page becomes one WARC/1.0 record whose HTTP body has the chunked transfer coding, WIRE bytes a chunk, so no
line of an archive is longer than that, whatever the page is like. Head, chunks and end of a record leave as rows of a
text table with the line separator ``\\n``, and each gzip part file is a valid ``.warc.gz``. Beyond the cell that the
row of pages is anyway, a batch of lines is in memory, and each byte of it is copied once. Reading: gzip files are not split, so a task sees the lines of a file in
order; a record streams through as rows (record identifier, chunk number), each with the digest so far, and never stands
in memory as a whole. Bodies without the transfer coding are read too, line by line.

Nulls and edges: a null payload is empty; a null url is ``urn:unknown``; white space and control characters of a url
are percent-encoded; a null page_id is written as an empty id and read back as null. Rows that repeat a page_id stay
separate records; rows with the page_id and payload of the response are responses too. An empty table gives an
archive without records. Other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import slices, stash

WIRE = 4096
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
END = "0\r\n\r\n"

CHUNK_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, chunk_no int, data binary, chunk_bytes long, "
    "digest_so_far string, is_last boolean, payload_bytes long, payload_digest string"
)


def deduplicated(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, bytes, refers_to): refers_to is the largest page_id with an equal payload of at
    least min_bytes, where that is another page. Copies are counted before the join, with map-side sums, and kept as a
    table; the join is an ordinary shuffled one on the digest, whose hot keys Spark's adaptive skew join splits."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        "page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"),
        F.sha1(payload.cast("binary")).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
    )
    groups = (
        rows.filter(F.col("bytes") >= min_bytes)
        .groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("original"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    groups = stash(groups, "page-copies")  # a table, so that both sides of the join are exchanged
    other = F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original"))
    return rows.join(groups, ["digest", "bytes"], "left").withColumn("refers_to", F.when(other, F.col("original")))


def write_archives(pages: DataFrame, folder: str, min_bytes: int = 1000) -> None:
    """Writes one record per page to gzip archives in folder."""
    rows = deduplicated(pages, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    url = F.coalesce(F.regexp_replace("url", r"[\x00-\x20\x7f]", "%20"), F.lit("urn:unknown"))
    full, rest = F.floor(F.col("bytes") / WIRE), F.col("bytes") % WIRE
    framed = F.col("bytes") + full * (len(f"{WIRE:X}") + 4) + F.when(rest > 0, F.length(F.hex(rest)) + 4).otherwise(0) + len(END)
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), uri(F.col("page_id")),
        F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), url,
        F.lit("\r\nWARC-Payload-Digest: sha1:"), F.col("digest"),
        F.lit("\r\nX-Payload-Length: "), F.col("bytes").cast("string"),
        F.when(revisit, F.concat(
            F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\nWARC-Refers-To: "),
            uri(F.col("refers_to")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(framed + len(HTTP)).cast("string"), F.lit("\r\n\r\n"), F.when(revisit, "").otherwise(HTTP),
    )
    found = rows.select(head.alias("head"), F.when(~revisit, F.col("payload")).alias("payload"), revisit.alias("revisit")).mapInArrow(_lines, "value binary")
    found.select(F.col("value").cast("string")).write.option("lineSep", "\n").option("compression", "gzip").text(folder)


def _lines(batches, held_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The lines of each record, without their last line break, which the table adds: its head, the chunks of its body, cut
    off a view of the page's cell one after another, and the end. So a page is read once, and a batch of lines is held."""
    out, size = [], 0
    for batch in slices(batches):
        for head, payload, revisit in zip(*(batch.column(c) for c in ("head", "payload", "revisit"))):
            out.append(head.as_py().encode()[:-1])
            body = memoryview(payload.as_buffer()) if payload.is_valid else memoryview(b"")
            for a in range(0, len(body), WIRE):
                chunk = body[a : a + WIRE]
                out.append(b"%X\r\n%b\r" % (len(chunk), chunk))
                size += len(chunk)
                if size >= held_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])
                    out, size = [], 0
            out.append(b"\r\n\r" if revisit.as_py() else END.encode() + b"\r\n\r")
            size += len(out[-1])
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["value"])


class _Record:
    """One record while its lines pass by."""

    def __init__(self, header: dict[bytes, bytes]):
        number = lambda key: int(x) if (x := header.get(key, b"").removeprefix(b"<urn:page:").removesuffix(b">")) else None
        self.page_id, self.refers_to = number(b"warc-record-id"), number(b"warc-refers-to")
        self.url, self.kind = header[b"warc-target-uri"].decode(), header[b"warc-type"].decode()
        self.left, self.stated = int(header[b"content-length"]), header[b"warc-payload-digest"].removeprefix(b"sha1:").decode()
        self.length = int(header[b"x-payload-length"])
        self.http, self.sha, self.seen, self.chunk_no = self.left > 0, hashlib.sha1(), 0, 0
        self.coded, self.size = False, 0  # whether the body has the transfer coding; bytes still to come of its chunk
        self.held: list[bytes] = []
        self.held_bytes = 0

    def payload(self, line: memoryview) -> memoryview:
        """What a line of the body has of the payload."""
        if not self.coded:
            return line
        if not self.size:  # a chunk's size, or the end of a chunk or of the body
            self.size = int(bytes(line).strip() or b"0", 16)
            return line[:0]
        line = line[: self.size]
        self.size -= len(line)
        return line

    def row(self, last: bool) -> tuple:
        data, n = b"".join(self.held), self.held_bytes
        self.held, self.held_bytes = [], 0
        digest = self.stated if self.kind == "revisit" else self.sha.copy().hexdigest()
        if last and (digest, self.seen) != (self.stated, 0 if self.kind == "revisit" else self.length):
            raise ValueError(f"record {self.page_id}: payload does not match its digest and length")
        self.chunk_no += 1
        return (self.page_id, self.url, self.kind, self.refers_to, self.chunk_no - 1, data, n, digest, last,
                self.length if last else None, self.stated if last else None)


def _chunks(lines: Iterator[bytes], chunk_bytes: int) -> Iterator[tuple]:
    header: dict[bytes, bytes] | None = None
    record: _Record | None = None
    for line in lines:
        if record is None:
            if header is None:
                if line == b"WARC/1.0\r":
                    header = {}
                elif line != b"\r":
                    raise ValueError(f"no record begins with {line[:60]!r}")
            elif line == b"\r":
                record, header = _Record(header), None
            else:
                key, _, value = line.partition(b":")
                header[key.lower()] = value.strip()
        elif record.http:
            record.left -= len(line) + 1
            record.coded |= line.lower() == b"transfer-encoding: chunked\r"
            record.http = line != b"\r"
        else:
            part = memoryview(line + b"\n")[: record.left]
            record.left -= len(part)
            part = record.payload(part)
            while part:
                if record.held_bytes >= chunk_bytes:
                    yield record.row(False)
                piece, part = part[: chunk_bytes - record.held_bytes], part[chunk_bytes - record.held_bytes :]
                record.sha.update(piece)
                record.seen += len(piece)
                record.held_bytes += len(piece)
                record.held.append(bytes(piece))
        if record is not None and not record.left:
            yield record.row(True)
            record = None
    if record is not None or header is not None:
        raise ValueError("an archive ends inside a record")


def read_chunks(spark: SparkSession, folder: str, chunk_bytes: int = 1 << 16) -> DataFrame:
    """The chunked record table of all archives in folder. digest_so_far is the SHA-1 of the payload up to and with the
    chunk; the last chunk of a record is checked against the header and carries payload_bytes and payload_digest."""
    text = spark.read.schema("value string").option("lineSep", "\n").text(folder)

    def chunks(batches):
        lines = (line for batch in slices(batches) for line in batch.column(0).to_pylist())
        rows: list[tuple] = []
        held = 0
        for row in _chunks(lines, chunk_bytes):
            rows.append(row)
            held += len(row[5]) + 200
            if held > 8 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    kinds = {"long": pa.int64(), "string": pa.string(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    names, types = zip(*((n, kinds[t]) for n, t in (x.split() for x in CHUNK_SCHEMA.split(", "))))
    return text.select(F.col("value").cast("binary")).mapInArrow(chunks, CHUNK_SCHEMA)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk."""
    return chunks.filter("is_last").select("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest")
