"""WARC archives of pages, written and read as a chunked record table.

Writing: each page becomes one WARC/1.1 record, a gzip member of its own, with
the page as HTTP payload.  Of records whose payloads are equal and large
enough, the one with the largest page_id is a ``response`` and the others are
``revisit`` records that refer to it and carry no payload.

Reading gives a table of chunks: (record_id, chunk_no, ...) with at most
``CHUNK`` bytes of the payload each.  A record is inflated piece by piece and
its SHA-1 advances with every chunk, so no record is ever held whole, however
large its payload; each chunk row carries the digest of the payload so far, and
the last one (``is_last``) that of the whole.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorewell.llm import files
from scorewell.llm.common import blank_text, written
from scorewell.session import scratch_location

CHUNK = 256 << 10
#: Payloads of fewer bytes are always stored.
LEAST_BYTES = 1000
#: Rows that join equal payloads are dealt over so many tasks a payload.
SALTS = 32
#: Payloads held more than once, at about 80 bytes each, that may go to all tasks: 20 MB.
BROADCAST_COPIES = 250_000
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2026-01-01T00:00:00Z"
MANIFEST = "file string, records bigint"
MANIFEST_ARROW = pa.schema([("file", pa.string()), ("records", pa.int64())])


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


# --- which records are stored ----------------------------------------------------------


def with_roles(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, url, html, digest, n_bytes, refers_to): refers_to is null for a response.

    The digests of the large payloads are grouped, never the payloads; what is
    joined back is one row per payload that occurs more than once.  They are
    counted: up to ``BROADCAST_COPIES`` of them go to all tasks, and no payload is
    shuffled; more of them are repeated for each salt and meet the pages by digest
    and salt, so that a payload held by a third of the pages spreads.
    """
    rows = pages.select(
        F.col("page_id").try_cast("bigint").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        blank_text(F.col("html")).alias("html"),
    ).withColumns({"digest": F.sha1(F.col("html").cast("binary")), "n_bytes": F.octet_length("html").cast("bigint")})
    salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
    ids = written(
        rows.where(F.col("n_bytes") >= least)
        .groupBy("digest", "n_bytes").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("keeper"))
        .where("n > 1 AND keeper IS NOT NULL").select("digest", "n_bytes", "keeper"),
        "warc-copies",
    )
    if ids.count() <= BROADCAST_COPIES:
        joined = rows.join(F.broadcast(ids), ["digest", "n_bytes"], "left")
    else:
        salted = ids.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", salt).join(salted, ["digest", "n_bytes", "salt"], "left")
    # A null page_id isn't equal to the keeper: such a row refers to it.
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper"))
    return joined.select("page_id", "url", "html", "digest", "n_bytes", refers.alias("refers_to"))


# --- writing ----------------------------------------------------------------------------------


def _member(out, header: list[str], blocks: Iterator[bytes]) -> None:
    """One gzip member, compressed block by block."""
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    out.write(z.compress(("\r\n".join(header) + "\r\n\r\n").encode()))
    for b in blocks:
        out.write(z.compress(b))
    out.write(z.compress(b"\r\n\r\n") + z.flush())


def _blocks(payload: memoryview) -> Iterator[memoryview]:
    for at in range(0, len(payload), CHUNK):
        yield payload[at : at + CHUNK]


def write_record(out, row: dict, payload: memoryview) -> None:
    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
    revisit = row["refers_to"] is not None
    size = len(HTTP) + (0 if revisit else len(payload))
    url = row["url"].replace("\r", "%0D").replace("\n", "%0A")
    header = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_name(row['page_id'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Bytes: {row['n_bytes']}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {size}",
    ]
    if revisit:
        header += [f"WARC-Refers-To: {record_name(row['refers_to'])}", f"WARC-Profile: {REVISIT}"]

    def blocks():
        yield HTTP
        if not revisit:
            yield from _blocks(payload)

    _member(out, header, blocks())


def write_archives(pages: DataFrame, folder: str, least: int = LEAST_BYTES) -> DataFrame:
    """Writes an archive per partition; returns the manifest of the finished tasks' files."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = None, 0
        for batch in batches:
            html = batch.column("html")
            slim = batch.select([c for c in batch.schema.names if c != "html"])
            for k, row in enumerate(slim.to_pylist()):
                if out is None:
                    uri, out = files.create(folder, f"pages-{TaskContext.get().partitionId():06d}.warc.gz")
                write_record(out, row, memoryview(html[k].as_buffer()))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pylist([{"file": uri, "records": n}], MANIFEST_ARROW)

    return written(with_roles(pages, least).mapInArrow(write, MANIFEST), "warc-manifest")


# --- reading ----------------------------------------------------------------------------------

CHUNKS = (
    "page_id bigint, record_id string, record_type string, refers_to bigint, url string, chunk_no bigint, "
    "chunk binary, bytes_so_far bigint, sha1_so_far string, is_last boolean, "
    "header_sha1 string, payload_bytes bigint"
)
CHUNKS_ARROW = pa.schema(
    [("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
     ("url", pa.string()), ("chunk_no", pa.int64()), ("chunk", pa.binary()), ("bytes_so_far", pa.int64()),
     ("sha1_so_far", pa.string()), ("is_last", pa.bool_()), ("header_sha1", pa.string()), ("payload_bytes", pa.int64())]
)


class Members:
    """Inflated bytes of a file of gzip members, as many as asked for at a time."""

    def __init__(self, stream):
        self.stream, self.raw, self.z, self.held = stream, b"", None, b""

    def _more(self) -> bool:
        """Inflates up to a chunk; False at the end of the file."""
        while True:
            if not self.raw:
                self.raw = self.stream.read(64 << 10)
            ended = not self.raw
            if ended and self.z is None:
                return False
            self.z = self.z or zlib.decompressobj(31)
            got = self.z.decompress(self.raw, CHUNK)
            if ended and not got:
                return False
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if self.z.eof:
                self.z = None
            if got:
                self.held += got
                return True

    def line(self) -> bytes | None:
        """The next line without its end; None at the end of the file."""
        while b"\r\n" not in self.held:
            if not self._more():
                return None
        line, _, self.held = self.held.partition(b"\r\n")
        return line

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes in pieces of at most a chunk."""
        while n:
            if not self.held and not self._more():
                raise ValueError("the archive ends within a record")
            piece, self.held = self.held[: min(n, CHUNK)], self.held[min(n, CHUNK) :]
            n -= len(piece)
            yield piece


def _pieces(parts: Iterator[bytes], size: int) -> Iterator[tuple[bytes, bool]]:
    """The parts as pieces of exactly ``size`` bytes, a shorter one last; (piece, is it the last)."""
    held = b""
    for p in parts:
        held += p
        while len(held) > size:
            yield held[:size], False
            held = held[size:]
    yield held, True


def read_records(stream, with_payload: bool = True, size: int = CHUNK) -> Iterator[dict]:
    """Chunk rows of an archive, in order."""
    source = Members(stream)
    while (line := source.line()) is not None:
        if not line:  # the two line ends after a record
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("a record was expected")
        head = {}
        while line := source.line():
            name, _, value = line.decode().partition(": ")
            head[name.lower()] = value
        left = int(head["content-length"])
        while left:  # HTTP header, up to its empty line
            line = source.line()
            left -= len(line) + 2
            if not line:
                break
        sha1, so_far, revisit = hashlib.sha1(), 0, head["warc-type"] == "revisit"
        row = {
            "page_id": page_of(head["warc-record-id"]), "record_id": head["warc-record-id"],
            "record_type": head["warc-type"],
            "refers_to": page_of(head["warc-refers-to"]) if revisit else None, "url": head["warc-target-uri"],
            "header_sha1": base64.b32decode(head["warc-payload-digest"].removeprefix("sha1:")).hex(),
            "payload_bytes": int(head["x-payload-bytes"]),
        }
        for k, (piece, last) in enumerate(_pieces(source.take(left), size)):
            sha1.update(piece)
            so_far += len(piece)
            yield row | {"chunk_no": k, "chunk": piece if with_payload else None, "bytes_so_far": so_far,
                         "sha1_so_far": sha1.copy().hexdigest(), "is_last": last}


def read_archives(spark: SparkSession, manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The chunk table of the manifest's archives; without payloads, ``chunk`` is null.

    A batch that goes to Spark holds at most 16 chunks, or 1000 rows.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("file").to_pylist():
                rows, held = [], 0
                with files.open_stream(uri) as stream:
                    for row in read_records(stream, with_payload):
                        rows.append(row)
                        held += len(row["chunk"] or b"")
                        if held >= 16 * CHUNK or len(rows) == 1000:
                            yield pa.RecordBatch.from_pylist(rows, CHUNKS_ARROW)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, CHUNKS_ARROW)

    files_ = manifest.select("file")
    return files_.repartition(max(1, manifest.count())).mapInArrow(read, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record from its last chunk; a response whose payload doesn't match its header fails."""
    stored = F.col("record_type") == "response"
    sound = (F.col("sha1_so_far") == F.col("header_sha1")) & (F.col("bytes_so_far") == F.col("payload_bytes"))
    # Part of the filter, so that it is seen whichever columns are asked for.
    damaged = F.raise_error(F.concat(F.lit("damaged record "), "record_id")).cast("boolean")
    return chunks.where(F.when(F.col("is_last") & stored & ~sound, damaged).otherwise(F.col("is_last"))).select(
        "page_id", "payload_bytes", F.col("header_sha1").alias("payload_digest"), "record_type", "refers_to",
    )


def archive_table(pages: DataFrame, folder: str | None = None, least: int = LEAST_BYTES) -> DataFrame:
    """Writes all pages to archives and reads them back: one row per page.

    Pages with a null or empty html have an empty payload.  Rows that share
    the largest page_id of a payload are all responses; a null page_id is
    smaller than any, and one that is no number is null.  Other columns play no
    part; an empty table gives no rows.
    """
    spark = pages.sparkSession
    folder = scratch_location(spark, "warc") if folder is None else folder
    return records(read_archives(spark, write_archives(pages, folder, least), with_payload=False))
