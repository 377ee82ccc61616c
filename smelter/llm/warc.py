"""WARC archives: written as one gzip stream a file, normalised to one gzip member a record with a sidecar index, read back.

Spark writes the records as compressed text files, so each file is one monolithic gzip stream. The normaliser streams every
file once through an inflater, cuts it into records by their Content-Length, rewrites each as a gzip member of its own, and
writes ``<archive>.idx`` beside it: a line ``offset, length, kind, record id, digest`` (tabs) for each member, in order of
offset. With it any record is read by one seek. Files are made under another name and renamed when whole, their names and
bytes follow from the source, so a task that runs again leaves the same files. Memory: a chunk of 1 MB and one record.

Of pages with equal payloads (SHA-256), those of the smallest page_id are responses, others are revisits that name it; they
carry the HTTP headers and the digest of the payload, not the payload itself. Below ``least_bytes`` all are responses.

Nulls: a null html is empty; a null page_id sorts after all others and is null again when read; a null url leaves the
target out. Repeated rows: a record each; all rows with the smallest page_id of a payload are responses. Empty table: no
archives, empty result. Very long texts: streamed through the compressor. Other columns are not looked at.

The archive folder must be one that pyarrow's file systems open (file, hdfs, s3, gs, abfs); the pages may lie anywhere.
A record that is cut short, or whose payload has another digest than its header says, raises ValueError.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smelter.llm.common import LAST, shared_folder, spread

CHUNK = 1 << 20
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
VERSION = b"WARC/1.1"
INDEX_SCHEMA = "archive string, offset long, length long, kind string, record_id string, payload_digest string"
PAGE_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
RECORD_ID = re.compile(r"<urn:page:(-?\d+|none):[A-Z2-7]{32}>")


# ---- records -----------------------------------------------------------------------------------------------------

def base32_sha1(data: Column) -> Column:
    """The SHA-1 of binary data in upper-case base32: five hex digits (20 bits) give four letters."""
    digest = F.sha1(data)
    digits = [F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*digits), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def page_records(pages: DataFrame, *, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """The WARC record of each page as ``value``, all but its last line break."""
    text = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(F.coalesce(F.col("page_id").cast("long"), F.lit(LAST)).alias("page"), F.col("url"), text.alias("body"))
    rows = rows.withColumns({"size": F.octet_length("body"), "digest": base32_sha1(F.col("body").cast("binary")),
                             "same": F.unhex(F.sha2(F.col("body"), 256))})
    # Only payloads that are found more than once; equal payloads of one task are one row before the shuffle.
    first = (rows.where(F.col("size") >= least_bytes).groupBy("same").agg(F.min("page").alias("keeper"), F.max("page").alias("other"))
             .where(F.col("keeper") < F.col("other")).select("same", "keeper"))
    rows = rows.join(spread(first), "same", "left")
    revisit = F.col("page") > F.col("keeper")

    def record_id(page: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.when(page < LAST, page.cast("string")).otherwise("none"), F.lit(":"), F.col("digest"), F.lit(">"))

    def line(name: str, value: Column, where: Column | None = None) -> Column:
        out = F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
        return F.coalesce(out if where is None else F.when(where, out), F.lit(""))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("size"))
    target = F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", F.when(revisit, "revisit").otherwise("response")), line("WARC-Record-ID", record_id(F.col("page"))),
        line("WARC-Date", F.lit(date)), line("WARC-Target-URI", target), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), revisit),
        line("WARC-Refers-To", record_id(F.col("keeper")), revisit), line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", block.cast("string")), F.lit("\r\n"), http, F.when(revisit, "").otherwise(F.col("body")), F.lit("\r\n")).alias("value"))


def write_monolithic(records: DataFrame, folder: str, *, records_per_file: int = 200_000) -> None:
    """Each task's records as files that are one gzip stream each."""
    (records.write.option("compression", "gzip").option("lineSep", "\r\n").option("maxRecordsPerFile", records_per_file).text(folder))


# ---- files -------------------------------------------------------------------------------------------------------

def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path there."""
    path = re.sub(r"^s3[an]:", "s3:", re.sub(r"^file:/+", "file:///", path))
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def inflated(stream: pa.NativeFile) -> Iterator[bytes]:
    """The bytes of a gzip stream, or of several one after the other, in chunks."""
    left, inflater = b"", zlib.decompressobj(31)
    while left or (left := stream.read(CHUNK)):
        if inflater.eof:
            inflater = zlib.decompressobj(31)
        yield inflater.decompress(left, CHUNK)
        left = inflater.unconsumed_tail or inflater.unused_data
    while not inflater.eof:
        more = inflater.decompress(inflater.unconsumed_tail, CHUNK)
        if not more:
            raise ValueError("the gzip stream is cut short")
        yield more


class Reader:
    """Lines and byte runs of a stream of chunks."""

    def __init__(self, chunks: Iterator[bytes]):
        self.chunks, self.held = chunks, bytearray()

    def more(self) -> bool:
        chunk = next(self.chunks, None)
        self.held += chunk or b""
        return chunk is not None

    def head(self) -> bytes:
        """All up to and with the next blank line; empty at the end of the stream."""
        seen = 0
        while (at := self.held.find(b"\r\n\r\n", seen)) < 0:
            seen = max(0, len(self.held) - 3)
            if not self.more():
                if self.held:
                    raise ValueError("a record's headers are cut short")
                return b""
        return self.take(at + 4)

    def take(self, size: int) -> bytes:
        while len(self.held) < size:
            if not self.more():
                raise ValueError("a record is cut short")
        out = bytes(self.held[:size])
        del self.held[:size]
        return out

    def run(self, size: int) -> Iterator[bytes]:
        while size:
            part = self.take(min(size, CHUNK))
            size -= len(part)
            yield part


def headers(head: bytes, first: bytes = VERSION) -> dict[str, str]:
    lines = head.split(b"\r\n")
    if lines[0] != first:
        raise ValueError(f"{lines[0][:40]!r} where {first!r} should be")
    return {k.strip().lower(): v.strip() for k, _, v in (x.decode("utf-8", "replace").partition(":") for x in lines[1:] if x)}


def _normalise_file(source: str, target: str) -> int:
    """One archive and its index; the number of its records."""
    here, path = opened(source)
    there, folder = opened(target)
    name, trial = re.sub(r"(\.txt|\.warc)?\.gz$", "", path.rsplit("/", 1)[-1]), f"{folder}/_attempts/{uuid.uuid4().hex}"
    there.create_dir(f"{folder}/_attempts", recursive=True)
    offset = count = 0
    with here.open_input_stream(path, compression=None) as stream, there.open_output_stream(trial, compression=None) as out, there.open_output_stream(f"{trial}.idx", compression=None) as index:
        reader = Reader(inflated(stream))
        while head := reader.head():
            has = headers(head)
            packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
            size = out.write(packer.compress(head))
            for part in reader.run(int(has["content-length"])):
                size += out.write(packer.compress(part))
            if (end := reader.take(4)) != b"\r\n\r\n":
                raise ValueError(f"{source}: {end!r} after the record {has.get('warc-record-id')}")
            size += out.write(packer.compress(end) + packer.flush())
            index.write("\t".join([str(offset), str(size), has["warc-type"], has["warc-record-id"], has.get("warc-payload-digest", "")]).encode() + b"\n")
            offset, count = offset + size, count + 1
    for kind in ("", ".idx"):
        _rename(there, f"{trial}{kind}", f"{folder}/{name}.warc.gz{kind}")
    return count


def _rename(files: fs.FileSystem, made: str, final: str) -> None:
    try:
        files.move(made, final)
    except OSError:
        if files.get_file_info(final).type != fs.FileType.File:
            raise
        files.delete_file(made)  # another attempt of this task was first; its bytes are the same


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    """The archives of a folder; a task's share of them is bounded by their bytes, and none is read here."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path", "length")


def normalise(spark: SparkSession, source: str, target: str) -> int:
    """Rewrite every archive of the folder source to the folder target, a member a record; returns the number of records."""

    def work(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for path in frame.column(0).to_pylist():
                yield pa.record_batch({"records": pa.array([_normalise_file(path, target)], pa.int64())})

    return _listed(spark, source).mapInArrow(work, "records long").agg(F.sum("records")).first()[0] or 0


# ---- reading back ------------------------------------------------------------------------------------------------

def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """The sidecar indexes of all archives."""
    rows = spark.read.option("pathGlobFilter", "*.idx").text(folder)
    part = F.split("value", "\t")
    return rows.select(
        F.regexp_replace("_metadata.file_path", r"\.idx$", "").alias("archive"), part[0].cast("long").alias("offset"), part[1].cast("long").alias("length"),
        part[2].alias("kind"), part[3].alias("record_id"), F.nullif(part[4], F.lit("")).alias("payload_digest"))


def _record(member: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """Headers, HTTP headers and payload of one gzip member."""
    reader = Reader(iter([zlib.decompress(member, 31)]))
    has = headers(reader.head())
    block = reader.take(int(has["content-length"]))
    at = block.find(b"\r\n\r\n") + 4
    http, payload = headers(block[:at], block.split(b"\r\n", 1)[0]), block[at:]
    if has["warc-type"] == "response":
        digest = "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != has.get("warc-payload-digest", digest):
            raise ValueError(f"{has['warc-record-id']}: the payload has the digest {digest}")
    return has, http, payload


def fetch(index: DataFrame) -> DataFrame:
    """record_id and payload (binary; empty for revisits) of rows of an index, each by one seek in its archive."""

    def work(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, file = None, None
        for frame in frames:
            for path, offset, length in zip(*(frame.column(k).to_pylist() for k in range(3)), strict=True):
                if path != at:
                    if file is not None:
                        file.close()
                    files, name = opened(path)
                    at, file = path, files.open_input_file(name)
                file.seek(offset)
                has, _, payload = _record(file.read(length))
                yield pa.record_batch({"record_id": [has["warc-record-id"]], "payload": [payload]})

    return index.select("archive", "offset", "length").mapInArrow(work, "record_id string, payload binary")


def _page_of(record_id: str | None) -> int | None:
    found = RECORD_ID.fullmatch(record_id or "")
    return int(found[1]) if found and found[1] != "none" else None


def read_pages(spark: SparkSession, folder: str) -> DataFrame:
    """The page of each record of normalised archives, with size and digest of its full payload. Payloads are read, inflated
    and checked by the members' places in the index; a revisit's size and digest are those its headers hold."""

    def work(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for frame in frames:
            for path in frame.column(0).to_pylist():
                files, name = opened(path)
                out: list[list] = []
                with files.open_input_stream(f"{name}.idx", compression=None) as index, files.open_input_file(name) as archive:
                    lines = Reader(iter(lambda: index.read(CHUNK) or None, None))
                    for offset, length in _places(lines):
                        archive.seek(offset)
                        has, http, payload = _record(archive.read(length))
                        full = len(payload) if has["warc-type"] == "response" else int(http["content-length"])
                        out.append([_page_of(has["warc-record-id"]), full, has["warc-payload-digest"][5:], has["warc-type"], _page_of(has.get("warc-refers-to"))])
                        if len(out) == 10_000:
                            yield _page_batch(out)
                            out = []
                yield _page_batch(out)

    return _listed(spark, folder).mapInArrow(work, PAGE_SCHEMA)


def _places(lines: Reader) -> Iterator[tuple[int, int]]:
    while True:
        while (at := lines.held.find(b"\n")) < 0:
            if not lines.more():
                return
        offset, length, _ = lines.take(at + 1).split(b"\t", 2)
        yield int(offset), int(length)


def _page_batch(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    return pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=list(names))


def archive(pages: DataFrame, folder: str, *, least_bytes: int = 0) -> int:
    """Write the pages' records to folder, normalised; the whole-file streams lie beside it until that is done."""
    spark = pages.sparkSession
    raw = f"{folder}-streams"
    write_monolithic(page_records(pages, least_bytes=least_bytes), raw)
    count = normalise(spark, raw, folder)
    discard(spark, raw)
    return count


def discard(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def page_records_back(pages: DataFrame) -> DataFrame:
    """Archive the pages in the shared folder and read them back: page_id, payload_bytes, payload_digest, record_type,
    refers_to, a row for each row of pages."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/warc-{uuid.uuid4().hex}"
    if not archive(pages, folder):
        return spark.createDataFrame([], PAGE_SCHEMA)
    return read_pages(spark, folder)


_BITS = "CAST(CAST(from_hex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR)"
PAGES_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, coalesce(html, '') AS body,
         list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
             16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT) + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT)
             + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT) + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS BIGINT), 1)), 'string_agg', '') AS payload_digest
  FROM (SELECT *, {_BITS} AS bits FROM pages)),
q AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS keeper FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM q"""
