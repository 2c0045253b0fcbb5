"""WARC archives of pages with dictionary compression, written and read by Spark.

Each page becomes one WARC/1.1 record, and each record one Zstandard frame compressed with a dictionary that is built
from a bounded sample of the records. The dictionary leads every archive file in a skippable frame, so a file can be
read alone. Spark's text writer writes the frames: its line separator is an empty skippable frame, which a Zstandard
reader passes over, so an archive is a plain sequence of frames on any file system Spark can write to.

Records with equal payloads of at least ``MIN_REVISIT_BYTES`` bytes are stored once: the smallest ``page_id`` is a
response and the others are revisits that name it. Equal payloads are found by their SHA-256 in an aggregate that is
merged before the shuffle; a payload shared by a third of all pages is split by adaptive execution.

Defined results: a null html is an empty payload. Rows with equal payload and the smallest ``page_id`` are all
responses, so repeated rows of it are, too. A null ``page_id`` counts as the largest and is read back as null; a null
url is written as an empty target. Extra columns are ignored; an empty table gives an archive without records.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlane.scratch import materialise, scratch_path

MIN_REVISIT_BYTES = 100
SAMPLE_RECORDS, SAMPLE_BYTES = 1_000, 16 << 10
DICTIONARY_BYTES = 64 << 10
ARCHIVE_BYTES = 32 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"
#: Fixed values of the formats: skippable frames and the profile of a revisit by payload.
_DICTIONARY_MAGIC = 0x184D2A5D
_EMPTY_FRAME = struct.pack("<II", 0x184D2A50, 0)
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_READ = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
    "target_uri string, payload binary"
)


def _record_id(kind: str, page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.sha256(f'{kind} {page_id} {digest}'.encode()).hexdigest()[:32])}>"


def _one_line(value: str | None) -> str:
    return " ".join((value or "").split())


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A whole WARC record. A revisit has no block; its headers keep the payload's digest and length."""
    kind = "response" if refers_to is None else "revisit"
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: {_record_id(kind, page_id, digest)}",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {_one_line(url)}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: {_record_id('response', refers_to, digest)}", f"X-Refers-To-Page-ID: {refers_to}"]
    block = payload if refers_to is None else b""
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> bytes:
    """A Zstandard dictionary; empty if there are too few or too small samples to build one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _frames(dictionary: bytes):
    lead = struct.pack("<II", _DICTIONARY_MAGIC, len(dictionary)) + dictionary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        head = [lead]
        for batch in batches:
            out, size = head, 0
            head = []
            for row in zip(*(c for c in batch.columns), strict=True):
                page_id, url, html, digest, refers_to = (x.as_py() for x in row)
                out.append(writer.compress(record(page_id, url, (html or "").encode(), digest, refers_to)))
                size += len(out[-1])
                if size > 4 << 20:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
                    out, size = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
        if head:
            yield pa.RecordBatch.from_arrays([pa.array(head, pa.binary())], ["frame"])

    return run


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """page_id, url, html, payload_digest and refers_to (null for responses)."""
    digest = F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256)
    first = (
        pages.where(F.octet_length("html") >= min_bytes).select(digest.alias("payload_digest"), "page_id")
        .groupBy("payload_digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    joined = pages.withColumn("payload_digest", digest).join(materialise(first, "equal_payloads"), "payload_digest", "left")
    revisit = F.coalesce(F.col("page_id") != F.col("first"), F.col("first").isNotNull())
    return joined.select("page_id", "url", "html", "payload_digest", F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Writes ``pages`` (page_id, url, html) as archives of about ``archive_bytes`` of payload below ``path``."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    rows = with_revisits(pages)
    # The ids are picked first, so that tasks send no more html to the driver than the sample holds.
    chosen = pages.select(F.col("page_id").alias("id")).where("id IS NOT NULL").orderBy(F.xxhash64("id"), "id").limit(SAMPLE_RECORDS)
    some = pages.join(F.broadcast(chosen.distinct()), F.col("page_id") == F.col("id"), "left_semi").where("html IS NOT NULL")
    some = some.select("url", F.substring("html", 1, SAMPLE_BYTES).alias("html")).limit(SAMPLE_RECORDS)
    samples = sorted(record(0, r.url, r.html.encode(), "0" * 64, None) for r in some.collect())
    dictionary = build_dictionary(samples)
    size = pages.agg(F.sum(F.octet_length("html"))).first()[0] or 0
    parts = max(1, -(-size // archive_bytes))
    # By the page, not by the payload, so that archives are even however many pages share a payload.
    spread = rows.repartition(parts, F.xxhash64("page_id", "url"))
    frames = spread.mapInArrow(_frames(dictionary), "frame binary").select(F.col("frame").cast("string").alias("value"))
    frames.write.option("lineSep", _EMPTY_FRAME.decode("latin-1")).text(path)


def split_frames(archive: bytes) -> tuple[bytes, list[memoryview]]:
    """The dictionary and the compressed frames of an archive."""
    view, at, dictionary, frames = memoryview(archive), 0, b"", []
    while at < len(view):
        magic, size = struct.unpack_from("<II", view, at)
        if 0x184D2A50 <= magic <= 0x184D2A5F:
            if magic == _DICTIONARY_MAGIC:
                dictionary = bytes(view[at + 8 : at + 8 + size])
            at += 8 + size
        else:
            stop = frame_end(view, at)
            frames.append(view[at:stop])
            at = stop
    return dictionary, frames


def frame_end(view: memoryview, at: int) -> int:
    """Where the Zstandard frame at ``at`` ends, from its header and the sizes of its blocks."""
    at += zstandard.frame_header_size(view[at : at + 18])
    while True:
        block = int.from_bytes(view[at : at + 3], "little")
        at += 3 + (1 if (block >> 1) & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4  # the checksum


def parse_record(data: bytes) -> tuple:
    """(page_id, payload_bytes, digest, kind, refers_to, url, payload), verified against the record's own headers."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda name: int(fields[name]) if name in fields else None
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
        raise ValueError(f"the payload of {fields['WARC-Record-ID']} does not have its digest")
    return (number("X-Page-ID"), number("X-Payload-Length"), digest, kind, number("X-Refers-To-Page-ID"), fields["WARC-Target-URI"], block if kind == "response" else None)


def _records(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*"page_id payload_bytes payload_digest record_type refers_to target_uri payload".split()]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for content in batch.column(0):
                dictionary, frames = split_frames(content.as_buffer())
                known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
                reader = zstandard.ZstdDecompressor(dict_data=known)
                for at in range(0, len(frames), 500):
                    rows = [parse_record(reader.decompress(f)) for f in frames[at : at + 500]]
                    columns = [*zip(*rows, strict=True)]
                    if not with_payload:
                        columns[6] = [None] * len(rows)
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return run


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row for each record below ``path``; the payload of a revisit is null."""
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_records(with_payload), _READ)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Writes the pages and reads the archives back: the fields of every record but its payload."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archives")
    write_archives(pages, path)
    return read_archives(spark, path, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
