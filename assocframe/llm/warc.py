"""WARC archives in Zstandard form: one frame per record behind a leading dictionary frame.

A file starts with a skippable frame (magic number 0x184D2A5D) that holds the
dictionary; every record is one Zstandard frame with its content size.  The
reader takes the dictionary from the first frame, walks frame by frame, and
rejects a file whose headers, lengths or digests do not agree.

Records of equal payloads of at least MIN_REVISIT bytes: that of the largest
page id is a response, the others are revisits that name it.

Defined results: a NULL html is an empty payload; a NULL page id is smaller than
all others; rows that repeat the largest id of their payload are responses each;
if all ids of a payload are NULL its records are responses; an empty table gives
an empty result and files of no records; other columns are never read.
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

from assocframe.llm.common import map_file, new_folder, read_files, write_file

DICTIONARY_MAGIC = 0x184D2A5D
FRAME_MAGIC = 0xFD2FB528
MIN_REVISIT = 1_000
#: A file is closed after so many bytes of records; a record is never split.
FILE_BYTES = 32 << 20
#: The dictionary is made of at most so many pages (those of the smallest hash), of so many bytes each.
SAMPLE_PAGES, SAMPLE_BYTES, DICTIONARY_BYTES = 400, 16_384, 32_768
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_TYPES = ("response", "revisit")


class BadArchive(ValueError):
    """A file that is no archive of this form, or whose parts disagree."""


# Records --------------------------------------------------------------------------


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """Bytes of one record; ``refers_to`` makes it a revisit without payload."""
    revisit = refers_to is not None
    block = b"" if revisit else payload
    target = " ".join((url or "urn:none").split())
    lines = [
        "WARC/1.1",
        f"WARC-Type: {_TYPES[revisit]}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Target-URI: {target}",
        "Content-Type: text/html; charset=utf-8",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Checks a record and returns page_id, payload_bytes, payload_digest, record_type, refers_to, payload."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not mark or version != "WARC/1.1":
        raise BadArchive("a record does not start with its version and headers")
    fields: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.partition(":")
        if not colon or name.lower() in fields:
            raise BadArchive(f"header {name!r} is broken or repeated")
        fields[name.lower()] = value.strip()
    needed = ("warc-type", "warc-record-id", "content-length", "warc-payload-digest", "x-payload-length")
    if any(n not in fields for n in needed) or fields["warc-type"] not in _TYPES:
        raise BadArchive("a header is missing or the record type is unknown")
    length, payload_bytes = int(fields["content-length"]), int(fields["x-payload-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive("content length and record differ")
    payload, digest = rest[:length], fields["warc-payload-digest"].removeprefix("sha1:")
    refers_to = None
    if fields["warc-type"] == "response":
        if length != payload_bytes or hashlib.sha1(payload).hexdigest() != digest:
            raise BadArchive("payload, length and digest differ")
    else:
        if length or fields.get("warc-profile") != REVISIT_PROFILE:
            raise BadArchive("a revisit has a payload or no profile")
        refers_to = _page(fields.get("warc-refers-to", ""))
        if refers_to is None:
            raise BadArchive("a revisit refers to nothing")
    return {
        "page_id": _page(fields["warc-record-id"]),
        "payload_bytes": payload_bytes,
        "payload_digest": digest,
        "record_type": fields["warc-type"],
        "refers_to": refers_to,
        "payload": payload,
    }


def _page(urn: str) -> int | None:
    if not (urn.startswith("<urn:page:") and urn.endswith(">")):
        raise BadArchive(f"{urn!r} names no page")
    return int(urn[10:-1]) if urn[10:-1] else None


# Files ----------------------------------------------------------------------------


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_MAGIC, len(dictionary)) + dictionary


def frame_length(data: memoryview) -> int:
    """Length of the Zstandard frame at the start of ``data``, from its block headers."""
    at = zstandard.frame_header_size(data)
    has_checksum = data[4] >> 2 & 1
    while True:
        if at + 3 > len(data):
            raise BadArchive("a frame is cut off")
        header = int.from_bytes(data[at : at + 3], "little")
        kind, size = header >> 1 & 3, header >> 3
        if kind == 3:
            raise BadArchive("a block type is reserved")
        at += 3 + (1 if kind == 1 else size)  # a run of one byte is stored as that byte
        if header & 1:
            break
    at += 4 * has_checksum
    if at > len(data):
        raise BadArchive("a frame is cut off")
    return at


def read_archive(data: bytes) -> Iterator[dict]:
    """The records of a file, each checked."""
    view = memoryview(data)
    if len(view) < 8:
        raise BadArchive("the file is shorter than a frame header")
    magic, size = struct.unpack_from("<II", view)
    if magic != DICTIONARY_MAGIC or 8 + size > len(view):
        raise BadArchive("the file does not start with a dictionary frame")
    dictionary = zstandard.ZstdCompressionDict(bytes(view[8 : 8 + size])) if size else None
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    at = 8 + size
    while at < len(view):
        if len(view) - at < 8 or struct.unpack_from("<I", view, at)[0] != FRAME_MAGIC:
            raise BadArchive("a record does not start a frame")
        end = at + frame_length(view[at:])
        frame = view[at:end]
        record = reader.decompress(frame)
        if len(record) != zstandard.frame_content_size(frame):
            raise BadArchive("a frame's content size and content differ")
        yield parse_record(record)
        at = end


class ArchiveWriter:
    """Collects records and hands over whole files."""

    def __init__(self, dictionary: bytes) -> None:
        held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.compress = zstandard.ZstdCompressor(
            level=3, dict_data=held, write_checksum=True, write_content_size=True
        ).compress
        self.start = dictionary_frame(dictionary)
        self.parts, self.size = [self.start], 0

    def add(self, record: bytes) -> None:
        self.parts.append(self.compress(record))
        self.size += len(record)

    def close(self) -> bytes:
        data = b"".join(self.parts)
        self.parts, self.size = [self.start], 0
        return data


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary of the sample, or none if the sample is too small for one."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


# Spark ----------------------------------------------------------------------------


def with_revisits(pages: DataFrame) -> DataFrame:
    """page_id, url, payload, digest and refers_to (NULL for responses) of every page."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    named = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    long = F.octet_length("payload") >= MIN_REVISIT
    # Only payloads that occur under several ids are looked up.
    last = (
        named.filter(long)
        .groupBy("digest")
        .agg(F.max("page_id").alias("last"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(F.col("digest").alias("_digest"), "last")
    )
    joined = named.join(last, F.col("digest") == F.col("_digest"), "left").drop("_digest")
    is_last = F.col("page_id").eqNullSafe(F.col("last"))
    return joined.withColumn("refers_to", F.when(~is_last, F.col("last"))).drop("last")


def write_archives(pages: DataFrame, folder: str | None = None) -> tuple[str, DataFrame]:
    """Writes all pages; returns the folder and one row (name, records) per file.

    Every attempt of a task writes under names of its own, each file whole and by
    renaming.  An attempt that was lost or came second may cut its files elsewhere
    and leaves them behind; the rows returned name the files of one attempt per
    task, so write those rows down once and read by them (``read_archives``).
    """
    spark = pages.sparkSession
    folder = folder or new_folder(spark, "warc")
    # Ids are drawn first, so that tasks send a few numbers to the driver, and then SAMPLE_PAGES starts of pages in all.
    drawn = pages.filter(F.length("html") >= MIN_REVISIT).select("page_id").dropna().orderBy(F.xxhash64("page_id"), "page_id")
    ids = sorted({r["page_id"] for r in drawn.limit(SAMPLE_PAGES).collect()})
    starts = pages.filter(F.col("page_id").isin(ids)).select(F.substring("html", 1, SAMPLE_BYTES).alias("html")).dropna()
    sample = sorted(r["html"] for r in starts.limit(SAMPLE_PAGES).collect())
    dictionary = train_dictionary([html.encode("utf-8", "surrogatepass") for html in sample])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        partition, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        attempt_name = f"{attempt:08d}-{uuid.uuid4().hex[:12]}"
        writer, names, counts = ArchiveWriter(dictionary), [], []
        held = 0

        def put() -> None:
            nonlocal held
            name = f"{partition:06d}-{attempt_name}-{len(names):06d}.warc.zst"
            write_file(folder, name, writer.close())
            names.append(name)
            counts.append(held)
            held = 0

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for r in batch.slice(at, 64).to_pylist():
                    writer.add(make_record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"]))
                    held += 1
                    if writer.size >= FILE_BYTES:
                        put()
        if held:
            put()
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64())], names=["name", "records"])

    made = with_revisits(pages).select("page_id", "url", "payload", "digest", "refers_to")
    return folder, made.mapInArrow(write, "name string, records bigint")


_COLUMNS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def read_archives(spark: SparkSession, folder: str, payload: bool = False, manifest: DataFrame | None = None) -> DataFrame:
    """One row per record of the archives that ``manifest`` names; a broken file fails the task.

    Without a manifest all archives in ``folder`` are read, also what lost attempts left there.
    """
    schema = _COLUMNS + ", payload binary" * payload
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in schema.split(", ")])

    by_name = manifest is not None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = batch.column(0)[k].as_py()
                held: list[dict] = []
                for record in read_archive(map_file(f"{folder}/{found}") if by_name else found):
                    held.append({n: record[n] for n in names})
                    if len(held) == 512:
                        yield pa.RecordBatch.from_pylist(held, schema=fields)
                        held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, schema=fields)

    files = read_files(spark, folder, ".warc.zst").select("content") if manifest is None else manifest.select("name")
    return files.mapInArrow(read, schema)
