"""WARC archives, each record compressed alone with a Zstandard dictionary kept at the archive's head."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rainpanel.llm.common import new_folder, settled

# Fixed values of the formats: a skippable frame that holds a dictionary, and record fields.
SKIPPABLE = 0x184D2A5D
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
SUFFIX = ".warc.zst"

#: Raw bytes of records in one archive; a task holds one archive's records at a time.
ARCHIVE_BYTES = 24 << 20
DICTIONARY_BYTES = 64 << 10
#: Records that the dictionary of an archive is trained on are spread over all of it, up to this many bytes.
SAMPLE_BYTES = 3 << 20
LEVEL = 3

#: Columns that name a page and a payload, without NULLs so that they can be joined on.
_KEY = ["__page", "__no_page", "__digest"]
_FIELDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(name: str) -> int | None:
    number = name.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def make_record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One whole record. A revisit keeps the response's HTTP header, and its length there, but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = [
        VERSION, f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:  # control characters would end the line
        lines.append("WARC-Target-URI: " + "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if revisit:
        lines += [f"WARC-Refers-To: {record_id(refers_to)}", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(records: Sequence[bytes]) -> bytes:
    """A dictionary trained on records from all over the archive; where they are too few, their own bytes."""
    total = sum(map(len, records))
    sample = [r[:1 << 17] for r in records[::max(1, total // SAMPLE_BYTES)]]
    size = min(DICTIONARY_BYTES, max(1024, total // 16))
    try:
        return zstandard.train_dictionary(size, sample, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(sample)[-size:]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict:
    return zstandard.ZstdCompressionDict(content)


def write_archive(target, records: Sequence[bytes]) -> None:
    """The dictionary in a skippable frame, then a frame for each record."""
    content = build_dictionary(records)
    target.write(struct.pack("<II", SKIPPABLE, len(content)) + content)
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(content), write_checksum=True)
    for record in records:
        target.write(packer.compress(record))


def read_archive(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record."""
    magic, size = struct.unpack_from("<II", content)
    if magic != SKIPPABLE:
        raise ValueError("an archive begins with the frame of its dictionary")
    unpacker = zstandard.ZstdDecompressor(dict_data=_dictionary(content[8:8 + size]))
    reader = unpacker.stream_reader(memoryview(content)[8 + size:], read_across_frames=True)
    buffer = bytearray()

    def fill(upto: int) -> bool:
        while len(buffer) < upto:
            if not (part := reader.read(1 << 20)):
                return False
            buffer.extend(part)
        return True

    at = 0
    while True:
        if at > 1 << 22:  # forget what has been parsed
            del buffer[:at]
            at = 0
        while (end := buffer.find(b"\r\n\r\n", at)) < 0:
            if not fill(len(buffer) + 1):
                if len(buffer) > at:
                    raise ValueError("an archive ends inside a record")
                return
        version, *lines = bytes(buffer[at:end]).decode().split("\r\n")
        if version != VERSION:
            raise ValueError(f"not a record: {version[:40]}")
        fields = dict(line.split(": ", 1) for line in lines)
        start, length = end + 4, int(fields["Content-Length"])
        if not fill(start + length + 4):
            raise ValueError("an archive ends inside a record")
        yield fields, bytes(buffer[start:start + length])
        at = start + length + 4


def describe(fields: dict[str, str], block: bytes) -> tuple[int | None, int, str, str, int | None]:
    """The columns of one record; a response's payload must agree with its header."""
    head, _, payload = block.partition(b"\r\n\r\n")
    size = int(head.rpartition(b"Content-Length: ")[2])
    digest, page = fields["WARC-Payload-Digest"].removeprefix("sha1:"), _page_of(fields["WARC-Record-ID"])
    if fields["WARC-Type"] == "revisit":
        return page, size, digest, "revisit", _page_of(fields["WARC-Refers-To"])
    if len(payload) != size or payload_digest(payload) != digest:
        raise ValueError(f"the payload of page {page} is damaged")
    return page, size, digest, "response", None


def first_copies(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``leader`` (largest id of the equal payloads) and ``copies`` for each page and digest, one row for each pair.

    Only ids and digests move here. A payload shared by any part of the table is one group that is
    combined in each task first. Payloads below ``least_bytes`` lead themselves.
    """
    keys = settled(pages.groupBy(*_KEY, "__bytes").agg(F.count(F.lit(1)).alias("copies")))
    page = F.when(~F.col("__no_page"), F.col("__page"))
    leaders = keys.filter(F.col("__bytes") >= least_bytes).groupBy("__digest").agg(F.max(page).alias("leader"))
    return keys.join(leaders, "__digest", "left").select(
        *_KEY, "copies", (F.col("__bytes") >= least_bytes).alias("shared"),
        F.when(F.col("__bytes") >= least_bytes, F.col("leader")).otherwise(page).alias("leader"))


def decide(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``html``, ``leader`` and ``revisit`` for every row.

    Payloads are moved once, for the join by page and payload, which is even where pages are. Of
    rows that repeat both, the first by url is the response and the others revisit it.
    """
    payload = F.coalesce("html", F.lit(""))
    # base32 of SHA-1 is made by the writer; grouping needs no more than the bytes themselves.
    marked = pages.select(
        "page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("__digest"),
        F.octet_length(payload).cast("long").alias("__bytes"), F.coalesce("page_id", F.lit(0)).alias("__page"),
        F.col("page_id").isNull().alias("__no_page"))
    turn = F.row_number().over(Window.partitionBy(*_KEY).orderBy("url"))  # within the join's partitions
    own = F.col("leader").eqNullSafe(F.col("page_id"))
    repeated = F.col("shared") & (F.col("copies") > 1) & (F.col("turn") > 1)
    return marked.join(first_copies(marked, least_bytes), _KEY).withColumn("turn", turn).select(
        "page_id", "url", "html", "leader", (~own | repeated).alias("revisit"))


def _location(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder else "file://" + folder.removeprefix("file:"))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Write every page as a record into archives under ``folder``; returns a row (name, records) for each.

    A task writes archives of about ``ARCHIVE_BYTES``, each under a name of its own that no other
    attempt uses, and moves it to its final name when it is whole; a repeated task replaces it.
    ``folder`` must be one that all executors share.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _location(folder)
        store.create_dir(root, recursive=True)
        context = TaskContext.get()
        done: list[tuple[str, int]] = []

        def flush(records: list[bytes]) -> None:
            name = f"part-{context.partitionId():06d}-{len(done):04d}{SUFFIX}"
            unfinished = f"{root}/_{name}.{context.taskAttemptId()}"
            with store.open_output_stream(unfinished) as target:
                write_archive(target, records)
            store.move(unfinished, f"{root}/{name}")
            done.append((name, len(records)))

        held, size = [], 0
        for batch in batches:
            for page_id, url, html, leader, revisit in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                payload = html.encode()
                held.append(make_record(page_id, url, payload, payload_digest(payload), leader, revisit))
                size += len(held[-1])
                if size >= ARCHIVE_BYTES:
                    flush(held)
                    held, size = [], 0
        if held:
            flush(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], names=["name", "records"])

    return decide(pages, least_bytes).mapInArrow(run, "name string, records long")


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """Page, payload length and digest, record type and reference, one row for each record."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = [describe(fields, block) for fields, block in read_archive(content.as_py())]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(
                        columns, (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()), strict=True)],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder)
    return files.select("content").mapInArrow(run, _FIELDS)


def warc_query(pages: DataFrame) -> DataFrame:
    """Write all pages, then read the archives back.

    A NULL html is an empty payload, a NULL url a record without a target; NULL page ids are lowest;
    an empty table writes no archive and gives an empty result. Other columns are not carried.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    written = write_archives(pages.select("page_id", "url", "html"), folder).agg(F.count("name")).first()[0]
    return read_archives(spark, folder) if written else spark.createDataFrame([], _FIELDS)
