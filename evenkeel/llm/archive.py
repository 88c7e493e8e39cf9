"""WARC archives with one Zstandard dictionary each.

An archive is a sequence of frames: first a skippable frame (magic 0x184D2A5D) that holds
the dictionary, then one Zstandard frame per record, so that any record can be read alone.
The dictionary is built from the archive's own records.

Archives are tables with one row per frame, written by Spark's own committer to the shared
folder: a task that is lost or run twice leaves no half archive, and no task needs a path that
it can open. The frames of an archive, joined in order, are its file; ``save_file`` writes it.

Cases: a NULL payload is empty, a NULL url is an empty target. Payloads under
``LEAST_SHARED`` bytes are always responses. Rows with one page_id and equal payloads: one is
the response, the others revisit it. NULL page_ids sort last, so they are responses only
where no other row has the payload; what revisits them refers to NULL. No rows give no archive.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evenkeel.llm.common import read_table, shared_folder, written

DICTIONARY_MAGIC = 0x184D2A5D
LEAST_SHARED = 100
#: an archive is closed after so many bytes of records; this bounds the memory of a task
ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 32 << 10
#: bytes of each record, and of all of an archive's records, that the dictionary is built from
SAMPLE_EACH = 4 << 10
SAMPLE_BYTES = 1 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"

FRAMES = "archive string, frame long, body binary"
RECORDS_DDL = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, block binary"
)
RECORDS = pa.schema(
    [("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
     ("record_type", pa.string()), ("refers_to", pa.int64()), ("block", pa.binary())]
)


#: a page's id with NULLs told apart, and its payload's digest: few rows have the same three
PAGE_KEY = ["no_id", "id", "payload_digest"]


def with_digests(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, payload, payload_bytes) of every page, and its ``PAGE_KEY``."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    return pages.select(
        F.col(page_id).alias("page_id"),
        F.col(url).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.col(page_id).isNull().alias("no_id"),
        F.coalesce(F.col(page_id), F.lit(0)).alias("id"),
        F.sha2(payload, 256).alias("payload_digest"),
    )


def shared_payloads(digested: DataFrame) -> DataFrame:
    """(page key, first): for every page whose payload others have too, the smallest key with that payload.

    Only ids and digests are shuffled. A payload that a third of all pages share is reduced
    to its smallest key task by task before its rows meet.
    """
    keys = digested.where(F.col("payload_bytes") >= LEAST_SHARED).groupBy(*PAGE_KEY).agg(F.count("*").alias("rows"))
    first = keys.groupBy("payload_digest").agg(F.min(F.struct("no_id", "id")).alias("first"), F.sum("rows").alias("rows"))
    return keys.drop("rows").join(first.where("rows > 1").drop("rows"), "payload_digest").select(*PAGE_KEY, "first")


def with_record_types(digested: DataFrame) -> DataFrame:
    """Adds record_type and refers_to.

    Payloads are shuffled by page id and digest together, so no key is hot however often a
    payload occurs; among rows alike in both, one is the response.
    """
    among = Window.partitionBy(*PAGE_KEY).orderBy("url")
    joined = digested.join(shared_payloads(digested), PAGE_KEY, "left").withColumn("place", F.row_number().over(among))
    is_first = (F.col("first") == F.struct("no_id", "id")) & (F.col("place") == 1)
    revisit = F.col("first").isNotNull() & ~is_first
    return joined.withColumns(
        {
            "record_type": F.when(revisit, "revisit").otherwise("response"),
            "refers_to": F.when(revisit & ~F.col("first")["no_id"], F.col("first")["id"]),
        }
    )


def record_bytes(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    payload_bytes: int,
    payload_digest: str,
    record_type: str,
    refers_to: int | None,
) -> bytes:
    """One WARC/1.1 record; a revisit carries no payload, only whom it refers to."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {record_type}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {''.join((url or '').splitlines())}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{payload_digest}",
        f"WARC-Payload-Length: {payload_bytes}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if record_type == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += [f"Content-Length: {len(payload)}", "", ""]
    return "\r\n".join(head).encode() + payload + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record; raises where the lengths don't agree."""
    head, mark, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not mark or lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(headers["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record is cut or too long")
    return headers, rest[:size]


def build_dictionary(records: list[bytes]) -> bytes:
    """A dictionary from the heads of records spread evenly over the archive; raw bytes where there are too few."""
    step = max(1, len(records) * SAMPLE_EACH // SAMPLE_BYTES)
    samples = [record[:SAMPLE_EACH] for record in records[::step]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(reversed(samples[:8]))[-DICTIONARY_BYTES:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict:
    trained = data[:4] == b"\x37\xa4\x30\xec"
    return zstandard.ZstdCompressionDict(
        data, dict_type=zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    )


def pack(records: list[bytes]) -> Iterator[bytes]:
    """The frames of one archive."""
    data = build_dictionary(records)
    yield struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=_dictionary(data), write_content_size=True)
    yield from map(compressor.compress, records)


def unpack(frames: Iterable[bytes]) -> Iterator[bytes]:
    """The records of one archive from its frames in order."""
    frames = iter(frames)
    head = next(frames)
    magic, size = struct.unpack("<II", head[:8])
    if magic != DICTIONARY_MAGIC or len(head) != size + 8:
        raise ValueError("the archive doesn't begin with its dictionary")
    reader = zstandard.ZstdDecompressor(dict_data=_dictionary(head[8:]))
    yield from map(reader.decompress, frames)


def _archives(batches: Iterator[pa.RecordBatch], part: int) -> Iterator[pa.RecordBatch]:
    """One archive, as a batch of frames, for every ``ARCHIVE_BYTES`` of records."""

    def closed(records: list[bytes], number: int) -> pa.RecordBatch:
        bodies = list(pack(records))
        name = f"{part:06d}-{number:05d}"
        return pa.RecordBatch.from_pydict(
            {"archive": [name] * len(bodies), "frame": pa.array(range(len(bodies)), pa.int64()), "body": bodies}
        )

    records, held, number = [], 0, 0
    for batch in batches:
        for row in batch.to_pylist():
            row["payload"] = b"" if row["record_type"] == "revisit" else bytes(row["payload"])
            records.append(record_bytes(**row))
            held += len(records[-1])
            if held >= ARCHIVE_BYTES:
                yield closed(records, number)
                records, held, number = [], 0, number + 1
    if records:
        yield closed(records, number)


def write_archives(typed: DataFrame, folder: str) -> DataFrame:
    """Write rows with payload, record_type and refers_to as archives; the stored frames."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _archives(batches, TaskContext.get().partitionId())

    columns = ["page_id", "url", "payload", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return written(typed.select(columns).mapInArrow(work, FRAMES), folder, "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """The records: (page_id, payload_bytes, payload_digest, record_type, refers_to, block).

    Each archive is read by one task, in frame order, with the dictionary in its first frame.
    The digest of every response is computed again from what was read, and must agree.
    """

    def work(table: pa.Table) -> pa.Table:
        out = []
        for record in unpack(table.sort_by("frame")["body"].to_pylist()):
            headers, block = parse_record(record)
            digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha256:"), headers["WARC-Type"]
            if kind == "response" and hashlib.sha256(block).hexdigest() != digest:
                raise ValueError(f"digest of {headers['WARC-Record-ID']} doesn't agree")
            refers_to = _page(headers.get("WARC-Refers-To", "<urn:page:None>"))
            out.append((_page(headers["WARC-Record-ID"]), int(headers["WARC-Payload-Length"]), digest, kind, refers_to, block))
        columns = [pa.array(column, field.type) for column, field in zip(zip(*out, strict=True), RECORDS, strict=True)]
        return pa.Table.from_arrays(columns, schema=RECORDS)

    return archives.groupBy("archive").applyInArrow(work, RECORDS_DDL)


def _page(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "None" else int(name)


def save_file(archives: DataFrame, archive: str, path: str) -> None:
    """Write one archive as a ``.warc.zst`` file, frame by frame."""
    with open(path, "wb") as out:
        for row in archives.where(F.col("archive") == archive).orderBy("frame").toLocalIterator():
            out.write(row["body"])


def archive_pages(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", folder: str | None = None
) -> DataFrame:
    """Archive every page and return the stored frames."""
    folder = folder or shared_folder(pages.sparkSession)
    return write_archives(with_record_types(with_digests(pages, page_id, url, html)), folder)


def archived_pages(spark, sf_dir: str) -> DataFrame:
    """``op10``: write all pages as archives, read them back and return each record's digest."""
    return read_archives(archive_pages(read_table(spark, sf_dir, "pages"))).drop("block")
