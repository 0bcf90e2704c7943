"""WARC archives with an index, and coalesced byte-range reads.

Every record is a gzip member of its own, so that an index entry (archive, offset, length)
is enough to read it. Tasks write archives through the file system that the shared folder
names and hand over the entries of the archives they finished. The index is the commit: a
file that a lost or repeated task left behind is in no entry and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stintlab.llm.common import map_batches
from stintlab.staging import new_path, settle

MIN_BYTES = 0
DATE = "2025-01-01T00:00:00Z"
# An archive is closed beyond so many bytes.
ARCHIVE_BYTES = 256 * 2**20
# One task reads so many bytes or records; ranges closer than the gap become one read.
RUN_BYTES = 32 * 2**20
RUN_RECORDS = 8_000
READ_BYTES = 8 * 2**20
GAP_BYTES = 64 * 2**10

_INDEX = (
    "archive string, offset long, length long, url string, digest string, page_id long,"
    " record_type string, refers_to long"
)


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'null' if page_id is None else page_id}>"


def _page_of(record_id: str) -> int | None:
    name = record_id.rpartition(":")[2].rstrip(">")
    return None if name == "null" else int(name)


def sha1_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def build_record(
    page_id: int | None, url: str | None, payload: bytes, revisits: bool, refers_to: int | None
) -> tuple[bytes, str]:
    """The record's bytes and its payload's digest. A revisit keeps only the response head."""
    digest = sha1_digest(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (b"" if revisits else payload)
    fields = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisits else 'response'}",
        f"WARC-Record-ID: {_record_id(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        fields.append(f"WARC-Target-URI: {quote(url, safe=':/?#[]@!$&()*+,;=%~' + chr(39))}")
    if revisits:
        fields.append(f"WARC-Refers-To: {_record_id(refers_to)}")
        fields.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", digest


def parse_record(record: bytes) -> dict:
    """What a record says, its payload checked against its digest."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    length = next(
        int(line.split(b": ")[1]) for line in http.split(b"\r\n") if line.startswith(b"Content-Length")
    )
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and (len(body) != length or sha1_digest(body) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} differs from its digest")
    refers_to = fields.get("WARC-Refers-To")
    return {
        "page_id": _page_of(fields["WARC-Record-ID"]),
        "payload_bytes": length,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": None if refers_to is None else _page_of(refers_to),
    }


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(batch.num_rows):
        yield {name: batch.column(name)[at].as_py() for name in batch.schema.names}


def with_roles(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(page_id, url, payload, first): ``first`` is the page that the row revisits, or null."""
    rows = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "utf-8").alias("payload"),
    ).withColumn("same", F.sha2("payload", 256))
    # Written, as the planner then sends it to the payloads where it is small.
    repeated = settle(
        rows.filter(F.length("payload") >= min_bytes)
        .groupBy("same")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter((F.col("n") > 1) & F.col("first").isNotNull())
        .select("same", "first")
    )
    is_first = F.coalesce(F.col("page_id") == F.col("first"), F.lit(False))
    return rows.join(repeated, "same", "left").select(
        "page_id", "url", "payload", F.when(~is_first, F.col("first")).alias("first")
    )


def write_archives(pages: DataFrame, folder: str | None = None, min_bytes: int = MIN_BYTES) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); returns the written index.

    Of rows with equal payloads of at least ``min_bytes`` bytes the one with the least
    page_id is a response and the others revisit it. Rows that share that least page_id
    are all responses, as is every row of a group without any page_id. A null html is an
    empty payload. A null url leaves its field out, other characters than a URL's are
    percent-encoded. Other columns are not looked at. No rows give an empty index.

    ``folder`` is a place that all executors reach, by default one in the shared folder.
    """
    spark = pages.sparkSession
    target = folder or f"{new_path(spark)}-warc"
    target = target if ":/" in target else f"file://{target}"

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(target)
        schema = pa.schema(
            [
                ("archive", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                ("url", pa.string()), ("digest", pa.string()), ("page_id", pa.int64()),
                ("record_type", pa.string()), ("refers_to", pa.int64()),
            ]
        )
        out, name, offset = None, "", 0
        for batch in batches:
            entries = []
            for row in _rows(batch):
                if out is None or offset >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    name, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                revisits = row["first"] is not None
                record, digest = build_record(
                    row["page_id"], row["url"], row["payload"], revisits, row["first"]
                )
                member = zlib.compress(record, level=3, wbits=31)
                out.write(member)
                entries.append(
                    {
                        "archive": f"{target}/{name}",
                        "offset": offset,
                        "length": len(member),
                        "url": row["url"],
                        "digest": digest,
                        "page_id": row["page_id"],
                        "record_type": "revisit" if revisits else "response",
                        "refers_to": row["first"],
                    }
                )
                offset += len(member)
            yield pa.RecordBatch.from_pylist(entries, schema)
        if out is not None:
            out.close()

    return settle(map_batches(with_roles(pages, min_bytes), change, _INDEX))


def byte_ranges(
    entries: Iterator[tuple[str, int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES
) -> Iterator[tuple[str, int, int, list[tuple[int, int]]]]:
    """Join entries (archive, offset, length), sorted, into reads (archive, from, to, entries)."""
    now: list = []
    for archive, offset, length in entries:
        if now and now[0] == archive and offset <= now[2] + gap and offset + length <= now[1] + most:
            now[2] = max(now[2], offset + length)
            now[3].append((offset, length))
            continue
        if now:
            yield tuple(now)
        now = [archive, offset, offset + length, [(offset, length)]]
    if now:
        yield tuple(now)


def read_records(index: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of the records that
    ``index`` selects, read from the archives.

    Each task gets a range of all entries sorted by archive and offset, so it reads forward and
    neighbours cost one read. An entry selected twice is read once and comes
    back twice. A payload that does not fit its digest is an error.
    """

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [
                ("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                ("payload_digest", pa.string()), ("record_type", pa.string()),
                ("refers_to", pa.int64()),
            ]
        )
        entries = (
            (row["archive"], row["offset"], row["length"]) for batch in batches for row in _rows(batch)
        )
        opened, source = None, None
        for archive, start, end, members in byte_ranges(entries):
            if archive != opened:
                if source is not None:
                    source.close()
                store, path = fs.FileSystem.from_uri(archive)
                source, opened = store.open_input_file(path), archive
            data = source.read_at(end - start, start)
            yield pa.RecordBatch.from_pylist(
                [
                    parse_record(zlib.decompress(data[o - start : o - start + n], wbits=31))
                    for o, n in members
                ],
                schema,
            )
        if source is not None:
            source.close()

    # The number of tasks follows what is to be read, not the size of the index.
    n_bytes, n_records = index.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count("*")).first()
    tasks = max(1, -(-n_bytes // RUN_BYTES), -(-n_records // RUN_RECORDS))
    sought = (
        index.select("archive", "offset", "length")
        .repartitionByRange(tasks, "archive", "offset")
        .sortWithinPartitions("archive", "offset")
    )
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return map_batches(sought, change, schema)
