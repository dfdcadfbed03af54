"""WARC records in ZIP archives: written by tasks, read back by byte ranges.

An archive has two stored members: the WARC data, one gzip member for each record, and an
index of the records' ranges. Being stored, both lie in the archive as they are, and a reader
gets at a record with the central directory, the index and one range of bytes.

Each task writes its own archives, rolled over at ``ARCHIVE_BYTES``, under names no other
attempt uses; only archives in the checkpointed list of finished tasks are read. Files go
through the file system that the target's URI names.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import uuid
import zipfile
from base64 import b16decode, b32decode, b32encode
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logstats.llm.common import read_table, small
from logstats.llm.zip_archive import read_members, stored_range
from logstats.scratch import checkpointed, scratch_folder

DATA, INDEX = "archive/data.warc.gz", "indexes/index.jsonl"
# Tasks that read archives, at most; each reads whole ones.
READERS = 10_000
ARCHIVE_BYTES = 64 << 20
READ_BYTES = 1 << 20
LEAST_REVISIT = 1000
# Pages carry no time of capture, so that records are the same in every run.
CAPTURED = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = (
    "page_id long, url string, payload binary, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)
ARCHIVES = "archive string, records long"


def capture_records(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """``page_id``, ``url``, ``payload`` with the record that each page becomes.

    Of equal payloads of ``least`` bytes or more the largest page_id is the response and the
    others revisit it. Repeated rows with that page_id are all responses; a row without
    page_id revisits like others, and if all are without, all are responses. Null html is
    an empty payload. Only payloads that occur more than once are joined back.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    rows = rows.withColumns(
        {"payload_bytes": F.octet_length("payload").cast("long"), "payload_digest": F.sha1("payload")}
    )
    copies = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy(F.col("payload_digest").alias("_digest"))
        .agg(F.max("page_id").alias("_response"), F.count(F.lit(1)).alias("_n"))
        .filter("_n > 1")
        .drop("_n")
    )
    joined = rows.join(small(copies), F.col("payload_digest") == F.col("_digest"), "left")
    revisit = F.col("_response").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("_response"))
    return joined.select(
        *rows.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_response")).alias("refers_to"),
    )


def _record_id(page_id: str | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def warc_record(row) -> bytes:
    """One record as a gzip member. Line ends in a URL are percent-encoded."""
    payload = row.payload if row.record_type == "response" else b""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row.payload_bytes}\r\n\r\n"
    ).encode()
    digest = b32encode(b16decode(row.payload_digest, casefold=True)).decode()
    fields = [
        ("WARC-Type", row.record_type),
        ("WARC-Record-ID", _record_id(row.page_id, row.payload_digest)),
        ("WARC-Date", CAPTURED),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + len(payload))),
    ]
    if row.url is not None:
        fields.append(("WARC-Target-URI", row.url.replace("\r", "%0D").replace("\n", "%0A")))
    if row.page_id is not None:
        fields.append(("Page-ID", row.page_id))
    if row.record_type == "revisit":
        fields.append(("WARC-Profile", PROFILE))
        fields.append(("WARC-Refers-To", _record_id(row.refers_to, row.payload_digest)))
        fields.append(("Refers-To-Page-ID", row.refers_to))
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return gzip.compress(head.encode() + http + payload + b"\r\n\r\n", 6, mtime=0)


def parse_record(data: bytes) -> tuple:
    """A record's ``RECORD`` values. A response's digest is taken from its payload."""
    head, _, block = gzip.decompress(data).partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    lengths = dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])
    size = int(lengths["Content-Length"])
    digest = b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    if fields["WARC-Type"] == "response":
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    else:
        payload = None
    page_id, refers_to = fields.get("Page-ID"), fields.get("Refers-To-Page-ID")
    return (
        None if page_id is None else int(page_id),
        fields.get("WARC-Target-URI"),
        payload,
        size,
        digest,
        fields["WARC-Type"],
        None if refers_to is None else int(refers_to),
    )


def _write_archive(folder: str, rows: Iterator, most: int) -> tuple[str, int]:
    """Write records until the archive is full or there are no more."""
    system, root = fs.FileSystem.from_uri(folder)
    name = f"pages-{uuid.uuid4().hex}.zip"
    index, at = [], 0
    with (
        system.open_output_stream(f"{root}/{name}") as out,
        zipfile.ZipFile(out, "w", zipfile.ZIP_STORED, allowZip64=True) as archive,
    ):
        with archive.open(DATA, "w", force_zip64=True) as data:
            for row in rows:
                record = warc_record(row)
                data.write(record)
                index.append(json.dumps({"offset": at, "length": len(record)}))
                at += len(record)
                if at >= most:
                    break
        archive.writestr(INDEX, "\n".join(index))
    return f"{folder}/{name}", len(index)


def write_archives(records: DataFrame, folder: str, most: int = ARCHIVE_BYTES) -> DataFrame:
    """Write all records; the list of archives, checkpointed. No rows, no archives."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = (row for batch in batches for row in batch.itertuples(index=False))
        for first in rows:
            archive = _write_archive(folder, _chained(first, rows), most)
            yield pd.DataFrame([archive], columns=["archive", "records"])

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root, recursive=True)
    columns = [name.split()[0] for name in RECORD.split(", ")]
    # As text, for pandas turns numbers with nulls among them into floats.
    ids = {name: F.col(name).cast("string") for name in ("page_id", "refers_to")}
    return checkpointed(records.select(*columns).withColumns(ids).mapInPandas(write, ARCHIVES))


def _chained(first, rest: Iterator) -> Iterator:
    yield first
    yield from rest


def archive_records(path: str) -> Iterator[tuple]:
    """The records of an archive by its index; neighbours share a read."""
    system, name = fs.FileSystem.from_uri(path)
    with system.open_input_file(name) as file:
        members = read_members(file)
        start, length = stored_range(file, members[INDEX])
        index = [json.loads(line) for line in file.read_at(length, start).decode().splitlines()]
        start, _ = stored_range(file, members[DATA])
        block, block_at = b"", 0
        for entry in index:
            at, length = entry["offset"], entry["length"]
            if at + length > block_at + len(block):
                block_at, block = at, file.read_at(max(length, READ_BYTES), start + at)
            yield parse_record(block[at - block_at : at - block_at + length])


def read_archives(archives: DataFrame) -> DataFrame:
    """All records of the listed archives; a task gets whole archives, which are bounded."""
    columns = [name.split()[0] for name in RECORD.split(", ")]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for path in (path for batch in batches for path in batch["archive"]):
            rows, held = [], 0
            for record in archive_records(path):
                rows.append(record)
                held += len(record[2] or b"")
                if held >= 16 * READ_BYTES:
                    yield _frame(rows, columns)
                    rows, held = [], 0
            if rows:
                yield _frame(rows, columns)

    # A number of partitions that is given is not merged by the size of the paths.
    parts = min(max(archives.count(), 1), READERS)
    return archives.repartition(parts, "archive").mapInPandas(read, RECORD)


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=columns)
    return frame.astype({"page_id": "Int64", "refers_to": "Int64"})


def op10_zip_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives are written in the shared folder, read back, and removed."""
    pages = read_table(spark, sf_dir, "pages")
    with scratch_folder(spark, "warc") as folder:
        archives = write_archives(capture_records(pages), folder)
        return checkpointed(
            read_archives(archives).select(
                "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
            )
        )


ORACLE = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), g AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest) END AS last
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM g
"""
