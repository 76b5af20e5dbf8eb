"""WARC archives, index first.

Writing yields one index row per record (file, offset, length, URL, digest), stored before anything
is read. Reading starts from the index: the rows asked for are sorted by place, near ones are
joined into one byte range, and only these ranges are fetched.

Every record is a gzip member of its own, so a range that starts at a record can be unpacked alone.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm import common
from gaugeflow.session import fresh_dir

LEAST_DEDUPED = 100
_LINE = b"\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX_SCHEMA = (
    "file string, offset long, length long, url string, payload_digest string, page_id long, "
    "record_type string"
)
RECORD_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, payload binary"
)


def _arrays(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [part.split() for part in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)],
        [name for name, _ in fields],
    )


def _header_text(value: str | None) -> bytes:
    """One header line's value: control characters would end the line, so they are escaped."""
    return re.sub(rb"[\x00-\x1f\x7f]", lambda m: b"%%%02X" % m[0][0], (value or "").encode())


def record_bytes(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None
) -> bytes:
    """One record, packed. A revisit keeps digest and size of the payload, but not the payload."""
    kind = b"response" if refers_to is None else b"revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
    block = http % len(payload) + (payload if refers_to is None else b"")
    record_id = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {digest}")
    headers = [
        b"WARC/1.1",
        b"WARC-Type: " + kind,
        b"WARC-Record-ID: <urn:uuid:%s>" % str(record_id).encode(),
        b"WARC-Date: 1970-01-01T00:00:00Z",
        b"WARC-Target-URI: " + _header_text(url),
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        b"WARC-Block-Digest: sha256:" + hashlib.sha256(block).hexdigest().encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
        b"X-Payload-Length: %d" % len(payload),
    ]
    if page_id is not None:
        headers.append(b"X-Page-Id: %d" % page_id)
    if refers_to is not None:
        headers.append(b"WARC-Profile: " + REVISIT_PROFILE.encode())
        headers.append(b"X-Refers-To-Page-Id: %d" % refers_to)
    raw = _LINE.join(headers) + _LINE * 2 + block + _LINE * 2
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def parse_record(member: bytes) -> tuple:
    """The row of RECORD_SCHEMA that a packed record holds; checks sizes and digests."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(_LINE * 2)
    version, *lines = head.split(_LINE)
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(b": ", 1) for line in lines)
    block = rest[: int(fields[b"Content-Length"])]
    if fields[b"WARC-Block-Digest"] != b"sha256:" + hashlib.sha256(block).hexdigest().encode():
        raise ValueError("block digest differs")
    _, _, payload = block.partition(_LINE * 2)
    kind = fields[b"WARC-Type"].decode()
    digest = fields[b"WARC-Payload-Digest"].decode().removeprefix("sha256:")
    size, refers_to = int(fields[b"X-Payload-Length"]), None
    if kind == "response":
        size, digest_now = len(payload), hashlib.sha256(payload).hexdigest()
        if digest_now != digest:
            raise ValueError("payload digest differs")
    else:
        refers_to, payload = int(fields[b"X-Refers-To-Page-Id"]), None
    page_id = fields.get(b"X-Page-Id")
    return (
        None if page_id is None else int(page_id),
        fields[b"WARC-Target-URI"].decode(),
        size,
        digest,
        kind,
        refers_to,
        payload,
    )


def with_revisits(pages: DataFrame, least: int = LEAST_DEDUPED) -> DataFrame:
    """Adds digest and refers_to to (page_id, url, html).

    Digests are grouped without the payloads, summed in each map task first; only the rows of
    repeated payloads, as (page_id, refers_to), meet the pages again.
    """
    digested = pages.withColumn("digest", F.sha2(F.col("html").cast("binary"), 256))
    narrow = digested.filter(F.octet_length("html") >= least).select("page_id", "digest")
    first = narrow.groupBy("digest").agg(
        F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")
    )
    first = first.filter(F.col("last") > F.col("refers_to")).drop("last")
    revisits = narrow.join(first, "digest").filter(F.col("page_id") > F.col("refers_to"))
    # A page_id may repeat with other payloads, so the digest belongs to the key.
    return digested.join(revisits.distinct(), ["page_id", "digest"], "left")


def write_archive(
    pages: DataFrame, folder: str, roll_bytes: int = 1 << 30, least: int = LEAST_DEDUPED
) -> DataFrame:
    """Writes (page_id, url, html) as WARC files in folder; returns the stored index."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, None, 0
        for batch in common.cut_batches(batches, "html"):
            found = []
            for page_id, url, html, digest, refers_to in zip(
                *(batch[c].to_pylist() for c in ("page_id", "url", "html", "digest", "refers_to")),
                strict=True,
            ):
                if out is None or at >= roll_bytes:
                    if out is not None:
                        out.close()
                    (name, out), at = common.new_file(folder, ".warc.gz"), 0
                member = record_bytes(page_id, url, html.encode(), digest, refers_to)
                out.write(member)
                kind = "response" if refers_to is None else "revisit"
                found.append((name, at, len(member), url, digest, page_id, kind))
                at += len(member)
            yield _arrays(found, INDEX_SCHEMA)
        if out is not None:
            out.close()

    ready = with_revisits(pages, least).select("page_id", "url", "html", "digest", "refers_to")
    return common.stored(common.arrow_map(ready, write, INDEX_SCHEMA), "warc-index")


#: Bytes of records that a task reads, about.
READ_BYTES = 16 << 20


def coalesce_ranges(
    places: list[tuple[int, int]], gap: int, most: int
) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, places inside) of byte ranges that cover sorted (offset, length) places.

    Places at most gap bytes apart share a range, until it has most bytes.
    """
    inside: list[tuple[int, int]] = []
    start = end = 0
    for offset, length in places:
        if inside and (offset - end > gap or offset + length - start > most):
            yield start, end, inside
            inside = []
        if not inside:
            start = offset
        inside.append((offset, length))
        end = max(end, offset + length)
    if inside:
        yield start, end, inside


def read_records(
    index: DataFrame, folder: str, gap: int = 1 << 16, most: int = 4 << 20, payloads: bool = True
) -> DataFrame:
    """The records of the index rows given, any selection of them, as RECORD_SCHEMA.

    Rows are dealt by file and by stretches of 64 MB, so a large archive is read by many tasks.
    Repeated index rows give repeated records.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = common.open_fs(folder)
        opened: tuple[str | None, pa.NativeFile | None] = (None, None)
        for batch in batches:
            files = batch["file"].to_pylist()
            places = list(zip(batch["offset"].to_pylist(), batch["length"].to_pylist(), strict=True))
            start = 0
            while start < len(files):
                end = start
                while end < len(files) and files[end] == files[start]:
                    end += 1
                if opened[0] != files[start]:
                    opened = files[start], system.open_input_file(f"{path}/{files[start]}")
                for low, high, inside in coalesce_ranges(places[start:end], gap, most):
                    data = opened[1].read_at(high - low, low)
                    rows = [parse_record(data[o - low : o - low + n]) for o, n in inside]
                    yield _arrays([r if payloads else (*r[:-1], None) for r in rows], RECORD_SCHEMA)
                start = end

    stretch = F.expr(f"offset div {64 << 20}")
    # As many tasks as there are records to read; the index alone would look small to the engine.
    total = index.agg(F.sum("length")).first()[0] or 0
    tasks = 1 + total // READ_BYTES
    near = index.select("file", "offset", "length").repartition(tasks, F.col("file"), stretch)
    return common.arrow_map(near.sortWithinPartitions("file", "offset"), read, RECORD_SCHEMA)


def archive_pages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """Writes every page as a record, reads all records back; RECORD_SCHEMA without payload.

    A null html is an empty payload and a null url an empty one. Among equal payloads of at least
    100 bytes the smallest page_id is the response; rows that repeat it with the same payload are
    responses too. A page without an id never refers to another and is not referred to. A page of
    any length is one record, built in memory. Other columns are ignored, whatever their names. An
    empty table gives no rows.
    """
    narrow = pages.select(
        F.col(id_col).cast("long").alias("page_id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("html"),
    )
    folder = fresh_dir(pages.sparkSession, "warc")
    index = write_archive(narrow, folder)
    return read_records(index, folder, payloads=False).drop("payload")


ORACLE_SQL = """
WITH digested AS (
    SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes,
        sha256(coalesce(html, '')) AS payload_digest FROM pages),
firsts AS (
    SELECT payload_digest, min(page_id) AS page_id FROM digested
    WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT d.page_id, coalesce(d.url, '') AS url, d.payload_bytes, d.payload_digest,
    CASE WHEN f.page_id < d.page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN f.page_id < d.page_id THEN f.page_id END AS refers_to
FROM digested AS d LEFT JOIN firsts AS f
    ON f.payload_digest = d.payload_digest AND d.payload_bytes >= 100
"""
