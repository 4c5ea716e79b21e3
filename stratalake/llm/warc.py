"""WARC archives: written by tasks, read back as a stream.

An archive is a sequence of gzip members, one per record.  The writer gives each
task's records to archives of its own, in the folder that it is told, under names
that no other attempt uses; a row of the manifest names a finished archive.  Only
what the manifest lists is read, so files of lost or repeated tasks do no harm.

The reader goes through an archive from front to back in blocks.  It inflates
member by member with an incremental decompressor, frames a record by its
content length, and verifies block and payload digests, so it holds one block and
one record at a time.

Of records with equal payloads, that with the largest page id is a response;
others are revisits that name it.  Equal means equal SHA-1 and length.  A row that
repeats the response's id is a response as well; rows without an id are responses
unless a row with an id has their payload.  A NULL payload is an empty one.  An
empty table gives no archive.  Other columns are left out.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.common import column, rows_by_batch, utf8

ARCHIVE_BYTES = 256 << 20
READ_BYTES = 1 << 18
# Payload lists shorter than this are handed to every task; longer ones are joined by shuffle.
HANDED_ROWS = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

MANIFEST = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("records", T.LongType()),
    T.StructField("bytes", T.LongType())])
RECORD = T.StructType([
    T.StructField("archive", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("target_uri", T.StringType()), T.StructField("refers_to_id", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("payload", T.BinaryType()), T.StructField("problem", T.StringType())])


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_bytes(page_id, url, payload: bytes, refers_to=None, revisit: bool = False) -> bytes:
    """One record as a gzip member: WARC headers, HTTP headers, and the payload of a response."""
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = http if revisit else http + payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
        ("WARC-Payload-Digest", f"sha1:{sha1_base32(payload)}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # Line breaks and other control characters would end the header.
        headers.append(("WARC-Target-URI", re.sub(
            r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if revisit:
        headers += [("WARC-Refers-To", f"<urn:page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block + b"\r\n\r\n") + packer.flush()


def with_responses(pages: DataFrame, id_col: str, payload_col: str) -> DataFrame:
    """(page_id, url, payload, winner): winner is the response of pages that share a payload."""
    keyed = pages.withColumn("sha", F.sha1(F.col(payload_col))).withColumn(
        "size", F.octet_length(payload_col))
    shared = (
        keyed.groupBy("sha", "size")
        .agg(F.max(id_col).alias("winner"), F.count(F.lit(1)).alias("n"))
        .where((F.col("n") > 1) & F.col("winner").isNotNull()).drop("n")
    )
    if shared.limit(HANDED_ROWS + 1).count() <= HANDED_ROWS:
        # Checked: at most 100,000 digests, some 10 MB.  The pages need not move.
        shared = F.broadcast(shared)
    return keyed.join(shared, ["sha", "size"], "left")


def write_archives(
    pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url",
    payload_col: str = "html", archive_bytes: int = ARCHIVE_BYTES,
) -> DataFrame:
    """Write a record per page to new archives in ``folder``; the manifest of what was written.

    The manifest must be stored before it is used more than once: each evaluation writes anew.
    """
    plain = pages.select(
        column(id_col).alias("page_id"), column(url_col).cast("string").alias("url"),
        F.coalesce(column(payload_col).cast("string"), F.lit("")).alias("payload"))
    sized = with_responses(plain, "page_id", "payload").select("page_id", "url", "payload", "winner")

    def write(batches) -> Iterator[dict]:
        store, root = pafs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        out, name, count, size, done = None, "", 0, 0, []
        for batch in batches:
            ids, urls, winners = (batch.column(i).to_pylist() for i in (0, 1, 3))
            for page_id, url, payload, winner in zip(ids, urls, utf8(batch, "payload"), winners):
                if out is None:
                    name, count, size = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(name, compression=None)
                revisit = winner is not None and winner != page_id
                member = record_bytes(page_id, url, payload, winner, revisit)
                out.write(member)
                count, size = count + 1, size + len(member)
                if size >= archive_bytes:
                    out.close()
                    out = None
                    done.append((name, count, size))
        if out is not None:
            out.close()
            done.append((name, count, size))
        yield {"archive": [d[0].rpartition("/")[2] for d in done], "records": [d[1] for d in done],
               "bytes": [d[2] for d in done]}

    return rows_by_batch(sized, MANIFEST, write)


def members(source: BinaryIO, block: int = READ_BYTES) -> Iterator[tuple[int, Iterator[bytes]]]:
    """(offset, inflated pieces) of each gzip member; the pieces must be used up in turn."""
    offset, rest = 0, source.read(block)
    while rest:
        inflater, used = zlib.decompressobj(31), 0

        def pieces():
            nonlocal rest, used
            data = rest
            while True:
                used += len(data)
                piece = inflater.decompress(data)
                if piece:
                    yield piece
                if inflater.eof:
                    rest = inflater.unused_data
                    used -= len(rest)
                    rest = rest or source.read(block)
                    return
                data = source.read(block)
                if not data:
                    raise EOFError("the archive ends within a record")

        yield offset, pieces()
        offset += used


def read_record(pieces: Iterator[bytes]) -> tuple[dict[str, str], bytes]:
    """Headers and block of one record, framed by its content length."""
    held = b""
    while b"\r\n\r\n" not in held:
        held += next(pieces, None) or _short()
    head, _, held = held.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record")
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    parts, have, length = [held], len(held), int(headers["content-length"])
    for piece in pieces:
        parts.append(piece)
        have += len(piece)
    held = b"".join(parts)
    if have != length + 4 or held[length:] != b"\r\n\r\n":
        raise ValueError("content length and record differ")
    return headers, held[:length]


def _short():
    raise EOFError("the record ends within its headers")


def parse_record(headers: dict[str, str], block: bytes) -> dict:
    """Fields of a record; ``problem`` says what did not verify."""
    head, _, payload = block.partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length:[ \t]*(\d+)", head)
    revisit = headers.get("warc-type") == "revisit"
    size = int(stated[1]) if stated else len(payload)
    digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
    problem = None
    if headers.get("warc-block-digest") != f"sha1:{sha1_base32(block)}":
        problem = "block digest"
    elif not revisit and sha1_base32(payload) != digest:
        problem = "payload digest"
    elif not revisit and size != len(payload):
        problem = "payload length"
    return {
        "record_id": headers.get("warc-record-id", "").strip("<>"),
        "record_type": headers.get("warc-type"), "target_uri": headers.get("warc-target-uri"),
        "refers_to_id": headers.get("warc-refers-to", "").strip("<>") or None,
        "payload_bytes": size, "payload_digest": digest,
        "payload": None if revisit else payload, "problem": problem,
    }


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """A row per record of the listed archives; an archive is read by one task, as a stream.

    A record that does not verify is kept with its ``problem``; what cannot be framed fails the job.
    """
    def read(batches) -> Iterator[dict]:
        store, root = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for name, expected in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, held, seen = [], 0, 0
                with store.open_input_stream(f"{root}/{name}", compression=None) as source:
                    for offset, pieces in members(source):
                        row = parse_record(*read_record(pieces))
                        rows.append(row | {"archive": name, "offset": offset})
                        held, seen = held + len(row["payload"] or b"") + 256, seen + 1
                        if held > 8 << 20:
                            yield {f: [r[f] for r in rows] for f in RECORD.names}
                            rows, held = [], 0
                if seen != expected:
                    raise ValueError(f"{name} has {seen} records, its manifest says {expected}")
                yield {f: [r[f] for r in rows] for f in RECORD.names}

    listed = manifest.select("archive", "records")
    tasks = max(1, listed.count())
    return rows_by_batch(listed.repartition(min(tasks, 100_000), "archive"), RECORD, read)


def page_number(uri: str):
    """The page id in a record id; NULL for a page without id."""
    return F.regexp_extract(F.col(uri), r"^urn:page:(-?\d+)$", 1).try_cast("long")
