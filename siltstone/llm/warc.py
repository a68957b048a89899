"""WARC archives: one gzip member per record, and a sequential reader.

The writer puts every page into one archive per task of the shared folder. Of
pages with equal payloads one is a response, the others are revisit records that
refer to it. The reader inflates an archive piece by piece, frames records by
their content length, and verifies block and payload digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_dir, stage_table

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PIECE = 64 << 10


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _header_lines(fields: list[tuple[str, str]]) -> bytes:
    return b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)


def record_member(record_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None) -> bytes:
    """One gzip member. A revisit (payload None) keeps the HTTP header of its response, without the body."""
    http = b"HTTP/1.1 200 OK\r\n" + _header_lines([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))]) + b"\r\n"
    block = http + (payload or b"")
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        ("WARC-Type", "response" if payload is not None else "revisit"),
        ("WARC-Record-ID", f"<urn:page:{'' if record_id is None else record_id}>"),
        ("WARC-Target-URI", target),
        ("WARC-Date", "2000-01-01T00:00:00Z"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{base32_sha1(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if payload is None:
        fields += [("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>"), ("WARC-Profile", PROFILE)]
    fields.append(("Content-Length", str(len(block))))
    squeeze = zlib.compressobj(3, zlib.DEFLATED, 31)
    return squeeze.compress(VERSION + b"\r\n" + _header_lines(fields) + b"\r\n" + block + b"\r\n\r\n") + squeeze.flush()


class BadArchive(ValueError):
    pass


def _members(source: BinaryIO) -> Iterator[Iterator[bytes]]:
    """The inflated pieces of each gzip member in turn; a member must be read to its end before the next."""
    pending = source.read(PIECE)
    while pending:
        inflate = zlib.decompressobj(31)
        rest: list[bytes] = []

        def pieces(first: bytes, inflate=inflate, rest=rest) -> Iterator[bytes]:
            feed = first
            while not inflate.eof:
                if not feed:
                    raise BadArchive("the archive ends inside a member")
                piece = inflate.decompress(feed, PIECE)
                feed = inflate.unconsumed_tail or (b"" if inflate.eof else source.read(PIECE))
                if piece:
                    yield piece
            rest.append(inflate.unused_data)

        yield pieces(pending)
        if not inflate.eof:
            raise BadArchive("a member was left before its end")
        pending = rest[0] or source.read(PIECE)


def read_records(source: BinaryIO) -> Iterator[dict]:
    """The records of an archive in order: headers (lower-case names), payload_bytes, payload_digest, valid.

    Memory is bounded by the largest header, not by a record: blocks are hashed
    as they are inflated.
    """
    for member in _members(source):
        head = b""
        while (cut := head.find(b"\r\n\r\n")) < 0:
            piece = next(member, None)
            if piece is None:
                raise BadArchive("a record without an end of its header")
            head += piece
        lines = head[:cut].decode().split("\r\n")
        if lines[0].encode() != VERSION:
            raise BadArchive(f"not a WARC 1.1 record: {lines[0][:40]!r}")
        fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        left = int(fields["content-length"])
        block_hash, payload_hash = hashlib.sha1(), hashlib.sha1()
        http, in_body, body = b"", False, 0
        data, tail = head[cut + 4 :], b""
        while True:
            part, over = data[:left], data[left:]
            left -= len(part)
            tail += over
            block_hash.update(part)
            if not in_body:
                http += part
                if (end := http.find(b"\r\n\r\n")) >= 0:
                    in_body, part, http = True, http[end + 4 :], http[:end]
            if in_body:
                payload_hash.update(part)
                body += len(part)
            if (data := next(member, None)) is None:
                break
        if left or tail != b"\r\n\r\n":
            raise BadArchive("a record's block doesn't have its content length")
        digest = lambda h: base64.b32encode(h.digest()).decode()
        valid = fields.get("warc-block-digest") == f"sha1:{digest(block_hash)}"
        if fields["warc-type"] == "response":
            size, own = body, digest(payload_hash)
            valid = valid and fields.get("warc-payload-digest") == f"sha1:{own}"
        else:  # the payload itself is with the response
            size = int(re.search(rb"(?im)^content-length: *(\d+)", http)[1])
            own = fields["warc-payload-digest"].removeprefix("sha1:")
        yield {"headers": fields, "payload_bytes": size, "payload_digest": own, "valid": valid}


def _open(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def write_archives(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write the pages as archives into the shared folder; return (path, n_records), one row per archive.

    Of pages with equal payloads of at least ``least`` bytes those with the
    largest ``key`` are responses, the others revisit it; rows that repeat a key
    and its payload are responses alike. A null html is an empty payload; null
    keys come before all others. Every attempt of a task writes a file of its
    own and renames it, so a repeated task leaves one whole archive.
    """
    spark = pages.sparkSession
    folder = f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    if ":" not in folder.split("/")[0]:
        folder = f"file://{folder}"
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    addressed = pages.select(F.col(key).alias("page"), F.col(url).cast("string").alias("page_url"), payload.alias("payload"), F.sha1(payload).alias("digest"))
    # a small table of (digest, last page); both sides of the join are exchanged, so a hot payload can be split
    last = stage_table(
        pages.select(F.col(key).alias("page"), F.sha1(payload).alias("digest")).groupBy("digest").agg(F.max("page").alias("last_page"), F.count("*").alias("n")).where("n > 1").drop("n")
    )
    # Only a response needs its payload: revisits drop it before the exchange that spreads the pages.
    joined = addressed.join(last, "digest", "left")
    big = F.length("payload") >= least
    revisit = F.col("last_page").isNotNull() & big & ~F.col("page").eqNullSafe(F.col("last_page"))
    rows = joined.select(
        "page", "page_url", F.when(~revisit, F.col("payload")).alias("payload"), F.length("payload").cast("long").alias("size"), "digest",
        F.when(revisit, F.col("last_page")).alias("refers_to"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        files, base = _open(folder)
        files.create_dir(base, recursive=True)
        final, attempt = f"{base}/part-{task.partitionId():06d}.warc.gz", f"{base}/.attempt-{uuid.uuid4().hex}"
        n = 0
        with files.open_output_stream(attempt) as out:
            for batch in batches:
                for row in batch.to_pylist():
                    digest = base64.b32encode(bytes.fromhex(row["digest"])).decode()
                    out.write(record_member(row["page"], row["page_url"], row["payload"], row["size"], digest, row["refers_to"]))
                    n += 1
        if n:
            files.move(attempt, final)
            yield pa.RecordBatch.from_pydict({"path": [f"{folder}/{final.rsplit('/', 1)[1]}"], "n_records": pa.array([n], pa.int64())})
        else:
            files.delete_file(attempt)

    return stage_table(rows.mapInArrow(write, "path string, n_records long"))


def read_archives(spark, archives: DataFrame) -> DataFrame:
    """The records of archives named in column ``path``, in one row each.

    Columns: record_id, url, payload_bytes, payload_digest, record_type,
    refers_to, valid (block and payload digests agree). A broken archive fails
    the query rather than losing records.
    """
    schema = T.StructType(
        [T.StructField(n, t) for n, t in (("record_id", T.LongType()), ("url", T.StringType()), ("payload_bytes", T.LongType()), ("payload_digest", T.StringType()), ("record_type", T.StringType()), ("refers_to", T.LongType()), ("valid", T.BooleanType()))]
    )

    def number(value: str | None) -> int | None:
        found = re.fullmatch(r"<urn:page:(-?\d+)>", value or "")
        return int(found[1]) if found else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, name = _open(path)
                with files.open_input_stream(name, compression=None) as source:
                    for r in read_records(source):
                        h = r["headers"]
                        out.append(
                            {
                                "record_id": number(h["warc-record-id"]), "url": h.get("warc-target-uri"), "payload_bytes": r["payload_bytes"], "payload_digest": r["payload_digest"],
                                "record_type": h["warc-type"], "refers_to": number(h.get("warc-refers-to")), "valid": r["valid"],
                            }
                        )
                        if len(out) >= 4096:
                            yield pa.RecordBatch.from_pylist(out, arrow)
                            out = []
        yield pa.RecordBatch.from_pylist(out, arrow)

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    # an archive is read by one task; the explicit number keeps adaptive execution from putting them together
    return archives.select("path").repartition(max(1, archives.count()), "path").mapInArrow(read, schema)


def op4(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    records = read_archives(spark, write_archives(pages))
    return records.select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")
