"""ZIM archives: entries, contents and Markdown.

The directory is read by a Python data source in runs of entries. Contents are
read where the entries have been sorted by their cluster: what moves between
tasks is the directory, never the contents, and clusters that no wanted entry
points to aren't read.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .footers import opened

# Fixed values of the format: magic number, versions, marks in place of a MIME type, compressions, the bit for wide offsets.
MAGIC = 72173914
VERSIONS = (5, 6)
REDIRECT, LINK, DELETED = 0xFFFF, 0xFFFE, 0xFFFD
PLAIN, XZ, ZSTANDARD = (0, 1), 4, 5
WIDE = 0x10

ENTRIES_PER_TASK = 20_000
CLUSTERS_PER_RUN = 16
PIECE = 1 << 20
SCHEMA = "archive string, entry long, namespace string, path string, title string, mime string, cluster long, blob long, redirect long"


class Header(NamedTuple):
    entries: int
    clusters: int
    paths_at: int
    clusters_at: int
    mimes_at: int
    checksum_at: int


def read_at(source, place: int, n: int) -> bytes:
    """Exactly n bytes from a place on."""
    source.seek(place)
    got = source.read(n)
    if len(got) < n:
        raise ValueError(f"archive ends at byte {place + len(got)}, {place + n} needed")
    return got


def zero_ended(source, place: int, n: int = 1) -> tuple[list[bytes], int]:
    """n zero-ended strings from a place on, and the place behind them."""
    held, size = b"", 256
    while True:
        source.seek(place)
        held = source.read(size)
        if held.count(b"\0") >= n:
            parts = held.split(b"\0")[:n]
            return parts, place + sum(map(len, parts)) + n
        if len(held) < size:
            raise ValueError(f"archive ends inside a string at byte {place + len(held)}")
        size *= 4


def header(source) -> Header:
    magic, version = struct.unpack_from("<IH", read_at(source, 0, 80))
    if magic != MAGIC:
        raise ValueError("not a ZIM archive")
    if version not in VERSIONS:
        raise ValueError(f"version {version} of the format is not known")
    entries, clusters, paths_at, _, clusters_at, mimes_at, _, _, checksum_at = struct.unpack_from("<IIQQQQIIQ", read_at(source, 0, 80), 24)
    return Header(entries, clusters, paths_at, clusters_at, mimes_at, checksum_at)


def mime_types(source, place: int) -> list[str]:
    """The list of MIME types, which ends at an empty one."""
    out = []
    while True:
        (one,), place = zero_ended(source, place)
        if not one:
            return out
        out.append(one.decode())


def dirent(source, place: int, mimes: Sequence[str], head: Header) -> tuple:
    """namespace, path, title, mime, cluster, blob and redirect of one entry."""
    kind, _, namespace, _, first = struct.unpack("<HBBII", read_at(source, place, 12))
    cluster = blob = redirect = mime = None
    behind = place + 12
    if kind == REDIRECT:
        redirect = first
        if redirect >= head.entries:
            raise ValueError(f"redirect to entry {redirect} of {head.entries}")
    elif kind in (LINK, DELETED):
        behind = place + 8
    elif kind >= len(mimes):
        raise ValueError(f"MIME type {kind} of {len(mimes)}")
    else:
        mime, cluster, blob, behind = mimes[kind], first, *struct.unpack("<I", read_at(source, behind, 4)), behind + 4
        if cluster >= head.clusters:
            raise ValueError(f"cluster {cluster} of {head.clusters}")
    (path, title), _ = zero_ended(source, behind, 2)
    return chr(namespace), path.decode(errors="replace"), (title or path).decode(errors="replace"), mime, cluster, blob, redirect


class Cluster:
    """The blobs of one cluster. A compressed one is held as a whole; of a plain one, only what is asked for is read."""

    def __init__(self, source, number: int, head: Header):
        (place,) = struct.unpack("<Q", read_at(source, head.clusters_at + 8 * number, 8))
        (info,) = read_at(source, place, 1)
        packing, self.width = info & 0x0F, 8 if info & WIDE else 4
        self.number, self.source, self.place, self.held = number, source, place + 1, None
        if packing not in PLAIN:
            self.held = self._unpacked(packing, head.checksum_at)
        (first,) = self._numbers(0, 1)
        if first < self.width or first % self.width:
            raise ValueError(f"cluster {number}: offsets are broken")
        self.blobs = first // self.width - 1

    def _unpacked(self, packing: int, end: int) -> bytes:
        """Unpack piece by piece up to the stream's own end, so that the length of the cluster needn't be known."""
        if packing == XZ:
            import lzma

            unpack = lzma.LZMADecompressor()
        elif packing == ZSTANDARD:
            import zstandard

            unpack = zstandard.ZstdDecompressor().decompressobj()
        else:
            raise ValueError(f"cluster {self.number}: compression {packing} is not known")
        out, place = [], self.place
        try:
            while not unpack.eof:
                self.source.seek(place)
                piece = self.source.read(min(PIECE, max(0, end - place)))
                if not piece:
                    raise ValueError(f"cluster {self.number} is cut off")
                place += len(piece)
                out.append(unpack.decompress(piece))
        except ValueError:
            raise
        except Exception as e:  # errors of the two libraries have no common class
            raise ValueError(f"cluster {self.number}: {e}") from e
        return b"".join(out)

    def _bytes(self, start: int, n: int) -> bytes:
        if self.held is None:
            return read_at(self.source, self.place + start, n)
        if start + n > len(self.held):
            raise ValueError(f"cluster {self.number} is cut off")
        return self.held[start : start + n]

    def _numbers(self, first: int, n: int) -> tuple[int, ...]:
        return struct.unpack(f"<{n}{'Q' if self.width == 8 else 'I'}", self._bytes(first * self.width, n * self.width))

    def __getitem__(self, blob: int) -> bytes:
        if blob >= self.blobs:
            raise ValueError(f"cluster {self.number}: blob {blob} of {self.blobs}")
        start, end = self._numbers(blob, 2)
        if end < start:
            raise ValueError(f"cluster {self.number}: offsets are broken")
        return self._bytes(start, end - start)


class ArchiveReader(DataSourceReader):
    """One partition per run of entries. The driver reads the headers only."""

    def __init__(self, options):
        self.paths = [p for p in options["path"].split("\n") if p]
        self.run = int(options.get("entriesPerTask", str(ENTRIES_PER_TASK)))

    def partitions(self):
        out = []
        for path in self.paths:
            system, inside = opened(path)
            with system.open_input_file(inside) as source:
                n = _named(path, header, source).entries
            out += [InputPartition((path, first, min(first + self.run, n))) for first in range(0, n, self.run)]
        return out or [InputPartition(("", 0, 0))]

    def read(self, partition):
        path, first, last = partition.value
        if first == last:
            return
        system, inside = opened(path)
        with system.open_input_file(inside) as source:
            head = header(source)
            mimes = mime_types(source, head.mimes_at)
            places = struct.unpack(f"<{last - first}Q", _named(path, read_at, source, head.paths_at + 8 * first, 8 * (last - first)))
            for entry, place in enumerate(places, first):
                yield path, entry, *_named(path, dirent, source, place, mimes, head)


def _named(path: str, read, *args):
    """The result of ``read``; what is wrong with an archive is an error that names it."""
    try:
        return read(*args)
    except ValueError as e:
        raise ValueError(f"{path}: {e}") from e


class ArchiveSource(DataSource):
    """``spark.read.format("zim_archive")``: the entries of archives. Options: path (several by line ends), entriesPerTask."""

    @classmethod
    def name(cls):
        return "zim_archive"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return ArchiveReader(self.options)


def read_entries(spark: SparkSession, *paths: str) -> DataFrame:
    """archive, entry, namespace, path, title, mime, and either cluster and blob or redirect (an entry's number).

    An archive without entries gives no rows; a file that is no archive, or is
    cut off, is an error.
    """
    spark.dataSource.register(ArchiveSource)
    whole = [p if "://" in p else os.path.abspath(p) for p in paths]
    return spark.read.format("zim_archive").option("path", "\n".join(whole)).load()


def _contents(batches: Iterator[pa.RecordBatch], out: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Add each row's content. Rows come sorted by archive and cluster, so that one cluster at a time is held."""
    at = held = source = head = None
    try:
        for batch in batches:
            rows, contents, size, first = batch.to_pydict(), [], 0, 0
            for k, place in enumerate(zip(rows["archive"], rows["cluster"], rows["blob"], strict=True)):
                path, cluster, blob = place
                if at is None or path != at[0]:
                    if source is not None:
                        source.close()
                    system, inside = opened(path)
                    source, at = system.open_input_file(inside), None
                    head = _named(path, header, source)
                if at != (path, cluster):
                    held, at = _named(path, Cluster, source, cluster, head), (path, cluster)
                contents.append(_named(path, held.__getitem__, blob))
                size += len(contents[-1])
                if size >= 16 * PIECE:
                    yield pa.RecordBatch.from_arrays([*batch.slice(first, len(contents)).columns, pa.array(contents, pa.binary())], schema=out)
                    contents, size, first = [], 0, k + 1
            if contents:
                yield pa.RecordBatch.from_arrays([*batch.slice(first).columns, pa.array(contents, pa.binary())], schema=out)
    finally:
        if source is not None:
            source.close()


def with_contents(entries: DataFrame) -> DataFrame:
    """The entries that have content, with it (``content``, binary). Redirects have none and go.

    Entries are dealt by runs of clusters: each cluster is unpacked by one task,
    once, and an archive of any size is spread over all tasks.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    run = F.floor(F.col("cluster") / CLUSTERS_PER_RUN)
    found = entries.where("cluster IS NOT NULL").repartition("archive", run).sortWithinPartitions("archive", "cluster", "blob")
    kinds = T.StructType([*found.schema.fields, T.StructField("content", T.BinaryType())])
    arrow = to_arrow_schema(kinds)
    return found.mapInArrow(lambda batches: _contents(batches, arrow), kinds)


def is_page() -> Column:
    """Entries of the namespaces of articles that hold HTML."""
    return F.col("namespace").isin("A", "C") & F.lower("mime").startswith("text/html")


def read_html(spark: SparkSession, *paths: str) -> DataFrame:
    """archive, entry, path, title and html of the pages of archives. Bytes that are no UTF-8 become replacement marks."""
    pages = with_contents(read_entries(spark, *paths).where(is_page()))
    return pages.select("archive", "entry", "path", "title", F.make_valid_utf8(F.col("content").cast("string")).alias("html"))
