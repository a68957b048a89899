"""A sink of numbered text files that appears as a whole, or not at all.

Each task writes its files beside their place; the driver then puts the new
folder in the place of the old one with two renames, however many files there
are. An aborted write leaves the old folder as it was.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

from .footers import opened


@dataclass
class Written(WriterCommitMessage):
    files: int


class ChunkFilesWriter(DataSourceWriter):
    def __init__(self, options):
        self.folder = options["path"].rstrip("/")
        self.slug, self.extension = options["slug"], options.get("extension", "md")
        head, _, tail = self.folder.rpartition("/")
        self.beside = f"{head}/.{tail}-{uuid.uuid4().hex}" if head else f".{tail}-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator) -> Written:
        """Rows (file_seq, value), those of one file together and in order; a repeated task writes the same files again."""
        system, beside = opened(self.beside)
        system.create_dir(beside, recursive=True)
        current, out, part, n = None, None, "", 0
        try:
            for seq, value in iterator:
                if seq != current:
                    if out is not None:
                        self._close(system, beside, out, part, current)
                    current, n, part = seq, n + 1, f"{beside}/.{uuid.uuid4().hex}"
                    out = system.open_output_stream(part)
                out.write(value.encode() + b"\n")
            if out is not None:
                self._close(system, beside, out, part, current)
                out = None
        finally:
            if out is not None:
                out.close()
                system.delete_file(part)
        return Written(n)

    def _close(self, system, beside: str, out, part: str, seq: int) -> None:
        out.close()
        system.move(part, f"{beside}/{self.slug}-{seq:05d}.{self.extension}")

    def commit(self, messages: list[Written]) -> None:
        from pyarrow import fs

        system, beside = opened(self.beside)
        _, folder = opened(self.folder)
        system.create_dir(beside, recursive=True)
        if system.get_file_info(folder).type == fs.FileType.NotFound:
            system.move(beside, folder)
            return
        own = re.compile(rf"{re.escape(self.slug)}-\d+\.{re.escape(self.extension)}")
        others = [f.base_name for f in system.get_file_info(fs.FileSelector(folder)) if not own.fullmatch(f.base_name)]
        aside = f"{beside}-old"
        system.move(folder, aside)
        try:
            system.move(beside, folder)
        except OSError:
            system.move(aside, folder)
            raise
        for name in others:  # what other writers have put there stays
            system.move(f"{aside}/{name}", f"{folder}/{name}")
        system.delete_dir(aside)

    def abort(self, messages: list) -> None:
        from pyarrow import fs

        system, beside = opened(self.beside)
        if system.get_file_info(beside).type != fs.FileType.NotFound:
            system.delete_dir(beside)


class ChunkFilesSource(DataSource):
    """``df.write.format("chunk_files")`` of (file_seq, value): files ``<slug>-00000.md`` and so on. Options: path, slug, extension."""

    @classmethod
    def name(cls):
        return "chunk_files"

    def writer(self, schema, overwrite):
        if not overwrite:
            raise ValueError("chunk_files replaces what is there: write it with mode overwrite")
        return ChunkFilesWriter(self.options)


def write_chunk_files(rows: DataFrame, folder: str, slug: str, extension: str = "md") -> None:
    """Write ``value`` of the rows to a file for each file_seq, by position. The slug's files of an earlier run go; others stay."""
    rows.sparkSession.dataSource.register(ChunkFilesSource)
    dealt = rows.repartition("file_seq").sortWithinPartitions("file_seq", "position").select("file_seq", "value")
    path = folder if "://" in folder else os.path.abspath(folder)
    dealt.write.format("chunk_files").mode("overwrite").option("path", path).option("slug", slug).option("extension", extension).save()
