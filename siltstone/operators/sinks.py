"""Sinks: manifests by category, JSON Lines, chunked Markdown."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.keys import key_category
from ..functions.rules import CATEGORIES
from ..sources import files
from ..sources.chunk_files import write_chunk_files
from ..sources.manifests import FIELDS
from .markdown import html_to_markdown
from .records import chunked, complete, document, json_line


def manifest_json(manifest: DataFrame) -> str:
    """A manifest as an indented JSON object with sorted keys. Manifests are catalogs of archives: small beside what they list."""
    rows = {r["key"]: {k: v for k, v in r.asDict().items() if k != "key" and v not in (None, "", [], 0)} for r in manifest.collect()}
    return _indented(rows)


def _indented(rows: dict) -> str:
    return json.dumps(rows, indent=2, sort_keys=True, ensure_ascii=False) + "\n"


def category_maps(manifest: DataFrame) -> DataFrame:
    """(category, value): one JSON map of key to dataset for every category in the keys. Malformed keys are left out, empty fields too."""
    present = []
    for c in FIELDS:
        kind = manifest.schema[c].dataType.typeName() if c in manifest.columns else None
        if kind is not None:
            empty = F.size(c) == 0 if kind == "array" else F.col(c) == (0 if kind in ("long", "integer") else "")
            present.append(F.when(~empty, F.col(c)).alias(c))
    keyed = manifest.withColumn("category", key_category(F.col("key"))).where("category <> ''")
    rows = keyed.groupBy("category").agg(F.array_sort(F.collect_list(F.struct("key", F.struct(*present).alias("d")))).alias("rows"))
    return rows.select("category", F.to_json(F.map_from_entries("rows")).alias("value"))


def write_manifests(manifest: DataFrame, folder: str, managed: Iterable[str] = CATEGORIES) -> None:
    """One ``<category>.json`` per category, replaced as a whole.

    Files of managed categories that the manifest no longer names are deleted;
    all others stay as they are. One category's map at a time passes the driver.
    """
    spark = manifest.sparkSession
    written = set()
    for row in category_maps(manifest).toLocalIterator():
        files.write_text(spark, f"{folder}/{row['category']}.json", _indented(json.loads(row["value"])))
        written.add(row["category"])
    for category in set(managed) - written:
        files.delete(spark, f"{folder}/{category}.json")


def write_json_lines(records: DataFrame, folder: str) -> None:
    """Complete records only, one JSON object per line."""
    records.where(complete()).select(json_line().alias("value")).write.mode("overwrite").text(folder)


def write_markdown(records: DataFrame, folder: str, slug: str, order: str, per_file: int = 1000) -> int:
    """Documents in files ``<slug>-00000.md`` and so on, of ``per_file`` each; the number of files.

    They appear together (``chunk_files``); files of the slug from an earlier run
    go, others in the folder stay.
    """
    doc = document()  # its last line end is the line separator of the sink
    rows = chunked(records, order, per_file).withColumn("value", doc.substr(F.lit(1), F.length(doc) - 1))
    write_chunk_files(rows, folder, slug)
    return -(-records.count() // per_file)


def write_pages(pages: DataFrame, folder: str, slug: str, order: str, per_file: int = 1000) -> int:
    """Markdown of pages (``html``), in the order of a unique column, in numbered files; the number of pages.

    Pages without text are left out. No pages make an empty folder.
    """
    texts = pages.select(order, html_to_markdown(F.col("html")).alias("markdown")).where("markdown <> ''")
    rows = chunked(texts, order, per_file)
    last = (F.col("position") % per_file) == 0
    # pages of one file are parted by an empty line
    write_chunk_files(rows.withColumn("value", F.when(last, F.col("markdown")).otherwise(F.concat("markdown", F.lit("\n")))), folder, slug)
    return rows.count()
