"""The footers of Parquet shards as a table: row groups, counts and bounds, without reading any data.

Footers are read where Spark puts the paths, a few kilobytes of each shard. The
index says which shards and row groups can hold what is asked for.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA = "path string, row_group int, first_row long, n_rows long, n_bytes long, bounds map<string, struct<low: string, high: string, nulls: bigint>>"
_BOUNDS = pa.map_(pa.string(), pa.struct([("low", pa.string()), ("high", pa.string()), ("nulls", pa.int64())]))
PATHS_PER_TASK = 64


def opened(path: str):
    """The file system of a path, and the path in it. Paths without a scheme are local."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else os.path.abspath(path))


def _text(value: object) -> str | None:
    return None if value is None else value.decode(errors="replace") if isinstance(value, bytes) else str(value)


def _footers(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    import pyarrow.parquet as pq

    for path in (p for b in batches for p in b.column(0).to_pylist()):
        system, inside = opened(path)
        with system.open_input_file(inside) as source:
            meta = pq.ParquetFile(source).metadata
        rows, first = [], 0
        for k in range(meta.num_row_groups):
            group = meta.row_group(k)
            bounds = []
            for c in (group.column(j) for j in range(group.num_columns)):
                if c.path_in_schema in columns and c.is_stats_set:
                    s = c.statistics
                    low, high = (s.min, s.max) if s.has_min_max else (None, None)
                    bounds.append((c.path_in_schema, {"low": _text(low), "high": _text(high), "nulls": s.null_count if s.has_null_count else None}))
            rows.append((path, k, first, group.num_rows, group.total_byte_size, bounds))
            first += group.num_rows
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), _BOUNDS]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=["path", "row_group", "first_row", "n_rows", "n_bytes", "bounds"]
        )


def row_groups(spark: SparkSession, paths: Sequence[str] | DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """One row for each row group: path, row_group, first_row, n_rows, n_bytes, and bounds of ``columns`` that have statistics.

    paths: files, or a DataFrame of them (``path``). Bounds are text; nested
    columns are named with dots. Shards without row groups give no rows; a file
    that is no Parquet file is an error.
    """
    if not isinstance(paths, DataFrame):
        paths = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, -(-len(paths) // PATHS_PER_TASK)))
    named = tuple(columns)
    return paths.select("path").mapInArrow(lambda batches: _footers(batches, named), SCHEMA)


def may_hold(column: str, low: object = None, high: object = None, kind: str = "long") -> Column:
    """Whether a row group of ``row_groups`` may hold a value from ``low`` to ``high``; those without bounds may."""
    bounds = F.col("bounds")[column]
    out = F.lit(True)
    if low is not None:
        out = out & (bounds["high"].cast(kind) >= F.lit(low).cast(kind))
    if high is not None:
        out = out & (bounds["low"].cast(kind) <= F.lit(high).cast(kind))
    return F.coalesce(out, F.lit(True))


def with_places(groups: DataFrame) -> DataFrame:
    """The row groups with ``before``: how many rows stand before them in the order of paths and rows.

    Shards are added up first, so what one task sees is a row for each shard.
    """
    per_path = groups.groupBy("path").agg(F.sum("n_rows").alias("_rows"))
    earlier = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_path.select("path", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return groups.join(starts, "path").withColumn("before", F.col("_before") + F.col("first_row")).drop("_before")


def first_groups(groups: DataFrame, n_rows: int) -> DataFrame:
    """The row groups that the first ``n_rows`` rows stand in."""
    return with_places(groups).where(F.col("before") < n_rows)
