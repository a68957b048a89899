"""Manifest files: a JSON map of key to dataset."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import DATASET, MANIFEST

FIELDS = ("url", "categories", "model", "size", "site", "kind", "repo", "config", "split")


def manifest_rows(files: DataFrame, value: str = "value") -> DataFrame:
    """key and dataset columns of whole-file JSON texts; blank files and JSON null are empty, bad JSON fails."""
    text = F.trim(F.col(value), F.lit(" \t\r\n"))
    parsed = F.from_json(text, MANIFEST, {"mode": "FAILFAST"})
    others = [c for c in files.columns if c != value]
    entries = files.where((text != "") & (text != "null")).select(*others, F.explode(parsed).alias("key", "d"))
    return entries.select(*others, "key", *[F.col("d")[f].alias(f) for f in FIELDS])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One manifest file; a missing file is an error."""
    return manifest_rows(spark.read.text(path, wholetext=True))


def read_manifests(spark: SparkSession, folder: str) -> DataFrame:
    """All ``*.json`` of a folder; of a key in several files the row of the last file (by name) counts. A folder without any is empty."""
    try:
        files = spark.read.text(f"{folder}/*.json", wholetext=True)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return empty_manifest(spark)
    rows = manifest_rows(files.select("value", F.col("_metadata.file_name").alias("file_name")))
    whole: Column = F.struct("key", *FIELDS)
    return rows.groupBy("key").agg(F.max_by(whole, "file_name").alias("d")).select("d.*")


def empty_manifest(spark: SparkSession) -> DataFrame:
    return spark.range(0).select(F.lit(None).cast("string").alias("key"), F.lit(None).cast(DATASET).alias("d")).select("key", "d.*")
