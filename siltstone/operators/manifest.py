"""Operators on manifests: DataFrames with a unique key and the columns of a dataset."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import key_category, key_filename


def merge(base: DataFrame, overlay: DataFrame, key: str = "key") -> DataFrame:
    """Keyed union; a row of the overlay replaces the base's row as a whole."""
    rest = [c for c in base.columns if c != key]
    rows = base.select(key, F.struct(*rest).alias("d"), F.lit(0).alias("layer")).unionByName(overlay.select(key, F.struct(*rest).alias("d"), F.lit(1).alias("layer")))
    return rows.groupBy(key).agg(F.max_by("d", "layer").alias("d")).select(key, "d.*")


def selected(models: Iterable[str] = (), categories: Iterable[str] = (), sites: Iterable[str] = ()) -> Column:
    """Rows that any of the lists names; empty lists select all. A site also names the category in a key."""
    models, categories, sites = list(models), list(categories), list(sites)
    any_of: list[Column] = []
    if models:
        any_of.append(F.col("model").isin(models))
    if categories:
        any_of.append(F.arrays_overlap("categories", F.array(*map(F.lit, categories))))
    if sites:
        any_of.append(F.col("site").isin(sites) | key_category(F.col("key")).isin(sites))
    if not any_of:
        return F.lit(True)
    out = F.lit(False)
    for c in any_of:
        out = out | F.coalesce(c, F.lit(False))
    return out


def select(manifest: DataFrame, models=(), categories=(), sites=()) -> DataFrame:
    return manifest.where(selected(models, categories, sites)).orderBy("key")


def only_archives(manifest: DataFrame) -> DataFrame:
    return manifest.where(F.coalesce("kind", F.lit("")).isin("", "zim"))


def reasoning_items(manifest: DataFrame) -> DataFrame:
    return manifest.where("kind = 'reasoning'").orderBy("key")


def total_size(manifest: DataFrame) -> DataFrame:
    return manifest.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("total_size"))


def selection_size(manifest: DataFrame) -> DataFrame:
    """Only positive sizes count."""
    return manifest.agg(F.coalesce(F.sum(F.greatest("size", F.lit(0))), F.lit(0)).alias("selection_size"))


def category_set(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("categories").alias("category")).distinct()


def partition_counts(manifest: DataFrame) -> DataFrame:
    """Datasets and bytes by the category in the key; malformed keys are left out."""
    keyed = manifest.withColumn("category", key_category(F.col("key"))).where("category <> ''")
    return keyed.groupBy("category").agg(F.count("*").alias("n_datasets"), F.coalesce(F.sum("size"), F.lit(0)).alias("total_bytes"))


def stale_categories(manifest: DataFrame, managed: DataFrame) -> DataFrame:
    """Managed categories that no key of the manifest has: their files are to be deleted."""
    present = manifest.select(key_category(F.col("key")).alias("category")).distinct()
    return managed.join(present, "category", "left_anti")


def exceeds_budget(manifest: DataFrame, most: int) -> DataFrame:
    """total and whether it is above the budget (0: no budget)."""
    return selection_size(manifest).select(F.col("selection_size").alias("total_bytes"), (F.lit(most > 0) & (F.col("selection_size") > most)).alias("exceeds"))


def guard_budget(manifest: DataFrame, most: int) -> DataFrame:
    """The manifest itself; a total above the budget is an error before any work."""
    row = exceeds_budget(manifest, most).first()
    if row["exceeds"]:
        raise ValueError(f"selection is {row['total_bytes']} bytes, exceeds limit {most} bytes")
    return manifest


def require_repo(manifest: DataFrame) -> DataFrame:
    """Reasoning rows must name a repository."""
    bad = (F.col("kind") == "reasoning") & (F.coalesce("repo", F.lit("")) == "")
    return manifest.withColumn("repo", F.when(bad, F.raise_error(F.concat(F.lit("no repo: "), "key"))).otherwise(F.col("repo")))


def with_key_parts(manifest: DataFrame) -> DataFrame:
    return manifest.withColumn("key_category", key_category(F.col("key"))).withColumn("key_filename", key_filename(F.col("key")))
