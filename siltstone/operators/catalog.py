"""From catalog entries to a manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.keys import MODEL_PREFIX, acquisition, archive_filename, flavour_rank, model_name
from ..functions.rules import classify
from ..functions.text import unicode_trim


def keep_entry(site: Column, language: Column) -> Column:
    """Entries in English alone, and no talks."""
    return (F.lower(unicode_trim(language)) == "eng") & (site != "ted")


def select_flavour(entries: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """The best variant of every logical name of a site; of equal ones the first seen (smallest ``ordinal``)."""
    name = F.when(F.coalesce("name", F.lit("")) == "", F.col("id")).otherwise(F.col("name"))
    best = Window.partitionBy("site", "__name").orderBy(flavour_rank(F.col("flavour")), ordinal)
    return entries.withColumn("__name", name).withColumn("__n", F.row_number().over(best)).where("__n = 1").drop("__name", "__n")


def build_dataset(entries: DataFrame, prefix: str = MODEL_PREFIX) -> DataFrame:
    """key and dataset of every entry that has a category, an acquisition link and an archive's file name."""
    linked = entries.withColumn("__category", classify(F.col("site"), F.col("name"))).withColumn("__link", acquisition(F.col("link")))
    href = F.coalesce(F.col("__link")["_href"], F.lit(""))
    named = linked.where(F.col("__category").isNotNull() & (href != "")).withColumn("__file", archive_filename(href)).where("__file <> ''")
    return named.select(
        F.concat(F.lit("datasets/"), "__category", F.lit("/"), "__file").alias("key"),
        F.regexp_replace(href, r"\.meta4\z", "").alias("url"),
        F.array("__category").alias("categories"),
        model_name(F.col("__category"), prefix).alias("model"),
        F.coalesce(F.col("__link")["_length"], F.lit(0)).alias("size"),
        "site",
        *([F.col("ordinal")] if "ordinal" in entries.columns else []),
    )


def last_by_key(datasets: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """Of rows with the same key the one written last."""
    rest = [c for c in datasets.columns if c not in ("key", ordinal)]
    return datasets.groupBy("key").agg(F.max_by(F.struct(*rest), ordinal).alias("d")).select("key", "d.*")


def catalog_to_manifest(entries: DataFrame, prefix: str = MODEL_PREFIX) -> DataFrame:
    """The whole way: filter, best variant, dataset, last write wins. One exchange by name and one by key."""
    kept = entries.where(keep_entry(F.col("site"), F.col("language")))
    return last_by_key(build_dataset(select_flavour(kept), prefix))
