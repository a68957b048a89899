"""Command line: ``python -m siltstone.cli <command>``. Every command builds a DataFrame and shows or writes it."""

from __future__ import annotations

import argparse
import logging
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.keys import MODEL_PREFIX, archive_name, key_filename, model_category
from .operators import catalog, manifest, sinks
from .operators.records import summary
from .plans import execute, work
from .session import local_session, shared_dir, stage_table
from .sources import catalog as feeds
from .sources import files, footers, manifests, traces

log = logging.getLogger("siltstone")
DEFAULTS = work.TrainSettings()
BUILT_IN = "spark"


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="siltstone")
    top.add_argument("--datasets", default="datasets", help="folder of manifests and corpora")
    top.add_argument("--root", default=".", help="folder that keys are relative to")
    commands = top.add_subparsers(dest="command", required=True)

    update = commands.add_parser("update", help="catalog feed to manifests")
    update.add_argument("--base-url", required=True)
    update.add_argument("--category", action="append", default=[], help="catalog category; may be repeated (default: all that the catalog names)")
    update.add_argument("--lang", default="eng")
    update.add_argument("--count", type=int, default=100)
    update.add_argument("--prefix", default=MODEL_PREFIX)
    update.add_argument("--keep-going", action="store_true", help="leave out categories that fail")
    update.add_argument("--dry-run", action="store_true", help="write nothing")

    chosen = argparse.ArgumentParser(add_help=False)
    for name in ("model", "category", "site"):
        chosen.add_argument(f"--{name}", action="append", default=[])
    chosen.add_argument("--dry-run", action="store_true")
    chosen.add_argument("--jobs", type=int, default=4)

    fetch = commands.add_parser("download", parents=[chosen], help="fetch the archives of a selection")
    fetch.add_argument("--max-bytes", type=int, default=0)
    fetch.add_argument("--retry", type=int, default=4)
    convert = commands.add_parser("extract", parents=[chosen], help="archives to Markdown by an external converter")
    convert.add_argument("--converter", default="archive-to-markdown", help=f"a program, or {BUILT_IN}: Spark reads the archives itself")
    convert.add_argument("--per-file", type=int, default=1000, help=f"pages of a Markdown file with the converter {BUILT_IN}")
    convert.add_argument("--workers", type=int, default=1)
    convert.add_argument("--force", action="store_true")
    convert.add_argument("--keep-going", action="store_true")
    training = commands.add_parser("train", parents=[chosen], help="plan or run the trainings of a selection")
    training.add_argument("--trainer-dir", default=".")
    training.add_argument("--base-dir", default=DEFAULTS.base_dir)
    training.add_argument("--model-tag", default="")
    training.add_argument("--preset", default=DEFAULTS.preset)
    for name in ("vocab_size", "depth", "num_iterations", "device_batch_size", "max_seq_len", "max_chars"):
        training.add_argument(f"--{name.replace('_', '-')}", type=int, default=getattr(DEFAULTS, name))
    training.add_argument("--train-tokenizer", action=argparse.BooleanOptionalAction, default=True)
    training.add_argument("--force-tokenizer", action="store_true", help="train the tokenizer even if there is one")
    training.add_argument("--reuse-base", action="store_true")
    training.add_argument("--keep-going", action="store_true")

    reasoning = commands.add_parser("reasoning", help="trace shards to JSON lines and Markdown")
    reasoning.add_argument("shards", nargs="*", help="Parquet files or folders; without them, and without --repo, all reasoning datasets of the manifests")
    reasoning.add_argument("--repo", default="", help="one dataset of the hub")
    reasoning.add_argument("--hub", default=traces.HUB, help="where the hub's shard listings are")
    reasoning.add_argument("--config", default="default")
    reasoning.add_argument("--split", default="train")
    reasoning.add_argument("--slug", default="", help="name of the output (default: the last part of the repo)")
    reasoning.add_argument("--category", default="base", help="category whose model uses the traces")
    reasoning.add_argument("--markdown", default="", help="default: <root>/datasets/<category>/markdown/<slug>")
    reasoning.add_argument("--jsonl", default="", help="default: <root>/datasets/reasoning/<slug>.jsonl")
    reasoning.add_argument("--cache", default="", help="default: <root>/datasets/reasoning/<slug>")
    reasoning.add_argument("--limit", type=int, default=0)
    reasoning.add_argument("--max-tokens", type=int, default=0)
    reasoning.add_argument("--per-file", type=int, default=1000)
    reasoning.add_argument("--jobs", type=int, default=4)
    reasoning.add_argument("--keep-shards", action="store_true")
    reasoning.add_argument("--dry-run", action="store_true")
    return top


def selection(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    rows = manifest.select(manifests.read_manifests(spark, args.datasets), args.model, args.category, args.site)
    if rows.isEmpty():
        raise SystemExit("nothing is selected")
    return rows


def run_update(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    categories = args.category or feeds.discovered_categories(spark, args.base_url)
    options = {"categories": "\n".join(categories), "lang": args.lang, "count": str(args.count), "keepGoing": str(args.keep_going)}
    # pages are fetched once
    pages = stage_table(feeds.read_catalog(spark, args.base_url, **options))
    for row in pages.where("error IS NOT NULL").select("site", "error").toLocalIterator():
        log.warning("update: category %s is left out: %s", row["site"], row["error"])
    entries = feeds.feed_entries(pages.where("error IS NULL").drop("error")).withColumn("ordinal", F.struct("site", "lang", "page", "position"))
    found = stage_table(catalog.catalog_to_manifest(entries, args.prefix))
    if not args.dry_run:
        sinks.write_manifests(found, args.datasets)
    counts = manifest.partition_counts(found)
    total = counts.agg(F.sum("n_datasets"), F.sum("total_bytes")).first()
    log.info("update: %d datasets, %d bytes", total[0] or 0, total[1] or 0)
    return counts


def run_download(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    rows = manifest.guard_budget(manifest.only_archives(selection(spark, args)), args.max_bytes)
    if args.dry_run:
        return rows.select("key", "url", "size")
    return execute.download(rows, args.root, args.jobs, args.retry, stop=True)


def run_extract(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    rows = manifest.only_archives(selection(spark, args))
    built_in = args.converter == BUILT_IN
    converter = args.converter if built_in else execute.find_converter(args.converter)
    wanted = work.extract_plan(rows, spark.createDataFrame([], "path string"), converter, args.workers, args.force)
    plan = work.extract_plan(rows, execute.present_outputs(wanted, args.root), converter, args.workers, args.force)
    if args.dry_run:
        return plan
    if built_in:
        result = execute.extract_archives(plan, args.root, args.per_file, args.force, stop=not args.keep_going)
    else:
        result = execute.extract(plan, args.root, args.jobs, args.force, stop=not args.keep_going)
    failed = 0
    for row in execute.failures(result, True).toLocalIterator():
        log.warning("extract: %s: %s", row["key"], row["error"])
        failed += 1
    if failed:
        raise SystemExit(f"extract: {failed} archives failed")
    return result


def run_train(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    given = {k: getattr(args, k) for k in ("depth", "num_iterations", "vocab_size", "device_batch_size", "max_seq_len", "max_chars", "preset", "base_dir", "reuse_base", "model_tag")}
    tokenizer = os.path.join(args.base_dir, "tokenizer", "tokenizer.json")
    present = not args.force_tokenizer and files.exists(spark, tokenizer)
    if present and args.train_tokenizer:
        log.info("train: keeping the tokenizer %s", tokenizer)
    settings = work.TrainSettings(datasets=args.datasets, tokenizer_present=present or not args.train_tokenizer, **given)
    rows = selection(spark, args)
    plan = work.train_plan(rows, settings)
    if args.dry_run:
        for folder in [settings.base, *[r[0] for r in work.requested_models(rows, settings).select(model_category(F.col("model"), settings.prefix)).collect()]]:
            if not files.has_markdown(spark, f"{args.datasets}/{folder}"):
                log.warning("train: no Markdown files in %s/%s", args.datasets, folder)
        return plan
    failed = execute.train(
        plan, "go", args.trainer_dir, {"GOEXPERIMENT": "simd"}, args.keep_going,
        require_corpus=lambda folder: files.require_markdown(spark, folder),
        checkpoint=lambda: files.require_checkpoint(spark, settings.checkpoint_folder),
    )
    if failed:
        raise SystemExit(f"trainings failed: {', '.join(failed)}")
    return plan


def run_reasoning(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.shards:
        return ingest_shards(spark, args, local_shards(spark, args, args.shards), args.slug or "traces", args.category)
    if args.repo:
        return ingest_repo(spark, args, args.repo, args.config, args.split, args.slug or args.repo.rpartition("/")[2].lower(), args.category)
    items = manifest.require_repo(manifest.reasoning_items(manifests.read_manifests(spark, args.datasets)))
    named = items.select(
        "repo", F.coalesce("config", F.lit(args.config)).alias("config"), F.coalesce("split", F.lit(args.split)).alias("split"),
        archive_name(key_filename(F.col("key"))).alias("slug"), model_category(F.col("model"), MODEL_PREFIX).alias("category"),
    ).collect()
    if not named:
        raise SystemExit("no reasoning datasets in the manifests")
    out = None
    for r in named:
        log.info("reasoning: %s (%s)", r["slug"], r["repo"])
        done = ingest_repo(spark, args, *r)
        out = done if out is None else out.unionByName(done)
    return out


def ingest_repo(spark: SparkSession, args: argparse.Namespace, repo: str, config: str, split: str, slug: str, category: str) -> DataFrame:
    """Fetch the shards of a dataset as far as the limit asks, ingest each once, and delete it unless it is to be kept.

    As many shards as there are jobs are on disk at a time, one if there is a limit.
    """
    plan = traces.shard_plan(traces.listed_shards(spark, f"{args.hub}/{repo}/parquet/{config}/{split}"), slug)
    if args.dry_run:
        return plan
    cache = args.cache or f"{args.root}/datasets/reasoning/{slug}"
    plan = stage_table(plan.withColumn("key", F.element_at(F.split("key", "/"), -1)))

    def fetched():
        step = 1 if args.limit > 0 else max(1, args.jobs)
        for first in range(0, plan.count(), step):
            part = plan.where(F.col("ordinal").between(first, first + step - 1))
            execute.download(part, cache, step, 3, stop=True)
            paths = [f"{cache}/{r['key']}" for r in part.select("key").orderBy("key").collect()]
            try:
                yield paths
            finally:
                for p in [] if args.keep_shards else paths:
                    files.delete(spark, p)

    out = ingest_shards(spark, args, fetched(), slug, category)
    if not args.keep_shards:
        files.delete_empty(spark, cache)
    return out


def local_shards(spark: SparkSession, args: argparse.Namespace, paths: list[str]):
    """The Parquet files of paths: all at once, or with a limit first as many as hold so many rows by their footers, then one by one."""
    found = sorted(spark.read.parquet(*paths).inputFiles())
    if args.limit <= 0:
        yield found
        return
    sizes = {r["path"]: r["n"] for r in footers.row_groups(spark, found).groupBy("path").agg(F.sum("n_rows").alias("n")).toLocalIterator()}
    first, rows = 0, 0
    while first < len(found) and rows < args.limit:
        rows, first = rows + sizes.get(found[first], 0), first + 1
    yield found[:first]
    for path in found[first:]:
        yield [path]


def ingest_shards(spark: SparkSession, args: argparse.Namespace, parts, slug: str, category: str) -> DataFrame:
    """JSON lines and Markdown of the records of some shards, in the order of shards and rows; what was written, in one row.

    parts: lists of shards, each read once, until there are as many records as the limit asks for.
    """
    staged, n_shards = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}", 0
    place = ("file_path", "row_index")
    for paths in parts:
        found = traces.ingest(traces.read_shards(spark, *paths), keep=place, max_tokens=args.max_tokens)
        found.write.mode("append").parquet(staged)
        n_shards += len(paths)
        if args.limit > 0 and spark.read.parquet(staged).count() >= args.limit:
            break
    parts.close()
    found = spark.read.parquet(staged)
    if args.limit > 0:
        found = found.orderBy(*place).limit(args.limit)
    placed = stage_table(found.withColumn("place", F.struct(*place)))
    told = stage_table(summary(placed).select(F.lit(slug).alias("slug"), F.lit(n_shards).alias("shards"), "records", "complete"))
    files.delete(spark, staged)
    if args.dry_run:
        return told
    sinks.write_json_lines(placed, args.jsonl or f"{args.root}/datasets/reasoning/{slug}.jsonl")
    n = sinks.write_markdown(placed, args.markdown or f"{args.root}/datasets/{category}/markdown/{slug}", slug, "place", args.per_file)
    return told.withColumn("markdown_files", F.lit(n))


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> DataFrame:
    logging.basicConfig(format="%(message)s")
    log.setLevel(logging.INFO)
    args = parser().parse_args(argv)
    spark = spark or local_session()
    if args.command in ("download", "extract", "reasoning") and not spark.sparkContext.master.startswith("local") and "/" not in args.root[:1]:
        raise SystemExit("on a cluster --root names a folder that all executors share, from / on")
    out = globals()[f"run_{args.command}"](spark, args)
    out.show(100, truncate=False)
    return out


if __name__ == "__main__":
    main()
