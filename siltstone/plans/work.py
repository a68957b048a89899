"""What is to be done for a selection: a row per step, so that a dry run is a query."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import MODEL_PREFIX, archive_name, env_with, key_category, key_filename, model_category


def download_plan(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """key, url, size, present_size and action (skip or download). files: path and length of what is there."""
    there = files.select(F.col("path").alias("key"), F.col("length").alias("present_size"))
    skip = F.col("present_size").isNotNull() & ((F.coalesce("size", F.lit(0)) == 0) | (F.col("present_size") == F.col("size")))
    return manifest.join(there, "key", "left").select("key", "url", "size", "present_size", F.when(skip, "skip").otherwise("download").alias("action"))


def retry_schedule(attempts: DataFrame, retries: Column, delay_ms: Column) -> DataFrame:
    """One row per attempt: attempt 0 at once, attempt k after delay * 2^(k-1)."""
    rows = attempts.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.greatest(retries, F.lit(0)))))
    wait = F.when(F.col("attempt") == 0, F.lit(0)).otherwise(delay_ms * F.pow(F.lit(2), F.col("attempt") - 1)).cast("bigint")
    return rows.withColumn("wait_ms", wait)


def extract_plan(manifest: DataFrame, present: DataFrame, converter: str = "archive-to-markdown", workers: int = 1, force: bool = False) -> DataFrame:
    """key, output folder, action and arguments. present: ``path`` of output folders with at least one file. Malformed keys are an error."""
    category = key_category(F.col("key"))
    checked = F.when(category == "", F.raise_error(F.concat(F.lit("malformed key: "), "key"))).otherwise(category)
    root = F.concat(F.lit("datasets/"), checked, F.lit("/markdown"))
    plan = manifest.select("key", root.alias("output_root"), F.concat(root, F.lit("/"), archive_name(key_filename(F.col("key")))).alias("output"))
    done = present.select(F.col("path").alias("output"), F.lit(True).alias("done")).distinct()
    argv = [F.lit(converter), F.lit("--output"), F.col("output_root"), F.lit("--workers"), F.lit(str(workers)), F.lit("--quiet")]
    argv += [] if force else [F.lit("--no-clobber")]
    action = F.when(F.coalesce("done", F.lit(False)) & F.lit(not force), "skip").otherwise("extract")
    return plan.join(done, "output", "left").select("key", "output", action.alias("action"), F.array(*argv, F.col("key")).alias("argv"))


@dataclass(frozen=True)
class TrainSettings:
    """Defaults of a training run."""

    datasets: str = "datasets"
    base_dir: str = "checkpoints"
    depth: int = 20
    vocab_size: int = 131072
    preset: str = "flash"
    max_seq_len: int = 512
    num_iterations: int = 200
    device_batch_size: int = 1
    max_chars: int = 2_000_000
    prefix: str = MODEL_PREFIX
    base: str = "base"
    reuse_base: bool = False
    tokenizer_present: bool = False
    model_tag: str = ""

    @property
    def tag(self) -> str:
        return self.model_tag or f"d{self.depth}"

    @property
    def checkpoint_folder(self) -> str:
        """Where a training of the base writes its checkpoints."""
        return f"{self.base_dir}/domains/{self.base}/base_checkpoints/{self.tag}"


def requested_models(manifest: DataFrame, settings: TrainSettings = TrainSettings()) -> DataFrame:
    """Distinct models of a selection without the base model, sorted."""
    named = manifest.where(F.coalesce("model", F.lit("")) != "").select("model").distinct()
    return named.where(F.col("model") != settings.prefix + settings.base).orderBy("model")


def train_plan(manifest: DataFrame, settings: TrainSettings = TrainSettings()) -> DataFrame:
    """stage, model, category and argv: tokenizer, base, then every specialty in order."""
    s = settings
    spark = manifest.sparkSession
    corpus = f"{s.datasets}/{s.base}"
    shape = ["--data-format", "markdown"]
    size = ["--device-batch-size", str(s.device_batch_size), "--num-iterations", str(s.num_iterations)]
    fixed = []
    if not s.tokenizer_present:
        fixed.append((0, "tokenizer", "", s.base, ["run", "./cmd/tok_train", "--data-dir", corpus, *shape, "--vocab-size", str(s.vocab_size), "--max-chars", str(s.max_chars), "--base-dir", s.base_dir]))
    if not s.reuse_base:
        fixed.append(
            (
                1, "base", s.prefix + s.base, s.base,
                ["run", "./cmd/base_train", "--domain", s.base, "--data-dir", corpus, *shape, "--base-dir", s.base_dir, "--model-tag", s.tag, "--depth", str(s.depth),
                 "--preset", s.preset, "--vocab-size", str(s.vocab_size), "--max-seq-len", str(s.max_seq_len), *size],
            )
        )
    head = spark.createDataFrame(fixed, "step int, stage string, model string, category string, argv array<string>")
    category = model_category(F.col("model"), s.prefix)
    checkpoint = f"{s.checkpoint_folder}/model_{s.num_iterations:06d}.gn"
    argv = F.array(
        *map(F.lit, ["run", "./cmd/base_train", "--domain"]), category, F.lit("--init-model"), F.lit(checkpoint), F.lit("--data-dir"),
        F.concat(F.lit(f"{s.datasets}/"), category), *map(F.lit, [*shape, "--base-dir", s.base_dir, "--model-tag", s.tag, *size]),
    )
    tail = requested_models(manifest, s).select(F.lit(2).alias("step"), F.lit("specialty").alias("stage"), "model", category.alias("category"), argv.alias("argv"))
    return head.unionByName(tail).orderBy("step", "model")


def train_environment(plan: DataFrame, env: Column) -> DataFrame:
    """The plan with the environment of its processes."""
    return plan.withColumn("env", env_with(env, "GOEXPERIMENT", "simd"))


def corpus_presence(models: DataFrame, files: DataFrame) -> DataFrame:
    """Each model's category with its number of Markdown files, and whether it has any. files: category per file."""
    counts = files.groupBy("category").agg(F.count("*").alias("n"))
    return models.join(counts, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n_files"), (F.coalesce("n", F.lit(0)) > 0).alias("present"))
