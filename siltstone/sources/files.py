"""Files of corpora and checkpoints, as listings that prune the content away, and small single files by name."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def markdown_files(spark: SparkSession, root: str) -> DataFrame:
    """path and length of every Markdown file below ``root``, sorted."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[mM][dD]").load(root)
    return files.select("path", "length").orderBy("path")


def read_markdown(spark: SparkSession, root: str) -> DataFrame:
    """path and value (the whole text) of every Markdown file below ``root``."""
    texts = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[mM][dD]").text(root, wholetext=True)
    return texts.select(F.col("_metadata.file_path").alias("path"), "value")


def has_markdown(spark: SparkSession, root: str) -> bool:
    try:
        return not markdown_files(spark, root).select("path").isEmpty()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return False


def require_markdown(spark: SparkSession, root: str) -> None:
    """A corpus without Markdown files is an error."""
    if not has_markdown(spark, root):
        raise FileNotFoundError(f"corpus {root}: no Markdown files")


def latest_checkpoint(files: DataFrame, path: str = "path", pattern: str = r"model_(\d+)\.gn$") -> DataFrame:
    """The path of the checkpoint with the largest step, in one row (null if there is none)."""
    step = F.regexp_extract(F.col(path), pattern, 1)
    return files.where(step != "").agg(F.max_by(path, step.cast("long")).alias("checkpoint"))


def require_checkpoint(spark: SparkSession, folder: str) -> str:
    """The latest checkpoint in a folder; none is an error."""
    found = latest_checkpoint(spark.createDataFrame([(p,) for p in listed(spark, f"{folder}/model_*.gn")], "path string")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no checkpoint in {folder}")
    return found


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def listed(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, sorted; for folders whose size follows no input."""
    files, place = _place(spark, pattern)
    return sorted(s.getPath().toUri().getPath() if s.getPath().toUri().getScheme() == "file" else s.getPath().toString() for s in files.globStatus(place) or [])


def delete(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.delete(place, True)


def delete_empty(spark: SparkSession, folder: str) -> None:
    """Delete a folder that holds nothing any more."""
    files, place = _place(spark, folder)
    if files.exists(place) and len(files.listStatus(place)) == 0:
        files.delete(place, False)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file, in place of what has the new name."""
    jvm = spark._jvm
    files, place = _place(spark, target)
    files.mkdirs(place.getParent())
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(kind, 1)
    over[0] = kind.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri() if place.toUri().getScheme() else files.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(context.makeQualified(jvm.org.apache.hadoop.fs.Path(source)), context.makeQualified(place), over)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, written beside its place and renamed."""
    beside = f"{path}.tmp"
    files, place = _place(spark, beside)
    out = files.create(place, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename(spark, beside, path)
