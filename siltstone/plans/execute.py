"""Carry out plans: fetch files, run the archive converter, run training steps.

Files go to a folder that all executors share (a mounted path). Every step is
safe to repeat: files are written beside their place and renamed, and what is
present is skipped.
"""

from __future__ import annotations

import logging
import os
import shutil
import subprocess
import time
import uuid
from collections.abc import Callable, Iterator
from urllib.request import urlopen

import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sinks import write_pages
from ..session import stage_table
from ..sources import files
from ..sources.archives import read_html

RESULT = "key string, action string, bytes bigint, error string"
_ARROW = pa.schema([("key", pa.string()), ("action", pa.string()), ("bytes", pa.int64()), ("error", pa.string())])
log = logging.getLogger("siltstone")


def fetch_to_file(url: str, place: str, timeout: float = 90) -> int:
    """Fetch into a sibling and rename; the number of bytes."""
    part = f"{place}.{uuid.uuid4().hex}.part"
    try:
        with urlopen(url, timeout=timeout) as answer, open(part, "wb") as out:  # noqa: S310
            if answer.status != 200:
                raise OSError(f"status {answer.status}")
            shutil.copyfileobj(answer, out)
        size = os.path.getsize(part)
        os.replace(part, place)
        return size
    finally:
        if os.path.exists(part):
            os.remove(part)


def fetch_one(row: dict, root: str, retries: int, delay: float) -> tuple[str, str, int, str | None]:
    """Skip what has the expected size; else fetch, with waits of delay * 2^(k-1) between attempts."""
    place, size = os.path.join(root, row["key"]), row["size"] or 0
    if os.path.isfile(place) and size in (0, os.path.getsize(place)):
        return row["key"], "skip", os.path.getsize(place), None
    os.makedirs(os.path.dirname(place), exist_ok=True)
    error = ""
    for attempt in range(max(0, retries) + 1):
        if attempt:
            time.sleep(delay * 2 ** (attempt - 1))
        try:
            got = fetch_to_file(row["url"], place)
        except OSError as e:
            error = str(e)
            continue
        if size > 0 and got != size:
            os.remove(place)
            error = f"size mismatch: {got} bytes, {size} expected"
            continue
        return row["key"], "download", got, None
    return row["key"], "failed", 0, error


def convert_one(row: dict, root: str, force: bool) -> tuple[str, str, int, str | None]:
    """Run the converter on one archive; with ``force`` earlier output goes first."""
    archive, output = os.path.join(root, row["key"]), os.path.join(root, row["output"])
    if not os.path.isfile(archive):
        return row["key"], "failed", 0, "archive not found"
    if not force and os.path.isdir(output) and os.listdir(output):
        return row["key"], "skip", 0, None
    if force:
        shutil.rmtree(output, ignore_errors=True)
    argv = [os.path.join(root, a) if a in (row["key"], os.path.dirname(row["output"])) else a for a in row["argv"]]
    os.makedirs(os.path.dirname(output), exist_ok=True)
    done = subprocess.run(argv, capture_output=True, text=True)  # noqa: S603
    if done.returncode:
        return row["key"], "failed", 0, (done.stdout + done.stderr).strip() or f"exit {done.returncode}"
    return row["key"], "extract", 0, None


def find_converter(name: str) -> str:
    """The converter's path; one that isn't there is an error before any work."""
    if (found := shutil.which(name)) is None:
        raise FileNotFoundError(f"converter {name!r} is not on the path: install it, or name it with --converter")
    return found


def _run(plan: DataFrame, root: str, jobs: int, one: Callable[[dict], tuple], stop: bool) -> DataFrame:
    """One row per item, items spread over ``jobs`` tasks. The work is done here, once; its results are a written table.

    stop: after the first item that fails no other is begun, and the failure is
    an error. A mark in ``root`` tells the other tasks, so that no task fails
    and is tried again.
    """
    mark = os.path.join(root, f".stopped-{uuid.uuid4().hex}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            if stop and os.path.exists(mark):
                done = row["key"], "cancelled", 0, None
            else:
                done = one(row)
                if stop and done[1] == "failed":
                    os.makedirs(root, exist_ok=True)
                    open(mark, "w").close()
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, done, strict=True))], _ARROW)

    try:
        result = stage_table(_dealt(plan, jobs).mapInArrow(work, RESULT))
    finally:
        if os.path.exists(mark):
            os.remove(mark)
    if stop:
        failures(result)
    return result


def _dealt(plan: DataFrame, jobs: int) -> DataFrame:
    """Items dealt to tasks by their place in the order of size, so that no task gets several of the largest by chance.

    A plan has one row for each archive of a manifest, which one task can number.
    """
    size = F.coalesce("size", F.lit(0)) if "size" in plan.columns else F.lit(0)
    numbered = plan.withColumn("_place", F.row_number().over(Window.orderBy(size.desc(), "key")) - 1)
    return numbered.repartitionById(jobs, (F.col("_place") % jobs).cast("int")).drop("_place")


def present_outputs(plan: DataFrame, root: str) -> DataFrame:
    """``path`` of the output folders of an extraction plan that hold a file."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here = [p for p in batch.column(0).to_pylist() if os.path.isdir(at := os.path.join(root, p)) and any(os.scandir(at))]
            yield pa.RecordBatch.from_arrays([pa.array(here, pa.string())], names=["path"])

    return plan.select("output").mapInArrow(look, "path string")


def download(plan: DataFrame, root: str, jobs: int = 4, retries: int = 4, delay: float = 1.0, stop: bool = False) -> DataFrame:
    """key, action (skip, download, failed), bytes and error of every item of a manifest or download plan."""
    return _run(plan.select("key", "url", "size"), root, jobs, lambda r: fetch_one(r, root, retries, delay), stop)


def extract(plan: DataFrame, root: str, jobs: int = 4, force: bool = False, stop: bool = False) -> DataFrame:
    """key, action (skip, extract, failed) and error of every archive of an extraction plan."""
    return _run(plan.select("key", "output", "argv"), root, jobs, lambda r: convert_one(r, root, force), stop)


def extract_archives(plan: DataFrame, root: str, per_file: int = 1000, force: bool = False, stop: bool = False) -> DataFrame:
    """As ``extract``, without a converter: one Spark job after another reads an archive's pages and writes their Markdown.

    The archive's own clusters are what is spread over the tasks. Its files
    appear together, so one that fails leaves no output.
    """
    spark, rows = plan.sparkSession, []
    for item in plan.select("key", "output", "action").orderBy("key").toLocalIterator():
        key, archive, output = item["key"], f"{root}/{item['key']}", f"{root}/{item['output']}"
        if item["action"] == "skip":
            rows.append((key, "skip", 0, None))
            continue
        try:
            if not files.exists(spark, archive):
                raise FileNotFoundError("archive not found")
            if force:
                files.delete(spark, output)
            write_pages(read_html(spark, archive), output, output.rpartition("/")[2], "entry", per_file)
            rows.append((key, "extract", 0, None))
        except (OSError, PySparkException) as e:
            log.warning("extract: %s: %s", key, e)
            rows.append((key, "failed", 0, str(e)))
            if stop:
                break
    result = spark.createDataFrame(rows, RESULT)
    if stop:
        failures(result)
    return result


def failures(result: DataFrame, keep_going: bool = False) -> DataFrame:
    """The failed rows; without ``keep_going`` the first failure is an error."""
    failed = result.where(F.col("action") == "failed")
    if not keep_going and (first := failed.orderBy("key").first()) is not None:
        raise RuntimeError(f"{first['key']}: {first['error']}")
    return failed


def train(
    plan: DataFrame,
    program: str,
    directory: str,
    env: dict[str, str] | None = None,
    keep_going: bool = False,
    run=subprocess.run,
    require_corpus: Callable[[str], object] | None = None,
    checkpoint: Callable[[], str] | None = None,
) -> list[str]:
    """Run the steps of a training plan in order on the driver; the models whose step failed.

    require_corpus: called with the data folder of each step before it runs, and
    fails where there is nothing to train on. checkpoint: called before the first
    specialty; the checkpoint that all of them start from.
    """
    failed, start = [], None
    for step in plan.orderBy("step", "model").collect():
        argv = list(step["argv"])
        specialty = step["stage"] == "specialty"
        try:
            if require_corpus is not None:
                require_corpus(argv[argv.index("--data-dir") + 1])
            if specialty and checkpoint is not None:
                start = start or checkpoint()
                argv[argv.index("--init-model") + 1] = start
            log.info("train: %s %s", step["stage"], step["model"])
            done = run([program, *argv], cwd=directory, env={**os.environ, **(env or {})})
            if done.returncode:
                raise RuntimeError(f"{step['stage']} {step['model']}: exit {done.returncode}")
        except (RuntimeError, OSError) as e:
            if not specialty or not keep_going:
                raise
            log.warning("train: %s: %s", step["model"], e)
            failed.append(step["model"])
    return failed
