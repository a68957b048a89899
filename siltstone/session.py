"""Session, table and stage-table helpers shared by every operator."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def local_session(cores: str = "8", shuffle_partitions: int = 8, app: str = "siltstone") -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    It is the one named in ``spark.checkpoint.dir``. Only a local session (one
    JVM) may fall back to a temporary folder of its own; a cluster without the
    setting is refused, because executors would not see each other's files.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            configured = tempfile.mkdtemp(prefix="siltstone-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def stage_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage at a copy that survives the loss of any executor, and gives
    the planner exact sizes for what follows. The copy goes with ``drop_table``,
    or when the driver ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    files, place = _files(spark, path)
    files.deleteOnExit(place)
    staged = spark.read.schema(df.schema).parquet(path)
    staged.staged_at = path
    return staged


def drop_table(staged: DataFrame) -> None:
    """Delete a staged table that no plan needs any more."""
    files, place = _files(staged.sparkSession, staged.staged_at)
    files.delete(place, True)


def _files(spark: SparkSession, path: str):
    """The file system of a path, and the path, as Spark's writers see them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def input_bytes(df: DataFrame) -> int:
    """About the size of ``df``: the files' for a scan, without a job; else the measured length of its strings.

    The planner's own estimates of joins, and of rows that come from the driver,
    are too far off to choose numbers of partitions by.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    size = int(plan.stats().sizeInBytes())
    while plan.children().size() == 1:
        plan = plan.children().head()
    if plan.children().size() == 0 and "LogicalRelation" in plan.getClass().getSimpleName():
        return size
    lengths = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return int(df.agg(F.sum(sum(lengths, F.lit(8)).cast("long"))).first()[0] or 0)
