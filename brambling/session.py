"""Sessions for local runs, and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

SPREAD_BYTES = 32 << 20
# Arrow batches for Python end at so many bytes, where the session does not say otherwise.
BATCH_BYTES, BATCH_SETTING = 4 << 20, "spark.sql.execution.arrow.maxBytesPerBatch"


def local_session(cpus: int | str = "*", app: str = "brambling", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the bench. On a cluster, pass your own session."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor reaches: ``spark.checkpoint.dir``, or in local mode one of our own."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not _one_machine(context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="brambling-")
    if not _one_machine(context.master):
        _check_shared(spark, folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def _one_machine(master: str) -> bool:
    return master == "local" or master.startswith("local[")


@cache
def _check_shared(spark: SparkSession, folder: str) -> None:
    """Raise unless a task can read what the driver writes to ``folder``; once per session."""
    path = f"{folder}/brambling-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = system.create(place)
    stream.writeBytes("shared")
    stream.close()
    try:
        found = [row.value for row in spark.read.text(path).collect()]
    except Exception as error:
        raise RuntimeError(f"executors cannot read {folder}, the folder in spark.checkpoint.dir") from error
    finally:
        system.delete(place, True)
    if found != ["shared"]:
        raise RuntimeError(f"executors cannot read {folder}, the folder in spark.checkpoint.dir")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that one job writes and the next one reads."""
    return f"{shared_folder(spark)}/brambling-{uuid.uuid4().hex}/{name}"


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt to all cores if it is so small that its files are read by a few tasks.

    A file of one row group is read by one task. Above ``SPREAD_BYTES`` a core, as Spark estimates
    the table, files have tasks enough, and rows are left where they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    estimate = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return df.repartition(cores) if estimate <= SPREAD_BYTES * cores else df


def bounded_batches(spark: SparkSession) -> None:
    """Batches for Python end at ``BATCH_BYTES``; without that they end at a number of rows, however long."""
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """Checkpoint a small fitted table: later plans start from it, and a lost executor costs a read."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spill(df: DataFrame) -> tuple[DataFrame, str]:
    """Store a table in the shared folder and name its path, for ``discard`` once it is not needed."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def store(df: DataFrame) -> DataFrame:
    """A Parquet table in the shared folder, compressed and splittable, that stays there."""
    return spill(df)[0]


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete tables that ``spill`` wrote."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
