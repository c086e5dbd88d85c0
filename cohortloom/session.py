"""Session settings and the shared scratch folder."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on. Null-safe joins put a fresh shuffle on both sides, so the adaptive skew
# join may split an oversized key; everything else is Spark's default behaviour.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(name: str = "cohortloom", cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and timing. On a cluster the caller brings its own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    settings = SETTINGS | {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        # Looking up the calling line for every column expression costs more than small queries do.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    for key, value in (settings | extra).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; the cluster says that it is shared (a shared mount is a ``file:`` path).

    Only a local session, where every task sees the same disk, may fall back to a temporary folder. On a
    cluster an unset folder is an error: a machine-local path would be lost with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if folder:
        return folder
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="cohortloom-"))
    return context.getCheckpointDir()


_RUN = ContextVar("cohortloom_run", default="")


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """Keep all steps written inside the block in one folder, and delete it at the end.

    The results of the block must be written elsewhere, or collected, before it ends.
    """
    path = f"{shared_folder(spark).rstrip('/')}/cohortloom/run-{uuid.uuid4().hex}"
    token = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(token)
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path not used before, below the shared folder, or below the folder of the current ``run_folder``."""
    base = _RUN.get() or f"{shared_folder(spark).rstrip('/')}/cohortloom"
    return f"{base}/{uuid.uuid4().hex}/{name}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written rows.

    Used where later steps must see exactly the rows and partition numbers of this moment, also after an
    executor is lost, or where a costly plan would otherwise run once per use.
    """
    path = scratch_path(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Have the shuffle files of steps that are over deleted now.

    Spark deletes them once the driver's garbage is collected, which may be long after they are of use.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
