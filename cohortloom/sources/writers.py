"""Writers. Each writes from the executors; nothing passes through the driver."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from cohortloom.operators.checks import completeness
from cohortloom.operators.ordering import batch_number, global_row_id


class IncompleteError(Exception):
    """A gated write found keys without a value. ``check`` is the check row."""

    def __init__(self, check: Row):
        super().__init__(f"{check['n_found']} of {check['n_wanted']} keys have a value")
        self.check = check


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, or headed CSV if the path ends in ``.csv``."""
    if path.endswith(".csv"):
        df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    else:
        df.write.mode("overwrite").parquet(path)


def write_lines(df: DataFrame, col: str, path: str) -> None:
    """One value per line."""
    df.select(F.col(col).cast("string")).write.mode("overwrite").text(path)


def write_batches(df: DataFrame, order: Sequence[str], n: int, path: str) -> None:
    """Rows in order, cut into batches of exactly n rows (the last may be smaller), one folder per batch."""
    numbered = global_row_id(df, order, "row_id")
    batched = numbered.withColumn("batch_no", batch_number(F.col("row_id"), n))
    batched.drop("row_id").repartition("batch_no").write.mode("overwrite").partitionBy("batch_no").parquet(path)


def write_if(df: DataFrame, key: str, value: str, path: str) -> DataFrame:
    """Write only if every key has a value; otherwise raise and leave nothing at ``path``. Returns the check row.

    The rows are written once, into a hidden folder beside ``path``, and checked there. If the check holds, the folder
    is renamed to ``path``, replacing what is there; if not, or on any error, it is deleted. A driver lost in between
    leaves the hidden folder at most.
    """
    parent, _, name = path.rstrip("/").rpartition("/")
    hidden = f"{parent}/.{name}-{uuid.uuid4().hex}"
    # Readers pass over names that start with a dot, so the rows lie one level below.
    rows = f"{hidden}/{name}"
    spark, files = df.sparkSession, _Files(df.sparkSession)
    try:
        write_table(df, rows)
        written = spark.read.schema(df.schema).csv(rows, header=True, escape='"') if name.endswith(".csv") else spark.read.schema(df.schema).parquet(rows)
        check = completeness(written, key, value).first()
        if not check["complete"]:
            raise IncompleteError(check)
        files.replace(rows, path)
    finally:
        files.delete(hidden)
    return spark.createDataFrame([check], "n_wanted long, n_found long, complete boolean")


class _Files:
    """Renaming and deleting where the executors write, through Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self.path, self.conf = spark.sparkContext._jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()

    def delete(self, name: str) -> None:
        target = self.path(name)
        target.getFileSystem(self.conf).delete(target, True)

    def replace(self, source: str, target: str) -> None:
        self.delete(target)
        old, new = self.path(source), self.path(target)
        if not old.getFileSystem(self.conf).rename(old, new):
            raise OSError(f"{source} could not be renamed to {target}")


def write_all(frames: dict[str, DataFrame], folder: str, kind: str = "parquet") -> dict[str, str]:
    """Write tables by name into one folder, each ``.csv`` or Parquet, and give their paths.

    Steps that the tables write down on the way are deleted at the end: build them inside ``run_folder``.
    """
    paths = {name: f"{folder.rstrip('/')}/{name}" + (".csv" if kind == "csv" else "") for name in frames}
    for name, frame in frames.items():
        write_table(frame, paths[name])
    return paths


def deidentify(df: DataFrame, ids: Sequence[str]) -> DataFrame:
    """The table without its identifying columns."""
    return df.drop(*ids)


def write_with_and_without_ids(df: DataFrame, ids: Sequence[str], path: str) -> None:
    """The table twice: as it is, and without the identifying columns, which is read from the first copy."""
    write_table(df, f"{path}/with_id")
    saved = df.sparkSession.read.schema(df.schema).parquet(f"{path}/with_id")
    write_table(deidentify(saved, ids), f"{path}/without_id")
