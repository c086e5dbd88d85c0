"""Volumes for the segmentation run: numbered, without 4-D ones, cut into batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import fixed_values as fixed, functions as fn, operators as ops


def prepare_volumes(images: DataFrame, batch_rows: int = fixed.BATCH_ROWS) -> DataFrame:
    """``images`` has image (path) and shape (array). Gives id, image and the number of the batch, from 1.

    All volumes are numbered by path first, so an id does not depend on which ones are left out. Volumes with four
    axes are dropped by their exact path.
    """
    numbered = ops.global_row_id(images, ["image"], "row")
    numbered = numbered.withColumn("id", F.concat(F.lit("scan_"), F.col("row").cast("string")))
    deep = images.where(fn.shape_rank("shape") == 4).select(F.col("image").alias("path"))
    kept = ops.anti_path_list(numbered.select("id", "image", "row"), "image", deep, "path")
    placed = ops.global_row_id(kept, ["row"], "place")
    return placed.select("id", "image", ops.batch_number(F.col("place"), batch_rows).alias("batch_no"))
