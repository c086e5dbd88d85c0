"""Predictions joined to their study ids, with scan numbers and slice counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import functions as fn, operators as ops
from cohortloom.session import settle


def prepare_predictions(predictions: DataFrame, scan_list: DataFrame, details: DataFrame) -> DataFrame:
    """``predictions`` has id, image, prediction and shape (array); ``scan_list`` has unique_study_id,
    report_num_temp and folder; ``details`` has unique_study_id, report_num_temp and StudyDate_Time_format.

    Rows are distinct, so a prediction that two joins reach twice comes out once.
    """
    predictions = predictions.withColumns(
        {
            "folder": fn.split_part("image", ("/", 1)),
            "image": fn.strip_whitespace("image"),
            "prediction": fn.strip_whitespace("prediction"),
            "slice_num": fn.shape_depth("shape"),
        }
    ).drop("shape")
    scan_list = scan_list.withColumn("folder", fn.strip_whitespace("folder"))
    # One join on folder brings the study id and the report number of the same list row.
    rows = ops.join_distinct(predictions, scan_list, ["folder"], ["unique_study_id", "report_num_temp"])
    rows = ops.join_ns(rows, details, ["unique_study_id", "report_num_temp"]).distinct()
    rows = rows.withColumn("StudyDate_Time_format", fn.parse_timestamp("StudyDate_Time_format"))
    # The largest subject is looked up before the ranks are made: the joins above should run once.
    return ops.dense_rank_per_subject(settle(rows), "unique_study_id", ["StudyDate_Time_format", "folder"])
