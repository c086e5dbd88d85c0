"""Long tables for quality review: volumes of all scans, and changes of follow-up scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortloom import fixed_values as fixed, functions as fn, operators as ops
from cohortloom.session import settle

SUBJECT = "unique_study_id"

# Columns kept beside each value.
CHANGE_IDS = [
    SUBJECT, "id", "scan_number", "quality_control_metric", "exclude_id", "patient_excluded", "reason_excluded",
]
VOLUME_IDS = [*CHANGE_IDS, "notes"]


def marked_scans(scans: DataFrame, sheet: DataFrame, excluded: DataFrame) -> DataFrame:
    """Scans of the reviewed subjects. ``exclude_id`` is 1 if the scan or its subject is excluded."""
    rows = ops.join_ns(scans, sheet.select(SUBJECT), [SUBJECT])
    out = excluded.select(SUBJECT, F.col("id_to_remove").alias("id"), F.lit(1).alias("exclude_id"))
    patients = sheet.where(fn.flag_is("exclude", 1)).select(SUBJECT, F.lit(1).alias("patient_excluded"))
    rows = ops.join_ns(ops.join_ns(rows, out, [SUBJECT, "id"], "left"), patients, [SUBJECT], "left")
    rows = rows.withColumns({c: fn.null_indicator(c) for c in ["exclude_id", "patient_excluded"]})
    return rows.withColumn("exclude_id", fn.flag_combine("exclude_id", "patient_excluded"))


def with_status(long: DataFrame, iph: str, eah: str) -> DataFrame:
    kind, out = F.col("variable"), F.col("exclude_id")
    rules = [
        ((out == 1) & (kind == iph), fixed.STATUS_IPH + fixed.STATUS_OUT), ((out == 1) & (kind == eah), fixed.STATUS_EAH + fixed.STATUS_OUT),
        ((out == 0) & (kind == iph), fixed.STATUS_IPH), ((out == 0) & (kind == eah), fixed.STATUS_EAH),
    ]
    return long.withColumn("scan_status", fn.case_label(rules, fixed.STATUS_OTHER))


def excluded_reasons(sheet: DataFrame) -> DataFrame:
    """Reasons for leaving subjects out, cleaned, with their number and share."""
    return ops.percent_of_total(sheet.where(fn.flag_is("exclude", 1)), "reason_excluded")


def large_volumes(volumes: DataFrame, ml: float = fixed.LARGE_ML) -> DataFrame:
    """Number of very large volumes by class and whether the subject is left out."""
    return ops.value_counts(volumes.where(F.col("value") > ml), ["variable", "patient_excluded"])


def status_summary(long: DataFrame) -> DataFrame:
    """Five-number summary of the values of each scan status, the numbers behind the box plots."""
    return ops.five_number_summary(long, "value", ["scan_status"])


def quality_tables(
    scans: DataFrame, sheet: DataFrame, excluded: DataFrame,
    volume_ids: Sequence[str] = VOLUME_IDS, change_ids: Sequence[str] = CHANGE_IDS,
) -> tuple[DataFrame, DataFrame]:
    """(volumes of all scans, changes of follow-up scans), long. Follow-up scans are those whose report is not
    the report of any subject's first scan."""
    rows = settle(marked_scans(scans, sheet, excluded))
    volumes = ["iph_predicted_volume_ml", "eah_predicted_volume_ml"]
    changes = ["change_iph_volume_first_scan", "change_eah_volume_first_scan"]
    later = ops.followup_rows(rows, SUBJECT, "scan_number", "report_num_temp", ["id"])
    long_changes = with_status(ops.melt(later, change_ids, changes), *changes)
    return with_status(ops.melt(rows, volume_ids, volumes), *volumes), long_changes.withColumn("value_abs", F.abs("value"))
