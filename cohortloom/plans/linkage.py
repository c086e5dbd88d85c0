"""From report tables to the folders of the scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortloom import functions as fn, operators as ops

# Columns of the linked report table, in order.
LINKED_COLUMNS = [
    "unique_study_id", "report_num_temp", "SearchAccession", "VNAAccession", "StudyID", "EDWAccession",
    "StudyDescription", "StudyDate", "StudyTime", "SUIDs", "StudyDate_format", "SearchAccession_temp", "order_reason",
    "accession", "trauma", "fall", "injury", "assault", "auto", "any trauma", " hemorrhage ",
    "posttraumatic hemorrhage", "report", "accession_temp",
]
PERSONAL_COLUMNS = ["Name", "DOB"]
ID_KEYS = ["SearchAccession", "VNAAccession", "EDWAccession"]


def link_reports(images: DataFrame, reports: DataFrame, ids: DataFrame, cols: Sequence[str] = LINKED_COLUMNS) -> DataFrame:
    """Image records joined to their annotated report and stable study id, without names and birth dates."""
    images = images.drop(*PERSONAL_COLUMNS).withColumns(
        {
            "StudyDate_format": fn.parse_int_date("StudyDate"),
            "SearchAccession_temp": fn.normalize_accession("SearchAccession", "plain"),
            "report_num_temp": fn.report_number("EDWAccession"),
        }
    )
    reports = reports.withColumn("accession_temp", fn.normalize_accession("accession", "plain"))
    # A number that is missing on both sides links nothing.
    linked = ops.join_on(images, reports.where(F.col("accession").isNotNull()), [("EDWAccession", "accession")])
    linked = ops.join_ns(linked, ids.select("unique_study_id", *ID_KEYS), ID_KEYS)
    return linked.select(*[fn.quoted(c) for c in cols])


def accession_check(images: DataFrame) -> DataFrame:
    """Image records, different search numbers, and whether each record has one of its own, as linkage takes for granted."""
    return ops.unique_key_check(images, "SearchAccession")


def locate_scans(wanted: DataFrame, manifests: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Folder of each wanted scan, looked up by report number and, for those not found, by archive number. A missing
    number finds nothing.

    ``manifests`` are (table, path prefix) pairs. Scans that neither number finds come out with a null
    ``file_path``, to be caught by the gate on writing.
    """
    listed = ops.union_all(
        *[
            m.withColumn("file_path", fn.literal_replace(F.concat(F.lit(prefix), "folder"), " "))
            for m, prefix in manifests
        ]
    ).withColumn("manifest_key", fn.normalize_accession("accession", "manifest"))
    wanted = wanted.withColumns(
        {
            "accession_temp": fn.normalize_accession("report_num_temp", "dated"),
            "VNAAccession_temp": fn.normalize_accession("VNAAccession", "fallback"),
        }
    )
    keys = [("accession_temp", "manifest_key"), ("VNAAccession_temp", "manifest_key")]
    return ops.waterfall(wanted, listed, keys).drop("manifest_key")
