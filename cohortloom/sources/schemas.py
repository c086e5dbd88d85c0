"""Schemas of the input tables. Column names are fixed values of the data model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql.types import (
    ArrayType, DataType, DoubleType, IntegerType, StringType, StructField, StructType, TimestampNTZType,
)

from cohortloom import fixed_values as fixed
from cohortloom.functions.exprs import family_names

TEXT, NUMBER, WHOLE, TIME = StringType(), DoubleType(), IntegerType(), TimestampNTZType()


def _table(*parts: tuple[DataType, Sequence[str]]) -> StructType:
    return StructType([StructField(name, kind) for kind, names in parts for name in names])


IMAGE_METADATA = _table(
    (TEXT, ["SearchAccession", "VNAAccession", "EDWAccession", "StudyID", "StudyDescription"]),
    (WHOLE, ["StudyDate"]),
    (TEXT, ["StudyTime", "SUIDs", "order_reason", "Name", "DOB"]),
)
ANNOTATED_REPORTS = _table(
    (TEXT, ["accession"]),
    (WHOLE, ["trauma", "fall", "injury", "assault", "auto", "any trauma", " hemorrhage ", "posttraumatic hemorrhage"]),
    (TEXT, ["report"]),
)
ID_LIST = _table((TEXT, ["unique_study_id", "SearchAccession", "VNAAccession", "EDWAccession"]))
SCANS_TO_INCLUDE = _table(
    (TEXT, ["unique_study_id", "report_num_temp", "SearchAccession", "VNAAccession", "EDWAccession", "StudyID", "StudyDate_Time_format"]),
    (WHOLE, ["flag_post_trauma_hem"]),
)
MANIFEST_NAMES = ["patient_id", "accession", "folder"]
TAGS = _table((TEXT, ["file_path", "Group", "Elem", "Description", "VR", "value"]))
VOLUMES = _table((TEXT, ["id", "image"]), (ArrayType(WHOLE), ["shape"]))
PREDICTIONS = _table(
    (TEXT, ["id", "image", "prediction", "atlas_in_native_space", "brain_mask_native_space"]),
    (NUMBER, [f"{c}_predicted_volume_ml" for c in fixed.CLASSES]),
    (NUMBER, ["quality_control_metric"]),
    (NUMBER, family_names(fixed.CLASS_REGION, fixed.REGIONS, fixed.CLASSES)),
    (NUMBER, family_names(fixed.REGION_VOLUME, ["Brain", *fixed.REGIONS])),
)
IMAGE_CHOICE = _table((TEXT, ["unique_study_id", "id_to_keep"]))
SCANS_TO_EXCLUDE = _table((TEXT, ["unique_study_id", "id_to_remove"]))
PATIENT_REVIEW = _table(
    (TEXT, ["unique_study_id"]),
    (WHOLE, ["exclude", "potential_hematoma_expansion_case"]),
    (TEXT, ["injury"]),
    (WHOLE, ["surgery"]),
    (TEXT, ["surgery_type", "artifact", "reason_excluded", "notes"]),
)
CHART_REVIEW = _table(
    (TEXT, ["unique_study_id", "injury"]),
    (WHOLE, ["exclude", "surgery"]),
    (TEXT, ["surgery_type"]),
    (WHOLE, ["first_scan_after_surgery", "second_scan_post_surgery_trauma"]),
    (TEXT, ["artifact", "prior_neurological_surgery", "reason_excluded", "notes"]),
)
