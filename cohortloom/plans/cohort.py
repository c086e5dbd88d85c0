"""The labelled cohort: time window, reviewed subjects, new baseline, outcomes, train and test sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortloom import fixed_values as fixed, functions as fn, operators as ops, sources
from cohortloom.session import run_folder, settle

SUBJECT, TIME, CENSORED = "unique_study_id", "StudyDate_Time_format", "second_scan_post_surgery_trauma"
VOLUMES = {c: f"{c}_predicted_volume_ml" for c in ["iph", "eah", "ivh"]}

# Columns of the model table, in order.
MODEL_COLUMNS = [
    "unique_study_id", "report_num_temp", "scan_number", "StudyDate_Time_format", "quality_control_metric", "injury",
    "second_scan_post_surgery_trauma", "surgery", "surgery_type", "first_scan_after_surgery", "artifact",
    "outcome_6ml", "outcome_8ml", "outcome_10ml", "notes",
    "iph_predicted_volume_ml", "eah_predicted_volume_ml", "ivh_predicted_volume_ml", "oedema_predicted_volume_ml",
    "change_iph_volume_first_scan", "change_eah_volume_first_scan", "change_ivh_volume_first_scan",
    "max_change_iph_volume_first_scan", "max_change_eah_volume_first_scan", "max_change_ivh_volume_first_scan",
    *fn.family_names(fixed.CLASS_REGION, fixed.REGIONS, fixed.MODEL_CLASSES),
]

# Columns of the feature and the label table.
FEATURES = [
    SUBJECT, "surgery", "surgery_type", CENSORED, "iph_predicted_volume_ml", "eah_predicted_volume_ml",
    "oedema_predicted_volume_ml", "ivh_predicted_volume_ml",
]
LABELS = [SUBJECT, CENSORED, "outcome_6ml", "outcome_8ml", "outcome_10ml"]


def subjects_by_first_scan(scans: DataFrame, ml: float = fixed.FIRST_SCAN_ML) -> DataFrame:
    """Subjects whose first scan shows at least ``ml`` in one of the two main classes."""
    volumes = [VOLUMES["iph"], VOLUMES["eah"]]
    first = ops.first_non_null_per_group(scans.select(SUBJECT, TIME, "id", *volumes), [SUBJECT], [TIME, "id"])
    return first.where(fn.any_at_least({v: ml for v in volumes})).select(SUBJECT)


def cohort_scans(
    scans: DataFrame, sheet: DataFrame | None, excluded: DataFrame, hours: float = fixed.WINDOW_HOURS
) -> DataFrame:
    """Scans in the time window, of the subjects to go on with, without the excluded scans.

    The reviewed ``sheet`` decides on subjects: ``exclude`` is 0, or censored is 1. Its columns replace those of
    the same name in ``scans``. Without a sheet the volume on the first scan decides, and nothing is censored.
    """
    rows = ops.within_hours(scans, SUBJECT, TIME, hours)
    if sheet is None:
        rows = ops.join_ns(rows, subjects_by_first_scan(rows), [SUBJECT], "semi")
        rows = rows.withColumn(CENSORED, F.lit(None).cast("int"))
    else:
        reviewed = sheet.where(fn.flag_is("exclude", 0) | fn.flag_is(CENSORED, 1))
        stale = [c for c in ops.shared_columns(rows, reviewed) if c != SUBJECT]
        rows = ops.join_ns(rows.drop(*stale), reviewed, [SUBJECT])
    return ops.not_in(rows, "id", excluded, "id_to_remove")


def without_first_scan(cohort: DataFrame) -> DataFrame:
    """Subjects of the cohort none of whose scans has number 1."""
    first = cohort.where(F.col("scan_number") == 1).select(SUBJECT)
    return ops.set_difference(cohort.select(SUBJECT), first)


def small_first_scans(cohort: DataFrame, ml: float = fixed.FIRST_SCAN_ML) -> DataFrame:
    """First scans that show less than ``ml`` in both main classes; a missing volume shows nothing."""
    enough = fn.any_at_least({VOLUMES["iph"]: ml, VOLUMES["eah"]: ml})
    return cohort.where((F.col("scan_number") == 1) & ~F.coalesce(enough, F.lit(False)))


def censored_review(sheet: DataFrame, excluded: DataFrame) -> DataFrame:
    """Excluded scans of the subjects that go on, beside what the sheet says of the subject."""
    kept = sheet.where(fn.flag_is("exclude", 0) | fn.flag_is(CENSORED, 1))
    return ops.join_ns(kept, excluded, [SUBJECT])


def model_table(cohort: DataFrame, cuts: Sequence[float] = fixed.OUTCOME_CUTS) -> DataFrame:
    """All scans with change from the first scan by scan number, greatest change and outcome flags.

    The outcome belongs to the subject and stands on each of its rows; a censored subject has outcome 0.
    """
    renamed = {f"{v}_first": f"{c}_volume_first" for c, v in VOLUMES.items()}
    renamed |= {f"change_{v}": f"change_{c}_volume_first_scan" for c, v in VOLUMES.items()}
    renamed |= {f"max_change_{v}": f"max_change_{c}_volume_first_scan" for c, v in VOLUMES.items()}
    # Older changes are dropped: they were measured from a first scan that may be excluded by now.
    rows = ops.baseline_change(
        cohort.drop(*renamed.values()), SUBJECT, ["scan_number", "id"], list(VOLUMES.values()), greatest="max_change_{}"
    )
    rows = rows.withColumnsRenamed(renamed).withColumn(CENSORED, fn.fill_null(CENSORED, 0))
    tops = ["max_change_iph_volume_first_scan", "max_change_eah_volume_first_scan"]
    return rows.withColumns({f"outcome_{cut}ml": fn.outcome_flag(tops, cut, CENSORED) for cut in cuts})


def first_scans(model: DataFrame) -> DataFrame:
    """One row per subject, in order of time, without notes. Each column is its first value that is not null."""
    return ops.first_non_null_per_group(model, [SUBJECT], [TIME, "scan_number", "report_num_temp"]).drop("notes")


def split_sets(
    first: DataFrame, share: float = fixed.TEST_SHARE, seed: int = fixed.SPLIT_SEED,
    features: Sequence[str] = FEATURES, labels: Sequence[str] = LABELS,
) -> dict[str, DataFrame]:
    """Features and labels of the train and the test set: X_train, X_test, y_train, y_test."""
    marked = ops.split_exact(first, SUBJECT, share, seed)
    return {
        f"{kind}_{part}": marked.where(F.col("split") == part).select(*cols)
        for kind, cols in [("X", features), ("y", labels)]
        for part in ["train", "test"]
    }


def write_split_sets(model: DataFrame, folder: str, kind: str = "parquet", **options) -> dict[str, str]:
    """Write the four sets of the first scans into ``folder``, each as it is and without the subject (``_no_id``), and
    give the paths. ``options``: see ``split_sets``. The steps on the way are deleted at the end."""
    with run_folder(model.sparkSession):
        sets = split_sets(settle(first_scans(model)), **options)
        bare = {f"{name}_no_id": sources.deidentify(rows, [SUBJECT]) for name, rows in sets.items()}
        return sources.write_all(sets | bare, folder, kind)
