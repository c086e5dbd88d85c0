"""One image per scan: quality filters, corrected images first, human choices, lowest quality metric otherwise."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom import fixed_values as fixed, functions as fn, operators as ops
from cohortloom.session import settle

SUBJECT, REPORT = "unique_study_id", "report_num_temp"
SERIES_KEYS = [SUBJECT, REPORT, "scan_number", "folder", "image_name"]
VOLUMES = ["iph", "eah", "ivh"]

# Columns of the cleaned table, in order.
CLEAN_COLUMNS = [
    "unique_study_id", "report_num_temp", "flag_post_trauma_hem", "id", "scan_number", "StudyDate_Time_format",
    "iph_predicted_volume_ml", "eah_predicted_volume_ml", "oedema_predicted_volume_ml", "ivh_predicted_volume_ml",
    "quality_control_metric", "folder", "image_name", "slice_num",
    "total_volume_scan", "total_volume_first_scan", "change_total_volume_scan",
    "iph_volume_first", "eah_volume_first", "ivh_volume_first",
    "change_iph_volume_first_scan", "change_eah_volume_first_scan", "change_ivh_volume_first_scan",
    *fn.family_names(fixed.CLASS_REGION, fixed.REGIONS, fixed.CLASSES),
    *fn.family_names(fixed.REGION_VOLUME, ["Brain", *fixed.REGIONS]),
    "image", "prediction", "atlas_in_native_space", "brain_mask_native_space",
]


# What the choice looks at, and what tells images apart of which one is taken.
CHOICE = [SUBJECT, REPORT, "folder", "scan_number", "image_name", "corrected", "id", "quality_control_metric"]
ONE_EACH = [SUBJECT, "image_name", "scan_number", "corrected"]


def image_filters(drop_ids: Sequence, keep_ids: Sequence) -> list[tuple[str, Column]]:
    """The filters of usable images in their order. ``keep_ids`` escape the slice limits, ``drop_ids`` are removed."""
    return [
        ("not removed by hand", fn.not_listed("id", drop_ids)),
        ("usable image", fn.contains_none("image", fixed.UNUSABLE_IMAGE_WORDS)),
        ("slices in range", fn.range_or_listed("slice_num", fixed.MIN_SLICES, fixed.MAX_SLICES, "id", keep_ids)),
    ]


def usable_images(predictions: DataFrame, drop_ids: Sequence, keep_ids: Sequence) -> DataFrame:
    """Rows without unusable images. Repeated rows stay: they are in one group, of which one row is taken next."""
    rows = predictions.where(fn.all_of([condition for _, condition in image_filters(drop_ids, keep_ids)]))
    return rows.withColumns(
        {
            "quality_control_metric": fn.fill_null("quality_control_metric", 0.0),
            "image_name": fn.split_part("image", ("/random/", 1), ("/", 0)),
            "corrected": fn.contains_any("image", fixed.CORRECTED_IMAGE_WORDS),
        }
    )


def choice_steps(rows: DataFrame, picks: DataFrame) -> dict[str, DataFrame]:
    """What is left after each step of the choice, in the columns ``CHOICE``, each written down.

    Only these columns of ``rows`` are read. The last step leaves subjects with two folders or more that have a report.
    """
    best = settle(ops.best_of_group(rows.select(*CHOICE), ONE_EACH, "quality_control_metric", ["id"]))
    corrected = settle(ops.prefer(best, fn.as_col("corrected"), SERIES_KEYS))
    by_hand = ops.override(
        corrected, picks, "id_to_keep", SUBJECT, REPORT, "folder", "scan_number", "id", "quality_control_metric", ["id"]
    )
    by_hand = settle(ops.keyed(by_hand, [SUBJECT, "folder"]).distinct())
    folders = by_hand.where(fn.as_col(REPORT).isNotNull()).select(SUBJECT, "folder").distinct()
    enough = ops.group_counts(folders, [SUBJECT]).where(F.col("count") >= 2)
    followed = settle(ops.join_ns(by_hand, settle(enough), [SUBJECT], "semi"))
    return {"one of each series": best, "corrected if there is one": corrected, "chosen by hand": by_hand, "two folders": followed}


def choose_images(predictions: DataFrame, picks: DataFrame, drop_ids: Sequence, keep_ids: Sequence) -> DataFrame:
    """One row per subject and folder, for subjects with at least two. ``picks`` has unique_study_id, id_to_keep.

    The choice is made on the key columns; whole rows are looked up once it is known, and written once.
    ``predictions`` is read for the choice and for the rows: settle it first if it is costly.
    """
    rows = usable_images(predictions, drop_ids, keep_ids)
    chosen = choice_steps(rows, picks)["two folders"]
    # Rows that agree in all these columns are one image; one of them is taken, as in the choice.
    whole = ops.best_of_group(ops.join_ns(rows, chosen, CHOICE, "semi"), ONE_EACH, "quality_control_metric", ["id"])
    return ops.first_non_null_per_group(whole.drop("corrected"), [SUBJECT, "folder"], ["scan_number", "id"])


def choice_funnel(predictions: DataFrame, picks: DataFrame, drop_ids: Sequence, keep_ids: Sequence) -> DataFrame:
    """Subjects and scans left after each filter and each step of the choice: ``step_no, step, subjects, rows``.

    The filters are counted in one pass over the predictions, the choices on the columns they are made on.
    """
    filters = [("predicted", F.lit(True)), *image_filters(drop_ids, keep_ids)]
    counted = ops.funnel(predictions, filters, SUBJECT)
    steps = choice_steps(usable_images(predictions, drop_ids, keep_ids), picks)
    for number, (name, left) in enumerate(steps.items(), len(filters)):
        sizes = left.agg(F.count_distinct(SUBJECT).alias("subjects"), F.count(F.lit(1)).alias("rows"))
        counted = counted.unionByName(sizes.select(F.lit(number).alias("step_no"), F.lit(name).alias("step"), "subjects", "rows"))
    return counted


def volume_changes(rows: DataFrame) -> DataFrame:
    """Total volume and change from the subject's first scan in time, in total and per compartment."""
    total, names = "total_volume_scan", {c: f"{c}_predicted_volume_ml" for c in VOLUMES}
    renamed = {f"{total}_first": "total_volume_first_scan"}
    renamed |= {f"{n}_first": f"{c}_volume_first" for c, n in names.items()}
    renamed |= {f"change_{n}": f"change_{c}_volume_first_scan" for c, n in names.items()}
    rows = rows.drop(*renamed.values()).withColumn(total, fn.row_sum(*names.values()))
    rows = ops.baseline_change(rows, SUBJECT, ["StudyDate_Time_format", "id"], [total, *names.values()])
    return rows.withColumnsRenamed(renamed)
