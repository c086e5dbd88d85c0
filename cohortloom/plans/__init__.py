"""End-to-end plans: tables in, curated tables out."""

from cohortloom.plans.choose_images import CLEAN_COLUMNS, choice_funnel, choose_images, volume_changes
from cohortloom.plans.cohort import (
    FEATURES, LABELS, MODEL_COLUMNS, censored_review, cohort_scans, first_scans, model_table, small_first_scans, split_sets,
    subjects_by_first_scan, without_first_scan, write_split_sets,
)
from cohortloom.plans.inclusion import all_lists, change_histograms, inclusion_funnel, inclusion_lists, listed_scans, write_inclusion_lists
from cohortloom.plans.linkage import accession_check, link_reports, locate_scans
from cohortloom.plans.predictions import prepare_predictions
from cohortloom.plans.quality import excluded_reasons, large_volumes, quality_tables, status_summary
from cohortloom.plans.series import select_series
from cohortloom.plans.volumes import prepare_volumes

__all__ = [
    "CLEAN_COLUMNS", "FEATURES", "LABELS", "MODEL_COLUMNS", "accession_check", "all_lists", "censored_review", "change_histograms",
    "choice_funnel", "choose_images", "cohort_scans", "excluded_reasons", "first_scans", "inclusion_funnel", "inclusion_lists",
    "large_volumes", "link_reports", "listed_scans", "locate_scans", "model_table", "prepare_predictions", "prepare_volumes",
    "quality_tables", "select_series", "small_first_scans", "split_sets", "status_summary", "subjects_by_first_scan",
    "volume_changes", "without_first_scan", "write_inclusion_lists", "write_split_sets",
]
