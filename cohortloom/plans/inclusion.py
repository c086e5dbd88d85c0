"""Lists for deciding on inclusion: likely cases, volume thresholds, tails, a random sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom import fixed_values as fixed, functions as fn, operators as ops, sources
from cohortloom.session import run_folder, settle

SUBJECT = "unique_study_id"
IPH, EAH, IVH = (f"{c}_predicted_volume_ml" for c in ["iph", "eah", "ivh"])
IPH_CHANGE, EAH_CHANGE = "change_iph_volume_first_scan", "change_eah_volume_first_scan"
TAIL_COLUMNS = [SUBJECT, "id", "report_num_temp", "folder", IPH, EAH, IPH_CHANGE, EAH_CHANGE]


def reviewed_scans(scans: DataFrame, review: DataFrame, reports: DataFrame) -> DataFrame:
    """Scans with their review, if there is one, and their report."""
    return ops.natural_join(ops.join_ns(scans, review, [SUBJECT], "left"), reports)


def included_scans(scans: DataFrame, review: DataFrame, reports: DataFrame, excluded: DataFrame) -> DataFrame:
    """Scans with their review and report; excluded subjects and scans are out, unreviewed subjects stay."""
    rows = reviewed_scans(scans, review, reports)
    return ops.not_in(rows.where(fn.flag_is_not("exclude", 1)), "id", excluded, "id_to_remove")


def inclusion_funnel(scans: DataFrame, review: DataFrame, reports: DataFrame, excluded: DataFrame) -> DataFrame:
    """Subjects and scans left after each step towards the cases with growth."""
    listed = excluded.select(F.col("id_to_remove").alias("id"), F.lit(1).alias("__listed")).distinct()
    rows = ops.join_ns(reviewed_scans(scans, review, reports), listed, ["id"], "left")
    steps = [
        ("reported", F.lit(True)),
        ("subject kept", fn.flag_is_not("exclude", 1)),
        ("scan kept", F.col("__listed").isNull()),
        ("likely case", F.col("potential_hematoma_expansion_case").isin(1, 999)),
        ("enough volume", fn.any_at_least({IPH: fixed.CASE_ML, EAH: fixed.CASE_ML})),
        ("grown", fn.any_at_least({IPH_CHANGE: fixed.IPH_GROWTH_ML, EAH_CHANGE: fixed.EAH_GROWTH_ML})),
    ]
    return ops.funnel(rows, steps, SUBJECT)


def change_histograms(cases: DataFrame, bins: int = 10) -> dict[str, DataFrame]:
    """Counts per bin of the two changes, over the cases with enough volume, both in the same two passes."""
    counts = ops.histograms(cases, [IPH_CHANGE, EAH_CHANGE], bins)
    return {c: counts.where(F.col("variable") == c).drop("variable") for c in (IPH_CHANGE, EAH_CHANGE)}


def _row_lists(plain_or: bool) -> dict[str, Column]:
    """The lists that a row is in or not by itself, given ``included``."""
    included, likely = F.col("included"), F.col("potential_hematoma_expansion_case").isin(1, 999)
    grown = fn.any_at_least({IPH_CHANGE: fixed.IPH_GROWTH_ML, EAH_CHANGE: fixed.EAH_GROWTH_ML})
    five_ml = included & fn.masked_or(F.col(IPH) >= fixed.CASE_ML, F.col(EAH) >= fixed.CASE_ML, None if plain_or else likely)
    case_five_ml = included & likely & fn.any_at_least({IPH: fixed.CASE_ML, EAH: fixed.CASE_ML})
    return {
        "excluded_subjects": fn.flag_is("exclude", 1),
        "accepted_subjects": fn.flag_is("exclude", 0),
        "included": included,
        "no_quality_error": included & (F.col("quality_control_metric") == 0),
        "cases": included & likely,
        "five_ml": five_ml,
        "five_ml_change": five_ml & grown,
        "case_five_ml": case_five_ml,
        "case_five_ml_change": case_five_ml & grown,
        "case_iph_change": case_five_ml & (F.col(IPH_CHANGE) >= fixed.IPH_GROWTH_ML),
        "case_eah_change": case_five_ml & (F.col(EAH_CHANGE) >= fixed.EAH_GROWTH_ML),
        "iph_grew": included & (F.col(IPH_CHANGE) >= fixed.TAIL_ML),
        "eah_grew": included & (F.col(EAH_CHANGE) >= fixed.TAIL_ML),
        "iph_large": included & (F.col(IPH) >= fixed.TAIL_ML),
        "eah_large": included & (F.col(EAH) >= fixed.TAIL_ML),
        "eah_shrank": included & (F.col(EAH_CHANGE) <= -fixed.TAIL_ML),
        "iph_shrank": included & (F.col(IPH_CHANGE) <= -fixed.TAIL_ML),
        "unreviewed": included & F.col("exclude").isNull(),
    }


TAILS = ["iph_grew", "eah_grew", "iph_large", "eah_large", "eah_shrank", "iph_shrank"]


def listed_scans(
    scans: DataFrame, review: DataFrame, reports: DataFrame, excluded: DataFrame, plain_or: bool = False
) -> DataFrame:
    """Every reviewed scan with ``lists``, the names of all lists it is in, worked out in one pass and written down.

    ``five_ml`` takes one class from all scans and the other from likely cases only; ``plain_or`` takes both
    from all scans.
    """
    out = excluded.select(F.col("id_to_remove").alias("id"), F.lit(True).alias("__out")).where(F.col("id").isNotNull()).distinct()
    rows = ops.join_ns(reviewed_scans(scans, review, reports), out, ["id"], "left")
    rows = rows.withColumn("included", fn.flag_is_not("exclude", 1) & F.col("__out").isNull())
    lists = F.array(*[F.when(F.coalesce(condition, F.lit(False)), F.lit(name)) for name, condition in _row_lists(plain_or).items()])
    return settle(rows.withColumn("lists", F.array_compact(lists)).drop("__out", "included"))


def all_lists(listed: DataFrame, cols: Sequence[str]) -> DataFrame:
    """All review lists as one table: ``list`` and the columns, a row once per list it is in; in one scan of
    ``listed``, with two more for the sample and for the subjects without bleeding (which have only their subject)."""
    each = listed.select(F.explode("lists").alias("list"), *cols)
    sample = review_sample(listed).select(F.lit("sample").alias("list"), *cols)
    none = no_hemorrhage(listed)
    only = [F.col(c) if c == SUBJECT else F.lit(None).cast(listed.schema[c].dataType).alias(c) for c in cols]
    return ops.union_all(each, sample, none.select(F.lit("no_hemorrhage").alias("list"), *only))


def in_list(listed: DataFrame, name: str) -> DataFrame:
    return listed.where(F.array_contains("lists", F.lit(name))).drop("lists")


def review_sample(listed: DataFrame) -> DataFrame:
    return ops.sample_n(in_list(listed, "five_ml"), "id", 20, fixed.SAMPLE_SEED)


def no_hemorrhage(listed: DataFrame) -> DataFrame:
    """Subjects whose scans show no volume at all."""
    top = ops.group_max(in_list(listed, "included"), [SUBJECT], [IPH, EAH, IVH])
    return top.where(F.col("total") == 0)


def inclusion_lists(
    scans: DataFrame, review: DataFrame, reports: DataFrame, excluded: DataFrame, plain_or: bool = False
) -> dict[str, DataFrame]:
    """The review lists by name, in no order: sort where a list is shown, ``unreviewed`` by falling IVH volume.

    All come from ``listed_scans``; ``all_lists`` gives them as one table in one scan.
    """
    listed = listed_scans(scans, review, reports, excluded, plain_or)
    lists = {name: in_list(listed, name) for name in _row_lists(plain_or) if name not in TAILS}
    tails = listed.select(F.explode(F.array_intersect("lists", F.array(*map(F.lit, TAILS)))).alias("tail"), *[c for c in TAIL_COLUMNS if c in listed.columns])
    return lists | {"sample": review_sample(listed), "tails": tails, "no_hemorrhage": no_hemorrhage(listed)}


def write_inclusion_lists(
    scans: DataFrame, review: DataFrame, reports: DataFrame, excluded: DataFrame, folder: str, plain_or: bool = False, kind: str = "parquet"
) -> dict[str, str]:
    """Write every review list into ``folder`` under its own name and give the paths; ``kind``: parquet or csv.

    The steps on the way are deleted at the end.
    """
    with run_folder(scans.sparkSession):
        lists = inclusion_lists(scans, review, reports, excluded, plain_or)
        return sources.write_all(lists, folder, kind)
