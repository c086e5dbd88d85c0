"""Choosing records: variants, human choices, unions and differences."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.exprs import ascending, hex_code, quoted
from cohortloom.operators.aggregates import argmin_per_group, group_counts
from cohortloom.operators.joins import distinct_keys, join_ns, not_in
from cohortloom.session import settle


def prefer(df: DataFrame, is_variant: Column, keys: Sequence[str]) -> DataFrame:
    """Where a key has a variant row, drop its other rows. Null keys count as equal."""
    variant = df.where(F.coalesce(is_variant, F.lit(False)))
    other = df.where(~F.coalesce(is_variant, F.lit(False)))
    return variant.unionByName(join_ns(other, distinct_keys(variant, keys), keys, "anti"))


def override(
    base: DataFrame,
    manual: DataFrame,
    manual_id: str,
    subject: str,
    report: str,
    folder: str,
    number: str,
    row_id: str,
    metric: str,
    tiebreak: Sequence[str],
) -> DataFrame:
    """Replace the rows of crowded groups by chosen ones, human choice first, lowest metric otherwise.

    A crowded group is a (subject, folder, number) with two rows or more. ``manual`` lists (subject, manual_id)
    picked by hand. Reports with a pick take no part in the default rule, which works per (subject, report).
    A choice blocks all other rows of its (subject, report, folder), whatever their number. Rows of a crowded
    group whose report was chosen in another folder stay. A repeated pick repeats its row.
    """
    group, block = [subject, folder, number], [subject, report, folder]
    # The choice needs a few columns only; whole rows are fetched at the end.
    slim = base.select(*[quoted(c) for c in dict.fromkeys([*block, number, row_id, metric, *tiebreak])])
    crowded = group_counts(slim, group).where(F.col("count") >= 2)
    rows = join_ns(slim, crowded, group, "semi")
    listed = manual.select(quoted(subject), quoted(manual_id).alias(row_id))
    # Picks and choice are written down: each is used twice, and Spark can broadcast them if they are small.
    picked = settle(join_ns(rows, listed, [subject, row_id]))
    unpicked = not_in(rows, report, picked, report)
    chosen = argmin_per_group(unpicked, [subject, report], metric, tiebreak).unionByName(picked)
    chosen = settle(chosen.select(*map(quoted, block), quoted(row_id)))
    kept = join_ns(base, chosen, block, "anti")
    return kept.unionByName(join_ns(base, chosen, [*block, row_id], "right"))


def union_all(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column missing in one is null there. Repeated rows stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that are not in ``b``."""
    return a.subtract(b)


def tag_long_table(
    df: DataFrame, entity: str, file: str, group: str, elem: str, name: str, vr: str, value: str, skip: str = "Pixel Data"
) -> DataFrame:
    """Header attributes of one representative file per entity, the pixel attribute left out.

    The representative is the file with the smallest name, so that the result does not depend on the order of
    a directory listing. Spark keeps the first rank of each entity in every input part before it shuffles, so an
    entity may have any number of files.
    """
    first = F.rank().over(Window.partitionBy(quoted(entity)).orderBy(*ascending(quoted(file))))
    rows = df.withColumn("__rank", first).where(F.col("__rank") == 1)
    return rows.where(F.coalesce(quoted(name) != skip, F.lit(True))).select(
        quoted(entity).cast("string").alias("file_path"),
        hex_code(quoted(group)).alias("Group"),
        hex_code(quoted(elem)).alias("Elem"),
        quoted(name).alias("Description"),
        quoted(vr).alias("VR"),
        quoted(value).cast("string").alias("value"),
    )
