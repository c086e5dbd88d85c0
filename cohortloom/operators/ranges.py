"""Rows cut into sorted ranges, the ground for all numbering and sweeping without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.exprs import ascending
from cohortloom.session import settle


def sorted_ranges(df: DataFrame, order: Sequence[Column], ranges: int | None = None) -> DataFrame:
    """Rows cut into ordered ranges, with ``__part`` and the place ``__place`` (from 0) of the row in it.

    The result is written down, so that later passes and any retry see the same cut. No task holds more than
    one range. Range numbers and places come from the row ids Spark counts up in each sorted partition.
    """
    by = ascending(*order)
    cut = df.repartitionByRange(ranges, *by) if ranges else df.repartitionByRange(*by)
    numbered = cut.sortWithinPartitions(*by).withColumn("__id", F.monotonically_increasing_id())
    split = {"__part": F.shiftright("__id", 33), "__place": F.col("__id").bitwiseAND((1 << 33) - 1)}
    return settle(numbered.withColumns(split).drop("__id"))
