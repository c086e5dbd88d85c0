"""Values of a subject's whole history on each of its rows: one grouped pass, then a lookup join.

A window over the subject would put all rows of one subject in one task. Here the history is reduced before its
shuffle, written down, and joined to the rows. As the written table has a known size, Spark broadcasts it if it is
below ``spark.sql.autoBroadcastJoinThreshold``, and then the rows are not shuffled at all; otherwise it is a sort-merge
join in which the adaptive skew join may split a large subject. Columns of the result replace older ones of that name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortloom.functions.exprs import elapsed_hours, outcome_flag, quoted
from cohortloom.operators.aggregates import argmin_per_group, first_non_null, group_counts, in_order, keyed
from cohortloom.operators.joins import join_ns, not_in
from cohortloom.session import settle


def group_max_on_rows(df: DataFrame, keys: Sequence[str], col: str, name: str) -> DataFrame:
    """Largest value of the group on every row; null where a key is null."""
    tops = keyed(df, keys).groupBy(*keys).agg(F.max(quoted(col)).alias(name))
    return join_ns(df.drop(name), settle(tops), keys, "left")


def first_on_rows(df: DataFrame, subject: str, order: Sequence[str], cols: dict[str, str]) -> DataFrame:
    """First non-null value in order of each column on every row of the subject, as {column: new name}."""
    rows = in_order(keyed(df, [subject]), order)
    firsts = rows.groupBy(subject).agg(*[first_non_null(c).alias(name) for c, name in cols.items()])
    return join_ns(df.drop(*cols.values()), settle(firsts), [subject], "left")


def within_hours(
    df: DataFrame, subject: str, ts: str, hours: float, elapsed: str = "time_since_first_scan"
) -> DataFrame:
    """Rows at most ``hours`` after the subject's first row. Hours are rounded half to even first, so a window
    of 72 hours admits 72.5 hours."""
    firsts = keyed(df, [subject]).groupBy(subject).agg(F.min(quoted(ts)).alias("first_scan_time"))
    rows = join_ns(df.drop("first_scan_time"), settle(firsts), [subject]).withColumn(elapsed, elapsed_hours("first_scan_time", quoted(ts)))
    return rows.where(F.col(elapsed) <= hours)


def baseline_change(
    df: DataFrame,
    subject: str,
    order: Sequence[str],
    cols: Sequence[str],
    first: str = "{}_first",
    change: str = "change_{}",
    greatest: str | None = None,
) -> DataFrame:
    """Each column minus the subject's first non-null value of it.

    With ``greatest`` the subject's greatest change is added too. It is taken as greatest value minus first
    value, which is the same number, so that all of it comes from one grouped pass and one join.
    """
    aggs = [first_non_null(c).alias(first.format(c)) for c in cols]
    if greatest:
        aggs += [F.max(quoted(c)).alias(greatest.format(c)) for c in cols]
    history = in_order(keyed(df, [subject]), order).groupBy(subject).agg(*aggs)
    if greatest:
        history = history.withColumns(
            {greatest.format(c): quoted(greatest.format(c)) - quoted(first.format(c)) for c in cols}
        )
    rows = join_ns(df.drop(*[c for c in history.columns if c != subject]), settle(history), [subject], "left")
    return rows.withColumns({change.format(c): quoted(c) - quoted(first.format(c)) for c in cols})


def rebaseline_after_exclusion(
    df: DataFrame,
    excluded: DataFrame,
    id_col: str,
    excluded_col: str,
    subject: str,
    order: Sequence[str],
    cols: Sequence[str],
    **names: str,
) -> DataFrame:
    """Remove the listed rows, then measure change from each subject's first remaining row."""
    return baseline_change(not_in(df, id_col, excluded, excluded_col), subject, order, cols, **names)


def outcomes(
    df: DataFrame, subject: str, changes: Sequence[str], cuts: Sequence[float], censored: str, name: str = "outcome_{}"
) -> DataFrame:
    """Outcome flags of the subject on each of its rows: greatest change reaches the cut, and not censored."""
    tops = keyed(df, [subject]).groupBy(subject).agg(*[F.max(quoted(c)).alias("max_" + c) for c in changes])
    rows = join_ns(df.drop(*["max_" + c for c in changes]), settle(tops), [subject], "left")
    tops_cols = [quoted("max_" + c) for c in changes]
    return rows.withColumns({name.format(cut): outcome_flag(tops_cols, cut, quoted(censored)) for cut in cuts})


def min_rows_per_subject(df: DataFrame, subject: str, n: int, counted: str | None = None) -> DataFrame:
    """Drop subjects with fewer than n rows; rows with null subject stay, as no count refers to them."""
    few = group_counts(df, [subject], counted).where(F.col("count") < n)
    return join_ns(df, settle(few.select(subject)), [subject], "anti")


def followup_rows(df: DataFrame, subject: str, number: str, report: str, tiebreak: Sequence[str]) -> DataFrame:
    """Rows whose report is not the report of any subject's first row."""
    slim = df.select(*[quoted(c) for c in dict.fromkeys([subject, number, report, *tiebreak])])
    first = argmin_per_group(slim, [subject], number, tiebreak)
    return not_in(df, report, settle(first.select(quoted(report))), report)
