"""Data checks as small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.exprs import quoted
from cohortloom.operators.aggregates import group_counts, keyed


def unique_key_check(df: DataFrame, key: str) -> DataFrame:
    """Rows, distinct keys (null counts as one value) and whether the key is unique; one pass over the key."""
    per_key = df.groupBy(quoted(key)).count()
    out = per_key.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))
    return out.withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def group_size_range(df: DataFrame, keys: Sequence[str], counted: str | None = None) -> DataFrame:
    """Smallest and largest group."""
    sizes = group_counts(df, keys, counted)
    return sizes.agg(F.min("count").alias("min_size"), F.max("count").alias("max_size"))


def funnel(df: DataFrame, steps: Sequence[tuple[str, Column]], subject: str) -> DataFrame:
    """Subjects and rows left after each step, as one table. Steps add up: a row must pass all earlier ones.

    One pass: rows are counted per subject and step, then the subjects with rows left.
    """
    flags, passed = {}, F.lit(True)
    for i, (_, condition) in enumerate(steps):
        passed = passed & F.coalesce(condition, F.lit(False))
        flags[f"s{i}"] = passed
    marked = df.select(quoted(subject).alias("subject"), *[c.alias(n) for n, c in flags.items()])
    per_subject = marked.groupBy("subject").agg(*[F.count_if(F.col(n)).alias(n) for n in flags])
    known = F.col("subject").isNotNull()
    totals = per_subject.agg(
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in flags],
        *[F.count_if(known & (F.col(n) > 0)).alias("subjects_" + n) for n in flags],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(i).alias("step_no"),
                F.lit(name).alias("step"),
                F.col(f"subjects_s{i}").alias("subjects"),
                F.col(f"s{i}").alias("rows"),
            )
            for i, (name, _) in enumerate(steps)
        ]
    )
    return totals.select(F.explode(lines).alias("line")).select("line.*")


def completeness(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct keys asked for, keys with a value, and whether these agree.

    The gate looks at the value, not at the key: after an outer join every key is there, found or not.
    """
    per_key = keyed(df, [key]).groupBy(quoted(key)).agg(F.count(quoted(value)).alias("__n"))
    out = per_key.agg(F.count(F.lit(1)).alias("n_wanted"), F.count_if(F.col("__n") > 0).alias("n_found"))
    return out.withColumn("complete", F.col("n_wanted") == F.col("n_found"))
