"""Grouping and reshaping. Every group is pre-aggregated before its shuffle, so no group has to fit in a task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from cohortloom.functions.exprs import as_col, ascending, order_key, quoted, row_sum, strip_whitespace, ticked
from cohortloom.functions.predicates import all_of
from cohortloom.session import settle


def keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with no null among the keys; grouping drops the others."""
    return df.where(all_of([quoted(k).isNotNull() for k in keys]))


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """One row with the number of distinct non-null values of each column; ``approx`` uses a sketch instead."""
    count = F.approx_count_distinct if approx else F.count_distinct
    return df.agg(*[count(quoted(c)).alias(c) for c in cols])


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of each column."""
    return df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in df.columns])


def group_counts(df: DataFrame, keys: Sequence[str], counted: str | None = None, name: str = "count") -> DataFrame:
    """Non-null values of ``counted`` per key (rows, if none is named)."""
    value = F.count(F.lit(1)) if counted is None else F.count(quoted(counted))
    return keyed(df, keys).groupBy(*keys).agg(value.alias(name))


def value_counts(df: DataFrame, cols: Sequence[str], name: str = "count") -> DataFrame:
    """Frequency of each combination without nulls."""
    return group_counts(df, cols, name=name)


def percent_of_total(df: DataFrame, label: str, count: str = "count", share: str = "percent") -> DataFrame:
    """Frequency of the cleaned label and its share of all labelled rows.

    The total is a one-row subquery on the grouped table, not a window over it.
    """
    counts = value_counts(df.select(strip_whitespace(F.lower(quoted(label))).alias(label)), [label], count)
    total = counts.agg(F.sum(count)).scalar()
    return counts.withColumn(share, F.bround(F.col(count) * 100 / total, 1))


def group_max(df: DataFrame, keys: Sequence[str], cols: Sequence[str], prefix: str = "max_") -> DataFrame:
    """Largest value of each column per key and the sum of these, null as 0."""
    tops = keyed(df, keys).groupBy(*keys).agg(*[F.max(quoted(c)).alias(prefix + c) for c in cols])
    return tops.withColumn("total", row_sum(*[quoted(prefix + c) for c in cols]))


def _lowest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in order. Spark keeps the first row of each key in every input part before it shuffles,
    so a key may have any number of rows."""
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*ascending(*map(quoted, order)))
    return df.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") == 1).drop("__rank")


def argmin_per_group(df: DataFrame, keys: Sequence[str], metric: str, tiebreak: Sequence[str]) -> DataFrame:
    """The whole row with the lowest metric per key.

    Rows with null metric or null key take no part. Ties go to the lowest tie-break, which should name enough
    columns to tell rows apart.
    """
    return _lowest(keyed(df, [*keys, metric]), keys, [metric, *tiebreak])


def best_of_group(df: DataFrame, keys: Sequence[str], metric: str, tiebreak: Sequence[str]) -> DataFrame:
    """One row per key: groups of one as they are, larger ones reduced to the lowest metric, null metric last."""
    return _lowest(keyed(df, keys), keys, [metric, *tiebreak])


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add the sort key that ``first_non_null`` goes by, once for all aggregates."""
    return df.withColumn("__order", order_key(*[quoted(o) for o in order]))


def first_non_null(value: str) -> Column:
    """Aggregate over ``in_order`` rows: first value that is not null."""
    return F.expr(f"min_by({ticked(value)}, __order) FILTER (WHERE {ticked(value)} IS NOT NULL)")


def first_non_null_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key and column the first non-null value in order. One result row may mix source rows.

    First the first row of each key, written down. Only for the cells that are null there, the rows of these keys are
    looked through once more: each offers its values for the open cells, and the first offer per cell is taken. Spark
    keeps the first row per key, and the first offer per cell, in every input part before it shuffles them.
    """
    rows, values = keyed(df, keys), [f for f in df.schema.fields if f.name not in keys]
    # Groups are numbered as they are written, so that the second look goes by numbers.
    # Nulls are counted while the rows are written; a task that runs twice may count its own twice, never none of them.
    nulls = Observation()
    counts = [F.count_if(quoted(f.name).isNull()).alias(str(i)) for i, f in enumerate(values)]
    numbered = _lowest(rows, keys, order).withColumn("__group", F.monotonically_increasing_id())
    first = settle(numbered.observe(nulls, F.count(F.lit(1)).alias("rows"), *counts))
    empty = [(i, f) for i, f in enumerate(values) if nulls.get[str(i)] and f.dataType.typeName() != "void"]
    if not empty:
        return first.drop("__group")
    # A cell has a place for each type, so that cells of all columns are rows of one table.
    types = {f.dataType.simpleString(): f.dataType for _, f in empty}
    places = {kind: f"t{k}" for k, kind in enumerate(types)}

    def cell(i: int, field) -> Column:
        own = places[field.dataType.simpleString()]
        value = [(quoted(field.name) if p == own else F.lit(None).cast(types[kind])).alias(p) for kind, p in places.items()]
        return F.struct(F.lit(i).alias("i"), *value)

    gaps = F.array_compact(F.array(*[F.when(quoted(f.name).isNull(), F.lit(i)) for i, f in empty]))
    wanted = first.select(*[quoted(k).alias(f"__key{n}") for n, k in enumerate(keys)], F.col("__group"), gaps.alias("__gaps")).where(F.size("__gaps") > 0)
    same = all_of([quoted(k) == F.col(f"__key{n}") for n, k in enumerate(keys)])
    offers = F.array_compact(F.array(*[F.when(F.array_contains("__gaps", F.lit(i)) & quoted(f.name).isNotNull(), cell(i, f)) for i, f in empty]))
    steps = {f"__order{n}": quoted(o) for n, o in enumerate(order)}
    offered = rows.join(wanted, same).select("__group", *[c.alias(n) for n, c in steps.items()], F.explode(offers).alias("__cell"))
    taken = _lowest(offered.withColumn("__i", F.col("__cell.i")), ["__group", "__i"], list(steps))
    cells = F.map_from_entries(F.collect_list(F.struct("__i", "__cell"))).alias("__cells")
    filled = first.join(settle(taken.groupBy("__group").agg(cells)), "__group", "left")
    for i, f in empty:
        given = F.try_element_at(F.col("__cells"), F.lit(i))[places[f.dataType.simpleString()]]
        filled = filled.withColumn(f.name, F.coalesce(quoted(f.name), given))
    return filled.select(*[quoted(c) for c in df.columns])


def pivot_unique(df: DataFrame, row: str, column: str, value: str, names: Sequence[str]) -> DataFrame:
    """Long to wide for the named attributes. A repeated (row, attribute) pair is an error, never merged."""

    def cell(name: str) -> Column:
        here = quoted(column) == name
        problem = F.raise_error(F.lit(f"more than one value for attribute {name}"))
        return F.when(F.count_if(here) > 1, problem).otherwise(F.max(F.when(here, quoted(value)))).alias(name)

    return keyed(df, [row]).groupBy(row).agg(*[cell(n) for n in names])


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Wide to long as (ids, variable, value); null values stay."""
    return df.unpivot([quoted(c) for c in ids], [quoted(c) for c in values], "variable", "value")


def histograms(df: DataFrame, values: Sequence[str], bins: int = 10) -> DataFrame:
    """``variable, bin, count``: rows per equal-width bin between lowest and highest value of each column, the last bin
    closed; nulls and NaN take no part.

    For a constant column the range reaches half a unit to both sides. Empty bins have count 0. The table is read
    twice, however many columns there are: for all ends, and for all counts.
    """
    numbers = {c: F.nullif(quoted(c).cast("double"), F.lit(float("nan"))) for c in values}
    low_high = [F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias(f"e{i}") for i, x in enumerate(numbers.values())]
    ends = df.agg(F.struct(*low_high).alias("ends")).scalar()
    cells = [F.struct(F.lit(i).alias("i"), x.alias("x"), ends[f"e{i}"]["low"].alias("low"), ends[f"e{i}"]["high"].alias("high")) for i, x in enumerate(numbers.values())]
    long = df.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("x").isNotNull())
    flat = F.col("low") == F.col("high")
    low, high = F.when(flat, F.col("low") - 0.5).otherwise(F.col("low")), F.when(flat, F.col("high") + 0.5).otherwise(F.col("high"))
    number = F.least(F.width_bucket("x", low, high, F.lit(bins)), F.lit(bins)).cast("int")
    counts = long.groupBy("i", number.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    labels = F.array(*[F.lit(c) for c in values])
    every = df.sparkSession.range(len(values) * bins).select(F.floor(F.col("id") / bins).cast("int").alias("i"), (F.col("id") % bins + 1).cast("int").alias("bin"))
    out = every.join(counts, ["i", "bin"], "left")
    return out.select(F.get(labels, F.col("i")).alias("variable"), "bin", F.coalesce("n", F.lit(0)).alias("count"))


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """``bin, count`` of one column (see ``histograms``)."""
    return histograms(df, [value], bins).drop("variable")


def tail_lists(df: DataFrame, tails: Sequence[tuple[str, Column]], cols: Sequence[str]) -> DataFrame:
    """Review lists in one pass: a row comes out once per tail it is in, with the tail's label."""
    labels = F.array(*[F.when(condition, F.lit(label)) for label, condition in tails])
    return df.select(F.explode(F.array_compact(labels)).alias("tail"), *[as_col(c) for c in cols])
