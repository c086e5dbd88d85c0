"""Numbering, ranks, quantiles, samples and splits without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.exprs import ascending, as_col, quoted
from cohortloom.operators.aggregates import keyed
from cohortloom.operators.joins import join_ns
from cohortloom.operators.ranges import sorted_ranges
from cohortloom.session import settle

# Leading hexadecimal digits of the hash that make a bucket: 65,536 buckets at most, whatever the data size.
_BUCKET_DIGITS = 4


def global_row_id(df: DataFrame, order: Sequence[str], name: str = "row_id", ranges: int | None = None) -> DataFrame:
    """Number the rows 1..n in the given order, which must tell rows apart. ``ranges`` is the number of sorted
    ranges, the shuffle partitions if not given."""
    ranged = sorted_ranges(df, [quoted(o) for o in order], ranges)
    # One row per range, so one task may add them up, and the sums may be broadcast.
    sizes = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"))
    out = ranged.join(F.broadcast(starts), "__part").withColumn(name, F.col("__start") + F.col("__place") + 1)
    return out.drop("__part", "__place", "__start")


def running_total(
    df: DataFrame, order: Sequence[str], weight: Column, name: str, within: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """Add the running sum of ``weight`` in the order of ``order``, restarting for each ``within``.

    ``within`` and ``order`` together must tell rows apart. Each sorted range is summed alone and then raised by
    the total of the same group in earlier ranges, so a group may have any number of rows.
    """
    group = [quoted(c) for c in within]
    rows = df.withColumn("__weight", weight.cast("long"))
    ranged = sorted_ranges(rows, [*group, *map(quoted, order)], ranges)
    inside = Window.partitionBy("__part", *group).orderBy("__place")
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = ranged.withColumn("__here", F.sum("__weight").over(inside))

    totals = ranged.groupBy("__part", *group).agg(F.sum("__weight").alias("__sum"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select("__part", *group, F.sum("__sum").over(before).alias("__before"))
    # Only the first group of a range can reach back into earlier ranges, so there is one row per range at most.
    carried = carried.where(F.col("__before").isNotNull())
    out = join_ns(summed, F.broadcast(carried), ["__part", *within], "left")
    total = F.col("__here") + F.coalesce(F.col("__before"), F.lit(0))
    return out.withColumn(name, total).drop("__part", "__place", "__weight", "__here", "__before")


def dense_rank_per_subject(
    df: DataFrame, subject: str, order: Sequence[str], name: str = "scan_number", large: int = 1_000_000
) -> DataFrame:
    """Rank per subject by the order columns; equal rows of the order share a number. Null subjects get null.

    Rows are shuffled once, by subject, and ranked in a sorted pass over each. A subject with more than ``large`` rows
    would make a task of its own too long: its distinct (subject, order) rows are numbered by sorted ranges and joined
    back, in which a key of any size can be split. Rows without a subject are spread over all tasks. A column of that
    name is replaced. ``df`` is read twice, for the sizes and for the ranks: settle it first if it is costly.
    """
    df, steps = df.drop(name), [quoted(o) for o in order]
    known = keyed(df, [subject])
    crowded = known.groupBy(quoted(subject).alias(subject)).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > large).select(quoted(subject))
    if crowded.isEmpty():
        return _ranked_in_place(df, subject, steps, name)
    crowded = settle(crowded)
    distinct = join_ns(known, crowded, [subject], "semi").select(quoted(subject), *steps).distinct()
    ranks = running_total(distinct, order, F.lit(1), name, within=[subject])
    spread = join_ns(join_ns(df, crowded, [subject], "semi"), ranks.withColumn(name, F.col(name).cast("int")), [subject, *order], "left")
    return _ranked_in_place(join_ns(df, crowded, [subject], "anti"), subject, steps, name).unionByName(spread)


def _ranked_in_place(df: DataFrame, subject: str, steps: Sequence[Column], name: str) -> DataFrame:
    lone = F.when(quoted(subject).isNull(), F.xxhash64(*steps))
    rank = F.dense_rank().over(Window.partitionBy(quoted(subject), lone).orderBy(*ascending(*steps)))
    return df.withColumn(name, F.when(quoted(subject).isNotNull(), rank))


def sort_multi(df: DataFrame, *by: tuple[str, bool]) -> DataFrame:
    """Sort by (column, ascending) pairs, null last both ways.

    Rows equal in these come in the order of a hash of the row. So the result is repeatable, and a value that many
    rows share is cut into several ranges.
    """
    keys = [as_col(c).asc_nulls_last() if up else as_col(c).desc_nulls_last() for c, up in by]
    return df.orderBy(*keys, F.xxhash64(*map(quoted, df.columns)))


def five_number_summary(
    df: DataFrame, value: str, by: Sequence[str], approx: bool = False
) -> DataFrame:
    """Minimum, quartiles and maximum per group, quartiles interpolated; nulls and NaN take no part.

    Equal values are counted together first, then the counts are summed in order by ranges, and only the rows
    next to a quartile are kept; a group may have any size and any number of equal values. ``approx`` uses a
    sketch in place of that.
    """
    names, shares = ["min", "q1", "median", "q3", "max"], [0.0, 0.25, 0.5, 0.75, 1.0]
    rows = keyed(df, [*by, value]).select(*map(quoted, by), quoted(value).cast("double").alias("__x"))
    rows = rows.where(~F.isnan("__x"))
    if approx:
        sketch = rows.groupBy(*map(quoted, by)).agg(F.percentile_approx("__x", shares, 10_000).alias("__q"))
        return sketch.select(*map(quoted, by), *[F.get("__q", F.lit(i)).alias(n) for i, n in enumerate(names)])

    counts = rows.groupBy(*map(quoted, by), "__x").agg(F.count(F.lit(1)).alias("__n"))
    placed = running_total(counts, ["__x"], F.col("__n"), "__upto", within=by)
    # Written down, so that the join knows its size: the groups are few as a rule.
    sizes = settle(placed.groupBy(*map(quoted, by)).agg(F.max("__upto").alias("__rows")))
    placed = join_ns(placed, sizes, by)

    def at(position: Column) -> Column:
        covers = (F.col("__upto") > position) & (F.col("__upto") - F.col("__n") <= position)
        return F.max(F.when(covers, F.col("__x")))

    aggs = []
    for label, share in zip(names, shares):
        place = (F.col("__rows") - 1) * F.lit(share)
        aggs += [at(F.floor(place)).alias(f"__{label}_lo"), at(F.ceil(place)).alias(f"__{label}_hi")]
    found = placed.groupBy(*map(quoted, by), "__rows").agg(*aggs)

    def quantile(label: str, share: float) -> Column:
        place = (F.col("__rows") - 1) * F.lit(share)
        low, high = F.col(f"__{label}_lo"), F.col(f"__{label}_hi")
        return (low + (high - low) * (place - F.floor(place))).alias(label)

    return found.select(*map(quoted, by), *[quantile(n, s) for n, s in zip(names, shares)])


def seeded_hash(key: str, seed: int) -> Column:
    """Repeatable random order of a key: the same on any cluster and with any partitioning."""
    text = F.coalesce(quoted(key).cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(f"{seed}:"), text).cast("binary"))


def sample_n(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in seeded random order of the key. Other rows than a NumPy generator would pick."""
    return df.orderBy(seeded_hash(key, seed), quoted(key)).limit(n)


def split_exact(df: DataFrame, key: str, test_share: float, seed: int, name: str = "split") -> DataFrame:
    """Mark exactly ``ceil(test_share * rows)`` rows as test and the rest as train, by seeded order of the key.

    The key must be unique; a key that repeats at the cut cannot be cut exactly and is an error. Rows are counted per
    leading digits of the hash; only the bucket that the cut falls into is put in order, to find the hash at the cut.
    The table itself is neither sorted nor shuffled. Other rows than a NumPy generator would pick.
    """
    h = seeded_hash(key, seed)
    limit = _hash_at(df.select(h.alias("h")), test_share)
    return df.withColumn(name, F.when(F.coalesce(h <= limit, F.lit(False)), "test").otherwise("train"))


def _hash_at(hashes: DataFrame, share: float) -> Column:
    """The hash up to which exactly ``ceil(share * rows)`` hashes lie; null if that is none."""
    bucket = F.substring("h", 1, _BUCKET_DIGITS)
    # At most 65,536 rows, so one task may add them up.
    counts = settle(hashes.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")))
    sums = counts.withColumns(
        {"upto": F.sum("n").over(Window.orderBy("bucket")), "total": F.sum("n").over(Window.partitionBy())}
    )
    wanted = F.ceil(F.col("total") * F.lit(share))
    cut = sums.where((F.col("upto") >= wanted) & (F.col("upto") - F.col("n") < wanted))
    found = cut.select("bucket", (wanted - (F.col("upto") - F.col("n"))).cast("int").alias("rank")).first()
    if found is None:
        return F.lit(None).cast("string")
    # Hashes are counted first, so that a key that fills the bucket is one row of it.
    per_hash = hashes.where(bucket == found["bucket"]).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(F.substring("h", 1, _BUCKET_DIGITS)).orderBy("h"))
    at_cut = per_hash.withColumn("upto", upto).where(F.col("upto") >= found["rank"]).orderBy("h").first()
    if at_cut["upto"] != found["rank"]:
        raise ValueError("the key repeats where the table is cut, so it cannot be split exactly; use a unique key")
    return F.lit(at_cut["h"])


def batch_number(row_id: Column, n: int) -> Column:
    """Number of the batch of n rows, from 1."""
    return F.floor((row_id - 1) / n).cast("int") + 1


