"""Joins. Null keys match null keys, as in the linked tables this library curates.

Spark runs ``<=>`` as an equi join on derived keys, so both sides get their own shuffle even when one of them
was just grouped on the same key. That shuffle is small for a grouped side, and it lets the adaptive skew join
split a key that holds a large part of the other side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.exprs import quoted
from cohortloom.operators.ranges import sorted_ranges
from cohortloom.session import settle

_RIGHT = "__right_"


def shared_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns of ``a`` that ``b`` has too."""
    return [c for c in a.columns if c in b.columns]


def _same(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda x, y: x & y, [quoted(l).eqNullSafe(quoted(r)) for l, r in pairs])


def join_ns(
    a: DataFrame,
    b: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    suffixes: tuple[str, str] = ("_x", "_y"),
) -> DataFrame:
    """Join on equally named keys, null equal to null; each key comes out once.

    Other columns in both tables get the suffixes. ``how``: inner, left, right, semi, anti.
    """
    right = b.withColumnsRenamed({k: _RIGHT + k for k in keys})
    right_keys = [_RIGHT + k for k in keys]
    condition = _same(list(zip(keys, right_keys)))
    if how in ("semi", "anti"):
        return a.join(right.select(*map(quoted, right_keys)), condition, f"left_{how}")
    if how not in ("inner", "left", "right"):
        raise ValueError(f"how must be inner, left, right, semi or anti, not {how!r}")
    twice = [c for c in shared_columns(a, b) if c not in keys]
    if twice:
        a = a.withColumnsRenamed({c: c + suffixes[0] for c in twice})
        right = right.withColumnsRenamed({c: c + suffixes[1] for c in twice})
    joined = a.join(right, condition, how)
    if how == "right":
        joined = joined.withColumns({k: quoted(r) for k, r in zip(keys, right_keys)})
    return joined.drop(*right_keys)


def distinct_keys(listed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The different keys of a list, for semi and anti joins: only the left side of these can be split, so a key (or a
    null) that holds a large part of the list is reduced before the shuffle, not in the one task that gets it."""
    return listed.select(*map(quoted, keys)).distinct()


def join_on(a: DataFrame, b: DataFrame, pairs: Sequence[tuple[str, str]], how: str = "inner") -> DataFrame:
    """Join on keys with different names, null equal to null; both keys stay. The tables share no column."""
    if how in ("semi", "anti"):
        return a.join(distinct_keys(b, [r for _, r in pairs]), _same(pairs), f"left_{how}")
    return a.join(b, _same(pairs), how)


def natural_join(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on all columns the tables share."""
    return join_ns(a, b, shared_columns(a, b), how)


def join_distinct(a: DataFrame, dim: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Inner join to the distinct (keys, cols) of ``dim``, so that rows of ``a`` do not fan out."""
    return join_ns(a, dim.select(*keys, *cols).distinct(), keys)


def not_in(a: DataFrame, column: str, listed: DataFrame, listed_column: str) -> DataFrame:
    """Rows whose value is not in the list. A null in the list removes null values only, never everything. The list may
    repeat a value, or null, any number of times."""
    return join_ns(a, distinct_keys(listed, [listed_column]).withColumnRenamed(listed_column, column), [column], "anti")


def outer_with_origin(a: DataFrame, b: DataFrame, keys: Sequence[str], origin: str = "_merge") -> DataFrame:
    """Full outer join that says where each row came from: left_only, right_only or both.

    Built as inner join plus two anti joins on the other table's different keys: a full outer join cannot split an
    oversized key, these three can, and the shuffles of both tables are reused.
    """
    both = join_ns(a, b, keys).withColumn(origin, F.lit("both"))
    left = join_ns(a, distinct_keys(b, keys), keys, "anti").withColumn(origin, F.lit("left_only"))
    right = join_ns(b, distinct_keys(a, keys), keys, "anti").withColumn(origin, F.lit("right_only"))
    out = both.unionByName(left, allowMissingColumns=True).unionByName(right, allowMissingColumns=True)
    return out


def waterfall(a: DataFrame, b: DataFrame, keys: Sequence[tuple[str, str]]) -> DataFrame:
    """Match ``a`` to ``b`` by the first (a key, b key) that finds anything.

    A null key matches nothing and leaves the row to its next key. Result rows are distinct. Rows of ``a`` that no
    key matches come out once, with null columns of ``b``.

    Both tables are read once and written down. Which key is the first that finds something is settled on row numbers
    and keys; then each row is joined by that key alone.
    """
    rows = settle(a.distinct().withColumn("__row", F.monotonically_increasing_id()))
    listed = settle(b.distinct())
    tried = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(r).alias("by"), quoted(l).cast("string").alias("key")) for i, (l, r) in enumerate(keys)])
    offered = F.array(*[F.struct(F.lit(r).alias("by"), quoted(r).cast("string").alias("key")) for r in dict.fromkeys(r for _, r in keys)])
    wanted = rows.select("__row", F.explode(tried).alias("try")).select("__row", "try.*").where(F.col("key").isNotNull())
    known = listed.select(F.explode(offered).alias("offer")).select("offer.*").where(F.col("key").isNotNull()).distinct()
    first = wanted.join(known, ["by", "key"]).groupBy("__row").agg(F.min(F.struct("i", "by", "key")).alias("__hit"))
    placed = rows.join(first, "__row", "left").withColumns({"__by": F.col("__hit.by"), "__key": F.col("__hit.key")})
    offers = listed.withColumn("__offer", F.explode(offered))
    same = (F.col("__by") == F.col("__offer.by")) & (F.col("__key") == F.col("__offer.key"))
    return placed.join(offers, same, "left").drop("__row", "__hit", "__by", "__key", "__offer")


def prefix_semi(a: DataFrame, path: str, prefixes: DataFrame, prefix: str, any_case: bool = True, ranges: int | None = None) -> DataFrame:
    """Rows whose path starts with one of the listed prefixes, taken literally.

    A prefix opens an interval of paths: from itself to itself and the byte 255, which no text holds. Prefixes and
    different paths are sorted together into ranges and swept in order; a path is in an open interval if the furthest
    end so far, of its range or any before it, is not behind it. So one pass over the sorted names is all, however many
    lengths the prefixes have, and a prefix of one sign costs what any other does. A path that extends a listed one is
    kept, and signs with a meaning in regular expressions have none here.
    """
    fold = F.lower if any_case else (lambda c: c)
    opened = prefixes.select(fold(quoted(prefix)).cast("binary").alias("__at")).where(F.col("__at").isNotNull()).distinct()
    opened = opened.select("__at", F.lit(0).alias("__kind"), F.concat("__at", F.lit(b"\xff")).alias("__end"), F.lit(None).cast("string").alias("__path"))
    paths = a.select(quoted(path).alias("__path")).where(F.col("__path").isNotNull()).distinct()
    paths = paths.select(fold(F.col("__path")).cast("binary").alias("__at"), F.lit(1).alias("__kind"), F.lit(None).cast("binary").alias("__end"), "__path")
    ranged = sorted_ranges(opened.unionByName(paths), [F.col("__at"), F.col("__kind"), F.col("__path")], ranges)
    inside = Window.partitionBy("__part").orderBy("__place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = ranged.withColumn("__open", F.max("__end").over(inside))
    # One row per range: the furthest end in any range before it.
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ranged.groupBy("__part").agg(F.max("__end").alias("__last")).select("__part", F.max("__last").over(before).alias("__carried"))
    held = swept.where("__kind = 1").join(F.broadcast(carried), "__part").where(F.col("__at") <= F.greatest("__open", "__carried"))
    return join_ns(a, held.select(F.col("__path").alias(path)), [path], "semi")


def anti_path_list(a: DataFrame, path: str, listed: DataFrame, listed_path: str) -> DataFrame:
    """Drop rows with a listed path. An empty list drops nothing."""
    return not_in(a, path, listed, listed_path)
