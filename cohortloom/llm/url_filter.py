"""URL block and allow rules by a sorted sweep; Spark SQL only.

A host is read from the right: ``www.example.net`` has the key ``net.example.www.``, so that a host and all its
subdomains are one interval of keys. Rules and URLs are sorted together by key. The sweep carries the stack of rules
open at the last rule it passed; those of them whose interval has ended before the URL are taken off. Intervals of
prefixes are nested or apart, so no other rule can be open at the URL.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.exprs import quoted
from cohortloom.session import settle


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` in lower case (A-Z), and the path after it; both empty for null or no ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: Column) -> Column:
    """Labels from right to left, each followed by a dot."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _sweep(points: DataFrame, starts: DataFrame) -> DataFrame:
    """Points (``__key`` and any columns) with ``__open``: the ``__stack`` of the last start at or before the key.

    Points and starts are cut into sorted ranges, written down, and swept range by range; each range begins with what
    the ranges before it left open, one row per range. A hash of the row breaks ties, so a key that many rows share is
    cut into several ranges. Adds ``__row``, a number for each point that stays the same from then on.
    """
    salt = F.xxhash64(*map(quoted, points.columns))
    rows = points.withColumns({"__point": F.lit(1), "__salt": salt})
    events = rows.unionByName(starts.select("__key", "__stack", F.lit(0).alias("__point")), allowMissingColumns=True)
    cut = events.repartitionByRange("__key", "__point", "__salt")
    placed = cut.withColumns({"__part": F.spark_partition_id(), "__row": F.monotonically_increasing_id()})
    ranged = settle(placed.drop("__salt"))
    last = ranged.groupBy("__part").agg(F.max_by("__stack", F.when(F.col("__point") == 0, F.col("__key"))).alias("__last"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select("__part", F.last("__last", ignorenulls=True).over(before).alias("__carried"))
    inside = Window.partitionBy("__part").orderBy("__key", "__point").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumn("__here", F.last("__stack", ignorenulls=True).over(inside)).where("__point = 1")
    out = swept.join(F.broadcast(carried), "__part").withColumn("__open", F.coalesce("__here", "__carried"))
    return out.drop("__part", "__stack", "__point", "__here", "__carried")


def _host_stacks(rules: DataFrame) -> DataFrame:
    """Each rule host's key with the keys of all rule hosts that hold it, itself included."""
    hosts = rules.select(F.col("host_key").alias("key")).distinct()
    labels = F.split(F.expr("substring(key, 1, length(key) - 1)"), r"\.")
    outer = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda n: F.concat(F.array_join(F.slice(labels, F.lit(1), n), "."), F.lit(".")))
    pairs = hosts.select("key", F.explode(outer).alias("outer"))
    held = pairs.join(hosts.select(F.col("key").alias("outer")), "outer")
    return held.groupBy(F.col("key").alias("__key")).agg(F.collect_list("outer").alias("__stack"))


def _path_stacks(rules: DataFrame) -> DataFrame:
    """Each rule's whole key with the rules of the same host whose path begins its path, itself included."""
    named = rules.withColumn("key", F.concat("host_key", "path"))
    entry = F.struct(F.length("rule").alias("length"), F.length("host").alias("host_length"), "verdict", "rule", "key")
    same = named.groupBy("key").agg(F.max(entry).alias("entry"), F.first("host_key").alias("host_key"))
    lengths = same.groupBy("host_key").agg(F.collect_set(F.length("key")).alias("lengths"))
    cuts = same.join(lengths, "host_key").select("key", F.explode("lengths").alias("n")).where(F.length("key") >= F.col("n"))
    cuts = cuts.select(F.col("key").alias("__key"), F.expr("substring(key, 1, n)").alias("key"))
    found = cuts.join(same.select("key", "entry"), "key")
    return found.groupBy("__key").agg(F.collect_list("entry").alias("__stack"))


def judge_urls(df: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to each row; columns of these names are replaced.

    ``rules``: ``host, path, verdict`` (block or allow). A rule fits its host and all subdomains if the URL's path
    starts with the rule's; the longest rule string wins, of equally long ones that with the longer host, of equal
    rules block. Rules with a null are ignored; a path is empty or starts with ``/``. Without a fitting rule ``rule``
    is null and the verdict is ``default``. Null URLs and URLs without ``://`` have an empty host and path. Repeated
    rows are judged each; the tables may be empty.

    One sweep over host keys finds the rule hosts that hold a URL's host. Only URLs with such a host go through the
    second sweep, over the rule host followed by the path. A stack holds nested rules only, so at most one per label
    of the host or per length of path.
    """
    host, path = host_and_path(quoted(url))
    known = rules.select("host", "path", "verdict").dropna().withColumn("rule", F.concat("host", "path"))
    known = settle(known.withColumn("host_key", host_key(F.col("host"))))

    rows = df.drop("rule", "verdict").withColumns({"host": host, "path": path})
    rows = rows.withColumn("__key", host_key(F.col("host")))
    judged = settle(_sweep(rows, _host_stacks(known)))
    holds = F.filter(F.col("__open"), lambda h: F.startswith(F.col("__key"), h))
    under = judged.select(F.col("__row").alias("__url"), "path", F.explode(holds).alias("__host"))
    points = under.select("__url", F.concat("__host", "path").alias("__key"))
    fits = F.filter(F.col("__open"), lambda r: F.startswith(F.col("__key"), r["key"]))
    best = _sweep(points, _path_stacks(known)).select("__url", F.array_max(fits).alias("best"))
    best = best.where("best is not null").groupBy(F.col("__url").alias("__row")).agg(F.max("best").alias("__best"))
    out = judged.join(best, "__row", "left").withColumns(
        {"rule": F.col("__best.rule"), "verdict": F.coalesce("__best.verdict", F.lit(default))}
    )
    return out.drop("__row", "__key", "__open", "__best")
