"""A Merkle tree over the rows of a dataset: coordinates from bitmap ranks, levels from keyed arrays of slots.

Rows are leaves, in ascending order of their id within their group. Nothing is sorted to number them: each group has a
bitmap of its ids, kept as the words of 64 bits that are not empty, and a directory of popcounts above it, 512 to one
at each level. The number of a leaf is the rank of its bit: what the directory counts in earlier words, plus the bits
below it in its own word. Rows of one id, which share a bit, are numbered among themselves by sorted ranges.

A leaf's number is the key of its place in every level: node ``number >> 4``, slot ``number & 15``. Nodes of a level are
gathered into their parent's array of 16 slots, hashed, written down and used as the nodes of the next level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.exprs import quoted
from cohortloom.operators.ordering import global_row_id, running_total
from cohortloom.session import settle

# Fixed values of the tree: children of a node as a power of two.
FAN_BITS = 4
# Bits of an id within a bitmap word, and words or counts below one count of the next level of the directory.
WORD_BITS, DIRECTORY_BITS = 6, 9


def field(value: Column) -> Column:
    """A value as it goes into a leaf: ``-`` for null, else its bytes in UTF-8, ``:`` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that follows from a leaf and its proof."""
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(F.concat(step["left"], node, step["right"]), 256))


def proof_digest(proof: Column) -> Column:
    """sha256 of all siblings of a proof, from the leaf up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def _same(a: DataFrame, b: DataFrame, *names: str) -> Column:
    condition = a["g"].eqNullSafe(b["to_g"])
    for name in names:
        condition = condition & (a[name] == b[f"to_{name}"])
    return condition


def _renamed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumnsRenamed({n: f"to_{n}" for n in names})


def _words(rows: DataFrame) -> DataFrame:
    """The bitmap: ``g, word, bits, n`` and, where rows share an id, ``extra``: (bit, rows beyond the first).

    ``extra`` has one entry per bit at most.
    """
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    words = settle(rows.groupBy("g", "word").agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n")))
    crowded = words.where(F.col("n") > F.bit_count("bits")).select("g", "word")
    if crowded.isEmpty():
        return words.withColumn("extra", F.array().cast("array<struct<bit: int, more: bigint>>"))
    # Rows are counted per id only in words that have fewer ids than rows.
    to = _renamed(crowded, "g", "word")
    counts = rows.select("g", "word", "bit").join(to, _same(rows, to, "word"), "left_semi").groupBy("g", "word", "bit").agg((F.count(F.lit(1)) - 1).alias("more"))
    extra = counts.where("more > 0").groupBy("g", "word").agg(F.sort_array(F.collect_list(F.struct("bit", "more"))).alias("extra"))
    to = _renamed(extra, "g", "word")
    joined = words.join(to, _same(words, to, "word"), "left").drop("to_g", "to_word")
    return settle(joined.withColumn("extra", F.coalesce("extra", F.array().cast("array<struct<bit: int, more: bigint>>"))))


def _directory(words: DataFrame, span: int) -> tuple[DataFrame, DataFrame]:
    """Rows before each word of its group, as ``to_g, to_word, bits, extra, before``; and ``g, n``: rows per group.

    ``span``: the largest word. Each level of the directory holds the sums of up to 512 counts of the level below, so
    the running sum within one of them is over 512 rows at most.
    """
    levels = [words.select("g", F.col("word").alias("k"), "n")]
    while True:
        up = settle(levels[-1].groupBy("g", F.shiftright("k", DIRECTORY_BITS).alias("k")).agg(F.sum("n").alias("n")))
        levels.append(up)
        span >>= DIRECTORY_BITS
        if not span:
            break
    base = levels[-1].select("g", "k", F.lit(0).cast("long").alias("before"))
    for level in reversed(levels[:-1]):
        inside = Window.partitionBy("g", F.shiftright("k", DIRECTORY_BITS)).orderBy("k").rowsBetween(Window.unboundedPreceding, -1)
        counted = level.withColumn("inside", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        to = _renamed(base, "g", "k", "before")
        held = counted["g"].eqNullSafe(to["to_g"]) & (F.shiftright(counted["k"], DIRECTORY_BITS) == to["to_k"])
        base = settle(counted.join(to, held).select("g", "k", (F.col("inside") + F.col("to_before")).alias("before")))
    to = base.select(F.col("g").alias("to_g"), F.col("k").alias("to_word"), "before")
    placed = words.join(to, _same(words, to, "word")).select("to_g", "to_word", "bits", "extra", "before")
    return placed, levels[-1].select("g", "n")


def ranked(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (``g, id, leaf, row`` and more, written down) with ``k``, the number of each in its group from 0 in
    ascending order of the id, null first; and ``g, n``. Rows with one id go by their leaf, then by ``row``."""
    low, high = leaves.agg(F.min("id"), F.max("id")).first()
    first = (low or 0) >> WORD_BITS
    # Word 0 is for rows without an id.
    word = F.coalesce(F.shiftright("id", WORD_BITS) - F.lit(first - 1), F.lit(0).cast("long"))
    bit = F.coalesce(F.col("id").bitwiseAND((1 << WORD_BITS) - 1), F.lit(0)).cast("int")
    rows = leaves.withColumns({"word": word, "bit": bit})
    words = _words(rows)
    directory, sizes = _directory(words, ((high or 0) >> WORD_BITS) - first + 1)
    below = F.col("bits").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), F.col("bit"))))
    doubles = F.aggregate(F.filter("extra", lambda x: x["bit"] < F.col("bit")), F.lit(0).cast("long"), lambda sum_, x: sum_ + x["more"])
    found = rows.join(directory, _same(rows, directory, "word"))
    shared = F.exists("extra", lambda x: x["bit"] == F.col("bit"))
    placed = found.select(*rows.columns, (F.col("before") + F.bit_count(below) + doubles).alias("k"), shared.alias("shared"))
    if words.where(F.size("extra") > 0).isEmpty():
        return placed.drop("word", "bit", "shared"), sizes
    placed = settle(placed)
    copies = running_total(placed.where("shared"), ["leaf", "row"], F.lit(1), "nth", within=["g", "word", "bit"])
    copies = copies.withColumn("k", F.col("k") + F.col("nth") - 1).drop("nth")
    return placed.where("NOT shared").unionByName(copies).drop("word", "bit", "shared"), sizes


def _levels(nodes: DataFrame, sizes: DataFrame, carried: Sequence[str]) -> list[DataFrame]:
    """Levels from the bottom: ``g, k, items, m, node``. ``items``: the slots in order, with the carried columns at the
    lowest level; ``m``: nodes of the group that go into this level. A lone node stays as it is."""
    most = sizes.agg(F.max("n")).first()[0] or 1
    to = _renamed(sizes, "g")
    nodes = nodes.join(to, nodes["g"].eqNullSafe(to["to_g"])).withColumnRenamed("n", "m").drop("to_g")
    levels = []
    while True:
        slot = F.col("k").bitwiseAND((1 << FAN_BITS) - 1).cast("int").alias("slot")
        items = F.sort_array(F.collect_list(F.struct(slot, "node", *carried)))
        met = nodes.groupBy("g", F.shiftright("k", FAN_BITS).alias("k")).agg(items.alias("items"), F.max("m").alias("m"))
        own = F.when(F.col("m") > 1, F.sha2(F.array_join("items.node", ""), 256)).otherwise(F.get("items.node", F.lit(0)))
        levels.append(settle(met.withColumn("node", own)))
        most, carried = (most + (1 << FAN_BITS) - 1) >> FAN_BITS, ()
        if most == 1:
            return levels
        nodes = levels[-1].select("g", "k", "node", F.shiftright(F.col("m") + ((1 << FAN_BITS) - 1), FAN_BITS).alias("m"))


def _step(items: Column, slot: Column, m: Column, above: Column) -> Column:
    """The steps above a slot: its siblings left and right, then ``above``."""
    nodes = items["node"]
    left = F.array_join(F.slice(nodes, F.lit(1), slot), "")
    right = F.array_join(F.slice(nodes, slot + 2, F.lit(1 << FAN_BITS)), "")
    return F.when(m > 1, F.concat(F.array(F.struct(left.alias("left"), right.alias("right"))), above)).otherwise(above)


def _paths(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The items of the lowest level, one a row, with their steps to the root. ``tops``: ``to_g, above`` and more, for
    each group."""
    for depth, level in enumerate(reversed(levels)):
        if depth:
            met = level["g"].eqNullSafe(tops["to_g"]) & (F.shiftright(level["k"], FAN_BITS) == tops["to_k"])
            slot = level["k"].bitwiseAND((1 << FAN_BITS) - 1).cast("int")
            above = _step(tops["to_items"], slot, tops["to_m"], tops["above"])
        else:
            met, above = level["g"].eqNullSafe(tops["to_g"]), tops["above"]
        more = [c for c in tops.columns if c not in ("to_g", "to_k", "to_items", "to_m", "above")]
        joined = level.join(tops, met).select(
            level["g"].alias("to_g"), level["k"].alias("to_k"), level["items"].alias("to_items"), level["m"].alias("to_m"), above.alias("above"), *more
        )
        tops = joined
    each = tops.select(F.col("to_g").alias("g"), F.explode("to_items").alias("item"), "to_items", "to_m", "above", *more)
    return each.withColumn("proof", _step(F.col("to_items"), F.col("item.slot"), F.col("to_m"), F.col("above"))).drop("to_items", "to_m", "above")


def merkle_proofs(leaves: DataFrame, group: str, key: str, leaf: str = "leaf") -> DataFrame:
    """Every row of ``leaves`` with ``subroot`` (of its group), ``root`` (of all) and ``proof``; columns of these names
    are replaced, all others kept.

    Leaves of a group ascend by ``key``, a whole number, null first; rows with one key go by their leaf, and equal rows
    each have a place. While a group has several nodes, every 16 in a row become the sha256 of their joined digests in
    lower-case hex (the last of them fewer). The subroots, by group as text in UTF-8 order, null first, give the root in
    the same way. ``proof`` is an array from the leaf up of the siblings' digests, joined, to the ``left`` and ``right``
    of the node; ``fold`` gives the root back. An empty table gives no rows; null leaves are an error.

    All levels are written to the shared folder, so jobs run when this is called.
    """
    own = F.struct(*[quoted(c) for c in leaves.columns if c not in ("subroot", "root", "proof")])
    node = F.coalesce(quoted(leaf), F.raise_error(F.lit("a leaf without a digest"))).alias("leaf")
    rows = leaves.select(quoted(group).cast("string").alias("g"), quoted(key).cast("long").alias("id"), node, own.alias("own"))
    rows = settle(rows.withColumn("row", F.monotonically_increasing_id()))
    placed, sizes = ranked(rows)
    levels = _levels(placed.select("g", "k", F.col("leaf").alias("node"), "own"), sizes, ["own"])

    # The groups are the leaves of the upper tree: numbered in the order of their names, by sorted ranges.
    subroots = levels[-1].select("g", F.col("node").alias("subroot"), F.col("g").isNotNull().alias("named"))
    numbered = settle(global_row_id(subroots, ["named", "g"], "k"))
    upper = numbered.select(F.lit(0).alias("g"), (F.col("k") - 1).alias("k"), F.col("subroot").alias("node"), F.struct(F.col("g"), "subroot").alias("group"))
    upper_levels = _levels(upper, upper.groupBy("g").agg(F.count(F.lit(1)).alias("n")), ["group"])
    nothing = F.array().cast("array<struct<left: string, right: string>>")
    top = upper_levels[-1].select(F.col("g").alias("to_g"), F.col("node").alias("root"), nothing.alias("above"))
    groups = _paths(upper_levels, top).select(F.col("item.group.g").alias("to_g"), "item.group.subroot", "root", F.col("proof").alias("above"))
    found = _paths(levels, settle(groups))
    return found.select("item.own.*", "subroot", "root", "proof")


def with_tampered(leaves: DataFrame, proof: str = "proof", tampered: str = "tampered", leaf: str = "leaf") -> DataFrame:
    """Add ``folded_root``, from the tampered leaf where there is one, and ``verified``, whether it is the root."""
    folded = fold(F.coalesce(quoted(tampered), quoted(leaf)), quoted(proof))
    return leaves.withColumn("folded_root", folded).withColumn("verified", F.col("folded_root") == F.col("root"))
