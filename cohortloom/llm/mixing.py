"""Mixing sources to target weights by capped water-filling; Spark SQL only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortloom.functions.exprs import quoted
from cohortloom.llm.words import WORD, word_count
from cohortloom.operators.joins import join_ns
from cohortloom.operators.ordering import global_row_id
from cohortloom.session import settle

# Documents of a source are cut into this many buckets by a seeded hash of their id (four hexadecimal digits).
BUCKETS = 65_536
# Low bits of a bucket's number; the high ones name its block.
BLOCK_BITS = 8


def _whole(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def source_targets(sources: DataFrame, weights: Sequence[int], max_epochs: int) -> DataFrame:
    """Add ``target`` to ``source, source_size``.

    The sources in code point order, null last, weigh ``weights`` in turn and share the sum of all sizes. Each round
    clamps the sources whose share is above ``max_epochs`` times their size and shares the rest anew among the others
    by weight, until none is above. A round is one small aggregate; the driver holds its two sums only. Shares are
    exact fractions of whole numbers, so the same sources clamp on every run.
    """
    numbered = global_row_id(sources, ["source"], "row")
    place = F.pmod(F.col("row") - 1, F.lit(len(weights))).cast("int") + 1
    ranked = settle(
        numbered.select(
            "source",
            "source_size",
            F.element_at(F.array(*map(F.lit, weights)), place).cast("long").alias("weight"),
            (F.col("source_size") * max_epochs).alias("cap"),
        )
    )
    words, parts = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    all_words, words, parts = words or 0, words or 0, parts or 0
    while True:
        over = _whole(F.col("cap")) * _whole(F.lit(parts)) < _whole(F.lit(words)) * _whole(F.col("weight"))
        clamped, open_parts = ranked.agg(
            F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))
        ).first()
        if (all_words - clamped, open_parts) == (words, parts):
            break
        words, parts = all_words - clamped, open_parts
    share = (F.lit(words) * F.col("weight")).cast("double") / F.lit(float(max(parts, 1)))
    target = F.when(over, F.col("cap").cast("double")).otherwise(share)
    return ranked.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: int = 7,
    doc_id: str = "doc_id", source: str = "source", size: str = "size",
) -> DataFrame:
    """Add ``source_size``, ``target`` and ``taken`` to sized documents.

    ``taken``: the words of the document that the mix takes, repeats counted. Every document of a source is repeated
    as often as its target holds whole epochs. What is left of the target goes to the documents whose seeded hash is
    lowest: they are taken once more as a whole, and those of the one bucket at the cut by the fraction that is left,
    rounded for each. So a source comes within half a word per document of that bucket of its target, no document
    exceeds ``max_epochs`` times its size, and reruns agree. Documents with equal ids are treated alike. A null source
    is a source of its own, a null size counts as 0. The table may be empty. Columns of these names are replaced.

    Sizes are summed per source and bucket before they are shuffled, so a source may hold any share of the rows.
    """
    docs = docs.drop("source_size", "target", "taken")
    size_of = F.coalesce(quoted(size).cast("long"), F.lit(0))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(quoted(doc_id).cast("string"), F.lit(""))).cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int")
    sums = settle(
        docs.groupBy(quoted(source).alias("source"), bucket.alias("bucket")).agg(F.sum(size_of).alias("words"))
    )
    targets = source_targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    planned = settle(
        targets.withColumn("epochs", epochs.cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size"))
    )
    # Two levels of at most 256 sums per source: the block of buckets that the cut falls into, then the bucket.
    earlier = lambda order: Window.partitionBy("source").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    blocks = sums.groupBy("source", F.shiftright("bucket", BLOCK_BITS).alias("block")).agg(F.sum("words").alias("block_words"))
    blocks = blocks.withColumn("block_before", F.coalesce(F.sum("block_words").over(earlier("block")), F.lit(0)))
    held = (F.col("block_before") <= F.col("rest")) & (F.col("rest") < F.col("block_before") + F.col("block_words"))
    at_block = join_ns(blocks, planned.select("source", "rest"), ["source"]).where(held).drop("block_words")
    inside = join_ns(sums.withColumn("block", F.shiftright("bucket", BLOCK_BITS)), at_block, ["source", "block"])
    upto = inside.withColumn("before", F.col("block_before") + F.coalesce(F.sum("words").over(earlier("bucket")), F.lit(0)))
    at_cut = upto.where((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words")))
    cuts = at_cut.select("source", F.col("bucket").alias("cut"), ((F.col("rest") - F.col("before")) / F.col("words")).alias("part"))
    plan = settle(join_ns(planned, cuts, ["source"], "left"))

    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    joined = docs.withColumns({"__key": quoted(source), "__bucket": bucket, "__size": size_of}).join(
        plan, F.col("__key").eqNullSafe(F.col("__source"))
    )
    once_more = (
        F.when(F.col("__bucket") < F.col("__cut"), F.col("__size"))
        .when(F.col("__bucket") == F.col("__cut"), F.floor(F.col("__part") * F.col("__size") + 0.5))
        .otherwise(0)
    )
    out = joined.withColumns(
        {
            "source_size": F.col("__source_size"),
            "target": F.col("__target"),
            "taken": (F.col("__epochs") * F.col("__size") + once_more).cast("long"),
        }
    )
    return out.drop("__key", "__bucket", "__size", *plan.columns)


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``size``, the number of words of the text."""
    return docs.withColumn("size", word_count(quoted(text)))


def mixed_copies(mixed: DataFrame, text: str = "text", length: str | None = None) -> DataFrame:
    """Rows of the mix: a document once for each whole time its ``size`` goes into ``taken``, and once with its first
    words, joined by single spaces, for what is left. Documents of which nothing is taken are not in the mix.
    ``length``: a column with the number of signs of the text, brought up to date where the text is cut."""
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    left = (F.col("taken") - whole * F.col("size")).cast("int")
    none = F.array().cast("array<int>")
    parts = F.concat(F.array_repeat(F.lit(None).cast("int"), whole), F.when(left > 0, F.array(left)).otherwise(none))
    rows = mixed.withColumn("__part", F.explode(parts))
    words = F.regexp_extract_all(quoted(text), F.lit(WORD), F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), F.col("__part")), " ")
    rows = rows.withColumn(text, F.when(F.col("__part").isNull(), quoted(text)).otherwise(first))
    if length:
        rows = rows.withColumn(length, F.when(F.col("__part").isNull(), quoted(length)).otherwise(F.length(quoted(text))))
    return rows.drop("__part")
