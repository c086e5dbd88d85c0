"""Token ids as Parquet list columns, in document order, readable in parts."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cohortloom.functions.exprs import quoted
from cohortloom.llm.byte_bpe import encode_texts

COLUMNS = "doc_id long, part int, place long, n_tokens long, ids array<int>"

# Parquet settings of the file format. Ids are written with a dictionary (a 50,257-word vocabulary packs into 16 bits
# or less), the ascending numbers beside them with delta encoding, which the second page version brings. Small pages
# and their indexes let a reader fetch the ids of a few documents; row groups hold tens of thousands of documents'
# numbers but stay below an executor's memory.
FORMAT = {
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "false",
    "parquet.enable.dictionary#ids.list.element": "true",
    "compression": "zstd",
}


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end: int | None = 0, ranges: int | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Write ``doc_id, part, place, n_tokens, ids`` with the documents in ascending order of their id, null first.

    ``part`` numbers the files in order and ``place`` the documents in a file, so a document's first token has a
    position that follows from the counts alone. Null texts are empty texts and get the end id only. Rows with the
    same id stand in the order of the first 64 signs of their text, then of its hash; all are kept.
    """
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    # Keys of bounded size: Spark finds the ranges from a sample of the keys, which must not hold whole texts.
    order = ["doc_id", F.substring("text", 1, 64), F.xxhash64("text")]
    cut = rows.repartitionByRange(ranges, *order) if ranges else rows.repartitionByRange(*order)
    sorted_rows = cut.sortWithinPartitions(*order).withColumn("id", F.monotonically_increasing_id())
    placed = sorted_rows.select(
        "doc_id", F.shiftright("id", 33).cast("int").alias("part"), F.col("id").bitwiseAND((1 << 33) - 1).alias("place"), "text"
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A few documents at a time, as their ids take more room than their texts."""
        for batch in batches:
            at = 0
            for ids in encode_texts(vocabulary, batch.column("text"), end):
                beside = [batch.column(c).slice(at, len(ids)) for c in ("doc_id", "part", "place")]
                counts = pa.compute.list_value_length(ids).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([*beside, counts, ids], ["doc_id", "part", "place", "n_tokens", "ids"])
                at += len(ids)

    placed.mapInArrow(encode, COLUMNS).write.options(**FORMAT).parquet(folder)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of the files; columns and row groups that are not asked for are not read."""
    return spark.read.schema(COLUMNS).parquet(folder)


def token_starts(files: DataFrame) -> DataFrame:
    """``part, place, start``: tokens of all documents before this one. Reads the numbers, not the ids.

    Each file is added up by itself and raised by the total of the files before it; the totals are one row per file.
    """
    numbers = files.select("part", "place", "n_tokens")
    totals = numbers.groupBy("part").agg(F.sum("n_tokens").alias("tokens"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    local = numbers.withColumn("local", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return local.join(bases, "part").select("part", "place", (F.col("base") + F.col("local")).alias("start"))
