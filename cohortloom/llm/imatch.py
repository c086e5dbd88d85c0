"""Document fingerprints by I-Match: hashes of a text's terms within randomised subsets of a lexicon."""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from cohortloom.functions.exprs import quoted
from cohortloom.llm.words import words

# A term is in the lexicon if it is in at least one of 1000 texts and at most one of 20: an IDF between 3 and 6.9.
# With d different terms in a text on average, there are at most 1000 d such terms, however many texts there are.
BAND = (1 / 1000, 1 / 20)
SUBSETS = 24
# Different terms a task counts before it hands its counts on.
_TASK_TERMS = 1_000_000


@dataclass
class Lexicon:
    """Terms with their place in each randomised order; a subset of level l holds the 2**-l lowest of an order."""

    place: dict[bytes, int]
    ranks: np.ndarray

    @staticmethod
    def of(terms: Sequence[bytes], seed: int = 1) -> Lexicon:
        ranks = [[xxhash.xxh32_intdigest(t, seed * 1000 + s) for s in range(SUBSETS)] for t in terms]
        return Lexicon({t: i for i, t in enumerate(terms)}, np.array(ranks, np.uint32).reshape(-1, SUBSETS))


@dataclass(frozen=True)
class Fingerprint:
    """Hashes of the terms kept by each subset at two neighbouring levels; empty where a subset keeps none.

    The level follows the number of lexicon terms in the text, so that a subset keeps less than one term on average
    and most of an edited text's subsets hold only terms that the edit left alone. Two levels let texts compare
    that stand on either side of a step. A text without lexicon terms has the hash of all its words instead.
    """

    level: int
    hashes: tuple[str, ...]

    def __str__(self) -> str:
        return f"{self.level}:" + ",".join(self.hashes)

    def likeness(self, other: Fingerprint) -> float:
        """Equal hashes among the subsets that keep a term of either text, over the levels both have; 0 to 1."""
        if self == other:
            return 1.0
        if self.level < 0 or other.level < 0:
            return 0.0
        equal = either = 0
        for level in {self.level, self.level + 1} & {other.level, other.level + 1}:
            a = self.hashes[(level - self.level) * SUBSETS:][:SUBSETS]
            b = other.hashes[(level - other.level) * SUBSETS:][:SUBSETS]
            equal += sum(x == y != "" for x, y in zip(a, b))
            either += sum((x or y) != "" for x, y in zip(a, b))
        return equal / either if either else 0.0


def fingerprint(lexicon: Lexicon, text: str | None) -> Fingerprint:
    found = words(text)
    terms = sorted(lexicon.place.keys() & set(found))
    if not terms:
        return Fingerprint(-1, (hashlib.sha1(b" ".join(found)).hexdigest(),))
    level = max(0, math.floor(math.log2(len(terms))) + 1)
    ranks = lexicon.ranks[[lexicon.place[t] for t in terms]]
    hashes = []
    for l in (level, level + 1):
        kept: list[list[bytes]] = [[] for _ in range(SUBSETS)]
        for term, subset in zip(*np.nonzero(ranks < np.uint64(1 << 32 >> l))):
            kept[subset].append(terms[term])
        hashes += [xxhash.xxh32_hexdigest(b" ".join(k)) if k else "" for k in kept]
    return Fingerprint(level, tuple(hashes))


def build_lexicon(docs: DataFrame, text: str = "text", band: tuple[float, float] = BAND) -> Lexicon:
    """The terms whose share of all texts lies in the band, counted over all texts.

    Tasks count the texts of each term they meet and Spark adds these up; only terms in the band reach the driver, at
    most (different terms of a text on average) / ``band[0]``.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def hand_on() -> Iterator[pa.RecordBatch]:
            terms, times = list(counts), list(counts.values())
            for a in range(0, len(terms), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(terms[a:a + 100_000], pa.binary()), pa.array(times[a:a + 100_000], pa.int64())], ["term", "texts"])
            counts.clear()

        for batch in batches:
            for text in batch.column(0):
                counts.update(set(words(text.as_py())))
                if len(counts) > _TASK_TERMS:
                    yield from hand_on()
        yield from hand_on()

    n = docs.count()
    low, high = max(1, math.ceil(band[0] * n)), max(1, math.floor(band[1] * n))
    texts = docs.select(quoted(text)).mapInArrow(count, "term binary, texts long").groupBy("term").agg(F.sum("texts").alias("texts"))
    return Lexicon.of(sorted(bytes(r["term"]) for r in texts.where(F.col("texts").between(low, high)).select("term").collect()))


def _cuts(docs: DataFrame, doc_id: str, parts: int) -> list[int]:
    """Ids that cut the table into about equal parts, rising; at most one per part."""
    shares = [i / parts for i in range(1, parts)]
    found = docs.agg(F.percentile_approx(quoted(doc_id), shares or [0.5], 10_000)).first()[0]
    return sorted(set(found or []))


def fingerprint_edits(docs: DataFrame, lexicon: Lexicon | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts, and of each text with its last third replaced by the start of the next text.

    Gives ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. The next text is
    that of the next lower id; ids fall, null last, equal ids in the order of the md5 of their texts; after the last comes the first.
    Null texts are empty texts. Repeated rows are each returned; a table of one row follows on itself; other columns
    are not used.

    Texts travel once, compressed, to parts that cover ranges of ids. Each part also gets the first text of the part
    after it, so no task needs another's rows. The driver knows one id per part.
    """
    spark = docs.sparkSession
    lexicon = lexicon or build_lexicon(docs, text)
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), F.coalesce(quoted(text), F.lit("")).alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = np.array(_cuts(docs, doc_id, parts), np.int64)

    @arrow_udf("int")
    def part_of(ids: pa.Array) -> pa.Array:
        # Falling ids: the highest are part 0, null ids stand in the last part.
        place = len(cuts) - np.searchsorted(cuts, pa.compute.fill_null(ids, 0).to_numpy(zero_copy_only=False), side="left")
        return pa.array(np.where(ids.is_null().to_numpy(zero_copy_only=False), len(cuts), place).astype(np.int32))

    @arrow_udf("binary")
    def shrink(texts: pa.Array) -> pa.Array:
        tool = zstandard.ZstdCompressor(level=3)
        return pa.array([tool.compress(t.as_py().encode()) for t in texts], pa.binary())

    firsts = rows.select("doc_id", part_of("doc_id").alias("part")).groupBy("part").agg(F.max("doc_id").alias("first"))
    firsts = sorted((r["part"], r["first"]) for r in firsts.collect())  # one row per part
    # The first text of each part is sent to the part before it as well, and that of the first part to the last.
    to = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    heads = spark.createDataFrame([(i, p) for i, p in to.items()] or [(None, None)], "first long, to int").where("to IS NOT NULL")
    placed = rows.withColumn("part", part_of("doc_id"))
    # Of rows with that id the first in the order of their texts' hashes.
    copies = rows.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("first"))).groupBy("to", "doc_id").agg(F.min_by("text", F.md5("text")).alias("text"))
    sent = placed.select("part", F.lit(0).alias("after"), "doc_id", shrink("text").alias("body"), F.md5("text").alias("tie")).union(
        copies.select(F.col("to").alias("part"), F.lit(1), "doc_id", shrink("text"), F.lit(""))
    )
    dealt = sent.repartition("part").sortWithinPartitions("part", "after", F.desc_nulls_last("doc_id"), "tie")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, last, out = zstandard.ZstdDecompressor(), None, []
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        for batch in batches:
            for part, body, id_ in zip(batch.column("part").to_pylist(), batch.column("body"), batch.column("doc_id").to_pylist()):
                text = tool.decompress(body.as_py()).decode()
                mark = fingerprint(lexicon, text)
                if last and last[0] == part:
                    _, before_id, before, before_mark = last
                    third = len(before) // 3
                    edited = before[: len(before) - third] + text[:third]
                    edited_mark = fingerprint(lexicon, edited)
                    out.append((
                        before_id, len(before), hashlib.sha256(edited.encode()).hexdigest(), str(before_mark), str(edited_mark),
                        before_mark.likeness(edited_mark), before_mark.likeness(mark),
                    ))
                last = (part, id_, text, mark)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
            out = []

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return dealt.mapInArrow(compare, schema)
