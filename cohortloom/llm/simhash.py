"""Near copies by SimHash: fingerprints that differ in few bits are linked."""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from cohortloom.functions.exprs import quoted
from cohortloom.llm.blocks import blocked_groups, each_group, star_edges
from cohortloom.llm.components import component_roots
from cohortloom.llm.words import words
from cohortloom.operators.joins import join_ns
from cohortloom.session import settle

HASH_SEED = 42
# Reference fingerprints: seeded, the same on every machine.
PIVOTS = np.random.default_rng(20).integers(0, 2**64, 64, dtype=np.uint64)


def fingerprint_of(text: str | None, shingle: int) -> int:
    """64 bits; a bit is set if it is set in over half of the hashes of the word shingles, repeats included.

    A text with fewer words has one shingle, all its words; a text without words has fingerprint zero.
    """
    found = words(text)
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    if len(found) <= shingle:
        return xxhash.xxh64_intdigest(joined, HASH_SEED)
    stops = ends[shingle - 1:].tolist()
    starts = [0, *(ends[: len(found) - shingle] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops)], np.uint64)
    counts = np.zeros(64, np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) >> 15)):  # bounds the memory of one very long text
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def simhash(text: Column, shingle: int = 3) -> Column:
    """Fingerprint of a whole text as a signed long."""

    @arrow_udf("bigint")
    def fingerprints(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in arrays:
            out = [fingerprint_of(t.as_py(), shingle) for t in texts]
            yield pa.array(np.array(out, np.uint64).view(np.int64))

    return fingerprints(text)


def _masks(max_bits: int) -> list[int]:
    """Masks such that any two fingerprints at most ``max_bits`` apart agree under one of them: the bits are cut into
    twice as many blocks, and each mask keeps half of the blocks."""
    blocks = np.array_split(np.arange(64), 2 * max_bits) if max_bits else [np.arange(64)]
    bits = [sum(1 << int(b) for b in block) for block in blocks]
    return [sum(chosen) for chosen in itertools.combinations(bits, max(1, len(bits) - max_bits))]


def pivot_distances(fp: np.ndarray) -> np.ndarray:
    """Differing bits to each reference fingerprint, one row per fingerprint."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS).astype(np.int8)


def with_distances(prints: DataFrame) -> DataFrame:
    """The pivot distance table: ``prints`` with ``far``, the distances of ``fp`` to all references, a byte each."""

    @arrow_udf("binary")
    def far(fp: pa.Array) -> pa.Array:
        table = pivot_distances(fp.to_numpy(zero_copy_only=False).view(np.uint64))
        return pa.array([row.tobytes() for row in table], pa.binary())

    return prints.withColumn("far", far("fp"))


def near_pairs(
    a: np.ndarray, b: np.ndarray, far_a: np.ndarray, far_b: np.ndarray, same: bool, max_bits: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Places of pairs at most ``max_bits`` apart, and how many pairs were compared bit by bit. ``same``: a and b are one
    list, each pair is given once.

    Two fingerprints cannot be nearer than the largest difference of their distances to any reference. Both lists are
    put in order of the distance to the first, so that only pairs near in it are formed; these are ruled out by the
    other references, and what is left is compared.
    """
    order_a, order_b = np.argsort(far_a[:, 0], kind="stable"), np.argsort(far_b[:, 0], kind="stable")
    first_a, first_b = far_a[order_a, 0].astype(np.int64), far_b[order_b, 0].astype(np.int64)
    low = np.arange(len(a)) + 1 if same else np.searchsorted(first_b, first_a - max_bits)
    high = np.searchsorted(first_b, first_a + max_bits, side="right")
    found, compared = [(np.empty(0, np.int64), np.empty(0, np.int64))], 0
    upto = np.cumsum(high - low)
    for start, end in _slices(upto):
        reach = (high - low)[start:end]
        i = np.repeat(np.arange(start, end), reach)
        j = np.arange(reach.sum()) - np.repeat(np.cumsum(reach) - reach, reach) + np.repeat(low[start:end], reach)
        i, j = order_a[i], order_b[j]
        for k in range(1, len(PIVOTS), 8):
            keep = np.abs(far_a[i, k:k + 8] - far_b[j, k:k + 8]).max(axis=1, initial=0) <= max_bits
            i, j = i[keep], j[keep]
        compared += len(i)
        keep = np.bitwise_count(a[i] ^ b[j]) <= max_bits
        found.append((i[keep], j[keep]))
    i, j = (np.concatenate(x) for x in zip(*found))
    return (np.minimum(i, j), np.maximum(i, j), compared) if same else (i, j, compared)


def _slices(upto: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Rows in a row that form about ``most`` pairs together."""
    start = 0
    while start < len(upto):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + most, side="right")))
        yield start, end
        start = end


def fingerprint_links(prints: DataFrame, max_bits: int, block: int = 1024) -> DataFrame:
    """``a, b``: links between different fingerprints (columns ``fp, far``), enough of them to join all that are linked.

    Fingerprints meet under masks; where they meet, the distance table rules pairs out. Each block of a group gives the
    links that connect it, not all its pairs, so the result grows with the rows. A group of n fingerprints that agree
    under one mask is written out ceil(n / block) times, so the work on it grows with its square.
    """
    masks = _masks(max_bits)
    keys = F.array(*[F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("under")) for i, m in enumerate(masks)])
    rows = prints.select("fp", F.explode(keys).alias("key")).select("key.mask", "key.under", "fp")
    grouped = blocked_groups(rows, ["mask", "under"], "fp", block, prints.select("fp", "far"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in each_group(batches, ["mask", "under", "left", "right"]):
            fp = group["fp"].to_numpy().view(np.uint64)
            far = np.frombuffer(b"".join(group["far"].to_pylist()), np.int8).reshape(len(fp), -1)
            side = group["side"].to_numpy()
            same = group["left"][0] == group["right"][0]
            a, b = (np.arange(len(fp)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            i, j, _ = near_pairs(fp[a], fp[b], far[a], far[b], same, max_bits)
            u, v = star_edges(len(fp), a[i], b[j])
            yield pa.RecordBatch.from_arrays([pa.array(fp[u].view(np.int64)), pa.array(fp[v].view(np.int64))], ["a", "b"])

    return grouped.mapInArrow(link, "a long, b long")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _groups(rows: DataFrame, max_bits: int) -> DataFrame:
    """``fp, root, label``: each fingerprint of ``doc_id, fp`` rows with a fingerprint that names its group, and the
    smallest id of the group."""
    prints = settle(with_distances(rows.groupBy("fp").agg(F.min("doc_id").alias("label"))))
    links = settle(fingerprint_links(prints, max_bits).distinct())
    prints = prints.drop("far")
    roots = component_roots(links).withColumnRenamed("node", "fp")
    grouped = join_ns(prints, roots, ["fp"], "left").withColumn("root", F.coalesce("root", "fp"))
    grouped = settle(grouped)
    least = grouped.groupBy("root").agg(F.min("label").alias("least"))
    return settle(join_ns(grouped, least, ["root"]).select("fp", "root", F.col("least").alias("label")))


def simhash_groups(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for each document.

    ``fingerprint``: 16 lower-case hex digits. ``component_id``: the smallest id that links lead to, itself included;
    two documents link if their fingerprints differ in at most ``max_bits`` bits. Null and empty texts have
    fingerprint zero and link like any other. Repeated rows are each returned. A null id is never the smallest; a
    group of null ids only has a null component. An empty table gives no rows. Other columns are not used.

    Documents with one fingerprint count once in the search, so exact copies cost one row however many there are.
    """
    rows = settle(docs.select(quoted(doc_id).alias("doc_id"), simhash(quoted(text), shingle).alias("fp")))
    out = join_ns(rows, _groups(rows, max_bits), ["fp"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("label").alias("component_id"))


def keep_one_of_each(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One whole row of each group of near copies, that with the smallest id (null last, then the smallest
    fingerprint as a signed number). Of repeated rows with that id and fingerprint any one stays.

    Ids are chosen on (id, fingerprint) rows. Rows whose id occurs once are fetched by it; only rows with repeated or
    null ids are fingerprinted again to tell them apart.
    """
    rows = settle(docs.select(quoted(doc_id).alias("doc_id"), simhash(quoted(text), shingle).alias("fp")))
    placed = join_ns(rows, _groups(rows, max_bits), ["fp"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "fp")).alias("first")
    chosen = placed.groupBy("root").agg(first).select("first.doc_id", "first.fp")
    often = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    chosen = settle(join_ns(chosen, often, ["doc_id"]).withColumn("alone", (F.col("n") == 1) & F.col("doc_id").isNotNull()))
    named = docs.withColumn("__id", quoted(doc_id))
    # Chosen ids grow with the documents, so they are merged at any size and never broadcast.
    once = chosen.where("alone").select(F.col("doc_id").alias("__id")).hint("merge")
    kept = named.join(once, "__id", "semi")
    again = chosen.where("NOT alone").select(F.col("doc_id").alias("__id"), F.col("fp").alias("__fp"))
    if not again.isEmpty():
        some = join_ns(named, again.select("__id").distinct(), ["__id"], "semi").withColumn("__fp", simhash(quoted(text), shingle))
        some = join_ns(some, again, ["__id", "__fp"], "semi").dropDuplicates(["__id", "__fp"])
        kept = kept.unionByName(some.drop("__fp"))
    return kept.select(*map(quoted, docs.columns))
