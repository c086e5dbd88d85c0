"""Near copies among embeddings by randomly rotated binary codes with correction factors."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.functions.exprs import quoted
from cohortloom.llm.blocks import blocked_groups, each_group, star_edges
from cohortloom.llm.components import component_roots
from cohortloom.operators.joins import join_ns
from cohortloom.session import settle

# Share of pairs exactly at the threshold that no band brings together, and standard errors allowed to an estimate.
MISSED, ERRORS = 1e-5, 4.0


def band_plan(largest: int, threshold: float) -> tuple[int, int]:
    """(bits in a band, bands): enough bits that unlike vectors of the largest label rarely meet, and enough bands
    that a pair at the threshold meets in one but for a share of ``MISSED``."""
    bits = max(12, math.ceil(math.log2(max(largest, 2))))
    agree = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** bits
    return bits, math.ceil(math.log(MISSED) / math.log1p(-agree)) if agree < 1 else 1


def rotation(dim: int, bits: int, seed: int) -> np.ndarray:
    """A random rotation of vectors padded with zeros to ``bits`` (or more) places; columns are orthonormal."""
    rng = np.random.default_rng([seed, dim])
    return np.linalg.qr(rng.standard_normal((max(dim, bits), dim)))[0]


def unit(vectors: np.ndarray) -> np.ndarray:
    """In double precision, scaled by the largest part first so that no square overflows or vanishes."""
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))


def encode(vectors: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sign bits of the rotated unit vectors (as booleans), and how much of the vector its code points along."""
    turned = unit(vectors) @ turn.T
    signs = turned > 0
    return signs, np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[0])


def estimate(signs: np.ndarray, factor: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unbiased estimates of the inner products of coded vectors with rotated unit vectors, and the error of each code
    that is not exceeded but for about one pair in ten thousand."""
    places = signs.shape[1]
    along = np.where(signs, np.float32(1), np.float32(-1)) @ other.T.astype(np.float32) / np.float32(np.sqrt(places))
    error = np.sqrt(np.maximum(1 - factor**2, 0)) / factor * ERRORS / np.sqrt(max(places - 1, 1))
    return along / factor[:, None].astype(np.float32), error


def _usable(embedding: Column) -> Column:
    """Finite numbers only, and not all zero."""
    odd = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def embedding_links(distinct: DataFrame, threshold: float, seed: int = 11, block: int = 1024) -> DataFrame:
    """``a, b, links`` for different vectors (``id``, ``label``, ``embedding``, ``copies``): rows with a null ``b`` count the
    copies of other vectors linked with ``a``; the others are links, enough to join all that are linked.

    Vectors of a label meet where all bits of a band of their codes agree. There the estimate and its error bound rule
    out most pairs; the rest get their cosine in double precision. A pair that meets in several bands counts in the
    first. A pair is never written out for each of many near copies: a block gives counts and a star of links.
    """
    sizes = distinct.groupBy("label").count().agg(F.max("count")).first()[0]
    bits, bands = band_plan(sizes or 1, threshold)
    places = bits * bands
    weigh = (1 << np.arange(bits, dtype=np.int64))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, ids = batch.column("embedding"), batch.column("id").to_numpy()
            lengths = pa.compute.list_value_length(lists).to_numpy()
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                signs, factor = encode(_matrix(lists.take(pa.array(at))), rotation(int(dim), places, seed))
                keys = signs[:, :places].reshape(len(at), bands, bits) @ weigh
                offsets = pa.array(np.arange(len(at) + 1) * bands, pa.int32())
                columns = [pa.array(ids[at]), pa.array(np.full(len(at), dim), pa.int32())]
                columns += [pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())), pa.array([r.tobytes() for r in np.packbits(signs, axis=1)], pa.binary()), pa.array(factor)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "dim", "keys", "code", "factor"])

    codes = distinct.select("id", "embedding").mapInArrow(code, "id long, dim int, keys array<long>, code binary, factor double")
    codes = settle(codes.join(distinct, "id"))
    rows = codes.select("id", "label", "dim", F.posexplode("keys").alias("band", "bits"))
    keys = ["label", "dim", "band", "bits"]
    attach = codes.select("id", "copies", "embedding", "keys", "code", "factor")
    grouped = blocked_groups(rows, keys, "id", block, attach)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for group in each_group(batches, [*keys, "left", "right"]):
            dim, band = group["dim"][0].as_py(), group["band"][0].as_py()
            if dim not in turns:
                turns[dim] = rotation(dim, places, seed)
            full = max(dim, places)
            ids, copies, meets = group["id"].to_numpy(), group["copies"].to_numpy(), _matrix(group["keys"])
            vectors, factor = unit(_matrix(group["embedding"])), group["factor"].to_numpy()
            packed = np.frombuffer(b"".join(group["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
            signs = np.unpackbits(packed, axis=1, count=full).astype(bool)
            side = group["side"].to_numpy()
            same = group["left"][0] == group["right"][0]
            a, b = (np.arange(len(ids)),) * 2 if same else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
            about, error = estimate(signs[a], factor[a], vectors[b] @ turns[dim].T)
            maybe = about + error[:, None].astype(np.float32) >= threshold
            i, j = np.nonzero(np.triu(maybe, 1) if same else maybe)
            i, j = a[i], b[j]
            keep = np.concatenate([np.empty(0, bool), *[
                ((vectors[i[s:s + 65536]] * vectors[j[s:s + 65536]]).sum(axis=1) >= threshold)
                & ((meets[i[s:s + 65536], :band] != meets[j[s:s + 65536], :band]).all(axis=1))
                for s in range(0, len(i), 65536)
            ]])
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
            u, v = star_edges(len(ids), i, j)
            counted = np.flatnonzero(links)
            columns = [
                pa.array(np.concatenate([ids[counted], ids[u]])),
                pa.concat_arrays([pa.nulls(len(counted), pa.int64()), pa.array(ids[v], pa.int64())]),
                pa.array(np.concatenate([links[counted], np.zeros(len(u))]).astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["a", "b", "links"])

    return grouped.mapInArrow(compare, "a long, b long, links long")


def near_copies(
    vectors: DataFrame, threshold: float = 0.98, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row.

    Vectors with the same label, not null, and the same number of parts link if their cosine is at least ``threshold``;
    vectors that are null, empty, all zero or hold null or non-finite parts link with nothing. ``n_links``: other rows
    linked directly. ``component_id``: the smallest id links lead to, itself included. ``kept``: whether it is its own.
    Equal vectors count once in the search and with their number in the counts. A null id is never the smallest and
    is kept if it has no other. The table may be empty; other columns are not used.
    """
    rows = vectors.select(quoted(vec_id).alias("vec_id"), quoted(label).alias("label"), quoted(embedding).alias("embedding"))
    rows = rows.withColumn("usable", _usable(F.col("embedding")) & F.col("label").isNotNull())
    found = rows.where("usable").groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
    distinct = settle(found.withColumn("id", F.monotonically_increasing_id()))
    links = settle(embedding_links(distinct.select("id", "label", "embedding", "copies"), threshold))
    counts = links.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    roots = component_roots(links.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "id")
    placed = settle(distinct.join(counts, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")))
    least = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = placed.join(least, "root").select(
        "label", "embedding", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id"
    )
    linked = rows.where("usable").join(placed, ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
