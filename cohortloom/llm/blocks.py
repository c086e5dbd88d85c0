"""Comparing rows that share a key, block by block, so that no task holds more than two blocks of a group."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortloom.session import settle


def blocked_groups(
    rows: DataFrame, keys: Sequence[str], item: str, block: int, attach: DataFrame | None = None
) -> DataFrame:
    """Rows of groups with at least two members, dealt out as pairs of blocks and sorted by ``keys, left, right``.

    A group of n rows is cut into ceil(n / block) blocks by a hash of ``item``; each pair of blocks is one unit of
    work, where ``side`` tells the left block's rows (0) from the right block's (1). A pair of a block with itself has
    side 0 only. Every two rows of a group meet in exactly one unit. ``keys`` hold no nulls; ``item`` tells rows apart.
    ``attach``: columns for each ``item``, joined once only rows with company are left.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    blocks = settle(sizes.select(*keys, F.ceil(F.col("n") / block).cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64(item), F.col("blocks")).cast("int")
    placed = rows.join(blocks, list(keys)).withColumn("own", own)
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    units = met.withColumns(
        {
            "left": F.least("own", "other"),
            "right": F.greatest("own", "other"),
            "side": (F.col("own") > F.col("other")).cast("int"),
        }
    ).drop("own", "other", "blocks")
    if attach is not None:
        units = units.join(attach, item)
    unit = [*keys, "left", "right"]
    # With a number Spark leaves the parts as they are: few bytes of a unit may mean a lot of comparing.
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return units.repartition(parts, *unit).sortWithinPartitions(*unit)


def each_group(batches: Iterator[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The groups of rows with equal keys from batches sorted by them; holds one batch and one group."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if rest is not None:
            batch = pa.Table.from_batches([rest, batch]).combine_chunks().to_batches()[0]
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist()]
        for a, b in zip(starts, starts[1:]):
            yield batch.slice(a, b - a)
        rest = batch.slice(starts[-1])
    if rest is not None:
        yield rest


def star_edges(n: int, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places 0..n-1 linked by (i, j): each place that can reach a smaller one, and the smallest it can reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label < np.arange(n))
    return moved, label[moved]
