"""Texts taken in chunks of bounded size, each with a vocabulary of its own.

A chunk's words are written once however often they occur in it, so what is counted or looked up over the whole corpus
is one row per chunk and word, not one per token.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext

# Signs of text in a chunk; a longer text is a chunk of its own.
CHUNK_SIGNS = 16 << 20


class Numbers(dict):
    """Numbers for words in the order of their first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = CHUNK_SIGNS) -> Iterator[tuple[int, list[dict]]]:
    """(number of the chunk, its rows) of a task's rows. Numbers differ between tasks; they hold as long as the rows of
    the task are the same, so what is numbered must be written down before it is used twice."""
    task, count, rows, signs = TaskContext.get().partitionId(), 0, [], 0
    for batch in batches:
        for at in range(batch.num_rows):
            row = {name: batch.column(i)[at].as_py() for i, name in enumerate(batch.schema.names)}
            rows.append(row)
            signs += len(row[text] or "")
            if signs >= size:
                yield (task << 32) + count, rows
                count, rows, signs = count + 1, [], 0
    if rows:
        yield (task << 32) + count, rows


def as_binary(values: np.ndarray) -> bytes:
    """Numbers as little-endian 32-bit integers."""
    return values.astype("<i4").tobytes()


def from_binary(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<i4")


def cut_at_spaces(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(different pieces between single spaces, the number of each piece of the texts one after the other, how many of
    each text). A null text is an empty one, which is one empty piece."""
    lists = pa.compute.split_pattern(pa.compute.fill_null(texts, ""), " ")
    found = lists.flatten().dictionary_encode()
    names = found.dictionary
    names = pa.compute.binary_join(pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), names), " ")[0].as_py().split(" ")
    return names, found.indices.to_numpy(), pa.compute.list_value_length(lists).to_numpy().astype(np.int64)


def frequent(seen: np.ndarray, weights: np.ndarray, limit: int) -> np.ndarray:
    """Ascending numbers of what was seen more than once, the most frequent as far as their weights stay within the limit."""
    order = np.argsort(-seen, kind="stable")
    order = order[: np.count_nonzero(seen > 1)]
    return np.sort(order[np.cumsum(weights[order]) <= limit])


def runs_at(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Places of runs, each from its start on, one run after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
