"""Alignment of two tokenizers on the same texts: groups of tokens that cover the same bytes, and their links.

Tokens of both lie side by side over the bytes of a text. Every token points to the token that reaches farthest right
among those it overlaps, itself included; pointers are doubled, each to where its target points, until none moves. Then
all tokens of a group point to its last token. This runs over the tokens of many texts at a time in arrays.

Neither tokenizer joins signs over a blank between two visible signs, so texts are cut there, and each different unit
of a chunk of texts is aligned once.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from cohortloom.functions.exprs import quoted
from cohortloom.llm.byte_bpe import _splits_at_spaces
from cohortloom.llm.chunks import Numbers, as_binary, chunks, from_binary
from cohortloom.llm.pieces import SPACE, piece_texts
from cohortloom.session import settle

_BLANKS = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S) (?=\S)")
# Signs of text in a chunk, and signs of new units encoded at a time.
CHUNK_SIGNS, _CALL_SIGNS = 8 << 20, 1 << 20
# Bits of an id in a pair, and links from which the repeated ids of a group are counted before they are paired.
ID_BITS, _LARGE_GROUP = 20, 1 << 10


def _byte_level() -> dict[str, int]:
    """The sign that stands for each byte in a byte-level vocabulary: itself where it is visible, else the next sign
    from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tools:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        self.bpe = Tokenizer.from_file(byte_path)
        self.bpe.no_truncation()
        self.bpe.no_padding()
        self.bpe.encode_special_tokens = True  # special strings inside texts are plain text
        self.model = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        signs = _byte_level()
        self.a_bytes = [b""] * self.bpe.get_vocab_size()
        for token, i in self.bpe.get_vocab().items():
            self.a_bytes[i] = bytes(signs[c] for c in token) if all(c in signs for c in token) else token.encode()
        self.b_bytes = piece_texts(piece_path)
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        if max(len(self.a_bytes), len(self.b_bytes)) >= 1 << ID_BITS:
            raise ValueError(f"vocabularies of {1 << ID_BITS} tokens or more are not supported")
        with open(byte_path, encoding="utf-8") as file:
            plain = _splits_at_spaces(json.load(file))
        names = map(self.model.id_to_piece, range(self.model.get_piece_size()))
        self.cuts = plain and not any(SPACE in name.lstrip(SPACE) for name in names)

    def units(self, text: str) -> list[str]:
        """The text cut at blanks that neither tokenizer crosses; the blank in front of each unit is left out."""
        if not self.cuts:
            return [text]
        if text[0].isspace() or text[-1].isspace() or _BLANKS.search(text):
            return _SAFE.split(text)
        return text.split(" ")

    def encode(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both of all units, each with a blank before it, one after the other, and how many each unit has; none
        where one of the two does not give the unit's bytes back."""
        raw = [b" " + u.encode() for u in units]
        ids = [[e.ids for e in self.bpe.encode_batch_fast([" " + u for u in units], add_special_tokens=False)], self.model.encode(units, num_threads=1)]
        tables = [(self.a_bytes, self.a_length), (self.b_bytes, self.b_length)]
        if not all(self._all_come_back(raw, found, *table) for found, table in zip(ids, tables)):
            kept = [all(b"".join(map(names.__getitem__, found[i])) == x for found, (names, _) in zip(ids, tables)) for i, x in enumerate(raw)]
            ids = [[x if ok else [] for x, ok in zip(found, kept)] for found in ids]
        flat = [np.fromiter(chain.from_iterable(found), np.int64) for found in ids]
        return flat[0], flat[1], *(np.fromiter(map(len, found), np.int64, len(units)) for found in ids)

    @staticmethod
    def _all_come_back(raw: list[bytes], ids: list[list[int]], names: list[bytes], length: np.ndarray) -> bool:
        """Whether every unit has its own bytes: all of them joined, and the number of each."""
        flat = list(chain.from_iterable(ids))
        if b"".join(map(names.__getitem__, flat)) != b"".join(raw):
            return False
        upto, ends = np.concatenate([[0], np.cumsum(length[flat])]), np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
        return np.array_equal(upto[ends], np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw))))

@functools.lru_cache(maxsize=2)
def tools(byte_path: str, piece_path: str) -> Tools:
    return Tools(byte_path, piece_path)


def group_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Group number of each token, for two rows of tokens that cover the same bytes and end at these places.

    A token points to the one of the other row that holds its last byte if that reaches farther; where both end, the
    token of the second row points to that of the first, which is the last of the group and points to itself.
    """
    n = len(a_ends)
    onto_b, onto_a = np.searchsorted(b_ends, a_ends), np.searchsorted(a_ends, b_ends)
    own = np.arange(n)
    to = np.concatenate([np.where(b_ends[onto_b] > a_ends, n + onto_b, own) if n else own, onto_a])
    while True:
        further = to[to]
        if np.array_equal(further, to):
            break
        to = further
    last = np.flatnonzero(to[:n] == own)
    group = np.searchsorted(last, to)
    return group[:n], group[n:], len(last)


def _different(group: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ids of each group in order: group, id and how often."""
    codes, times = np.unique((group << ID_BITS) | ids, return_counts=True)
    return codes >> ID_BITS, codes & ((1 << ID_BITS) - 1), times


class Aligned:
    """The alignment of a list of units, unit after unit."""

    def __init__(self, tool: Tools, units: list[str]):
        a_ids, b_ids, self.n_a, self.n_b = tool.encode(units)
        n = len(units)
        a_group, b_group, groups = group_ends(np.cumsum(tool.a_length[a_ids]), np.cumsum(tool.b_length[b_ids]))
        unit_of = np.zeros(groups, np.int64)
        unit_of[a_group] = np.repeat(np.arange(n), self.n_a)
        self.n_groups = np.bincount(unit_of, minlength=n)
        in_a, in_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        self.n_links = np.bincount(unit_of, in_a * in_b, minlength=n).astype(np.int64)
        self._links(unit_of, a_group, a_ids, b_group, b_ids, int((in_a * in_b).max(initial=0)))
        self.n_codes = np.bincount(self._unit, minlength=n)
        self.names = self._names(unit_of, a_group, a_ids, b_group, b_ids, n)

    def _links(self, unit_of: np.ndarray, a_group: np.ndarray, a_ids: np.ndarray, b_group: np.ndarray, b_ids: np.ndarray, most: int) -> None:
        """Per unit its different id pairs (``codes``) with their number of links (``times``): each A id of a group with
        each B id of it. In a large group ids that repeat are counted first, so that a run of one sign stays small."""
        a_times = b_times = None
        if most > _LARGE_GROUP:
            a_group, a_ids, a_times = _different(a_group, a_ids)
            b_group, b_ids, b_times = _different(b_group, b_ids)
        size = np.bincount(b_group, minlength=len(unit_of))
        reach = size[a_group]
        start = (np.cumsum(size) - size)[a_group] - (np.cumsum(reach) - reach)
        at = np.repeat(start, reach) + np.arange(reach.sum())
        keys = np.repeat((unit_of[a_group] << 2 * ID_BITS) | (a_ids << ID_BITS), reach) | b_ids[at]
        if a_times is None:
            keys, self.times = np.unique(keys, return_counts=True)
        else:
            keys, own = np.unique(keys, return_inverse=True)
            self.times = np.bincount(own, np.repeat(a_times, reach) * b_times[at]).astype(np.int64)
        self._unit, self.codes = keys >> 2 * ID_BITS, keys & ((1 << 2 * ID_BITS) - 1)

    def _names(self, unit_of: np.ndarray, a_group: np.ndarray, a_ids: np.ndarray, b_group: np.ndarray, b_ids: np.ndarray, n: int) -> list[bytes]:
        """The groups of each unit as text: every id with the sign behind it."""
        order = np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")
        ids = np.concatenate([a_ids, b_ids])[order]
        side = np.concatenate([2 * a_group, 2 * b_group + 1])[order]
        unit = unit_of[side >> 1]
        behind = np.zeros(len(ids), np.int64)  # a comma
        behind[:-1][side[1:] != side[:-1]] = 2  # a semicolon
        behind[:-1][(side[1:] != side[:-1]) & (side[:-1] % 2 == 0)] = 1  # a bar
        behind[:-1][unit[1:] != unit[:-1]] = 3  # nothing
        behind[-1:] = 3
        parts = list(map(_id_names().__getitem__, (4 * ids + behind).tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return [b"".join(parts[a:b]) for a, b in zip([0, *ends], ends)]


@functools.lru_cache(maxsize=1)
def _id_names() -> "_Names":
    return _Names()


class _Names(dict):
    """Ids as text with the sign behind them, made when first asked for; as many as the vocabularies have."""

    def __missing__(self, key: int) -> bytes:
        self[key] = name = str(key >> 2).encode() + (b",", b"|", b";", b"")[key & 3]
        return name


def _calls(units: list[str]) -> Iterator[list[str]]:
    start, size = 0, 0
    for i, unit in enumerate(units):
        size += len(unit) + 1
        if size >= _CALL_SIGNS or i == len(units) - 1:
            yield units[start:i + 1]
            start, size = i + 1, 0


def token_groups(tool: Tools, text: str | None) -> list[tuple[list[int], list[int]]]:
    """The groups of a text as (A ids, B ids); none for null, the empty text, and texts that do not come back."""
    found = Aligned(tool, tool.units(text)) if text else None
    if found is None or not found.n_a.all():
        return []
    return [tuple([int(i) for i in side.split(b",")] for side in g.split(b"|")) for name in found.names for g in name.split(b";")]


def with_token_groups(df: DataFrame, byte_path: str, piece_path: str, text: str = "text") -> DataFrame:
    """Add ``token_groups``, the groups of each whole text in order as (``a``, ``b``) lists of ids; a column of that
    name is replaced. Null and empty texts, and texts that do not come back, have none."""
    rows = df.drop("token_groups")
    place = rows.columns.index(text)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tools(byte_path, piece_path)
        for batch in batches:
            for at in range(batch.num_rows):
                groups = [{"a": a, "b": b} for a, b in token_groups(tool, batch.column(place)[at].as_py())]
                yield pa.RecordBatch.from_arrays([*batch.slice(at, 1).columns, pa.array([groups], kind)], [*batch.schema.names, "token_groups"])

    added = StructType.fromDDL("token_groups array<struct<a: array<int>, b: array<int>>>")
    return rows.mapInArrow(add, StructType(rows.schema.fields + added.fields))


WRITTEN = {
    "chunk": pa.int64(), "doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(),
    "groups_sha256": pa.string(), "numbers": pa.binary(), "n_codes": pa.binary(), "pairs": pa.binary(), "times": pa.binary(),
    "number": pa.int32(), "pair": pa.int64(), "docs": pa.int64(),
}


def _batch(chunk: int, n: int, **columns: pa.Array) -> pa.RecordBatch:
    """Rows of ``WRITTEN``, null in the columns that are not given."""
    columns["chunk"] = pa.array(np.full(n, chunk, np.int64))
    return pa.RecordBatch.from_pydict({c: columns[c].cast(t) if c in columns else pa.nulls(n, t) for c, t in WRITTEN.items()})


def _write_chunks(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """Three kinds of rows. Texts: their digests and units as ``numbers``. One row a chunk for its units: how many
    pairs each has (``n_codes``), their numbers and links (``pairs``, ``times``). And the pairs of the chunk: ``number``,
    ``pair``, and ``docs``, how many of its texts hold it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = tools(byte_path, piece_path)
        for chunk, rows in chunks(batches, size=CHUNK_SIGNS):
            known = Numbers()
            texts = [np.array([known[u] for u in tool.units(row["text"])] if row["text"] else [], np.int32) for row in rows]
            doc_ids = pa.array([r["doc_id"] for r in rows], pa.int64())
            rows.clear()
            parts = [Aligned(tool, call) for call in _calls(list(known))]
            del known
            join = lambda name: np.concatenate([getattr(p, name) for p in parts] or [np.zeros(0, np.int64)])
            whole, names = {c: join(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_codes", "times")}, [x for p in parts for x in p.names]
            codes, pairs = np.unique(join("codes"), return_inverse=True)
            del parts
            ends = np.cumsum(whole["n_codes"])
            docs_of, out = np.zeros(len(codes), np.int64), {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", "groups_sha256", "numbers")}
            for numbers in texts:
                if not whole["n_a"][numbers].all():
                    numbers = numbers[:0]  # a unit that does not come back
                sizes = whole["n_codes"][numbers]
                at = np.repeat(ends[numbers] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
                docs_of[pairs[at]] += 1  # once for each different pair, however often it is among them
                for c in ("n_a", "n_b", "n_groups", "n_links"):
                    out[c].append(int(whole[c][numbers].sum()))
                out["groups_sha256"].append(hashlib.sha256(b";".join([names[i] for i in numbers.tolist()])).hexdigest() if len(numbers) else "")
                out["numbers"].append(as_binary(numbers))
            yield _batch(chunk, len(texts), doc_id=doc_ids, **{c: pa.array(v) for c, v in out.items()})
            blobs = {"n_codes": whole["n_codes"], "pairs": pairs, "times": whole["times"]}
            yield _batch(chunk, 1, **{c: pa.array([as_binary(v)], pa.binary()) for c, v in blobs.items()})
            met = np.flatnonzero(docs_of)
            for a in range(0, len(met), 100_000):
                part = met[a:a + 100_000]
                yield _batch(chunk, len(part), number=pa.array(part), pair=pa.array(codes[part]), docs=pa.array(docs_of[part]))

    return settle(docs.mapInArrow(read, from_arrow_schema(pa.schema(WRITTEN))))


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row.

    A: a byte-level vocabulary of the tokenizers library on a blank and the text; B: a sentencepiece model on the text,
    to which it adds the blank itself. The places where tokens of both end cut them into groups; every A token of a
    group is linked to every B token of it. The count of an id pair is the number of rows of ``docs`` that have it
    linked. ``n_best``: links whose pair has the highest count of all pairs with that A id, ties included; ``count_sum``:
    the sum of the counts over all links. ``groups_sha256``: of the groups as text, ids of a group by commas, A before
    ``|`` and B behind it, groups by semicolons (``token_groups`` gives the ids themselves).

    Null and empty texts, and texts that one of the two does not give back byte for byte, have no tokens: all numbers
    are 0 and the digest is empty. Null and repeated ids are kept, repeated rows count each, other columns are not used.
    Memory is bounded by a chunk of ``CHUNK_SIGNS`` signs and the longest text. Pairs are counted over all rows by
    joins on one row per chunk and pair; nothing reaches the driver.
    """
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"))
    written = _write_chunks(rows, byte_path, piece_path)
    listed = written.where("pair IS NOT NULL").select("chunk", "number", "pair", "docs")
    counts = settle(listed.groupBy("pair").agg(F.sum("docs").alias("count")))
    a_id = F.shiftright("pair", ID_BITS)
    tops = counts.groupBy(a_id.alias("a")).agg(F.max("count").alias("top"))
    ranked = counts.withColumn("a", a_id).join(tops, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))
    found = listed.select("chunk", "number", "pair").join(ranked, "pair").select(F.col("chunk").alias("in_chunk"), "number", "count", "best")

    def place(key, texts: pa.Table, pairs: pa.Table) -> pa.Table:
        units = texts.filter(pa.compute.is_valid(texts["pairs"]))
        texts = texts.filter(pa.compute.is_valid(texts["numbers"]))
        n_codes, own, times = (from_binary(units[c][0].as_py()).astype(np.int64) for c in ("n_codes", "pairs", "times"))
        top = int(own.max(initial=-1)) + 1
        count, best = np.zeros(top, np.int64), np.zeros(top, np.int64)
        number = pairs["number"].to_numpy()
        count[number], best[number] = pairs["count"].to_numpy(), pairs["best"].to_numpy(zero_copy_only=False)
        ends = np.cumsum(n_codes)
        sums = []
        for value in (best, count):
            upto = np.concatenate([[0], np.cumsum(value[own] * times)])
            per_unit = upto[ends] - upto[ends - n_codes]
            sums.append([int(per_unit[from_binary(x)].sum()) for x in texts["numbers"].to_pylist()])
        kept = texts.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
        return kept.append_column("n_best", pa.array(sums[0], pa.int64())).append_column("count_sum", pa.array(sums[1], pa.int64()))

    wanted = written.where("pair IS NULL").drop("number", "pair", "docs")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return wanted.groupBy("chunk").cogroup(found.groupBy("in_chunk")).applyInArrow(place, schema)
