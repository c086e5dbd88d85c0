"""Counting and encoding whole texts with a byte-level BPE vocabulary file."""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from cohortloom.functions.exprs import quoted
from cohortloom.llm.chunks import cut_at_spaces, frequent, runs_at

# Bytes of text whose pieces are made distinct together, bytes of text whose ids are written out at a time, pieces in
# one text and texts in one call of the library, and what is remembered: pieces, their signs and their ids.
CUT_BYTES, STEP_BYTES, CALL_PIECES, CALL_TEXTS, MEMORY_PIECES, MEMORY_SIGNS = 6 << 20, 2 << 20, 256, 64, 1_000_000, 16 << 20
# Signs from which a piece is cut further, where no token of the vocabulary can reach over the cut.
LONG_PIECE = 1 << 12
_RUN = re.compile(r"\s\s")
_SAFE = re.compile(r"(?<=\S) (?=\S)")


class _Index:
    """Numbers of strings, 0, 1, 2 and so on as they are new. By sorted hashes beside the strings end to end, which takes
    a few dozen bytes and no object for each; of different strings with one hash, the first is found again."""

    def __init__(self):
        self.hashes, self.at = np.empty(0, np.int64), np.empty(0, np.int64)
        self.strings = pa.array([], pa.large_string())

    def numbers(self, asked: list[str]) -> tuple[np.ndarray, list[str]]:
        """(the number of each string, the new strings in the order of their numbers)"""
        hashes = np.fromiter(map(hash, asked), np.int64, len(asked))
        order = np.argsort(hashes)
        strings = pa.array(asked, pa.large_string()).take(pa.array(order))
        hashes = hashes[order]
        # Equal hashes stand together: each string is compared with the known one of its hash, else with the first here.
        place = np.searchsorted(self.hashes, hashes)
        known = place < len(self.hashes)
        known[known] = self.hashes[place[known]] == hashes[known]
        head = np.ones(len(asked), bool)
        head[1:] = hashes[1:] != hashes[:-1]
        first = np.maximum.accumulate(np.where(head, np.arange(len(asked)), 0))
        same = np.ones(len(asked), bool)
        same[known] = _equal(strings.filter(pa.array(known)), self.strings.take(pa.array(self.at[place[known]])))
        again = ~known & ~head
        same[again] = _equal(strings.filter(pa.array(again)), strings.take(pa.array(first[again])))
        new = ~same | (~known & head)
        number = np.empty(len(asked), np.int64)
        number[known] = self.at[place[known]]
        number[new] = len(self.strings) + np.arange(np.count_nonzero(new))
        again &= same
        number[again] = number[first[again]]
        added = strings.filter(pa.array(new))
        self.strings = pa.concat_arrays([self.strings, added])
        fresh = ~known & head
        self.hashes = np.insert(self.hashes, place[fresh], hashes[fresh])
        self.at = np.insert(self.at, place[fresh], number[fresh])
        out = np.empty(len(asked), np.int64)
        out[order] = number
        return out, added.to_pylist()

    def keep(self, kept: np.ndarray) -> None:
        """Forget all strings but these, by ascending numbers; they are numbered anew in that order."""
        number = np.full(len(self.strings), -1)
        number[kept] = np.arange(len(kept))
        number = number[self.at]
        self.hashes, self.at = self.hashes[number >= 0], number[number >= 0]
        self.strings = self.strings.take(pa.array(kept))


def _equal(a: pa.Array, b: pa.Array) -> np.ndarray:
    return pa.compute.equal(a, b).to_numpy(zero_copy_only=False)


def _splits_at_spaces(config: dict) -> bool:
    """Whether the vocabulary always starts a new token at a space between two visible signs: plain byte-level
    splitting, no normaliser, and no special string that holds or swallows white space."""
    split = config.get("pre_tokenizer") or {}
    plain = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    added = config.get("added_tokens") or []
    calm = all(not (re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip")) for t in added)
    return bool(plain and calm and not config.get("normalizer"))


class Library:
    """A vocabulary file and its library, with what may be cut and joined without changing a token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task per core
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.ids, self.cuts = (lambda texts: model.encode(texts, num_threads=1)), False
            return
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        if hasattr(model.model, "_resize_cache"):
            model.model._resize_cache(0)  # a piece goes through the library once, so its own memory only costs time
        self.ids = lambda texts: [e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)]
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        self.cuts = _splits_at_spaces(config)
        if self.cuts:
            self._measure(model, {t["content"] for t in config.get("added_tokens") or []})

    def _measure(self, model, added: set[str]) -> None:
        """Bytes of each token, and which pairs of bytes stand side by side in one. In a byte-level vocabulary every
        sign of a token is one byte."""
        vocabulary = model.get_vocab()
        self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        self.beside = np.zeros((256, 256), bool)
        for token, i in vocabulary.items():
            raw = list(token.encode()) if token in added else [byte[c] for c in token]
            self.length[i] = len(raw)
            self.beside[raw[:-1], raw[1:]] = True

    def parts(self, piece: str) -> list[str]:
        """A long piece cut between letters whose bytes no token has side by side. Letters stay together when texts are
        split, and merging, which builds tokens of the vocabulary only, cannot reach over such a place."""
        if len(piece) < LONG_PIECE:
            return [piece]
        cuts, last = [0], 0
        ends = [(c.encode()[-1], c.encode()[0]) for c in piece]
        for i in range(1, len(piece)):
            if i - last >= LONG_PIECE // 4 and not self.beside[ends[i - 1][0], ends[i][1]] and piece[i - 1].isalpha() and piece[i].isalpha():
                cuts.append(i)
                last = i
        return [piece[a:b] for a, b in zip(cuts, [*cuts[1:], len(piece)])]

    def _called(self, calls: list[list[int]], pieces: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """(call, ids of its pieces joined), a bounded number of calls at a time."""
        for a in range(0, len(calls), CALL_TEXTS):
            part = calls[a:a + CALL_TEXTS]
            yield from zip(part, self.ids(["".join([pieces[i] for i in call]) for call in part]))

    def encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has.

        Pieces that begin with a space before a visible sign and end in one are joined for a call: the library cuts
        there anyway, and the bytes of its tokens tell where each piece ends.
        """
        joined, lone = [], []
        for i, piece in enumerate(pieces):
            (joined if self.cuts and piece[:1] == " " and piece[1:] and piece.strip() == piece[1:] else lone).append(i)
        octets = pa.compute.binary_length(pa.array(pieces, pa.string())).to_numpy()
        order, sizes, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
        calls = [joined[a:a + CALL_PIECES] for a in range(0, len(joined), CALL_PIECES)]
        for call, ids in self._called(calls, pieces):
            ids, members = np.array(ids, np.int32), np.array(call)
            ends = np.cumsum(octets[members])
            upto = np.cumsum(self.length[ids])
            place = np.searchsorted(upto, ends)
            if upto[-1] != ends[-1] or not np.array_equal(upto[place], ends):
                lone += call  # a token over the end of a piece; the library has the last word
                continue
            order.append(members)
            sizes.append(np.diff(place + 1, prepend=0))
            found.append(ids)
        for a in range(0, len(lone), CALL_PIECES):
            call = lone[a:a + CALL_PIECES]
            lists = self.ids([pieces[i] for i in call])
            order.append(np.array(call))
            sizes.append(np.array([len(ids) for ids in lists]))
            found += [np.array(ids, np.int32) for ids in lists]
        order, sizes = np.concatenate(order), np.concatenate(sizes)
        counts, starts = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
        counts[order], starts[order] = sizes, np.cumsum(sizes) - sizes
        return np.concatenate(found)[runs_at(starts, counts)], counts


@functools.lru_cache(maxsize=4)
def _library(path: str) -> Library:
    """Loaded once per worker."""
    return Library(path)


def pieces(text: str) -> list[str]:
    """Cut before each space that stands between two visible signs; joined by one space they give the text back.

    Byte-level BPE starts a new pre-token at such a space whatever stands around it, so tokens never cross a cut.
    """
    return _SAFE.split(text) if _RUN.search(text) else text.split(" ")


class PieceCoder:
    """Encode texts piece by piece; each different piece goes through the library once, until it is forgotten.

    Memory is bounded by ``MEMORY_PIECES`` different pieces, ``MEMORY_SIGNS`` of their signs and ids, ``CUT_BYTES`` of
    new text and the largest single text. When it is full, the most frequent pieces stay in half of it. A worker keeps
    what it knows from task to task (``_coder``).
    """

    def __init__(self, path: str, with_ids: bool):
        self.library, self.with_ids = _library(path), with_ids
        self._clear()

    def _clear(self) -> None:
        self.signs = 0
        self.lengths = self.starts = self.seen = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)
        self.index = _Index()

    def _weights(self) -> np.ndarray:
        """Signs and ids of each piece."""
        return pa.compute.utf8_length(self.index.strings).to_numpy() + self.lengths

    def _forget(self) -> None:
        share = np.maximum(self._weights(), MEMORY_SIGNS // MEMORY_PIECES)
        kept = frequent(self.seen, share, MEMORY_SIGNS // 2)
        self.index.keep(kept)
        if self.with_ids:
            self.flat = self.flat[runs_at(self.starts[kept], self.lengths[kept])]
        self.lengths, self.seen = self.lengths[kept], self.seen[kept] // 2
        self.starts, self.signs = np.cumsum(self.lengths) - self.lengths, int(self._weights().sum())

    def _pieces(self, text: str) -> list[str]:
        """Of one text, whatever it holds; joined they give it back."""
        if not self.library.cuts:
            return [text]
        # The first part of a long piece follows a space if the piece does, the others follow a letter.
        out = []
        for before, piece in zip(itertools.chain([""], itertools.repeat(" ")), pieces(text)):
            head, *tail = self.library.parts(piece)
            out += [before + head, *tail]
        return out

    def _number(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(piece numbers of texts one after the other, how many of each). Different pieces are looked up once, new ones
        learnt; texts that are not cut at each space, or hold a long piece, are taken one by one."""
        strings = texts.to_pylist()
        odd = np.array([bool(text) and (not self.library.cuts or bool(_RUN.search(text))) for text in strings], bool)
        strings = {i: strings[i] for i in np.flatnonzero(odd).tolist()}
        names, index, sizes = cut_at_spaces(pa.compute.if_else(pa.array(odd), "", texts) if odd.any() else texts)
        if max(map(len, names)) >= LONG_PIECE:
            long = np.array([len(name) >= LONG_PIECE for name in names], bool)
            odd |= np.logical_or.reduceat(long[index], np.cumsum(sizes) - sizes)
            names, index, sizes = cut_at_spaces(pa.compute.if_else(pa.array(odd), "", texts))
        starts = np.cumsum(sizes) - sizes
        later = np.ones(len(index), bool)
        later[starts] = False
        used = np.zeros(len(names), bool)
        used[index[later]] = True
        asked = [" " + name for name in itertools.compress(names, used)]
        place = np.cumsum(used) - 1
        numbers = place[index]
        numbers[starts] = np.arange(len(asked), len(asked) + len(starts))
        asked += [names[i] for i in index[starts].tolist()]
        if odd.any():
            found, local = np.split(numbers, starts[1:]), {}
            for i in np.flatnonzero(odd).tolist():
                own = self._pieces(strings[i] if i in strings else texts[i].as_py())
                found[i] = np.array([local.setdefault(piece, len(asked) + len(local)) for piece in own], np.int64)
            asked += local
            numbers, sizes = np.concatenate(found), np.array([len(x) for x in found], np.int64)
        known, new = self.index.numbers(asked)
        self._learn(new)
        return known[numbers], sizes

    def _learn(self, new: list[str]) -> None:
        flat, lengths = self.library.encode(new)
        self.signs += sum(map(len, new)) + len(flat)
        self.seen = np.concatenate([self.seen, np.zeros(len(new), np.int64)])
        self.lengths = np.concatenate([self.lengths, lengths])
        if self.with_ids:
            self.flat = np.concatenate([self.flat, flat])
        self.starts = np.cumsum(self.lengths) - self.lengths

    def batches(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(piece numbers of some texts one after the other, how many of each text), about ``STEP_BYTES`` of text at a
        time; the lengths and ids of these pieces are known then."""
        upto = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.binary_length(texts), 0)).astype(np.int64))
        for at, end in _steps(upto, 0, len(texts), CUT_BYTES):
            numbers, sizes = self._number(texts.slice(at, end - at))
            places = np.concatenate([[0], np.cumsum(sizes)])
            for a, b in _steps(upto, at, end, STEP_BYTES):
                yield numbers[places[a - at]:places[b - at]], sizes[a - at:b - at]
            if not self.library.cuts:
                self._clear()
                continue
            self.seen += np.bincount(numbers, minlength=len(self.seen))
            if self.signs > MEMORY_SIGNS or len(self.lengths) > MEMORY_PIECES:
                self._forget()
            pa.default_memory_pool().release_unused()


def _steps(upto: np.ndarray, at: int, last: int, size: int) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts that reach a size, by the sizes of all texts up to each."""
    while at < last:
        end = min(int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size)) + 1, last)
        yield at, end
        at = end


@functools.lru_cache(maxsize=2)
def _coder(path: str, with_ids: bool) -> PieceCoder:
    return PieceCoder(path, with_ids)


def _totals(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums over runs of values, 0 for empty runs."""
    sums = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(sizes)
    return sums[ends] - sums[ends - sizes]


def token_count(path: str, text: Column) -> Column:
    """Number of tokens of a whole text; 0 for null and the empty text.

    ``path``: a ``.json`` file of the tokenizers library or a ``.model`` file of sentencepiece, at the same place on
    every machine. No begin, end or added special tokens; special strings inside texts as the library does by default.
    """

    @arrow_udf("bigint")
    def count(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _coder(path, False)
        for texts in arrays:
            out = [_totals(coder.lengths[numbers], sizes) for numbers, sizes in coder.batches(texts)]
            yield pa.array(np.concatenate(out) if out else [], pa.int64())

    return count(text)


def encode_texts(path: str, texts: pa.Array, end: int | None = None) -> Iterator[pa.Array]:
    """Lists of token ids of whole texts in their order, some megabytes of text at a time."""
    coder = _coder(path, True)
    for numbers, pieces_of in coder.batches(texts):
        lengths = coder.lengths[numbers]
        ids = coder.flat[runs_at(coder.starts[numbers], lengths)]
        tokens = _totals(lengths, pieces_of)
        if end is not None:
            ids, tokens = np.insert(ids, np.cumsum(tokens), end), tokens + 1
        offsets = pa.array(np.concatenate([[0], np.cumsum(tokens)]), pa.int32())
        yield pa.ListArray.from_arrays(offsets, pa.array(ids, pa.int32()))


def token_ids(path: str, text: Column, end: int | None = None) -> Column:
    """Token ids of a whole text, with ``end`` after them if given. As ``token_count`` in all else."""

    @arrow_udf("array<int>")
    def encode(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in arrays:
            yield pa.concat_arrays([pa.array([], pa.list_(pa.int32())), *encode_texts(path, texts, end)])

    return encode(text)


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of token ids written as little-endian unsigned 32-bit integers; 0 for null and no ids."""

    @arrow_udf("bigint")
    def digest(lists: pa.Array) -> pa.Array:
        values = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
        ends = np.cumsum(np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0)))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        return pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(starts, ends)], pa.int64())

    return digest(ids)


def with_token_counts(df: DataFrame, path: str, limit: int, text: str = "text") -> DataFrame:
    """Add ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens). Columns of these names
    are replaced, all others kept; null texts count as empty, repeated rows are counted each, an empty table stays empty."""
    whole = F.coalesce(quoted(text), F.lit(""))
    out = df.withColumns({"n_bytes": F.octet_length(whole).cast("long"), "n_tokens": token_count(path, whole)})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
