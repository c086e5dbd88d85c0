"""SentencePiece encoding with the n best segmentations, and decoding.

The lattice of a text has an edge for each vocabulary piece that stands in it, weighted with the score in the model
file; a sign that is no piece becomes its UTF-8 bytes. The best segmentations are the paths with the highest sums. A
forward Viterbi pass gives the best sum up to each place; a backward A* search from the end takes these sums as its
estimate of what is left, which is exact, so paths come out best first and nothing is expanded in vain.

No piece runs from another sign into a space, so a text is a chain of independent units, "spaces and what follows".
Each different unit is searched once. A text's n best differ from its best path in at most n - 1 units, those whose
second best is nearest to their best; only there does the backward search run.
"""

from __future__ import annotations

import functools
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StructType

from cohortloom.llm.chunks import frequent, runs_at

SPACE = "▁"
# Units of at most this many signs are searched many at a time; memory of one such search; signs remembered.
_SHORT, _BATCH_CELLS, _MEMORY = 64, 1 << 20, 3 << 20
_UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")


class Lattice:
    """The pieces of a model, and the search over one unit or many of equal length."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        special = [model.is_byte(i) or model.is_control(i) or model.is_unknown(i) for i in range(len(names))]
        self.scores = {p: model.get_score(i) for i, p in enumerate(names) if not special[i]}
        self.ids = {p: i for i, p in enumerate(names) if not special[i]}
        self.bytes = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # Runs of spaces carry a mark, not a rank; the worst rank less ten makes bytes the last resort.
        self.byte_score = min((v for p, v in self.scores.items() if p.strip(SPACE)), default=0.0) - 10.0
        self.longest = max(map(len, self.scores), default=1)
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces of this model run from a sign into a space")
        self.pairs = {p[i:i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.texts = piece_texts(path)
        self._grow_tree()

    def _grow_tree(self) -> None:
        """The pieces as a tree of signs: sorted (node, sign) keys, their child nodes, and the piece ending there."""
        signs = sorted({c for p in self.ids for c in p})
        self.sign = np.full(0x110000, -1, np.int32)
        self.sign[[ord(c) for c in signs]] = np.arange(len(signs))
        self.width, children, ends = len(signs), {}, [(-1, 0.0)]
        for piece, i in self.ids.items():
            node = 0
            for c in piece:
                key = node * self.width + int(self.sign[ord(c)])
                if key not in children:
                    children[key] = len(ends)
                    ends.append((-1, 0.0))
                node = children[key]
            ends[node] = (i, self.scores[piece])
        order = sorted(children)
        self.keys = np.array([*order, 2**62], np.int64)
        self.child = np.array([*(children[k] for k in order), 0], np.int64)
        self.end_id = np.array([i for i, _ in ends], np.int32)
        self.end_score = np.array([s for _, s in ends])

    def fallback(self, sign: str) -> list[int]:
        return [self.bytes[b] for b in sign.encode()]

    def edges_to(self, unit: str, end: int) -> Iterator[tuple[int, float]]:
        """(start, score) of the edges that end there, longest piece first."""
        for start in range(max(0, end - self.longest), end):
            score = self.scores.get(unit[start:end])
            if score is not None:
                yield start, score
            elif start == end - 1:
                yield start, self.byte_score * len(unit[start].encode())

    def best_sums(self, unit: str) -> list[float]:
        best = [0.0]
        for end in range(1, len(unit) + 1):
            best.append(max(best[start] + score for start, score in self.edges_to(unit, end)))
        return best

    def path_ids(self, unit: str, cuts: list[int]) -> list[int]:
        out = []
        for a, b in zip(cuts, cuts[1:]):
            found = self.ids.get(unit[a:b])
            out += [found] if found is not None else self.fallback(unit[a:b])
        return out

    def n_best(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """(score, ids) of the n best paths, best first; of equal ones that with the longer last pieces first.

        Of equal sums the one nearest to the start goes on first, so equal paths are finished one after the other. A
        place is gone through n times at most: each of the n best paths ends, from there on, in one of the n best ends.
        """
        forward, out, arrivals = self.best_sums(unit), [], [0] * (len(unit) + 1)
        heap, count = [(-forward[-1], len(unit), 0, 0.0, None)], 0
        while heap and len(out) < n:
            bound, place, _, behind, path = heapq.heappop(heap)
            if arrivals[place] == n:
                continue
            arrivals[place] += 1
            if not place:
                cuts = [0]
                while path:
                    cuts.append(path[0])
                    path = path[1]
                out.append((-bound, self.path_ids(unit, cuts)))
                continue
            for start, score in self.edges_to(unit, place):
                count += 1
                heapq.heappush(heap, (-(forward[start] + score + behind), start, count, behind + score, (place, path)))
        return out

    def search_many(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Best sum, gap to the second best (infinite if there is none) and best ids of units of one length."""
        size, many = len(units[0]), len(units)
        codes = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).reshape(many, size).astype(np.int64)
        signs = self.sign[codes].astype(np.int64)
        wide = min(self.longest, size)
        score = np.full((wide + 1, size, many), -np.inf)
        piece = np.full((wide + 1, size, many), -1, np.int32)
        octets = 1 + (codes >= 0x80) + (codes >= 0x800) + (codes >= 0x10000)
        for start in range(size):
            rows, node = np.arange(many), np.zeros(many, np.int64)
            for length in range(1, min(wide, size - start) + 1):
                sign = signs[rows, start + length - 1]
                rows, node, sign = rows[sign >= 0], node[sign >= 0], sign[sign >= 0]
                key = node * self.width + sign
                at = np.searchsorted(self.keys, key)
                hit = self.keys[at] == key
                rows, node = rows[hit], self.child[at[hit]]
                if not len(rows):
                    break
                ends = self.end_id[node] >= 0
                piece[length, start, rows[ends]] = self.end_id[node[ends]]
                score[length, start, rows[ends]] = self.end_score[node[ends]]
        lone = piece[1] < 0
        score[1][lone] = (self.byte_score * octets.T)[lone]

        ahead, last = np.full((size + 1, many), -np.inf), np.zeros((size + 1, many), np.int8)
        ahead[0] = 0
        for end in range(1, size + 1):
            for length in range(min(wide, end), 0, -1):
                sums = ahead[end - length] + score[length, end - length]
                better = sums > ahead[end]
                ahead[end][better] = sums[better]
                last[end][better] = length
        behind = np.full((size + 1, many), -np.inf)
        behind[size] = 0
        for start in range(size - 1, -1, -1):
            for length in range(1, min(wide, size - start) + 1):
                np.maximum(behind[start], score[length, start] + behind[start + length], out=behind[start])

        best, place, everyone, steps = ahead[size].copy(), np.full(many, size), np.arange(many), []
        while (place > 0).any():
            length = np.where(place > 0, last[place, everyone], 0)
            start = place - length
            on = length > 0
            found = piece[length, np.minimum(start, size - 1), everyone]
            steps.append(np.where(on, np.where(found < 0, -3 - start, found), -2).astype(np.int32))
            score[length[on], start[on], everyone[on]] = -np.inf  # what is left are the edges off the best path
            place = start
        second = np.full(many, -np.inf)
        for length in range(1, wide + 1):
            through = ahead[: size + 1 - length] + score[length, : size + 1 - length] + behind[length:]
            np.maximum(second, through.max(axis=0), out=second)
        path = np.stack(steps[::-1], axis=1)
        flat, ends = path[path != -2], np.cumsum((path != -2).sum(1)).tolist()
        ids = [flat[a:b] for a, b in zip([0, *ends], ends)]
        for i in np.flatnonzero((path <= -3).any(1)):
            parts = [self.fallback(units[i][-3 - k]) if k <= -3 else [k] for k in ids[i].tolist()]
            ids[i] = np.array(sum(parts, []), np.int32)
        return best, best - second, ids


@functools.lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


@functools.lru_cache(maxsize=2)
def piece_texts(path: str) -> list[bytes]:
    """The text of each piece in UTF-8; pieces that stand for no text are empty."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = []
    for i in range(model.get_piece_size()):
        name = model.id_to_piece(i)
        if model.is_byte(i):
            texts.append(bytes([int(name[3:5], 16)]))
        else:
            texts.append(b"" if model.is_control(i) or model.is_unknown(i) else name.replace(SPACE, " ").encode())
    return texts


def units(text: str) -> tuple[list[str], bool]:
    """The units of a text that is not empty, and whether the space that starts each is left out."""
    if text[0] != " " and "  " not in text and SPACE not in text:
        return text.split(" "), True
    return _UNIT.findall(SPACE + text.replace(" ", SPACE)), False


class _Numbers(dict):
    """Numbers of units by what follows their first sign, a space, or of parts of units as they are."""

    def __init__(self, known: _Known, spaced: bool):
        self.known, self.spaced = known, spaced

    def __missing__(self, key: str) -> int:
        self[key] = n = len(self.known.names)
        self.known.names.append(key)
        self.known.spaced.append(self.spaced)
        return n


class _Known:
    """What is known of the units met so far, but for rare ones when that becomes too much."""

    def __init__(self, tree: Lattice, n: int):
        self.tree, self.n = tree, n
        self.names: list[str] = []
        self.spaced = bytearray()
        self.units, self.parts = _Numbers(self, True), _Numbers(self, False)
        self.best = np.empty(0)
        self.gap = np.empty(0)
        self.counts = self.starts = self.seen = np.empty(0, np.int64)
        self.flat = np.empty(0, np.int32)
        self.others: dict[int, list[tuple[float, list[int]]]] = {}
        self.size = 0

    def forget(self) -> None:
        """Keep the most frequent units in half of the memory."""
        weights = np.array(list(map(len, self.names)), np.int64) + np.frombuffer(self.spaced, np.uint8) + 8
        kept = frequent(self.seen, weights, _MEMORY // 2)
        names, spaced, number = self.names, self.spaced, kept.tolist()
        self.flat = self.flat[runs_at(self.starts[kept], self.counts[kept])]
        self.best, self.gap, self.counts, self.seen = self.best[kept], self.gap[kept], self.counts[kept], self.seen[kept] // 2
        self.starts, self.size = np.cumsum(self.counts) - self.counts, int(weights[kept].sum())
        self.others = {new: self.others[old] for new, old in enumerate(number) if old in self.others}
        self.names, self.spaced = [names[i] for i in number], bytearray(spaced[i] for i in number)
        self.units.clear()
        self.parts.clear()
        for new, (name, space) in enumerate(zip(self.names, self.spaced)):
            dict.__setitem__(self.units if space else self.parts, name, new)

    def name(self, number: int) -> str:
        return SPACE + self.names[number] if self.spaced[number] else self.names[number]

    def numbers(self, text: str | None) -> np.ndarray:
        if not text:
            return np.empty(0, np.int64)
        found, bare = units(text)
        if not bare:
            found = [unit[1:] for unit in found]
        if max(map(len, found)) < _SHORT:
            return np.array(list(map(self.units.__getitem__, found)), np.int64)
        out = []
        for key in found:
            head, *tail = self._apart(SPACE + key) if len(key) >= _SHORT else [SPACE + key]
            out.append(self.units[head[1:]])
            out += map(self.parts.__getitem__, tail)
        return np.array(out, np.int64)

    def _apart(self, unit: str) -> list[str]:
        """A long unit cut between signs that no piece has side by side."""
        cuts = [i for i in range(1, len(unit)) if unit[i - 1:i + 1] not in self.tree.pairs]
        return [unit[a:b] for a, b in zip([0, *cuts], [*cuts, len(unit)])]

    def learn(self) -> None:
        new = range(len(self.counts), len(self.names))
        best, gap, ids = np.zeros(len(new)), np.zeros(len(new)), [None] * len(new)
        by_length: dict[int, list[int]] = {}
        for i in new:
            signs = len(self.names[i]) + self.spaced[i]
            by_length.setdefault(signs, []).append(i)
            self.size += signs + 8
        for length, members in by_length.items():
            if length > _SHORT:
                for i in members:
                    two = self.tree.n_best(self.name(i), 2)
                    k = i - new.start
                    best[k], ids[k] = two[0][0], np.array(two[0][1], np.int32)
                    gap[k] = two[0][0] - two[1][0] if len(two) > 1 else np.inf
                continue
            step = max(1, _BATCH_CELLS // (length * min(length, self.tree.longest)))
            for a in range(0, len(members), step):
                part = members[a:a + step]
                found = self.tree.search_many([self.name(i) for i in part])
                at = np.array(part) - new.start
                best[at], gap[at] = found[0], found[1]
                for k, x in zip(at.tolist(), found[2]):
                    ids[k] = x
        self.best, self.gap = np.append(self.best, best), np.append(self.gap, gap)
        self.flat = np.concatenate([self.flat, *ids]).astype(np.int32)
        self.counts = np.append(self.counts, np.array([len(x) for x in ids], np.int64))
        self.seen = np.append(self.seen, np.zeros(len(new), np.int64))
        self.starts = np.cumsum(self.counts) - self.counts

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        """Ids of the best paths of units one after the other."""
        return self.flat[runs_at(self.starts[numbers], self.counts[numbers])]

    def paths(self, numbers: np.ndarray) -> list[tuple[float, list[tuple[int, int, list[int]]]]]:
        """The n best paths of a text as (score, changes to the best path: start, length, ids)."""
        gaps = self.gap[numbers]
        k = min(self.n - 1, len(gaps))
        near = np.sort(np.argsort(gaps, kind="stable")[:k])
        starts = np.cumsum(self.counts[numbers]) - self.counts[numbers]
        found = [(0.0, [])]
        for place in near.tolist():
            number = int(numbers[place])
            if number not in self.others:
                self.others[number] = self.tree.n_best(self.name(number), self.n)
            ways = self.others[number]
            options = [(score - ways[0][0], [(int(starts[place]), int(self.counts[number]), ids)] if r else []) for r, (score, ids) in enumerate(ways)]
            both = [(a + b, x + y) for a, x in found for b, y in options]
            found = sorted(both, key=lambda p: -p[0])[: self.n]
        total = float(self.best[numbers].sum())
        return [(total + less, changes) for less, changes in found]


ADDED = (
    "ids array<int>, score double, "
    "others array<struct<score: double, changes: array<struct<start: int, length: int, ids: array<int>>>>>"
)


@functools.lru_cache(maxsize=1)
def _memory(path: str, n: int) -> _Known:
    """What a worker knows, kept from task to task."""
    return _Known(lattice(path), n)


def encode_texts(path: str, n: int, texts: pa.Array) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """(ids, score, others) of whole texts in their order, about a megabyte of text at a time."""
    change = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])
    other = pa.struct([("score", pa.float64()), ("changes", pa.list_(change))])
    known, waiting, size = _memory(path, n), [], 0
    for at, text in enumerate(texts):
        text = text.as_py()
        waiting.append(known.numbers(text))
        size += len(text or "")
        if size < 1 << 20 and at < len(texts) - 1:
            continue
        known.learn()
        sizes, scores, others = [0], [], []
        for numbers in waiting:
            found = known.paths(numbers)
            sizes.append(int(known.counts[numbers].sum()))
            scores.append(found[0][0])
            others.append([{"score": s, "changes": [{"start": a, "length": b, "ids": x} for a, b, x in c]} for s, c in found[1:]])
        everything = np.concatenate(waiting)
        ids = known.ids(everything)
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), pa.array(ids, pa.int32()))
        yield lists, pa.array(scores, pa.float64()), pa.array(others, pa.list_(other))
        waiting, size = [], 0
        known.seen += np.bincount(everything, minlength=len(known.seen))
        if known.size > _MEMORY:
            known.forget()


def other_ids(ids: list[int], changes: list[tuple[int, int, list[int]]]) -> list[int]:
    """The ids of another segmentation."""
    out, place = [], 0
    for start, length, new in changes:
        out += [*ids[place:start], *new]
        place = start + length
    return out + ids[place:]


def decode_ids(path: str, ids: Column) -> Column:
    """The text of ids: pieces joined, bytes put together, and the space that encoding put in front taken away. Bytes
    that are no UTF-8 become U+FFFD. Null gives null, no ids the empty text."""

    @arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        texts, out = piece_texts(path), []
        ends = lists.offsets.to_numpy().tolist()
        for valid, a, b in zip(lists.is_valid().to_pylist(), ends, ends[1:]):
            if not valid:
                out.append(None)
                continue
            joined = b"".join(map(texts.__getitem__, lists.values[a:b].to_numpy(zero_copy_only=False).tolist()))
            out.append(joined.removeprefix(b" ").decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return decode(ids)


def with_pieces(df: DataFrame, path: str, n: int = 3, text: str = "text") -> DataFrame:
    """Add the n best segmentations of each whole text, replacing columns of these names: ``ids`` and ``score`` of the
    best, and ``others`` in falling order of score, each as the places in ``ids`` that it changes (``other_ids`` writes
    them out).

    Null and empty texts have no ids, score 0 and no others. A text with fewer than n segmentations has fewer others.
    Repeated rows are each encoded; the table may be empty. ``path``: a sentencepiece model at the same place on every
    machine. Memory is bounded by the units remembered, one batch of about a megabyte of text, and the longest text.
    """
    rows = df.drop("ids", "score", "others")
    place = rows.columns.index(text)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for found in encode_texts(path, n, batch.column(place)):
                part = batch.slice(at, len(found[0]))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], [*batch.schema.names, "ids", "score", "others"])
                at += part.num_rows

    return rows.mapInArrow(encode, StructType(rows.schema.fields + StructType.fromDDL(ADDED).fields))
