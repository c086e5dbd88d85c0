"""Language-model scores by Brown's class-based bigrams, with exchange clustering."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from cohortloom.functions.exprs import quoted
from cohortloom.llm.chunks import Numbers, as_binary, chunks, from_binary
from cohortloom.llm.words import words
from cohortloom.session import release, settle

# Counts added to a class's row in proportion to how common each next class is.
PRIOR = 10.0
# Signs of text whose words are counted at a time within a chunk: lists of words and their sorted pairs take many times
# the room of their text.
SLAB_SIGNS = 2 << 20


def _n_log_n(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(pairs: np.ndarray, classes: int, movable: int, sweeps: int = 10) -> np.ndarray:
    """A class for each symbol of a square table of neighbour counts.

    The first ``movable`` symbols start in turn in ``classes`` classes; each of the others keeps a class of its own after
    those. In each sweep every movable symbol goes to the class that raises the likelihood of the class bigrams most,
    given where all others are, until none moves. Equal gains go to the lower class.
    """
    n = len(pairs)
    own = np.concatenate([np.arange(movable) % classes, classes + np.arange(n - movable)])
    total = classes + n - movable
    member = np.zeros((n, total))
    member[np.arange(n), own] = 1
    to, fro = pairs @ member, pairs.T @ member  # symbol x class
    table = member.T @ to
    for _ in range(sweeps):
        moved = 0
        for w in range(movable):
            a, right, left, self_ = own[w], to[w], fro[w], pairs[w, w]
            if not right.any() and not left.any():
                continue
            # The table without the symbol; its own repeats are in both its row and its column.
            table[a] -= right
            table[:, a] -= left
            table[a, a] += self_
            right, left = right.copy(), left.copy()
            right[a] -= self_
            left[a] -= self_
            rows, columns = table.sum(1), table.sum(0)
            gain = (_n_log_n(table[:classes] + right) - _n_log_n(table[:classes])).sum(1)
            gain += (_n_log_n(table[:, :classes] + left[:, None]) - _n_log_n(table[:, :classes])).sum(0)
            both = np.arange(classes)
            cell = table[both, both]
            # The cell of a class with itself takes both parts and the repeats at once.
            gain -= _n_log_n(cell + right[both]) + _n_log_n(cell + left[both]) - 2 * _n_log_n(cell)
            gain += _n_log_n(cell + right[both] + left[both] + self_) - _n_log_n(cell)
            out, into = right.sum() + self_, left.sum() + self_
            gain -= _n_log_n(rows[:classes] + out) - _n_log_n(rows[:classes])
            gain -= _n_log_n(columns[:classes] + into) - _n_log_n(columns[:classes])
            best = int(np.argmax(gain > gain.max() - 1e-9))
            b = best if gain[best] > gain[a] + 1e-9 else a
            table[b] += right
            table[:, b] += left
            table[b, b] += self_
            if b != a:
                own[w], moved = b, moved + 1
                to[:, a] -= pairs[:, w]
                to[:, b] += pairs[:, w]
                fro[:, a] -= pairs[w]
                fro[:, b] += pairs[w]
        if not moved:
            break
    return own


class ClassScorer:
    """Log10 probabilities from counts of class pairs, words per class and words met once per class.

    A word has probability P(class | class before) (1 - u) count / words of the class, where u is the class's share for
    words never met, after the words it met once; an unknown word has the sum of P(class | class before) u. The
    probabilities of all known words and the unknown one add up to 1 after any class.
    """

    def __init__(self, pairs: np.ndarray, size: np.ndarray, once: np.ndarray, end: int):
        share = size / max(size.sum(), 1)
        next_class = (pairs + PRIOR * share) / (pairs.sum(1, keepdims=True) + PRIOR)
        # After an unknown word: how common each class is.
        next_class = np.vstack([next_class, share])
        unseen = (once + 0.5) / (size + 1)
        unseen[end] = 0
        with np.errstate(divide="ignore"):
            self.known = np.log10(next_class) + np.log10((1 - unseen) / np.maximum(size, 1))
            self.unknown = np.log10(np.maximum(next_class @ unseen, 1e-300))
        self.end = end

    def score(self, sequence: np.ndarray, count_logs: float) -> float:
        """Of a text's classes, the end last, unknown words the number after the last class."""
        before = np.concatenate([[self.end], sequence[:-1]])
        unknown = sequence == self.known.shape[1]
        known = self.known[before[~unknown], sequence[~unknown]].sum()
        return float(known + self.unknown[before[unknown]].sum() + count_logs)


def _write_chunks(docs: DataFrame) -> DataFrame:
    """Two kinds of rows: texts as numbers of their chunk's words (``numbers``), and the words with their number and
    their count in learning texts (``word``)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in chunks(batches):
            known, texts, learned = Numbers(), [], [np.empty(0, np.int32)]
            for row in rows:
                # Texts go as their numbers come.
                numbers = np.array([known[w] for w in words(row.pop("text"))], np.int32)
                texts.append(as_binary(numbers))
                if row["learn"]:
                    learned.append(numbers)
            n, m = len(rows), len(known)
            counts = np.zeros(m, np.int64)
            for part in learned:
                found, times = np.unique(part, return_counts=True)
                counts[found] += times
            yield pa.RecordBatch.from_pydict({
                "chunk": pa.array([chunk] * n, pa.int64()), "doc_id": pa.array([r["doc_id"] for r in rows], pa.int64()),
                "learn": pa.array([r["learn"] for r in rows], pa.bool_()), "numbers": pa.array(texts, pa.binary()),
                "number": pa.nulls(n, pa.int32()), "word": pa.nulls(n, pa.string()), "count": pa.nulls(n, pa.int64()),
            })
            names = iter(known)
            for a in range(0, m, 100_000):
                k = min(100_000, m - a)
                yield pa.RecordBatch.from_pydict({
                    "chunk": pa.array(np.full(k, chunk), pa.int64()), "doc_id": pa.nulls(k, pa.int64()), "learn": pa.nulls(k, pa.bool_()),
                    "numbers": pa.nulls(k, pa.binary()), "number": pa.array(np.arange(a, a + k), pa.int32()),
                    "word": pa.array([w.decode() for w in itertools.islice(names, k)], pa.string()), "count": pa.array(counts[a:a + k], pa.int64()),
                })

    schema = "chunk long, doc_id long, learn boolean, numbers binary, number int, word string, count long"
    return settle(docs.mapInArrow(read, schema))


def _streams(rows: list[dict], end: int, code: Callable[[list[bytes]], list[int]]) -> Iterator[np.ndarray]:
    """Codes of the words of some texts one after the other, ``end`` before and after each text; about ``SLAB_SIGNS`` of
    text at a time. The texts are taken out of the rows."""
    parts, size = [np.array([end], np.int32)], 0
    for row in rows:
        text = row.pop("text")
        parts.append(np.array([*code(words(text)), end], np.int32))
        size += len(text or "")
        if size >= SLAB_SIGNS:
            yield np.concatenate(parts)
            parts, size = [np.array([end], np.int32)], 0
    if len(parts) > 1:
        yield np.concatenate(parts)


def _common_pairs(docs: DataFrame, common: list[str]) -> np.ndarray:
    """Neighbour counts in the learning texts of the common words, all other words as one (number n) and the end (n + 1).

    The end also stands before the first word. At most (n + 2) squared counts reach the driver, whatever the corpus.
    """
    n = len(common)
    place = {w.encode(): i for i, w in enumerate(common)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((n + 2) ** 2, np.int64)
        for _, rows in chunks(batches, size=SLAB_SIGNS):
            for symbols in _streams(rows, n + 1, lambda found: [place.get(w, n) for w in found]):
                codes, times = np.unique(symbols[:-1].astype(np.int64) * (n + 2) + symbols[1:], return_counts=True)
                sums[codes] += times
        codes = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(codes), pa.array(sums[codes])], ["code", "times"])

    learning = docs.where("learn").select("text")
    counts = learning.mapInArrow(count, "code long, times long").groupBy("code").agg(F.sum("times").alias("times"))
    found = counts.toArrow()
    pairs = np.zeros((n + 2) ** 2)
    pairs[found["code"].to_numpy()] = found["times"].to_numpy()
    return pairs.reshape(n + 2, n + 2)


def _other_classes(docs: DataFrame, common: list[str], own: np.ndarray, pairs: np.ndarray, classes: int) -> DataFrame:
    """``word, class`` of the words that are not common: one exchange step of each against the classes of the common words.

    A word goes to the class whose members most often stand next to the classes it stands next to; a word without a
    common neighbour goes to class ``classes``.
    """
    n = len(common)
    end = classes + 1
    # Classes are negative, so that they are told from the numbers of other words.
    sign_of = {w.encode(): -1 - int(c) for w, c in zip(common, own)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in chunks(batches):
            known = Numbers()
            codes, times = np.empty(0, np.int64), np.empty(0, np.int64)
            for stream in _streams(rows, -1 - end, lambda found: [sign_of[w] if w in sign_of else known[w] for w in found]):
                after, before = np.flatnonzero((stream[1:] >= 0) & (stream[:-1] < 0)), np.flatnonzero((stream[:-1] >= 0) & (stream[1:] < 0))
                here = np.concatenate([stream[after + 1], stream[before]]).astype(np.int64)
                beside = np.concatenate([stream[after], stream[before + 1]])
                found, seen_here = np.unique(here * (end + 1) - 1 - beside, return_counts=True)
                every, back = np.unique(np.concatenate([codes, found]), return_inverse=True)
                sums = np.zeros(len(every), np.int64)
                np.add.at(sums, back, np.concatenate([times, seen_here]))
                codes, times = every, sums
            word = codes // (end + 1)
            starts = np.searchsorted(word, np.arange(len(known) + 1)).astype(np.int32)
            names = iter(known)
            for a in range(0, len(known), 100_000):
                b = min(a + 100_000, len(known))
                lo, hi = starts[a], starts[b]
                near = pa.ListArray.from_arrays(pa.array(starts[a:b + 1] - lo), pa.array(times[lo:hi] * (end + 1) + codes[lo:hi] % (end + 1)))
                yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in itertools.islice(names, b - a)], pa.string()), near], ["word", "near"])

    # A neighbour's class and how often it was met, in one number.
    seen = docs.where("learn").select("text").mapInArrow(look, "word string, near array<long>")
    # One shuffle: rows of a word meet, then its neighbours are summed where they are. At most classes + 2 per word.
    met = seen.repartition("word").select("word", F.explode_outer("near").alias("x"))
    met = met.select("word", (F.col("x") % (end + 1)).cast("int").alias("beside"), F.expr(f"x div {end + 1}").alias("times"))
    summed = met.groupBy("word", "beside").agg(F.sum("times").alias("times"))
    near = summed.groupBy("word").agg(F.collect_list(F.when(F.col("beside").isNotNull(), F.struct("beside", "times"))).alias("near"))

    member = np.zeros((n + 2, end + 1))
    member[np.arange(n), own[:n]] = 1
    member[n + 1, end] = 1
    table = member.T @ pairs @ member
    both = table + table.T
    with np.errstate(divide="ignore"):
        fit = np.log((both[:, :classes] + 0.5) / (both.sum(0)[:classes] + 0.5 * (end + 1)))

    @arrow_udf("int")
    def best(lists: pa.Array) -> pa.Array:
        sizes = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy()
        flat = lists.flatten()
        score = np.zeros((len(lists), classes))
        of = np.repeat(np.arange(len(lists)), sizes)
        if len(flat):
            np.add.at(score, of, fit[flat.field("beside").to_numpy()] * flat.field("times").to_numpy()[:, None])
        return pa.array(np.where(sizes > 0, score.argmax(1), classes).astype(np.int32))

    return near.select("word", best("near").alias("class"))


def score_texts(
    docs: DataFrame, learn: Column, classes: int = 32, common_words: int = 2048, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Log10 probabilities of whole texts; learns from the rows where ``learn`` is true.

    Gives ``doc_id, learned, n_tokens, n_known, train_tokens, base_score, score`` for each row. A text's tokens are its
    words and one end; null and empty texts have the end only. ``base_score``: words counted alone, one added to each
    count and to that of unknown words. ``score``: the class-based model. Without a learning row both are 0. Repeated
    rows are learned from and scored each; a null ``learn`` is false; other columns are not used.

    Every word of the corpus is counted and has a class. The ``common_words`` most frequent words are clustered by
    exchange on their neighbour counts over all learning texts, a table of fixed size; every other word then makes one
    exchange step against them. Counts and classes reach the texts by a join on one row per chunk and word.
    """
    rows = docs.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    written = _write_chunks(rows)
    listed = written.where("word IS NOT NULL").select("chunk", "number", "word", "count")
    counts = settle(listed.where("count > 0").groupBy("word").agg(F.sum("count").alias("n")))
    n_words, n_types = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    n_texts = written.where("word IS NULL AND learn").count()
    train_tokens, types = n_words + n_texts, n_types + (n_texts > 0)

    # At most common_words rows, so the driver may hold them.
    common = [r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(common_words).collect()]
    pairs = _common_pairs(rows, common)
    # All other words and the end keep classes of their own.
    own = exchange(pairs, classes, len(common))[: len(common)]
    place = docs.sparkSession.createDataFrame(
        pa.table({"word": pa.array(common, pa.string()), "class": pa.array(own.astype(np.int32))}).to_pandas(), "word string, class int"
    )
    known = settle(_other_classes(rows, common, own, pairs, classes).union(place))
    vocabulary = settle(counts.join(known, "word"))
    release(docs.sparkSession)

    end, unknown = classes + 1, classes + 2
    kind = np.min_scalar_type(unknown)  # a byte per word up to 253 classes, two beyond
    by_class = {r["class"]: (r["n"], r["once"]) for r in vocabulary.groupBy("class").agg(F.sum("n").alias("n"), F.sum((F.col("n") == 1).cast("long")).alias("once")).collect()}
    size = np.array([float(by_class.get(c, (0, 0))[0]) for c in range(unknown)])
    once = np.array([float(by_class.get(c, (0, 0))[1]) for c in range(unknown)])
    size[end] = n_texts

    named = listed.select("chunk", "number", "word").join(vocabulary, "word").select(F.col("chunk").alias("in_chunk"), "number", "n", "class")

    def place_texts(key, texts: pa.Table, found: pa.Table) -> pa.Table:
        numbers = found["number"].to_numpy()
        top = int(numbers.max()) + 1 if len(numbers) else 0
        data = [from_binary(x) for x in texts["numbers"].to_pylist()]
        top = max([top, *(int(d.max()) + 1 for d in data if len(d))])
        n, cls = np.zeros(top, np.int64), np.full(top, unknown, kind)
        n[numbers], cls[numbers] = found["n"].to_numpy(), found["class"].to_numpy()
        plus, alone = np.log10(n + 1.0), np.log10(np.maximum(n, 1))
        return pa.table({
            "doc_id": texts["doc_id"], "learn": texts["learn"],
            "n_tokens": pa.array([len(d) + 1 for d in data], pa.int64()),
            "n_known": pa.array([int(np.count_nonzero(n[d])) + (n_texts > 0) for d in data], pa.int64()),
            "plus": pa.array([float(plus[d].sum()) + math.log10(n_texts + 1) for d in data], pa.float64()),
            "alone": pa.array([float(alone[d].sum()) + math.log10(max(n_texts, 1)) for d in data], pa.float64()),
            "sequence": pa.array([np.append(cls[d], end).astype(kind).tobytes() for d in data], pa.binary()),
        })

    texts = written.where("word IS NULL").select("chunk", "doc_id", "learn", "numbers")
    schema = "doc_id long, learn boolean, n_tokens long, n_known long, plus double, alone double, sequence binary"
    placed = settle(texts.groupBy("chunk").cogroup(named.groupBy("in_chunk")).applyInArrow(place_texts, schema))

    def count_classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(unknown * unknown, np.int64)
        for batch in batches:
            stream = np.frombuffer(np.array(end, kind).tobytes() + b"".join(batch.column("sequence").to_pylist()), kind).astype(np.int64)
            sums += np.bincount(stream[:-1] * unknown + stream[1:], minlength=unknown * unknown)
        at = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[at])], ["code", "times"])

    learned = placed.where("learn").select("sequence").mapInArrow(count_classes, "code long, times long")
    table = np.zeros(unknown * unknown)
    for r in learned.groupBy("code").agg(F.sum("times").alias("times")).collect():  # at most one row per pair of classes
        table[r["code"]] = r["times"]
    scorer = ClassScorer(table.reshape(unknown, unknown), size, once, end)

    @arrow_udf("double")
    def class_score(sequences: pa.Array, alone: pa.Array) -> pa.Array:
        pairs_of = zip(sequences.to_pylist(), alone.to_pylist())
        return pa.array([scorer.score(np.frombuffer(s, kind), a) for s, a in pairs_of], pa.float64())

    spread = math.log10(train_tokens + types + 1)
    score = class_score("sequence", "alone") if n_texts else F.lit(0.0)
    return placed.select(
        "doc_id", F.col("learn").alias("learned"), "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("plus") - F.col("n_tokens") * spread).alias("base_score"), score.alias("score"),
    )
