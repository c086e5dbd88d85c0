"""Quality of whole texts by attention-based multiple-instance learning."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from cohortloom.functions.exprs import quoted

PASSAGE_BYTES = 1024
# Bytes of text handled at a time on the executors.
_STEP_BYTES = 1 << 20


def _byte_classes() -> np.ndarray:
    """Kind of each byte: what matters is how a text is put together, not which words it uses."""
    kinds = ["\n\r", " \t\x0b\x0c", "".join(map(chr, range(97, 123))), "".join(map(chr, range(65, 91))), "0123456789"]
    kinds += [".", ",", "!?", "|", "$#%&*@^~+=<>\\/_{}[]", "'\"-:;()`"]
    table = np.full(256, len(kinds), np.int64)
    for kind, signs in enumerate(kinds):
        table[[ord(s) for s in signs]] = kind
    table[128:] = 2  # parts of letters beyond ASCII in UTF-8
    table[0] = len(kinds) + 1  # between texts
    return table


CLASSES = _byte_classes()
KINDS = int(CLASSES.max()) + 1
# Words are told apart by a hash into so many numbers.
WORD_KINDS = 256
WIDTH = KINDS * KINDS + 2 + WORD_KINDS
# A number per byte; the sums over words tell different words apart. White space and the sign between texts count 0.
_BYTE_NUMBERS = np.where(np.isin(CLASSES, (0, 1, KINDS - 1)), 0, np.random.default_rng(3).integers(1, 2**40, 256))


def _words(raw: np.ndarray, text_of: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    """Per passage the root shares of words that are the word before, or the one before that, once more, and of words
    by their hash. A word counts for the passage it begins in."""
    number = _BYTE_NUMBERS[raw]
    inside = np.concatenate([[False], number > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    sums = np.concatenate([[0], np.cumsum(number)])
    word, text = sums[ends] - sums[starts], text_of[starts]
    out = np.zeros((n, 2 + WORD_KINDS))
    for lag in (1, 2):
        again = (word[lag:] == word[:-lag]) & (text[lag:] == text[:-lag])
        out[:, lag - 1] = np.bincount(passage[starts[lag:]], again, minlength=n)
    kind = _kind_of_word(word)
    out[:, 2:] = np.bincount(passage[starts] * WORD_KINDS + kind, minlength=n * WORD_KINDS).reshape(n, WORD_KINDS)
    return np.sqrt(out / np.maximum(np.bincount(passage[starts], minlength=n), 1)[:, None])


def _kind_of_word(word: np.ndarray) -> np.ndarray:
    """The upper bits of a product, which depend on all bits of the number."""
    mixed = word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % WORD_KINDS


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """One row per passage of ``PASSAGE_BYTES`` bytes: root shares of neighbouring kinds of bytes, of repeated words and
    of words by their hash; and the number of passages of each text. An empty text has one passage of zeros."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    bags = np.maximum(1, -(-(sizes - 1) // PASSAGE_BYTES))
    raw = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    kinds = CLASSES[raw]
    pairs = kinds * KINDS + np.append(kinds[1:], KINDS - 1)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    # The sign between texts belongs to the last passage.
    of_text = np.minimum(within // PASSAGE_BYTES, np.repeat(bags - 1, sizes))
    passage = of_text + np.repeat(np.cumsum(bags) - bags, sizes)
    n, squares = int(bags.sum()), KINDS * KINDS
    counts = np.bincount(passage * squares + pairs, minlength=n * squares).reshape(n, squares)
    counts[:, (KINDS - 1) * KINDS:] = 0
    shares = np.sqrt(counts / np.maximum(counts.sum(1, keepdims=True), 1))
    words = _words(raw, np.repeat(np.arange(len(texts)), sizes), passage, n)
    return np.concatenate([shares, words], axis=1).astype(np.float32), bags


def pooled(x: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` rows, each the mean of passages in a row, so that every passage counts."""
    if len(x) <= most:
        return x
    starts = np.arange(most) * len(x) // most
    return (np.add.reduceat(x.astype(np.float64), starts, axis=0) / np.diff(starts, append=len(x))[:, None]).astype(np.float32)


def _product(x: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``x @ weights``, added up column by column in double precision: a row's result does not depend on the others, as
    it does where a library picks the order of sums by the size of the table."""
    x, weights = x.astype(np.float64), weights.astype(np.float64).reshape(x.shape[1], -1)
    out = np.zeros((len(x), weights.shape[1]))
    for i in np.flatnonzero(x.any(axis=0)):
        out += x[:, i:i + 1] * weights[i]
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class AttentionModel:
    """Encoder, gated attention and scorer: h = tanh(x W + b), a ~ exp(((tanh h V) * sigmoid(h U)) w) within a text,
    score = sigmoid((sum of a h) c + d)."""

    weights: dict[str, np.ndarray]

    @staticmethod
    def start(seed: int, hidden: int = 24, gate: int = 12) -> AttentionModel:
        rng = np.random.default_rng(seed)
        shapes = {"W": (WIDTH, hidden), "b": (hidden,), "V": (hidden, gate), "U": (hidden, gate), "w": (gate,), "c": (hidden,), "d": (1,)}
        return AttentionModel({k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if k not in "bd" else np.zeros(s)).astype(np.float32) for k, s in shapes.items()})

    def score(self, x: np.ndarray, bags: np.ndarray) -> np.ndarray:
        """Of each text, from its own passages alone: the same number whatever texts are scored with it."""
        p, starts, of = self.weights, np.cumsum(bags) - bags, np.repeat(np.arange(len(bags)), bags)
        h = np.tanh(_product(x, p["W"]) + p["b"])
        e = _product(np.tanh(_product(h, p["V"])) * _sigmoid(_product(h, p["U"])), p["w"])[:, 0]
        a = np.exp(e - np.maximum.reduceat(e, starts)[of])
        # Sums in the order of the passages.
        total, z = np.bincount(of, a, minlength=len(bags)), np.zeros((len(bags), h.shape[1]))
        for i in range(h.shape[1]):
            z[:, i] = np.bincount(of, a * h[:, i], minlength=len(bags))
        return _sigmoid(_product(z / total[:, None], p["c"])[:, 0] + float(p["d"][0]))

    def forward(self, x: np.ndarray, bags: np.ndarray) -> dict[str, np.ndarray]:
        """All that learning needs."""
        p, starts, of = self.weights, np.cumsum(bags) - bags, np.repeat(np.arange(len(bags)), bags)
        h = np.tanh(x @ p["W"] + p["b"])
        t, s = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
        e = (t * s) @ p["w"]
        a = np.exp(e - np.maximum.reduceat(e, starts)[of])
        a = a / np.add.reduceat(a, starts)[of]
        z = np.add.reduceat(a[:, None] * h, starts, axis=0)
        return {"of": of, "starts": starts, "h": h, "t": t, "s": s, "a": a, "z": z, "y": _sigmoid(z @ p["c"] + p["d"])}

    def gradients(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss."""
        p, f = self.weights, self.forward(x, bags)
        dy = (f["y"] - label) / len(label)
        dz = dy[:, None] * p["c"]
        dz_of = dz[f["of"]]
        da = (dz_of * f["h"]).sum(1)
        de = f["a"] * (da - np.add.reduceat(f["a"] * da, f["starts"])[f["of"]])
        dt, ds = de[:, None] * p["w"] * f["s"], de[:, None] * p["w"] * f["t"]
        dt, ds = dt * (1 - f["t"] ** 2), ds * f["s"] * (1 - f["s"])
        dh = f["a"][:, None] * dz_of + dt @ p["V"].T + ds @ p["U"].T
        dpre = dh * (1 - f["h"] ** 2)
        return {
            "W": x.T @ dpre, "b": dpre.sum(0), "V": f["h"].T @ dt, "U": f["h"].T @ ds, "w": (f["t"] * f["s"]).T @ de,
            "c": f["z"].T @ dy, "d": dy.sum(keepdims=True),
        }

    def fit(self, x: np.ndarray, bags: np.ndarray, label: np.ndarray, steps: int = 200, rate: float = 0.02, decay: float = 1e-4) -> AttentionModel:
        """Adam over all given texts, the rate falling to zero."""
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            for k, g in self.gradients(x, bags, label).items():
                g = g + decay * self.weights[k]
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                move = mean[k] / (1 - 0.9**step) / (np.sqrt(square[k] / (1 - 0.999**step)) + 1e-8)
                self.weights[k] = (self.weights[k] - rate * (1 - step / (steps + 1)) * move).astype(np.float32)
        return self


def _in_steps(texts: pa.Array) -> Iterator[list[bytes]]:
    step, size = [], 0
    for text in texts:
        step.append((text.as_py() or "").encode().replace(b"\0", b" "))
        size += len(step[-1])
        if size >= _STEP_BYTES:
            yield step
            step, size = [], 0
    if step:
        yield step


def quality_score(model: AttentionModel, text: Column) -> Column:
    """Score of a whole text, 0 to 1; null counts as empty, and an empty text has a score too."""
    weights = model.weights

    @arrow_udf("double")
    def score(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in arrays:
            found = [AttentionModel(weights).score(*passages(step)) for step in _in_steps(texts)]
            yield pa.array(np.concatenate(found).astype(np.float64) if found else [], pa.float64())

    return score(text)


def fit_quality(
    docs: DataFrame, labels: DataFrame, fit_rows: int = 4000, fit_passages: int = 16, seed: int = 5,
    doc_id: str = "doc_id", text: str = "text", label: str = "quality",
) -> AttentionModel:
    """Learn from at most ``fit_rows`` labelled documents, those with the lowest seeded hash of their id.

    A text is learned from whole: of one with more than ``fit_passages`` passages, passages in a row are averaged into
    as many (scores always use each by itself). Both bounds keep what the driver gets below ``fit_rows`` times
    ``fit_passages`` rows of features, 120 MB, whatever the size of the tables. Labels other than 0 and 1 do not count; a
    document with both labels counts as 0; of documents with one id one is learned from, that whose features sort
    first. Without any label all scores are 0.5.
    """
    named = labels.where(quoted(label).isin(0, 1) & quoted(doc_id).isNotNull())
    known = named.groupBy(quoted(doc_id).alias("__id")).agg(F.min(quoted(label)).cast("int").alias("__label"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col("__id").cast("string")).cast("binary"))
    chosen = known.orderBy(order, "__id").limit(fit_rows)
    # At most fit_rows short rows, so the broadcast is bounded.
    picked = docs.join(F.broadcast(chosen), quoted(doc_id) == F.col("__id")).select("__id", "__label", quoted(text).alias("text"))

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                x, _ = passages([(batch.column("text")[at].as_py() or "").encode().replace(b"\0", b" ")])
                row = [batch.column("__id").slice(at, 1), batch.column("__label").slice(at, 1), pa.array([pooled(x, fit_passages).tobytes()], pa.binary())]
                yield pa.RecordBatch.from_arrays(row, ["id", "label", "x"])

    found = picked.mapInArrow(features, "id long, label int, x binary")
    one_each = found.groupBy("id", "label").agg(F.min("x").alias("x"))  # at most fit_rows
    rows = sorted((r["id"], r["label"], bytes(r["x"])) for r in one_each.collect())
    model = AttentionModel.start(seed)
    if not rows:
        model.weights["c"][:] = 0
        return model
    bags = [np.frombuffer(x, np.float32).reshape(-1, WIDTH) for _, _, x in rows]
    return model.fit(np.concatenate(bags), np.array([len(b) for b in bags]), np.array([r[1] for r in rows], np.float32))


def with_quality(docs: DataFrame, model: AttentionModel, text: str = "text") -> DataFrame:
    """Add ``score`` and ``predicted`` (1 if the score is at least 0.5), replacing columns of these names."""
    scored = docs.withColumn("score", quality_score(model, quoted(text)))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
