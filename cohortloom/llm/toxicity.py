"""Toxic passages of whole texts: maximum-scoring segments of token log-odds, with extreme-value calibration.

Every token has a log-odds of standing in toxic rather than clean texts, less a constant, so that a clean text drifts
down. A linear scan finds all maximal segments of a text (no longer or shorter neighbour has a higher sum). The highest
segment of n clean tokens follows a Gumbel law, P(S >= x) ~ K n exp(-lambda x); that turns the sums of any number of
segments of a text into one evidence, whatever its length, and evidence into a score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from cohortloom.functions.exprs import quoted
from cohortloom.operators.ordering import seeded_hash
from cohortloom.session import settle

TOKEN = re.compile(r"[^\W_]+")
# Starts of words that have counts of their own, in signs; a whole word is marked by a blank behind it.
SHORTEST, LONGEST = 2, 8
# Tokens remembered by a worker, and the longest that is.
_MEMORY, _REMEMBERED_SIGNS = 500_000, 64
FOUND = "struct<score: double, predicted: int, passages: array<struct<start: int, end: int, sum: double, p_value: double>>>"


def starts_of(word: str) -> list[str]:
    """The terms a word counts for, shortest first."""
    return [word[:k] for k in range(SHORTEST, min(len(word), LONGEST) + 1)] + [word + " "]


def term_log_odds(counts: dict[str, tuple[int, int]], strength: float) -> dict[str, float]:
    """Log-odds of toxic against clean of each term, above that of all words.

    ``counts``: in how many toxic and clean texts the words with this start occur, summed. The share of toxic among
    them has a Dirichlet prior of weight ``strength`` around the share of the next shorter start that is known, so a
    rare word leans on the words that begin alike, and these on all words. "" holds the sums over all words.
    """
    toxic, clean = counts.get("", (0, 0))
    share = {"": (toxic + 0.5) / (toxic + clean + 1)}
    base = math.log(share[""] / (1 - share[""]))
    for term in sorted(counts, key=lambda t: (len(t), t)):
        if term:
            known = next((term[:k] for k in range(min(len(term) - 1, LONGEST), SHORTEST - 1, -1) if term[:k] in share), "")
            t, c = counts[term]
            share[term] = (t + strength * share[known]) / (t + c + strength)
    return {t: math.log(s / (1 - s)) - base for t, s in share.items() if t}


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """(start, end, sum) of all maximal segments with a sum above 0, left to right, in linear time.

    Only tokens above 0 can start or end one. Each candidate keeps a link to the last one before it with a lower
    running sum on its left, so no candidate is looked at twice on the way back.
    """
    places = np.flatnonzero(scores > 0)
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float, int]] = []  # start, end, running sum at its left and right, link
    for at, left, right in zip(places.tolist(), sums[places].tolist(), sums[places + 1].tolist()):
        start, end, link = at, at + 1, len(found) - 1
        while True:
            while link >= 0 and found[link][2] >= left:
                link = found[link][4]
            if link < 0 or found[link][3] >= right:
                found.append((start, end, left, right, link))
                break
            start, _, left, _, below = found[link]
            del found[link:]
            link = below
    return [(s, e, r - l) for s, e, l, r, _ in found]


@dataclass
class ToxicModel:
    """Token scores, the Gumbel law of clean texts and the step from evidence to score."""

    odds: dict[str, float]
    drift: float
    rate: float = 1.0
    log_k: float = 0.0
    slope: float = 0.0
    base: float = -40.0
    known: dict[str, float] = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def token_score(self, token: str) -> float:
        word = token.lower()
        terms = [word + " ", *(word[:k] for k in range(min(len(word), LONGEST), SHORTEST - 1, -1))]
        score = next((self.odds[t] for t in terms if t in self.odds), 0.0) - self.drift
        if len(token) <= _REMEMBERED_SIGNS:
            if len(self.known) >= _MEMORY:
                self.known.clear()
            self.known[token] = score
        return score

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        """Number of tokens, and the maximal segments."""
        known, tokens = self.known, TOKEN.findall(text)
        scores = [known[t] if t in known else self.token_score(t) for t in tokens]
        return len(tokens), maximal_segments(np.array(scores, np.float64))

    def evidence(self, n: int, sums: list[float]) -> float:
        """-log of how likely clean text of n tokens has segments as high as these: the best over the r highest, for
        any r, halved for each further one. 0 without a segment."""
        if not sums:
            return 0.0
        r = np.arange(1, len(sums) + 1)
        total = np.cumsum(self.rate * np.sort(sums)[::-1] - (self.log_k + math.log(n)))
        factorials = np.concatenate([[0.0], np.cumsum(np.log(r))])
        log_p = -total + (r - 1) * np.log(np.maximum(total, 1e-9)) - factorials[1:] - factorials[:-1]
        return float(max(0.0, np.max(np.where(total > 0, -log_p - r * math.log(2), 0.0))))

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-min(40.0, max(-40.0, self.slope * evidence + self.base))))

    def p_value(self, n: int, total: float) -> float:
        """How likely clean text of n tokens has a segment this high."""
        return -math.expm1(-math.exp(min(700.0, self.log_k + math.log(n) - self.rate * total)))


def fit_gumbel(best: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(lambda, log K) of highest likelihood for the highest segments of clean texts of n tokens each."""

    def given(rate: float) -> tuple[float, float]:
        z = rate * best - np.log(n)
        low = z.min()
        log_k = low - math.log(np.mean(np.exp(low - z)))
        return float(np.mean(math.log(rate) - (z - log_k) - np.exp(log_k - z))), log_k

    if not len(best):
        return 1.0, 0.0
    rate = max((float(x) for x in np.geomspace(0.02, 50, 600)), key=lambda x: given(x)[0])
    return rate, given(rate)[1]


def fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """(slope, base) of a logistic curve by Newton's steps, with a small pull to 0 so that separable data have one."""
    pull, w = np.diag([30.0, 0.1]), np.array([0.05, -1.0])
    rows = np.stack([x, np.ones(len(x))], axis=1)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -40, 40)))
        step = np.linalg.solve(rows.T @ (rows * (p * (1 - p) + 1e-9)[:, None]) + pull, rows.T @ (y - p) - pull @ w)
        w = w + np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def _count_words(rows: DataFrame) -> DataFrame:
    """``word, toxic, clean``: in how many texts of each label a word occurs. One row per task's batch and word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for text, toxic in zip(batch.column("text"), batch.column("label").to_pylist()):
                counts[toxic].update({w.lower() for w in TOKEN.findall(text.as_py() or "")})
            words = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict({
                "word": pa.array(words, pa.string()), "toxic": pa.array([counts[1][w] for w in words], pa.int64()),
                "clean": pa.array([counts[0][w] for w in words], pa.int64()),
            })

    found = rows.mapInArrow(count, "word string, toxic long, clean long")
    return found.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _per_text(rows: DataFrame, model: ToxicModel) -> list:
    """(label, tokens, highest segment, evidence) of each learning text."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column("text"):
                n, found = model.segments(text.as_py() or "")
                sums = [s for _, _, s in found]
                out.append({"n": n, "best": max(sums, default=0.0), "evidence": model.evidence(n, sums)})
            yield pa.RecordBatch.from_pydict({
                "label": batch.column("label"), "n": pa.array([r["n"] for r in out], pa.int64()),
                "best": pa.array([r["best"] for r in out], pa.float64()), "evidence": pa.array([r["evidence"] for r in out], pa.float64()),
            })

    found = rows.mapInArrow(look, "label int, n long, best double, evidence double").collect()
    return sorted(found)  # at most fit_rows short rows, in an order of their own


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, fit_rows: int = 20_000, most_terms: int = 1 << 18, least_texts: int = 4,
    strength: float = 50.0, drift: float = 1.0, seed: int = 11, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
) -> ToxicModel:
    """Learn from at most ``fit_rows`` labelled documents, those with the lowest seeded hash of their id.

    The model has at most ``most_terms`` starts and words, those found in the most texts, each in ``least_texts`` at
    least. Both bounds keep what reaches the driver small whatever the size of the tables: four numbers per learning
    text and the terms. Labels other than 0 and 1 do not count; a document with both counts as toxic; of documents with
    one id the text that sorts first is learned from. Without a toxic and a clean document every score is that of the
    share of toxic ones, 0 without any.
    """
    named = labels.where(quoted(label).isin(0, 1) & quoted(doc_id).isNotNull())
    known = named.groupBy(quoted(doc_id).alias("__id")).agg(F.max(quoted(label)).cast("int").alias("label"))
    chosen = known.orderBy(seeded_hash("__id", seed), "__id").limit(fit_rows)
    # At most fit_rows short rows, so the broadcast is bounded.
    picked = docs.select(quoted(doc_id).alias("__doc"), quoted(text).alias("text")).join(F.broadcast(chosen), F.col("__doc") == F.col("__id"))
    rows = settle(picked.groupBy("__id", "label").agg(F.min("text").alias("text")).select("label", "text"))

    words = settle(_count_words(rows))
    length = F.least(F.length("word"), F.lit(LONGEST))
    starts = F.when(length >= SHORTEST, F.transform(F.sequence(F.lit(SHORTEST), length), lambda k: F.substring("word", F.lit(1), k)))
    terms = F.array_union(F.coalesce(starts, F.array().cast("array<string>")), F.array(F.concat("word", F.lit(" "))))
    sums = [F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")]
    counted = words.select(F.explode(terms).alias("term"), "toxic", "clean").groupBy("term").agg(*sums)
    counted = counted.where(F.col("toxic") + F.col("clean") >= least_texts)
    kept = counted.orderBy(F.desc(F.col("toxic") + F.col("clean")), "term").limit(most_terms).toArrow()
    total = words.agg(*sums).first()
    counts = dict(zip(kept["term"].to_pylist(), zip(kept["toxic"].to_pylist(), kept["clean"].to_pylist())))
    model = ToxicModel(term_log_odds(counts | {"": (total["toxic"] or 0, total["clean"] or 0)}, strength), drift)

    texts = _per_text(rows, model)
    clean = [r for r in texts if r["label"] == 0 and r["n"] and r["best"] > 0]
    model.rate, model.log_k = fit_gumbel(np.array([r["best"] for r in clean]), np.array([float(r["n"]) for r in clean]))
    texts = _per_text(rows, model)
    toxic = sum(r["label"] for r in texts)
    if 0 < toxic < len(texts):
        model.slope, model.base = fit_logistic(np.array([r["evidence"] for r in texts]), np.array([float(r["label"]) for r in texts]))
    elif toxic:
        model.base = 40.0
    return model


def toxicity(model: ToxicModel, text: Column, cut: float = 0.3, significant: float = 0.01) -> Column:
    """``score, predicted, passages`` of a whole text; null counts as empty.

    ``score`` (0 to 1) depends on the text alone. ``predicted`` is 1 where it reaches ``cut``. ``passages``: every
    maximal segment that clean text of this length has with a probability of at most ``significant``, by place in
    signs, the highest sum first.
    """

    @arrow_udf(FOUND)
    def find(arrays: Iterator[pa.Array]) -> Iterator[pa.Array]:
        passage = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("sum", pa.float64()), ("p_value", pa.float64())])
        for texts in arrays:
            scores, passages = [], []
            for one in texts:
                one = one.as_py() or ""
                n, found = model.segments(one)
                scores.append(model.score(model.evidence(n, [s for _, _, s in found])))
                high = [(s, a, b, model.p_value(n, s)) for a, b, s in found]
                high = sorted((x for x in high if x[3] <= significant), key=lambda x: (-x[0], x[1]))
                spans = [m.span() for m in TOKEN.finditer(one)] if high else []
                passages.append([{"start": spans[a][0], "end": spans[b - 1][1], "sum": s, "p_value": p} for s, a, b, p in high])
            score = pa.array(scores, pa.float64())
            predicted = pa.array(np.array(scores) >= cut).cast(pa.int32())
            yield pa.StructArray.from_arrays([score, predicted, pa.array(passages, pa.list_(passage))], ["score", "predicted", "passages"])

    return find(text)


def with_toxicity(docs: DataFrame, model: ToxicModel, cut: float = 0.3, significant: float = 0.01, text: str = "text") -> DataFrame:
    """Add ``score``, ``predicted`` and ``passages`` (see ``toxicity``), replacing columns of these names.

    Null and empty texts have the score of no evidence and no passages; equal texts have equal scores, repeated rows are
    each scored, and an empty table stays empty. Memory is bounded by the model, one batch and the longest text.
    """
    marked = docs.drop("score", "predicted", "passages").withColumn("__found", toxicity(model, F.coalesce(quoted(text), F.lit("")), cut, significant))
    return marked.withColumns({c: F.col(f"__found.{c}") for c in ("score", "predicted", "passages")}).drop("__found")
