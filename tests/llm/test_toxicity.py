"""Segments against all intervals, the law of clean texts, held-out texts and awkward rows."""

import math

import numpy as np
import pytest
from awkward import docs, nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from cohortloom.llm import queries
from cohortloom.llm.toxicity import ToxicModel, fit_gumbel, fit_logistic, fit_toxicity, maximal_segments, term_log_odds, with_toxicity


def plain_segments(x, start=0):
    """The interval with the highest sum (the shortest, then leftmost of equal ones), then the same on both sides."""
    sums = [(sum(x[a:b]), -(b - a), -a) for a in range(len(x)) for b in range(a + 1, len(x) + 1)]
    best = max(sums, default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a = -best[2]
    b = a - best[1]
    return plain_segments(x[:a], start) + [(start + a, start + b, best[0])] + plain_segments(x[b:], start + b)


@pytest.mark.parametrize("seed", range(60))
def test_segments_are_all_maximal_ones(seed):
    """Random sums, so that no two intervals tie."""
    rng = np.random.default_rng(seed)
    x = rng.normal(-0.2, 1, rng.integers(0, 30))
    got = maximal_segments(x)
    assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in plain_segments(x.tolist())]
    assert [s for *_, s in got] == pytest.approx([s for *_, s in plain_segments(x.tolist())])


def test_segments_of_long_rising_and_falling_texts_take_linear_time():
    wave = np.tile([1.0, -0.9], 100_000)
    assert len(maximal_segments(wave)) == 1
    assert len(maximal_segments(np.concatenate([wave, -wave]))) >= 1 and maximal_segments(np.zeros(5)) == []


def test_log_odds_lean_on_the_shorter_start():
    odds = term_log_odds({"": (100, 900), "ab": (50, 50), "abc": (1, 0), "xy": (0, 50), "abcd ": (40, 0)}, 10)
    assert odds["ab"] > 1 and odds["xy"] < -0.5 and odds["ab"] < odds["abc"] < odds["abcd "]
    share = (1 + 10 * (50 + 10 * 100.5 / 1001) / 110) / 11
    assert odds["abc"] == pytest.approx(math.log(share / (1 - share)) - math.log(100.5 / 900.5))
    assert ToxicModel(odds, 1.0).token_score("ABX") == pytest.approx(odds["ab"] - 1)
    assert ToxicModel(odds, 1.0).token_score("q") == -1.0


def test_law_of_clean_texts_is_found_again():
    rng = np.random.default_rng(4)
    n = rng.integers(20, 3000, 5000).astype(float)
    best = (rng.gumbel(size=5000) + np.log(n) + math.log(0.05)) / 1.7
    rate, log_k = fit_gumbel(best, n)
    assert rate == pytest.approx(1.7, rel=0.05) and log_k == pytest.approx(math.log(0.05), abs=0.2)
    model = ToxicModel({}, 1.0, rate, log_k)
    assert np.mean([model.p_value(k, b) < 0.1 for k, b in zip(n, best)]) == pytest.approx(0.1, abs=0.02)
    assert fit_gumbel(np.zeros(0), np.zeros(0)) == (1.0, 0.0)


def test_evidence_grows_with_segments_and_falls_with_length():
    model = ToxicModel({}, 1.0, 1.0, -2.0)
    assert model.evidence(100, []) == 0 and model.evidence(100, [8.0, 8.0, 8.0]) > model.evidence(100, [8.0]) > model.evidence(1000, [8.0])
    assert model.evidence(100, [8.0, 0.1]) == model.evidence(100, [8.0])
    slope, base = fit_logistic(np.array([0, 1, 0, 9, 8.0] * 50), np.array([0, 0, 0, 1, 1.0] * 50))
    assert slope > 0 > base


def test_held_out_texts(spark, folder):
    got = queries.QUERIES["op11_toxicity"](spark, folder)
    rows = got.where("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    assert sum(r["predicted"] == r["toxic"] for r in rows) / len(rows) > 0.97
    every = got.collect()
    assert len(every) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in every)


def test_scores_depend_on_the_text_alone_and_passages_are_places_in_it(spark):
    clean = [f"plain word{i} and more of it {i}" for i in range(60)]
    texts = clean + [t + " VILEthing here vilething" for t in clean[:20]]
    rows = [(i, t, int(i >= 60)) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(df, df, strength=5.0)
    one = {r["text"]: r for r in with_toxicity(df.repartition(5), model).collect()}
    two = {r["text"]: r for r in with_toxicity(df.coalesce(1).orderBy(F.desc("doc_id")), model).collect()}
    assert {t: r["score"] for t, r in one.items()} == {t: r["score"] for t, r in two.items()}
    assert all(one[t]["predicted"] == label for _, t, label in rows)
    for _, text, label in rows:
        assert {text[p["start"]:p["end"]].lower() for p in one[text]["passages"]} <= {"vilething", "vilething here vilething"}
        assert bool(one[text]["passages"]) == bool(label)


def test_awkward_rows(spark, odd, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, None), (7, 0), (9, 1), (None, 1), (8, 5)], "doc_id long, toxic int")
    model = fit_toxicity(odd, labels, least_texts=1)
    got = with_toxicity(odd, model).collect()
    assert len(got) == docs.count() and len({r["score"] for r in got if not (r["text"] or "").strip()}) == 1
    assert all(0 <= r["score"] <= 1 and r["fp"] == "own fp" for r in got)
    assert with_toxicity(nothing, model).count() == 0 and fit_toxicity(nothing, labels).odds == {}
    without = fit_toxicity(odd, labels.limit(0))
    assert {r["predicted"] for r in with_toxicity(odd, without).collect()} == {0}
