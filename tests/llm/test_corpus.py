"""Rules, mixing, quality, language model, fingerprints and the pipeline, against plain versions in Python."""

import hashlib
import math
import pathlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from awkward import docs, nothing, odd  # noqa: F401
from compare import connect, differences
from pyspark.sql import functions as F

from cohortloom.llm import brown, queries
from cohortloom.llm.brown import ClassScorer, exchange, score_texts
from cohortloom.llm.imatch import BAND, SUBSETS, Lexicon, build_lexicon, fingerprint, fingerprint_edits
from cohortloom.llm.mixing import mix, mixed_copies, sized, source_targets
from cohortloom.llm.quality import WIDTH, AttentionModel, fit_quality, passages, pooled, with_quality
from cohortloom.llm.url_filter import judge_urls
from cohortloom.llm.words import words
from cohortloom.session import settle, shared_folder

RULES = "host string, path string, verdict string"


@pytest.fixture(scope="module")
def duck():
    from conftest import FOLDER

    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, duck, folder, name):
    assert differences(queries.QUERIES[name](spark, folder), duck, queries.ORACLES[name]) == ""


# URL rules


def plain_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [
        (len(h + p), len(h), v, h + p) for h, p, v in rules
        if None not in (h, p, v) and (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = max(fits, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_urls_against_all_rules(spark, conf):
    draw = random.Random(5)
    labels, steps = ["net", "example", "a", "b", "xn--a", "A", ""], ["/", "/en/", "/en", "/e", "/en/x/", "", "/ü/"]
    rules = {(".".join(draw.choice(labels[:5]) for _ in range(draw.randint(1, 4))), draw.choice(steps)) for _ in range(60)}
    rules = [(h, p, draw.choice(["block", "allow"])) for h, p in sorted(rules)] + [(None, "/", "block"), ("net", "/", "block"), ("net", "/", "allow")]
    tails = ["", "?q=1", "#f", "x", "en/y?/de/", "\n/en/"]
    urls = [
        "http" + draw.choice(["://", "s://", ":/"]) + ".".join(draw.choice(labels) for _ in range(draw.randint(0, 5))) + draw.choice(steps) + draw.choice(tails)
        for _ in range(1500)
    ] + [None, "", "://", "http://net", "http://net/", "x://y://net/", "HTTP://NET/en/"] * 3
    conf(spark__sql__shuffle__partitions="5")
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumns({"rule": F.lit(1), "key": F.lit(2), "best": F.lit(3)})
    got = judge_urls(pages, spark.createDataFrame(rules, RULES))
    assert got.columns == ["page_id", "url", "key", "best", "host", "path", "rule", "verdict"]
    for r in got.collect():
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == plain_judge(urls[r["page_id"]], rules), urls[r["page_id"]]
    assert got.count() == len(urls)


def test_empty_urls_and_rules(spark):
    none = spark.createDataFrame([], RULES)
    one = spark.createDataFrame([("http://a.net/",)], "url string")
    assert judge_urls(one, none).select("host", "path", "rule", "verdict").first() == ("a.net", "/", None, "allow")
    assert judge_urls(one.limit(0), spark.createDataFrame([("net", "/", "block")], RULES)).count() == 0


# Mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, total = {}, sum(sizes.values())
    while True:
        rest, parts = total - sum(target.values()), sum(weight[s] for s in names if s not in target)
        over = [s for s in names if s not in target and rest * weight[s] > most * sizes[s] * parts]
        if not over:
            return target | {s: rest * weight[s] / max(parts, 1) for s in names if s not in target}
        target |= {s: most * sizes[s] for s in over}


@pytest.mark.parametrize("seed", range(4))
def test_targets_fill_like_water(spark, seed):
    draw = random.Random(seed)
    sizes = {s: draw.choice([0, 1, 5, 100, 10_000]) for s in ["a", "b", "Z", "é", "", None, "c", "d", "zz"]}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r["source"]: r["target"] for r in source_targets(df, (5, 2, 1), 3).collect()}
    assert got == pytest.approx(plain_targets(sizes))
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_comes_near_its_targets(spark, folder):
    docs = sized(spark.read.parquet(f"{folder}/documents.parquet"))
    rows = mix(docs).collect()
    assert Counter(rows) == Counter(mix(docs.repartition(7)).collect())
    by = {}
    for r in rows:
        assert r["size"] == len(words(r["text"])) and 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    targets = plain_targets({s: sum(r["size"] for r in rs) for s, rs in by.items()})
    for source, rs in by.items():
        assert rs[0]["target"] == pytest.approx(targets[source])
        assert abs(sum(r["taken"] for r in rs) - rs[0]["target"]) <= 2


def test_mix_of_awkward_rows(odd, docs, nothing):
    got = mix(sized(odd.drop("size"))).collect()
    assert len(got) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in got)
    assert {r["size"] for r in got if not (r["text"] or "").strip()} == {0}
    assert [r["fp"] for r in got] == ["own fp"] * len(got)
    assert mix(sized(nothing)).count() == 0


def test_a_source_of_equal_ids_is_taken_in_part(spark):
    """No order tells these rows apart; each gives the same part."""
    rows = [(1, "w " * 10, "a")] * 300 + [(2, "w " * 10, "b")] * 900
    got = mix(sized(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    for source in "ab":
        taken = [r["taken"] for r in got if r["source"] == source]
        assert abs(sum(taken) - next(r["target"] for r in got if r["source"] == source)) <= len(taken) / 2


def test_copies_hold_the_words_taken(spark):
    rows = [(1, "a  b\nc", 3, 7, 6), (2, "d e", 2, 0, 3), (3, "f", 1, 2, 1), (4, None, 0, 0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, size long, taken long, n_chars long")
    got = sorted((r["doc_id"], r["text"], r["n_chars"]) for r in mixed_copies(df, length="n_chars").collect())
    assert got == [(1, "a", 1), (1, "a  b\nc", 6), (1, "a  b\nc", 6), (3, "f", 1), (3, "f", 1)]


# Quality


def test_gradients_are_right():
    rng = np.random.default_rng(1)
    model = AttentionModel.start(2, hidden=4, gate=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    x, bags, label = rng.random((7, WIDTH)), np.array([2, 1, 4]), np.array([1.0, 0, 1])

    def loss():
        y = model.forward(x, bags)["y"]
        return -np.mean(label * np.log(y) + (1 - label) * np.log(1 - y))

    for name, gradient in model.gradients(x, bags, label).items():
        at = np.unravel_index(np.argmax(np.abs(gradient)), gradient.shape)
        model.weights[name][at] += 1e-6
        up = loss()
        model.weights[name][at] -= 2e-6
        assert (up - loss()) / 2e-6 == pytest.approx(gradient[at], rel=1e-4)
        model.weights[name][at] += 1e-6


def test_passages_do_not_depend_on_the_texts_around():
    texts = [b"", b"Ab, ab ab!!\n", b"x" * 5000, "é ü".encode() * 700]
    together, bags = passages(texts)
    alone = [passages([t])[0] for t in texts]
    assert bags.tolist() == [len(a) for a in alone] and np.array_equal(together, np.concatenate(alone))


def test_scores_are_those_of_the_text_alone():
    rng = np.random.default_rng(4)
    model = AttentionModel.start(3)
    texts = [bytes(rng.integers(32, 127, rng.integers(0, 6000), dtype=np.uint8)) for _ in range(80)] + [b"", b"", b"word " * 900]
    together = model.score(*passages(texts))
    assert together.tolist() == [model.score(*passages([t]))[0] for t in texts]
    assert together[::-1].tolist() == model.score(*passages(texts[::-1])).tolist()
    assert together == pytest.approx(model.forward(*passages(texts))["y"], abs=1e-5)


def test_long_texts_are_learned_whole():
    x = np.random.default_rng(5).random((37, WIDTH)).astype(np.float32)
    few = pooled(x, 16)
    assert few.shape == (16, WIDTH) and (few.max(0) <= x.max(0)).all() and np.array_equal(pooled(x, 40), x)
    sizes = np.diff(np.arange(16) * 37 // 16, append=37)
    assert (few * sizes[:, None]).sum(0) == pytest.approx(x.sum(0), rel=1e-4)


def test_quality_of_held_out_texts(spark, folder):
    got = queries.QUERIES["op2_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.97
    assert got.count() == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_quality_of_awkward_rows(spark, odd, docs, nothing):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 1), (3, None), (7, 0), (None, 1), (8, 5)], "doc_id long, quality int")
    model = fit_quality(odd, labels)
    got = with_quality(odd, model).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if not r["text"]}) == 1
    assert with_quality(nothing, model).count() == 0
    without = fit_quality(odd, labels.limit(0))
    assert {r["score"] for r in with_quality(odd, without).collect()} == {0.5}


# Language model


def test_exchange_raises_the_likelihood_and_finds_classes():
    rng = np.random.default_rng(6)
    n, classes = 24, 4
    hidden = rng.integers(0, classes, n)
    after = rng.permutation(classes)
    pairs = np.zeros((n + 2, n + 2))
    for a in range(n):
        for b in range(n):
            pairs[a, b] = rng.poisson(20 if hidden[b] == after[hidden[a]] else 0.2)

    def value(own):
        table = np.zeros((own.max() + 1,) * 2)
        np.add.at(table, (own[:, None], own[None, :]), pairs)
        f = lambda x: (x[x > 0] * np.log(x[x > 0])).sum()
        return f(table) - f(table.sum(0)) - f(table.sum(1))

    start = np.concatenate([np.arange(n) % classes, [classes, classes + 1]])
    own = exchange(pairs, classes, n)
    assert value(own) > value(start)
    for w in range(n):  # no single move is better
        for c in range(classes):
            other = own.copy()
            other[w] = c
            assert value(other) <= value(own) + 1e-6
    assert len({(h, o) for h, o in zip(hidden, own)}) == classes


def test_probabilities_add_up_to_one():
    rng = np.random.default_rng(7)
    counts = {0: [5, 1, 1], 1: [2, 9], 2: [1], 3: [4]}  # class 3 is the end
    size = np.array([float(sum(counts[c])) for c in range(4)])
    once = np.array([float(counts[c].count(1)) for c in range(4)])
    scorer = ClassScorer(rng.integers(0, 9, (4, 4)).astype(float), size, once, end=3)
    for before in range(5):
        total = sum(10 ** (scorer.known[before, c] + math.log10(n)) for c in counts for n in counts[c]) + 10 ** scorer.unknown[before]
        assert total == pytest.approx(1)


def test_base_scores_and_better_model(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r["doc_id"]: r for r in queries.QUERIES["op5_class_lm"](spark, folder).collect()}
    texts = {r["doc_id"]: words(r["text"]) for r in docs.collect()}
    counts = Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update([*t, "end"])
    n, v = sum(counts.values()), len(counts)
    for i, t in texts.items():
        r = got[i]
        assert r["base_score"] == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*t, "end"]))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t) + 1, sum(w in counts for w in [*t, "end"]), n)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 7 == 2) and r["score"] < 0
    held = [r for r in got.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_more_classes_than_a_byte_holds(spark):
    rows = [(i, " ".join(f"w{(i * 7 + k) % 400}" for k in range(60))) for i in range(40)]
    got = score_texts(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True), classes=300, common_words=350).collect()
    assert len(got) == 40 and all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)


def test_scores_of_awkward_rows(odd, docs, nothing):
    got = score_texts(odd, F.col("doc_id") != 9, classes=3, common_words=5).collect()
    assert len(got) == docs.count()
    assert {r["n_tokens"] for r in got if r["doc_id"] in (3, 4, 5)} == {1} and {r["learned"] for r in got if r["doc_id"] is None} == {False}
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in got)
    unlearned = score_texts(odd, F.lit(False), classes=3, common_words=5).collect()
    assert {(r["train_tokens"], r["n_known"], r["base_score"], r["score"]) for r in unlearned} == {(0, 0, 0.0, 0.0)}
    assert score_texts(nothing, F.lit(True)).count() == 0


# Fingerprints


def test_lexicon_is_the_band(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = [set(words(r["text"])) for r in docs.collect()]
    counts = Counter(w for t in texts for w in t)
    low, high = math.ceil(BAND[0] * len(texts)), math.floor(BAND[1] * len(texts))
    assert set(build_lexicon(docs).place) == {w for w, n in counts.items() if low <= n <= high}


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_edits_follow_the_next_lower_id(odd, docs, conf, partitions):
    conf(spark__sql__shuffle__partitions=partitions)
    lexicon = Lexicon.of(sorted({w for r in docs.collect() for w in words(r["text"])}))
    got = Counter(tuple(r) for r in fingerprint_edits(odd, lexicon).collect())
    tie = lambda r: hashlib.md5((r["text"] or "").encode()).hexdigest()
    rows = sorted(docs.collect(), key=lambda r: (r["doc_id"] is None, -(r["doc_id"] or 0), tie(r)))
    expected = Counter()
    for r, after in zip(rows, [*rows[1:], rows[0]]):
        text, nxt = r["text"] or "", after["text"] or ""
        edited = text[: len(text) - len(text) // 3] + nxt[: len(text) // 3]
        a, b, c = (fingerprint(lexicon, t) for t in (text, edited, nxt))
        expected[r["doc_id"], len(text), hashlib.sha256(edited.encode()).hexdigest(), str(a), str(b), a.likeness(b), a.likeness(c)] += 1
    assert got == expected


def plain_mark(lexicon_terms, text):
    """(level, {(level, subset): terms}) of a text, subset by subset."""
    found = (text or "").encode().lower().split()
    terms = sorted({t for t in found if t in lexicon_terms})
    if not terms:
        return -1, {(-1, 0): found}
    level = len(terms).bit_length()
    kept = {(l, s): [t for t in terms if xxhash.xxh32_intdigest(t, 1000 + s) << l < 1 << 32] for l in (level, level + 1) for s in range(24)}
    return level, {k: ts for k, ts in kept.items() if ts}


def plain_likeness(a, b):
    if a == b:
        return 1.0
    if -1 in (a[0], b[0]):
        return 0.0
    shared = {a[0], a[0] + 1} & {b[0], b[0] + 1}
    either = {k for k in a[1].keys() | b[1].keys() if k[0] in shared}
    return sum(a[1].get(k) == b[1].get(k) for k in either) / len(either) if either else 0.0


def test_fingerprints_against_plain_sets():
    draw = random.Random(11)
    terms = [f"t{i}".encode() for i in range(300)]
    lexicon = Lexicon.of(terms)
    texts = [" ".join(draw.choice([f"T{draw.randint(0, 299)}", "other"]) for _ in range(draw.choice([0, 1, 3, 20, 200]))) for _ in range(120)] + [None, "", "other", " other "]
    texts += [t + " other t5" for t in texts[:30]]
    marks, plains = [fingerprint(lexicon, t) for t in texts], [plain_mark(set(terms), t) for t in texts]
    for (a, x), (b, y) in [(draw.choice(list(zip(marks, plains))), draw.choice(list(zip(marks, plains)))) for _ in range(4000)]:
        assert a.likeness(b) == pytest.approx(plain_likeness(x, y)) and (str(a) == str(b)) == (x == y)
    for mark, (level, kept) in zip(marks, plains):
        hashes = [xxhash.xxh32_hexdigest(b" ".join(kept[l, s])) if (l, s) in kept else "" for l in (level, level + 1) for s in range(24)]
        assert mark.level == level and (level < 0 or list(mark.hashes) == hashes)
    assert len({m.level for m in marks}) > 3


def test_small_edits_stay_alike_and_other_texts_do_not():
    draw = random.Random(8)
    terms = [f"t{i}".encode() for i in range(4000)]
    lexicon = Lexicon.of(terms)
    near, far = [], []
    for _ in range(40):
        text = [draw.choice(terms).decode() for _ in range(300)]
        edited = text[:200] + [draw.choice(terms).decode() for _ in range(100)]
        other = [draw.choice(terms).decode() for _ in range(300)]
        mark = fingerprint(lexicon, " ".join(text))
        assert mark.likeness(fingerprint(lexicon, " ".join(reversed(text)))) == 1 and len(mark.hashes) == 2 * SUBSETS
        near.append(mark.likeness(fingerprint(lexicon, " ".join(edited))))
        far.append(mark.likeness(fingerprint(lexicon, " ".join(other))))
    assert np.mean(near) > 0.3 and np.mean(far) < 0.1


def test_fingerprints_of_empty_and_single_tables(spark, nothing):
    assert fingerprint_edits(nothing).count() == 0
    row = fingerprint_edits(spark.createDataFrame([(5, "abc def")], "doc_id long, text string")).first()
    assert (row["doc_id"], row["n_chars"]) == (5, 7) and row["edited_sha256"] == hashlib.sha256(b"abc dab").hexdigest()


# Pipeline


def test_pipeline_stages(spark, folder):
    import corpus_pipeline

    source = spark.read.parquet(f"{folder}/documents.parquet")
    docs, counts = source, []
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = settle(stage(spark, docs, folder))
        assert docs.columns == source.columns
        counts.append(docs.count())
    assert counts[0] < source.count() and counts[1] < counts[0]
    ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
    assert max(Counter(ids).values()) <= 4  # three epochs and a part
    out = corpus_pipeline.STAGES[3][1](spark, docs, folder)
    assert out.count() == len(ids)
    base = pathlib.Path(shared_folder(spark).removeprefix("file:")) / "cohortloom"
    assert corpus_pipeline.run(spark, folder).count() == len(ids)
    assert not list(base.glob("run-*"))  # the steps of the run are gone


def test_pipeline_of_awkward_rows(spark, odd, nothing, tmp_path):
    import corpus_pipeline

    spark.createDataFrame([(1, 1, 0), (7, 1, 0), (None, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for df in (odd, nothing):
        docs = df
        for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, str(tmp_path))
            if i < 3:
                assert docs.columns == df.columns
        assert docs.count() == 0 or df is odd


def test_class_model_counts_a_chunk_in_slabs(spark, monkeypatch):
    """Words of a chunk are counted some texts at a time; the counts are those of the whole chunk, and texts are let go."""
    texts = ["b a b", None, "c a", "", "a a d b", "e"]
    code = {w.encode(): i for i, w in enumerate("abcde")}.__getitem__
    monkeypatch.setattr(brown, "SLAB_SIGNS", 4)
    rows = [{"text": t} for t in texts]
    slabs = [list(s) for s in brown._streams(rows, 9, lambda found: list(map(code, found)))]
    assert slabs == [[9, 1, 0, 1, 9], [9, 9, 2, 0, 9, 9, 0, 0, 3, 1, 9], [9, 4, 9]]
    assert not any(rows)
    for row in (many := [{"text": "a b"} for _ in range(9)]):
        assert row
    assert max(map(len, brown._streams(many, 9, lambda found: list(map(code, found))))) <= 7
