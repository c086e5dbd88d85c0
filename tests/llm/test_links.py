"""Near copies by fingerprints and embeddings, against all pairs."""

import itertools
import math

import numpy as np
import pytest
from awkward import docs, nothing, odd  # noqa: F401
import xxhash
from pyspark.sql import functions as F

from cohortloom.llm.components import component_roots
from cohortloom.llm.embeddings import estimate, encode, near_copies, rotation, unit
from cohortloom.llm.simhash import PIVOTS, _masks, fingerprint_links, keep_one_of_each, near_pairs, pivot_distances, simhash_groups, with_distances
from cohortloom.llm.words import words

SHIFTED = "doc_id long, text string"


def groups(n, linked):
    root = list(range(n))
    for i, j in linked:
        a, b = root[i], root[j]
        root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def plain_fingerprint(text, k=3):
    found = words(text)
    shingles = [b" ".join(found[i:i + k]) for i in range(max(1, len(found) - k + 1))] if found else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_masks_leave_any_three_bits_out():
    masks = _masks(3)
    assert len(masks) == 20
    for bits in itertools.combinations(range(0, 64, 3), 3):
        assert any(not any(m >> b & 1 for b in bits) for m in masks)


def test_pairs_are_all_near_pairs():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    near = base ^ np.array([sum(1 << int(b) for b in rng.choice(64, k % 6, replace=False)) for k in range(40)], np.uint64)
    fp = np.concatenate([base, near])
    far = pivot_distances(fp)
    i, j, compared = near_pairs(fp, fp, far, far, True, 3)
    got = set(zip(i.tolist(), j.tolist()))
    assert len(got) == len(i) and got == {(i, j) for i in range(80) for j in range(i + 1, 80) if bin(int(fp[i] ^ fp[j])).count("1") <= 3}


def test_the_distance_table_rules_almost_all_pairs_out():
    """Of half a million pairs only near ones are compared bit by bit, and none of them is lost."""
    rng = np.random.default_rng(8)
    fp = rng.integers(0, 2**64, 1000, dtype=np.uint64)
    fp = np.concatenate([fp, fp[:50] ^ np.uint64(5), fp[50:90] ^ np.uint64(1 << 40)])
    far = pivot_distances(fp)
    assert (far[3] == [int(fp[3] ^ p).bit_count() for p in PIVOTS]).all()
    i, j, compared = near_pairs(fp, fp, far, far, True, 3)
    every = len(fp) * (len(fp) - 1) // 2
    print(f"{every - compared} of {every} pairs ruled out")
    assert every - compared > 0.999 * every and set(zip(i.tolist(), j.tolist())) == {*((k, 1000 + k) for k in range(90))}
    left, right = np.arange(0, len(fp), 2), np.arange(1, len(fp), 2)
    i, j, _ = near_pairs(fp[left], fp[right], far[left], far[right], False, 3)
    assert {(left[x], right[y]) for x, y in zip(i, j)} == {(a, b) for a in left for b in right if int(fp[a] ^ fp[b]).bit_count() <= 3}


@pytest.mark.parametrize("block", [7, 1024])
def test_links_join_what_all_pairs_join(spark, block):
    """Groups larger than a block are cut, and no link between blocks is lost."""
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 6)
    fp = sorted({int(c) ^ sum(1 << int(b) for b in rng.choice(20, rng.integers(0, 3), replace=False)) for c in centre for _ in range(60)})
    prints = with_distances(spark.createDataFrame([(x,) for x in fp], "fp long"))
    links = fingerprint_links(prints, 3, block=block).collect()
    at = {x: i for i, x in enumerate(fp)}
    every = [(i, j) for i in range(len(fp)) for j in range(i) if bin(fp[i] ^ fp[j]).count("1") <= 3]
    assert groups(len(fp), [(at[r["a"]], at[r["b"]]) for r in links]) == groups(len(fp), every)


def test_roots_of_chains_stars_and_rings(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star, ring = [(7, i) for i in range(200, 230)], [(300, 301), (301, 302), (302, 300), (303, 303)]
    found = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame([*chain, *star, *ring], "a long, b long")).collect()}
    assert len({found[i] for i in range(100, 161)}) == 1 and len({found[7], *(found[i] for i in range(200, 230))}) == 1
    assert len({found[i] for i in (300, 301, 302)}) == 1 and 303 not in found
    assert len(set(found.values())) == 3
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_simhash_of_documents_is_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(400).select("doc_id", "text")
    rows = docs.collect()
    prints = [plain_fingerprint(r["text"]) for r in rows]
    linked = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 3]
    root = groups(len(rows), linked)
    least = {}
    for r, g in zip(rows, root):
        least[g] = min(least.get(g, r["doc_id"]), r["doc_id"])
    expected = {r["doc_id"]: (f"{p:016x}", least[g]) for r, p, g in zip(rows, prints, root)}
    df = spark.createDataFrame([tuple(r) for r in rows], SHIFTED)
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_groups(df).collect()} == expected


def test_simhash_of_awkward_rows(odd, docs, nothing):
    found = [(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash_groups(odd).collect()]
    assert len(found) == docs.count()
    blank = {(i, c) for i, f, c in found if f == "0" * 16}
    assert blank == {(3, 3), (4, 3), (5, 3), (None, 3)}
    assert {c for i, _, c in found if i in (1, 2)} == {1} and {c for i, _, c in found if i in (7, 8)} == {7}
    assert simhash_groups(nothing).count() == 0


def test_one_row_of_each_group_stays(odd, nothing):
    kept = keep_one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in kept.collect())[0][1] == 1
    ids = sorted((r["doc_id"] for r in kept.collect()), key=str)
    assert ids == sorted([1, 3, 7, 9, 10, None], key=str)
    assert keep_one_of_each(nothing).count() == 0


def test_repeated_ids_of_different_texts_each_stay(spark):
    rows = [(1, "a b c d e f"), (1, "quite another text it is"), (1, "a b c d e f"), (1, "a b c d e f")]
    assert keep_one_of_each(spark.createDataFrame(rows, SHIFTED)).count() == 2


def test_estimates_are_unbiased_and_their_bounds_hold():
    rng = np.random.default_rng(3)
    a = rng.standard_normal((200, 48))
    b = a + rng.standard_normal(a.shape) * rng.uniform(0, 2, (200, 1))
    turn = rotation(48, 512, 5)
    signs, factor = encode(a, turn)
    about, error = estimate(signs, factor, unit(b) @ turn.T)
    truth = unit(a) @ unit(b).T
    assert abs((about - truth).mean()) < 0.002
    assert (np.abs(about - truth) <= error[:, None]).mean() > 0.9999


def brute(rows, threshold):
    def good(v):
        return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    pairs = []
    for i in range(n):
        for j in range(i):
            (_, v, a), (_, w, b) = rows[i], rows[j]
            if a is None or a != b or not (good(v) and good(w)) or len(v) != len(w):
                continue
            if np.dot(unit(np.array([v]))[0], unit(np.array([w]))[0]) >= threshold:
                pairs.append((i, j))
    links = [sum(k in p for p in pairs) for k in range(n)]
    root = groups(n, pairs)
    least = [min((rows[j][0] for j in range(n) if root[j] == root[i] and rows[j][0] is not None), default=None) for i in range(n)]
    return sorted((rows[i][0], links[i], least[i], rows[i][0] == least[i]) for i in range(n) if rows[i][0] is not None)


VECTORS = "vec_id long, embedding array<double>, label int"


@pytest.mark.parametrize("block", [5, 1024])
def test_embedding_links_are_brute_force(spark, block, monkeypatch):
    rng = np.random.default_rng(4)
    rows = []
    for label in range(3):
        for _ in range(12):
            centre = rng.standard_normal(16)
            for _ in range(rng.integers(1, 9)):
                rows.append((len(rows), (centre + rng.standard_normal(16) * rng.uniform(0, 0.25)).tolist(), label))
    rows += [(1000 + i, rows[0][1], 0) for i in range(8)] + [(1100, rows[0][1], 1), (1101, rows[0][1], None)]
    import cohortloom.llm.embeddings as module

    links = module.embedding_links
    monkeypatch.setattr(module, "embedding_links", lambda d, t: links(d, t, block=block))
    got = near_copies(spark.createDataFrame(rows, VECTORS), 0.98).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, 0.98)


def test_awkward_embeddings(spark):
    one = [1.0, 2.0, 3.0]
    rows = [
        (1, one, 0), (2, [2.0, 4.0, 6.0], 0), (2, one, 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0, 0.0], 0),
        (6, [1.0, None, 2.0], 0), (7, [math.nan, 1.0, 1.0], 0), (8, [math.inf, 1.0, 1.0], 0), (9, one, None), (10, one, 1),
        (11, [1e300, 2e300, 3e300], 0), (12, [1e-300, 2e-300, 3e-300], 0), (13, [1.0, 2.0], 0), (14, [-1.0, -2.0, -3.0], 0),
    ]
    df = spark.createDataFrame(rows, VECTORS).withColumns({"id": F.lit("own"), "n_links": F.lit("own")})
    got = sorted((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in near_copies(df, 0.98).collect())
    assert got == brute(rows, 0.98)
    assert got[:3] == [(1, 4, 1, True), (2, 4, 1, False), (2, 4, 1, False)]
    assert near_copies(spark.createDataFrame([], VECTORS)).count() == 0
    assert near_copies(spark.createDataFrame([(None, one, 0)], VECTORS)).first()["kept"]
