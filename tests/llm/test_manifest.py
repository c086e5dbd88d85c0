"""The tree against a plain one in Python, ranks, repeated ids and awkward rows."""

import hashlib
import random
from collections import Counter

import pytest
from awkward import docs, nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from cohortloom.llm.manifest import fold, leaf_digest, merkle_proofs, proof_digest, with_tampered

LEAVES = "id long, source string, leaf string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def tree(nodes):
    """(root, siblings of each leaf from the leaf up)"""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, place in enumerate(at):
            run = nodes[place // 16 * 16: place // 16 * 16 + 16]
            proofs[i].append(("".join(run[: place % 16]), "".join(run[place % 16 + 1:])))
        nodes = [sha(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)]
        at = [place // 16 for place in at]
    return nodes[0], proofs


def plain(rows):
    """(id, source, leaf, subroot, root, proof) of rows (id, source, leaf)."""
    groups = {}
    for r in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[2])):
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([r[2] for r in groups[s]]) for s in names}
    root, upper = tree([trees[s][0] for s in names])
    above = dict(zip(names, upper))
    return Counter((*r, trees[s][0], root, tuple(p + above[s])) for s in names for r, p in zip(groups[s], trees[s][1]))


def found(df):
    return Counter((r["id"], r["source"], r["leaf"], r["subroot"], r["root"], tuple(map(tuple, r["proof"]))) for r in df.collect())


def made(seed, ids):
    draw = random.Random(seed)
    names = ["a", "B", None, "é", "漢", "", "zz", "\U0001f600", "one"] + [f"s{i}" for i in range(20)]
    weight = [30, 20, 10, 5, 1, 1, 1, 1, 1] + [0.1] * 20
    return [(draw.choice(ids), draw.choices(names, weight)[0], sha(str(draw.randint(0, 10**9)))) for _ in range(900)]


@pytest.mark.parametrize("ids", [range(10**6), range(-70, 90), [-(2**63), 2**63 - 1, None, 0, -1, 5], [2**40 * i + i for i in range(-300, 300)]], ids=["spread", "dense and repeated", "ends", "sparse"])
def test_tree_equals_a_plain_one(spark, ids):
    rows = made(3, ids)
    got = merkle_proofs(spark.createDataFrame(rows, LEAVES).repartition(5), "source", "id")
    assert found(got) == plain(rows)
    assert got.where(fold(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


@pytest.mark.parametrize("n", [1, 17, 257])
def test_runs_of_any_length(spark, n):
    rows = [(i, "a", sha(str(i))) for i in range(n)] + [(7, "b", sha("b"))]
    assert found(merkle_proofs(spark.createDataFrame(rows, LEAVES), "source", "id")) == plain(rows)
    assert found(merkle_proofs(spark.createDataFrame(rows[:n], LEAVES), "source", "id")) == plain(rows[:n])


def test_a_third_of_all_rows_with_one_id(spark):
    rows = [(5, "a", sha(str(i % 40))) for i in range(400)] + [(None, "a", sha("x"))] * 300 + [(i, "a", sha(f"y{i}")) for i in range(300)]
    assert found(merkle_proofs(spark.createDataFrame(rows, LEAVES), "source", "id")) == plain(rows)


def test_only_changed_leaves_fail(spark, odd):
    names = ["doc_id", "source", "lang", "n_chars"]
    leaves = odd.withColumns({"leaf": leaf_digest([F.col(c) for c in [*names, "text"]]), "tampered": F.when(F.col("doc_id").isin(1, 4, 9), leaf_digest([*map(F.col, names), F.lower("text")]))})
    leaves = leaves.withColumns({c: F.lit(f"own {c}") for c in ("g", "k", "m", "items", "above", "root")})
    out = with_tampered(merkle_proofs(leaves, "source", "doc_id")).withColumn("sha", proof_digest(F.col("proof")))
    rows = out.collect()
    assert len(rows) == odd.count() and {r["fp"] for r in rows} == {"own fp"} and {r["g"] for r in rows} == {"own g"}
    # Of the three, only the text of document 9 has capital letters.
    assert {r["doc_id"] for r in rows if not r["verified"]} == {9}
    for r in rows:
        assert r["verified"] == (r["folded_root"] == r["root"])
        assert r["sha"] == sha(*(left + right for left, right in r["proof"]))
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]]
        assert r["leaf"] == sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def test_empty_tables_and_missing_leaves(spark):
    assert merkle_proofs(spark.createDataFrame([], LEAVES), "source", "id").count() == 0
    with pytest.raises(Exception, match="without a digest"):
        merkle_proofs(spark.createDataFrame([(1, "a", None)], LEAVES), "source", "id").count()
