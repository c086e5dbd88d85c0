"""Groups, links and counts against the whole texts' tokens and every pair."""

import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from awkward import docs, nothing, odd  # noqa: F401
from pyspark.sql import functions as F

from cohortloom.llm import alignment
from cohortloom.llm.alignment import align_tokens, group_ends, token_groups, tools, with_token_groups

BYTES, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SIGNS = "aabbes  1\n\t 　'.s<|endoftext|>é漢\x1c\x85 ll\x00<s>"
SHIFTED = "doc_id long, text string"


def plain_groups(text):
    """By the ends of the whole text's tokens."""
    tool = tools(BYTES, MODEL)
    if not text:
        return []
    a, b = tool.bpe.encode(" " + text, add_special_tokens=False).ids, tool.model.encode(text)
    if any(b"".join(names[i] for i in ids) != (" " + text).encode() for names, ids in ((tool.a_bytes, a), (tool.b_bytes, b))):
        return []
    ends = [np.cumsum([len(names[i]) for i in ids]).tolist() for names, ids in ((tool.a_bytes, a), (tool.b_bytes, b))]
    cuts = sorted(set(ends[0]) & set(ends[1]))
    out = [([], []) for _ in cuts]
    for side, (ids, es) in enumerate(zip((a, b), ends)):
        for i, end in zip(ids, es):
            out[bisect.bisect_left(cuts, end)][side].append(i)
    return out


def plain(rows):
    groups = [plain_groups(t) for _, t in rows]
    links = [[(a, b) for g in gs for a in g[0] for b in g[1]] for gs in groups]
    count = Counter(p for ls in links for p in set(ls))
    top = Counter()
    for (a, _), n in count.items():
        top[a] = max(top[a], n)
    out = Counter()
    for (i, _), gs, ls in zip(rows, groups, links):
        name = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        sha = hashlib.sha256(name.encode()).hexdigest() if gs else ""
        sizes = (sum(len(a) for a, _ in gs), sum(len(b) for _, b in gs), len(gs), len(ls))
        out[(i, *sizes, sum(count[p] == top[p[0]] for p in ls), sum(count[p] for p in ls), sha)] += 1
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect())


def noise(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 40))) for _ in range(n)]


def test_pointers_end_where_both_rows_end():
    draw = random.Random(1)
    for _ in range(200):
        n = draw.randint(1, 60)
        a, b = (np.array(sorted({n, *draw.sample(range(1, n + 1), draw.randint(0, n))})) for _ in range(2))
        cuts = sorted(set(a.tolist()) & set(b.tolist()))
        in_a, in_b, groups = group_ends(a, b)
        assert groups == len(cuts)
        assert in_a.tolist() == np.searchsorted(cuts, a).tolist() and in_b.tolist() == np.searchsorted(cuts, b).tolist()


def test_long_chains_need_few_doublings():
    """Tokens that overlap like bricks make one group of all."""
    a = np.append(np.arange(2, 200_001, 2), 200_001)
    b = np.append(np.arange(1, 200_001, 2), 200_001)
    assert group_ends(a, b)[2] == 1


def test_units_of_texts_give_the_tokens_of_the_whole():
    tool = tools(BYTES, MODEL)
    assert tool.cuts
    for text in [*noise(600, 2), " a", "a ", " ", "  ", "a  b", "▁", "the thanedble, and 12 \n more"]:
        assert token_groups(tool, text) == plain_groups(text), repr(text)


@pytest.mark.parametrize("size", [2000, 1 << 20])
def test_all_rows_equal_all_pairs(spark, monkeypatch, size):
    monkeypatch.setattr(alignment, "CHUNK_SIGNS", size)
    words = ["thanedble", "the", "ering,", "über", "漢字", "ааа", "12345", "a.b"]
    draw = random.Random(3)
    texts = [" ".join(draw.choices(words, k=draw.randint(1, 12))) for _ in range(150)] + noise(150, 4) + ["same text"] * 40 + [None, "", "▁ x"]
    rows = list(enumerate(texts)) + [(None, "the the"), (5, "the"), (5, "the")]
    df = spark.createDataFrame(rows, SHIFTED).repartition(4).withColumns({"chunk": F.lit("own"), "number": F.lit("own")})
    assert found(align_tokens(df, BYTES, MODEL)) == plain(rows)


def test_documents_equal_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").limit(150)
    rows = [tuple(r) for r in docs.collect()]
    assert found(align_tokens(spark.createDataFrame(rows, SHIFTED), BYTES, MODEL)) == plain(rows)


def test_awkward_rows(spark, odd, docs, nothing):
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(align_tokens(odd, BYTES, MODEL)) == plain(rows)
    assert align_tokens(nothing, BYTES, MODEL).count() == 0
    got = with_token_groups(odd, BYTES, MODEL).collect()
    assert len(got) == len(rows) and {r["word"] for r in got} == {"own word"}
    assert all([(list(g["a"]), list(g["b"])) for g in r["token_groups"]] == plain_groups(r["text"]) for r in got)


def test_long_texts_without_blanks():
    tool = tools(BYTES, MODEL)
    for text in ("-" * 20_000, "漢字仮名" * 3000, "a" * 20_000):
        assert token_groups(tool, text) == plain_groups(text)
