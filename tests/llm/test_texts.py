"""Counting, encoding and segmenting whole texts, against the libraries and against all paths of small lattices."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from awkward import docs, nothing, odd, rows_of  # noqa: F401
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cohortloom.llm.byte_bpe import ids_crc32, pieces, token_ids, with_token_counts
from cohortloom.llm.pieces import decode_ids, lattice, other_ids, with_pieces
from cohortloom.llm.token_files import read_token_files, token_starts, write_token_files

BYTES, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SIGNS = "ab 1\n\t 　'.s<|endoftext|>é漢\x1c\x85 ll  ▁"


def noise(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(SIGNS) for _ in range(draw.randint(0, 50))) for _ in range(n)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTES)


def test_pieces_give_the_text_back():
    for text in noise(500, 1):
        assert " ".join(pieces(text)) == text


def test_counts_and_ids_are_those_of_the_library(spark, library):
    texts = [*noise(800, 2), "", None, " ", "<|endoftext|> a<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = with_token_counts(df.withColumn("n_tokens", F.lit("own")), BYTES, 5).withColumn("ids", token_ids(BYTES, F.col("text"), end=0)).collect()
    for row in got:
        expected = library.encode(texts[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == [*expected, 0]
        assert (row["n_tokens"], row["over_limit"]) == (len(expected), len(expected) > 5)
        assert row["n_bytes"] == len((texts[row["doc_id"]] or "").encode())


def test_texts_without_blanks_are_cut_and_memory_is_bounded(library):
    """Many long texts without a blank: the same ids as the library's, and nothing of them is remembered."""
    import pyarrow as pa

    from cohortloom.llm import byte_bpe

    draw = random.Random(7)
    letters = [chr(draw.randint(0x4E00, 0x9FFF)) for _ in range(400)] + list("abcdefghij") * 10
    texts = ["".join(draw.choice(letters) for _ in range(20_000)) for _ in range(60)] + ["a" * 20_000, "-" * 9000, "x1" * 4000, "don't" * 3000, "é" * 9000]
    texts += [f"word {t} and {t[:5000]} more" for t in texts[:3]]
    got = [ids for part in byte_bpe.encode_texts(BYTES, pa.array(texts)) for ids in part.to_pylist()]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert len(byte_bpe._library(BYTES).parts(texts[0])) > 5
    coder = byte_bpe.PieceCoder(BYTES, True)
    for _ in coder.batches(pa.array(texts * 5)):
        assert coder.signs <= byte_bpe.MEMORY_SIGNS + 4 * byte_bpe.STEP_BYTES


def test_frequent_pieces_outlast_a_full_memory(library, monkeypatch):
    """Ids stay the library's while rare pieces are forgotten, and frequent pieces are not looked up again."""
    import pyarrow as pa

    from cohortloom.llm import byte_bpe

    for name, value in (("CUT_BYTES", 4000), ("STEP_BYTES", 1000), ("MEMORY_PIECES", 400), ("MEMORY_SIGNS", 4000)):
        monkeypatch.setattr(byte_bpe, name, value, raising=False)
    texts = [f"often met words {i}, rare{i} Often.\n met  twice {'z' * 5000 if i % 97 == 0 else ''}" if i % 5 else ["", " ", None, "often often "][i // 5 % 4] for i in range(2000)]
    coder, asked, got = byte_bpe.PieceCoder(BYTES, True), [], []
    learn = coder.library.encode
    monkeypatch.setattr(coder.library, "encode", lambda pieces: asked.extend(pieces) or learn(pieces))
    monkeypatch.setattr(byte_bpe, "_coder", lambda path, with_ids: coder)
    for part in byte_bpe.encode_texts(BYTES, pa.array(texts)):
        got += part.to_pylist()
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(asked) > 2000 and asked.count(" words") == 1
    assert len(coder.lengths) <= 400 + 4000


def test_known_pieces_take_little_memory():
    """Workers share an executor's memory: a known piece takes no Python object, only its signs, ids and some numbers."""
    import tracemalloc

    import pyarrow as pa

    from cohortloom.llm import byte_bpe

    coder, texts = byte_bpe.PieceCoder(BYTES, True), pa.array([" ".join(f"w{i * 50 + j}x" for j in range(50)) for i in range(1000)])
    before = pa.total_allocated_bytes()
    tracemalloc.start()
    try:
        for _ in coder.batches(texts):
            pass
        del _
        taken = tracemalloc.get_traced_memory()[0] + pa.total_allocated_bytes() - before
    finally:
        tracemalloc.stop()
    assert len(coder.lengths) == 50_000 and taken < 120 * 50_000


@pytest.mark.parametrize("alike", [lambda piece: 7, len, lambda piece: hash(piece) % 50 - 25])
def test_pieces_of_equal_hash_are_told_apart(library, monkeypatch, alike):
    """Also while pieces are forgotten, and in texts that are not cut at each space."""
    import pyarrow as pa

    from cohortloom.llm import byte_bpe

    for name, value in (("CUT_BYTES", 400), ("STEP_BYTES", 100), ("MEMORY_PIECES", 200), ("MEMORY_SIGNS", 2000)):
        monkeypatch.setattr(byte_bpe, name, value)
    monkeypatch.setattr(byte_bpe, "hash", alike, raising=False)
    coder = byte_bpe.PieceCoder(BYTES, True)
    monkeypatch.setattr(byte_bpe, "_coder", lambda path, with_ids: coder)
    texts = [*noise(300, 4), *[f"met often w{i} w{i % 9} w{i}" for i in range(300)], "", None, " "]
    got = [ids for part in byte_bpe.encode_texts(BYTES, pa.array(texts)) for ids in part.to_pylist()]
    assert got == [library.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_frequent_units_outlast_a_full_memory(monkeypatch):
    """Paths stay the same while rare units are forgotten, and frequent units are not searched again."""
    import pyarrow as pa

    from cohortloom.llm import pieces as module

    texts = [f"often met words {i} rare{i} oft  met {'\u4e01x' * 90}" if i % 5 else ["", " ", None, "often often "][i // 5 % 4] for i in range(600)]
    kept = [[part.to_pylist() for part in found] for text in texts for found in module.encode_texts(MODEL, 3, pa.array([text], pa.string()))]
    monkeypatch.setattr(module, "_MEMORY", 3000)
    known, searched = module._Known(module.lattice(MODEL), 3), []
    search = known.tree.search_many
    monkeypatch.setattr(known.tree, "search_many", lambda units: searched.extend(units) or search(units))
    monkeypatch.setattr(module, "_memory", lambda path, n: known if hasattr(known, "forget") else [known])
    got = [[part.to_pylist() for part in found] for text in texts for found in module.encode_texts(MODEL, 3, pa.array([text], pa.string()))]
    assert got == kept
    assert len(searched) > 480 and searched.count("\u2581words") == 1


def test_counts_of_a_sentencepiece_model(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = noise(50, 3)
    got = with_token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), MODEL, 5).collect()
    assert all(r["n_tokens"] == len(model.encode(texts[r["doc_id"]])) for r in got)


def test_awkward_rows_are_counted(docs, odd, nothing, library):
    for df in (docs, odd):
        got = with_token_counts(df, BYTES, 512).collect()
        assert len(got) == docs.count()
        assert all(r["n_tokens"] == len(library.encode(r["text"] or "", add_special_tokens=False).ids) for r in got)
    assert with_token_counts(nothing, BYTES, 512).count() == 0


def test_token_files_hold_all_documents_in_order(spark, odd, library, tmp_path):
    folder = str(tmp_path / "tokens")
    write_token_files(odd, folder, BYTES, end=0, ranges=4)
    files = read_token_files(spark, folder)
    rows = files.withColumn("crc", ids_crc32(F.col("ids"))).join(token_starts(files), ["part", "place"]).orderBy("part", "place").collect()
    texts = sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["text"] or "") for r in odd.collect())
    start = 0
    for row, ((known, doc_id), text) in zip(rows, texts, strict=True):
        ids = [*library.encode(text, add_special_tokens=False).ids, 0]
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids"]) == (doc_id if known else None, start, len(ids), ids)
        assert row["crc"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_token_files_of_an_empty_table(spark, nothing, tmp_path):
    write_token_files(nothing, str(tmp_path / "none"), BYTES)
    assert read_token_files(spark, str(tmp_path / "none")).count() == 0


def test_token_file_format(spark, docs, tmp_path):
    """Dictionary for ids, delta encoding for the rising numbers, and a page index for each."""
    import glob

    import pyarrow.parquet as pq

    write_token_files(docs, str(tmp_path / "t"), BYTES, ranges=1)
    meta = pq.ParquetFile(max(glob.glob(f"{tmp_path}/t/*.parquet"))).metadata.row_group(0)
    columns = {meta.column(i).path_in_schema: meta.column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in columns["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["place"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())


def all_paths(tree, unit):
    def go(at):
        if at == len(unit):
            yield 0.0, []
        for end in range(at + 1, min(len(unit), at + tree.longest) + 1):
            score = tree.scores.get(unit[at:end])
            if score is None and end == at + 1:
                score = tree.byte_score * len(unit[at].encode())
            if score is not None:
                for rest, cuts in go(end):
                    yield score + rest, [end, *cuts]

    return sorted((s for s, _ in go(0)), reverse=True)


@pytest.mark.parametrize("unit", ["▁thentien", "▁éauleê", "▁a", "▁x\ny", "▁漢字", "▁▁the", "▁queue,"])
def test_best_segmentations_are_the_best_of_all(unit):
    tree = lattice(MODEL)
    every = all_paths(tree, unit)
    assert [s for s, _ in tree.n_best(unit, 5)] == every[:5]
    best, gap, ids = tree.search_many([unit, unit])
    assert best[1] == every[0] and (len(every) == 1 or gap[1] == every[0] - every[1])
    assert b"".join(tree.texts[i] for i in ids[1]).decode() == unit.replace("▁", " ")


@pytest.mark.parametrize("unit", ["▁--------", "-" * 11, "▁aaaaaaa", "▁......", "=" * 9, "▁漢漢漢", "▁the----the", "▁abababab"])
def test_ties_are_all_found(unit):
    """Runs of equal signs have many paths of one sum."""
    tree = lattice(MODEL)
    every = all_paths(tree, unit)
    for n in (1, 2, 3, 7):
        found = tree.n_best(unit, n)
        assert [s for s, _ in found] == every[:n] and len({tuple(ids) for _, ids in found}) == len(found)


@pytest.mark.parametrize("sign", ["-", "a", "漢", "=", "é"])
def test_long_runs_of_one_sign_take_seconds(spark, sign):
    import time

    df = spark.createDataFrame([(1, sign * 100_000)], "doc_id long, text string")
    start = time.time()
    row = with_pieces(df, MODEL).withColumn("again", decode_ids(MODEL, F.col("ids"))).first()
    assert row["again"] == sign * 100_000 and len(row["others"]) == {"漢": 0, "é": 1}.get(sign, 2)  # no piece has two of these; "▁é" is one
    assert time.time() - start < 60


def test_best_of_whole_texts(spark):
    """Two units at a time are few enough to try all paths of the whole text."""
    tree = lattice(MODEL)
    texts = ["the tion", "an on a", "ab  cd", "é 漢", " a", "a "]
    got = with_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), MODEL, n=4).collect()
    for row in got:
        every = all_paths(tree, "▁" + texts[row["doc_id"]].replace(" ", "▁"))[:4]
        assert [row["score"], *(o["score"] for o in row["others"])] == every
        for other in row["others"]:
            ids = other_ids(row["ids"], [(c["start"], c["length"], c["ids"]) for c in other["changes"]])
            assert b"".join(tree.texts[i] for i in ids).decode().removeprefix(" ") == texts[row["doc_id"]]


def test_pieces_round_trip(spark, odd, nothing):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate(noise(300, 4))], "doc_id long, text string")
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for df in (texts, odd):
        rows = with_pieces(df, MODEL).withColumn("again", decode_ids(MODEL, F.col("ids"))).collect()
        assert len(rows) == df.count()
        for r in rows:
            assert r["again"] == (r["text"] or "").replace("▁", " ")
            assert r["again"] == model.decode(r["ids"])
    assert with_pieces(nothing, MODEL).count() == 0
    assert [r for r in rows_of(with_pieces(odd, MODEL), "text", "ids", "score") if not r[0]] == [("", [], 0.0)] + [(None, [], 0.0)] * 2


def test_parts_of_long_units_are_told_from_units():
    """The same signs are one thing after a space and another inside a long unit; short and long ones meet in one text."""
    from cohortloom.llm.pieces import _Known

    known = _Known(lattice(MODEL), 3)
    cut = next(a + b for a in "qzé漢" for b in "漢jéx" if a + b not in known.tree.pairs)
    long = "a" * 70 + cut
    numbers = known.numbers(f"{cut[1]} {long}").tolist()
    assert [known.name(i) for i in numbers] == ["▁" + cut[1], *known._apart("▁" + long)]
    assert known.name(numbers[-1]) == cut[1] and numbers[-1] != numbers[0]
    assert known.numbers(f"{cut[1]} {long}").tolist() == numbers
