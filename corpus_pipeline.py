"""A training corpus from ``documents``: good texts, no near copies, mixed to target weights, cut into pieces.

Each stage takes (session, documents, folder of the tables) and returns a DataFrame, which is written as Parquet and
read again as the next stage's documents. All but the last return the columns of their documents, extra ones included.
Null and empty texts, null and repeated ids and empty tables are handled as each operator says.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm.mixing import mix, mixed_copies, sized
from cohortloom.llm.pieces import with_pieces
from cohortloom.llm.quality import fit_quality, with_quality
from cohortloom.llm.simhash import keep_one_of_each
from cohortloom.llm.words import doc_remainder
from cohortloom.session import run_folder, scratch_path, settle


def _aside(docs: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """Columns that an operator would replace, under other names, and the way back."""
    own = {f"__own_{c}": c for c in docs.columns if c.lower() in names}
    return docs.withColumnsRenamed({c: o for o, c in own.items()}), own


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject. It learns from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet").where(doc_remainder(F.col("doc_id"), 3) != 1)
    model = fit_quality(docs, labels)
    rows, own = _aside(docs, ["score", "predicted"])
    kept = with_quality(rows, model).where("predicted = 1").drop("score", "predicted")
    return kept.withColumnsRenamed(own).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs, shingle=3, max_bits=3)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that the sources have their target weights, at most three epochs of each."""
    rows, own = _aside(docs, ["size", "source_size", "target", "taken"])
    # Written down with their sizes: the mix goes over the sizes twice, and counting words is most of its work.
    mixed = mixed_copies(mix(settle(sized(rows)), weights=(5, 2, 1), max_epochs=3), length="n_chars")
    return mixed.drop("size", "source_size", "target", "taken").withColumnsRenamed(own).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_pieces, ids, score, others``: the best segmentation of each text and the next two."""
    found = with_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"), n=3)
    return found.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_pieces"), "ids", "score", "others")


STAGES = [("quality", quality), ("simhash", near_copies), ("mixing", mixing), ("sentencepiece", encoding)]

# Neither the classifier nor the search for near copies and segmentations can be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again.

    The stages and the steps they write down are deleted at the end; only the last stage's table stays.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    result = scratch_path(spark, "result")
    with run_folder(spark):
        for i, (name, stage) in enumerate(STAGES, 1):
            path = result if i == len(STAGES) else scratch_path(spark, name)
            stage(spark, docs, sf_dir).write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
