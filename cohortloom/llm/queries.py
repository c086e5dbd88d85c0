"""The queries of this package: thin calls of its operators on the shared tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortloom.llm.alignment import align_tokens
from cohortloom.llm.brown import score_texts
from cohortloom.llm.byte_bpe import ids_crc32, with_token_counts
from cohortloom.llm.embeddings import near_copies
from cohortloom.llm.imatch import fingerprint_edits
from cohortloom.llm.manifest import leaf_digest, merkle_proofs, proof_digest, with_tampered
from cohortloom.llm.mixing import mix, sized
from cohortloom.llm.pieces import decode_ids, with_pieces
from cohortloom.llm.quality import fit_quality, with_quality
from cohortloom.llm.simhash import simhash_groups
from cohortloom.llm.token_files import read_token_files, token_starts, write_token_files
from cohortloom.llm.toxicity import fit_toxicity, with_toxicity
from cohortloom.llm.url_filter import judge_urls
from cohortloom.llm.words import doc_remainder
from cohortloom.session import scratch_path, settle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    rules = spark.createDataFrame(rules, "host string, path string, verdict string")
    return judge_urls(table(spark, folder, "pages").select("page_id", "url"), rules).drop("url")


ORACLES["op1_url_filters"] = r"""
    WITH parts AS (
        SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ), split AS (
        SELECT page_id,
            translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM parts
    ), ruled AS (
        SELECT *, CASE
            WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/'
        END AS rule
        FROM split
    )
    SELECT page_id, host, path, rule,
        CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
    FROM ruled
"""


@query
def op2_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(doc_remainder(F.col("doc_id"), 3) != 1)
    scored = with_quality(docs, fit_quality(docs, labels))
    return scored.select("doc_id", (doc_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


@query
def op3_embedding_copies(spark: SparkSession, folder: str) -> DataFrame:
    return near_copies(table(spark, folder, "embeddings"), threshold=0.98)


@query
def op4_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Encode, write in document order, read back and digest."""
    path = scratch_path(spark, "tokens")
    docs = table(spark, folder, "documents")
    write_token_files(docs, path, public_tokenizers.path("byte_bpe_50k.json"), end=0)
    files = read_token_files(spark, path)
    digests = files.select("doc_id", "part", "place", "n_tokens", ids_crc32(F.col("ids")).alias("ids_crc32"))
    return digests.join(token_starts(files), ["part", "place"]).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_class_lm(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the rows that are not held out."""
    docs = table(spark, folder, "documents")
    scored = score_texts(docs, doc_remainder(F.col("doc_id"), 7) != 2)
    held_out = (doc_remainder(F.col("doc_id"), 7) == 2).alias("held_out")
    return scored.select("doc_id", held_out, "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op6_imatch(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_edits(table(spark, folder, "documents"))


@query
def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = settle(sized(table(spark, folder, "documents")).select("doc_id", "source", "size"))
    return mix(docs, weights=(5, 2, 1), max_epochs=3).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op7_mixing"] = r"""
    WITH sized AS (
        SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
            ('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 4))::INT AS bucket
        FROM documents
    ), sources AS (
        SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
    ), weighed AS (
        SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::BIGINT AS weight
        FROM sources
    ), sorted AS (
        SELECT *, sum(3 * source_size) OVER o - 3 * source_size AS clamped, sum(weight) OVER () - sum(weight) OVER o + weight AS parts,
            sum(source_size) OVER () AS words
        FROM weighed
        WINDOW o AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
    ), level AS (
        SELECT words - clamped AS words, parts FROM sorted
        WHERE 3 * source_size * parts >= (words - clamped) * weight
        ORDER BY clamped LIMIT 1
    ), targets AS (
        SELECT source, source_size, CASE
            WHEN 3 * source_size * (SELECT parts FROM level) < (SELECT words FROM level) * weight THEN (3 * source_size)::DOUBLE
            ELSE ((SELECT words FROM level) * weight)::BIGINT::DOUBLE / (SELECT parts FROM level)::DOUBLE END AS target
        FROM weighed
    ), planned AS (
        SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS epochs FROM targets
    ), buckets AS (
        SELECT source, bucket, sum(size)::BIGINT AS words,
            (sum(sum(size)) OVER (PARTITION BY source ORDER BY bucket) - sum(size))::BIGINT AS before
        FROM sized GROUP BY source, bucket
    ), cuts AS (
        SELECT b.source, b.bucket AS cut, (p.target - p.epochs * p.source_size - b.before) / b.words AS part
        FROM buckets b JOIN planned p ON b.source IS NOT DISTINCT FROM p.source
        WHERE b.before <= p.target - p.epochs * p.source_size AND p.target - p.epochs * p.source_size < b.before + b.words
    )
    SELECT s.doc_id, s.size, p.source_size, p.target, (p.epochs * s.size + CASE
            WHEN s.bucket < c.cut THEN s.size WHEN s.bucket = c.cut THEN floor(c.part * s.size + 0.5) ELSE 0 END)::BIGINT AS taken
    FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
    LEFT JOIN cuts c ON s.source IS NOT DISTINCT FROM c.source
"""


@query
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = with_token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@query
def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The three best segmentations of each text, written down; the best is read back and decoded."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    # Only one thing is lost: the sign that stands for a space comes back as a space.
    plain = F.translate(F.coalesce("text", F.lit("")), "\u2581", " ")
    docs = table(spark, folder, "documents").select("doc_id", "text", F.md5(plain).alias("plain_md5"))
    found = settle(with_pieces(docs, model, n=3).drop("text"))
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_pieces"),
        ids_crc32(F.col("ids")).alias("ids_crc32"),
        "score",
        F.get("others.score", F.lit(0)).alias("second_score"),
        F.get("others.score", F.lit(1)).alias("third_score"),
        (F.md5(decode_ids(model, F.col("ids"))) == F.col("plain_md5")).alias("round_trip"),
    )


@query
def op10_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_groups(table(spark, folder, "documents"), shingle=3, max_bits=3)


@query
def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Learns from the rows that are not held out."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").where(doc_remainder(F.col("doc_id"), 4) != 2)
    scored = with_toxicity(docs, fit_toxicity(docs, labels))
    held_out = (doc_remainder(F.col("doc_id"), 4) == 2).alias("held_out")
    return scored.select("doc_id", held_out, "score", "predicted", F.size("passages").alias("n_passages"))


@query
def op12_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Proofs of all documents; in a fifth of them the text is lower-cased before the root is worked out again."""
    docs = table(spark, folder, "documents")
    before = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.when(doc_remainder(F.col("doc_id"), 5) == 0, leaf_digest([*before, lowered])).alias("tampered")
    leaves = docs.select("doc_id", "source", leaf_digest([*before, F.col("text")]).alias("leaf"), tampered)
    found = with_tampered(merkle_proofs(leaves, "source", "doc_id"))
    return found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


ORACLES["op12_manifest"] = r"""
    WITH RECURSIVE tampers AS (
        SELECT *, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, length(coalesce(doc_id::VARCHAR, '')) + 1), lambda i: ascii((doc_id::VARCHAR)[i::INT])::BIGINT)),
            lambda sum, sign: list_reduce([xor(sum, sign), 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)
        ) AS crc FROM documents
    ), heads AS (
        SELECT *, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id::VARCHAR, '-') || coalesce(strlen(source) || ':' || source, '-')
            || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars::VARCHAR, '-') AS head,
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
        FROM tampers
    ), leaves AS MATERIALIZED (
        SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
            CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-')) END AS tampered
        FROM heads
    ), placed AS MATERIALIZED (
        SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, leaf) AS row,
            row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS k, count(*) OVER (PARTITION BY source) AS m
        FROM leaves
    ), nodes AS (
        SELECT source, 0 AS level, k, m, leaf AS node FROM placed
        UNION ALL
        SELECT source, level + 1, k // 16, (max(m) + 15) // 16, sha256(string_agg(node, '' ORDER BY k)) FROM nodes WHERE m > 1 GROUP BY source, level, k // 16
    ), kept AS MATERIALIZED (SELECT * FROM nodes
    ), subroots AS MATERIALIZED (
        SELECT source, node AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS sources
        FROM kept WHERE m = 1
    ), uppers AS (
        SELECT 0 AS level, place AS k, sources AS m, subroot AS node FROM subroots
        UNION ALL
        SELECT level + 1, k // 16, (max(m) + 15) // 16, sha256(string_agg(node, '' ORDER BY k)) FROM uppers WHERE m > 1 GROUP BY level, k // 16
    ), top AS MATERIALIZED (SELECT * FROM uppers
    ), steps AS (
        SELECT p.row, n.level AS step, string_agg(n.node, '' ORDER BY n.k) FILTER (WHERE n.k < p.k >> (4 * n.level)) AS before,
            string_agg(n.node, '' ORDER BY n.k) FILTER (WHERE n.k > p.k >> (4 * n.level)) AS after
        FROM placed p JOIN kept n ON p.source IS NOT DISTINCT FROM n.source AND n.m > 1 AND n.k // 16 = p.k >> (4 * n.level + 4)
        GROUP BY ALL
        UNION ALL
        SELECT p.row, s.height + n.level, string_agg(n.node, '' ORDER BY n.k) FILTER (WHERE n.k < s.place >> (4 * n.level)),
            string_agg(n.node, '' ORDER BY n.k) FILTER (WHERE n.k > s.place >> (4 * n.level))
        FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source JOIN top n ON n.m > 1 AND n.k // 16 = s.place >> (4 * n.level + 4)
        GROUP BY ALL
    ), known AS MATERIALIZED (SELECT row, step, coalesce(before, '') AS before, coalesce(after, '') AS after FROM steps
    ), folds AS (
        SELECT row, 0 AS step, coalesce(tampered, leaf) AS node FROM placed
        UNION ALL
        SELECT f.row, f.step + 1, sha256(k.before || f.node || k.after) FROM folds f JOIN known k ON f.row = k.row AND f.step = k.step
    ), folded AS (SELECT row, max_by(node, step) AS folded_root FROM folds GROUP BY row
    ), proofs AS (SELECT row, sha256(string_agg(before || after, '' ORDER BY step)) AS proof_sha256 FROM known GROUP BY row)
    SELECT p.doc_id, p.leaf, s.subroot, t.node AS root, coalesce(q.proof_sha256, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = t.node AS verified
    FROM placed p JOIN subroots s ON p.source IS NOT DISTINCT FROM s.source JOIN top t ON t.m = 1
        JOIN folded f ON p.row = f.row LEFT JOIN proofs q ON p.row = q.row
"""


@query
def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return align_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
