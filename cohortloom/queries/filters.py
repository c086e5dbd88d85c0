"""Filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import functions as fn, operators as ops
from cohortloom.queries.registry import Tables, query
from cohortloom.queries.standins import LINES, REVIEWED, SCANS, lines, reviewed, scans


@query("SELECT page_id, url FROM pages WHERE lower(url) LIKE '%/en/%' OR lower(url) LIKE '%.html%'")
def filter_contains_ci(t: Tables) -> DataFrame:
    return t.pages.select("page_id", "url").where(fn.contains_any("url", ["/EN/", ".HTML"]))


@query("""
SELECT 'part' AS source, p_partkey AS id FROM part WHERE NOT (lower(p_name) LIKE '%ring%' OR lower(p_name) LIKE '%bolt%')
UNION ALL
SELECT 'document', doc_id FROM documents WHERE NOT (lower(text) LIKE '%email%' OR lower(text) LIKE '%license%')
""")
def filter_exclude_words(t: Tables) -> DataFrame:
    parts = t.part.where(fn.contains_none("p_name", ["RING", "Bolt"]))
    documents = t.documents.where(fn.contains_none("text", ["EMAIL", "License"]))
    return parts.select(F.lit("part").alias("source"), F.col("p_partkey").alias("id")).unionByName(
        documents.select(F.lit("document").alias("source"), F.col("doc_id").alias("id"))
    )


@query("SELECT event_id, event_type FROM events WHERE event_type NOT IN ('error', 'signup')")
def filter_in_list(t: Tables) -> DataFrame:
    return t.events.select("event_id", "event_type").where(fn.not_listed("event_type", ["error", "signup"]))


@query(f"""
SELECT id, vol, qc FROM ({SCANS}) WHERE qc IS NULL OR (qc >= -100 AND qc < -30) OR id IN (1, 2, 3)
""")
def filter_range_keep_null(t: Tables) -> DataFrame:
    return scans(t).select("id", "vol", "qc").where(fn.range_or_listed("qc", -100, -30, "id", [1, 2, 3]))


@query(f"SELECT * FROM ({LINES}) WHERE iph <= 10 AND eah <= 4 AND ivh <= 5")
def filter_all_thresholds(t: Tables) -> DataFrame:
    return lines(t).where(fn.all_of([F.col("iph") <= 10, F.col("eah") <= 4, F.col("ivh") <= 5]))


@query(f"SELECT * FROM ({LINES}) WHERE iph >= 45 OR eah >= 8")
def filter_any_threshold(t: Tables) -> DataFrame:
    return lines(t).where(fn.any_at_least({"iph": 45, "eah": 8}))


@query(f"""
SELECT id, coalesce(qc <= -100 OR (vol >= 50 AND series IN ('purchase', 'error')), false) AS masked,
       coalesce(qc <= -100, false) OR vol >= 50 AS plain
FROM ({SCANS}) WHERE coalesce(qc <= -100, false) OR vol >= 50
""")
def filter_masked_or(t: Tables) -> DataFrame:
    first, second = F.col("qc") <= -100, F.col("vol") >= 50
    masked = fn.masked_or(first, second, F.col("series").isin("purchase", "error"))
    plain = fn.masked_or(first, second)
    return scans(t).where(plain).select("id", masked.alias("masked"), plain.alias("plain"))


@query(f"""
SELECT 'excluded' AS cohort, doc_id FROM ({REVIEWED}) WHERE exclude = 1
UNION ALL SELECT 'included', doc_id FROM ({REVIEWED}) WHERE exclude = 0
UNION ALL SELECT 'not excluded', doc_id FROM ({REVIEWED}) WHERE exclude IS NULL OR exclude <> 1
""")
def filter_not_flag(t: Tables) -> DataFrame:
    cohorts = [
        ("excluded", fn.flag_is("exclude", 1)),
        ("included", fn.flag_is("exclude", 0)),
        ("not excluded", fn.flag_is_not("exclude", 1)),
    ]
    labels = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in cohorts]))
    return reviewed(t).select(F.explode(labels).alias("cohort"), "doc_id")


@query(f"SELECT doc_id, n_chars FROM ({REVIEWED}) WHERE exclude IS NULL ORDER BY n_chars DESC NULLS LAST, doc_id")
def filter_null(t: Tables) -> DataFrame:
    rows = reviewed(t).select("doc_id", "n_chars", "exclude").where(F.col("exclude").isNull())
    return ops.sort_multi(rows.drop("exclude"), ("n_chars", False), ("doc_id", True))


@query("""
SELECT 'high' AS tail, c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 9000
UNION ALL SELECT 'very high', c_custkey, c_acctbal FROM customer WHERE c_acctbal > 9900
UNION ALL SELECT 'low', c_custkey, c_acctbal FROM customer WHERE c_acctbal <= -900
""")
def filter_magnitude_tail(t: Tables) -> DataFrame:
    balance = F.col("c_acctbal")
    tails = [("high", balance >= 9000), ("very high", balance > 9900), ("low", balance <= -900)]
    return ops.tail_lists(t.customer, tails, ["c_custkey", "c_acctbal"])


@query(f"""
WITH f AS (SELECT *, min(ts) OVER (PARTITION BY uid) AS first_ts FROM ({SCANS})),
h AS (SELECT *, round_even((epoch_us(ts) - epoch_us(first_ts)) / 3600000000.0, 0) AS time_since_first_scan FROM f)
SELECT uid, id, vol, time_since_first_scan FROM h WHERE time_since_first_scan <= 72
""")
def filter_time_window(t: Tables) -> DataFrame:
    rows = ops.within_hours(scans(t), "uid", "ts", 72)
    return rows.select("uid", "id", "vol", "time_since_first_scan")
