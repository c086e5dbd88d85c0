"""Values along a subject's history, numbering, samples and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import operators as ops
from cohortloom.queries.registry import Tables, query
from cohortloom.queries.standins import LINES, LINES_ORDER, LINES_ORDER_SQL, SCANS, lines, scans


@query("""
SELECT o_orderkey, o_custkey, CAST(dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderstatus) AS INTEGER) AS scan_number
FROM orders
""")
def dense_rank_per_subject(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return ops.dense_rank_per_subject(rows, "o_custkey", ["o_orderdate", "o_orderstatus"]).drop(
        "o_orderdate", "o_orderstatus"
    )


@query(f"SELECT uid, id, folder, vol, max(vol) OVER (PARTITION BY uid, folder) AS max_vol FROM ({SCANS})")
def group_max_broadcast(t: Tables) -> DataFrame:
    return ops.group_max_on_rows(scans(t).select("uid", "id", "folder", "vol"), ["uid", "folder"], "vol", "max_vol")


@query(f"""
SELECT uid, id, qc, first_value(qc IGNORE NULLS) OVER (PARTITION BY uid ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS qc_first,
       first_value(nullif(series, 'click') IGNORE NULLS) OVER (PARTITION BY uid ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS series_first
FROM ({SCANS})
""")
def first_value_per_subject(t: Tables) -> DataFrame:
    rows = scans(t).select("uid", "id", "ts", "qc", F.nullif("series", F.lit("click")).alias("series"))
    firsts = ops.first_on_rows(rows, "uid", ["ts", "id"], {"qc": "qc_first", "series": "series_first"})
    return firsts.drop("ts", "series")


_FIRST = (
    "first_value({0} IGNORE NULLS) OVER (PARTITION BY uid ORDER BY "
    + LINES_ORDER_SQL
    + " ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
)


@query(f"""
WITH f AS (SELECT *, {_FIRST.format("iph")} AS iph_first, {_FIRST.format("eah")} AS eah_first, {_FIRST.format("ivh")} AS ivh_first FROM ({LINES}))
SELECT *, iph - iph_first AS change_iph, eah - eah_first AS change_eah, ivh - ivh_first AS change_ivh FROM f
""")
def change_from_baseline(t: Tables) -> DataFrame:
    return ops.baseline_change(lines(t), "uid", LINES_ORDER, ["iph", "eah", "ivh"])


@query(f"""
WITH s AS (SELECT *, dense_rank() OVER (PARTITION BY uid ORDER BY ts, folder) AS scan_number FROM ({SCANS})),
k AS (SELECT * FROM s WHERE id NOT IN (SELECT event_id FROM events WHERE event_type = 'error')),
f AS (SELECT *, first_value(vol) OVER (PARTITION BY uid ORDER BY scan_number, id) AS vol_first FROM k)
SELECT uid, id, vol, vol_first, vol - vol_first AS change_vol, max(vol - vol_first) OVER (PARTITION BY uid) AS max_change_vol FROM f
""")
def rebaseline_after_exclusion(t: Tables) -> DataFrame:
    rows = scans(t).select("uid", "id", "ts", "folder", "vol")
    numbered = ops.dense_rank_per_subject(rows, "uid", ["ts", "folder"])
    excluded = t.events.where(F.col("event_type") == "error").select(F.col("event_id").alias("id_to_remove"))
    out = ops.rebaseline_after_exclusion(
        numbered, excluded, "id", "id_to_remove", "uid", ["scan_number", "id"], ["vol"], greatest="max_change_{}"
    )
    return out.select("uid", "id", "vol", "vol_first", "change_vol", "max_change_vol")


@query(f"""
WITH f AS (SELECT DISTINCT folder FROM (SELECT * FROM ({SCANS}) QUALIFY row_number() OVER (PARTITION BY uid ORDER BY ts, id) = 1))
SELECT uid, id, folder, vol FROM ({SCANS}) WHERE folder NOT IN (SELECT folder FROM f)
""")
def followup_rows(t: Tables) -> DataFrame:
    rows = scans(t).select("uid", "id", "ts", "folder", "vol")
    return ops.followup_rows(rows, "uid", "ts", "folder", ["id"]).drop("ts")


@query("SELECT doc_id, source, 'scan_' || row_number() OVER (ORDER BY source, doc_id) AS id FROM documents")
def global_row_id(t: Tables) -> DataFrame:
    numbered = ops.global_row_id(t.documents.select("doc_id", "source"), ["source", "doc_id"])
    return numbered.select("doc_id", "source", F.concat(F.lit("scan_"), F.col("row_id").cast("string")).alias("id"))


@query("""
SELECT c_custkey, c_mktsegment, c_acctbal FROM customer
ORDER BY nullif(c_mktsegment, 'BUILDING') ASC NULLS LAST, c_acctbal DESC NULLS LAST, c_custkey
""")
def sort_multi(t: Tables) -> DataFrame:
    rows = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    rows = rows.withColumn("segment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    return ops.sort_multi(rows, ("segment", True), ("c_acctbal", False), ("c_custkey", True)).drop("segment")


@query("SELECT * FROM customer ORDER BY md5('1148:' || c_custkey), c_custkey LIMIT 20")
def sample_n(t: Tables) -> DataFrame:
    return ops.sample_n(t.customer, "c_custkey", 20, 1148)


@query("""
WITH r AS (SELECT *, row_number() OVER (ORDER BY md5('1300:' || c_custkey)) AS rn, count(*) OVER () AS n FROM customer)
SELECT c_custkey, c_acctbal, CASE WHEN rn <= ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM r
""")
def exact_split(t: Tables) -> DataFrame:
    return ops.split_exact(t.customer.select("c_custkey", "c_acctbal"), "c_custkey", 0.3, 1300)
