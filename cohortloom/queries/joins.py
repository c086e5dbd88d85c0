"""Joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom import functions as fn, operators as ops
from cohortloom.queries.registry import Tables, query
from cohortloom.queries.standins import (
    ACCESSION, SCANS, SECOND_ACCESSION, accession, accession_sql, scans, second_accession,
)


@query("SELECT o.*, c.* FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey")
def join_inner_diff_keys(t: Tables) -> DataFrame:
    return ops.join_on(t.orders, t.customer, [("o_custkey", "c_custkey")])


@query("""
WITH a AS (SELECT l_orderkey, l_linenumber, count(*) AS n, max(l_quantity) AS top FROM lineitem GROUP BY 1, 2)
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, a.n, a.top
FROM lineitem l JOIN a ON l.l_orderkey = a.l_orderkey AND l.l_linenumber = a.l_linenumber
""")
def join_inner_multi_key(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    sums = t.lineitem.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max("l_quantity").alias("top"))
    return ops.join_ns(t.lineitem.select(*keys, "l_partkey", "l_quantity"), sums, keys)


@query("""
WITH e AS (SELECT event_id, user_id, nullif(event_type, 'error') AS event_type FROM events),
c AS (SELECT user_id, event_type, count(*) AS n FROM e GROUP BY 1, 2)
SELECT e.*, c.n FROM e JOIN c ON e.user_id = c.user_id AND e.event_type IS NOT DISTINCT FROM c.event_type
""")
def join_natural(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", F.nullif("event_type", F.lit("error")).alias("event_type"))
    return ops.natural_join(e, e.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")))


@query("""
WITH d AS (SELECT doc_id, nullif(lang, 'en') AS lang FROM documents),
l AS (SELECT lang, count(*) AS n FROM d GROUP BY lang)
SELECT d.doc_id, d.lang, l.n FROM d JOIN l ON d.lang IS NOT DISTINCT FROM l.lang
""")
def join_null_safe(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"))
    return ops.join_ns(d, d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), ["lang"])


@query("SELECT d.doc_id, d.source, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def join_left(t: Tables) -> DataFrame:
    return ops.join_ns(t.documents.select("doc_id", "source"), t.labels, ["doc_id"], "left")


@query("""
SELECT n.n_nationkey AS nation, n.n_name, s.s_suppkey
FROM (SELECT s_suppkey, CASE WHEN s_acctbal > 8000 THEN s_nationkey END AS nation FROM supplier) s
RIGHT JOIN nation n ON s.nation = n.n_nationkey
""")
def join_right(t: Tables) -> DataFrame:
    rich = t.supplier.select("s_suppkey", F.when(F.col("s_acctbal") > 8000, F.col("s_nationkey")).alias("nation"))
    nations = t.nation.select(F.col("n_nationkey").alias("nation"), "n_name")
    return ops.join_ns(rich, nations, ["nation"], "right").select("nation", "n_name", "s_suppkey")


@query("""
WITH c AS (SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -c_custkey END AS cust, c_acctbal FROM customer),
o AS (SELECT CASE WHEN o_totalprice > 450000 THEN o_custkey ELSE o_custkey % 100 - 1000000 END AS cust, count(*) AS n FROM orders GROUP BY 1)
SELECT coalesce(c.cust, o.cust) AS cust, c.c_acctbal, o.n,
       CASE WHEN c.cust IS NULL THEN 'right_only' WHEN o.cust IS NULL THEN 'left_only' ELSE 'both' END AS _merge
FROM c FULL JOIN o ON c.cust = o.cust
""")
def join_outer_indicator(t: Tables) -> DataFrame:
    c = t.customer.select(F.when(F.col("c_acctbal") > 0, F.col("c_custkey")).otherwise(-F.col("c_custkey")).alias("cust"), "c_acctbal")
    other = F.col("o_custkey") % 100 - 1_000_000
    o = t.orders.groupBy(F.when(F.col("o_totalprice") > 450000, F.col("o_custkey")).otherwise(other).alias("cust"))
    return ops.outer_with_origin(c, o.agg(F.count(F.lit(1)).alias("n")), ["cust"])


@query("SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_anti(t: Tables) -> DataFrame:
    return ops.join_on(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")], "anti")


@query("SELECT * FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def join_semi(t: Tables) -> DataFrame:
    return ops.join_on(t.orders, t.lineitem, [("o_orderkey", "l_orderkey")], "semi")


# Only sales of 49 pieces have a part number here: the list holds nulls, which must not empty the result.
@query("""
SELECT * FROM part WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT CASE WHEN l_quantity = 49 THEN l_partkey END AS id FROM lineitem) WHERE id = p_partkey)
""")
def join_not_in(t: Tables) -> DataFrame:
    listed = t.lineitem.select(F.when(F.col("l_quantity") == 49, F.col("l_partkey")).alias("id"))
    return ops.not_in(t.part, "p_partkey", listed, "id")


@query("""
SELECT o.o_orderkey, o.o_custkey, d.l_shipdate
FROM orders o JOIN (SELECT DISTINCT l_orderkey, l_shipdate FROM lineitem) d ON o.o_orderkey = d.l_orderkey
""")
def join_distinct_dim(t: Tables) -> DataFrame:
    shipped = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    return ops.join_distinct(t.orders.select("o_orderkey", "o_custkey"), shipped, ["o_orderkey"], ["l_shipdate"])


# Pending orders are listed under their own number, customers with a high balance under theirs; the others have none.
# Orders with a key that 7 divides have no first number, those with a customer that 5 divides no second one.
WANTED_1 = f"CASE WHEN o_orderkey % 7 <> 0 THEN {ACCESSION} END"
WANTED_2 = f"CASE WHEN o_custkey % 5 <> 0 THEN {SECOND_ACCESSION} END"
MANIFEST = f"""
SELECT CASE WHEN o_orderstatus = 'P' THEN {ACCESSION} END AS accession, 'order/' || o_orderkey AS folder, 'a' AS list FROM orders
UNION ALL
SELECT CASE WHEN c_acctbal > 4000 THEN '*1CT20' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') END, 'customer/' || c_custkey, 'b' FROM customer
"""


def wanted_numbers() -> tuple[Column, Column]:
    return F.when(F.col("o_orderkey") % 7 != 0, accession()), F.when(F.col("o_custkey") % 5 != 0, second_accession())


def manifests(t: Tables) -> tuple[DataFrame, DataFrame]:
    by_order = t.orders.select(
        F.when(F.col("o_orderstatus") == "P", accession()).alias("accession"),
        F.concat(F.lit("order/"), F.col("o_orderkey").cast("string")).alias("folder"),
    )
    number = F.col("c_custkey").cast("string")
    by_customer = t.customer.select(
        F.when(F.col("c_acctbal") > 4000, F.concat(F.lit("*1CT20"), F.lpad(number, 6, "0"))).alias("accession"),
        F.concat(F.lit("customer/"), number).alias("folder"),
    )
    return by_order, by_customer


@query(f"""
WITH w AS (SELECT o_orderkey, {accession_sql(WANTED_1, "dated")} AS k1, {accession_sql(WANTED_2, "fallback")} AS k2 FROM orders),
m AS (SELECT {accession_sql("accession", "manifest")} AS mk, folder FROM ({MANIFEST}))
SELECT DISTINCT w.*, m.mk, m.folder FROM w JOIN m ON w.k1 = m.mk
UNION
SELECT DISTINCT w.*, m.mk, m.folder FROM w LEFT JOIN m ON w.k2 = m.mk WHERE NOT EXISTS (SELECT 1 FROM m AS n WHERE n.mk = w.k1)
""")
def waterfall_match(t: Tables) -> DataFrame:
    first, second = wanted_numbers()
    wanted = t.orders.select(
        "o_orderkey",
        fn.normalize_accession(first, "dated").alias("k1"),
        fn.normalize_accession(second, "fallback").alias("k2"),
    )
    by_order, by_customer = manifests(t)
    listed = by_order.unionByName(by_customer).select(fn.normalize_accession("accession", "manifest").alias("mk"), "folder")
    return ops.waterfall(wanted, listed, [("k1", "mk"), ("k2", "mk")])


# Scans with a report per user and series, and hand picks: the purchases of the first days, by id.
CHOICE_BASE = f"""
SELECT uid, id, folder, series, uid || '-' || series AS report, coalesce(qc, 0) AS qc,
       CASE WHEN vol < 50 THEN 1 ELSE 2 END AS scan_number FROM ({SCANS})
"""
CHOICE_PICKS = f"""
SELECT uid, id AS id_to_keep FROM ({SCANS}) WHERE series = 'purchase' AND vol >= 150
UNION ALL SELECT uid, id FROM ({SCANS}) WHERE series = 'view' AND vol >= 250
"""


def choice_base(t: Tables) -> DataFrame:
    return scans(t).select(
        "uid", "id", "folder", "series",
        F.concat(F.col("uid").cast("string"), F.lit("-"), "series").alias("report"),
        fn.fill_null("qc", 0.0).alias("qc"),
        F.when(F.col("vol") < 50, 1).otherwise(2).alias("scan_number"),
    )


def choice_picks(t: Tables) -> DataFrame:
    s, vol = scans(t), F.col("vol")
    hits = ((F.col("series") == "purchase") & (vol >= 150)) | ((F.col("series") == "view") & (vol >= 250))
    return s.where(hits).select("uid", F.col("id").alias("id_to_keep"))


def override_sql(base: str, picks: str) -> str:
    """The rule of hand picks and default choice, written as SQL on (uid, report, folder, scan_number, id, qc)."""
    return f"""
b AS ({base}),
crowded AS (SELECT *, count(*) OVER (PARTITION BY uid, folder, scan_number) AS group_rows FROM b),
e AS (SELECT * FROM crowded WHERE group_rows >= 2),
m AS (SELECT e.* FROM e JOIN ({picks}) p ON e.uid = p.uid AND e.id = p.id_to_keep),
a AS (SELECT * FROM e WHERE report NOT IN (SELECT report FROM m)
      QUALIFY row_number() OVER (PARTITION BY uid, report ORDER BY qc, id) = 1),
c AS (SELECT uid, report, folder, id FROM a UNION ALL SELECT uid, report, folder, id FROM m),
chosen AS (
  SELECT b.* FROM b WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.uid = b.uid AND c.report = b.report AND c.folder = b.folder)
  UNION ALL
  SELECT b.* FROM b JOIN c ON c.uid = b.uid AND c.report = b.report AND c.folder = b.folder AND c.id = b.id)
"""


@query(f"WITH {override_sql(CHOICE_BASE, CHOICE_PICKS)} SELECT * FROM chosen")
def override_selection(t: Tables) -> DataFrame:
    return ops.override(
        choice_base(t), choice_picks(t), "id_to_keep", "uid", "report", "folder", "scan_number", "id", "qc", ["id"]
    )


@query(f"""
SELECT * EXCLUDE (has_variant) FROM (
  SELECT *, bool_or(series = 'purchase') OVER (PARTITION BY uid, folder) AS has_variant FROM ({SCANS}))
WHERE series = 'purchase' OR NOT has_variant
""")
def prefer_variant(t: Tables) -> DataFrame:
    return ops.prefer(scans(t), F.col("series") == "purchase", ["uid", "folder"])


@query("""
WITH p AS (SELECT lower(regexp_extract(url, '^[^/]*//[^/]*/[^/]*/[0-9]', 0)) AS prefix FROM pages WHERE split_part(url, '/', 4) = 'en')
SELECT page_id, url FROM pages WHERE EXISTS (SELECT 1 FROM p WHERE starts_with(lower(url), p.prefix))
""")
def join_path_prefix(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "url")
    english = pages.where(fn.split_part("url", ("/", 3)) == "en")
    prefixes = english.select(F.regexp_extract("url", "^[^/]*//[^/]*/[^/]*/[0-9]", 0).alias("prefix"))
    return ops.prefix_semi(pages, "url", prefixes, "prefix")


@query("SELECT page_id, url FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE split_part(url, '/', 4) = 'fr')")
def anti_path_list(t: Tables) -> DataFrame:
    pages = t.pages.select("page_id", "url")
    listed = pages.where(fn.split_part("url", ("/", 3)) == "fr").select(F.col("url").alias("image"))
    return ops.anti_path_list(pages, "url", listed, "image")
