"""Projections and row-local expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import functions as fn
from cohortloom.queries.registry import Tables, query
from cohortloom.queries.standins import (
    ACCESSION, LINES, REVIEWED, SECOND_ACCESSION, accession, accession_sql, lines, reviewed, second_accession,
)


@query("SELECT o_orderpriority, o_orderkey, o_custkey FROM orders")
def select_reorder(t: Tables) -> DataFrame:
    return t.orders.select("o_orderpriority", "o_orderkey", "o_custkey")


_FLAGS, _STATUSES = ["A", "N", "R"], ["F", "O"]
_CELLS = [(f, s, f"qty_{f}_{s}-sum_ml") for f in _FLAGS for s in _STATUSES]


@query(
    "SELECT l_suppkey, "
    + ", ".join(
        f"CAST(sum(CASE WHEN l_returnflag = '{f}' AND l_linestatus = '{s}' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT)"
        f' AS "{n}"'
        for f, s, n in _CELLS
    )
    + " FROM lineitem GROUP BY l_suppkey"
)
def family_projection(t: Tables) -> DataFrame:
    cells = [
        F.sum(F.when((F.col("l_returnflag") == f) & (F.col("l_linestatus") == s), F.col("l_quantity").cast("long"))).alias(n)
        for f, s, n in _CELLS
    ]
    wide = t.lineitem.groupBy("l_suppkey").agg(*cells)
    names = fn.family_names("qty_{cls}_{region}-sum_ml", _STATUSES, _FLAGS)
    return wide.select("l_suppkey", *[fn.quoted(n) for n in names])


@query("SELECT c_custkey, c_nationkey, c_mktsegment FROM customer")
def drop_columns(t: Tables) -> DataFrame:
    return t.customer.drop("c_name", "c_acctbal")


@query("SELECT n_nationkey AS id, n_name AS label, n_regionkey FROM nation")
def rename_columns(t: Tables) -> DataFrame:
    return t.nation.withColumnsRenamed({"n_nationkey": "id", "n_name": "label"})


@query("SELECT p_partkey, 1 AS exclude_id FROM part")
def constant_column(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.lit(1).alias("exclude_id"))


@query("SELECT c_custkey, replace(replace(c_name, '#', ''), 'Customer', '') AS code FROM customer")
def literal_replace(t: Tables) -> DataFrame:
    return t.customer.select(
        "c_custkey", fn.literal_replace(fn.literal_replace("c_name", "#"), "Customer").alias("code")
    )


_TEXT = "'x1CT7 ' || replace(c_name, 'Customer#', 'CT20') || '1CT'"


@query(f"""
SELECT c_custkey, regexp_replace({_TEXT}, '.*CT', 'CT') AS last_part,
       regexp_replace({_TEXT}, '^.*?CT20', '') AS after_prefix, regexp_replace({_TEXT}, 'CT|1CT', '', 'g') AS no_code
FROM customer
""")
def regex_replace(t: Tables) -> DataFrame:
    text = F.concat(F.lit("x1CT7 "), fn.literal_replace("c_name", "Customer#", "CT20"), F.lit("1CT"))
    return t.customer.select(
        "c_custkey",
        fn.report_number(text).alias("last_part"),
        F.regexp_replace(text, "^.*?CT20", "").alias("after_prefix"),
        F.regexp_replace(text, "CT|1CT", "").alias("no_code"),
    )


@query(
    "SELECT o_orderkey, "
    + ", ".join(
        f"{accession_sql(text, mode)} AS {mode}_{i}"
        for i, text in enumerate([ACCESSION, SECOND_ACCESSION])
        for mode in ["plain", "dated", "manifest", "fallback"]
    )
    + " FROM orders"
)
def normalize_accession(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        *[
            fn.normalize_accession(text, mode).alias(f"{mode}_{i}")
            for i, text in enumerate([accession(), second_accession()])
            for mode in ["plain", "dated", "manifest", "fallback"]
        ],
    )


_SPACES = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"


@query(f"""
SELECT doc_id, regexp_replace(regexp_replace(chr(9) || text || ' ' || chr(10), '^{_SPACES}', ''), '{_SPACES}$', '') AS stripped
FROM documents
""")
def strip_whitespace(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("\t"), "text", F.lit(" \n"))
    return t.documents.select("doc_id", fn.strip_whitespace(padded).alias("stripped"))


@query("SELECT p_partkey, lower(upper(p_name)) AS name FROM part")
def lower_case(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.lower(F.upper("p_name")).alias("name"))


@query("""
SELECT page_id, split_part(url, '/', 4) AS lang, split_part(split_part(url, '://', 2), '/', 1) AS host,
       nullif(regexp_extract(url, '[?]ref=([^?]*)', 1), '') AS missing
FROM pages
""")
def split_part(t: Tables) -> DataFrame:
    return t.pages.select(
        "page_id",
        fn.split_part("url", ("/", 3)).alias("lang"),
        fn.split_part("url", ("://", 1), ("/", 0)).alias("host"),
        fn.split_part("url", ("?ref=", 1)).alias("missing"),
    )


@query("SELECT s_suppkey, '/share/images/' || CASE WHEN s_acctbal > 0 THEN replace(s_name, ' ', '') END AS file_path FROM supplier")
def concat_prefix(t: Tables) -> DataFrame:
    name = F.when(F.col("s_acctbal") > 0, F.col("s_name"))
    path = F.concat(F.lit("/share/images/"), name)
    return t.supplier.select("s_suppkey", fn.literal_replace(path, " ").alias("file_path"))


@query("SELECT 'scan_' || CAST(o_orderkey AS VARCHAR) AS id FROM orders")
def cast_string(t: Tables) -> DataFrame:
    return t.orders.select(F.concat(F.lit("scan_"), F.col("o_orderkey").cast("string")).alias("id"))


@query("SELECT p_partkey, lpad(printf('%X', p_size), 4, '0') AS code FROM part")
def hex_code(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", fn.hex_code("p_size").alias("code"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def parse_int_date(t: Tables) -> DataFrame:
    number = F.date_format("o_orderdate", "yyyyMMdd").cast("int")
    return t.orders.select("o_orderkey", fn.parse_int_date(number).cast("string").alias("day"))


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS parsed FROM events")
def parse_timestamp(t: Tables) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.lit("not known")).otherwise(F.col("ts").cast("string"))
    return t.events.select("event_id", fn.parse_timestamp(text).alias("parsed"))


@query("SELECT event_id, value AS centre, CAST(NULL AS DOUBLE) AS other FROM events")
def first_of_list_literal(t: Tables) -> DataFrame:
    text = F.col("value").cast("string")
    literal = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), text, F.lit(", 1]"))).otherwise(text)
    return t.events.select(
        "event_id", fn.first_of_list_literal(literal).alias("centre"), fn.first_of_list_literal("props").alias("other")
    )


@query("SELECT event_id, coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE -value END, 0.0) AS qc FROM events")
def fill_null(t: Tables) -> DataFrame:
    qc = F.when(F.col("event_type") != "error", -F.col("value"))
    return t.events.select("event_id", fn.fill_null(qc, 0.0).alias("qc"))


@query(f"SELECT doc_id, CAST(exclude IS NOT NULL AS INTEGER) AS reviewed FROM ({REVIEWED})")
def null_indicator(t: Tables) -> DataFrame:
    return reviewed(t).select("doc_id", fn.null_indicator("exclude").alias("reviewed"))


@query("SELECT doc_id, CASE WHEN quality = 1 OR toxic = 1 THEN 1 ELSE quality END AS exclude_id FROM labels")
def flag_combine(t: Tables) -> DataFrame:
    return t.labels.select("doc_id", fn.flag_combine("quality", "toxic").alias("exclude_id"))


@query("""
SELECT event_id, CASE WHEN event_type = 'click' AND value >= 50 THEN 'IPH-Exclude' WHEN event_type = 'view' AND value >= 50 THEN 'EAH-Exclude'
                      WHEN event_type = 'click' THEN 'IPH' WHEN event_type = 'view' THEN 'EAH' ELSE 'Unknown' END AS scan_status
FROM events
""")
def case_label(t: Tables) -> DataFrame:
    high = F.col("value") >= 50
    click, view = F.col("event_type") == "click", F.col("event_type") == "view"
    rules = [(click & high, "IPH-Exclude"), (view & high, "EAH-Exclude"), (click, "IPH"), (view, "EAH")]
    return t.events.select("event_id", fn.case_label(rules, "Unknown").alias("scan_status"))


@query(f"SELECT *, coalesce(iph, 0) + coalesce(eah, 0) + coalesce(ivh, 0) AS total FROM ({LINES})")
def row_sum(t: Tables) -> DataFrame:
    return lines(t).withColumn("total", fn.row_sum("iph", "eah", "ivh"))


@query(f"SELECT l_orderkey, l_partkey, l_linenumber, iph - eah AS change FROM ({LINES})")
def difference(t: Tables) -> DataFrame:
    return lines(t).select("l_orderkey", "l_partkey", "l_linenumber", (F.col("iph") - F.col("eah")).alias("change"))


@query("SELECT c_custkey, abs(c_acctbal) AS value_abs FROM customer")
def absolute(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.abs("c_acctbal").alias("value_abs"))


@query("""
WITH c AS (SELECT p_type, count(*) AS n, count(*) FILTER (p_size > 25) AS large FROM part GROUP BY p_type)
SELECT p_type, round_even(large / n * 100, 1) AS percent_large FROM c
""")
def round_half_even(t: Tables) -> DataFrame:
    counts = t.part.groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("p_size") > 25).alias("large")
    )
    return counts.select("p_type", fn.percent("large", "n").alias("percent_large"))


@query("""
SELECT event_id, round_even((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 3600000000.0, 0) AS hours FROM events
""")
def elapsed_hours(t: Tables) -> DataFrame:
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return t.events.select("event_id", fn.elapsed_hours(start, "ts").alias("hours"))


@query("""
WITH e AS (SELECT vec_id, embedding, CASE WHEN label = 0 THEN NULL ELSE CAST(label AS DOUBLE) END AS slope,
                  CASE WHEN label = 1 THEN NULL ELSE 0.5 END AS inter FROM embeddings)
SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos,
       greatest(least(CAST(embedding[i] AS DOUBLE) * coalesce(slope, 1) + coalesce(inter, 0), 0.25 + 1), 0.25 - 1) AS hu
FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM e)
""")
def array_rescale_clip(t: Tables) -> DataFrame:
    slope = F.when(F.col("label") != 0, F.col("label").cast("double"))
    inter = F.when(F.col("label") != 1, F.lit(0.5))
    clipped = fn.array_rescale_clip("embedding", slope, inter, F.lit(0.25), F.lit(3.0))
    return t.embeddings.select("vec_id", F.posexplode(clipped).alias("pos", "hu"))


@query("""
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS slice_num FROM embeddings WHERE label % 3 <> 0
UNION ALL SELECT vec_id, NULL FROM embeddings WHERE label % 3 = 0 AND label <> 0
""")
def shape_rank_and_depth(t: Tables) -> DataFrame:
    side, depth = F.lit(512), F.size("embedding")
    shape = (
        F.when(F.col("label") == 0, F.array(side, side, depth, F.lit(2)))
        .when(F.col("label") % 3 == 0, F.array(side, side))
        .otherwise(F.array(side, side, depth))
    )
    volumes = t.embeddings.select("vec_id", shape.alias("shape"))
    return volumes.where(fn.shape_rank("shape") != 4).select("vec_id", fn.shape_depth("shape").alias("slice_num"))
