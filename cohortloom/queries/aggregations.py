"""Aggregations and reshaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cohortloom import functions as fn, operators as ops
from cohortloom.queries.registry import Tables, query
from cohortloom.queries.standins import HEADERS, LINES, REVIEWED, SCANS, headers, lines, reviewed, scans

_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@query(" UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows FROM {n}" for n in _TABLES))
def count_rows(t: Tables) -> DataFrame:
    counts = [getattr(t, n).agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("n_rows")) for n in _TABLES]
    return reduce(DataFrame.unionAll, counts)


@query("""
SELECT count(DISTINCT o_custkey) AS o_custkey, count(DISTINCT nullif(o_orderstatus, 'F')) AS status,
       count(DISTINCT o_orderdate) AS o_orderdate
FROM orders
""")
def distinct_counts(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("status", F.nullif("o_orderstatus", F.lit("F")))
    return ops.distinct_counts(rows, ["o_custkey", "status", "o_orderdate"])


@query("""
WITH s AS (SELECT user_id, true AS s0, event_type <> 'error' AS s1, event_type <> 'error' AND value >= 5 AND value < 100 AS s2,
                  event_type <> 'error' AND value >= 5 AND value < 100 AND ts < TIMESTAMP '2024-01-04 00:00:00' AS s3 FROM events)
SELECT CAST(step_no AS INTEGER) AS step_no, step, subjects, "rows" FROM (
  SELECT 0 AS step_no, 'all' AS step, count(DISTINCT user_id) FILTER (s0) AS subjects, count(*) FILTER (s0) AS "rows" FROM s
  UNION ALL SELECT 1, 'no error', count(DISTINCT user_id) FILTER (s1), count(*) FILTER (s1) FROM s
  UNION ALL SELECT 2, 'in range', count(DISTINCT user_id) FILTER (s2), count(*) FILTER (s2) FROM s
  UNION ALL SELECT 3, 'first days', count(DISTINCT user_id) FILTER (s3), count(*) FILTER (s3) FROM s)
""")
def attrition_funnel(t: Tables) -> DataFrame:
    steps = [
        ("all", F.lit(True)),
        ("no error", F.col("event_type") != "error"),
        ("in range", (F.col("value") >= 5) & (F.col("value") < 100)),
        ("first days", F.col("ts") < F.lit("2024-01-04 00:00:00").cast("timestamp_ntz")),
    ]
    return ops.funnel(t.events, steps, "user_id")


@query(f"""
SELECT count(*) - count(doc_id) AS doc_id, count(*) - count(lang) AS lang, count(*) - count(source) AS source,
       count(*) - count(n_chars) AS n_chars, count(*) - count(exclude) AS exclude, count(*) - count(artifact) AS artifact
FROM ({REVIEWED})
""")
def null_counts(t: Tables) -> DataFrame:
    return ops.null_counts(reviewed(t))


@query("""
WITH k AS (SELECT 'o_orderkey' AS name, CAST(o_orderkey AS VARCHAR) AS k FROM orders
           UNION ALL SELECT 'status', nullif(o_orderstatus, 'F') FROM orders),
g AS (SELECT name, k, count(*) AS n FROM k GROUP BY name, k)
SELECT name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys, sum(n) = count(*) AS is_unique FROM g GROUP BY name
""")
def unique_key_check(t: Tables) -> DataFrame:
    checks = [
        ops.unique_key_check(t.orders, "o_orderkey").withColumn("name", F.lit("o_orderkey")),
        ops.unique_key_check(
            t.orders.select(F.nullif("o_orderstatus", F.lit("F")).alias("status")), "status"
        ).withColumn("name", F.lit("status")),
    ]
    return checks[0].unionByName(checks[1])


@query(f"""
WITH c AS (SELECT folder, series, count(*) AS "count" FROM ({SCANS}) GROUP BY 1, 2)
SELECT folder, series, "count", CASE WHEN "count" > 1 THEN 'several' ELSE 'one' END AS size FROM c
""")
def group_count_having(t: Tables) -> DataFrame:
    counts = ops.group_counts(scans(t), ["folder", "series"])
    several = counts.where(F.col("count") > 1).withColumn("size", F.lit("several"))
    return several.unionByName(counts.where(F.col("count") == 1).withColumn("size", F.lit("one")))


@query("""
SELECT min(n) AS min_size, max(n) AS max_size, min(n) >= 2 AS at_least_2
FROM (SELECT count(*) AS n FROM events GROUP BY user_id)
""")
def min_group_size_check(t: Tables) -> DataFrame:
    return ops.group_size_range(t.events, ["user_id"]).withColumn("at_least_2", F.col("min_size") >= 2)


@query("SELECT * FROM orders QUALIFY count(*) OVER (PARTITION BY o_custkey) >= 10")
def min_rows_per_subject(t: Tables) -> DataFrame:
    return ops.min_rows_per_subject(t.orders, "o_custkey", 10)


@query(f"""
WITH m AS (SELECT uid, max(iph) AS max_iph, max(eah) AS max_eah, max(ivh) AS max_ivh FROM ({LINES}) GROUP BY uid)
SELECT *, coalesce(max_iph, 0) + coalesce(max_eah, 0) + coalesce(max_ivh, 0) AS total FROM m
""")
def group_max(t: Tables) -> DataFrame:
    return ops.group_max(lines(t), ["uid"], ["iph", "eah", "ivh"])


@query(f"""
SELECT uid, series, id, vol, qc, folder FROM ({SCANS}) WHERE qc IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY uid, series ORDER BY qc, id) = 1
""")
def argmin_per_group(t: Tables) -> DataFrame:
    rows = scans(t).select("uid", "series", "id", "vol", "qc", "folder")
    return ops.argmin_per_group(rows, ["uid", "series"], "qc", ["id"])


@query(f"""
SELECT uid, series, id, vol, qc, folder FROM ({SCANS})
QUALIFY row_number() OVER (PARTITION BY folder, series ORDER BY qc NULLS LAST, id) = 1
""")
def best_of_group(t: Tables) -> DataFrame:
    rows = scans(t).select("uid", "series", "id", "vol", "qc", "folder")
    return ops.best_of_group(rows, ["folder", "series"], "qc", ["id"])


@query(f"""
SELECT uid, folder, arg_min(id, (ts, id)) AS id, arg_min(qc, (ts, id)) FILTER (qc IS NOT NULL) AS qc,
       arg_min(nullif(series, 'click'), (ts, id)) FILTER (series <> 'click') AS series
FROM ({SCANS}) GROUP BY uid, folder
""")
def first_non_null_per_group(t: Tables) -> DataFrame:
    rows = scans(t).select("uid", "folder", "ts", "id", "qc", F.nullif("series", F.lit("click")).alias("series"))
    return ops.first_non_null_per_group(rows, ["uid", "folder"], ["ts", "id"]).drop("ts")


@query("""
SELECT o_orderstatus, o_orderpriority, count(*) AS "count" FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1, 2
""")
def value_counts(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("F")))
    return ops.sort_multi(ops.value_counts(rows, ["o_orderstatus", "o_orderpriority"]), ("count", False))


@query("""
WITH c AS (SELECT lower(p_type) AS p_type, count(*) AS "count" FROM part GROUP BY 1)
SELECT p_type, "count", round_even("count" * 100 / sum("count") OVER (), 1) AS "percent" FROM c
""")
def percent_of_total(t: Tables) -> DataFrame:
    return ops.percent_of_total(t.part.select(F.concat(F.lit(" "), "p_type").alias("p_type")), "p_type")


@query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber").distinct()


@query("SELECT DISTINCT p_brand FROM part")
def distinct_list(t: Tables) -> DataFrame:
    return t.part.select("p_brand").distinct()


_TAGS = ["Image Type", "Accession Number", "Window Center", "Window Width"]

PIVOTED = f"""
SELECT h.folder AS file_path, {", ".join(f"max(CASE WHEN name = '{n}' THEN h.value END) AS " + '"' + n + '"' for n in _TAGS)}
FROM ({HEADERS}) h JOIN (SELECT folder, min(file) AS file FROM ({HEADERS}) GROUP BY folder) f
  ON h.folder = f.folder AND h.file = f.file
WHERE name <> 'Pixel Data' GROUP BY h.folder
"""


@query(PIVOTED)
def pivot_tags(t: Tables) -> DataFrame:
    tags = ops.tag_long_table(headers(t), "folder", "file", "grp", "elem", "name", "vr", "value")
    return ops.pivot_unique(tags, "file_path", "Description", "value", _TAGS)


@query(f"""
FROM (SELECT uid, l_orderkey, l_partkey, l_linenumber, iph, ivh FROM ({LINES}))
UNPIVOT INCLUDE NULLS (value FOR variable IN (iph, ivh))
""")
def melt(t: Tables) -> DataFrame:
    return ops.melt(lines(t), ["uid", "l_orderkey", "l_partkey", "l_linenumber"], ["iph", "ivh"])


@query("""
WITH e AS (SELECT min(value) AS low, max(value) AS high FROM events),
b AS (SELECT CAST(least(floor((value - low) / (high - low) * 10) + 1, 10) AS INTEGER) AS bin FROM events, e),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS "count" FROM range(1, 11) r(i) LEFT JOIN c ON c.bin = r.i
""")
def histogram(t: Tables) -> DataFrame:
    return ops.histogram(t.events, "value")


@query(f"""
WITH m AS (UNPIVOT (SELECT iph, eah FROM ({LINES})) ON iph, eah INTO NAME variable VALUE value)
SELECT variable, min(value) AS "min", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
       quantile_cont(value, 0.75) AS q3, max(value) AS "max"
FROM m GROUP BY variable
""")
def five_number_summary(t: Tables) -> DataFrame:
    return ops.five_number_summary(ops.melt(lines(t), ["uid"], ["iph", "eah"]), "value", ["variable"])


@query(f"""
WITH f AS (SELECT *, min(ts) OVER (PARTITION BY uid) AS first_ts FROM ({SCANS})),
w AS (SELECT *, vol - first_value(vol) OVER (PARTITION BY uid ORDER BY ts, id) AS change FROM f
      WHERE round_even((epoch_us(ts) - epoch_us(first_ts)) / 3600000000.0, 0) <= 72),
m AS (SELECT *, max(change) OVER (PARTITION BY uid) AS top,
             CASE WHEN uid < 10 THEN 1 WHEN uid < 20 THEN 0 END AS censored FROM w)
SELECT uid, id, change, censored,
       {", ".join(f"CASE WHEN coalesce(censored, 0) = 0 AND top >= {c} THEN 1 ELSE 0 END AS outcome_{c}" for c in (60, 80, 100))}
FROM m
""")
def outcome_label(t: Tables) -> DataFrame:
    rows = ops.within_hours(scans(t).select("uid", "id", "ts", "vol"), "uid", "ts", 72)
    rows = ops.baseline_change(rows, "uid", ["ts", "id"], ["vol"], change="change")
    censored = F.when(F.col("uid") < 10, 1).when(F.col("uid") < 20, 0)
    labelled = ops.outcomes(rows.withColumn("censored", censored), "uid", ["change"], [60, 80, 100], "censored")
    return labelled.select("uid", "id", "change", "censored", "outcome_60", "outcome_80", "outcome_100")
