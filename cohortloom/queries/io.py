"""Sources and sinks: tables are written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cohortloom import operators as ops, sources
from cohortloom.functions import split_part
from cohortloom.queries.registry import Tables, query
from cohortloom.queries.standins import HEADERS, headers
from cohortloom.session import scratch_path


@query("SELECT * FROM customer")
def scan_csv(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "customer.csv")
    sources.write_table(t.customer, path)
    return sources.read_csv(t.spark, path, t.customer.schema)


@query("""
SELECT CAST(s_suppkey AS VARCHAR) AS patient_id, s_name AS accession, CAST(s_nationkey AS VARCHAR) AS folder
FROM supplier
""")
def scan_delimited(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "manifest")
    t.supplier.select("s_suppkey", "s_name", "s_nationkey").write.option("sep", "|").csv(path)
    return sources.read_delimited(t.spark, path, "|", ["patient_id", "accession", "folder"])


@query("""
SELECT o_orderkey, CASE WHEN o_custkey % 5 <> 0 THEN o_custkey END AS o_custkey,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS o_totalprice, o_orderpriority || chr(10) || 'x' AS note, o_orderstatus AS batch
FROM orders
""")
def scan_batches(t: Tables) -> DataFrame:
    """Customers as numbers with a decimal point, prices with NaN, notes over two lines."""
    path = scratch_path(t.spark, "batches")
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_custkey") % 5 != 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).alias("o_custkey"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).otherwise(F.lit(float("nan"))).alias("o_totalprice"),
        F.concat("o_orderpriority", F.lit("\nx")).alias("note"),
        F.col("o_orderstatus").alias("run"),
    )
    rows.write.option("header", True).option("escape", '"').partitionBy("run").csv(path)
    schema = "o_orderkey bigint, o_custkey bigint, o_totalprice double, note string"
    return sources.read_batches(t.spark, f"{path}/run=*", schema, "/run=([^/]+)/", line_breaks=True)


@query("SELECT doc_id, quality, CASE WHEN toxic = 1 THEN 1 END AS toxic, 'seen' || chr(10) || quality AS notes FROM labels")
def scan_review_sheet(t: Tables) -> DataFrame:
    """A sheet as other tools export it: flags as 1.0, empty cells, notes over two lines."""
    path = scratch_path(t.spark, "sheet.csv")
    flag = F.concat(F.col("quality").cast("string"), F.lit(".0"))
    rows = t.labels.select(
        "doc_id", flag.alias("quality"), F.when(F.col("toxic") == 1, "1.0").alias("toxic"), F.concat(F.lit("seen\n"), F.col("quality").cast("string")).alias("notes")
    )
    sources.write_table(rows, path)
    return sources.read_review(t.spark, path, "doc_id bigint, quality int, toxic int, notes string")


@query("SELECT DISTINCT 'folder=' || split_part(url, '/', 4) AS folder FROM pages")
def list_files(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tree")
    pages = t.pages.select(split_part("url", ("/", 3)).alias("folder"), "html")
    pages.write.partitionBy("folder").text(path)
    files = sources.list_files(t.spark, path, "*.txt")
    return files.select(F.regexp_extract("folder", "([^/]+)$", 1).alias("folder")).distinct()


@query(f"""
WITH headers AS ({HEADERS}),
first_file AS (SELECT folder, min(file) AS file FROM headers GROUP BY folder)
SELECT h.folder AS file_path, lpad(printf('%X', grp), 4, '0') AS "Group", lpad(printf('%X', elem), 4, '0') AS "Elem",
       name AS "Description", vr AS "VR", h.value
FROM headers h JOIN first_file f ON h.folder = f.folder AND h.file = f.file
WHERE name <> 'Pixel Data'
""")
def tag_long_table(t: Tables) -> DataFrame:
    return ops.tag_long_table(headers(t), "folder", "file", "grp", "elem", "name", "vr", "value")


@query("SELECT * FROM orders")
def write_table(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "orders")
    sources.write_table(t.orders, path)
    return t.spark.read.schema(t.orders.schema).parquet(path)


@query("SELECT url AS value FROM pages")
def write_text_list(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "urls")
    sources.write_lines(t.pages, "url", path)
    return t.spark.read.text(path)


@query("""
WITH r AS (SELECT row_number() OVER (ORDER BY doc_id) AS rn, doc_id FROM documents)
SELECT CAST((rn - 1) // 100 + 1 AS INTEGER) AS batch_no, count(*) AS n_rows, min(doc_id) AS first_doc, max(doc_id) AS last_doc
FROM r GROUP BY 1
""")
def write_fixed_batches(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "documents")
    sources.write_batches(t.documents.select("doc_id", "source", "n_chars"), ["doc_id"], 100, path)
    saved = t.spark.read.schema("doc_id bigint, source string, n_chars bigint, batch_no int").parquet(path)
    return saved.groupBy("batch_no").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")
    )


@query("""
WITH lines AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
all_orders AS (SELECT o_orderkey, n FROM orders LEFT JOIN lines ON o_orderkey = l_orderkey),
cases AS (SELECT 'all' AS batch, * FROM all_orders UNION ALL SELECT 'shipped', * FROM all_orders WHERE n IS NOT NULL),
checks AS (SELECT batch, count(DISTINCT o_orderkey) AS n_wanted, count(DISTINCT CASE WHEN n IS NOT NULL THEN o_orderkey END) AS n_found
           FROM cases GROUP BY batch)
SELECT batch, n_wanted, n_found, n_wanted = n_found AS complete,
       CASE WHEN n_wanted = n_found THEN n_wanted ELSE 0 END AS rows_written
FROM checks
""")
def gated_write(t: Tables) -> DataFrame:
    lines = ops.group_counts(t.lineitem, ["l_orderkey"], name="n")
    orders = t.orders.select("o_orderkey").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    out = []
    for batch, rows in [("all", orders), ("shipped", orders.where("n IS NOT NULL"))]:
        path = scratch_path(t.spark, "gated")
        try:
            check = sources.write_if(rows, "o_orderkey", "n", path)
            written = t.spark.read.schema(rows.schema).parquet(path).agg(F.count(F.lit(1))).scalar()
        except sources.IncompleteError as refused:
            check, written = t.spark.createDataFrame([refused.check], "n_wanted long, n_found long, complete boolean"), F.lit(0).cast("long")
        out.append(check.select(F.lit(batch).alias("batch"), "*", written.alias("rows_written")))
    return out[0].unionByName(out[1])


@query("""
SELECT 'with_id' AS copy, c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT 'without_id', NULL, NULL, c_nationkey, c_acctbal, c_mktsegment FROM customer
""")
def deidentified_copies(t: Tables) -> DataFrame:
    path, ids = scratch_path(t.spark, "customer"), ["c_custkey", "c_name"]
    sources.write_with_and_without_ids(t.customer, ids, path)
    full = t.spark.read.schema(t.customer.schema).parquet(f"{path}/with_id")
    bare = t.spark.read.schema(t.customer.drop(*ids).schema).parquet(f"{path}/without_id")
    return full.withColumn("copy", F.lit("with_id")).unionByName(
        bare.withColumn("copy", F.lit("without_id")), allowMissingColumns=True
    )
