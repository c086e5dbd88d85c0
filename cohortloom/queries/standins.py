"""Tables in the shape of the curated ones, derived row by row from the shared tables. Spark form and SQL form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom.queries.registry import Tables

# --- scans: one row per event ---------------------------------------------------------------------------------

SCANS = """
SELECT user_id AS uid, event_id AS id, ts, event_type AS series, value AS vol,
       user_id || '/' || strftime(ts, '%Y-%m-%d') AS folder,
       CASE WHEN event_type = 'error' THEN NULL ELSE -value END AS qc
FROM events
"""


def scans(t: Tables) -> DataFrame:
    folder = F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd"))
    qc = F.when(F.col("event_type") == "error", F.lit(None)).otherwise(-F.col("value"))
    return t.events.select(
        F.col("user_id").alias("uid"),
        F.col("event_id").alias("id"),
        "ts",
        F.col("event_type").alias("series"),
        F.col("value").alias("vol"),
        folder.alias("folder"),
        qc.alias("qc"),
    )


# --- lines: one row per order line, three "volumes" and a supplier as subject ---------------------------------

LINES = """
SELECT l_suppkey AS uid, l_shipdate AS ts, l_orderkey, l_partkey, l_linenumber, l_extendedprice,
       nullif(l_quantity, 1) AS iph, l_tax * 100 AS eah, nullif(l_discount * 100, 0) AS ivh
FROM lineitem
"""
LINES_ORDER = ["ts", "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "eah"]
LINES_ORDER_SQL = ", ".join(f"{c} NULLS LAST" for c in LINES_ORDER)


def lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_suppkey").alias("uid"),
        F.col("l_shipdate").alias("ts"),
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_extendedprice",
        F.nullif("l_quantity", F.lit(1.0)).alias("iph"),
        (F.col("l_tax") * 100).alias("eah"),
        F.nullif(F.col("l_discount") * 100, F.lit(0.0)).alias("ivh"),
    )


# --- header attributes: five per event, with folders of one user and day --------------------------------------

HEADERS = r"""
SELECT '/data/images/u' || user_id || '/' || strftime(ts, '%Y%m%d') || '/random/' ||
       CASE WHEN events.value < 10 THEN 'Sag_' WHEN events.value < 20 THEN 'Head_Spine_' ELSE 'head_' END || event_type AS folder,
       lpad(CAST(event_id AS VARCHAR), 12, '0') AS file, tag.grp, tag.elem, tag.name, tag.vr, tag.value
FROM events, LATERAL (VALUES
  (8, 8, 'Image Type', 'CS', CASE WHEN event_type IN ('click', 'view') THEN 'ORIGINAL PRIMARY Axial' ELSE 'LOCALIZER' END),
  (8, 80, 'Accession Number', 'SH', '*1CT20' || lpad(CAST(event_id AS VARCHAR), 8, '0')),
  (40, 4176, 'Window Center', 'DS', CASE WHEN event_id % 2 = 0 THEN '[' || events.value || ', 1]' ELSE CAST(events.value AS VARCHAR) END),
  (40, 4177, 'Window Width', 'DS', CASE WHEN event_id % 2 = 0 THEN '[' || events.value * 4 || ', 1]' ELSE CAST(events.value * 4 AS VARCHAR) END),
  (32736, 16, 'Pixel Data', 'OW', props)) AS tag(grp, elem, name, vr, value)
"""


def headers(t: Tables) -> DataFrame:
    value = F.col("value")
    prefix = F.when(value < 10, "Sag_").when(value < 20, "Head_Spine_").otherwise("head_")
    folder = F.concat(
        F.lit("/data/images/u"), F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyyMMdd"),
        F.lit("/random/"), prefix, F.col("event_type"),
    )
    kind = F.when(F.col("event_type").isin("click", "view"), "ORIGINAL PRIMARY Axial").otherwise("LOCALIZER")
    accession = F.concat(F.lit("*1CT20"), F.lpad(F.col("event_id").cast("string"), 8, "0"))

    def number(c: Column) -> Column:
        text = c.cast("string")
        return F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("["), text, F.lit(", 1]"))).otherwise(text)

    def tag(grp: int, elem: int, name: str, vr: str, v: Column) -> Column:
        return F.struct(
            F.lit(grp).alias("grp"), F.lit(elem).alias("elem"), F.lit(name).alias("name"),
            F.lit(vr).alias("vr"), v.alias("value"),
        )

    tags = F.array(
        tag(8, 8, "Image Type", "CS", kind),
        tag(8, 80, "Accession Number", "SH", accession),
        tag(40, 4176, "Window Center", "DS", number(value)),
        tag(40, 4177, "Window Width", "DS", number(value * 4)),
        tag(32736, 16, "Pixel Data", "OW", F.col("props")),
    )
    rows = t.events.select(
        folder.alias("folder"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("file"), F.explode(tags).alias("tag")
    )
    return rows.select("folder", "file", "tag.*")


# --- reviewed documents: a flag with nulls --------------------------------------------------------------------

REVIEWED = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality AS exclude, l.toxic AS artifact
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def reviewed(t: Tables) -> DataFrame:
    flags = t.labels.select("doc_id", F.col("quality").alias("exclude"), F.col("toxic").alias("artifact"))
    return t.documents.select("doc_id", "lang", "source", "n_chars").join(flags, "doc_id", "left")


# --- accession numbers of orders --------------------------------------------------------------------------------

ACCESSION = "'*1CT20' || lpad(CAST(o_orderkey AS VARCHAR), 8, '0')"
SECOND_ACCESSION = "' CT' || lpad(CAST(o_custkey AS VARCHAR), 6, '0') || '1CT '"


def accession(key: str = "o_orderkey") -> Column:
    return F.concat(F.lit("*1CT20"), F.lpad(F.col(key).cast("string"), 8, "0"))


def second_accession(key: str = "o_custkey") -> Column:
    return F.concat(F.lit(" CT"), F.lpad(F.col(key).cast("string"), 6, "0"), F.lit("1CT "))


def accession_sql(text: str, mode: str) -> str:
    """The cleaning steps of one mode, written as SQL."""
    steps = {
        "plain": "replace(replace({0}, '*', ''), 'CT', '')",
        "dated": "replace(regexp_replace(replace({0}, '*', ''), '^.*?CT20', ''), 'CT', '')",
        "manifest": "regexp_replace(regexp_replace(replace({0}, '*', ''), '^.*?CT20', ''), '^.*?CT', '')",
        "fallback": "regexp_replace(regexp_replace(replace({0}, '*', ''), '^.*?CT20', ''), 'CT|1CT', '', 'g')",
    }
    return "trim(" + steps[mode].format(text) + ")"
