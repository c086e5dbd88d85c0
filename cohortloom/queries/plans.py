"""End-to-end plans on tables derived from the shared ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cohortloom import fixed_values as fixed, functions as fn, operators as ops, plans, sources
from cohortloom.queries.aggregations import PIVOTED
from cohortloom.queries.joins import MANIFEST, WANTED_1, WANTED_2, manifests, override_sql, wanted_numbers
from cohortloom.queries.registry import Tables, query
from cohortloom.queries.standins import (
    ACCESSION, SECOND_ACCESSION, accession, accession_sql, headers, second_accession,
)
from cohortloom.session import scratch_path, settle


def text(c: str) -> Column:
    return F.col(c).cast("string")


# --- reports --------------------------------------------------------------------------------------------------

_LINKED = [
    "unique_study_id", "report_num_temp", "SearchAccession", "VNAAccession", "EDWAccession", "StudyDate",
    "SearchAccession_temp", "accession", "any trauma", " hemorrhage ", "accession_temp",
]


_IMAGE_NUMBER = "CASE WHEN o_orderkey % 11 <> 0 THEN 'X1CT' || o_orderkey END"


@query(f"""
WITH images AS (SELECT {ACCESSION} AS sa, {SECOND_ACCESSION} AS va, {_IMAGE_NUMBER} AS ea,
                       CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS d FROM orders),
reports AS (SELECT DISTINCT CASE WHEN l_quantity >= 40 THEN 'X1CT' || l_orderkey END AS accession,
                   CAST(l_linestatus = 'F' AS INTEGER) AS trauma, l_returnflag AS hem FROM lineitem),
ids AS (SELECT o_custkey AS unique_study_id, {ACCESSION} AS sa, {SECOND_ACCESSION} AS va,
               CASE WHEN o_orderstatus <> 'F' THEN {_IMAGE_NUMBER} END AS ea FROM orders)
SELECT i.unique_study_id, regexp_replace(m.ea, '.*CT', 'CT') AS report_num_temp, m.sa AS "SearchAccession", m.va AS "VNAAccession",
       m.ea AS "EDWAccession", m.d AS "StudyDate", {accession_sql("m.sa", "plain")} AS "SearchAccession_temp", r.accession,
       r.trauma AS "any trauma", r.hem AS " hemorrhage ", {accession_sql("r.accession", "plain")} AS accession_temp
FROM images m JOIN reports r ON m.ea = r.accession JOIN ids i ON i.sa = m.sa AND i.va = m.va AND i.ea = m.ea
""")
def pipe_link_reports(t: Tables) -> DataFrame:
    number = F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("X1CT"), text("o_orderkey")))
    named = [accession().alias("SearchAccession"), second_accession().alias("VNAAccession")]
    images = t.orders.select(
        *named,
        number.alias("EDWAccession"),
        F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("StudyDate"),
        text("o_custkey").alias("Name"),
        F.lit(None).cast("date").alias("DOB"),
    )
    reports = t.lineitem.select(
        F.when(F.col("l_quantity") >= 40, F.concat(F.lit("X1CT"), text("l_orderkey"))).alias("accession"),
        (F.col("l_linestatus") == "F").cast("int").alias("any trauma"),
        F.col("l_returnflag").alias(" hemorrhage "),
    )
    listed = F.when(F.col("o_orderstatus") != "F", number).alias("EDWAccession")
    ids = t.orders.select(F.col("o_custkey").alias("unique_study_id"), *named, listed)
    return plans.link_reports(images, reports.distinct(), ids, _LINKED)


@query(f"""
WITH w AS (SELECT o_custkey AS unique_study_id, {WANTED_1} AS report_num_temp, {WANTED_2} AS "VNAAccession" FROM orders),
k AS (SELECT DISTINCT *, {accession_sql("report_num_temp", "dated")} AS k1, {accession_sql('"VNAAccession"', "fallback")} AS k2 FROM w),
m AS (SELECT DISTINCT accession, folder, CASE list WHEN 'a' THEN '/first/images/' ELSE '/second/images/' END || folder AS file_path,
             {accession_sql("accession", "manifest")} AS mk FROM ({MANIFEST})),
found AS (SELECT DISTINCT k.*, m.accession, m.folder, m.file_path FROM k JOIN m ON k.k1 = m.mk
          UNION SELECT k.*, m.accession, m.folder, m.file_path FROM k LEFT JOIN m ON k.k2 = m.mk
          WHERE NOT EXISTS (SELECT 1 FROM m AS n WHERE n.mk = k.k1))
SELECT unique_study_id, report_num_temp, "VNAAccession", k1 AS accession_temp, k2 AS "VNAAccession_temp", accession, folder, file_path,
       (SELECT count(DISTINCT report_num_temp) FROM found) AS n_wanted,
       (SELECT count(DISTINCT report_num_temp) FROM found WHERE file_path IS NOT NULL) AS n_found,
       (SELECT count(*) FROM found WHERE file_path IS NULL) AS n_without_path,
       (SELECT count(*) FROM found WHERE report_num_temp IS NULL) AS n_without_report
FROM found
""")
def pipe_locate_scans(t: Tables) -> DataFrame:
    """The gate refuses to write, as some scans are in no manifest; its check row and the null counts come out too."""
    report, archive = wanted_numbers()
    wanted = t.orders.select(F.col("o_custkey").alias("unique_study_id"), report.alias("report_num_temp"), archive.alias("VNAAccession"))
    first, second = manifests(t)
    found = settle(plans.locate_scans(wanted, [(first, "/first/images/"), (second, "/second/images/")]))
    try:
        check = sources.write_if(found, "report_num_temp", "file_path", scratch_path(t.spark, "located")).first()
    except sources.IncompleteError as refused:
        check = refused.check
    nulls = ops.null_counts(found).first()
    counts = {"n_wanted": check["n_wanted"], "n_found": check["n_found"], "n_without_path": nulls["file_path"], "n_without_report": nulls["report_num_temp"]}
    return found.withColumns({n: F.lit(v).cast("long") for n, v in counts.items()})


@query(f"""
SELECT count(*) AS n_rows, count(DISTINCT coalesce(sa, '')) AS n_keys, count(*) = count(DISTINCT coalesce(sa, '')) AS is_unique
FROM (SELECT {ACCESSION} AS sa FROM orders)
""")
def pipe_report_check(t: Tables) -> DataFrame:
    return plans.accession_check(t.orders.select(accession().alias("SearchAccession")))


# --- series ---------------------------------------------------------------------------------------------------

_BAD = "coronal|sag|chest|abdomen|spine|facial_bones|lung"
_NUMBER = """TRY_CAST(regexp_extract("{0}", '[0-9.]+', 0) AS DOUBLE)"""


@query(f"""
WITH wide AS ({PIVOTED}),
axial AS (SELECT * FROM wide WHERE lower("Image Type") LIKE '%axial%'),
folders AS (SELECT lower(file_path) AS f FROM axial WHERE NOT regexp_matches(lower(file_path), '{_BAD}')),
kept AS (SELECT *, split_part(split_part(file_path, '/random/', 2), '/CT', 1) AS image_type_temp,
                {_NUMBER.format("Window Center")} AS first_center_number, {_NUMBER.format("Window Width")} AS first_width_number
         FROM axial a WHERE EXISTS (SELECT 1 FROM folders WHERE starts_with(lower(a.file_path), f)))
SELECT * FROM kept WHERE first_center_number <= 100 AND first_width_number <= 400
""")
def pipe_select_series(t: Tables) -> DataFrame:
    tags = ops.tag_long_table(headers(t), "folder", "file", "grp", "elem", "name", "vr", "value")
    return plans.select_series(tags)


# --- predictions ----------------------------------------------------------------------------------------------

_DAY = "user_id || '_' || strftime(ts, '%Y%m%d')"


def day(t: Tables) -> DataFrame:
    return t.events.withColumn("folder", F.concat(text("user_id"), F.lit("_"), F.date_format("ts", "yyyyMMdd")))


@query(f"""
WITH e AS (SELECT *, {_DAY} AS folder FROM events),
p AS (SELECT 'scan_' || event_id AS id, 'nifti/' || folder || '/' || event_id || '.nii' AS image, 'out/' || event_id || '.nii' AS prediction,
             event_type AS batch, CAST(floor(value) AS INTEGER) AS slice_num, folder FROM e),
l AS (SELECT DISTINCT user_id AS unique_study_id, 'R' || folder AS report_num_temp,
             CASE WHEN value >= 60 THEN folder ELSE 'not sent ' || folder END AS folder FROM e),
d AS (SELECT user_id AS unique_study_id, 'R' || folder AS report_num_temp, min(ts) AS t FROM e GROUP BY 1, 2)
SELECT p.*, l.unique_study_id, l.report_num_temp, d.t AS "StudyDate_Time_format",
       CAST(dense_rank() OVER (PARTITION BY l.unique_study_id ORDER BY d.t, p.folder) AS INTEGER) AS scan_number
FROM p JOIN l ON p.folder = l.folder JOIN d ON d.unique_study_id = l.unique_study_id AND d.report_num_temp = l.report_num_temp
""")
def pipe_prepare_predictions(t: Tables) -> DataFrame:
    e, path = day(t), scratch_path(t.spark, "predictions")
    rows = e.select(
        F.concat(F.lit("scan_"), text("event_id")).alias("id"),
        F.concat(F.lit("nifti/"), "folder", F.lit("/"), text("event_id"), F.lit(".nii")).alias("image"),
        F.concat(F.lit("out/"), text("event_id"), F.lit(".nii")).alias("prediction"),
        F.floor("value").cast("int").alias("depth"),
        F.col("event_type").alias("run"),
    )
    rows.write.option("header", True).partitionBy("run").csv(path)
    batches = sources.read_batches(t.spark, f"{path}/run=*", rows.drop("run").schema, "/run=([^/]+)/")
    predictions = batches.withColumn("shape", F.array(F.lit(512), F.lit(512), "depth")).drop("depth")
    report = F.concat(F.lit("R"), "folder").alias("report_num_temp")
    sent = F.when(F.col("value") >= 60, F.col("folder")).otherwise(F.concat(F.lit("not sent "), "folder"))
    scan_list = e.select(
        F.col("user_id").alias("unique_study_id"), report, F.concat(F.lit(" "), sent, F.lit("\t")).alias("folder")
    )
    details = e.groupBy(F.col("user_id").alias("unique_study_id"), report).agg(
        F.min("ts").cast("string").alias("StudyDate_Time_format")
    )
    return plans.prepare_predictions(predictions, scan_list, details)


# --- images ---------------------------------------------------------------------------------------------------

_IMAGES = f"""
SELECT user_id AS uid, event_id AS n, 'scan_' || event_id AS id, ts, {_DAY} AS folder,
       {_DAY} || CASE WHEN value < 40 THEN 'a' ELSE 'b' END AS report,
       CASE event_type WHEN 'purchase' THEN 'click' WHEN 'view' THEN 'Bone' ELSE event_type END AS image_name,
       'nifti/' || {_DAY} || '/random/' || CASE event_type WHEN 'purchase' THEN 'click' WHEN 'view' THEN 'Bone' ELSE event_type END
         || '/' || event_id || CASE WHEN event_type = 'purchase' THEN '_TILT.nii' ELSE '.nii' END AS image,
       event_type = 'purchase' AS corrected, CAST(floor(value) AS INTEGER) AS slice_num,
       coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE -value END, 0) AS qc,
       value AS iph, CASE WHEN event_type = 'signup' THEN NULL ELSE value / 2 END AS eah, CAST(NULL AS DOUBLE) AS ivh
FROM events
"""
_PICKS = """
SELECT user_id AS uid, 'scan_' || event_id AS id_to_keep FROM events WHERE value >= 60 AND event_type IN ('signup', 'purchase')
"""


def images(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    name = F.when(kind == "purchase", "click").when(kind == "view", "Bone").otherwise(kind)
    ending = F.when(kind == "purchase", "_TILT.nii").otherwise(".nii")
    rows = day(t).select(
        F.col("user_id").alias("unique_study_id"),
        F.concat(F.lit("scan_"), text("event_id")).alias("id"),
        F.col("ts").alias("StudyDate_Time_format"),
        "folder",
        F.concat("folder", F.when(value < 40, "a").otherwise("b")).alias("report_num_temp"),
        F.concat(F.lit("nifti/"), "folder", F.lit("/random/"), name, F.lit("/"), text("event_id"), ending).alias("image"),
        F.floor("value").cast("int").alias("slice_num"),
        F.when(kind != "error", -value).alias("quality_control_metric"),
        value.alias("iph_predicted_volume_ml"),
        F.when(kind != "signup", value / 2).alias("eah_predicted_volume_ml"),
        F.lit(None).cast("double").alias("ivh_predicted_volume_ml"),
    )
    return ops.dense_rank_per_subject(rows, "unique_study_id", ["folder"])


def image_picks(t: Tables) -> DataFrame:
    hits = (F.col("value") >= 60) & F.col("event_type").isin("signup", "purchase")
    return t.events.where(hits).select(
        F.col("user_id").alias("unique_study_id"), F.concat(F.lit("scan_"), text("event_id")).alias("id_to_keep")
    )


_CHOSEN = [
    "unique_study_id", "report_num_temp", "folder", "id", "scan_number", "image_name", "slice_num", "quality_control_metric",
    "total_volume_scan", "total_volume_first_scan", "change_total_volume_scan", "iph_volume_first", "eah_volume_first",
    "change_iph_volume_first_scan", "change_eah_volume_first_scan",
]

_CHOICE = f"""
i AS (SELECT *, CAST(dense_rank() OVER (PARTITION BY uid ORDER BY folder) AS INTEGER) AS scan_number FROM ({_IMAGES})),
usable AS (SELECT * FROM i WHERE id NOT IN ('scan_7', 'scan_8') AND image_name <> 'Bone'
             AND ((slice_num >= 30 AND slice_num < 100) OR id IN ('scan_10', 'scan_11'))),
best AS (SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY uid, image_name, scan_number, corrected ORDER BY qc, id) = 1),
preferred AS (SELECT * EXCLUDE (has) FROM (
  SELECT *, bool_or(corrected) OVER (PARTITION BY uid, report, scan_number, folder, image_name) AS has FROM best)
  WHERE corrected OR NOT has),
{override_sql("SELECT * FROM preferred", _PICKS)},
one AS (SELECT uid, folder, {", ".join(f"arg_min({c}, (scan_number, id)) FILTER ({c} IS NOT NULL) AS {c}"
        for c in ["report", "id", "ts", "scan_number", "image_name", "image", "slice_num", "qc", "iph", "eah", "ivh"])}
        FROM chosen GROUP BY uid, folder),
kept AS (SELECT * FROM one QUALIFY count(report) OVER (PARTITION BY uid) >= 2),
total AS (SELECT *, coalesce(iph, 0) + coalesce(eah, 0) + coalesce(ivh, 0) AS total FROM kept),
firsts AS (SELECT *, {", ".join(f"first_value({c} IGNORE NULLS) OVER (PARTITION BY uid ORDER BY ts, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS {c}_first"
        for c in ["total", "iph", "eah", "ivh"])} FROM total)
"""


@query(f"""
WITH {_CHOICE}
SELECT uid AS unique_study_id, report AS report_num_temp, folder, id, scan_number, image_name, slice_num, qc AS quality_control_metric,
       total AS total_volume_scan, total_first AS total_volume_first_scan, total - total_first AS change_total_volume_scan,
       iph_first AS iph_volume_first, eah_first AS eah_volume_first, iph - iph_first AS change_iph_volume_first_scan,
       eah - eah_first AS change_eah_volume_first_scan
FROM firsts
""")
def pipe_choose_images(t: Tables) -> DataFrame:
    rows = plans.choose_images(settle(images(t)), image_picks(t), ["scan_7", "scan_8"], ["scan_10", "scan_11"])
    return plans.volume_changes(rows).select(*_CHOSEN)


_FUNNEL = [
    ("predicted", "i"), ("not removed by hand", "i WHERE id NOT IN ('scan_7', 'scan_8')"),
    ("usable image", "i WHERE id NOT IN ('scan_7', 'scan_8') AND image_name <> 'Bone'"), ("slices in range", "usable"),
    ("one of each series", "best"), ("corrected if there is one", "preferred"), ("chosen by hand", "(SELECT DISTINCT * FROM chosen)"),
    ("two folders", """(SELECT DISTINCT * FROM chosen) WHERE uid IN (
        SELECT uid FROM chosen WHERE report IS NOT NULL GROUP BY uid HAVING count(DISTINCT folder) >= 2)"""),
]


@query(f"WITH {_CHOICE}" + " UNION ALL ".join(
    f"SELECT {n} AS step_no, '{name}' AS step, count(DISTINCT uid) AS subjects, count(*) AS rows FROM {left}"
    for n, (name, left) in enumerate(_FUNNEL)
))
def pipe_choice_funnel(t: Tables) -> DataFrame:
    """Subjects and scans left after each filter and each step of the choice."""
    return plans.choice_funnel(settle(images(t)), image_picks(t), ["scan_7", "scan_8"], ["scan_10", "scan_11"])


# The wide families, each a multiple of one volume, so that every column of the clean and of the model table is there.
_IMAGE_FAMILIES = [
    *fn.family_names(fixed.CLASS_REGION, fixed.REGIONS, fixed.CLASSES), *fn.family_names(fixed.REGION_VOLUME, ["Brain", *fixed.REGIONS]),
]
_MODEL_FAMILIES = fn.family_names(fixed.CLASS_REGION, fixed.REGIONS, fixed.MODEL_CLASSES)


def multiples(names: list[str], of: str) -> dict[str, Column]:
    return {name: F.col(of) * k for k, name in enumerate(names, 1)}


def multiples_sql(names: list[str], of: str) -> str:
    return ", ".join(f'{of} * {k} AS "{name}"' for k, name in enumerate(names, 1))


@query(f"""
WITH {_CHOICE}
SELECT uid AS unique_study_id, report AS report_num_temp, 1 AS flag_post_trauma_hem, id, scan_number, ts AS "StudyDate_Time_format",
       iph AS iph_predicted_volume_ml, eah AS eah_predicted_volume_ml, iph / 8 AS oedema_predicted_volume_ml, ivh AS ivh_predicted_volume_ml,
       qc AS quality_control_metric, folder, image_name, slice_num, total AS total_volume_scan, total_first AS total_volume_first_scan,
       total - total_first AS change_total_volume_scan, iph_first AS iph_volume_first, eah_first AS eah_volume_first,
       ivh_first AS ivh_volume_first, iph - iph_first AS change_iph_volume_first_scan, eah - eah_first AS change_eah_volume_first_scan,
       ivh - ivh_first AS change_ivh_volume_first_scan, {multiples_sql(_IMAGE_FAMILIES, "iph")},
       image, 'p' || image AS prediction, 'a' || image AS atlas_in_native_space, 'b' || image AS brain_mask_native_space
FROM firsts
""")
def pipe_clean_table(t: Tables) -> DataFrame:
    """All 183 columns of the clean table. The images are numbered once, before they are wide."""
    wide = settle(images(t)).withColumns(
        {
            "flag_post_trauma_hem": F.lit(1), "oedema_predicted_volume_ml": F.col("iph_predicted_volume_ml") / 8,
            "prediction": F.concat(F.lit("p"), "image"), "atlas_in_native_space": F.concat(F.lit("a"), "image"),
            "brain_mask_native_space": F.concat(F.lit("b"), "image"),
        }
        | multiples(_IMAGE_FAMILIES, "iph_predicted_volume_ml")
    )
    rows = plans.choose_images(wide, image_picks(t), ["scan_7", "scan_8"], ["scan_10", "scan_11"])
    return plans.volume_changes(rows).select(*map(fn.quoted, plans.CLEAN_COLUMNS))


# --- cohort ---------------------------------------------------------------------------------------------------

_HISTORY = """
SELECT user_id AS uid, 'scan_' || event_id AS id, 'R' || event_id AS report, ts, value AS iph,
       CASE WHEN event_type = 'signup' THEN NULL ELSE value / 2 END AS eah, value / 4 AS ivh,
       CASE WHEN event_type = 'error' THEN NULL ELSE -value END AS qc,
       CAST(dense_rank() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS scan_number
FROM events
"""
_SHEET = "SELECT doc_id AS uid, 1 - quality AS exclude, nullif(toxic, 0) AS censored FROM labels"
_EXCLUDED = "SELECT user_id AS uid, 'scan_' || event_id AS id FROM events WHERE event_type = 'error' AND value >= 20"
_WINDOW = f"""
h AS ({_HISTORY}),
f AS (SELECT *, min(ts) OVER (PARTITION BY uid) AS first_ts FROM h),
w AS (SELECT * EXCLUDE (first_ts) FROM f WHERE round_even((epoch_us(ts) - epoch_us(first_ts)) / 3600000000.0, 0) <= 72)
"""


def history(t: Tables) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    rows = t.events.select(
        F.col("user_id").alias("unique_study_id"),
        F.concat(F.lit("scan_"), text("event_id")).alias("id"),
        F.concat(F.lit("R"), text("event_id")).alias("report_num_temp"),
        F.col("ts").alias("StudyDate_Time_format"),
        value.alias("iph_predicted_volume_ml"),
        F.when(kind != "signup", value / 2).alias("eah_predicted_volume_ml"),
        (value / 4).alias("ivh_predicted_volume_ml"),
        F.when(kind != "error", -value).alias("quality_control_metric"),
    )
    return ops.dense_rank_per_subject(rows, "unique_study_id", ["StudyDate_Time_format", "id"])


def sheet(t: Tables) -> DataFrame:
    return t.labels.select(
        F.col("doc_id").alias("unique_study_id"),
        (1 - F.col("quality")).alias("exclude"),
        F.nullif("toxic", F.lit(0)).alias("second_scan_post_surgery_trauma"),
    )


def excluded(t: Tables) -> DataFrame:
    hits = (F.col("event_type") == "error") & (F.col("value") >= 20)
    return t.events.where(hits).select(
        F.col("user_id").alias("unique_study_id"), F.concat(F.lit("scan_"), text("event_id")).alias("id_to_remove")
    )


_BASE = "first_value({0} IGNORE NULLS) OVER (PARTITION BY uid ORDER BY scan_number, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
_OUTCOMES = ", ".join(
    f"CASE WHEN censored = 0 AND (max_iph >= {c} OR max_eah >= {c}) THEN 1 ELSE 0 END AS outcome_{c}ml" for c in (60, 80, 100)
)
_FIRSTS = ["id", "scan_number", "exclude", "censored", "iph", "eah", "change_iph", "change_eah", "max_iph", "max_eah"]
_FIRSTS += [f"outcome_{c}ml" for c in (60, 80, 100)]
_NAMES = {
    "uid": "unique_study_id", "censored": "second_scan_post_surgery_trauma", "iph": "iph_predicted_volume_ml",
    "eah": "eah_predicted_volume_ml", "change_iph": "change_iph_volume_first_scan",
    "change_eah": "change_eah_volume_first_scan", "max_iph": "max_change_iph_volume_first_scan",
    "max_eah": "max_change_eah_volume_first_scan",
}


@query(f"""
WITH {_WINDOW},
c AS (SELECT w.*, s.exclude, coalesce(s.censored, 0) AS censored FROM w JOIN ({_SHEET}) s ON w.uid = s.uid
      WHERE (s.exclude = 0 OR s.censored = 1) AND w.id NOT IN (SELECT id FROM ({_EXCLUDED}))),
b AS (SELECT *, iph - {_BASE.format("iph")} AS change_iph, eah - {_BASE.format("eah")} AS change_eah FROM c),
m AS (SELECT *, max(change_iph) OVER (PARTITION BY uid) AS max_iph, max(change_eah) OVER (PARTITION BY uid) AS max_eah FROM b),
o AS (SELECT *, {_OUTCOMES} FROM m),
first_rows AS (SELECT uid, {", ".join(f"arg_min({c}, (ts, id)) FILTER ({c} IS NOT NULL) AS {c}" for c in _FIRSTS)} FROM o GROUP BY uid),
r AS (SELECT *, row_number() OVER (ORDER BY md5('1300:' || uid)) AS rn, count(*) OVER () AS n FROM first_rows)
SELECT {", ".join(f"{c} AS {_NAMES.get(c, c)}" for c in ["uid", *_FIRSTS])}, CASE WHEN rn <= ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split
FROM r
""")
def pipe_cohort_outcomes(t: Tables) -> DataFrame:
    cohort = settle(plans.cohort_scans(history(t), sheet(t), excluded(t)))
    first = settle(plans.first_scans(plans.model_table(cohort, [60, 80, 100])))
    marked = ops.split_exact(first, "unique_study_id", 0.3, 1300)
    return marked.select(*[_NAMES.get(c, c) for c in ["uid", *_FIRSTS]], "split")


@query(f"""
WITH {_WINDOW},
q AS (SELECT w.*, CAST(s.exclude = 1 AS INTEGER) AS patient_excluded,
             CAST(s.exclude = 1 OR w.id IN (SELECT id FROM ({_EXCLUDED})) AS INTEGER) AS exclude_id
      FROM w JOIN ({_SHEET}) s ON w.uid = s.uid),
firsts AS (SELECT report FROM q QUALIFY row_number() OVER (PARTITION BY uid ORDER BY scan_number, id) = 1),
b AS (SELECT q.*, q.iph - g.iph AS d_iph, q.eah - g.eah AS d_eah FROM q
      JOIN (SELECT DISTINCT uid, {_BASE.format("iph")} AS iph, {_BASE.format("eah")} AS eah FROM h) g ON q.uid = g.uid),
long AS (SELECT 'volume' AS kind, uid, id, exclude_id, patient_excluded, 'iph' AS v, iph AS value FROM b
         UNION ALL SELECT 'volume', uid, id, exclude_id, patient_excluded, 'eah', eah FROM b
         UNION ALL SELECT 'change', uid, id, exclude_id, patient_excluded, 'iph', d_iph FROM b WHERE report NOT IN (SELECT report FROM firsts)
         UNION ALL SELECT 'change', uid, id, exclude_id, patient_excluded, 'eah', d_eah FROM b WHERE report NOT IN (SELECT report FROM firsts))
SELECT kind, uid AS unique_study_id, id, exclude_id, patient_excluded, value,
       CASE WHEN kind = 'volume' THEN v || '_predicted_volume_ml' ELSE 'change_' || v || '_volume_first_scan' END AS variable,
       upper(v) || CASE WHEN exclude_id = 1 THEN '-Exclude' ELSE '' END AS scan_status
FROM long
""")
def pipe_quality_tables(t: Tables) -> DataFrame:
    scans = settle(plans.volume_changes(history(t)))
    scans = ops.within_hours(scans, "unique_study_id", "StudyDate_Time_format", 72)
    ids = ["unique_study_id", "id", "exclude_id", "patient_excluded"]
    volumes, changes = plans.quality_tables(scans, sheet(t), excluded(t), ids, ids)
    return volumes.withColumn("kind", F.lit("volume")).unionByName(
        changes.drop("value_abs").withColumn("kind", F.lit("change"))
    )


def review_tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Scans, review, reports and excluded scans."""
    scans = plans.volume_changes(history(t)).withColumn("folder", F.lit(None).cast("string"))
    flag = F.when(F.col("exclude") == 0, 999).otherwise(F.col("second_scan_post_surgery_trauma"))
    review = sheet(t).select("unique_study_id", "exclude", flag.alias("potential_hematoma_expansion_case"))
    number = F.concat(F.when(F.col("event_type") == "view", "no report ").otherwise("R"), text("event_id"))
    reports = t.events.select(F.col("user_id").alias("unique_study_id"), number.alias("report_num_temp"))
    return scans, review, reports, excluded(t)


_REVIEWED = f"""
h AS ({_HISTORY}),
b AS (SELECT *, iph - {_BASE.format("iph")} AS d_iph, eah - {_BASE.format("eah")} AS d_eah FROM h),
a AS (SELECT b.*, s.exclude, CASE WHEN s.exclude = 0 THEN 999 ELSE s.censored END AS flag, b.id IN (SELECT id FROM ({_EXCLUDED})) AS listed
      FROM b LEFT JOIN ({_SHEET}) s ON b.uid = s.uid
      WHERE b.id IN (SELECT 'scan_' || event_id FROM events WHERE event_type <> 'view')),
r AS (SELECT * FROM a WHERE coalesce(exclude, 0) <> 1 AND NOT listed)
"""


@query(f"""
WITH {_REVIEWED}
SELECT 'included' AS list, uid AS unique_study_id, id FROM r
UNION ALL SELECT 'cases', uid, id FROM r WHERE flag IN (1, 999)
UNION ALL SELECT 'five_ml', uid, id FROM r WHERE iph >= 5 OR (eah >= 5 AND flag IN (1, 999))
UNION ALL SELECT 'five_ml_change', uid, id FROM r WHERE (iph >= 5 OR (eah >= 5 AND flag IN (1, 999))) AND (d_iph >= 8 OR d_eah >= 9)
UNION ALL SELECT 'case_five_ml', uid, id FROM r WHERE flag IN (1, 999) AND (iph >= 5 OR eah >= 5)
UNION ALL SELECT 'case_five_ml_change', uid, id FROM r WHERE flag IN (1, 999) AND (iph >= 5 OR eah >= 5) AND (d_iph >= 8 OR d_eah >= 9)
UNION ALL SELECT 'unreviewed', uid, id FROM r WHERE exclude IS NULL
UNION ALL SELECT 'excluded_subjects', uid, id FROM a WHERE exclude = 1
UNION ALL SELECT 'accepted_subjects', uid, id FROM a WHERE exclude = 0
UNION ALL SELECT 'no_quality_error', uid, id FROM r WHERE qc = 0
UNION ALL SELECT 'case_iph_change', uid, id FROM r WHERE flag IN (1, 999) AND (iph >= 5 OR eah >= 5) AND d_iph >= 8
UNION ALL SELECT 'case_eah_change', uid, id FROM r WHERE flag IN (1, 999) AND (iph >= 5 OR eah >= 5) AND d_eah >= 9
UNION ALL (SELECT 'sample', uid, id FROM r WHERE iph >= 5 OR (eah >= 5 AND flag IN (1, 999)) ORDER BY md5('1148:' || id), id LIMIT 20)
UNION ALL SELECT 'iph_grew', uid, id FROM r WHERE d_iph >= 10
UNION ALL SELECT 'eah_grew', uid, id FROM r WHERE d_eah >= 10
UNION ALL SELECT 'iph_large', uid, id FROM r WHERE iph >= 10
UNION ALL SELECT 'eah_large', uid, id FROM r WHERE eah >= 10
UNION ALL SELECT 'iph_shrank', uid, id FROM r WHERE d_iph <= -10
UNION ALL SELECT 'eah_shrank', uid, id FROM r WHERE d_eah <= -10
UNION ALL SELECT 'no_hemorrhage', uid, NULL FROM r GROUP BY uid
  HAVING coalesce(max(iph), 0) + coalesce(max(eah), 0) + coalesce(max(ivh), 0) = 0
""")
def pipe_inclusion_lists(t: Tables) -> DataFrame:
    return plans.all_lists(plans.listed_scans(*review_tables(t)), ["unique_study_id", "id"])


_COUNTED = [
    "included", "cases", "five_ml", "five_ml_change", "case_five_ml", "case_five_ml_change", "unreviewed", "excluded_subjects",
    "accepted_subjects", "no_quality_error", "case_iph_change", "case_eah_change",
]
_LIST_RULES = [
    "true", "flag IN (1, 999)", "(iph >= 5 OR (eah >= 5 AND flag IN (1, 999)))",
    "(iph >= 5 OR (eah >= 5 AND flag IN (1, 999))) AND (d_iph >= 8 OR d_eah >= 9)", "flag IN (1, 999) AND (iph >= 5 OR eah >= 5)",
    "flag IN (1, 999) AND (iph >= 5 OR eah >= 5) AND (d_iph >= 8 OR d_eah >= 9)", "exclude IS NULL", "exclude = 1", "exclude = 0", "qc = 0",
    "flag IN (1, 999) AND (iph >= 5 OR eah >= 5) AND d_iph >= 8", "flag IN (1, 999) AND (iph >= 5 OR eah >= 5) AND d_eah >= 9",
]


@query(f"""
WITH {_REVIEWED},
five AS (SELECT count(*) AS n FROM r WHERE iph >= 5 OR (eah >= 5 AND flag IN (1, 999)))
""" + " UNION ALL ".join(
    f"SELECT '{name}' AS list, count(*) AS rows, count(DISTINCT uid) AS subjects FROM {'a' if name.endswith('_subjects') else 'r'} WHERE {rule}"
    for name, rule in zip(_COUNTED, _LIST_RULES)
) + """
UNION ALL SELECT 'tails', sum(n)::BIGINT, count(DISTINCT uid) FROM (SELECT uid,
  coalesce((d_iph >= 10)::INT, 0) + coalesce((d_eah >= 10)::INT, 0) + coalesce((iph >= 10)::INT, 0) + coalesce((eah >= 10)::INT, 0)
  + coalesce((d_iph <= -10)::INT, 0) + coalesce((d_eah <= -10)::INT, 0) AS n FROM r) WHERE n > 0
UNION ALL SELECT 'sample', count(*), count(DISTINCT uid) FROM (SELECT uid FROM r WHERE iph >= 5 OR (eah >= 5 AND flag IN (1, 999)) ORDER BY md5('1148:' || id), id LIMIT 20)
UNION ALL SELECT 'no_hemorrhage', count(*), count(DISTINCT uid) FROM (
  SELECT uid FROM r GROUP BY uid HAVING coalesce(max(iph), 0) + coalesce(max(eah), 0) + coalesce(max(ivh), 0) = 0)
""")
def pipe_written_lists(t: Tables) -> DataFrame:
    """Rows and subjects of each review list as written to its own folder."""
    paths = plans.write_inclusion_lists(*review_tables(t), scratch_path(t.spark, "lists"))
    sizes = [
        t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("unique_study_id").alias("subjects")).withColumn("list", F.lit(name))
        for name, path in paths.items()
    ]
    return ops.union_all(*sizes)


_STEPS = ["true", "coalesce(exclude, 0) <> 1", "NOT listed", "flag IN (1, 999)", "(iph >= 5 OR eah >= 5)", "(d_iph >= 8 OR d_eah >= 9)"]
_STEP_NAMES = ["reported", "subject kept", "scan kept", "likely case", "enough volume", "grown"]


@query(f"WITH {_REVIEWED}" + " UNION ALL ".join(
    f"SELECT {i} AS step_no, '{name}' AS step, count(DISTINCT uid) AS subjects, count(*) AS rows FROM a WHERE {' AND '.join(_STEPS[: i + 1])}"
    for i, name in enumerate(_STEP_NAMES)
))
def pipe_inclusion_funnel(t: Tables) -> DataFrame:
    return plans.inclusion_funnel(*review_tables(t))


@query(f"""
WITH {_REVIEWED},
five AS (SELECT d_iph, d_eah FROM r WHERE flag IN (1, 999) AND (iph >= 5 OR eah >= 5)),
long AS (SELECT 'change_iph_volume_first_scan' AS variable, d_iph AS x FROM five WHERE d_iph IS NOT NULL
         UNION ALL SELECT 'change_eah_volume_first_scan', d_eah FROM five WHERE d_eah IS NOT NULL),
ends AS (SELECT variable, min(x) AS low, max(x) AS high FROM long GROUP BY variable),
binned AS (SELECT variable, least(CAST(floor((x - low) / ((high - low) / 10)) AS INTEGER) + 1, 10) AS bin, count(*) AS n
           FROM long JOIN ends USING (variable) GROUP BY 1, 2)
SELECT ends.variable, CAST(i AS INTEGER) AS bin, coalesce(n, 0) AS count
FROM ends CROSS JOIN range(1, 11) AS bins(i) LEFT JOIN binned ON binned.variable = ends.variable AND binned.bin = i
""")
def pipe_change_histograms(t: Tables) -> DataFrame:
    cases = plans.inclusion_lists(*review_tables(t))["case_five_ml"]
    parts = plans.change_histograms(cases)
    return ops.union_all(*[h.select(F.lit(c).alias("variable"), "bin", "count") for c, h in parts.items()])


@query("""
WITH numbered AS (SELECT 'nifti/' || page_id || '/' || url AS image, page_id % 10 = 0 AS deep FROM pages),
ids AS (SELECT *, row_number() OVER (ORDER BY image) AS row FROM numbered)
SELECT 'scan_' || row AS id, image, CAST((row_number() OVER (ORDER BY row) - 1) // 100 + 1 AS INTEGER) AS batch_no FROM ids WHERE NOT deep
""")
def pipe_prepare_volumes(t: Tables) -> DataFrame:
    axes = F.when(F.col("page_id") % 10 == 0, F.array(*map(F.lit, [512, 512, 30, 2]))).otherwise(F.array(*map(F.lit, [512, 512, 30])))
    images = t.pages.select(F.concat(F.lit("nifti/"), text("page_id"), F.lit("/"), "url").alias("image"), axes.alias("shape"))
    return plans.prepare_volumes(images, 100)


_REASON = "CASE doc_id % 3 WHEN 0 THEN ' Skull Fracture ' WHEN 1 THEN 'skull fracture' ELSE 'Tumor' || chr(10) END"


@query(f"""
WITH {_WINDOW},
q AS (SELECT w.*, CAST(s.exclude = 1 AS INTEGER) AS patient_excluded,
             CAST(s.exclude = 1 OR w.id IN (SELECT id FROM ({_EXCLUDED})) AS INTEGER) AS exclude_id
      FROM w JOIN ({_SHEET}) s ON w.uid = s.uid),
long AS (SELECT 'iph_predicted_volume_ml' AS variable, 'IPH' AS class, patient_excluded, exclude_id, iph AS value FROM q
         UNION ALL SELECT 'eah_predicted_volume_ml', 'EAH', patient_excluded, exclude_id, eah FROM q),
reasons AS (SELECT lower(trim({_REASON}, ' ' || chr(10))) AS reason FROM labels WHERE 1 - quality = 1)
SELECT 'reason' AS part, reason AS label, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 1) AS percent, NULL::DOUBLE AS q1, NULL::DOUBLE AS median, NULL::DOUBLE AS q3
FROM reasons GROUP BY reason
UNION ALL SELECT 'large', variable || ' ' || patient_excluded, count(*), NULL, NULL, NULL, NULL FROM long WHERE value > 100 GROUP BY variable, patient_excluded
UNION ALL SELECT 'status', class || CASE WHEN exclude_id = 1 THEN '-Exclude' ELSE '' END, NULL, NULL,
       round(quantile_cont(value, 0.25), 6), round(quantile_cont(value, 0.5), 6), round(quantile_cont(value, 0.75), 6)
FROM long GROUP BY class, exclude_id
""")
def pipe_quality_summaries(t: Tables) -> DataFrame:
    scans = settle(plans.volume_changes(history(t)))
    scans = ops.within_hours(scans, "unique_study_id", "StudyDate_Time_format", 72)
    ids = ["unique_study_id", "id", "exclude_id", "patient_excluded"]
    volumes, _ = plans.quality_tables(scans, sheet(t), excluded(t), ids, ids)
    volumes = settle(volumes)
    kind = F.col("doc_id") % 3
    reason = F.when(kind == 0, " Skull Fracture ").when(kind == 1, "skull fracture").otherwise("Tumor\n")
    reasons = plans.excluded_reasons(t.labels.select((1 - F.col("quality")).alias("exclude"), reason.alias("reason_excluded")))
    large = plans.large_volumes(volumes).select(F.concat("variable", F.lit(" "), text("patient_excluded")).alias("label"), F.col("count").alias("n"))
    status = plans.status_summary(volumes).select(
        F.col("scan_status").alias("label"), *[F.round(q, 6).alias(q) for q in ("q1", "median", "q3")]
    )
    out = ops.union_all(
        reasons.select(F.lit("reason").alias("part"), F.col("reason_excluded").alias("label"), F.col("count").alias("n"), "percent"),
        large.withColumn("part", F.lit("large")),
        status.withColumn("part", F.lit("status")),
    )
    return out.select("part", "label", "n", "percent", "q1", "median", "q3")


@query(f"""
WITH {_WINDOW},
c AS (SELECT w.*, coalesce(s.censored, 0) AS censored FROM w JOIN ({_SHEET}) s ON w.uid = s.uid
      WHERE (s.exclude = 0 OR s.censored = 1) AND w.id NOT IN (SELECT id FROM ({_EXCLUDED})))
SELECT 'no first scan' AS list, uid AS unique_study_id, NULL AS id FROM c GROUP BY uid HAVING min(scan_number) > 1
UNION ALL SELECT 'small first scan', uid, id FROM c WHERE scan_number = 1 AND NOT (coalesce(iph >= 20, false) OR coalesce(eah >= 20, false))
UNION ALL SELECT 'censored review', s.uid, e.id FROM ({_SHEET}) s JOIN ({_EXCLUDED}) e ON s.uid = e.uid WHERE s.exclude = 0 OR s.censored = 1
""")
def pipe_cohort_checks(t: Tables) -> DataFrame:
    cohort = settle(plans.cohort_scans(history(t), sheet(t), excluded(t)))
    return ops.union_all(
        plans.without_first_scan(cohort).select(F.lit("no first scan").alias("list"), "unique_study_id", F.lit(None).cast("string").alias("id")),
        plans.small_first_scans(cohort, 20).select(F.lit("small first scan").alias("list"), "unique_study_id", "id"),
        plans.censored_review(sheet(t), excluded(t)).select(F.lit("censored review").alias("list"), "unique_study_id", F.col("id_to_remove").alias("id")),
    )


_CHART = """
SELECT doc_id AS uid, 1 - quality AS exclude, nullif(toxic, 0) AS censored, 'injury ' || doc_id % 3 AS injury, CAST(doc_id % 2 AS INTEGER) AS surgery,
       'type ' || doc_id % 5 AS surgery_type, CAST(doc_id % 4 AS INTEGER) AS first_scan_after_surgery, CAST(doc_id % 7 AS INTEGER) AS artifact,
       CASE WHEN quality = 0 THEN 'note' END AS notes FROM labels
"""
_CHARTED = ["injury", "surgery", "surgery_type", "first_scan_after_surgery", "artifact", "notes"]


@query(f"""
WITH {_WINDOW},
c AS (SELECT w.*, {", ".join(f"s.{c}" for c in _CHARTED)}, coalesce(s.censored, 0) AS censored FROM w JOIN ({_CHART}) s ON w.uid = s.uid
      WHERE (s.exclude = 0 OR s.censored = 1) AND w.id NOT IN (SELECT id FROM ({_EXCLUDED}))),
b AS (SELECT *, iph - {_BASE.format("iph")} AS d_iph, eah - {_BASE.format("eah")} AS d_eah, ivh - {_BASE.format("ivh")} AS d_ivh FROM c),
m AS (SELECT *, {", ".join(f"max(d_{c}) OVER (PARTITION BY uid) AS max_{c}" for c in ("iph", "eah", "ivh"))} FROM b)
SELECT uid AS unique_study_id, report AS report_num_temp, scan_number, ts AS "StudyDate_Time_format", qc AS quality_control_metric,
       {", ".join(_CHARTED)}, censored AS second_scan_post_surgery_trauma, iph AS iph_predicted_volume_ml, eah AS eah_predicted_volume_ml,
       ivh AS ivh_predicted_volume_ml, iph / 8 AS oedema_predicted_volume_ml,
       {", ".join(f"d_{c} AS change_{c}_volume_first_scan, max_{c} AS max_change_{c}_volume_first_scan" for c in ("iph", "eah", "ivh"))},
       {", ".join(f"CASE WHEN censored = 0 AND (max_iph >= {c} OR max_eah >= {c}) THEN 1 ELSE 0 END AS outcome_{c}ml" for c in fixed.OUTCOME_CUTS)},
       {multiples_sql(_MODEL_FAMILIES, "iph")}
FROM m
""")
def pipe_model_table(t: Tables) -> DataFrame:
    """All 118 columns of the model table."""
    number, scans = F.col("unique_study_id"), history(t)
    chart = sheet(t).withColumns(
        {
            "injury": F.concat(F.lit("injury "), (number % 3).cast("string")), "surgery": (number % 2).cast("int"),
            "surgery_type": F.concat(F.lit("type "), (number % 5).cast("string")), "first_scan_after_surgery": (number % 4).cast("int"),
            "artifact": (number % 7).cast("int"), "notes": F.when(F.col("exclude") == 1, "note"),
        }
    )
    families = {"oedema_predicted_volume_ml": F.col("iph_predicted_volume_ml") / 8} | multiples(_MODEL_FAMILIES, "iph_predicted_volume_ml")
    cohort = settle(plans.cohort_scans(scans.withColumns(families), chart, excluded(t)))
    return plans.model_table(cohort).select(*map(fn.quoted, plans.MODEL_COLUMNS))


_SET_SQL = " UNION ALL ".join(
    f"SELECT '{kind}_{part}{suffix}' AS part, {uid} AS unique_study_id, censored AS second_scan_post_surgery_trauma, {cols} FROM m WHERE split = '{part}'"
    for kind, cols in [("X", "iph AS iph_predicted_volume_ml, eah AS eah_predicted_volume_ml, NULL AS outcome_60ml, NULL AS outcome_80ml"),
                       ("y", "NULL, NULL, outcome_60ml, outcome_80ml")]
    for part in ("train", "test") for suffix, uid in [("", "uid"), ("_no_id", "NULL")]
)


@query(f"""
WITH {_WINDOW},
c AS (SELECT w.*, s.exclude, coalesce(s.censored, 0) AS censored FROM w JOIN ({_SHEET}) s ON w.uid = s.uid
      WHERE (s.exclude = 0 OR s.censored = 1) AND w.id NOT IN (SELECT id FROM ({_EXCLUDED}))),
b AS (SELECT *, iph - {_BASE.format("iph")} AS change_iph, eah - {_BASE.format("eah")} AS change_eah FROM c),
t AS (SELECT *, max(change_iph) OVER (PARTITION BY uid) AS max_iph, max(change_eah) OVER (PARTITION BY uid) AS max_eah FROM b),
o AS (SELECT *, {_OUTCOMES} FROM t),
first_rows AS (SELECT uid, {", ".join(f"arg_min({c}, (ts, id)) FILTER ({c} IS NOT NULL) AS {c}" for c in _FIRSTS)} FROM o GROUP BY uid),
r AS (SELECT *, row_number() OVER (ORDER BY md5('1300:' || uid)) AS rn, count(*) OVER () AS n FROM first_rows),
m AS (SELECT *, CASE WHEN rn <= ceil(n * 0.3) THEN 'test' ELSE 'train' END AS split FROM r)
{_SET_SQL}
""")
def pipe_training_sets(t: Tables) -> DataFrame:
    """Features and labels of both sets, with and without the id, written and read again."""
    cohort = settle(plans.cohort_scans(history(t), sheet(t), excluded(t)))
    both = ["unique_study_id", "second_scan_post_surgery_trauma"]
    volumes, outcomes = ["iph_predicted_volume_ml", "eah_predicted_volume_ml"], ["outcome_60ml", "outcome_80ml"]
    paths = plans.write_split_sets(
        plans.model_table(cohort, [60, 80, 100]), scratch_path(t.spark, "sets"), features=both + volumes, labels=both + outcomes
    )
    sets = [t.spark.read.parquet(path).withColumn("part", F.lit(name)) for name, path in paths.items()]
    return ops.union_all(*sets).select("part", *both, *volumes, *outcomes)
