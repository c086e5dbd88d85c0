"""End-to-end plans on a few hand-made rows, one for each rule that is easy to miss."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortloom import plans
from cohortloom.operators import split_exact

T0 = datetime(2024, 1, 1)
SCANS = """unique_study_id int, id string, report_num_temp string, scan_number int, StudyDate_Time_format timestamp_ntz,
           iph_predicted_volume_ml double, eah_predicted_volume_ml double, ivh_predicted_volume_ml double,
           oedema_predicted_volume_ml double, quality_control_metric double, notes string"""
SHEET = "unique_study_id int, exclude int, second_scan_post_surgery_trauma int, surgery int, surgery_type string, reason_excluded string, notes string"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


def scan(uid, n, hours, iph, eah=0.0, report=None):
    return (uid, f"s{uid}{n}", report or f"r{uid}{n}", n, T0 + timedelta(hours=hours), iph, eah, 0.0, 1.0, -1.0, "old")


@pytest.fixture
def scans(spark):
    data = [
        scan(1, 1, 0, 3.0), scan(1, 2, 5, 12.0), scan(1, 3, 80, 90.0),  # grows by 9; the last scan is too late
        scan(2, 1, 0, 2.0), scan(2, 2, 1, 50.0),  # censored
        scan(3, 1, 0, 9.0), scan(3, 2, 1, 9.5, 8.0),  # excluded subject
        scan(4, 1, 0, 30.0), scan(4, 2, 2, 4.0), scan(4, 3, 4, 11.0),  # first scan excluded, then grows by 7
        scan(5, 1, 0, 1.0), scan(5, 2, 2, 7.0),  # not in the sheet
    ]
    return spark.createDataFrame(data, SCANS)


@pytest.fixture
def sheet(spark):
    data = [(1, 0, None, 1, "a", None, "new"), (2, 1, 1, 1, "b", "x", "new"), (3, 1, None, 0, None, "x", "new"), (4, 0, 0, None, None, None, None)]
    return spark.createDataFrame(data, SHEET)


@pytest.fixture
def excluded(spark):
    return spark.createDataFrame([(4, "s41"), (1, None)], "unique_study_id int, id_to_remove string")


def test_cohort_from_sheet(scans, sheet, excluded):
    model = plans.model_table(plans.cohort_scans(scans, sheet, excluded))
    assert rows(model, "id", "second_scan_post_surgery_trauma", "outcome_6ml", "outcome_8ml", "outcome_10ml", "notes") == [
        ("s11", 0, 1, 1, 0, "new"), ("s12", 0, 1, 1, 0, "new"), ("s21", 1, 0, 0, 0, "new"), ("s22", 1, 0, 0, 0, "new"),
        ("s42", 0, 1, 0, 0, None), ("s43", 0, 1, 0, 0, None),
    ]
    assert rows(model, "id", "change_iph_volume_first_scan")[-1] == ("s43", 7.0)
    first = plans.first_scans(model)
    assert rows(first, "unique_study_id", "id") == [(1, "s11"), (2, "s21"), (4, "s42")]
    assert "notes" not in first.columns
    sets = plans.split_sets(first)
    assert sets["X_test"].count() == sets["y_test"].count() == 1 and sets["X_train"].count() == 2
    assert rows(sets["X_test"], "unique_study_id") == rows(sets["y_test"], "unique_study_id")
    assert rows(split_exact(first, "unique_study_id", 0.3, 1300).where("split = 'test'"), "unique_study_id") == rows(
        sets["X_test"], "unique_study_id"
    )


def test_cohort_without_sheet_goes_by_the_first_scan(scans, excluded):
    cohort = plans.cohort_scans(scans, None, excluded)
    assert {r.unique_study_id for r in cohort.collect()} == {1, 2, 3, 4}


def test_scan_is_excluded_by_itself_or_by_its_subject(scans, sheet, excluded):
    from cohortloom.plans.choose_images import volume_changes

    scans = volume_changes(scans).withColumn("reason_excluded", F.lit("none"))
    volumes, changes = plans.quality_tables(scans, sheet, excluded)
    got = rows(volumes.where("variable like 'iph%'"), "id", "exclude_id", "patient_excluded", "scan_status")
    assert ("s41", 1, 0, "IPH-Exclude") in got and ("s42", 0, 0, "IPH") in got and ("s31", 1, 1, "IPH-Exclude") in got
    assert not any(r[0].startswith("s5") for r in got)
    assert {r.id for r in changes.collect()} == {"s12", "s13", "s22", "s32", "s42", "s43"}


def test_inclusion_lists(spark, scans, excluded):
    from cohortloom.plans.choose_images import volume_changes

    review = spark.createDataFrame([(1, 0, 999), (2, 1, 1), (3, None, None), (4, 0, 0)], "unique_study_id int, exclude int, potential_hematoma_expansion_case int")
    reports = scans.selectExpr("unique_study_id", "report_num_temp", "'text' AS report").where("id <> 's13'")
    lists = plans.inclusion_lists(volume_changes(scans), review, reports, excluded)
    assert rows(lists["included"], "id") == [("s11",), ("s12",), ("s31",), ("s32",), ("s42",), ("s43",), ("s51",), ("s52",)]
    assert rows(lists["cases"], "id") == [("s11",), ("s12",)]
    assert rows(lists["five_ml"], "id") == [("s12",), ("s31",), ("s32",), ("s43",), ("s52",)]
    assert rows(lists["unreviewed"], "id") == [("s31",), ("s32",), ("s51",), ("s52",)]
    assert ("iph_shrank", "s42") in rows(lists["tails"], "tail", "id")
    assert lists["no_hemorrhage"].count() == 0
    assert lists["sample"].count() == 5


def test_series_with_unwanted_word_stays_if_it_extends_a_kept_path(spark):
    def tags(path, kind="ORIGINAL Axial", centre="[40, 80]", width="300"):
        values = [("Image Type", kind), ("Accession Number", "1"), ("Window Center", centre), ("Window Width", width)]
        return [(path, n, v) for n, v in values]

    data = [
        *tags("/images/a/random/head"), *tags("/images/a/random/head_sag"), *tags("/images/a/random/SPINE"),
        *tags("/images/b/random/x", kind="LOCALIZER"), *tags("/images/c/random/wide", width="[401, 1]"),
        *tags("/images/d/random/high", centre="100.5"), *tags("/images/e/random/none", centre=None),
    ]
    out = plans.select_series(spark.createDataFrame(data, "file_path string, Description string, value string"))
    assert rows(out, "file_path", "image_type_temp", "first_center_number") == [
        ("/images/a/random/head", "head", 40.0), ("/images/a/random/head_sag", "head_sag", 40.0),
    ]


def test_locate_uses_the_second_number_and_reports_misses(spark):
    wanted = spark.createDataFrame(
        [(1, "CT2011", "CT2099"), (2, "CT2022", "*1CT2033"), (3, "CT2044", None)],
        "unique_study_id int, report_num_temp string, VNAAccession string",
    )
    first = spark.createDataFrame([("p", "*1CT2011 ", "fold er")], "patient_id string, accession string, folder string")
    second = spark.createDataFrame([("q", "CT20CT33", "g")], "patient_id string, accession string, folder string")
    out = plans.locate_scans(wanted, [(first, "/one/"), (second, "/two/")])
    assert rows(out, "unique_study_id", "file_path") == [(1, "/one/folder"), (2, "/two/g"), (3, None)]


def test_choose_images(spark):
    def image(n, name, qc, slices=40, folder="f", number=1, uid=1, volume=1.0):
        return (uid, f"scan_{n}", f"r{folder}", folder, number, f"n/{folder}/random/{name}/{n}.nii", slices, qc, T0 + timedelta(hours=n), volume, None, 0.0)

    data = [
        image(1, "head", -5.0), image(2, "head", -9.0),  # lower metric wins
        image(3, "bone", -99.0), image(4, "h60s", -99.0),  # unusable
        image(5, "neck_Tilt", -1.0, folder="g", number=2), image(6, "neck_Tilt", -2.0, slices=29, folder="g", number=2),
        image(7, "late", None, slices=100, folder="h", number=3), image(8, "kept", None, slices=28, folder="h", number=3),
        image(9, "only", -1.0, uid=2),  # one scan only
        image(10, "dropped", -1.0, folder="k", number=4), image(2, "head", -9.0),
    ]
    schema = """unique_study_id int, id string, report_num_temp string, folder string, scan_number int, image string, slice_num int,
                quality_control_metric double, StudyDate_Time_format timestamp_ntz, iph_predicted_volume_ml double,
                eah_predicted_volume_ml double, ivh_predicted_volume_ml double"""
    picks = spark.createDataFrame([(1, "scan_99")], "unique_study_id int, id_to_keep string")
    out = plans.choose_images(spark.createDataFrame(data, schema), picks, ["scan_10"], ["scan_8"])
    assert rows(out, "id", "quality_control_metric") == [("scan_2", -9.0), ("scan_5", -1.0), ("scan_8", 0.0)]
    changed = plans.volume_changes(out)
    assert rows(changed, "id", "total_volume_scan", "change_total_volume_scan", "change_eah_volume_first_scan")[0] == ("scan_2", 1.0, 0.0, None)


def test_link_drops_personal_columns(spark):
    images = spark.createDataFrame([("*CT1", "v", "xCT9", 20240102, "name", "1970")], "SearchAccession string, VNAAccession string, EDWAccession string, StudyDate int, Name string, DOB string")
    reports = spark.createDataFrame([("xCT9", 1)], "accession string, ` hemorrhage ` int")
    ids = spark.createDataFrame([(5, "*CT1", "v", "xCT9"), (6, "*CT1", None, "xCT9")], "unique_study_id int, SearchAccession string, VNAAccession string, EDWAccession string")
    out = plans.link_reports(images, reports, ids, ["unique_study_id", "report_num_temp", "StudyDate_format", "SearchAccession_temp", " hemorrhage ", "accession_temp"])
    assert [tuple(map(str, r)) for r in out.collect()] == [("5", "CT9", "2024-01-02", "1", "1", "x9")]


def test_prepare_predictions(spark):
    predictions = spark.createDataFrame(
        [("scan_1", " n/f/a.nii", "p ", [1, 1, 30]), ("scan_2", "n/g/b.nii", "p", [1, 1]), ("scan_3", "n/f/c.nii", "p", [1, 1, 31])],
        "id string, image string, prediction string, shape array<int>",
    )
    scan_list = spark.createDataFrame([(1, "rf", "f "), (1, "rf", "f"), (1, "rg", "g"), (1, "rz", "z")], "unique_study_id int, report_num_temp string, folder string")
    details = spark.createDataFrame([(1, "rf", "2024-01-02 00:00:00"), (1, "rg", "2024-01-01 00:00:00")], "unique_study_id int, report_num_temp string, StudyDate_Time_format string")
    out = plans.prepare_predictions(predictions, scan_list, details)
    assert rows(out, "id", "image", "scan_number", "slice_num") == [
        ("scan_1", "n/f/a.nii", 2, 30), ("scan_2", "n/g/b.nii", 1, None), ("scan_3", "n/f/c.nii", 2, 31),
    ]


def test_full_width_from_predictions_to_model_table(spark):
    """The wide tables go through choice, changes, cohort and labels with all their columns."""
    from cohortloom.sources import schemas

    def record(schema, **given):
        return tuple(given.get(f.name, 0.5 if f.dataType.simpleString() == "double" else None) for f in schema)

    def prediction(n, volume):
        image = f"nifti/f{n}/random/head/{n}.nii"
        return record(schemas.PREDICTIONS, id=f"scan_{n}", image=image, prediction="p", iph_predicted_volume_ml=volume) + ([1, 1, 40],)

    wide = StructType(schemas.PREDICTIONS.fields + [schemas.VOLUMES["shape"]])
    predictions = spark.createDataFrame([prediction(1, 3.0), prediction(2, 11.0)], wide)
    scan_list = spark.createDataFrame([("u", f"r{n}", f"f{n}") for n in (1, 2)], "unique_study_id string, report_num_temp string, folder string")
    details = spark.createDataFrame(
        [record(schemas.SCANS_TO_INCLUDE, unique_study_id="u", report_num_temp=f"r{n}", StudyDate_Time_format=f"2024-01-0{n} 00:00:00") for n in (1, 2)],
        schemas.SCANS_TO_INCLUDE,
    )
    picks = spark.createDataFrame([], schemas.IMAGE_CHOICE)
    excluded = spark.createDataFrame([], schemas.SCANS_TO_EXCLUDE)
    chart = spark.createDataFrame([record(schemas.CHART_REVIEW, unique_study_id="u", exclude=0)], schemas.CHART_REVIEW)

    prepared = plans.prepare_predictions(predictions, scan_list, details)
    clean = plans.volume_changes(plans.choose_images(prepared, picks, [], [])).select(*plans.CLEAN_COLUMNS)
    assert len(clean.columns) == 183 and clean.count() == 2
    model = plans.model_table(plans.cohort_scans(clean, chart, excluded)).select(*plans.MODEL_COLUMNS)
    assert len(model.columns) == 25 + 93
    assert rows(model, "scan_number", "outcome_6ml", "outcome_8ml", "outcome_10ml") == [(1, 1, 1, 0), (2, 1, 1, 0)]
    first = plans.first_scans(model)
    assert first.count() == 1 and len(first.columns) == 117
    assert plans.split_sets(first)["X_test"].columns == plans.FEATURES
