"""Row-local rules on hand-made rows."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortloom import fixed_values as fixed, functions as fn


def values(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def texts(spark, items, expr):
    return values(spark, [(i,) for i in items], "c string", expr)


def test_strip_takes_all_white_space(spark):
    got = texts(spark, ["\t a b \n", " x ", "", None, "\x1cq\x0b"], fn.strip_whitespace("c"))
    assert got == ["a b", "x", "", None, "q"]


@pytest.mark.parametrize(
    "mode, given, wanted",
    [
        ("plain", " *CT00CT12 ", "0012"),
        ("dated", "*1CT20123CT4", "1234"),
        ("dated", "aCT20bCT20c", "bCT20c".replace("CT", "")),
        ("dated", "no prefix", "no prefix"),
        ("manifest", "*1CT2012CT7", "7"),
        ("manifest", "*1CT2012", "12"),
        ("fallback", "x1CT9CT8", "x98"),
        ("fallback", "1CT", ""),
    ],
)
def test_accession_modes(spark, mode, given, wanted):
    assert texts(spark, [given, None], fn.normalize_accession("c", mode)) == [wanted, None]


def test_unknown_accession_mode():
    with pytest.raises(ValueError):
        fn.normalize_accession("c", "other")


def test_report_number_is_greedy(spark):
    assert texts(spark, ["aCTbCT9", "none", None], fn.report_number("c")) == ["CT9", "none", None]


def test_split_part_is_literal_and_null_when_absent(spark):
    got = texts(spark, ["a.b.c", "abc", None], fn.split_part("c", (".", 1)))
    assert got == ["b", None, None]
    path = "/x/images/f1/random/head/CT.1"
    assert texts(spark, [path], fn.split_part("c", ("/random/", 1), ("/CT", 0))) == ["head"]


def test_list_literal(spark):
    given = ["[40, 80]", "40", " -3.5 ", "(1e2, 3)", "text", "[]", None, "['a']"]
    assert texts(spark, given, fn.first_of_list_literal("c")) == [40.0, 40.0, -3.5, 100.0, None, None, None, None]


def test_hex_code_pads_but_never_cuts(spark):
    got = values(spark, [(8,), (32736,), (1048576,)], "c int", fn.hex_code("c"))
    assert got == ["0008", "7FE0", "100000"]


def test_dates(spark):
    assert values(spark, [(20240229,), (None,)], "c int", fn.parse_int_date("c")) == [date(2024, 2, 29), None]
    got = texts(spark, ["2024-01-01 05:06:07", "later", None], fn.parse_timestamp("c"))
    assert got == [datetime(2024, 1, 1, 5, 6, 7), None, None]


def test_elapsed_hours_rounds_half_to_even(spark):
    start = datetime(2024, 1, 1)
    rows = [(start, start + timedelta(hours=h)) for h in (71.5, 72.5, 72.6, 73.5, 0.5)]
    got = values(spark, rows, "a timestamp_ntz, b timestamp_ntz", fn.elapsed_hours("a", "b"))
    assert got == [72.0, 72.0, 73.0, 74.0, 0.0]


def test_percent_rounds_half_to_even(spark):
    assert values(spark, [(49, 400), (51, 400)], "a int, b int", fn.percent("a", "b")) == [12.2, 12.8]


def test_row_sum_counts_null_as_zero(spark):
    got = values(spark, [(1.0, None), (None, None)], "a double, b double", fn.row_sum("a", "b"))
    assert got == [1.0, 0.0]


def test_outcome_flag(spark):
    rows = [(6.0, None, 0), (5.9, 6.0, None), (None, None, 0), (100.0, 100.0, 1)]
    got = values(spark, rows, "a double, b double, c int", fn.outcome_flag(["a", "b"], 6, "c"))
    assert got == [1, 1, 0, 0]


def test_flags(spark):
    rows = [(1, 0), (0, 1), (0, 0), (None, 0)]
    assert values(spark, rows, "a int, b int", fn.flag_combine("a", "b")) == [1, 1, 0, None]
    assert values(spark, rows, "a int, b int", fn.null_indicator("a")) == [1, 1, 1, 0]


def test_rescale_clip(spark):
    rows = [([0.0, 50.0, 500.0], None, None), ([1.0, None], 2.0, -1.0)]
    expr = fn.array_rescale_clip("x", "s", "i", F.lit(40.0), F.lit(81.0))
    got = values(spark, rows, "x array<double>, s double, i double", expr)
    assert got[0] == [0.0, 50.0, 80.0] and got[1][0] == 1.0


def test_shape(spark):
    rows = [([512, 512, 31],), ([512, 512, 31, 2],), ([512, 512],)]
    assert values(spark, rows, "s array<int>", fn.shape_depth("s")) == [31, 31, None]
    assert values(spark, rows, "s array<int>", fn.shape_rank("s")) == [3, 4, 2]


def kept(spark, rows, schema, condition):
    return [r[0] for r in spark.createDataFrame(rows, schema).where(condition).collect()]


def test_word_filters(spark):
    rows = [("Head_SAG",), ("head",), ("a.b",), (None,)]
    assert kept(spark, rows, "c string", fn.contains_none("c", ["sag"])) == ["head", "a.b"]
    assert kept(spark, rows, "c string", fn.contains_any("c", ["A.B", "hEAd"])) == ["Head_SAG", "head", "a.b"]
    assert kept(spark, rows, "c string", fn.contains_any("c", ["e.d"])) == []
    assert kept(spark, rows, "c string", fn.contains_any("c", [])) == []
    assert kept(spark, rows, "c string", fn.contains_none("c", [])) == ["Head_SAG", "head", "a.b"]


def test_range_keeps_null_and_listed(spark):
    rows = [(1, 29), (2, 30), (3, 99), (4, 100), (5, None), (6, 28)]
    assert kept(spark, rows, "id int, n int", fn.range_or_listed("n", 30, 100, "id", [6])) == [2, 3, 5, 6]


def test_flag_filters(spark):
    rows = [(1, None), (2, 0), (3, 1), (4, 999)]
    schema = "id int, f int"
    assert kept(spark, rows, schema, fn.flag_is("f", 0)) == [2]
    assert kept(spark, rows, schema, fn.flag_is("f", 1)) == [3]
    assert kept(spark, rows, schema, fn.flag_is_not("f", 1)) == [1, 2, 4]
    assert kept(spark, rows, schema, fn.not_listed("f", [0, 999])) == [1, 3]


def test_masked_or(spark):
    rows = [(1, 6.0, 0.0, None), (2, 0.0, 6.0, 999), (3, 0.0, 6.0, 0), (4, None, 6.0, None), (5, None, None, 1)]
    schema = "id int, a double, b double, f int"
    a, b, mask = F.col("a") >= 5, F.col("b") >= 5, F.col("f").isin(1, 999)
    assert kept(spark, rows, schema, fn.masked_or(a, b, mask)) == [1, 2]
    assert kept(spark, rows, schema, fn.masked_or(a, b)) == [1, 2, 3, 4]


def test_family_names():
    names = fn.family_names(fixed.CLASS_REGION, fixed.REGIONS, fixed.CLASSES)
    assert len(names) == 124 == len(set(names))
    assert names[4] == "prediction_iph_LeftBasalganglia-lentiform-nucleus_ml"
    assert len(fn.family_names(fixed.CLASS_REGION, fixed.REGIONS, fixed.MODEL_CLASSES)) == 93
    assert fn.family_names(fixed.REGION_VOLUME, ["Brain"]) == ["Brain_volume_ml"]
