"""Table operators on hand-made rows: nulls, ties, empty lists, repeated rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cohortloom import operators as ops


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=str)


# --- joins ------------------------------------------------------------------------------------------------------


@pytest.fixture
def pair(spark):
    a = frame(spark, [(1, "a"), (None, "n"), (2, "b"), (2, "b")], "k int, x string")
    b = frame(spark, [(1, 10), (None, 20), (3, 30)], "k int, y int")
    return a, b


def test_null_matches_null(pair):
    a, b = pair
    assert rows(ops.join_ns(a, b, ["k"])) == [(1, "a", 10), (None, "n", 20)]
    assert rows(ops.join_ns(a, b, ["k"], "left")) == [(1, "a", 10), (2, "b", None), (2, "b", None), (None, "n", 20)]
    assert rows(ops.join_ns(a, b, ["k"], "right")) == [(1, "a", 10), (3, None, 30), (None, "n", 20)]
    assert rows(ops.join_ns(a, b, ["k"], "semi")) == [(1, "a"), (None, "n")]
    assert rows(ops.join_ns(a, b, ["k"], "anti")) == [(2, "b"), (2, "b")]
    assert rows(ops.natural_join(a, b)) == [(1, "a", 10), (None, "n", 20)]


def test_shared_other_columns_get_suffixes(spark):
    a, b = frame(spark, [(1, 2)], "k int, v int"), frame(spark, [(1, 3)], "k int, v int")
    out = ops.join_ns(a, b, ["k"])
    assert out.columns == ["k", "v_x", "v_y"] and rows(out) == [(1, 2, 3)]
    with pytest.raises(ValueError):
        ops.join_ns(a, b, ["k"], "full")


def test_outer_with_origin(pair):
    a, b = pair
    assert rows(ops.outer_with_origin(a, b, ["k"])) == [
        (1, "a", 10, "both"), (2, "b", None, "left_only"), (2, "b", None, "left_only"), (3, None, 30, "right_only"),
        (None, "n", 20, "both"),
    ]


def test_not_in_with_null_in_list(spark, pair):
    a, _ = pair
    listed = frame(spark, [(1,), (None,)], "id int")
    assert rows(ops.not_in(a, "k", listed, "id")) == [(2, "b"), (2, "b")]
    assert ops.not_in(a, "k", listed.where("false"), "id").count() == 4


def test_join_distinct_does_not_fan_out(spark, pair):
    a, _ = pair
    dim = frame(spark, [(2, "z"), (2, "z"), (1, "y")], "k int, w string")
    assert rows(ops.join_distinct(a, dim, ["k"], ["w"])) == [(1, "a", "y"), (2, "b", "z"), (2, "b", "z")]


def test_waterfall_tries_keys_in_turn_and_loses_no_row(spark):
    a = frame(spark, [(1, "p", "q"), (1, "p", "q"), (2, "x", "q"), (3, "x", "x")], "id int, k1 string, k2 string")
    b = frame(spark, [("p", "/1"), ("q", "/2"), ("q", "/3")], "m string, path string")
    out = ops.waterfall(a, b, [("k1", "m"), ("k2", "m")])
    assert rows(out, "id", "path") == [(1, "/1"), (2, "/2"), (2, "/3"), (3, None)]


def test_waterfall_matches_no_missing_number(spark):
    """300 rows without a number against 200 listed rows without one: each comes out once, with nothing."""
    a = frame(spark, [(i, None, None) for i in range(300)] + [(300, None, "x"), (301, "y", "x")], "id int, k1 string, k2 string")
    b = frame(spark, [(None, f"folder {i}") for i in range(200)] + [("x", "of x"), ("y", "of y")], "m string, folder string")
    out = rows(ops.waterfall(a, b, [("k1", "m"), ("k2", "m")]), "id", "folder")
    assert len(out) == 302 and {(300, "of x"), (301, "of y")} <= set(out)
    assert [r for r in out if r[0] < 300] == sorted(((i, None) for i in range(300)), key=str)


def test_waterfall_with_two_listed_numbers(spark):
    a = frame(spark, [(1, "p", "q"), (2, "z", "q"), (3, "z", "z")], "id int, k1 string, k2 string")
    b = frame(spark, [("p", "1", "first"), ("0", "q", "second")], "m string, n string, folder string")
    assert rows(ops.waterfall(a, b, [("k1", "m"), ("k2", "n")]), "id", "folder") == [(1, "first"), (2, "second"), (3, None)]


def test_prefix_is_literal_and_extensions_stay(spark):
    a = frame(spark, [("/a/b",), ("/a/b_more",), ("/A/B/c",), ("/axb",), ("/z",), (None,), ("/a/b",)], "p string")
    listed = frame(spark, [("/a/b",), ("/a.b",), (None,)], "f string")
    assert rows(ops.prefix_semi(a, "p", listed, "f")) == [("/A/B/c",), ("/a/b",), ("/a/b",), ("/a/b_more",)]
    assert rows(ops.prefix_semi(a, "p", listed, "f", any_case=False)) == [("/a/b",), ("/a/b",), ("/a/b_more",)]
    assert ops.prefix_semi(a, "p", listed.where("false"), "f").count() == 0


def test_empty_removal_list_removes_nothing(spark):
    a = frame(spark, [("/a",), ("/b",)], "p string")
    empty = frame(spark, [], "f string")
    assert ops.anti_path_list(a, "p", empty, "f").count() == 2
    assert rows(ops.anti_path_list(a, "p", frame(spark, [("/a",)], "f string"), "f")) == [("/b",)]


# --- grouping ---------------------------------------------------------------------------------------------------


@pytest.fixture
def metric(spark):
    data = [("a", 1, 5.0), ("a", 2, 3.0), ("a", 3, 3.0), ("a", 4, None), ("b", 5, None), (None, 6, 1.0), ("c", 7, 9.0)]
    return frame(spark, data, "g string, id int, m double")


def test_argmin_skips_null_and_breaks_ties(metric):
    assert rows(ops.argmin_per_group(metric, ["g"], "m", ["id"])) == [("a", 2, 3.0), ("c", 7, 9.0)]


def test_best_of_group_keeps_all_null_groups(metric):
    assert rows(ops.best_of_group(metric, ["g"], "m", ["id"])) == [("a", 2, 3.0), ("b", 5, None), ("c", 7, 9.0)]


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_prefixes_of_any_length_are_swept_once(spark, ranges):
    """One prefix of one sign among a hundred lengths, nested ones, and signs beyond all others."""
    draw = random.Random(9)
    signs = ["a", "b", "/", "é", "漢", "\U0010ffff", ".", "%"]
    name = lambda n: "".join(draw.choices(signs, k=n))
    listed = ["%", *[name(n) for n in range(2, 102)], None, "", "aab", "aa"][: 104 if ranges != 1 else 102] + ["aab", "aa"]
    paths = [name(draw.randint(0, 9)) for _ in range(700)] + [p + name(3) for p in listed if p] + listed
    for known in (listed, [p for p in listed if p]):
        wanted = sorted(p for p in paths if p is not None and any(k is not None and p.startswith(k) for k in known))
        a, prefixes = frame(spark, [(p, i) for i, p in enumerate(paths)], "p string, i int"), frame(spark, [(k,) for k in known], "k string")
        got = ops.prefix_semi(a, "p", prefixes, "k", any_case=False, ranges=ranges)
        assert sorted(r["p"] for r in got.collect()) == wanted


def test_prefixes_make_no_row_per_length(spark):
    a, prefixes = frame(spark, [("x" * n,) for n in range(1, 200)], "p string"), frame(spark, [("x" * n,) for n in range(1, 101)], "k string")
    got = ops.prefix_semi(a, "p", prefixes, "k")
    assert got.count() == 199
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("seed", range(3))
def test_first_non_null_of_all_types(spark, seed):
    """Whatever the type of a column, and with keys that have nothing to offer."""
    draw = random.Random(seed)
    made = {"i": lambda: draw.randint(0, 9), "s": lambda: draw.choice("xyz"), "d": lambda: draw.random(), "a": lambda: [draw.randint(0, 3), None],
            "t": lambda: {"p": draw.randint(0, 9), "q": None}, "s2": lambda: "w", "never": lambda: None}
    data = [(draw.randint(0, 12), draw.choice([None, 1, 2]), o, *[f() if draw.random() < 0.3 else None for f in made.values()]) for o in range(80)]
    schema = "g int, h int, o int, i int, s string, d double, a array<int>, t struct<p: int, q: string>, s2 string, never date"
    df = frame(spark, data, schema)
    wanted = {}
    for g, h, o, *values in data:
        if h is not None:
            row = wanted.setdefault((g, h), [None] * (len(values) + 1))
            row[0] = o if row[0] is None else row[0]
            row[1:] = [v if old is None else old for old, v in zip(row[1:], values)]
    out = ops.first_non_null_per_group(df, ["g", "h"], ["o"])
    assert out.columns == df.columns
    got = {(r["g"], r["h"]): [r["o"], *[r[c].asDict() if c == "t" and r[c] else r[c] for c in made]] for r in out.collect()}
    assert got == wanted
    assert ops.first_non_null_per_group(df.limit(0), ["g", "h"], ["o"]).count() == 0


def test_first_non_null_mixes_rows(spark):
    data = [(1, 1, None, "x"), (1, 2, 5.0, None), (1, 3, 6.0, "y"), (2, 1, None, None), (None, 1, 1.0, "z"), (3, None, 1.0, "l"), (3, 9, 2.0, "k")]
    df = frame(spark, data, "g int, o int, v double, t string")
    out = ops.first_non_null_per_group(df, ["g"], ["o"])
    assert rows(out, "g", "v", "t") == [(1, 5.0, "x"), (2, None, None), (3, 2.0, "k")]


def test_pivot_raises_on_repeated_pairs(spark):
    df = frame(spark, [("f", "A", "1"), ("f", "B", None), ("g", "A", "2"), ("g", "C", "3")], "r string, c string, v string")
    assert rows(ops.pivot_unique(df, "r", "c", "v", ["A", "B"])) == [("f", "1", None), ("g", "2", None)]
    twice = df.unionByName(frame(spark, [("f", "A", "1")], "r string, c string, v string"))
    with pytest.raises(Exception, match="more than one value for attribute A"):
        ops.pivot_unique(twice, "r", "c", "v", ["A", "B"]).collect()


def test_melt_keeps_null(spark):
    df = frame(spark, [(1, 2.0, None)], "id int, a double, b double")
    assert rows(ops.melt(df, ["id"], ["a", "b"])) == [(1, "a", 2.0), (1, "b", None)]


def test_counts(spark):
    df = frame(spark, [("x", 1), ("x", None), (None, 2), ("y", 2)], "k string, v int")
    assert rows(ops.group_counts(df, ["k"], "v")) == [("x", 1), ("y", 1)]
    assert rows(ops.value_counts(df, ["k"])) == [("x", 2), ("y", 1)]
    assert rows(ops.distinct_counts(df, ["k", "v"])) == [(2, 2)]
    assert rows(ops.null_counts(df)) == [(1, 1)]
    assert rows(ops.unique_key_check(df, "k")) == [(4, 3, False)]
    assert rows(ops.unique_key_check(df.where("v is null or k = 'y'"), "k")) == [(2, 2, True)]
    assert rows(ops.group_size_range(df, ["k"])) == [(1, 2)]


def test_percent_of_total_cleans_labels(spark):
    df = frame(spark, [(" A",), ("a ",), ("b",), (None,)], "r string")
    assert rows(ops.percent_of_total(df, "r")) == [("a", 2, 66.7), ("b", 1, 33.3)]


def test_group_max_total(spark):
    df = frame(spark, [(1, 0.0, None), (1, 2.0, None), (2, 0.0, 0.0), (None, 9.0, 9.0)], "g int, a double, b double")
    assert rows(ops.group_max(df, ["g"], ["a", "b"])) == [(1, 2.0, None, 2.0), (2, 0.0, 0.0, 0.0)]


def test_histogram(spark):
    df = frame(spark, [(0.0,), (1.0,), (10.0,), (9.5,), (None,)], "v double")
    assert {r.bin: r.count_ for r in ops.histogram(df, "v").withColumnRenamed("count", "count_").collect() if r.count_} == {
        1: 1, 2: 1, 10: 2,
    }
    assert ops.histogram(df, "v").count() == 10
    flat = frame(spark, [(3.0,)] * 4, "v double")
    assert [tuple(r) for r in ops.histogram(flat, "v").where("count > 0").collect()] == [(6, 4)]


def test_histograms_of_all_columns_read_the_table_twice(spark, tmp_path):
    data = [(float(i % 7), None if i % 3 else float(i), 5, "nan") for i in range(50)]
    frame(spark, data, "a double, b double, c int, d string").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t").withColumn("d", F.col("d").cast("double"))
    names = ["a", "b", "c", "d"]
    out = ops.histograms(df, names, 5)
    got = {c: [r["count"] for r in out.where(F.col("variable") == c).orderBy("bin").collect()] for c in names}
    for c in names:
        assert got[c] == [r["count"] for r in ops.histogram(df, c, 5).orderBy("bin").collect()]
    assert got == {"a": [15, 7, 7, 7, 14], "b": [4, 3, 3, 3, 4], "c": [0, 0, 50, 0, 0], "d": [0] * 5}
    out.collect()
    assert out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan") <= 2


@pytest.mark.parametrize("seed", [1, 2])
def test_five_numbers_equal_linear_quantiles(spark, seed):
    import numpy as np

    rng = random.Random(seed)
    data = [(g, float(rng.choice([0, 0, 0, 1, 2.5, rng.random()]))) for g in ("a", "b") for _ in range(rng.randint(1, 40))]
    df = frame(spark, data + [("a", None), (None, 1.0), ("one", 7.0)], "g string, v double")
    for row in ops.five_number_summary(df, "v", ["g"]).collect():
        wanted = np.quantile([v for g, v in data + [("one", 7.0)] if g == row.g], [0, 0.25, 0.5, 0.75, 1])
        assert [row["min"], row.q1, row.median, row.q3, row["max"]] == pytest.approx(list(wanted))
    near = ops.five_number_summary(df, "v", ["g"], approx=True)
    assert rows(near.where("g = 'one'")) == [("one", 7.0, 7.0, 7.0, 7.0, 7.0)]


def test_tails_are_labelled_in_one_pass(spark):
    df = frame(spark, [(1, 10.0), (2, -10.0), (3, None), (4, 200.0)], "id int, v double")
    tails = [("up", F.col("v") >= 10), ("down", F.col("v") <= -10), ("far", F.col("v") > 100)]
    assert rows(ops.tail_lists(df, tails, ["id"])) == [("down", 2), ("far", 4), ("up", 1), ("up", 4)]


def test_funnel(spark):
    df = frame(spark, [(1, 1, 1), (1, 0, 1), (2, 1, 0), (2, None, 1), (None, 1, 1)], "s int, a int, b int")
    out = ops.funnel(df, [("all", F.lit(True)), ("a", F.col("a") == 1), ("b", F.col("b") == 1)], "s")
    assert rows(out) == [(0, "all", 2, 5), (1, "a", 2, 3), (2, "b", 1, 2)]


def test_completeness_looks_at_the_value(spark):
    df = frame(spark, [("r1", "/p"), ("r2", None), ("r1", None), (None, "/q")], "k string, p string")
    assert rows(ops.completeness(df, "k", "p")) == [(2, 1, False)]
    assert rows(ops.completeness(df.where("p is not null"), "k", "p")) == [(1, 1, True)]


# --- histories --------------------------------------------------------------------------------------------------

T0 = datetime(2024, 1, 1)


@pytest.fixture
def history(spark):
    data = [
        (1, "a", T0, None, 1.0), (1, "b", T0 + timedelta(hours=72.5), 5.0, 3.0),
        (1, "c", T0 + timedelta(hours=72.6), 9.0, 2.0), (2, "d", T0, 4.0, None), (None, "e", T0, 1.0, 1.0),
    ]
    return frame(spark, data, "s int, id string, t timestamp_ntz, v double, w double")


def test_window_admits_half_an_hour_more(history):
    assert rows(ops.within_hours(history, "s", "t", 72), "s", "id") == [(1, "a"), (1, "b"), (2, "d")]


def test_baseline_is_first_non_null(history):
    out = ops.baseline_change(history, "s", ["t", "id"], ["v", "w"], greatest="max_{}")
    assert rows(out, "id", "v_first", "change_v", "max_v", "change_w", "max_w") == [
        ("a", 5.0, None, 4.0, 0.0, 2.0), ("b", 5.0, 0.0, 4.0, 2.0, 2.0), ("c", 5.0, 4.0, 4.0, 1.0, 2.0),
        ("d", 4.0, 0.0, 0.0, None, None), ("e", None, None, None, None, None),
    ]


def test_values_on_rows(history):
    assert rows(ops.group_max_on_rows(history, ["s"], "v", "m"), "id", "m") == [
        ("a", 9.0), ("b", 9.0), ("c", 9.0), ("d", 4.0), ("e", None),
    ]
    assert rows(ops.first_on_rows(history, "s", ["t"], {"v": "f"}), "id", "f") == [
        ("a", 5.0), ("b", 5.0), ("c", 5.0), ("d", 4.0), ("e", None),
    ]


def test_rebaseline_follows_the_given_order(spark):
    df = frame(spark, [(1, "a", 1, 9.0), (1, "b", 3, 5.0), (1, "c", 2, 4.0)], "s int, id string, n int, v double")
    out = ops.rebaseline_after_exclusion(df, frame(spark, [("a",)], "x string"), "id", "x", "s", ["n"], ["v"])
    assert rows(out, "id", "change_v") == [("b", 1.0), ("c", 0.0)]


def test_outcomes_belong_to_the_subject(spark):
    df = frame(spark, [(1, 7.0, None), (1, 0.0, None), (2, 50.0, 1), (3, None, 0)], "s int, d double, c int")
    out = ops.outcomes(df, "s", ["d"], [6, 8], "c")
    assert rows(out, "s", "outcome_6", "outcome_8") == [(1, 1, 0), (1, 1, 0), (2, 0, 0), (3, 0, 0)]


def test_min_rows(history):
    assert rows(ops.min_rows_per_subject(history, "s", 2), "id") == [("a",), ("b",), ("c",), ("e",)]
    assert rows(ops.min_rows_per_subject(history, "s", 3, "v"), "id") == [("e",)]


def test_followup_is_by_report_not_by_subject(spark):
    df = frame(spark, [(1, 1, "r1"), (1, 2, "r2"), (2, 1, "r2"), (2, 2, "r3")], "s int, n int, r string")
    assert rows(ops.followup_rows(df, "s", "n", "r", ["r"])) == [(2, 2, "r3")]


# --- numbering --------------------------------------------------------------------------------------------------


def test_dense_rank(spark):
    rng = random.Random(3)
    data = [(rng.choice([1, 1, 1, 2, None]), rng.randint(0, 30), rng.choice("ab")) for _ in range(300)]
    df = frame(spark, data, "s int, t int, f string")
    out = ops.dense_rank_per_subject(df, "s", ["t", "f"])
    again = ops.dense_rank_per_subject(out.withColumn("scan_number", F.lit("old")), "s", ["t", "f"])
    assert again.columns == out.columns and rows(again) == rows(out)
    order = {s: {p: i + 1 for i, p in enumerate(sorted({(t, f) for q, t, f in data if q == s}))} for s in (1, 2)}
    wanted = sorted(((s, t, f, order[s][(t, f)] if s else None) for s, t, f in data), key=str)
    assert rows(out) == wanted


@pytest.mark.parametrize("large", [0, 3, 80, 10_000])
def test_dense_rank_of_large_subjects(spark, large):
    """Ranked in place or by ranges, the numbers are the same."""
    rng = random.Random(5)
    data = [(rng.choice([1, 1, 1, 2, 3, None]), rng.choice([rng.randint(0, 20), None]), rng.choice("ab")) for _ in range(200)]
    df = frame(spark, data, "s int, t int, f string")
    key = lambda p: (p[0] is None, p[0] or 0, p[1])
    order = {s: {p: i + 1 for i, p in enumerate(sorted({(t, f) for q, t, f in data if q == s}, key=key))} for s in (1, 2, 3)}
    wanted = sorted(((s, t, f, order[s][(t, f)] if s else None) for s, t, f in data), key=str)
    assert rows(ops.dense_rank_per_subject(df, "s", ["t", "f"], large=large)) == wanted


@pytest.mark.parametrize("ranges", [None, 1, 5])
def test_row_ids_are_complete_and_in_order(spark, ranges):
    keys = random.Random(4).sample(range(10_000), 500)
    out = ops.global_row_id(frame(spark, [(k,) for k in keys], "k int").repartition(7), ["k"], ranges=ranges)
    assert {r.k: r.row_id for r in out.collect()} == {k: i + 1 for i, k in enumerate(sorted(keys))}


@pytest.mark.parametrize("n, test_rows", [(1, 1), (10, 3), (11, 4), (1000, 300), (0, 0)])
def test_split_is_exact_and_repeatable(spark, n, test_rows):
    df = spark.range(n).withColumnRenamed("id", "k")
    one = rows(ops.split_exact(df.repartition(3), "k", 0.3, 1300))
    two = rows(ops.split_exact(df.coalesce(1), "k", 0.3, 1300))
    assert one == two and len(one) == n and sum(s == "test" for _, s in one) == test_rows
    if n > 10:
        assert one != rows(ops.split_exact(df, "k", 0.3, 1))


def test_sample_is_repeatable(spark):
    df = spark.range(1000)
    one = rows(ops.sample_n(df.repartition(5), "id", 20, 1148))
    assert len(one) == 20 and one == rows(ops.sample_n(df.coalesce(1), "id", 20, 1148))


def test_sort_puts_null_last_both_ways(spark):
    df = frame(spark, [(1,), (None,), (2,)], "v int")
    assert [r.v for r in ops.sort_multi(df, ("v", True)).collect()] == [1, 2, None]
    assert [r.v for r in ops.sort_multi(df, ("v", False)).collect()] == [2, 1, None]


# --- choosing ---------------------------------------------------------------------------------------------------


def test_prefer_drops_only_where_a_variant_exists(spark):
    df = frame(spark, [(1, True), (1, False), (2, False), (None, True), (None, False), (3, None)], "k int, v boolean")
    assert rows(ops.prefer(df, F.col("v"), ["k"])) == [(1, True), (2, False), (3, None), (None, True)]


def chosen_by_hand(base, picks):
    """The rule, row by row. Rows are (uid, report, folder, number, id, qc)."""
    sizes = {}
    for u, r, f, n, i, q in base:
        sizes[(u, f, n)] = sizes.get((u, f, n), 0) + 1
    crowded = [b for b in base if sizes[(b[0], b[2], b[3])] >= 2]
    picked = [b for b in crowded for p in picks if (b[0], b[4]) == p]
    reports = {b[1] for b in picked}
    best = {}
    for b in crowded:
        if b[1] not in reports and b[5] is not None:
            key = (b[0], b[1])
            best[key] = min(best.get(key, b), b, key=lambda x: (x[5], x[4]))
    choice = list(best.values()) + picked
    blocks = {(c[0], c[1], c[2]) for c in choice}
    kept = [b for b in base if (b[0], b[1], b[2]) not in blocks]
    return sorted(kept + [b for c in choice for b in base if (b[:3], b[4]) == (c[:3], c[4])], key=str)


@pytest.mark.parametrize("seed", range(4))
def test_override_equals_rule_by_hand(spark, seed):
    rng = random.Random(seed)
    base = [
        (rng.randint(1, 3), rng.choice("rst"), rng.choice("fg"), rng.randint(1, 2), i, rng.choice([None, -1.0, -2.0, 0.0]))
        for i in range(40)
    ]
    picks = [(b[0], b[4]) for b in rng.sample(base, 5)]
    picks.append(picks[0])
    out = ops.override(
        frame(spark, base, "u int, r string, f string, n int, id int, q double"),
        frame(spark, picks, "u int, keep int"), "keep", "u", "r", "f", "n", "id", "q", ["id"],
    )
    assert rows(out, "u", "r", "f", "n", "id", "q") == chosen_by_hand(base, picks)


def test_report_picked_in_another_folder_leaves_rows_in_place(spark):
    base = [
        (1, "r", "f", 1, 1, -1.0), (1, "r", "f", 1, 2, -2.0), (1, "r", "g", 1, 3, -1.0), (1, "r", "g", 1, 4, -5.0),
    ]
    df = frame(spark, base, "u int, r string, f string, n int, id int, q double")
    picks = frame(spark, [(1, 1)], "u int, keep int")
    out = ops.override(df, picks, "keep", "u", "r", "f", "n", "id", "q", ["id"])
    assert [r[0] for r in rows(out, "id")] == [1, 3, 4]


def test_unions(spark):
    a, b = frame(spark, [(1, "x"), (1, "x")], "k int, v string"), frame(spark, [(1,)], "k int")
    assert rows(ops.union_all(a, b)) == [(1, "x"), (1, "x"), (1, None)]
    assert rows(ops.union_distinct(a, a)) == [(1, "x")]
    assert rows(ops.set_difference(a.select("k"), frame(spark, [(2,)], "k int"))) == [(1,)]


def test_tag_table_takes_smallest_file_and_drops_pixels(spark):
    data = [
        ("d", "2", 8, 8, "Image Type", "CS", "late"), ("d", "1", 8, 8, "Image Type", "CS", "early"),
        ("d", "1", 32736, 16, "Pixel Data", "OW", "..."), (None, "5", 8, 80, None, "SH", "n"),
    ]
    df = frame(spark, data, "e string, f string, g int, h int, n string, vr string, v string")
    assert rows(ops.tag_long_table(df, "e", "f", "g", "h", "n", "vr", "v")) == [
        ("d", "0008", "0008", "Image Type", "CS", "early"), (None, "0008", "0050", None, "SH", "n"),
    ]


def test_approximate_counts(spark):
    df = spark.range(100).selectExpr("id % 10 AS k")
    assert rows(ops.distinct_counts(df, ["k"], approx=True)) == [(10,)]


def test_missing_numbers_are_not_counted(spark):
    df = frame(spark, [(float(i),) for i in range(1, 11)] + [(float("nan"),), (None,)], "v double")
    assert sum(r["count"] for r in ops.histogram(df, "v", 3).collect()) == 10
    five = ops.five_number_summary(df.withColumn("g", F.lit(1)), "v", ["g"]).first()
    assert (five["min"], five["q1"], five["median"], five["q3"], five["max"]) == (1.0, 3.25, 5.5, 7.75, 10.0)


def test_a_split_is_exact_or_an_error(spark):
    four = frame(spark, [(i % 4,) for i in range(100)], "k int")
    with pytest.raises(ValueError, match="unique key"):
        ops.split_exact(four, "k", 0.3, 1300).count()
    assert ops.split_exact(spark.range(100), "id", 0.3, 1300).where("split = 'test'").count() == 30
