"""What must hold at scale: hot keys are split, nothing goes through one task, results do not depend on partitions."""

import re
import sys

import pytest
from pyspark.sql import functions as F

from conftest import FOLDER

from cohortloom import operators as ops, session
from cohortloom.queries import QUERIES
from cohortloom.queries.registry import Tables
from cohortloom.queries.standins import headers, lines, scans
from cohortloom.session import shared_folder


def plan(df):
    """Executed plan, final after the rows were fetched."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def first_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    """Scans of which more than a third belong to one subject, in eight files: one map output cannot be split."""
    df = scans(Tables(spark, FOLDER))
    df = df.withColumn("uid", F.when(F.col("series").isin("click", "error"), F.lit(7)).otherwise(F.col("uid")))
    path = str(tmp_path_factory.mktemp("hot") / "scans")
    df.repartition(8).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@pytest.fixture
def small_limits(conf):
    """Limits brought down to the size of the test data."""
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )


HOT_CASES = {
    "group_max_on_rows": lambda df: ops.group_max_on_rows(df, ["uid"], "vol", "m"),
    "first_on_rows": lambda df: ops.first_on_rows(df, "uid", ["ts", "id"], {"vol": "v"}),
    "within_hours": lambda df: ops.within_hours(df, "uid", "ts", 72),
    "baseline_change": lambda df: ops.baseline_change(df, "uid", ["ts", "id"], ["vol"]),
    "outcomes": lambda df: ops.outcomes(df.withColumn("c", F.lit(0)), "uid", ["vol"], [6], "c"),
    "min_rows_per_subject": lambda df: ops.min_rows_per_subject(df, "uid", 30),
    "join_ns left": lambda df: ops.join_ns(df, df.groupBy("uid").count(), ["uid"], "left"),
    "outer_with_origin": lambda df: ops.outer_with_origin(df, df.groupBy("uid").count(), ["uid"]),
    "waterfall": lambda df: ops.waterfall(
        df.select("uid", "id"), df.select(F.col("uid").alias("k"), F.lit("/p").alias("path")).distinct(), [("uid", "k"), ("id", "k")]
    ),
    "not_in": lambda df: ops.not_in(df, "uid", df.where("vol > 300 and uid <> 7"), "uid"),
    "prefer": lambda df: ops.prefer(df, F.col("vol") > 200, ["uid"]),
}


@pytest.mark.parametrize("case", sorted(HOT_CASES))
def test_hot_subject_is_split_and_nothing_is_lost(hot, small_limits, case):
    text = plan(HOT_CASES[case](hot))
    assert "skew=true" in text, text
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("case", sorted(HOT_CASES))
def test_split_gives_the_same_rows(hot, conf, case):
    wanted = HOT_CASES[case](hot)
    names = wanted.columns
    wanted = sorted(map(str, wanted.select(names).collect()))
    conf(
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="10KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
    )
    assert sorted(map(str, HOT_CASES[case](hot).select(names).collect())) == wanted


def test_list_of_a_semi_or_anti_join_is_reduced_before_its_shuffle(spark, small_limits):
    """Neither a null nor a value that fills the list reaches one task."""
    rows = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z"), (3, "x")], "k int, v string")
    listed = spark.range(30_000, numPartitions=4).select(F.when(F.col("id") % 3 == 1, 1).when(F.col("id") == 0, 7).alias("id"))
    cases = {
        "not in": (ops.not_in(rows, "k", listed, "id"), [(2, "y"), (3, "x")]),
        "anti": (ops.join_on(rows, listed, [("k", "id")], "anti"), [(2, "y"), (3, "x")]),
        "semi": (ops.join_on(rows, listed, [("k", "id")], "semi"), [(1, "x"), (None, "z")]),
    }
    for df, wanted in cases.values():
        found = sorted(map(tuple, df.collect()), key=str)
        assert found == sorted(wanted, key=str)
        right = first_plan(df).split("Join", 1)[1]
        assert re.search(r"Exchange hashpartitioning[^\n]*\n[^\n]*HashAggregate\(keys=\[[^]]*\], functions=\[\]", right), right
    origin = ops.outer_with_origin(rows.withColumnRenamed("k", "id"), listed.withColumn("w", F.lit(1)), ["id"])
    assert {r["_merge"]: r["count"] for r in origin.groupBy("_merge").count().collect()} == {"both": 10_000 + 19_999, "left_only": 2, "right_only": 1}


def test_small_history_is_broadcast_by_its_size(hot):
    text = first_plan(ops.baseline_change(hot, "uid", ["ts", "id"], ["vol"]))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_large_history_is_not_broadcast(hot, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="100B")
    assert "SortMergeJoin" in first_plan(ops.baseline_change(hot, "uid", ["ts", "id"], ["vol"]))


def test_groups_are_reduced_before_the_shuffle(hot):
    for df in [
        ops.group_max(hot, ["uid"], ["vol"]),
        ops.group_counts(hot, ["uid"]),
    ]:
        text = first_plan(df)
        assert "partial_" in text and "Window" not in text
    for df in [
        ops.argmin_per_group(hot, ["uid"], "vol", ["id"]),
        ops.best_of_group(hot, ["uid"], "vol", ["id"]),
        ops.tag_long_table(hot, "uid", "folder", "id", "id", "series", "series", "vol"),
    ]:
        assert re.search(r"Exchange hashpartitioning.*\n.*WindowGroupLimit .* 1, Partial", first_plan(df))


def written_plans(monkeypatch, make):
    """Plans of a result and of every step that is written down on the way."""
    plans = []

    def written(df):
        plans.append(first_plan(df))
        return session.settle(df)

    for module in [m for n, m in sys.modules.items() if n.startswith("cohortloom.") and hasattr(m, "settle") and m is not session]:
        monkeypatch.setattr(module, "settle", written)
    last = first_plan(make())
    return [*plans, last]


def test_first_non_null_sorts_no_rows_for_an_aggregate(hot, monkeypatch):
    """First rows and open cells are both found by rank, reduced in every input part."""
    df = hot.withColumns({"s": F.when(F.col("vol") > 100, F.col("id")), "v": F.when(F.col("vol") < 50, F.col("vol"))})
    plans = written_plans(monkeypatch, lambda: ops.first_non_null_per_group(df, ["uid"], ["ts", "id"]))
    assert len(plans) == 3 and not any("SortAggregate" in p for p in plans)
    assert all(re.search(r"WindowGroupLimit .* 1, Partial", p) for p in plans[:2])


def test_hot_subject_is_ranked_by_ranges(hot, small_limits, monkeypatch):
    wanted = sorted(map(str, ops.dense_rank_per_subject(hot.select("uid", "ts", "id"), "uid", ["ts"]).collect()))
    plans = written_plans(monkeypatch, lambda: ops.dense_rank_per_subject(hot.select("uid", "ts", "id"), "uid", ["ts"], large=100))
    assert any("rangepartitioning" in p for p in plans)
    assert sorted(map(str, ops.dense_rank_per_subject(hot.select("uid", "ts", "id"), "uid", ["ts"], large=100).collect())) == wanted


def test_ordinary_subjects_are_shuffled_once(hot):
    text = first_plan(ops.dense_rank_per_subject(hot.select("uid", "ts", "id"), "uid", ["ts"]))
    assert text.count("Exchange") == 1 and "Join" not in text


# Queries with a window over everything: it runs over one row per range, never over the table.
BOUNDED = r"__part|bucket"


def windows_in_one_task(text):
    lines_ = text.split("\n")
    for i, line in enumerate(lines_):
        if re.search(r"[-+ ]Window \[", line):
            exchange = next((x for x in lines_[i + 1 :] if "Exchange" in x), "")
            if "SinglePartition" in exchange:
                yield line


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_single_task(spark, folder, name, monkeypatch):
    """Holds for the result and for every step that is written down on the way."""
    for text in written_plans(monkeypatch, lambda: QUERIES[name](spark, folder)):
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "PythonUDF" not in text and "InPandas" not in text
        assert all(re.search(BOUNDED, w) for w in windows_in_one_task(text))


@pytest.mark.parametrize("name", ["pipe_clean_table", "pipe_choose_images"])
def test_images_are_numbered_once(spark, folder, name, monkeypatch):
    assert sum("dense_rank" in text for text in written_plans(monkeypatch, lambda: QUERIES[name](spark, folder))) == 1


def test_columns_and_filters_reach_the_scan(spark, folder):
    t = Tables(spark, folder)
    text = first_plan(t.events.where(F.col("value") >= 100).select("event_id"))
    assert "GreaterThanOrEqual(value,100.0)" in text and "ReadSchema: struct<event_id:bigint,value:double>" in text
    text = first_plan(ops.best_of_group(scans(t).select("uid", "id", "qc"), ["uid"], "qc", ["id"]))
    assert "props" not in text


@pytest.mark.parametrize("parts", ["1", "7"])
def test_rows_do_not_depend_on_partitions(spark, folder, conf, parts):
    t = Tables(spark, folder)

    def results():
        return [
            sorted(map(str, df.collect()))
            for df in [
                ops.best_of_group(scans(t), ["folder", "series"], "qc", ["id"]),
                ops.global_row_id(t.documents.select("doc_id", "source"), ["source", "doc_id"]),
                ops.split_exact(t.customer.select("c_custkey"), "c_custkey", 0.3, 1300),
                ops.five_number_summary(ops.melt(lines(t), ["uid"], ["iph", "eah"]), "value", ["variable"]),
                ops.dense_rank_per_subject(scans(t).select("uid", "ts", "id"), "uid", ["ts"]),
                ops.tag_long_table(headers(t), "folder", "file", "grp", "elem", "name", "vr", "value"),
            ]
        ]

    wanted = results()
    conf(spark__sql__shuffle__partitions=parts, spark__sql__adaptive__enabled="false")
    assert results() == wanted


def test_at_most_one_row_per_key(spark, folder):
    t = Tables(spark, folder)
    best = ops.best_of_group(scans(t), ["folder", "series"], "qc", ["id"])
    assert best.groupBy("folder", "series").count().where("count > 1").count() == 0
    variant = F.col("series") == "purchase"
    mixed = ops.prefer(best, variant, ["folder"]).groupBy("folder")
    assert mixed.agg(F.max(variant).alias("a"), F.min(variant).alias("b")).where("a and not b").count() == 0


class Named:
    """A session as seen by ``shared_folder``."""

    def __init__(self, master, named=None, context_dir=None):
        self.conf = {"spark.checkpoint.dir": named} if named else {}
        self.sparkContext = self
        self.master, self.folder = master, context_dir

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


def test_shared_folder_is_the_one_the_session_names():
    assert shared_folder(Named("yarn", "hdfs:///shared")) == "hdfs:///shared"
    assert shared_folder(Named("yarn", None, "hdfs:///set")) == "hdfs:///set"
    assert "cohortloom-" in shared_folder(Named("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Named("yarn"))


def test_numbered_rows_are_written_to_the_shared_folder(spark):
    df = ops.global_row_id(spark.range(10), ["id"])
    assert all(shared_folder(spark).removeprefix("file:") in f for f in df.inputFiles())
