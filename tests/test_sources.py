"""Reading and writing."""

import pathlib

import pytest
from pyspark.sql import functions as F

from cohortloom import sources


def test_csv_keeps_quotes_and_turns_nan_into_null(spark, tmp_path):
    path = f"{tmp_path}/a.csv"
    df = spark.createDataFrame([(1, 'he said "x", then', 2.5), (2, None, float("nan"))], "id int, t string, v double")
    sources.write_table(df, path)
    got = sources.read_csv(spark, path, df.schema).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(1, 'he said "x", then', 2.5), (2, None, None)]


def test_csv_with_line_breaks(spark, tmp_path):
    (tmp_path / "r.csv").write_text('id,report\n1,"line one\nline two"\n')
    got = sources.read_csv(spark, str(tmp_path / "r.csv"), "id int, report string", line_breaks=True).collect()
    assert [tuple(r) for r in got] == [(1, "line one\nline two")]


def test_review_sheet_from_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1, 0), (2, None)], "unique_study_id int, exclude int")
    for ending in ("sheet.csv", "sheet"):
        path = f"{tmp_path}/{ending}"
        sources.write_table(df, path)
        got = sources.read_review(spark, path, df.schema).orderBy("unique_study_id").collect()
        assert [tuple(r) for r in got] == [(1, 0), (2, None)]


def test_delimited_and_batches(spark, tmp_path):
    (tmp_path / "m.txt").write_text("1|*1CT20 5|folder a\n2||x\n")
    got = sources.read_delimited(spark, str(tmp_path / "m.txt"), "|", ["patient_id", "accession", "folder"]).collect()
    assert [tuple(r) for r in got] == [("1", "*1CT20 5", "folder a"), ("2", None, "x")]
    for n in (1, 2):
        (tmp_path / f"batch_{n}" / "predictions").mkdir(parents=True)
        (tmp_path / f"batch_{n}" / "predictions" / "prediction.csv").write_text(f"id\nscan_{n}\n")
    got = sources.read_batches(spark, f"{tmp_path}/batch_*/predictions", "id string", "/batch_([0-9]+)/").collect()
    assert sorted(tuple(r) for r in got) == [("scan_1", "1"), ("scan_2", "2")]


def test_listing_does_not_read_content(spark, tmp_path):
    for name in ("a/CT.1", "a/b/CT.2", "a/other.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("x" * 5)
    df = sources.list_files(spark, str(tmp_path), "CT.*")
    assert sorted(r.folder.rsplit("/", 1)[1] for r in df.collect()) == ["a", "b"]
    assert {r.length for r in df.collect()} == {5}
    assert "content" not in df._jdf.queryExecution().executedPlan().toString()


def test_lines_and_batches(spark, tmp_path):
    df = spark.range(25).select(F.concat(F.lit("/p/"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("p"))
    sources.write_lines(df, "p", f"{tmp_path}/list")
    assert spark.read.text(f"{tmp_path}/list").count() == 25
    sources.write_batches(df.repartition(4), ["p"], 10, f"{tmp_path}/batches")
    out = spark.read.parquet(f"{tmp_path}/batches").groupBy("batch_no").agg(F.count("*").alias("n"), F.min("p"))
    assert sorted(tuple(r) for r in out.collect()) == [(1, 10, "/p/000"), (2, 10, "/p/010"), (3, 5, "/p/020")]


def test_gate(spark, tmp_path):
    df = spark.createDataFrame([("r1", "/p"), ("r2", None)], "k string, p string")
    with pytest.raises(sources.IncompleteError, match="1 of 2"):
        sources.write_if(df, "k", "p", f"{tmp_path}/out")
    assert not (tmp_path / "out").exists()
    check = sources.write_if(df.where("p is not null"), "k", "p", f"{tmp_path}/out")
    assert check.first()["complete"] and spark.read.parquet(f"{tmp_path}/out").count() == 1
    with pytest.raises(sources.IncompleteError):
        sources.write_if(df, "k", "p", f"{tmp_path}/out")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    assert [f.name for f in tmp_path.iterdir()] == ["out"]  # nothing hidden stays


def test_gate_writes_once_and_replaces(spark, tmp_path, monkeypatch):
    writes = []
    write = sources.writers.write_table
    monkeypatch.setattr(sources.writers, "write_table", lambda df, path: (writes.append(path), write(df, path)))
    for n in (3, 2):
        df = spark.createDataFrame([(f"r{i}", f'a "b", {i}') for i in range(n)], "k string, p string")
        sources.write_if(df, "k", "p", f"{tmp_path}/out.csv")
        assert sorted(r["p"] for r in spark.read.csv(f"{tmp_path}/out.csv", header=True, escape='"').collect()) == [f'a "b", {i}' for i in range(n)]
    assert len(writes) == 2 and all("/.out.csv-" in w for w in writes)

    broken = spark.range(3).select(F.raise_error(F.lit("lost")).cast("string").alias("k"), F.lit("x").alias("p"))
    with pytest.raises(Exception, match="lost"):
        sources.write_if(broken, "k", "p", f"{tmp_path}/out.csv")
    assert [f.name for f in tmp_path.iterdir()] == ["out.csv"]


def test_tables_of_a_run_are_written_and_its_steps_deleted(spark, tmp_path):
    from cohortloom.session import run_folder, settle

    with run_folder(spark) as steps:
        frames = {"a": settle(spark.range(5)), "b": settle(spark.range(3)).where("id > 0")}
        local = pathlib.Path(steps.removeprefix("file:"))
        assert local.exists()
        paths = sources.write_all(frames, f"{tmp_path}/lists")
        csv = sources.write_all({"c": frames["b"]}, f"{tmp_path}/lists", kind="csv")
    assert not local.exists()
    assert {n: spark.read.parquet(p).count() for n, p in paths.items()} == {"a": 5, "b": 2}
    assert csv == {"c": f"{tmp_path}/lists/c.csv"} and spark.read.csv(csv["c"], header=True).count() == 2


def test_copies_without_ids(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 2.0)], "unique_study_id int, surgery string, v double")
    sources.write_with_and_without_ids(df, ["unique_study_id"], f"{tmp_path}/x")
    assert spark.read.parquet(f"{tmp_path}/x/with_id").columns == df.columns
    assert spark.read.parquet(f"{tmp_path}/x/without_id").columns == ["surgery", "v"]


def test_flags_with_a_decimal_point(spark, tmp_path):
    (tmp_path / "s.csv").write_text('unique_study_id,exclude,notes\na,1.0,"x\ny"\nb,0.0,\nc,,\nd,NaN,\ne,-2,\n')
    got = sources.read_review(spark, f"{tmp_path}/s.csv", "unique_study_id string, exclude int, notes string").collect()
    assert sorted((r["unique_study_id"], r["exclude"]) for r in got) == [("a", 1), ("b", 0), ("c", None), ("d", None), ("e", -2)]
    assert got[0]["notes"] == "x\ny"


@pytest.mark.parametrize("cell, kind", [("x", "int"), ("1.5", "int"), ("x", "double"), ("1;2", "bigint")])
def test_a_bad_cell_is_an_error(spark, tmp_path, cell, kind):
    (tmp_path / "s.csv").write_text(f"id,v\n1,{cell}\n")
    with pytest.raises(Exception, match="whole number|MALFORMED|FAILED_READ_FILE"):
        sources.read_csv(spark, f"{tmp_path}/s.csv", f"id int, v {kind}").collect()


def test_a_cut_record_is_an_error(spark, tmp_path):
    (tmp_path / "s.csv").write_text('id,v\n1,"one\ntwo"\n')
    with pytest.raises(Exception, match="MALFORMED|FAILED_READ_FILE|whole number"):
        sources.read_csv(spark, f"{tmp_path}/s.csv", "id int, v string").collect()


def test_batches_turn_nan_into_null(spark, tmp_path):
    (tmp_path / "batch_1").mkdir()
    (tmp_path / "batch_1" / "p.csv").write_text('id,v.ml,t\n1,NaN,"a\nb"\n2,6.5,c\n')
    got = sources.read_batches(spark, f"{tmp_path}/batch_*", "id int, `v.ml` double, t string", "/batch_([0-9]+)/", line_breaks=True)
    assert sorted(tuple(r) for r in got.collect()) == [(1, None, "a\nb", "1"), (2, 6.5, "c", "1")]
