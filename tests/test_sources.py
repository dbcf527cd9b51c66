import pytest

from sortilex.operators import class_metrics, long_metrics
from sortilex.sources import (
    ingest_text_files,
    read_documents,
    read_metrics,
    record_metrics,
    write_documents,
)


def ids(df):
    return sorted(r.id for r in df.collect())


def test_append_and_overwrite(spark):
    df = spark.range(5)
    write_documents(df, "docs_modes", "overwrite")
    write_documents(df, "docs_modes", "append")
    assert ids(read_documents(spark, "docs_modes")) == sorted(list(range(5)) * 2)
    write_documents(spark.range(2), "docs_modes", "overwrite")
    assert ids(read_documents(spark, "docs_modes")) == [0, 1]
    with pytest.raises(Exception):
        write_documents(df, "docs_modes", "error")
    write_documents(df, "docs_modes", "ignore")
    assert ids(read_documents(spark, "docs_modes")) == [0, 1]


def test_three_level_name(spark):
    write_documents(spark.range(3), "spark_catalog.default.docs_named", "overwrite")
    assert ids(read_documents(spark, "spark_catalog.default.docs_named")) == [0, 1, 2]


def test_external_partitioned_table(spark, tmp_path, plan):
    df = spark.range(10).selectExpr("id", "concat('k', id % 2) as kind")
    path = str(tmp_path / "t")
    write_documents(df, "docs_parts", "overwrite", path=path, partition_by=["kind"])
    one = read_documents(spark, path=path).filter("kind = 'k1'")
    assert ids(one) == [1, 3, 5, 7, 9]
    assert "PartitionFilters: [isnotnull(kind" in plan(one)


def test_bucketed_tables_join_without_a_shuffle(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("docs_left", "docs_right"):
            write_documents(spark.range(100), name, "overwrite", bucket_by=(4, "id"))
        left, right = read_documents(spark, "docs_left"), read_documents(spark, "docs_right")
        joined = left.join(right, "id")
        assert "Exchange" not in plan(joined)
        assert joined.count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bad_calls_are_refused(spark):
    with pytest.raises(ValueError):
        write_documents(spark.range(1), "x", "merge")
    with pytest.raises(ValueError):
        read_documents(spark)
    with pytest.raises(ValueError):
        read_documents(spark, "x", "y")


def test_one_row_per_file(spark, tmp_path):
    files = {
        "peachy/one.txt": "一行目\n二行目\n\n四行目\n",
        "peachy/deep er/two+three.txt": "a\r\nb",
        "smax/100%.txt": " ",
        "smax/猫.txt": "𠮷",
    }
    for name, content in files.items():
        target = tmp_path / name
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(content.encode())
    (tmp_path / "smax" / "notes.md").write_text("not a document")
    (tmp_path / "smax" / "empty.txt").write_text("")
    rows = ingest_text_files(spark, str(tmp_path), "*.txt").collect()
    got = {r.path.split(f"{tmp_path}/")[1]: r for r in rows}
    assert set(got) == set(files)
    assert {k: r.content for k, r in got.items()} == files
    assert {k: r.folder for k, r in got.items()} == {
        "peachy/one.txt": "peachy",
        "peachy/deep er/two+three.txt": "deep er",
        "smax/100%.txt": "smax",
        "smax/猫.txt": "smax",
    }
    assert ingest_text_files(spark, str(tmp_path)).count() == 5


def test_bytes_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "bad.txt").write_bytes(b"ok \xff end")
    assert ingest_text_files(spark, str(tmp_path)).first().content == "ok � end"


def metrics(spark, pairs):
    scored = spark.createDataFrame(pairs, "label int, prediction int")
    return long_metrics(class_metrics(scored, ("a", "b")))


def stored(spark, path):
    rows = read_metrics(spark, path).collect()
    return {(r.run_id, r.category, r.metric): r.value for r in rows}, len(rows)


def test_recording_again_replaces_one_run(spark, tmp_path, plan):
    path = str(tmp_path / "m")
    record_metrics(metrics(spark, [(0, 0)]), "r1", path)
    record_metrics(metrics(spark, [(1, 1)]), "r2", path)
    record_metrics(metrics(spark, [(0, 1)]), "r1", path)
    got, n = stored(spark, path)
    assert n == 24
    assert got["r1", "a", "recall"] == 0.0
    assert got["r2", "b", "recall"] == 1.0
    assert got["r1", "a", "precision"] is None
    one = read_metrics(spark, path).filter("run_id = 'r1'")
    assert "PartitionFilters: [isnotnull(run_id" in plan(one)


def test_run_names_stay_strings(spark, tmp_path):
    path = str(tmp_path / "m")
    names = ["12345678901234567890123456789012", "1e5", "2026-01-01", "a/b=c d"]
    for name in names:
        record_metrics(metrics(spark, [(0, 0)]), name, path)
    got, _ = stored(spark, path)
    assert {k[0] for k in got} == set(names)


def test_a_run_needs_a_name(spark, tmp_path):
    with pytest.raises(ValueError):
        record_metrics(metrics(spark, [(0, 0)]), "", str(tmp_path / "m"))
