"""Many small files: how they are made and read."""

import gzip
import pathlib

import pytest

import __spark_entry__ as driver
from sortilex.sources import ingest_text_files


def rows(spark, folder, path_glob="*.txt"):
    got = ingest_text_files(spark, str(folder), path_glob).select("folder", "content")
    return sorted(map(tuple, got.collect()))


def test_raw_files_are_those_of_sparks_writer(spark, tmp_path):
    names = ["a", "a", None, "", "x/y%z", "tab\t=?'\"#*:\\[]{}^\x7f\x01", "ü +&", ".", "a b"]
    docs = spark.createDataFrame([("text ü\n" * i if i else None, n) for i, n in enumerate(names)], "text string, source string")
    mine, sparks = tmp_path / "mine", tmp_path / "sparks"
    for _ in range(2):
        driver.write_raw_files(docs, f"file://{mine}")
        docs.write.mode("append").option("maxRecordsPerFile", 1).partitionBy("source").text(str(sparks))
    assert {p.name for p in mine.iterdir()} == {p.name for p in sparks.iterdir() if p.is_dir()}
    got = rows(spark, mine)
    assert got == rows(spark, sparks) and len(got) == 2 * len(names)
    # Hadoop's local file system would add a checksum file to each, and start a process for both.
    assert not list(mine.rglob("*.crc"))


@pytest.mark.parametrize("path_glob", [None, "*", "*.txt", "*.{txt,gz}", "*.gz"])
def test_files_are_unpacked_where_a_glob_allows_packed_ones(spark, plan, tmp_path, path_glob):
    wanted = {"a.txt": "eins\nzwei", "b.gz": "packed", "e.txt": ""}
    (tmp_path / "a.txt").write_bytes(b"eins\nzwei")
    (tmp_path / "b.gz").write_bytes(gzip.compress(b"packed"))
    (tmp_path / "e.txt").write_bytes(b"")
    got = ingest_text_files(spark, str(tmp_path), path_glob)
    ends = {"*.txt": ".txt", "*.gz": ".gz"}.get(path_glob, "")
    found = {pathlib.Path(r.path).name: r.content for r in got.collect()}
    # A file of zero bytes gives no row.
    assert found == {n: t for n, t in wanted.items() if t and n.endswith(ends)}
    assert ("binaryFile" in plan(got)) == (path_glob == "*.txt")


def test_bytes_that_are_no_utf8(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"a\xff\xc3b")
    assert rows(spark, tmp_path) == rows(spark, tmp_path, "*") == [(tmp_path.name, "a��b")]
