"""Stored documents and the lists of attempts that count."""

import pathlib
import time

import pytest
from pyspark.sql import functions as F

from sortilex.operators import class_metrics, long_metrics
from sortilex.sources import Commits, ConflictError, DocumentStore, read_metrics, record_metrics
from sortilex.sources import document_store


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def content(store):
    return sorted((r.doc_id, r.text) for r in store.read().collect())


def files(path):
    return {str(f) for f in pathlib.Path(path).rglob("*.parquet")}


def listed(store):
    """The files that the store's list names now."""
    _, state = store.commits.current()
    return {
        f
        for bucket, names in state["pieces"].items()
        for n in names
        for f in files(f"{store.commits.attempt_path(n)}/bucket={bucket}")
    }


def test_a_batch_stored_twice_leaves_one_row_per_id(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"), buckets=8)
    batch = docs(spark, [(i, f"t{i}") for i in range(100)])
    assert store.put(batch) == 0
    once = content(store)
    assert store.put(batch) == 8
    assert content(store) == once == [(i, f"t{i}") for i in range(100)]


def test_new_ids_rewrite_nothing_and_old_ids_only_their_bucket(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"), buckets=16)
    store.put(docs(spark, [(i, "old") for i in range(200)]))
    before = listed(store)
    assert store.put(docs(spark, [(i, "more") for i in range(200, 260)])) == 0
    assert before < listed(store)
    before = listed(store)
    assert store.put(docs(spark, [(7, "new"), (7, "new"), (1_000, "x")])) == 1
    gone = before - listed(store)
    assert gone and len({f.split("bucket=")[1].split("/")[0] for f in gone}) == 1
    got = dict(content(store))
    assert len(got) == 261 and got[7] == "new" and got[8] == "old" and got[200] == "more"


def test_a_killed_put_changes_nothing(spark, tmp_path, monkeypatch):
    store = DocumentStore(spark, str(tmp_path / "s"), buckets=4)
    store.put(docs(spark, [(1, "a"), (2, "b")]))
    before = content(store)

    def killed(self, after, content):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Commits, "replace", killed)
        with pytest.raises(KeyboardInterrupt):
            store.put(docs(spark, [(1, "z"), (3, "c")]))
    assert content(store) == before
    store.put(docs(spark, [(1, "z"), (3, "c")]))
    assert content(store) == [(1, "z"), (2, "b"), (3, "c")]
    assert store.remove_unlisted() >= 1
    assert content(store) == [(1, "z"), (2, "b"), (3, "c")]


def test_a_replayed_batch_is_not_stored_again(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"), buckets=4)
    store.put(docs(spark, [(1, "a")]), batch_id="0")
    before = listed(store)
    store.put(docs(spark, [(1, "a")]), batch_id="0")
    assert listed(store) == before


def test_pieces_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(document_store, "MAX_PIECES", 3)
    store = DocumentStore(spark, str(tmp_path / "s"), buckets=1)
    for i in range(6):
        store.put(docs(spark, [(i, "t")]))
        _, state = store.commits.current()
        assert len(state["pieces"]["0"]) <= 3
    assert content(store) == [(i, "t") for i in range(6)]


def test_odd_batches(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"), buckets=4)
    with pytest.raises(ValueError, match="nothing is stored"):
        store.read()
    store.put(docs(spark, []))
    assert content(store) == []
    store.put(docs(spark, [(1, None), (1, "b"), (1, "a")]))
    assert content(store) == [(1, "b")]
    with pytest.raises(Exception, match="without doc_id"):
        store.put(docs(spark, [(None, "x")]))
    with pytest.raises(ValueError, match="the batch"):
        store.put(spark.range(1).select(F.col("id").alias("doc_id")))
    with pytest.raises(ValueError, match="4 buckets"):
        DocumentStore(spark, str(tmp_path / "s"), buckets=5).put(docs(spark, [(1, "a")]))
    assert content(store) == [(1, "b")]


def test_two_writers_of_one_list(spark, tmp_path):
    commits = Commits(spark, str(tmp_path / "c"))
    number, state = commits.current()
    assert (number, state) == (0, {})
    commits.replace(number, {"a": 1})
    with pytest.raises(ConflictError):
        commits.replace(number, {"a": 2})
    assert commits.current() == (1, {"a": 1})
    for n in range(1, 30):
        commits.replace(n, {"a": n})
    assert commits.current() == (30, {"a": 29}) and len(commits._numbers()) == 20


def test_a_killed_recording_leaves_the_old_run(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "m")

    def metrics(pairs):
        scored = spark.createDataFrame(pairs, "label int, prediction int")
        return long_metrics(class_metrics(scored, ("a", "b")))

    record_metrics(metrics([(0, 0)]), "r1", path)
    before = sorted(map(repr, read_metrics(spark, path).collect()))

    def killed(self, after, content):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Commits, "replace", killed)
        with pytest.raises(KeyboardInterrupt):
            record_metrics(metrics([(1, 1)]), "r1", path)
    assert sorted(map(repr, read_metrics(spark, path).collect())) == before


def test_stored_rows_move_and_are_written_once(spark, tmp_path):
    """A put shuffles and writes a whole text once, the replacing one the batch's and the kept ones."""
    store = DocumentStore(spark, str(tmp_path / "s"), buckets=4)
    work = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before, texts = files(work), [(i, f"{i} " * 500) for i in range(400)]
    store.put(docs(spark, texts))
    assert store.put(docs(spark, [(i, "new " * 500) for i in range(0, 400, 4)] + [(7, None), (7, "b")])) == 4
    got = dict(content(store))
    assert len(got) == 400 and got[7] == "b"
    assert all(got[i] == ("new " * 500 if i % 4 == 0 else t) for i, t in texts if i != 7)
    # No second copy of a batch lies in the work folder.
    rows = [spark.read.parquet(f).count() for f in files(work) - before]
    assert sum(rows) == 0


def test_a_put_leaves_no_shuffled_rows_on_disk(spark, tmp_path):
    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()

    def shuffled():
        return {f for d in dirs for f in pathlib.Path(d).rglob("shuffle_*.data")}

    store, before = DocumentStore(spark, str(tmp_path / "s"), buckets=2), shuffled()
    for _ in range(2):
        # Rows that do not compress; the second put rewrites those of the first.
        store.put(spark.range(20_000).select(F.col("id").alias("doc_id"), F.sha2(F.col("id").cast("string"), 512).alias("text")))
        deadline = time.monotonic() + 10
        while (left := sum(f.stat().st_size for f in shuffled() - before)) > 500_000 and time.monotonic() < deadline:
            time.sleep(0.1)
        assert left <= 500_000
    assert store.read().count() == 20_000
