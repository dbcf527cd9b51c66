"""The files of a volume, found and read by tasks."""

import gzip
import os
import pathlib

import pytest

from sortilex.sources import DocumentStore, ingest_text_files, volume_files
from sortilex.streaming import ingest, ingest_volume


def put_files(folder, texts):
    for name, text in texts.items():
        path = pathlib.Path(folder) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(text if isinstance(text, bytes) else text.encode())


class Project:
    """A volume, a store and a checkpoint; ``run`` gives what is stored after a run."""

    def __init__(self, spark, tmp_path):
        self.spark, self.volume, self.checkpoint = spark, tmp_path / "volume", tmp_path / "checkpoint"
        self.volume.mkdir()
        self.store = DocumentStore(spark, str(tmp_path / "store"), buckets=2)

    def start(self, path_glob=None, **more):
        return ingest_volume(self.spark, str(self.volume), self.store, str(self.checkpoint), path_glob, **more)

    def run(self, path_glob=None, **more):
        self.start(path_glob, **more).awaitTermination()
        return self.stored()

    def stored(self):
        return sorted((r.category, r.text) for r in self.store.read().collect())

    def batches(self, monkeypatch):
        """The batches put from now on: the number of partitions and the texts of each."""
        seen, put = [], DocumentStore.put

        def spied(store, batch, batch_id=None):
            seen.append((batch.rdd.getNumPartitions(), sorted(r.text for r in batch.collect())))
            return put(store, batch, batch_id)

        monkeypatch.setattr(DocumentStore, "put", spied)
        return seen


@pytest.fixture
def project(spark, tmp_path):
    return Project(spark, tmp_path)


def use_sparks_source(patch):
    patch.setattr(ingest, "plain_path", lambda spark, path: None)


def test_many_small_files_share_a_task(project, monkeypatch):
    put_files(project.volume, {f"a/{i}.txt": f"t{i}" for i in range(600)})
    conf = project.spark.conf
    before = conf.get("spark.sql.files.maxPartitionBytes")
    seen = project.batches(monkeypatch)
    try:
        conf.set("spark.sql.files.maxPartitionBytes", "16m")
        assert len(project.run("*.txt")) == 600
    finally:
        conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [n for n, _ in seen] == [project.spark.sparkContext.defaultParallelism]


def test_the_driver_holds_no_list_of_files(project):
    for run in (1, 2):
        put_files(project.volume, {f"a/{run}-{i}.txt": "t" for i in range(50)})
        assert len(project.run("*.txt")) == 50 * run
    # Spark's own source keeps all paths here, and in the driver while it runs.
    assert not (project.checkpoint / "sources").exists()
    volume = volume_files.VolumeFiles(project.spark, str(project.volume), f"{project.checkpoint}/files")
    _, state = volume.commits.current()
    assert len(state["lists"]) == 2 and ".txt" not in str(state)


def test_a_run_that_was_cut_off_goes_on_with_the_files_it_had_found(project, monkeypatch):
    put_files(project.volume, {f"a/{i}.txt": f"t{i}" for i in range(4)})
    for i in range(4):
        os.utime(project.volume / f"a/{i}.txt", (1_000 - i, 1_000 - i))
    put = DocumentStore.put

    def fails(store, batch, batch_id=None):
        if batch_id.endswith(".1"):
            raise RuntimeError("cut off")
        return put(store, batch, batch_id)

    with monkeypatch.context() as patch:
        patch.setattr(DocumentStore, "put", fails)
        with pytest.raises(Exception, match="cut off"):
            project.run("*.txt", max_files_per_trigger=2)
    # The files that changed longest ago came first.
    assert project.stored() == [("a", "t2"), ("a", "t3")]
    put_files(project.volume, {"a/3.txt": "changed", "b/4.txt": "t4"})
    (project.volume / "a/1.txt").unlink()
    seen = project.batches(monkeypatch)
    assert project.run("*.txt", max_files_per_trigger=2) == [("a", "t0"), ("a", "t2"), ("a", "t3"), ("b", "t4")]
    assert [texts for _, texts in seen] == [["t0"], ["t4"]]


def test_a_batch_that_was_stored_but_not_listed_is_not_stored_again(project, monkeypatch):
    put_files(project.volume, {"a/1.txt": "one"})
    replace = volume_files.Commits.replace

    def killed(commits, after, content):
        if content.get("done"):
            raise RuntimeError("killed")
        return replace(commits, after, content)

    with monkeypatch.context() as patch:
        patch.setattr(volume_files.Commits, "replace", killed)
        with pytest.raises(Exception, match="killed"):
            project.run("*.txt")
    put_files(project.volume, {"a/1.txt": "changed"})
    assert project.run("*.txt") == [("a", "one")]


def test_max_files_bounds_a_batch(project, monkeypatch):
    put_files(project.volume, {f"{'abc'[i % 3]}/{i:02d}.txt": f"{i:02d}" for i in range(25)})
    for path in project.volume.rglob("*.txt"):
        os.utime(path, (1_000 + int(path.stem), 1_000 + int(path.stem)))
    seen = project.batches(monkeypatch)
    assert len(project.run("*.txt", max_files_per_trigger=10)) == 25
    assert [t for _, t in seen] == [[f"{i:02d}" for i in range(*r)] for r in ((0, 10), (10, 20), (20, 25))]


ODD = {
    "a/plain.txt": "one",
    "a/1 +ü%41.txt": "two",
    "a/[x]{y}*?.txt": "three",
    "a/.hidden.txt": "no",
    "a/_hidden.txt": "no",
    "a/_x=1.txt": "four",
    "a/half._COPYING_": "no",
    "a/empty.txt": "",
    "a/bad.txt": b"a\xff\xc3b",
    "_b/c.txt": "no",
    ".b/c.txt": "no",
    "_metadata/c.txt": "five",
    "_k=v/deep/deeper/c.txt": "six",
    "root.txt": "seven",
    "packed.gz": gzip.compress(b"eight"),
    "a/p[1] +.gz": gzip.compress("nüne".encode()),
    "a/b.csv": "ten",
}


@pytest.mark.parametrize("path_glob", [None, "*.txt", "*.{gz,csv}", "[a-p]*", "plain.txt", "*.md"])
def test_rows_are_those_of_sparks_source(project, monkeypatch, path_glob):
    put_files(project.volume, ODD)
    (project.volume / "none").mkdir()
    (project.volume / "link").symlink_to(project.volume / "a", target_is_directory=True)
    (project.volume / "broken.txt").symlink_to(project.volume / "nothing")
    seen = []

    def put(store, batch, batch_id=None):
        seen.append(sorted(map(tuple, batch.collect())))

    monkeypatch.setattr(DocumentStore, "put", put)
    project.start(path_glob).awaitTermination()
    with monkeypatch.context() as patch:
        use_sparks_source(patch)
        project.checkpoint = project.checkpoint.with_name("other")
        project.start(path_glob).awaitTermination()
    if path_glob == "*.md":
        assert not any(seen)
    else:
        assert len(seen) == 2 and seen[0] == seen[1] and seen[0]


def test_a_name_that_is_no_utf8(project):
    put_files(project.volume, {"a/1.txt": "one"})
    with open(os.fsencode(project.volume) + b"/a/\xff.txt", "wb") as file:
        file.write(b"two")
    assert project.run("*.txt") == [("a", "one"), ("a", "two")]


def test_a_pipe_and_a_link_to_itself_are_passed_over(project):
    put_files(project.volume, {"a/1.txt": "one"})
    os.mkfifo(project.volume / "a/pipe.txt")
    (project.volume / "self.txt").symlink_to(project.volume / "self.txt")
    assert project.run("*.txt") == [("a", "one")]


def test_files_taken_by_sparks_source_count_as_taken(project, monkeypatch):
    with monkeypatch.context() as patch:
        use_sparks_source(patch)
        for run in (1, 2):
            put_files(project.volume, {f"a/{run} +%ü.txt": "old"})
            project.run("*.txt")
    put_files(project.volume, {"a/1 +%ü.txt": "changed", "a/3.txt": "new"})
    assert project.run("*.txt") == [("a", "new"), ("a", "old"), ("a", "old")]
    assert project.run("*.txt") == [("a", "new"), ("a", "old"), ("a", "old")]


def test_lists_of_many_runs_become_one(project, monkeypatch):
    monkeypatch.setattr(volume_files, "MAX_LISTS", 2)
    for run in range(4):
        put_files(project.volume, {"a/0.txt": f"t{run}", f"a/{run}.txt": f"t{run}"})
        assert project.run("*.txt") == [("a", f"t{i}") for i in range(run + 1)]
    assert len(list((project.checkpoint / "files/data").iterdir())) == 2


def test_a_query_that_goes_on_takes_files_as_they_arrive(project):
    put_files(project.volume, {"a/0.txt": "t0"})
    query = project.start("*.txt", trigger={"processingTime": "100 milliseconds"})
    try:
        for i in (1, 2):
            query.processAllAvailable()
            assert project.stored() == [("a", f"t{k}") for k in range(i)]
            put_files(project.volume, {f"a/{i}.txt": f"t{i}"})
        assert query.isActive
    finally:
        query.stop()


def test_an_archive_keeps_whole_paths_and_lies_outside(project, tmp_path):
    put_files(project.volume, {"a/1.txt": "one", "b/1.txt": "two"})
    with pytest.raises(ValueError, match="outside"):
        project.start("*.txt", archive_path=str(project.volume / "done"))
    assert project.run("*.txt", archive_path=str(tmp_path / "archive")) == [("a", "one"), ("b", "two")]
    assert not list(project.volume.rglob("*.txt"))
    moved = {p.relative_to(f"{tmp_path}/archive{project.volume}").as_posix() for p in tmp_path.glob("archive/**/*.txt")}
    assert moved == {"a/1.txt", "b/1.txt"}


def test_ids_are_those_of_the_batch_reader(project):
    put_files(project.volume, {"a/1 +ü%41.txt": "one", "b.txt": "two"})
    project.run("*.txt")
    files = ingest_text_files(project.spark, str(project.volume), "*.txt")
    ids = {r.doc_id for r in ingest.as_documents(files, str(project.volume)).collect()}
    assert ids == {r.doc_id for r in project.store.read().collect()}
