"""Files to documents, versions of a model, and a stream whose model changes."""

import pathlib
import shutil

import pytest

from sortilex import Settings
from sortilex.operators import ClassifierParams, encode_category, fit_classifier, score_batch, truncate_documents
from sortilex.plans import (
    ModelVersions,
    ingest_documents,
    load_registered,
    read_promoted,
    serve_promoted,
    train,
)
from sortilex.sources import as_documents, ingest_text_files
from sortilex.sources.commits import Commits
from sortilex.streaming import stream_documents

LANGS = ("de", "en", "es", "fr")


def project(tmp_path, categories=LANGS, **more):
    return Settings(
        "c", "s", "model", "run1", "web", str(tmp_path / "root"),
        volume_root=str(tmp_path / "volumes"), categories=categories, **more,
    )


def put_file(settings, name, text):
    path = pathlib.Path(settings.volume_path) / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_a_second_run_takes_only_new_files(spark, tmp_path):
    settings = project(tmp_path)
    put_file(settings, "de/1 +ü.txt", "eins\nzwei")
    put_file(settings, "en/deep/2.txt", "two")
    put_file(settings, "en/skip.csv", "no")
    first = ingest_documents(spark, settings, "*.txt", buckets=4)
    assert sorted((r.category, r.text) for r in first.collect()) == [("de", "eins\nzwei"), ("deep", "two")]
    # A file taken before is not read anew, also if it has changed since.
    put_file(settings, "en/deep/2.txt", "changed")
    put_file(settings, "fr/3.txt", "trois")
    second = ingest_documents(spark, settings, "*.txt", buckets=4)
    texts = sorted(r.text for r in second.collect())
    assert texts == ["eins\nzwei", "trois", "two"]
    assert sorted(r.text for r in ingest_documents(spark, settings, "*.txt", buckets=4).collect()) == texts


def test_ids_follow_the_path_below_the_volume(spark, tmp_path):
    settings = project(tmp_path)
    put_file(settings, "de/1.txt", "eins")
    copy = tmp_path / "copy" / "of" / "it"
    shutil.copytree(settings.volume_path, copy)
    ids = {
        as_documents(ingest_text_files(spark, str(p)), str(p)).first().doc_id
        for p in (settings.volume_path, copy, f"file://{copy}/")
    }
    assert len(ids) == 1


def test_archived_files_leave_the_volume(spark, tmp_path):
    settings = project(tmp_path)
    archive = str(tmp_path / "archive")
    for i in range(3):
        put_file(settings, f"de/{i}.txt", f"t{i}")
    for i in range(3, 5):
        got = ingest_documents(spark, settings, archive_path=archive, max_files_per_trigger=1, buckets=2)
        assert got.count() == i
        put_file(settings, f"de/{i}.txt", f"t{i}")
    left = {p.name for p in pathlib.Path(settings.volume_path).rglob("*.txt")}
    gone = {p.name for p in pathlib.Path(archive).rglob("*.txt")}
    assert gone and not left & gone


def test_from_files_to_a_trained_model(spark, tmp_path):
    settings = project(tmp_path, ("a", "b"))
    for i in range(40):
        put_file(settings, f"{'ab'[i % 2]}/{i}.txt", ("red apple " if i % 2 else "blue sky ") + f"w{i}")
    documents = ingest_documents(spark, settings, buckets=4)
    _, stored = train(documents, "category", settings, ClassifierParams(num_features=64, max_iter=5))
    counts = {r.metric: r.value for r in stored.filter("category is null").collect()}
    assert counts["documents"] == 40 == counts["train"] + counts["test"]


@pytest.fixture(scope="module")
def cut(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    return docs


def fitted(cut, n):
    examples = encode_category(truncate_documents(cut), "lang", LANGS)
    return fit_classifier(examples, ClassifierParams(num_features=1 << n, max_iter=4), LANGS)


def test_versions(spark, cut, tmp_path, monkeypatch):
    settings = project(tmp_path)
    versions = ModelVersions(spark, settings)
    assert versions.versions() == []
    with pytest.raises(LookupError):
        versions.load()
    with pytest.raises(LookupError):
        versions.promoted("stg_web")
    models = [fitted(cut, n) for n in (6, 7)]
    assert [versions.register(m) for m in models] == [1, 2]
    assert [v["version"] for v in versions.versions()] == [1, 2]
    features = lambda m: m.stages[-1].numFeatures
    assert features(versions.load()) == 128 and features(versions.load(1)) == 64
    assert features(load_registered(settings, 1)) == 64
    with pytest.raises(ValueError):
        versions.promote("stg_web", 3)
    versions.promote("stg_web", 2)
    versions.promote("prod_web", 1)
    assert (versions.promoted("stg_web"), versions.promoted("prod_web")) == (2, 1)

    def killed(self, after, content):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Commits, "replace", killed)
        with pytest.raises(KeyboardInterrupt):
            versions.register(models[0])
    assert len(versions.versions()) == 2 and features(versions.load()) == 128


def test_a_running_stream_takes_the_promoted_version(spark, cut, tmp_path):
    settings = project(tmp_path)
    versions, endpoint = ModelVersions(spark, settings), settings.prod_serving_endpoint_name
    models = [fitted(cut, n) for n in (6, 9)]
    for m in models:
        versions.register(m)
    versions.promote(endpoint, 1)
    halves = [cut.filter(f"doc_id % 2 = {i}") for i in (0, 1)]
    arriving = str(tmp_path / "in")
    halves[0].coalesce(1).write.parquet(arriving)
    stream = stream_documents(spark, arriving, cut.schema)
    query = serve_promoted(stream, settings, endpoint, trigger={"processingTime": "200 milliseconds"})
    try:
        query.processAllAvailable()
        versions.promote(endpoint, 2)
        halves[1].coalesce(1).write.mode("append").parquet(arriving)
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    got = read_promoted(spark, settings, endpoint)
    for half, model, version in zip(halves, models, (1, 2), strict=True):
        want = score_batch(truncate_documents(half).select("doc_id", "lang", "truncated_text"), model, LANGS)
        own = got.filter(f"model_version = {version}").select(want.columns)
        assert sorted(map(repr, own.collect())) == sorted(map(repr, want.collect()))
    assert got.count() == cut.count()


def test_a_replayed_batch_writes_nothing_twice(spark, cut, tmp_path):
    settings = project(tmp_path)
    versions, endpoint = ModelVersions(spark, settings), "stg_web"
    versions.register(fitted(cut, 6))
    versions.register(fitted(cut, 9))
    versions.promote(endpoint, 1)
    arriving = str(tmp_path / "in")
    cut.write.parquet(arriving)

    def run():
        stream = stream_documents(spark, arriving, cut.schema)
        serve_promoted(stream, settings, endpoint).awaitTermination()
        return sorted(map(repr, read_promoted(spark, settings, endpoint).collect()))

    first = run()
    # Forget that the batch was finished, as if the driver had died before it said so.
    commits = pathlib.Path(settings.checkpoint_path(f"promoted-{endpoint}")) / "commits"
    for f in list(commits.iterdir()):
        f.unlink()
    versions.promote(endpoint, 2)
    assert run() == first and len(first) == cut.count()
