"""How the files of a volume are listed."""

import pathlib

from sortilex import Settings
from sortilex.plans import ingest, ingest_documents

LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def test_ingest_lists_files_in_few_tasks(spark, tmp_path, monkeypatch):
    settings = Settings(
        "c", "s", "model", "run1", "web", str(tmp_path / "root"), volume_root=str(tmp_path / "volumes")
    )
    folder = pathlib.Path(settings.volume_path) / "de"
    folder.mkdir(parents=True)
    for i in range(40):
        (folder / f"{i}.txt").write_text(f"t{i}")
    seen, start = [], ingest.ingest_volume

    def spied(*args):
        seen.append(int(spark.conf.get(LISTING)))
        return start(*args)

    monkeypatch.setattr(ingest, "ingest_volume", spied)
    before = spark.conf.get(LISTING)
    assert ingest_documents(spark, settings, "*.txt", buckets=2).count() == 40
    assert seen == [4 * spark.sparkContext.defaultParallelism] and spark.conf.get(LISTING) == before


def test_folders_of_a_volume_are_not_listed_one_after_the_other(spark, tmp_path, monkeypatch):
    threshold = "spark.sql.sources.parallelPartitionDiscovery.threshold"
    settings = Settings(
        "c", "s", "model", "run1", "web", str(tmp_path / "root"), volume_root=str(tmp_path / "volumes")
    )
    seen, start = [], ingest.ingest_volume

    def spied(*args):
        seen.append(spark.conf.get(threshold))
        return start(*args)

    monkeypatch.setattr(ingest, "ingest_volume", spied)
    before = spark.conf.get(threshold)
    for run in (1, 2):
        for name in ("de", "en", "fr"):
            folder = pathlib.Path(settings.volume_path) / name
            folder.mkdir(parents=True, exist_ok=True)
            (folder / f"{run}.txt").write_text(f"{name} {run}")
        got = ingest_documents(spark, settings, "*.txt", buckets=2)
        wanted = {(name, f"{name} {r}") for name in ("de", "en", "fr") for r in range(1, run + 1)}
        assert {(r.category, r.text) for r in got.collect()} == wanted and got.count() == len(wanted)
    assert seen == ["1", "1"] and spark.conf.get(threshold) == before
