import pytest

from sortilex.storage import run_folder, shared_folder


class Session:
    """Just the settings of a session."""

    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_the_folder_the_cluster_names_is_used():
    session = Session(**{"spark.master": "spark://host:7077", "spark.checkpoint.dir": "hdfs://x/y/"})
    assert shared_folder(session, "a", "b") == "hdfs://x/y/a/b"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError):
        shared_folder(Session(**{"spark.master": "yarn"}), "a")


def test_run_folders_differ(spark):
    assert run_folder(spark, "a") != run_folder(spark, "a")
    assert run_folder(spark, "a").startswith(spark.conf.get("spark.checkpoint.dir"))
