import pytest

from sortilex import CATEGORY_LIST, MAX_LENGTH, Settings


def make(**changes):
    given = dict(
        catalog_name="cat",
        schema_name="db",
        registered_model_name="model_ja",
        run_id="0a1b",
        endpoint_name="texts",
        storage_root="/shared",
    )
    return Settings(**{**given, **changes})


def test_fixed_values():
    assert MAX_LENGTH == 128
    assert len(CATEGORY_LIST) == 9
    assert CATEGORY_LIST[0] == "dokujo-tsushin" and CATEGORY_LIST[8] == "topic-news"
    assert list(CATEGORY_LIST) == sorted(CATEGORY_LIST)


def test_derived_names():
    s = make()
    assert s.volume_path == "/Volumes/cat/db/raw_files_vol"
    assert s.table_name_full_path == "cat.db.raw_documents"
    assert s.registered_model_full_path == "cat.db.model_ja"
    assert s.stg_serving_endpoint_name == "stg_texts"
    assert s.prod_serving_endpoint_name == "prod_texts"


def test_runs_and_endpoints_do_not_share_folders():
    first, second = make(run_id="r1"), make(run_id="r2")
    assert first.model_path != second.model_path
    assert first.examples_path != second.examples_path
    assert first.metrics_path == second.metrics_path
    staging, production = first.stg_serving_endpoint_name, first.prod_serving_endpoint_name
    assert first.scores_path(staging) != first.scores_path(production)
    assert first.checkpoint_path(staging) != first.checkpoint_path(production)


@pytest.mark.parametrize(
    "changes",
    [
        {"categories": ()},
        {"categories": ("a", "a")},
        {"categories": ("a", None)},
        {"max_length": 0},
        {"unit": "word"},
        {"split_threshold": "CD"},
        {"split_threshold": ""},
        {"run_id": ""},
    ],
)
def test_bad_settings_are_refused(changes):
    with pytest.raises(ValueError):
        make(**changes)
