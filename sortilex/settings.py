"""Names and fixed values of one classification project."""

from __future__ import annotations

import re
from dataclasses import dataclass

# Results depend on them, so they are stated as they are.
CATEGORY_LIST = (
    "dokujo-tsushin",
    "it-life-hack",
    "kaden-channel",
    "livedoor-homme",
    "movie-enter",
    "peachy",
    "smax",
    "sports-watch",
    "topic-news",
)
MAX_LENGTH = 128
TABLE_NAME = "raw_documents"
VOLUME_NAME = "raw_files_vol"
STAGING_PREFIX = "stg_"
PRODUCTION_PREFIX = "prod_"

# Our own choice: md5 prefixes below this are train, 0xcd / 0x100 is about 80 %.
SPLIT_THRESHOLD = "cd"

UNITS = ("token", "char")


def check_categories(categories) -> tuple[str, ...]:
    """The categories as a tuple; a position is a class id, so all must differ."""
    names = tuple(categories)
    if not names:
        raise ValueError("the category domain is empty")
    if any(not isinstance(name, str) for name in names):
        raise ValueError("every category must be a string")
    if len(set(names)) != len(names):
        raise ValueError("the category domain holds a name twice")
    return names


def check_length(max_length: int, unit: str) -> None:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}, not {unit!r}")
    if max_length < 1:
        raise ValueError("max_length must be at least 1")


def check_threshold(threshold: str) -> None:
    if not re.fullmatch(r"[0-9a-f]{1,32}", threshold):
        raise ValueError("the threshold must be 1 to 32 lower-case hex digits")


@dataclass(frozen=True)
class Settings:
    """Where a project keeps its table, files, models, scores and metrics.

    The first five names differ between users and have no default. ``storage_root``
    is a folder that every executor can reach.
    """

    catalog_name: str
    schema_name: str
    registered_model_name: str
    run_id: str
    endpoint_name: str
    storage_root: str
    table_name: str = TABLE_NAME
    volume_name: str = VOLUME_NAME
    volume_root: str = "/Volumes"
    experiment_name: str = "experiment"
    model_artifact_path: str = "model"
    categories: tuple[str, ...] = CATEGORY_LIST
    max_length: int = MAX_LENGTH
    unit: str = "token"
    split_threshold: str = SPLIT_THRESHOLD

    def __post_init__(self) -> None:
        object.__setattr__(self, "categories", check_categories(self.categories))
        check_length(self.max_length, self.unit)
        check_threshold(self.split_threshold)
        if not self.run_id:
            raise ValueError("run_id is empty")

    @property
    def volume_path(self) -> str:
        """Folder of the text files."""
        return "/".join((self.volume_root, self.catalog_name, self.schema_name, self.volume_name))

    @property
    def table_name_full_path(self) -> str:
        """Three-level name of the document table."""
        return ".".join((self.catalog_name, self.schema_name, self.table_name))

    @property
    def registered_model_full_path(self) -> str:
        """Three-level name of the model."""
        return ".".join((self.catalog_name, self.schema_name, self.registered_model_name))

    @property
    def stg_serving_endpoint_name(self) -> str:
        """Name of the scoring query under trial."""
        return STAGING_PREFIX + self.endpoint_name

    @property
    def prod_serving_endpoint_name(self) -> str:
        """Name of the scoring query in use."""
        return PRODUCTION_PREFIX + self.endpoint_name

    @property
    def model_path(self) -> str:
        """Folder of the model that this run saved."""
        return "/".join(
            (
                self.storage_root,
                "models",
                self.registered_model_full_path,
                self.run_id,
                self.model_artifact_path,
            )
        )

    @property
    def versions_path(self) -> str:
        """Folder of the versions saved under the registered name, by all runs."""
        return "/".join((self.storage_root, "registered", self.registered_model_full_path))

    @property
    def documents_path(self) -> str:
        """Folder of the documents that came from the volume."""
        return "/".join((self.storage_root, "documents", self.table_name_full_path))

    @property
    def ingest_checkpoint_path(self) -> str:
        """Folder where the ingest of the volume keeps its progress."""
        return "/".join((self.storage_root, "checkpoints", self.volume_name))

    @property
    def examples_path(self) -> str:
        """Folder of this run's prepared examples."""
        return "/".join((self.storage_root, "examples", self.run_id))

    @property
    def metrics_path(self) -> str:
        """Folder that holds the results of every run of the experiment."""
        return "/".join((self.storage_root, "experiments", self.experiment_name))

    def scores_path(self, endpoint: str) -> str:
        """Folder that the scoring query named ``endpoint`` writes to."""
        return "/".join((self.storage_root, "scores", endpoint))

    def batch_scores_path(self, endpoint: str) -> str:
        """Folder of the scores of whole tables under the name ``endpoint``."""
        return "/".join((self.storage_root, "batch_scores", endpoint))

    def promoted_scores_path(self, endpoint: str) -> str:
        """Folder of the scores of the promoted versions, a folder per batch."""
        return "/".join((self.storage_root, "promoted_scores", endpoint))

    def checkpoint_path(self, endpoint: str) -> str:
        """Folder where the scoring query named ``endpoint`` keeps its progress."""
        return "/".join((self.storage_root, "checkpoints", endpoint))
