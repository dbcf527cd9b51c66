"""Versions of the model under its registered name, and which one an endpoint uses."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from ..operators import load_classifier
from ..settings import Settings
from ..sources.commits import Commits


class ModelVersions:
    """The saved versions of ``settings.registered_model_full_path``.

    Versions count from 1 and are never overwritten. A version is listed after it is
    saved whole, and an endpoint's pointer is part of the list, so both change by one
    rename (see ``Commits``): a save that dies is never seen, and whoever reads the
    list finds a model behind every entry. The folder is a plain one; there is no
    service.
    """

    def __init__(self, spark: SparkSession, settings: Settings) -> None:
        self.settings = settings
        self._commits = Commits(spark, settings.versions_path)

    def _state(self) -> tuple[int, dict]:
        number, state = self._commits.current()
        return number, state or {"versions": [], "endpoints": {}}

    def register(self, model: PipelineModel) -> int:
        """Save the model as the next version; returns its number."""
        path = f"{self.settings.versions_path}/models/{uuid.uuid4().hex}"
        model.write().save(path)
        number, state = self._state()
        entry = {"run_id": self.settings.run_id, "path": path}
        self._commits.replace(number, {**state, "versions": [*state["versions"], entry]})
        return len(state["versions"]) + 1

    def versions(self) -> list[dict]:
        """The entries ``version``, ``run_id`` and ``path``, oldest first."""
        return [{"version": i, **v} for i, v in enumerate(self._state()[1]["versions"], 1)]

    def promote(self, endpoint: str, version: int) -> None:
        """From now on the endpoint uses this version."""
        number, state = self._state()
        if not 1 <= version <= len(state["versions"]):
            raise ValueError(f"there is no version {version}, only 1 to {len(state['versions'])}")
        self._commits.replace(number, {**state, "endpoints": {**state["endpoints"], endpoint: version}})

    def promoted(self, endpoint: str) -> int:
        """The version that the endpoint uses."""
        endpoints = self._state()[1]["endpoints"]
        if endpoint not in endpoints:
            raise LookupError(f"no version was promoted to {endpoint!r}")
        return endpoints[endpoint]

    def load(self, version: int | None = None) -> PipelineModel:
        """A version's model, the latest one's by default."""
        versions = self._state()[1]["versions"]
        version = len(versions) if version is None else version
        if not 1 <= version <= len(versions):
            raise LookupError(f"there is no version {version} of {self.settings.registered_model_full_path}")
        return load_classifier(versions[version - 1]["path"])
