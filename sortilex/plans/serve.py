"""Score a table, or arriving documents, with a trained model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import load_classifier, score_batch, truncate_documents
from ..settings import Settings
from ..streaming import score_promoted_stream, score_stream
from .registry import ModelVersions


def _cut(df: DataFrame, settings: Settings, text_col: str) -> DataFrame:
    cut = truncate_documents(df, settings.max_length, settings.unit, text_col)
    return cut.drop(text_col, "n_units")


def score_table(
    documents: DataFrame, model: PipelineModel, settings: Settings, text_col: str = "text"
) -> DataFrame:
    """Every document with its scores; no shuffle, whole texts are not carried on."""
    return score_batch(_cut(documents, settings, text_col), model, settings.categories)


def load_registered(
    settings: Settings, version: int | None = None, spark: SparkSession | None = None
) -> PipelineModel:
    """A model under the registered name: a ``version``, or that of the run of ``settings``."""
    if version is None:
        return load_classifier(settings.model_path)
    return ModelVersions(spark or SparkSession.active(), settings).load(version)


def score_to_endpoint(
    documents: DataFrame,
    model: PipelineModel,
    settings: Settings,
    endpoint: str,
    text_col: str = "text",
) -> DataFrame:
    """Score a whole table under the name ``endpoint``, store the rows and read them back.

    A later call replaces the rows. They lie apart from what ``serve`` writes
    under the same name, whose folder keeps track of its own files.
    """
    path = settings.batch_scores_path(endpoint)
    score_table(documents, model, settings, text_col).write.mode("overwrite").parquet(path)
    return documents.sparkSession.read.parquet(path)


def serve(
    arriving: DataFrame,
    model: PipelineModel,
    settings: Settings,
    endpoint: str,
    text_col: str = "text",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score arriving documents under the name ``endpoint``.

    Use one of the two endpoint names of ``settings``. Each has its own output
    and progress, so a model can run under trial beside the one in use.
    """
    return score_stream(
        _cut(arriving, settings, text_col),
        model,
        settings.scores_path(endpoint),
        settings.checkpoint_path(endpoint),
        settings.categories,
        name=endpoint,
        trigger=trigger,
    )


def serve_promoted(
    arriving: DataFrame,
    settings: Settings,
    endpoint: str,
    text_col: str = "text",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Score arriving documents with the version that is promoted to ``endpoint``.

    ``ModelVersions.promote`` takes effect with the next batch, without a restart.
    Read the scores with ``read_promoted``.
    """
    versions = ModelVersions(arriving.sparkSession, settings)

    def scorer(version: int):
        model = versions.load(version)
        return lambda batch: score_batch(batch, model, settings.categories)

    return score_promoted_stream(
        _cut(arriving, settings, text_col),
        lambda: versions.promoted(endpoint),
        scorer,
        settings.promoted_scores_path(endpoint),
        settings.checkpoint_path(f"promoted-{endpoint}"),
        name=endpoint,
        trigger=trigger,
    )


def read_promoted(spark: SparkSession, settings: Settings, endpoint: str) -> DataFrame:
    """The scores that ``serve_promoted`` wrote, with ``model_version`` and ``batch``."""
    return spark.read.parquet(settings.promoted_scores_path(endpoint))
