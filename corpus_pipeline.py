"""A corpus pipeline of five stages over ``documents``.

Each stage is a function ``(spark, docs, sf_dir) -> DataFrame``; its result is
written as Parquet and read again as the next one's ``docs``. All but the last
return the columns of ``docs``, whatever further ones there are. An empty table
gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sortilex.llm.decontaminate import drop_contaminated
from sortilex.llm.mixing import mix_sources
from sortilex.llm.near_dedup import drop_near_duplicates
from sortilex.llm.pii import pseudonymise
from sortilex.llm.queries import pii_key
from sortilex.llm.store import small_arrow_batches, stored
from sortilex.llm.toxicity import drop_toxic, fit_toxicity


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, fitted on the labels, do not reject.

    A null or empty text is kept. Rows that repeat stay or go together.
    """
    small_arrow_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return drop_toxic(docs, fit_toxicity(docs, labels))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the least id.

    Texts without words and rows without an id are kept. Of rows that repeat an id
    one stays, that of the least text.
    """
    small_arrow_batches(spark)
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts are kept; items without words match nothing. Rows that
    repeat stay or go together.
    """
    small_arrow_batches(spark)
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in place of personal values.

    A null text stays null and an empty one empty; equal texts stay equal. The key is
    the session's ``spark.sortilex.pii.secret``, or else one for tests.
    """
    return pseudonymise(docs, pii_key(spark)).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them; ``copy`` counts repeats from 0.

    A null source is a source of its own. Texts without words have no size and are
    taken as their source's rate says; a source without words is not taken.
    """
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("mixing", mixing),
]

# Fitted models and similarity joins have no SQL; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that the stages make of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
