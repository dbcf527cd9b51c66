"""Fit, save and load the text classifier."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer
from pyspark.ml.linalg import SparseMatrix
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import CATEGORY_LIST, UNITS, check_categories
from ..storage import remove_folder, run_folder

TEXT_COL = "truncated_text"
COUNTS_COL = "term_counts"
WORK_COLS = ("terms", COUNTS_COL, "features", "rawPrediction", "probability")

# Null text has no terms. Characters overlap in pairs, since single characters
# say little in unspaced text.
_TERMS_SQL = {
    "token": f"array_remove(split(coalesce({TEXT_COL}, ''), ' '), '')",
    "char": f"regexp_extract_all(coalesce({TEXT_COL}, ''), '(?s)(?=(..?)).', 1)",
}


@dataclass(frozen=True)
class ClassifierParams:
    """What the fit needs beside its rows.

    ``num_features`` times the class count, not the data, is what tasks send to
    the driver in each solver step; raise ``aggregation_depth`` to 3 on clusters
    with many thousand tasks. Keep ``num_features`` below the number of distinct
    terms: where most of the hash space is unused, Spark stores the coefficients
    as a sparse matrix and scoring walks all of it for every row (measured: ten
    times slower at 2^18 than at 2^16 features on 10,000 documents).

    ``max_iter`` bounds the solver's steps; a fit that reaches it says so.
    ``reg_param`` keeps the weights of separable classes finite.

    ``partitions`` is the most tasks a solver step may have. Each sends a
    gradient, so a few per core are right, where the scan of a large table has
    very many; neighbouring splits of the scan share a task, without a shuffle.
    None leaves the rows as the scan splits them.
    """

    unit: str = "token"
    num_features: int = 1 << 14
    min_doc_freq: int = 0
    max_iter: int = 100
    reg_param: float = 1e-4
    elastic_net: float = 0.0
    aggregation_depth: int = 2
    partitions: int | None = None

    def __post_init__(self) -> None:
        if self.unit not in UNITS:
            raise ValueError(f"unit must be one of {UNITS}, not {self.unit!r}")
        if self.partitions is not None and self.partitions < 1:
            raise ValueError("partitions must be at least 1")


def _with_domain(train: DataFrame, label_col: str, names: tuple[str, ...]) -> DataFrame:
    # Tells the solver the whole domain, so probabilities cover every class
    # even where training rows of one are missing, and no count pass is needed.
    about = {"ml_attr": {"name": label_col, "type": "nominal", "vals": list(names)}}
    return train.withColumn(label_col, F.col(label_col).cast("double").alias(label_col, metadata=about))


def _term_stages(params: ClassifierParams) -> tuple[SQLTransformer, HashingTF]:
    terms = SQLTransformer(statement=f"SELECT *, {_TERMS_SQL[params.unit]} AS terms FROM __THIS__")
    hashing = HashingTF(inputCol="terms", outputCol=COUNTS_COL, numFeatures=params.num_features)
    return terms, hashing


def count_terms(df: DataFrame, params: ClassifierParams = ClassifierParams()) -> DataFrame:
    """Add ``term_counts``, the hashed terms of ``truncated_text``; local to each row.

    Hashing costs more than any other step before the solver, whose fit takes three
    passes: store the result and fit from that.
    """
    terms, hashing = _term_stages(params)
    return hashing.transform(terms.transform(df)).drop("terms")


def fit_unsaved(
    train: DataFrame,
    params: ClassifierParams = ClassifierParams(),
    categories=CATEGORY_LIST,
    label_col: str = "label",
) -> PipelineModel:
    """Fit hashed term counts, IDF and logistic regression on ``truncated_text``.

    Rows without a label are not used. Rows that have ``term_counts`` (see
    ``count_terms``, with the same ``params``) are used as they are; of others the
    counts are written to a shared folder for the time of the fit, so that a lost
    executor repeats a scan and not the hashing. The model still holds its training
    summary; ``fit_classifier`` gives one that is fit for scoring.
    """
    names, work, spark = check_categories(categories), None, train.sparkSession
    labelled = train.filter(F.col(label_col).isNotNull())
    if COUNTS_COL not in train.columns:
        work = run_folder(spark, "term-counts")
        counted = count_terms(labelled.select(label_col, TEXT_COL), params)
        counted.select(label_col, COUNTS_COL).write.parquet(work)
        labelled = spark.read.parquet(work)
    if params.partitions is not None:
        labelled = labelled.coalesce(params.partitions)
    idf = IDF(inputCol=COUNTS_COL, outputCol="features", minDocFreq=params.min_doc_freq)
    solver = LogisticRegression(
        featuresCol="features",
        labelCol=label_col,
        family="multinomial" if len(names) > 2 else "auto",
        maxIter=params.max_iter,
        regParam=params.reg_param,
        elasticNetParam=params.elastic_net,
        aggregationDepth=params.aggregation_depth,
    )
    try:
        counts = _with_domain(labelled.select(label_col, COUNTS_COL), label_col, names)
        fitted = Pipeline(stages=[idf, solver]).fit(counts)
    finally:
        if work is not None:
            remove_folder(spark, work)
    model = PipelineModel([*_term_stages(params), *fitted.stages])
    if isinstance(model.stages[-1].coefficientMatrix, SparseMatrix):
        warnings.warn("most hashed features are unused: lower num_features to score faster")
    if fitted.stages[-1].summary.totalIterations >= params.max_iter:
        warnings.warn(f"the solver stopped at max_iter={params.max_iter} before it converged")
    return model


def fit_classifier(
    train: DataFrame,
    params: ClassifierParams = ClassifierParams(),
    categories=CATEGORY_LIST,
    label_col: str = "label",
    path: str | None = None,
) -> PipelineModel:
    """Fit as ``fit_unsaved`` does, save the model and load it.

    It is saved at ``path``, where it replaces an older one, or else in a new
    shared folder.
    """
    model = fit_unsaved(train, params, categories, label_col)
    path = path or run_folder(train.sparkSession, "model")
    model.write().overwrite().save(path)
    # A model fresh from the fit drags its training summary, and with it the
    # session, into every scoring task; the saved one is the model alone.
    return load_classifier(path)


def load_classifier(path: str) -> PipelineModel:
    """The model that ``fit_classifier`` saved at ``path``."""
    return PipelineModel.load(path)
