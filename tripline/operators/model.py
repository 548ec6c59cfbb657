"""Trip-duration model on Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.operators.requests import valid_requests
from tripline.sources.files import literal_rows, written_by
from tripline.sources.schemas import FEATURES, IMPORTANCES, LABEL
from tripline.sources.session import settle

# Size of the forest.
TREES = 20
DEPTH = 10


# Rows of a training partition; set it higher for tables beyond some 10**9 rows.
ROWS_PER_PARTITION = 10_000


def training_table(train: DataFrame, key: str, rows: int = ROWS_PER_PARTITION,
                   folder: str | None = None) -> DataFrame:
    """The training rows in even, sorted partitions, written to shared storage.

    A fit reads its rows a dozen times, and bagging draws per partition. The
    number of rows sets the number of partitions, and the key the place of a
    row, so a forest is the same on any cluster and for any layout of the
    input. ``key`` must identify a row.
    """
    count = max(1, -(-train.count() // rows))
    placed = (train.select(key, *FEATURES, LABEL).repartition(count, key)
              .sortWithinPartitions(key))
    return settle(placed, "train", folder)


def fit(train: DataFrame, trees: int = TREES, depth: int = DEPTH, seed: int = 42,
        memory_mb: int = 256) -> PipelineModel:
    """Random forest over the five numeric features.

    A seed alone does not fix the forest, as bagging draws per partition: fit on
    a ``training_table``. ``memory_mb`` bounds the node statistics per pass; 256 holds one level of 20
    trees of depth 10, deeper forests want more.
    """
    forest = RandomForestRegressor(
        featuresCol="features", labelCol=LABEL, numTrees=trees, maxDepth=depth,
        seed=seed, maxMemoryInMB=memory_mb)
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    return Pipeline(stages=[assembler, forest]).fit(train.select(*FEATURES, LABEL))


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(spark: SparkSession, path: str) -> PipelineModel:
    with written_by("the training job", path):
        spark.read.text(f"{path}/metadata")
    return PipelineModel.load(path)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Add ``prediction``. Features must be complete: the assembler fails on nulls."""
    return model.transform(rows).drop("features")


def score_requests(model: PipelineModel, requests: DataFrame, key: str) -> DataFrame:
    """Predictions for the valid ones among text requests, batch or stream."""
    return predict(model, valid_requests(requests, key))


def feature_importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """One row per feature, from the fitted forest."""
    scores = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(score)) for name, score in zip(FEATURES, scores, strict=True)]
    return literal_rows(spark, rows, IMPORTANCES).orderBy(F.desc("importance"), "feature")
