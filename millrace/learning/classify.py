"""Classifiers. Training runs on Spark ML; models are saved to and loaded from any file system."""

from __future__ import annotations

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.learning.rules import nodes


def logistic(max_iter: int = 10, reg: float = 0.01) -> LogisticRegression:
    return LogisticRegression(maxIter=max_iter, regParam=reg)


def decision_tree(label: str = "label", features: str = "features") -> DecisionTreeClassifier:
    return DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=42)


def random_forest(trees: int = 100, depth: int = 5, seed: int = 42) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)


def labelled_pipeline(label: str, columns: list[str], classifier) -> Pipeline:
    """Index the text label, assemble the features, classify."""
    stages = [
        StringIndexer(inputCol=label, outputCol="label"),
        VectorAssembler(inputCols=columns, outputCol="features"),
        classifier,
    ]
    return Pipeline(stages=stages)


def score(model: Model | PipelineModel, df: DataFrame, *keep: str) -> DataFrame:
    """Prediction and class probabilities of each row, probabilities as an array."""
    return model.transform(df).select(
        *keep, "prediction", vector_to_array(F.col("probability")).alias("probability")
    )


def training_history(model) -> DataFrame:
    """Objective of a fitted logistic model before the first and after each iteration, a row each."""
    history = [(i, float(value)) for i, value in enumerate(model.summary.objectiveHistory)]
    return SparkSession.active().createDataFrame(history, "iteration int, objective double")


def rules(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Nodes of a saved tree or forest as rows: ``tree``, ``node``, ``feature`` and ``threshold`` of
    its test (NULL in a leaf), ``left`` (value at most the threshold), ``right``, ``prediction``."""
    saved = nodes(spark, path, columns)
    return saved.select("tree", "node", "feature", "threshold", "left", "right", "prediction")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)
