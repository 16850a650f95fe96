"""Saving and loading fitted feature pipelines and classifiers."""

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    LinearSVCModel, LogisticRegressionModel, NaiveBayesModel, RandomForestClassificationModel)
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

LOADERS = {
    "org.apache.spark.ml.classification.LinearSVCModel": LinearSVCModel,
    "org.apache.spark.ml.classification.LogisticRegressionModel": LogisticRegressionModel,
    "org.apache.spark.ml.classification.NaiveBayesModel": NaiveBayesModel,
    "org.apache.spark.ml.classification.RandomForestClassificationModel":
        RandomForestClassificationModel,
}


def save_fitted(fitted, path: str) -> str:
    """Save a feature pipeline or a classifier, replacing what is at the path."""
    fitted.write().overwrite().save(path)
    return path


def save_classifier(model, folder: str, name: str) -> str:
    return save_fitted(model, f"{folder}/clf_{name}")


def load_features(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_classifier(spark: SparkSession, path: str):
    """Load a classifier by the class its metadata names; ValueError for others."""
    described = F.get_json_object("value", "$.class")
    saved_as = spark.read.text(f"{path}/metadata").select(described).first()
    loader = LOADERS.get(saved_as[0]) if saved_as else None
    if loader is None:
        raise ValueError(f"no known classifier saved at {path}")
    return loader.load(path)
