"""Predictions joined with known labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import join_spreading_heavy


def mispredictions(
    predictions: DataFrame, truth: DataFrame, key: str = "id", spread: bool = False
) -> DataFrame:
    """Rows where both sides know a class and the classes differ.

    Only the key and the label of the truth take part, so the exchange stays narrow. ``spread`` looks for heavy keys first
    and joins them in many tasks, for tables whose keys are no identities.
    """
    labels = truth.select(key, "label").where(F.col("label").isNotNull())
    joined = join_spreading_heavy(predictions, labels, key) if spread else predictions.join(labels, key, "inner")
    return joined.where(F.col("prediction") != F.col("label"))


def false_positive_count(predictions: DataFrame, truth: DataFrame, key: str = "id") -> DataFrame:
    flagged = predictions.where(F.col("prediction") == 1).select(key, "prediction")
    wrong = mispredictions(flagged, truth, key)
    return wrong.agg(F.count(key).alias("false_positive_count"))


def rows_with_label(features: DataFrame, labels: DataFrame, value: int = 1, key: str = "id") -> DataFrame:
    """Feature rows whose label, kept in another frame, has the given value."""
    return features.join(labels.where(F.col("label") == value).select(key), key, "left_semi")
