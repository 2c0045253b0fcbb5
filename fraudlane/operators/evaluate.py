"""Confusion matrix, rates and class counts, each in a single aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import CELLS, cell_counts, rates_sql


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """All four cells, also the empty ones."""
    cells = ", ".join(f"{y}, {p}, {name}" for name, (y, p) in CELLS.items())
    counted = df.agg(*cell_counts(label, prediction))
    return counted.selectExpr(f"stack({len(CELLS)}, {cells}) AS (label, prediction, n_rows)")


def evaluation(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    scale: float = 1.0,
    digits: int | None = 5,
) -> DataFrame:
    """One row of positive-class rates; ``scale=100`` gives percent."""
    counted = df.agg(*cell_counts(label, prediction))
    rates = rates_sql(scale=scale).items()
    return counted.selectExpr(
        *[f"{sql} AS {name}" if digits is None else f"round({sql}, {digits}) AS {name}" for name, sql in rates]
    )


def label_counts(df: DataFrame, label: str = "label") -> DataFrame:
    counted = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"))
    return counted.orderBy(F.desc("n_rows"), label)


def imbalance(df: DataFrame, label: str = "label") -> DataFrame:
    positive = F.sum(F.col(label).cast("bigint"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(positive, F.lit(0)).alias("n_positive"),
        F.round(F.avg(label) * F.lit(100.0), 3).alias("positive_percent"),
    )


def split_shapes(df: DataFrame, part: str, features: list[str], label: str = "label") -> DataFrame:
    """Rows and columns of the features and of the label in each part."""
    counted = df.groupBy(part).agg(F.count(F.lit(1)).alias("n_rows"))
    frames = F.array(
        F.struct(F.lit("features").alias("frame"), F.lit(len(features)).alias("n_columns")),
        F.struct(F.lit(label).alias("frame"), F.lit(1).alias("n_columns")),
    )
    return counted.select(part, "n_rows", F.inline(frames))
