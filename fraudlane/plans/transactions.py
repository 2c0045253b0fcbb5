"""Transactions with 28 features, derived from the ``events`` and ``embeddings`` tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.features import FEATURES, pack_vector
from ..operators.joins import join_measured
from ..sources.files import read_table

# Fixed values of the fixture: lower ends of the amount ranges 1 to 8, and the rule for a positive label.
AMOUNT_CUTS = (1, 2, 5, 10, 20, 50, 100, 200)
LABEL_SUM = 0.3
LABEL_AMOUNT_RANGE = 5

COLUMNS = ["id", "time", "amountRange", *FEATURES, "label"]


def amount_range(value: str) -> Column:
    """0 to 8: how many cuts the value has reached; 0 for NULL."""
    steps = list(enumerate(AMOUNT_CUTS, start=1))
    cases = " ".join(f"WHEN {value} >= {cut} THEN {position}" for position, cut in reversed(steps))
    return F.expr(f"CASE {cases} ELSE 0 END")


def whole_seconds(interval: Column) -> Column:
    """Whole seconds of a day-time interval, independent of the session time zone."""
    return interval.cast("interval second").cast("bigint")


def feature_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, spread into feature columns; event n refers to vector n modulo their number."""
    vectors = read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"])
    spread = [f"CAST(embedding[{i}] AS DOUBLE) AS {name}" for i, name in enumerate(FEATURES)]
    return vectors.selectExpr("vec_id AS vector_id", *spread)


def with_transactions(events: DataFrame, vectors: DataFrame, first_ts: Column) -> DataFrame:
    """Transactions from event rows, batch or stream; ``first_ts`` is where time starts.

    Vectors are numbered from 0 without a gap, or there would be events without features: an error.
    """
    vector_id = F.col("vector_id")
    n_vectors, low, high = vectors.agg(F.count(F.lit(1)), F.min(vector_id), F.max(vector_id)).first()
    if n_vectors and (low, high) != (0, n_vectors - 1):
        raise ValueError(f"{n_vectors} vectors are numbered from {low} to {high}")
    modulus = max(1, n_vectors)
    base = events.select(
        F.col("event_id").alias("id"),
        whole_seconds(F.col("ts") - first_ts).cast("int").alias("time"),
        amount_range("value").alias("amountRange"),
        F.pmod("event_id", F.lit(modulus)).cast("bigint").alias("vector_id"),
    )
    label = (
        f"CASE WHEN pca0 + pca1 > {LABEL_SUM}D AND amountRange >= {LABEL_AMOUNT_RANGE} "
        "THEN 1 ELSE 0 END AS label"
    )
    joined = join_measured(base, vectors, "vector_id", rows=n_vectors)
    return joined.selectExpr("id", "time", "amountRange", *FEATURES, label)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events", ["event_id", "ts", "value"])
    first_ts = events.select(F.min("ts")).scalar()
    return with_transactions(events, feature_vectors(spark, sf_dir), first_ts)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As they arrive: no id, the features in one vector column."""
    txn = transactions(spark, sf_dir)
    return pack_vector(txn.select("time", "amountRange", "label", *FEATURES))
