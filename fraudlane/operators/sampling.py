"""Splits and samples that repeat whatever the partitioning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import BUCKETS, seeded_bucket, seeded_digest


def with_part(
    df: DataFrame, shares: dict[str, float], seed: int, key: str = "id", name: str = "part"
) -> DataFrame:
    """Assign each row to one part by the hash of its key; rows of one key stay together."""
    if abs(sum(shares.values()) - 1.0) > 1e-9:
        raise ValueError("shares must sum to 1")
    bucket = seeded_bucket(key, seed)
    upper, part = 0.0, None
    for label, share in list(shares.items())[:-1]:
        upper += share
        below = bucket < F.lit(round(upper * BUCKETS))
        part = F.when(below, label) if part is None else part.when(below, label)
    last = list(shares)[-1]
    return df.withColumn(name, F.lit(last) if part is None else part.otherwise(last))


def split(
    df: DataFrame, shares: dict[str, float], seed: int, key: str = "id"
) -> dict[str, DataFrame]:
    tagged = with_part(df, shares, seed, key, "_part")
    return {label: tagged.where(F.col("_part") == label).drop("_part") for label in shares}


def random_rows(df: DataFrame, n: int, seed: int, key: str = "id") -> DataFrame:
    """A uniform sample of ``n`` rows: the smallest seeded digests, kept by a distributed top-n."""
    return df.orderBy(seeded_digest(key, seed), F.col(key)).limit(n)


def first_rows(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    return df.orderBy(key).limit(n)


def mixed_sample(df: DataFrame, n: int, n_positive: int, seed: int) -> DataFrame:
    """Rows of all kinds plus rows of the rare class; a row drawn twice stays twice."""
    positives = df.where(F.col("label") == 1)
    return random_rows(df, n, seed).unionByName(random_rows(positives, n_positive, seed))


def scoring_sample(test: DataFrame, n: int, n_positive: int) -> DataFrame:
    """The first test rows, followed by the first test rows known to be positive."""
    positives = test.where(F.col("label") == 1)
    return first_rows(test, n).unionByName(first_rows(positives, n_positive))
