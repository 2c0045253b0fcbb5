"""Row hashes that depend on the key and a seed only, never on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUCKETS = 10_000


def seeded_digest(key: str | Column, seed: int) -> Column:
    value = F.col(key) if isinstance(key, str) else key
    return F.md5(F.concat(value.cast("string"), F.lit(f":{seed}")))


def seeded_bucket(key: str | Column, seed: int) -> Column:
    """A bucket from 0 to 9999, about evenly filled."""
    prefix = F.substring(seeded_digest(key, seed), 1, 8)
    return F.pmod(F.conv(prefix, 16, 10).cast("bigint"), F.lit(BUCKETS))
