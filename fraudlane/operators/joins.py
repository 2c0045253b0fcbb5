"""Joins whose small side is measured before it is broadcast, and joins that spread their heavy keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES, TEXT_BYTES = 64 << 20, 256
# A key is heavy from this share of the rows on; so many parts it is cut into; counters of the sketch that finds it.
HEAVY_SHARE, SALTS, TRACKED = 0.01, 64, 10_000


def row_bytes(df: DataFrame) -> int:
    """What a row takes: eight bytes for each fixed column and the row itself, ``TEXT_BYTES`` for any other."""
    fixed = (T.NumericType, T.BooleanType, T.DatetimeType)
    return 8 + sum(8 if isinstance(f.dataType, fixed) else TEXT_BYTES for f in df.schema.fields)


def fits_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES, rows: int | None = None) -> bool:
    """Whether ``df`` takes at most ``max_bytes``: by its ``rows``, or a count that reads no column it does not need."""
    return (df.count() if rows is None else rows) * row_bytes(df) <= max_bytes


def join_measured(
    big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_BYTES, rows: int | None = None
) -> DataFrame:
    """Broadcast ``small`` if it was measured and fits; beyond that the join is left to the optimiser."""
    side = F.broadcast(small) if fits_broadcast(small, max_bytes, rows) else small
    return big.join(side, on, how)


def heavy_keys(df: DataFrame, key: str, share: float = HEAVY_SHARE) -> list:
    """Keys that hold at least ``share`` of the rows, by a count sketch of fixed size; at most 1 / ``share`` of them.

    The sketch may count too much, never so little that a heavy key is missed, as long as it has more counters than
    there can be heavy keys.
    """
    most = int(1 / share)
    found = df.where(F.col(key).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {max(TRACKED, 4 * most)})").alias("top")
    ).first()
    return [t["item"] for t in found["top"] or [] if t["count"] >= max(2, share * found["n"])]


def join_spreading_heavy(
    left: DataFrame, right: DataFrame, key: str, share: float = HEAVY_SHARE, salts: int = SALTS
) -> DataFrame:
    """Inner join on ``key`` whose heavy keys go to ``salts`` tasks each, whether stored by that key or not.

    A key is heavy if it is in either side. Its rows on the left are dealt over the salts, its rows on the right are copied
    to each of them; all other rows join as usual, without a shuffle if both sides are bucketed by the key.
    """
    heavy = sorted({*heavy_keys(left, key, share), *heavy_keys(right, key, share)})
    if not heavy:
        return left.join(right, key)
    among = F.col(key).isin(heavy)
    usual = left.where(~among).join(right.where(~among), key)
    dealt = left.where(among).withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    copied = right.where(among).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    spread = dealt.hint("shuffle_merge").join(copied, [key, "_salt"]).drop("_salt")
    return usual.unionByName(spread)
