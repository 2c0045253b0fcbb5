"""Dense row numbers without a single-task window.

Rows are range-sorted once and stored. A stored row then has a lasting address, its file and its
position in that file, so its number is the position plus the rows of all earlier files. Only one
total per file is ever gathered, and a task that is run again finds the same addresses.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.features import quoted
from ..scratch import materialise, scratch_path

_TIE = "_row_tie"


def sort_for_storage(df: DataFrame, order: list[str]) -> DataFrame:
    """Globally sorted rows; equal rows stay separable, so copies of one row fill many tasks.

    Rows with equal ``order`` columns are ordered by their other columns, so a number belongs to content.
    """
    plain = (T.AtomicType, T.NullType)
    rest = [f.name for f in df.schema.fields if f.name not in order and isinstance(f.dataType, plain)]
    tagged = df.withColumn(_TIE, F.monotonically_increasing_id())
    return tagged.orderBy(*[quoted(c) for c in [*order, *rest]], _TIE).drop(_TIE)


def number_stored_rows(stored: DataFrame, name: str = "id", start: int = 1) -> DataFrame:
    """Number the rows of a stored Parquet frame in storage order.

    ``stored`` must be a plain scan of files written by one job.
    """
    file_name = F.col("_metadata.file_name").alias("_file")
    written = [
        F.regexp_extract("_file", pattern, 1).cast("bigint")
        for pattern in (r"^part-(\d+)", r"c(\d+)\.[a-z0-9_.]*parquet$")
    ]
    earlier = Window.orderBy(*written).rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.select(file_name).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
    offset = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset")
    offsets = materialise(sizes.select("_file", offset), "file_offsets")
    addressed = stored.select("*", file_name, F.col("_metadata.row_index").alias("_position"))
    number = (F.col("_offset") + F.col("_position") + F.lit(start)).cast("bigint").alias(name)
    # One row for each file of one write, so its size is bounded by that write's tasks: a million take 100 MB.
    rows = addressed.join(F.broadcast(offsets), "_file")
    return rows.select(number, *[f"`{c}`" for c in stored.columns])


def dense_row_number(
    df: DataFrame, order: list[str], name: str = "id", start: int = 1
) -> DataFrame:
    """``row_number() over (order by ...)`` for frames of any size: one shuffle, one stored copy."""
    spark = df.sparkSession
    path = scratch_path(spark, "sorted_rows")
    sort_for_storage(df, order).write.parquet(path)
    return number_stored_rows(spark.read.schema(df.schema).parquet(path), name, start)


def with_batches(
    df: DataFrame,
    order: list[str],
    size: int,
    name: str = "batch_no",
    position: str | None = None,
) -> DataFrame:
    """Consecutive batches of exactly ``size`` rows, the last one of the rest.

    Rows are counted, not key ranges: a key that fills a third of the table fills many batches.
    ``position`` names a column for the place of a row in its batch.
    """
    numbered = dense_row_number(df, order, "_number", start=0)
    placed = numbered.withColumn(name, F.expr(f"_number div {int(size)}"))
    if position:
        placed = placed.withColumn(position, F.expr(f"CAST(_number % {int(size)} AS INT)"))
    return placed.drop("_number")
