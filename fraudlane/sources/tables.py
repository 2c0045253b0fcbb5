"""Catalog tables: create, insert, truncate, drop, inspect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import scratch_path, unique_name
from .files import list_files

# The rows meant for one bucket, and the fewest buckets of a table.
BUCKET_ROWS, MIN_BUCKETS = 2_000_000, 8


def create_database(spark: SparkSession, name: str | None = None) -> str:
    """A database in shared storage; without a name, one nobody else uses."""
    name = name or unique_name("fraud")
    location = scratch_path(spark, name)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{location}'")
    return name


def overwrite_table(df: DataFrame, table: str) -> DataFrame:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def buckets_for(df: DataFrame) -> int:
    """Buckets that grow with the table, from one count that reads no wide column."""
    return max(MIN_BUCKETS, -(-df.count() // BUCKET_ROWS))


def create_table(
    df: DataFrame, table: str, key: str | None = None, buckets: int | None = None
) -> DataFrame:
    """Fails if the table exists. Tables bucketed alike on a key later join without a shuffle.

    One task writes a bucket; one that a heavy key fills is split over tasks and files.
    """
    if key:
        buckets = buckets or buckets_for(df)
        writer = df.hint("rebalance", buckets, key).write.bucketBy(buckets, key).sortBy(key)
    else:
        writer = df.write
    writer.mode("errorifexists").format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def create_empty_table(spark: SparkSession, table: str, columns: str) -> None:
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet")


def insert_by_position(df: DataFrame, table: str, columns: list[str] | None = None) -> None:
    """``INSERT INTO table (columns) SELECT *``: source columns are matched by position."""
    named = f" ({', '.join(columns)})" if columns else ""
    df.sparkSession.sql(f"INSERT INTO {table}{named} SELECT * FROM {{source}}", source=df)


def drop_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def delete_all_rows(spark: SparkSession, table: str) -> None:
    spark.sql(f"TRUNCATE TABLE {table}")


def external_table(spark: SparkSession, table: str, location: str) -> DataFrame:
    """A table over files that stay where they are."""
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{location}'")
    return spark.table(table)


def temp_view(df: DataFrame, name: str | None = None) -> str:
    name = name or unique_name("view")
    df.createOrReplaceTempView(name)
    return name


def table_detail(spark: SparkSession, table: str) -> DataFrame:
    """Format, location, file count and bytes from a listing of the location; no row is read."""
    described = spark.sql(f"DESCRIBE EXTENDED {table}")
    detail = described.where(F.col("col_name").isin("Provider", "Location")).agg(
        F.max(F.when(F.col("col_name") == "Provider", F.col("data_type"))).alias("format"),
        F.max(F.when(F.col("col_name") == "Location", F.col("data_type"))).alias("location"),
    )
    provider, location = detail.first()
    return list_files(spark, location).where(~F.col("path").rlike(r"/[_.][^/]*$")).agg(
        F.lit(provider).alias("format"),
        F.lit(location).alias("location"),
        F.count(F.lit(1)).alias("n_files"),
        F.coalesce(F.sum("length"), F.lit(0)).alias("size_bytes"),
    )
