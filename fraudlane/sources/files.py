"""File scans and file sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A Parquet directory; ``columns`` are checked at once instead of at the first action."""
    df = spark.read.parquet(path)
    missing = [c for c in columns or [] if c not in df.columns]
    if missing:
        raise ValueError(f"{path} lacks columns: {', '.join(missing)}")
    return df.select(*columns) if columns else df


def read_table(
    spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None
) -> DataFrame:
    """One of the given tables: a Parquet directory or file."""
    return scan_parquet(spark, f"{sf_dir}/{name}.parquet", columns)


def scan_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV with a header; the schema is given, so no pass is spent on inferring it."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.option("header", True).csv(path)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and time of each file below ``path``; contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return listing.select("path", "length", "modificationTime")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows under an explicit schema of plain types; a NULL in a required field fails the job."""
    columns = []
    for field in schema.fields:
        value = F.col(f"`{field.name}`").cast(field.dataType)
        if not field.nullable:
            failure = F.raise_error(F.lit(f"{field.name} must not be NULL")).cast(field.dataType)
            # Never reached; a literal is what makes the column required.
            text = isinstance(field.dataType, T.StringType)
            value = F.coalesce(value, failure, F.lit("" if text else 0).cast(field.dataType))
        columns.append(value.alias(field.name))
    return df.select(*columns).to(schema)
