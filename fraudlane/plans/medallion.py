"""Bronze, silver and gold tables, and the test and validation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from ..functions.features import FEATURES, flatten_vector, rename_features
from ..functions.scoring import sql_call, vote_score
from ..operators.numbering import number_stored_rows, sort_for_storage
from ..sources import tables

# Table names and typed columns.
BRONZE, SILVER, GOLD = "cc_fraud_bronze", "cc_fraud_silver", "cc_fraud_gold"
TEST, VALID = "cc_fraud_test", "cc_fraud_valid"
SILVER_COLUMNS = "id bigint, time int, amountRange int, label int, " + ", ".join(
    f"{name} double" for name in FEATURES
)
GOLD_COLUMNS = "id bigint, time int, amountRange int, prediction int"


def build_bronze(raw: DataFrame, database: str) -> DataFrame:
    """Flattened rows, stored in content order.

    The order clusters the table by time, and makes storage order an identity that any run on the
    same rows assigns alike.
    """
    flat = flatten_vector(raw)
    return tables.overwrite_table(sort_for_storage(flat, flat.columns), f"{database}.{BRONZE}")


def build_silver(spark: SparkSession, database: str) -> DataFrame:
    """Typed rows with a generated identity from 1; bronze columns are matched by position."""
    table = f"{database}.{SILVER}"
    tables.drop_table(spark, table)
    tables.create_empty_table(spark, table, SILVER_COLUMNS)
    bronze = spark.table(f"{database}.{BRONZE}")
    numbered = number_stored_rows(bronze, "id", start=1)
    tables.insert_by_position(numbered, table, ["id", "time", "amountRange", "label", *FEATURES])
    return spark.table(table)


def gold_rows(silver: DataFrame, prediction: Column | None = None) -> DataFrame:
    scored = vote_score() if prediction is None else prediction
    return silver.select("id", "time", "amountRange", scored.cast("int").alias("prediction"))


def build_gold(silver: DataFrame, database: str, prediction: Column | None = None) -> DataFrame:
    """Scores are computed once and stored, so later filters read them instead of scoring again."""
    spark, table = silver.sparkSession, f"{database}.{GOLD}"
    tables.drop_table(spark, table)
    tables.create_empty_table(spark, table, GOLD_COLUMNS)
    tables.insert_by_position(gold_rows(silver, prediction), table)
    return spark.table(table)


def valid_rows(transactions: DataFrame) -> DataFrame:
    """Id first, label last, features under their flattened names."""
    flat = rename_features(transactions, "flattened")
    middle = [c for c in flat.columns if c not in ("id", "label")]
    return flat.select("id", *[f"`{c}`" for c in middle], "label")


def build_test_and_valid(
    transactions: DataFrame, database: str, buckets: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Both tables, bucketed by id so that joining them needs no shuffle.

    The ids come with the rows, so they agree in both tables however often the rows are computed.
    """
    buckets = buckets or tables.buckets_for(transactions)
    valid = tables.create_table(valid_rows(transactions), f"{database}.{VALID}", "id", buckets)
    test = tables.create_table(valid.drop("label"), f"{database}.{TEST}", "id", buckets)
    return test, valid


def predictions_view(test: DataFrame, function: str, names: list[str], view: str | None = None) -> str:
    """A temporary view that scores with a registered function; runs nothing by itself."""
    name = view or tables.unique_name("cc_fraud_predictions")
    source = tables.temp_view(test)
    test.sparkSession.sql(
        f"CREATE OR REPLACE TEMPORARY VIEW {name} AS "
        f"SELECT id, time, amountRange, {sql_call(function, names)} AS prediction FROM {source}"
    )
    return name
