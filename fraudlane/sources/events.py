"""Append-only rows in a shared folder.

Each append is a folder of its own with one file, which appears by one rename. Writers therefore never meet, and a
reader sees an append whole or not at all. A reader lists the folder when it is asked for the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..scratch import unique_name


class EventFolder:
    def __init__(self, spark: SparkSession, path: str, columns: str):
        """``columns`` is the DDL of a row; ``event``, the name of its append, comes with each row read."""
        self.spark, self.path, self.columns = spark, path, columns

    @classmethod
    def create(cls, spark: SparkSession, path: str, columns: str) -> EventFolder:
        folder = cls(spark, path, columns)
        folder._write(spark.createDataFrame([], columns), "start")
        return folder

    def _write(self, rows: DataFrame, event: str) -> None:
        rows.coalesce(1).write.parquet(f"{self.path}/event={event}")

    def append(self, rows: DataFrame, event: str | None = None) -> str:
        """Add rows under a name; a name that is taken is an error, so an append with a chosen name happens once."""
        event = event or unique_name("e")
        self._write(rows, event)
        return event

    def read(self) -> DataFrame:
        return self.spark.read.schema(f"{self.columns}, event string").parquet(self.path)
