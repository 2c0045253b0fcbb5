"""Tables of an external warehouse through the data source interface.

The connector is a parameter. A connector with a table option gets the table name; a file format
gets it as the path below ``root``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Warehouse:
    connector: str = "parquet"
    root: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def _address(self, handle, table: str):
        handle = handle.format(self.connector).options(**self.options)
        return (handle, f"{self.root}/{table}") if self.root else (handle.option("table", table), None)

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        reader, path = self._address(spark.read, table)
        return reader.load(path) if path else reader.load()

    def overwrite(self, df: DataFrame, table: str) -> None:
        writer, path = self._address(df.write, table)
        writer = writer.mode("overwrite")
        writer.save(path) if path else writer.save()

    def round_trip(self, df: DataFrame, table: str, view: str) -> DataFrame:
        """Write, read back, and register what was read."""
        self.overwrite(df, table)
        stored = self.read(df.sparkSession, table)
        stored.createOrReplaceTempView(view)
        return stored
