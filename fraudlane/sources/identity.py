"""Tables whose rows get an id when they are added, going on from the ids before.

Every append is logged under a key with its first id and its number of rows; the highest id so far, the mark, is what the
log adds up to, and the next append starts behind it. Rows are numbered in content order by their place in stored files,
so ids are dense and no window runs over all rows. An append whose key is in the log is recognised and changes nothing:
a job that is started again after it was done adds no rows. One that failed before it was logged left nothing that is
read, and takes the same ids when it runs again.

The log decides what is read. An append is a folder of its own, so a failed one never mixes with others. One writer at a
time may append to a table: the claim of a number in the log is refused if that number is taken, and the writer
starts again from the new mark.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import number_stored_rows, sort_for_storage
from ..scratch import scratch_path
from .events import EventFolder

LOG_COLUMNS = "append_no bigint, append_key string, first_id bigint, n_rows bigint, path string"


class IdentityTable:
    def __init__(self, spark: SparkSession, root: str, columns: str, identity: str = "id"):
        """``columns`` is the DDL of the rows without their id."""
        self.spark, self.root, self.columns, self.identity = spark, root, columns, identity
        self._log = EventFolder(spark, f"{root}/log", LOG_COLUMNS)

    @classmethod
    def create(cls, spark: SparkSession, columns: str, identity: str = "id", root: str | None = None) -> IdentityTable:
        table = cls(spark, root or scratch_path(spark, "identity"), columns, identity)
        EventFolder.create(spark, f"{table.root}/log", LOG_COLUMNS)
        return table

    def appends(self) -> DataFrame:
        return self._log.read().drop("event")

    def mark(self) -> tuple[int, int]:
        """The highest id that is taken, and how many appends there were."""
        row = self.appends().agg(
            F.coalesce(F.max(F.col("first_id") + F.col("n_rows") - 1), F.lit(0)), F.count(F.lit(1))
        ).first()
        return row[0], row[1]

    def append(self, rows: DataFrame, key: str) -> bool:
        """Add ``rows``, matched by name; False if an append with this key is there already."""
        schema = self.spark.createDataFrame([], self.columns).schema
        stored = scratch_path(self.spark, "append_sorted")
        wanted = rows.selectExpr(*[f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema])
        n_rows = None
        while True:
            if not self.appends().where(F.col("append_key") == key).isEmpty():
                return False
            if n_rows is None:
                sort_for_storage(wanted, wanted.columns).write.parquet(stored)
                content = self.spark.read.schema(schema).parquet(stored)
                n_rows = content.count()
            last, number = self.mark()
            path = scratch_path(self.spark, "append")
            number_stored_rows(content, self.identity, last + 1).write.parquet(path)
            entry = self.spark.createDataFrame([(number, key, last + 1, n_rows, path)], LOG_COLUMNS)
            try:
                self._log.append(entry, f"n{number:012d}")
            except AnalysisException as taken:
                if taken.getCondition() != "PATH_ALREADY_EXISTS":
                    raise
                continue
            return True

    def read(self) -> DataFrame:
        """All logged rows: the id first, then the columns."""
        paths = [r["path"] for r in self.appends().select("path").collect()]
        columns = f"{self.identity} bigint, {self.columns}"
        if not paths:
            return self.spark.createDataFrame([], columns)
        return self.spark.read.schema(columns).parquet(*paths)
