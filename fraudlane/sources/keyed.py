"""Wide-column keyed export: rows as cells in tables bucketed by row key, newest cell wins on read.

A write is one partition, named by its writer and the writer's count of writes, so writing it again replaces it and
never adds to it. Its files lie in a folder of their own, and the partition is pointed at them when they are complete:
writers that are active at the same time do not touch each other's files. Inside a write, ``batch_no`` counts batches of
a fixed number of row keys: a loader with a limit for each request takes one batch at a time, and files carry the minimum
and maximum of the column, so it finds them without reading the rest.

Cells are bucketed and sorted by ``row_key``: a read of one key opens that key's bucket only, and the newest cells of all
rows are found without a shuffle. A row key with a large share of a write is split over several files of its bucket.

Compaction merges writes level by level while writers go on. It takes the writes it sees, writes their newest cells as
one partition of the next level, and then logs the merge in one step: before that no reader sees the result, after it
none sees what went into it. A write that comes in meanwhile is not among those merged and stays as it is. If the cells
have outgrown the buckets, the merge goes to a table with more of them, a new generation, which later writes go to as
well. One compaction at a time is sensible; of two that merge the same write, the earlier counts and the other is void.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.numbering import with_batches
from ..scratch import scratch_path, unique_name
from . import tables
from .events import EventFolder

# The column family, and the row keys that go into one batch.
FAMILY = "predict"
BATCH_ROWS = 10_000
# Fewest buckets of a store, the cells meant for one bucket, and the writes of one level that are merged together.
BUCKETS, BUCKET_CELLS, FAN = 8, 4_000_000, 4
COMPACTED = "compacted"
_STORED = ("row_key", "family", "qualifier", "value", "stamp_us", "batch_no", "source_writer", "source_no")
CELL_COLUMNS = (
    "row_key string, family string, qualifier string, value string, stamp_us bigint, batch_no bigint, "
    "source_writer string, source_no bigint, writer string, write_no bigint"
)
MERGE_COLUMNS = (
    "number bigint, level int, generation int, buckets int, "
    "replaced array<struct<generation:int,writer:string,write_no:bigint>>"
)
# A merged cell keeps the write it came from, so that equal stamps are decided as before.
_NEWEST = ("stamp_us", "source_no", "source_writer", "batch_no", "value")
_LOG, _SIZE = "cells.log", "cells.bucket"


@dataclass(frozen=True, order=True)
class Write:
    """One partition of one generation's table."""

    generation: int
    writer: str
    write_no: int

    def condition(self) -> Column:
        return (F.col("writer") == self.writer) & (F.col("write_no") == self.write_no)

    def spec(self) -> str:
        return f"PARTITION (writer = '{self.writer}', write_no = {int(self.write_no)})"


def to_cells(
    df: DataFrame,
    qualifiers: list[str],
    stamp_us: int | Column,
    key: str = "id",
    family: str = FAMILY,
) -> DataFrame:
    """One row for each value that is not NULL; columns beyond key and qualifiers are kept."""
    kept = [c for c in df.columns if c != key and c not in qualifiers]
    stamp = stamp_us if isinstance(stamp_us, Column) else F.lit(stamp_us).cast("bigint")
    cells = ", ".join(f"'{q}', CAST(`{q}` AS STRING)" for q in qualifiers)
    unpivoted = df.select(
        F.col(key).cast("string").alias("row_key"),
        F.lit(family).alias("family"),
        stamp.alias("stamp_us"),
        *kept,
        *qualifiers,
    ).selectExpr(
        "row_key", "family", "stamp_us", *kept, f"stack({len(qualifiers)}, {cells}) AS (qualifier, value)"
    )
    return unpivoted.where(F.col("value").isNotNull()).select(
        "row_key", "family", "qualifier", "value", "stamp_us", *kept
    )


def batched_cells(
    df: DataFrame,
    qualifiers: list[str],
    stamp_us: int,
    key: str = "id",
    batch_rows: int = BATCH_ROWS,
) -> DataFrame:
    return to_cells(with_batches(df, [key], batch_rows), qualifiers, stamp_us, key)


def _side_by_side(cells: DataFrame, qualifiers: list[str]) -> DataFrame:
    """One aggregate both picks the newest value and turns it into a column."""
    columns = [
        F.max(F.when(F.col("qualifier") == q, F.struct(*_NEWEST))).getField("value").alias(q)
        for q in qualifiers
    ]
    wanted = cells.where(F.col("qualifier").isin(*qualifiers))
    return wanted.groupBy("row_key").agg(*columns)


def buckets_for_cells(cells: int, bucket_cells: int = BUCKET_CELLS) -> int:
    return max(BUCKETS, -(-cells // bucket_cells))


class KeyedStore:
    def __init__(self, spark: SparkSession, table: str):
        self.table = table
        self.spark = spark

    @classmethod
    def create(
        cls, spark: SparkSession, table: str, buckets: int | None = None, cells: int = 0, bucket_cells: int = BUCKET_CELLS
    ) -> KeyedStore:
        """``cells`` is how many there will be to begin with; compaction follows the growth with more buckets."""
        store = cls(spark, table)
        store._create_generation(0, buckets or buckets_for_cells(cells, bucket_cells))
        store._set_log(bucket_cells)
        return store

    # Tables and the log

    def _name(self, generation: int) -> str:
        return f"{self.table}_g{generation}" if generation else self.table

    def _create_generation(self, generation: int, buckets: int) -> None:
        self.spark.sql(
            f"CREATE TABLE {self._name(generation)} ({CELL_COLUMNS}) USING parquet PARTITIONED BY (writer, write_no) "
            f"CLUSTERED BY (row_key) SORTED BY (row_key) INTO {int(buckets)} BUCKETS"
        )

    def _set_log(self, bucket_cells: int) -> None:
        path = scratch_path(self.spark, "cell_merges")
        EventFolder.create(self.spark, path, MERGE_COLUMNS)
        self.spark.sql(f"ALTER TABLE {self.table} SET TBLPROPERTIES ('{_LOG}' = '{path}', '{_SIZE}' = '{int(bucket_cells)}')")

    def _properties(self) -> dict[str, str]:
        return {r["key"]: r["value"] for r in self.spark.sql(f"SHOW TBLPROPERTIES {self.table}").collect()}

    def _log(self) -> EventFolder:
        return EventFolder(self.spark, self._properties()[_LOG], MERGE_COLUMNS)

    def merges(self) -> dict[Write, tuple[int, frozenset[Write]]]:
        """Every merge that counts, with its level and the writes it replaced, in order."""
        found, replaced = {}, set()
        for row in sorted(self._log().read().collect(), key=lambda r: (r["number"], r["event"])):
            inputs = frozenset(Write(*one) for one in row["replaced"])
            if not inputs & replaced:
                found[Write(row["generation"], COMPACTED, row["number"])] = (row["level"], inputs)
                replaced |= inputs
        return found

    def buckets(self, generation: int | None = None) -> int:
        name = self._name(self.generation() if generation is None else generation)
        described = self.spark.sql(f"DESCRIBE EXTENDED {name}")
        return int(described.where("col_name = 'Num Buckets'").select("data_type").first()[0])

    def generation(self) -> int:
        """The table that writes go to."""
        return max((w.generation for w in self.merges()), default=0)

    def _present(self, generation: int) -> list[Write]:
        rows = self.spark.sql(f"SHOW PARTITIONS {self._name(generation)}").collect()
        parts = [dict(part.split("=", 1) for part in row["partition"].split("/")) for row in rows]
        return [Write(generation, p["writer"], int(p["write_no"])) for p in parts]

    def writes(self) -> tuple[dict[Write, int], list[Write]]:
        """The writes that count with their levels, and partitions that do not: merged ones, and unfinished merges."""
        merges = self.merges()
        replaced = {w for _, inputs in merges.values() for w in inputs}
        present = [w for g in sorted({0, *(m.generation for m in merges)}) for w in self._present(g)]
        live = {
            w: merges[w][0] if w in merges else 0
            for w in present
            if w not in replaced and (w in merges or w.writer != COMPACTED)
        }
        return live, [w for w in present if w not in live]

    # Writing

    def merged(self, writer: str, write_no: int) -> bool:
        """Whether a write has become part of a merge; it is final then."""
        replaced = (w for _, inputs in self.merges().values() for w in inputs)
        return any((w.writer, w.write_no) == (writer, write_no) for w in replaced)

    def write(self, cells: DataFrame, write_no: int, writer: str = "batch") -> None:
        if not writer.replace("_", "").isalnum() or writer == COMPACTED:
            raise ValueError("a writer is named by letters, digits and underscores")
        if self.merged(writer, write_no):
            raise ValueError(f"write {write_no} of {writer} has been merged; later cells need a number of their own")
        if "batch_no" not in cells.columns:
            cells = cells.withColumn("batch_no", F.lit(0).cast("bigint"))
        own = cells.withColumns({"source_writer": F.lit(writer), "source_no": F.lit(write_no).cast("bigint")})
        self._put(own, Write(self.generation(), writer, write_no))

    def _put(self, cells: DataFrame, write: Write) -> None:
        """Files of ``cells`` in a new folder, then the partition that points at them."""
        name, buckets = self._name(write.generation), self.buckets(write.generation)
        path, loader = scratch_path(self.spark, "cells"), f"{name}_{unique_name('load')}"
        # One task for each bucket, more for one that a hot key fills.
        rows = cells.select(*_STORED).hint("rebalance", buckets, "row_key")
        writer = rows.write.format("parquet").bucketBy(buckets, "row_key").sortBy("row_key")
        writer.option("path", path).saveAsTable(loader)
        spark = rows.sparkSession
        # Dropping a table over a path leaves the path.
        spark.sql(f"DROP TABLE {loader}")
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {write.spec()} LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {name} {write.spec()} SET LOCATION '{path}'")
        spark.sql(f"REFRESH TABLE {name}")

    # Reading

    def _of(self, writes: list[Write], left_out: list[Write]) -> DataFrame:
        """The cells of ``writes``, which are all partitions of their tables but those ``left_out``."""
        frames = []
        for generation in sorted({w.generation for w in writes} or {0}):
            frame = self.spark.table(self._name(generation))
            for write in left_out:
                if write.generation == generation:
                    frame = frame.where(~write.condition())
            frames.append(frame)
        cells = frames[0]
        for frame in frames[1:]:
            cells = cells.unionByName(frame)
        return cells

    def cells(self) -> DataFrame:
        live, left_out = self.writes()
        return self._of(list(live), left_out)

    def latest(self) -> DataFrame:
        """The newest cell of each column of each row; older copies drop out before anything is shuffled."""
        newest = F.max(F.struct(*_NEWEST))
        grouped = self.cells().groupBy("row_key", "family", "qualifier").agg(newest.alias("cell"))
        return grouped.select(
            "row_key", "family", "qualifier", "cell.value", "cell.stamp_us"
        )

    def rows(self, qualifiers: list[str], keys: DataFrame | None = None) -> DataFrame:
        """Newest values side by side, for all rows or for the row keys given."""
        cells = self.cells()
        if keys is not None:
            cells = cells.join(keys.select("row_key"), "row_key", "left_semi")
        return _side_by_side(cells, qualifiers)

    def row(self, key: str, qualifiers: list[str]) -> DataFrame:
        """One row by key; the predicate reaches the files."""
        return _side_by_side(self.cells().where(F.col("row_key") == key), qualifiers)

    def count(self) -> DataFrame:
        return self.cells().agg(F.count_distinct("row_key").alias("n_rows"))

    # Compaction

    def compact(self, fan: int | None = None) -> int:
        """Merge all writes into one or, with ``fan``, only levels that hold so many; how many merges were made.

        With a fan a cell is rewritten once for each level it rises, so the work for each new write stays about the same
        however much the store holds. Merged partitions stay for readers that began before, until ``vacuum``.
        """
        made = 0
        while True:
            live, left_out = self.writes()
            levels = sorted(set(live.values()))
            full = [level for level in levels if sum(x == level for x in live.values()) >= (fan or 2)]
            if fan is None:
                chosen = list(live) if len(live) > 1 else []
            else:
                chosen = [w for w, level in live.items() if full and level == full[0]]
            if not chosen:
                return made
            self._merge(chosen, [*left_out, *(w for w in live if w not in chosen)], 1 + max(live[w] for w in chosen))
            made += 1

    def _merge(self, chosen: list[Write], left_out: list[Write], level: int) -> None:
        cells = self._of(chosen, left_out)
        # A count of files' rows; the cells are fewer after the merge.
        wanted = buckets_for_cells(cells.count(), int(self._properties()[_SIZE]))
        generation = self.generation()
        if wanted > 2 * self.buckets(generation):
            generation += 1
            if not self.spark.catalog.tableExists(self._name(generation)):
                self._create_generation(generation, wanted)
        kept = cells.groupBy("row_key", "family", "qualifier").agg(F.max(F.struct(*_NEWEST)).alias("cell"))
        kept = kept.select("row_key", "family", "qualifier", *(f"cell.{c}" for c in _NEWEST))
        merge = Write(generation, COMPACTED, time.time_ns() // 1000)
        self._put(kept, merge)
        replaced = [(w.generation, w.writer, w.write_no) for w in chosen]
        row = (merge.write_no, level, generation, self.buckets(generation), replaced)
        self._log().append(self.spark.createDataFrame([row], MERGE_COLUMNS))

    def vacuum(self) -> int:
        """Drop partitions that no longer count; for a time when no reader has begun before the last merge."""
        _, left_out = self.writes()
        for write in left_out:
            self.spark.sql(f"ALTER TABLE {self._name(write.generation)} DROP IF EXISTS {write.spec()} PURGE")
        return len(left_out)

    def clear(self) -> None:
        """Forget all cells and merges."""
        bucket_cells = int(self._properties()[_SIZE])
        for generation in range(self.generation(), 0, -1):
            tables.drop_table(self.spark, self._name(generation))
        for write in self._present(0):
            self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {write.spec()} PURGE")
        self._set_log(bucket_cells)
