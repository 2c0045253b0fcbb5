"""Scoring of arriving records: stateless, appended to files or upserted by key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.scoring import vote_score
from ..plans.medallion import gold_rows
from ..sources.keyed import KeyedStore, to_cells


def stream_parquet(
    spark: SparkSession, path: str, schema, files_per_trigger: int | None = None
) -> DataFrame:
    """Files of a directory as a stream, new files as they arrive."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def append_scores(
    records: DataFrame, output: str, checkpoint: str, prediction: Column | None = None
) -> StreamingQuery:
    """Score every record once and append it; the checkpoint makes a restart go on, not repeat."""
    scored = gold_rows(records, vote_score() if prediction is None else prediction)
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def upsert_scores(
    records: DataFrame,
    store: KeyedStore,
    checkpoint: str,
    stamp_us: Callable[[int], int],
    qualifiers: tuple[str, ...] = ("prediction", "time", "amountRange"),
    prediction: Column | None = None,
    writer: str = "stream",
) -> StreamingQuery:
    """Score every record and write its cells under the number of its micro-batch.

    A micro-batch that is run again replaces its own cells, so each counts once. Batch numbers start
    again with each checkpoint, so the query's lasting id, which the checkpoint keeps, is part of
    the writer: streams and new checkpoints never replace each other's cells.
    """
    scored = gold_rows(records, vote_score() if prediction is None else prediction)

    def write(batch: DataFrame, batch_id: int) -> None:
        cells = to_cells(batch, list(qualifiers), stamp_us(batch_id))
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        owner = f"{writer}_{query_id.replace('-', '')}"
        target = KeyedStore(batch.sparkSession, store.table)
        # A micro-batch that is run again after its cells were merged has nothing to add.
        if not target.merged(owner, batch_id):
            target.write(cells, batch_id, owner)

    return (
        scored.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
