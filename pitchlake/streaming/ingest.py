"""Structured Streaming over a landing folder: each new file is taken in once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pitchlake.plans.warehouse import Warehouse
from pitchlake.sources.raw import describe_artifacts


def landed_files(spark: SparkSession, landing: str, files_per_batch: int | None = None) -> DataFrame:
    reader = (
        spark.readStream.format("text").option("wholetext", True)
        .option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return describe_artifacts(reader.load(landing))


def start_ingest(
    warehouse: Warehouse, landing: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Take in everything landed so far, then stop.

    The key of a batch holds the identity that the stream keeps in its checkpoint: a batch that
    is run again after a failure goes on with its own work, and another stream, or one whose checkpoint
    was lost, has keys of its own.
    """
    def take_in(batch: DataFrame, batch_id: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        warehouse.ingest(batch, f"stream-{stream}-{batch_id}")

    return (
        landed_files(warehouse.spark, landing, files_per_batch).writeStream
        .foreachBatch(take_in).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
