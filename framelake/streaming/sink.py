"""Rows of a micro-batch written once, however often the batch is run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from framelake.sources.scratch import new_path


def batch_writer(path: str, make: Callable[[DataFrame], DataFrame]) -> Callable[[DataFrame, int], None]:
    """For ``foreachBatch``: ``make(batch)`` goes to the folder of the batch's number; a batch that is run again replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        make(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def read_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows that batches wrote, with their batch_id."""
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)


def drain_batches(stream: DataFrame, make: Callable[[DataFrame], DataFrame], schema: str, name: str) -> DataFrame:
    """What ``make`` gives for each micro-batch of all that the source holds now; a stream without rows gives none."""
    spark = stream.sparkSession
    path = new_path(spark, name)
    spark.createDataFrame([], schema).write.parquet(f"{path}/batch_id=-1")  # the folder is there whatever comes
    job = stream.writeStream.foreachBatch(batch_writer(path, make)).option("checkpointLocation", new_path(spark, f"{name}-state")).trigger(availableNow=True).start()
    job.awaitTermination()
    return read_batches(spark, path, schema)
