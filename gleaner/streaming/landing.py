"""Incremental processing of a landing folder: whatever is new, once, with progress in a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def process_new(spark: SparkSession, folder: str, schema: str, work: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, kind: str = "parquet") -> None:
    """Run ``work`` over the files that have landed since the last call and append its rows to ``out``, each batch in its own folder.

    A batch that is run again after a failure replaces its folder, so results aren't doubled.
    """

    def batch(df: DataFrame, number: int) -> None:
        work(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).format(kind).load(folder)
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def first_seen(stream: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """One row per key of a stream of documents, as far back as ``late``."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
