"""Streaming sinks: appended logs and keyed upserts, resumable by checkpoint."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stepforge.operators.keyed import first_per_key

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def run_available(stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream over what is there, write parquet in ``folder`` and read it back."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        run = stream.writeStream.format("parquet").outputMode(mode).option(
            "checkpointLocation", os.path.join(folder, "checkpoint")).trigger(availableNow=True).start(
            os.path.join(folder, "rows"))
        run.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
    return spark.read.schema(stream.schema).parquet(os.path.join(folder, "rows"))


def append_log(results: DataFrame, folder: str, logs: dict[str, Column]) -> None:
    """Append each result at once to every log whose condition it meets.

    The batch number is a folder of its own that is replaced, so a batch that
    is run again after a failure is not written twice.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        for name, condition in logs.items():
            batch.filter(condition).write.mode("overwrite").parquet(os.path.join(folder, name, f"batch={number}"))
        batch.unpersist()

    run = results.writeStream.foreachBatch(write).option(
        "checkpointLocation", os.path.join(folder, "checkpoint")).trigger(availableNow=True).start()
    run.awaitTermination()


def read_log(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, name))


def upsert(results: DataFrame, folder: str) -> str:
    """Write every micro-batch as a folder of its own under its number; returns the folder, for ``read_upserted``.

    A batch that is run again after a failure replaces its folder. Nothing is
    looked up or rewritten while the stream runs; the newest row of a key is
    chosen by whoever reads.
    """
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(folder, "rows", f"batch={number}"))

    run = results.writeStream.foreachBatch(write).option(
        "checkpointLocation", os.path.join(folder, "checkpoint")).trigger(availableNow=True).start()
    run.awaitTermination()
    return folder


def read_upserted(spark: SparkSession, folder: str, key: str, order: Sequence[str]) -> DataFrame:
    """The row of the greatest ``order`` per key over all batches; of equal ones the last batch's."""
    rows = spark.read.parquet(os.path.join(folder, "rows"))
    newest = first_per_key(rows, [key], [*[F.col(c) for c in order], F.col("batch")], latest=True)
    return newest.drop("batch")


def compacted(spark: SparkSession, folder: str, key: str, order: Sequence[str], to: str) -> DataFrame:
    """The newest rows written as one table, which a reader may take instead of the batches so far."""
    read_upserted(spark, folder, key, order).write.mode("overwrite").parquet(to)
    return spark.read.parquet(to)
