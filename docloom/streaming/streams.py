"""Streaming forms of what a batch reads once: the log of bad cases, and documents as they arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.operators import review
from docloom.session import shared_folder


def flags_stream(spark: SparkSession, path: str, schema, most_files: int = 100) -> DataFrame:
    """The state of each key of a log of Parquet files as it grows: an aggregation with one record a key as its state."""
    log = spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)
    return review.latest_flags(log)


def drained(stream: DataFrame, name: str) -> DataFrame:
    """The state of an aggregation over all that a stream holds now, as a table in a shared folder.

    Each batch writes the whole state beside the one before; the driver learns only the number of the last.
    """
    spark = stream.sparkSession
    folder, last = shared_folder(spark, name), []

    def keep(state: DataFrame, number: int) -> None:
        state.write.mode("overwrite").parquet(f"{folder}/state/{number}")
        last.append(number)

    query = stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", f"{folder}/progress").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/state/{last[-1]}") if last else spark.createDataFrame([], stream.schema)


def ingest(spark: SparkSession, root: str, out: str, checkpoint: str, process: Callable[[DataFrame], DataFrame], most_files: int = 1000) -> None:
    """New documents below ``root`` through ``process`` to a table, some files a batch; a restart goes on where it stopped.

    A batch's output is marked by its number: one that is written twice after a failure replaces itself.
    """
    kind = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(kind).option("recursiveFileLookup", True).option("pathGlobFilter", "*.pdf").option("maxFilesPerTrigger", most_files).load(root)

    def write(batch: DataFrame, number: int) -> None:
        process(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(out)

    files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def remaining(inputs: DataFrame, done: DataFrame, key: str = "sha256") -> DataFrame:
    """Inputs of which the output has no row yet; those without a key are always left."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")
