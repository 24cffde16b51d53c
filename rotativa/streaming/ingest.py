"""Arriving files as streams, and the plain stream writer."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rotativa.schema import HEADLINES
from rotativa.sources.headlines import CSV_OPTIONS
from rotativa.sources.pages import HTML_NAMES

BYTES_PER_BATCH = 1 << 40


def arriving_table(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", bytes_per_batch: int = BYTES_PER_BATCH
) -> DataFrame:
    """New Parquet files of a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxBytesPerTrigger", bytes_per_batch)
        .parquet(folder)
    )


def arriving_headline_files(spark: SparkSession, root: str, bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """New headline files of a partitioned folder."""
    return (
        spark.readStream.schema(HEADLINES)
        .options(**CSV_OPTIONS)
        .option("maxBytesPerTrigger", bytes_per_batch)
        .csv(root)
    )


def arriving_page_files(spark: SparkSession, root: str, bytes_per_batch: int = BYTES_PER_BATCH) -> DataFrame:
    """New HTML files below a folder as ``path, modified, content``."""
    return (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", HTML_NAMES)
        .option("maxBytesPerTrigger", bytes_per_batch)
        .load(root)
        .select("path", F.col("modificationTime").alias("modified"), "content")
    )


def append_stream(rows: DataFrame, path: str, checkpoint: str, *partition_by: str) -> StreamingQuery:
    """Process all files that have arrived and append their rows, each file once."""
    writer = rows.writeStream.format("parquet").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.trigger(availableNow=True).start(path)
