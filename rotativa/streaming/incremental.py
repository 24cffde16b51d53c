"""Incremental, repeatable loading into a table with the sink's unique key, and compaction of the loads.

One writer at a time: a load and a compaction, or two of either, must not run at once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rotativa.operators.clean import valid_rows
from rotativa.operators.dedupe import absent_from
from rotativa.schema import NEWS
from rotativa.session import discard, folder_exists, remove_folder, stored
from rotativa.streaming.manifest import Manifest, read_manifest, retired_folders, swap_manifest

_STORED = T.StructType([*NEWS.fields, T.StructField("load", T.StringType())])
MERGED_FILE_ROWS = 5_000_000  # of a merged file; a larger date has several


def _open_rows(spark: SparkSession, target: str, manifest: Manifest) -> DataFrame:
    """Rows of the loads since the last compaction."""
    folder = manifest.open_folder(target)
    if not folder_exists(spark, folder):
        return spark.createDataFrame([], _STORED)
    return spark.read.schema(_STORED).parquet(folder)


def _merged_rows(spark: SparkSession, target: str, manifest: Manifest) -> DataFrame:
    """Rows of the dates that were compacted."""
    rows = spark.createDataFrame([], _STORED)
    for root, dates in manifest.merged_folders(target).items():
        rows = rows.unionByName(spark.read.schema(_STORED).option("basePath", root).parquet(*dates))
    return rows


def stored_rows(spark: SparkSession, target: str) -> DataFrame:
    """Rows of the target with the load that brought them: the stream's identity and the batch's number."""
    manifest = read_manifest(spark, target)
    if not manifest.merged:
        return _open_rows(spark, target, manifest)
    return _merged_rows(spark, target, manifest).unionByName(_open_rows(spark, target, manifest))


def append_new_rows(batch: DataFrame, load: str, target: str) -> None:
    """Add the rows whose key the target does not hold yet.

    Rows are kept by date and load.  A load that is run again after a failure
    compares with all others and replaces its own folders, so the target ends up
    the same, whatever other checkpoints have written to it.  Rows of it that were
    compacted meanwhile are held like those of any other load; only what they lack
    is added.  The batch is read once: its rows are stored and compared.  The
    comparison reads only the dates that arrived.
    """
    spark = batch.sparkSession
    manifest = read_manifest(spark, target)
    rows = stored(valid_rows(batch), "batch-rows")
    held = _open_rows(spark, target, manifest).where(F.col("load") != load)
    if manifest.merged:
        held = held.unionByName(_merged_rows(spark, target, manifest))
    (
        absent_from(rows, held)
        .withColumn("load", F.lit(load))
        .hint("rebalance", "fecha")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fecha", "load")
        .parquet(manifest.open_folder(target))
    )
    discard(rows)


def compact_loads(spark: SparkSession, target: str) -> int:
    """Merge the files of all dates that were loaded since the last compaction, and return how many dates.

    Dates without new loads are neither read nor written.  Readers see the merged
    files from the swap of the manifest on; a compaction that fails before it has
    changed nothing, and the next one replaces what it left.  Folders go one
    compaction after they were retired, so that readers that began before the swap
    can end.
    """
    before = read_manifest(spark, target)
    arrived = _open_rows(spark, target, before)
    dates = [row.fecha.isoformat() for row in arrived.select("fecha").distinct().collect()]
    if not dates:
        return 0
    following = Manifest(before.generation + 1, before.merged | dict.fromkeys(dates, before.generation + 1))
    again = Manifest(before.generation, {date: g for date, g in before.merged.items() if date in set(dates)})
    (
        arrived.unionByName(_merged_rows(spark, target, again))
        .hint("rebalance", "fecha")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", MERGED_FILE_ROWS)
        .option("partitionOverwriteMode", "static")
        .partitionBy("fecha")
        .parquet(f"{target}/merged={following.generation}")
    )
    swap_manifest(spark, target, following)
    for folder in retired_folders(spark, target, following, before):
        remove_folder(spark, folder)
    return len(dates)


def stream_identity(spark: SparkSession, checkpoint: str) -> str:
    """The identity that a stream keeps in its checkpoint: another one after a checkpoint is lost."""
    return spark.read.json(f"{checkpoint}/metadata").first()["id"]


def load_new_headlines(arriving: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Load everything that has arrived since the last committed run."""

    def load(batch: DataFrame, batch_id: int) -> None:
        append_new_rows(batch, f"{stream_identity(batch.sparkSession, checkpoint)}-{batch_id}", target)

    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(load)
        .trigger(availableNow=True)
        .start()
    )
