"""Session defaults and the shared working folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings a job wants on any cluster.  Shuffle parallelism is left to adaptive
# execution: it starts wide and merges small partitions, so the same job serves
# a laptop and a thousand executors.
JOB_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


_READ_BYTES = "spark.sql.files.maxPartitionBytes"
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app_name: str = "rotativa", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the job settings; ``master`` is only for local runs."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false")
    for key, value in {**JOB_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Without ``spark.checkpoint.dir`` it lies in the warehouse, which executors
    and driver share as well; a machine's own temporary folder is never used.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_working"


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder (nothing is created yet).

    It belongs to the application: what is left in it goes when that ends.
    """
    path = f"{shared_folder(spark)}/rotativa/{purpose}-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    system.mkdirs(place.getParent())
    system.deleteOnExit(place)
    return path


def folder_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``new_folder`` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)


def stored(rows: DataFrame, purpose: str, codec: str | None = None) -> DataFrame:
    """The rows written to the shared folder and read back; ``codec`` packs a large table more tightly.

    For intermediate results that are costly to make and read more than once.
    The written table cuts the lineage and outlives any executor.  Nothing reads
    the shuffles that led to it again, so they go at once.
    """
    spark = rows.sparkSession
    path = new_folder(spark, purpose)
    before = spark.conf.get(_SHUFFLE_CLEANUP)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        rows.write.parquet(path, compression=codec)
    finally:
        spark.conf.set(_SHUFFLE_CLEANUP, before)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    table.working_folder = path
    return table


@contextmanager
def read_in_parts(spark: SparkSession, size: int) -> Iterator[None]:
    """Within it a task reads files of at most ``size`` bytes in all, or one part of a file that cannot be split.

    A fit keeps what a task has read, several times as large, in memory.
    """
    before = spark.conf.get(_READ_BYTES)
    spark.conf.set(_READ_BYTES, str(size))
    try:
        yield
    finally:
        spark.conf.set(_READ_BYTES, before)


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that no later result reads."""
    for table in tables:
        remove_folder(table.sparkSession, table.working_folder)


def reading(result: DataFrame, *tables: DataFrame) -> DataFrame:
    """The result, naming the stored tables it still reads: once it is written they can be discarded."""
    result.working_tables = tables
    return result
