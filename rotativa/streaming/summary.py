"""The news summary, kept current while rows arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rotativa.session import discard, folder_exists, stored

_GROUP = ("fecha", "periodico", "categoria")


def running_counts(arriving: DataFrame, *group: str, added: str | None = None) -> DataFrame:
    """Rows per group so far, with ``added`` also the first and last time; the state holds these per group."""
    times = (F.min(added).alias("first_added"), F.max(added).alias("last_added")) if added else ()
    return arriving.groupBy(*(group or _GROUP)).agg(F.count("*").alias("total_articles"), *times)


def keep_summary(counts: DataFrame, path: str, checkpoint: str, date: str = "fecha", group: tuple[str, ...] = _GROUP) -> StreamingQuery:
    """Bring the summary up to date after each batch: only dates that have changed groups are written.

    The stream hands over the groups of the batch with their new totals.  The
    summary lies in one folder per date; of a touched date the other groups are
    kept, and its folder is replaced as a whole.  A batch that runs again after a
    failure hands over the same totals and so writes the same.
    """

    def publish(changed: DataFrame, batch_id: int) -> None:
        changed = stored(changed, "summary-changes")
        held = current_summary(changed.sparkSession, path, changed)
        bounds = changed.agg(F.min(date).alias("first"), F.max(date).alias("last"), F.max(F.col(date).isNull()).alias("undated"))
        first, last, undated = bounds.first()
        touched = F.col(date).between(F.lit(first), F.lit(last))  # prunes folders; the join below is exact
        near = held.where(touched | F.col(date).isNull() if undated else touched)
        dates = changed.select(F.col(date).alias("_date")).distinct()
        same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in group]
        replaced = changed.select(*(F.col(name).alias(f"_{name}") for name in group))
        kept = near.join(dates, F.col(date).eqNullSafe(F.col("_date")), "left_semi").join(replaced, same, "left_anti")
        summary = stored(kept.unionByName(changed), "summary-dates")  # what is read is not overwritten
        (
            summary.hint("rebalance", date)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(date)
            .parquet(path)
        )
        discard(changed, summary)

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
        .trigger(availableNow=True)
        .start()
    )


def current_summary(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The summary as it stands, with the columns of ``like``; empty before the first batch."""
    if not folder_exists(spark, path):
        return like.limit(0)
    return spark.read.schema(like.schema).parquet(path).select(*like.columns)


def latest_summary(spark: SparkSession, path: str, date: str = "fecha") -> DataFrame:
    """The summary as it stands, its date in front."""
    summary = spark.read.parquet(path)
    return summary.select(date, *(name for name in summary.columns if name != date))
