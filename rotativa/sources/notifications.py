"""Object-created notifications: one row per announced object."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rotativa.schema import NOTIFICATION


def parse_notification(body: Column) -> Column:
    return F.from_json(body, NOTIFICATION)


def is_valid_notification(event: Column) -> Column:
    """``Records`` is there and each record names a bucket and an object."""
    complete = F.forall(
        event["Records"],
        lambda record: record["s3"]["bucket"].isNotNull() & record["s3"]["object"].isNotNull(),
    )
    return F.coalesce(event["Records"].isNotNull() & complete, F.lit(False))


def announced_objects(notifications: DataFrame, body: str = "body", *, first_only: bool = False) -> DataFrame:
    """``bucket, key`` of the objects in valid notifications.

    ``first_only`` keeps the first record of each notification.
    """
    events = notifications.select(parse_notification(F.col(body)).alias("event"))
    records = F.slice(F.col("event.Records"), 1, 1) if first_only else F.col("event.Records")
    return (
        events.where(is_valid_notification(F.col("event")))
        .select(F.explode(records).alias("record"))
        .select(
            F.col("record.s3.bucket.name").alias("bucket"),
            F.col("record.s3.object.key").alias("key"),
        )
    )
