"""Repeated items of a stream, dropped with a state that does not grow with the stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def first_within(arriving: DataFrame, moment: str, delay: str, *keys: str) -> DataFrame:
    """The first row of each key; a repeat within ``delay`` of it is dropped.

    The state holds a key until the watermark (the newest moment of the batches
    before, less ``delay``) passes the key's first moment plus ``delay``, so it
    holds the keys of about twice that time, however long the stream runs.  A key
    that comes back later is new again.  Rows older than the watermark are late
    and dropped.  Of repeats in one batch any may be the one that stays.
    """
    return arriving.withWatermark(moment, delay).dropDuplicatesWithinWatermark(list(keys))


def keep_first(arriving: DataFrame, moment: str, delay: str, keys: tuple[str, ...], path: str, checkpoint: str) -> StreamingQuery:
    """Append what has arrived and is no repeat to a folder, each file once."""
    return (
        first_within(arriving, moment, delay, *keys)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def held_keys(finished: StreamingQuery) -> int:
    """Keys in the state after the last batch of a run."""
    return finished.lastProgress["stateOperators"][0]["numRowsTotal"]
