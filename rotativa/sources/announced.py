"""Objects that notifications announce, fetched by their keys: no folder is listed."""

from __future__ import annotations

from math import ceil

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from rotativa.functions.paths import is_html_name
from rotativa.session import reading, stored

OBJECTS_PER_TASK = 500
BATCH_BYTES = 16 << 20  # of bodies that leave a task at once; a larger body leaves alone
ABSENT, NOT_A_PAGE = "absent", "not a page"

_FETCHED = "path STRING, modified TIMESTAMP, content BINARY, refused STRING"
_ARROW = pa.schema(
    [
        ("path", pa.string()),
        ("modified", pa.timestamp("us", tz="UTC")),
        ("content", pa.binary()),
        ("refused", pa.string()),
    ]
)


def _content(system: fs.FileSystem, base: str, key: str):
    """Time and body of an object, or None if there is none; any other failure is the task's."""
    if ".." in key.split("/"):  # would leave the bucket
        return None
    place = f"{base.rstrip('/')}/{key}"
    info = system.get_file_info(place)
    if info.type != fs.FileType.File:
        return None
    try:
        with system.open_input_stream(place) as stream:
            return info.mtime, stream.read()
    except FileNotFoundError:  # gone since
        return None


def fetch_pages(objects: DataFrame, store: str) -> DataFrame:
    """``path, modified, content, refused`` of the distinct ``bucket, key``; ``refused`` says why there is no body.

    ``store`` is what stands before a bucket's name, such as ``s3://``.  The tasks
    fetch the bodies, each a bounded number, so no path goes through the driver.
    Objects whose names are not those of pages are not fetched.  The result reads
    the stored keys, ``working_tables``.
    """
    keys = stored(objects.where("bucket IS NOT NULL AND key IS NOT NULL").distinct(), "announced")
    count, spread = keys.count(), keys.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, ceil(count / OBJECTS_PER_TASK), min(count, spread))

    def fetch(batches):
        places, rows, size = {}, [], 0
        for batch in batches:
            for bucket, key, page in zip(*(batch.column(name).to_pylist() for name in ("bucket", "key", "page"))):
                if bucket not in places:
                    places[bucket] = fs.FileSystem.from_uri(store + bucket)
                found = _content(*places[bucket], key) if page else None
                modified, content = found or (None, None)
                refused = None if found else ABSENT if page else NOT_A_PAGE
                rows.append({"path": f"{store}{bucket}/{key}", "modified": modified, "content": content, "refused": refused})
                size += len(content or b"")
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)
                    rows, size = [], 0
        yield pa.RecordBatch.from_pylist(rows, schema=_ARROW)

    spread_keys = keys.withColumn("page", is_html_name(F.col("key"))).repartition(tasks, "bucket", "key")
    return reading(spread_keys.mapInArrow(fetch, _FETCHED), keys)
