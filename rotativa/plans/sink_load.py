"""Headline rows to the relational sink, in one pass and one write."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F

from rotativa.operators.clean import sink_rows, valid_rows
from rotativa.operators.dedupe import absent_from


def load_sink(headlines: DataFrame, write: Callable[[DataFrame], None], held: DataFrame | None = None) -> dict[str, int]:
    """Clean, drop what the sink holds already, write, and return the row counts.

    Rows read and rows written are observed while the data pass through.  Nothing
    is written when no valid row comes in; one valid row is enough to know, so
    that check reads no further.
    """
    if valid_rows(headlines).isEmpty():
        return {"read": headlines.count(), "written": 0}
    read, written = Observation("read"), Observation("written")
    rows = sink_rows(headlines.observe(read, F.count("*").alias("rows")))
    if held is not None:
        rows = absent_from(rows, held)
    write(rows.observe(written, F.count("*").alias("rows")))
    return {"read": read.get["rows"], "written": written.get["rows"]}
