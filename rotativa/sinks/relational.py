"""Relational sink over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame

from rotativa.schema import SINK_COLUMN_TYPES


def jdbc_options(
    url: str,
    table: str,
    *,
    user: str,
    password: str,
    driver: str = "com.mysql.cj.jdbc.Driver",
    rows_per_batch: int = 10_000,
    connections: int = 16,
    column_types: str = SINK_COLUMN_TYPES,
) -> dict[str, str]:
    """Options of the writer: batched inserts over a bounded number of connections.

    ``column_types`` shapes the table when the first write creates it.
    """
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(rows_per_batch),
        "numPartitions": str(connections),
        "createTableColumnTypes": column_types,
    }


def append_jdbc(rows: DataFrame, options: dict[str, str]) -> None:
    rows.write.format("jdbc").options(**options).mode("append").save()
