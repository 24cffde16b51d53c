"""Relational source over JDBC, and the schema map of a set of tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SCHEMA_MAP = T.StructType(
    [
        T.StructField("table", T.StringType(), False),
        T.StructField("position", T.IntegerType(), False),
        T.StructField("column", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
    ]
)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    user: str,
    password: str,
    driver: str = "com.mysql.cj.jdbc.Driver",
    date_column: str | None = "fecha",
    first_date: str | None = None,
    last_date: str | None = None,
    connections: int = 16,
) -> DataFrame:
    """A relational table, read over several connections when a date range is given."""
    options = {"url": url, "dbtable": table, "user": user, "password": password, "driver": driver}
    if date_column and first_date and last_date:
        options |= {
            "partitionColumn": date_column,
            "lowerBound": first_date,
            "upperBound": last_date,
            "numPartitions": str(connections),
        }
    return spark.read.format("jdbc").options(**options).load()


def schema_map(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table, position, column, type`` of every column; reads no data."""
    rows = [
        (name, position, field.name, field.dataType.simpleString())
        for name, table in tables.items()
        for position, field in enumerate(table.schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, SCHEMA_MAP)


def unexpected_columns(found: DataFrame, expected: DataFrame) -> DataFrame:
    """Columns of ``expected`` that ``found`` lacks or holds with another type."""
    keys = ["table", "column", "type"]
    return expected.select(*keys).join(found.select(*keys), keys, "left_anti").orderBy(*keys)
