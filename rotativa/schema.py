"""Schemas of the data sets and the DDL derived from them."""

from __future__ import annotations

from pyspark.sql import types as T

from rotativa.fixed import CSV_COLUMNS, PARTITION_COLUMNS


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), True) for name in names]


HEADLINE_FILE = T.StructType(_strings(*CSV_COLUMNS))
HEADLINES = T.StructType(_strings(*CSV_COLUMNS, *PARTITION_COLUMNS))
RAW_PAGES = T.StructType(
    [
        T.StructField("path", T.StringType(), True),
        T.StructField("source", T.StringType(), True),
        T.StructField("fetch_date", T.DateType(), True),
        T.StructField("html", T.StringType(), True),
    ]
)
NEWS = T.StructType(
    [
        T.StructField("fecha", T.DateType(), True),
        T.StructField("categoria", T.StringType(), True),
        T.StructField("titular", T.StringType(), True),
        T.StructField("enlace", T.StringType(), True),
        T.StructField("periodico", T.StringType(), True),
    ]
)

# Column types of the relational sink, for the JDBC writer's first write.  The
# writer takes Spark's type names only, of which none is an unbounded text: title
# and link are left to it, and get the database's own (TEXT, LONGTEXT).
SINK_COLUMN_TYPES = "fecha DATE, categoria VARCHAR(255), periodico VARCHAR(100)"

NOTIFICATION = (
    "Records ARRAY<STRUCT<s3: STRUCT<bucket: STRUCT<name: STRING>, object: STRUCT<key: STRING>>>>"
)
