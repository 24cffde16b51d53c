"""Headline files and tables: partitioned CSV, catalog table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rotativa.schema import HEADLINES

# How headline files are quoted.  Embedded quotes are doubled, embedded line
# breaks are kept, and surrounding white space belongs to the value.
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def read_headline_files(spark: SparkSession, root: str) -> DataFrame:
    """All headline files below ``root``, with the partition columns of their folders.

    The schema is given, so nothing is inferred, padded partition values stay
    text, and files with or without the redundant fifth column read alike.
    """
    return spark.read.schema(HEADLINES).options(**CSV_OPTIONS).csv(root)
