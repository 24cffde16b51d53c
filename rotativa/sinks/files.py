"""Partitioned headline files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rotativa.fixed import CSV_COLUMNS, PARTITION_COLUMNS
from rotativa.functions.dates import date_parts, parse_date
from rotativa.sources.headlines import CSV_OPTIONS

# A file with embedded line breaks is read by one task, so files stay small.
ROWS_PER_FILE = 500_000

# fixed values: characters that a folder name holds as their code
ESCAPED = "\"#%'*/:=?\\{[]^"


def with_partition_columns(headlines: DataFrame) -> DataFrame:
    """Padded ``year, month, day`` of each row's date."""
    return headlines.withColumns(date_parts(parse_date(F.col("fecha").cast("string"))))


def _partitioned(rows: DataFrame, rows_per_file: int):
    """Writer with rows gathered by partition.

    The rebalance hint brings the rows of a partition together so that each
    folder gets few files, and lets adaptive execution split a partition that
    holds far more than the others.  Only the partitions present are replaced.
    """
    return (
        rows.hint("rebalance", *PARTITION_COLUMNS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", rows_per_file)
        .partitionBy(*PARTITION_COLUMNS)
    )


def write_headline_files(headlines: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Headline files with a header, in one folder per source and day.

    A CSV file does not tell an empty text from a missing one; it reads as NULL.
    """
    rows = headlines.select(*CSV_COLUMNS, *PARTITION_COLUMNS)
    _partitioned(rows, rows_per_file).options(**CSV_OPTIONS).csv(path)


def write_headline_table(headlines: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """The same folders as Parquet: splittable, typed and pruned by column."""
    _partitioned(headlines, rows_per_file).parquet(path)


def partition_folder(values: Sequence[str | None], names: Sequence[str] = PARTITION_COLUMNS) -> str:
    """The folder of a partition below its dataset's root, as Spark writes it."""
    def written(value: str | None) -> str:
        if not value:
            return "__HIVE_DEFAULT_PARTITION__"
        return "".join(f"%{ord(c):02X}" if c in ESCAPED or ord(c) < 32 or ord(c) == 127 else c for c in value)

    return "/".join(f"{name}={written(value)}" for name, value in zip(names, values))
