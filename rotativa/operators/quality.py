"""Data-quality checks; each gives a report, none stops a job by itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rotativa.fixed import REQUIRED_COLUMNS, REQUIRED_ITEM_FIELDS
from rotativa.functions.dates import partition_date
from rotativa.functions.paths import is_storage_path
from rotativa.operators.partitions import with_levels


def missing_columns(rows: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> list[str]:
    return [name for name in required if name not in rows.columns]


def null_profile(rows: DataFrame, columns: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """Rows, and NULLs per column, in one pass."""
    return rows.agg(
        F.count("*").alias("rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"{name}_nulls") for name in columns],
    )


def is_valid_item(fields: Sequence[str] = REQUIRED_ITEM_FIELDS) -> Column:
    """Every required field is there and not empty."""
    valid = F.lit(True)
    for name in fields:
        valid = valid & F.coalesce(F.col(name) != "", F.lit(False))
    return valid


def valid_items(items: DataFrame) -> DataFrame:
    return items.where(is_valid_item())


def rejected_items(items: DataFrame) -> DataFrame:
    return items.where(~is_valid_item())


def cleaning_loss(rows: DataFrame, kept: Column) -> DataFrame:
    """Rows before and after a filter, counted in one pass."""
    return rows.agg(
        F.count("*").alias("rows_before"),
        F.count_if(kept).alias("rows_after"),
        (F.count("*") - F.count_if(kept)).alias("rows_lost"),
    )


def clean_text_violations(rows: DataFrame, text: str = "clean_text") -> DataFrame:
    """Rows, and rows whose cleaned text has a digit or an upper-case letter."""
    broken = F.col(text).rlike("[0-9]") | (F.col(text) != F.lower(text))
    return rows.agg(F.count("*").alias("rows"), F.count_if(broken).alias("violations"))


def path_report(paths: DataFrame, scheme: str = "s3://") -> DataFrame:
    return paths.withColumn("is_valid", is_storage_path(F.col("path"), scheme))


def expected_outputs(sources: DataFrame, first_date: Column, last_date: Column) -> DataFrame:
    """One row per source and day between two dates."""
    days = F.explode(F.sequence(first_date, last_date)).alias("fecha")
    return sources.select("periodico").distinct().select("periodico", days)


def missing_outputs(expected: DataFrame, listing: DataFrame) -> DataFrame:
    """Expected source days without a partition in the listing."""
    date = partition_date(F.col("year"), F.col("month"), F.col("day"))
    found = with_levels(listing).select("periodico", date.alias("fecha")).distinct()
    return expected.join(found, ["periodico", "fecha"], "left_anti")


def missing_raw_pages(expected: DataFrame, listing: DataFrame, prefix: str = "headlines/raw") -> DataFrame:
    """Expected source days without a landed raw page in the listing."""
    key = F.format_string(
        f"{prefix}/%s-%s.html", F.col("periodico"), F.date_format("fecha", "yyyy-MM-dd")
    )
    landed = listing.select("key").where(F.col("key").startswith(f"{prefix}/")).distinct()
    return expected.withColumn("key", key).join(landed, "key", "left_anti")
