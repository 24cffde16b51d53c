"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_date(text: Column) -> Column:
    """Date from text; anything that is not a date is NULL (a plain cast would raise)."""
    return text.try_cast("date")


def date_parts(date: Column) -> dict[str, Column]:
    """Zero-padded year, month and day, as the partition columns hold them."""
    return {
        "year": F.date_format(date, "yyyy"),
        "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd"),
    }


def partition_date(year: Column, month: Column, day: Column) -> Column:
    """Date of a partition, padded or not; NULL when the three are no calendar date."""
    y, m, d = (part.try_cast("int") for part in (year, month, day))
    text = F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), m.cast("string"), d.cast("string"))
    return F.when(y.between(1, 9999) & m.isNotNull() & d.isNotNull(), F.try_to_date(text, "yyyy-M-d"))
