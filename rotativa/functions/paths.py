"""Object-path expressions: names, formats, sources, partition levels."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

from rotativa.fixed import PARTITION_COLUMNS, SITES, UNKNOWN_SOURCE

SOURCE_NAMES = tuple((site.name, site.name) for site in SITES)
SOURCE_DOMAINS = tuple((site.domain, site.name) for site in SITES)


def is_html_name(path: Column, *, ignore_case: bool = True) -> Column:
    return path.rlike(r"(?i)\.html$") if ignore_case else path.endswith(".html")


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_base_name(path: Column) -> Column:
    """Last path segment without any ``.html``."""
    return F.replace(last_segment(path), F.lit(".html"), F.lit(""))


def file_format(path: Column) -> Column:
    """Text after the last dot."""
    return F.element_at(F.split(path, r"\."), -1)


def is_storage_path(path: Column, scheme: str = "s3://") -> Column:
    return path.startswith(scheme) & (F.size(F.split(path, "/")) >= 3)


def detect_source(text: Column, patterns: Sequence[tuple[str, str]] = SOURCE_NAMES) -> Column:
    """First source whose pattern occurs in the lower-cased text, else unknown."""
    lowered = F.lower(text)
    return reduce(
        lambda rest, pair: F.when(lowered.contains(pair[0]), F.lit(pair[1])).otherwise(rest),
        reversed(list(patterns)),
        F.lit(UNKNOWN_SOURCE),
    )


def date_in_name(path: Column) -> Column:
    """The first valid ``YYYY-MM-DD`` in a file name, else NULL."""
    # a look-ahead, so that a date that begins inside another match is found as well
    found = F.regexp_extract_all(last_segment(path), F.lit(r"(?=(\d{4}-\d{2}-\d{2}))"), F.lit(1))
    dates = F.transform(found, lambda text: F.try_to_date(text, "yyyy-MM-dd"))
    return F.get(F.filter(dates, lambda date: date.isNotNull()), F.lit(0))


def partition_levels(path: Column) -> Column:
    """Map of the ``name=value`` parts of a path; a repeated name keeps its last value."""
    parts = F.filter(F.split(path, "/"), lambda part: part.contains("="))
    pairs = F.transform(
        F.reverse(parts),
        lambda part: F.struct(
            F.substring_index(part, "=", 1).alias("key"),
            F.substr(part, F.instr(part, "=") + 1).alias("value"),
        ),
    )
    names = F.transform(pairs, lambda pair: pair["key"])
    latest = F.filter(pairs, lambda pair, i: F.array_position(names, pair["key"]) == i + 1)
    return F.map_from_entries(latest)


def level_value(path: Column, name: str) -> Column:
    """Value of one partition level of a path, the last one if repeated, NULL if there is none."""
    pattern = rf"(?:^|/){name}=([^/]*)(?!.*/{name}=)"
    return F.when(path.rlike(pattern), F.regexp_extract(path, pattern, 1))


def partition_values(levels: Column) -> Column:
    """The four partition values in order; a missing one is empty."""
    return F.array(*[F.coalesce(levels[name], F.lit("")) for name in PARTITION_COLUMNS])
