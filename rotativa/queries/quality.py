"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rotativa.functions import paths
from rotativa.operators import clean, quality
from rotativa.queries.base import CLEAN, HEADLINES, query
from rotativa.queries.partitions import LEVELS, keys
from rotativa.queries.rows import headlines


def _expected(spark: SparkSession, folder: str) -> DataFrame:
    """Every source on each of the sixty publication days."""
    first, last = F.lit("2024-01-01").cast("date"), F.lit("2024-02-29").cast("date")
    return quality.expected_outputs(headlines(spark, folder), first, last)


@query(
    "missing_outputs",
    f"""
    WITH {LEVELS},
    expected AS (
        SELECT DISTINCT source AS periodico, unnest(range(0, 60)) AS n FROM documents
    )
    SELECT periodico, DATE '2024-01-01' + CAST(n AS INTEGER) AS fecha FROM expected
    EXCEPT
    SELECT periodico, try_cast(year || '-' || lpad(month, 2, '0') || '-' || lpad(day, 2, '0') AS DATE)
    FROM found WHERE regexp_full_match(day, '[0-9]+')
    """,
)
def missing_outputs(spark, folder):
    return quality.missing_outputs(_expected(spark, folder), keys(spark, folder))


@query(
    "missing_raw_pages",
    f"""
    WITH {LEVELS},
    expected AS (
        SELECT DISTINCT source AS periodico, unnest(range(0, 60)) AS n FROM documents
    ),
    dated AS (
        SELECT periodico, DATE '2024-01-01' + CAST(n AS INTEGER) AS fecha FROM expected
    ),
    named AS (
        SELECT *, 'headlines/raw/' || periodico || '-' || strftime(fecha, '%Y-%m-%d') || '.html' AS key FROM dated
    )
    SELECT key, periodico, fecha FROM named WHERE key NOT IN (SELECT key FROM keys)
    """,
)
def missing_raw_pages(spark, folder):
    return quality.missing_raw_pages(_expected(spark, folder), keys(spark, folder))


@query(
    "null_profile",
    f"""
    WITH {HEADLINES}
    SELECT count(*) AS rows, count(*) - count(categoria) AS categoria_nulls, count(*) - count(titular) AS titular_nulls,
           count(*) - count(enlace) AS enlace_nulls, count(*) - count(fecha) AS fecha_nulls,
           count(*) - count(periodico) AS periodico_nulls
    FROM headlines
    """,
)
def null_profile(spark, folder):
    return quality.null_profile(headlines(spark, folder))


@query(
    "valid_items",
    f"""
    WITH {HEADLINES}
    SELECT * FROM headlines WHERE categoria <> '' AND titular <> '' AND enlace <> ''
    """,
)
def valid_items(spark, folder):
    return quality.valid_items(headlines(spark, folder))


@query(
    "rejected_items",
    f"""
    WITH {HEADLINES}
    SELECT * FROM headlines WHERE NOT coalesce(categoria <> '' AND titular <> '' AND enlace <> '', false)
    """,
)
def rejected_items(spark, folder):
    return quality.rejected_items(headlines(spark, folder))


@query(
    "cleaning_loss",
    f"""
    WITH {CLEAN}
    SELECT (SELECT count(*) FROM headlines) AS rows_before, count(*) AS rows_after,
           (SELECT count(*) FROM headlines) - count(*) AS rows_lost
    FROM clean
    """,
)
def cleaning_loss(spark, folder):
    kept = clean.is_classifier_row(F.col("categoria"), F.col("titular"))
    return quality.cleaning_loss(headlines(spark, folder), kept)


@query(
    "clean_text_invariant",
    f"""
    WITH {CLEAN}
    SELECT count(*) AS rows, count(*) FILTER (regexp_matches(clean_text, '[0-9]') OR clean_text <> lower(clean_text)) AS violations
    FROM clean
    """,
)
def clean_text_invariant(spark, folder):
    return quality.clean_text_violations(clean.classifier_rows(headlines(spark, folder)))


@query(
    "path_validation",
    f"""
    WITH {LEVELS},
    listed AS (
        SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN key ELSE 's3://bucket/' || key END AS path FROM keys
    )
    SELECT doc_id, path, starts_with(path, 's3://') AND len(string_split(path, '/')) >= 3 AS is_valid FROM listed
    """,
)
def path_validation(spark, folder):
    path = F.when(F.col("doc_id") % 3 == 0, F.col("key")).otherwise(F.concat(F.lit("s3://bucket/"), "key"))
    return quality.path_report(keys(spark, folder).select("doc_id", path.alias("path")))


@query(
    "file_format",
    f"WITH {LEVELS} SELECT doc_id, string_split(key, '.')[-1] AS file_format FROM keys",
)
def file_format(spark, folder):
    return keys(spark, folder).select("doc_id", paths.file_format(F.col("key")).alias("file_format"))
