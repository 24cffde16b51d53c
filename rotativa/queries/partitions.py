"""Queries over object keys, partitioned files and the catalog table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from rotativa.fixed import CSV_COLUMNS, PARTITION_COLUMNS
from rotativa.functions import paths
from rotativa.operators import partitions, reports
from rotativa.operators.schemas import read_reconciled
from rotativa.plans.headlines import refresh_catalog
from rotativa.queries.base import HEADLINES, query, table
from rotativa.queries.rows import headlines
from rotativa.session import new_folder, stored
from rotativa.sinks.files import write_headline_files, write_headline_table
from rotativa.sources.adapters import object_keys, raw_pages
from rotativa.sources.headlines import read_headline_files
from rotativa.sources.notifications import announced_objects


def keys(spark: SparkSession, folder: str) -> DataFrame:
    return object_keys(table(spark, folder, "documents"))


KEYS = """
keys AS (
    SELECT doc_id, lang, n_chars AS bytes, source, day_of,
           CASE doc_id % 12
               WHEN 5 THEN f || month(day_of) || '/day=' || dd || '/f' || doc_id || '.csv'
               WHEN 6 THEN f || mm || '/f' || doc_id || '.csv'
               WHEN 7 THEN f || '13/day=' || dd || '/f' || doc_id || '.csv'
               WHEN 8 THEN f || mm || '/day=' || dd || '=x/f' || doc_id || '.csv'
               WHEN 9 THEN f || mm || '/day=00/day=' || dd || '/f' || doc_id || '.csv'
               WHEN 10 THEN 'headlines/raw/' || source || '-' || strftime(day_of, '%Y-%m-%d') || '.html'
               ELSE f || mm || '/day=' || dd || '/f' || doc_id || '.csv'
           END AS key
    FROM (
        SELECT doc_id, lang, n_chars, source, DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS day_of,
               strftime(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER), '%m') AS mm,
               strftime(DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER), '%d') AS dd,
               'headlines/final/periodico=' || source || '/year=2024/month=' AS f
        FROM documents
    )
)"""

# Last value of a level: the part after the last '/level=', up to the next slash.
LEVELS = f"""{KEYS},
parts AS (
    SELECT *, list_filter(string_split(key, '/'), lambda x: contains(x, '=')) AS p FROM keys
),
levels AS (
    SELECT * EXCLUDE (p), len(list_distinct(list_transform(p, lambda x: string_split(x, '=')[1]))) AS level_count,
           list_filter(p, lambda x: starts_with(x, 'periodico='))[-1][11:] AS periodico,
           list_filter(p, lambda x: starts_with(x, 'year='))[-1][6:] AS year,
           list_filter(p, lambda x: starts_with(x, 'month='))[-1][7:] AS month,
           list_filter(p, lambda x: starts_with(x, 'day='))[-1][5:] AS day
    FROM parts
),
found AS (
    SELECT DISTINCT periodico, year, month, day FROM levels
    WHERE periodico IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL
)"""

REGISTERED = f"""{LEVELS},
registered AS (
    SELECT DISTINCT periodico, CASE WHEN lang = 'de' THEN '2023' ELSE year END AS year, month, day
    FROM levels WHERE lang IN ('en', 'de') AND periodico IS NOT NULL AND year IS NOT NULL
      AND month IS NOT NULL AND day IS NOT NULL AND day <> '07'
)"""


def _registered(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog entries: those of one language and those of another under a past year, one day of the month apart."""
    listed = keys(spark, folder).where(F.col("lang").isin("en", "de"))
    found = partitions.partitions_found(listed, "lang").where(F.col("day") != "07")
    return found.withColumn("year", F.when(F.col("lang") == "de", "2023").otherwise(F.col("year"))).drop("lang")


@query(
    "partition_from_path",
    f"WITH {LEVELS} SELECT doc_id, key, periodico, year, month, day, level_count FROM levels",
)
def partition_from_path(spark, folder):
    levels = keys(spark, folder).withColumn("levels", paths.partition_levels(F.col("key")))
    return levels.select(
        "doc_id",
        "key",
        *[F.col("levels")[name].alias(name) for name in PARTITION_COLUMNS],
        F.size("levels").cast("bigint").alias("level_count"),
    )


@query(
    "partition_values",
    f"""
    WITH {LEVELS}
    SELECT doc_id, coalesce(periodico, '') || '|' || coalesce(year, '') || '|' || coalesce(month, '') || '|'
                   || coalesce(day, '') AS partition_values
    FROM levels
    """,
)
def partition_values(spark, folder):
    values = paths.partition_values(paths.partition_levels(F.col("key")))
    return keys(spark, folder).select("doc_id", F.array_join(values, "|").alias("partition_values"))


@query("partitions_found", f"WITH {LEVELS} SELECT * FROM found")
def partitions_found(spark, folder):
    return partitions.partitions_found(keys(spark, folder))


@query(
    "partition_inventory",
    f"""
    WITH {LEVELS}
    SELECT periodico, year, month, day, count(*) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM levels
    WHERE periodico IS NOT NULL AND year IS NOT NULL AND month IS NOT NULL AND day IS NOT NULL GROUP BY ALL
    """,
)
def partition_inventory(spark, folder):
    return partitions.partition_inventory(keys(spark, folder))


@query(
    "partitions_missing",
    f"WITH {REGISTERED} SELECT * FROM found EXCEPT SELECT * FROM registered",
)
def partitions_missing(spark, folder):
    return partitions.partitions_missing(
        partitions.partitions_found(keys(spark, folder)), _registered(spark, folder)
    )


@query(
    "partitions_stale",
    f"WITH {REGISTERED} SELECT * FROM registered EXCEPT SELECT * FROM found",
)
def partitions_stale(spark, folder):
    return partitions.partitions_stale(
        partitions.partitions_found(keys(spark, folder)), _registered(spark, folder)
    )


@query(
    "retention_report",
    f"""
    WITH {LEVELS},
    dated AS (
        SELECT *, try_cast(year || '-' || lpad(month, 2, '0') || '-' || lpad(day, 2, '0') AS DATE) AS partition_date
        FROM found WHERE regexp_full_match(day, '[0-9]+') AND regexp_full_match(month, '[0-9]+')
    )
    SELECT * FROM dated WHERE partition_date < DATE '2024-03-01' - 30
    """,
)
def retention_report(spark, folder):
    found = partitions.partitions_found(keys(spark, folder))
    return partitions.retention_report(found, F.lit("2024-03-01").cast("date"))


@query(
    "schema_merge",
    f"""
    WITH {HEADLINES}
    SELECT fecha, categoria, titular, enlace, NULL AS periodico FROM headlines
    UNION ALL SELECT fecha, categoria, titular, enlace, periodico FROM headlines
    """,
)
def schema_merge(spark, folder):
    """Files in the four-column and in the five-column layout, read as one table."""
    rows = headlines(spark, folder)
    return partitions.merge_schemas(rows.select(*CSV_COLUMNS), rows.select(*CSV_COLUMNS, "periodico"))


@query(
    "schema_reconciled",
    """
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
           CAST(o_totalprice AS DOUBLE) AS o_totalprice,
           o_orderstatus AS status, CASE WHEN o_orderkey % 4 = 2 OR (o_orderkey % 4 = 3 AND o_custkey % 2 = 1) THEN o_orderpriority END AS priority,
           CASE o_orderkey % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'date' WHEN 2 THEN 'text' ELSE 'mixed' END AS part
    FROM orders
    """,
)
def schema_reconciled(spark, folder):
    """Orders written in four layouts, one folder holding two of them, read as one table.

    Keys are ``int`` or ``bigint``, customers numbers or text, dates dates or text; one field of the struct is not everywhere.
    """
    root = new_folder(spark, "layouts")
    orders = table(spark, folder, "orders")
    number, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    short = F.struct(F.col("o_orderstatus").alias("status"))
    long = F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderstatus").alias("status"))
    price, customer = F.col("o_totalprice"), F.col("o_custkey")
    first = [number.cast("int").alias("o_orderkey"), customer, day.alias("o_orderdate"), price, short.alias("state")]
    second = [number, customer, day.alias("o_orderdate"), price, short.alias("state")]
    third = [price, long.alias("state"), number, customer.cast("string").alias("o_custkey"), day.cast("string").alias("o_orderdate")]
    for rest, part, layouts in ((0, "int", [first]), (1, "date", [second]), (2, "text", [third]), (3, "mixed", [second, third])):
        for i, layout in enumerate(layouts):
            own = orders.where((number % 4 == rest) & (customer % len(layouts) == i))
            own.select(*layout).write.mode("append").parquet(f"{root}/part={part}")
    rows = read_reconciled(spark, root, partitions.list_files(spark, root, "*.parquet"))
    return rows.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice", "state.status", "state.priority", "part")


_ALL_HEADLINES = f"WITH {HEADLINES} SELECT * FROM headlines"


@query("csv_partition_scan", _ALL_HEADLINES)
def csv_partition_scan(spark, folder):
    """Headlines written as partitioned CSV files and read back."""
    root = new_folder(spark, "csv")
    write_headline_files(headlines(spark, folder), root)
    return read_headline_files(spark, root)


@query("partition_write_roundtrip", _ALL_HEADLINES)
def partition_write_roundtrip(spark, folder):
    """Headlines written twice as a partitioned table: a repeated run replaces its days."""
    root = new_folder(spark, "table")
    rows = headlines(spark, folder)
    write_headline_table(rows, root)
    write_headline_table(rows.where(F.col("month") == "02"), root)
    return spark.read.schema(rows.schema).parquet(root)


@query(
    "catalog_scan",
    f"""
    WITH {HEADLINES}
    SELECT periodico, count(*) AS total_noticias FROM headlines WHERE year = '2024' AND month = '01' GROUP BY periodico
    """,
)
def catalog_scan(spark, folder):
    """Partitioned files registered as a catalog table and queried through it."""
    root = new_folder(spark, "catalog")
    write_headline_files(headlines(spark, folder), root)
    # The database is only a name in the session's catalog; its data are the files above.
    database = f"news_{uuid.uuid4().hex}"
    registered = refresh_catalog(spark, database, root)
    counted = stored(reports.count_by_source_in_month(registered, 2024, 1), "catalog-counts")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return counted


@query(
    "catalog_report",
    f"""
    WITH {HEADLINES}, parts AS (SELECT DISTINCT periodico, year, month, day FROM headlines)
    SELECT 'headlines' AS "table", 'periodico,year,month,day' AS keys, count(*) AS partitions FROM parts
    """,
)
def catalog_report(spark, folder):
    """The registered tables of a database, with their keys and numbers of partitions."""
    root, database = new_folder(spark, "catalog"), f"news_{uuid.uuid4().hex}"
    write_headline_files(headlines(spark, folder), root)
    refresh_catalog(spark, database, root)
    report = partitions.table_report(spark, database).drop("location")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return report


@query(
    "partitions_repaired",
    f"WITH {HEADLINES} SELECT DISTINCT periodico, year, month, day FROM headlines WHERE month = '02'",
)
def partitions_repaired(spark, folder):
    """What a repair adds once February has been written beside January."""
    root, database = new_folder(spark, "catalog"), f"news_{uuid.uuid4().hex}"
    rows = headlines(spark, folder)
    write_headline_files(rows.where(F.col("month") != "02"), root)
    refresh_catalog(spark, database, root)
    write_headline_files(rows.where(F.col("month") == "02"), root)
    added = stored(partitions.repair_partitions(spark, database, "headlines"), "repaired")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return added


@query("partitions_registered", f"WITH {LEVELS} SELECT * FROM found")
def partitions_registered(spark, folder):
    """What the catalog holds once the keys of half of the documents, then of all, have been registered."""
    root, database = new_folder(spark, "catalog"), f"news_{uuid.uuid4().hex}"
    partitions.ensure_database(spark, database)
    partitions.recreate_table(spark, database, "headlines", root)
    arrived = keys(spark, folder)
    for listing in (arrived.where("doc_id % 2 = 0"), arrived):
        partitions.register_partitions(spark, database, "headlines", partitions.partitions_found(listing))
    held = stored(partitions.registered_partitions(spark, database, "headlines"), "registered")
    spark.sql(f"DROP DATABASE `{database}` CASCADE")
    return held


# --- notifications ------------------------------------------------------------


def _notifications(spark: SparkSession, folder: str) -> DataFrame:
    """One notification per page: one record, two records, or a record without an object."""
    raw = raw_pages(table(spark, folder, "pages"))

    def record(path):
        return F.concat(F.lit('{"s3":{"bucket":{"name":"'), "host", F.lit('"},"object":{"key":"'), path, F.lit('"}}}'))

    whole = record(F.col("path"))
    copy = record(F.concat(F.lit("copy/"), "path"))
    body = (
        F.when(F.col("page_id") % 5 == 3, F.concat(F.lit('{"Records":['), whole, F.lit(","), copy, F.lit("]}")))
        .when(F.col("page_id") % 5 == 4, F.concat(F.lit('{"Records":[{"s3":{"bucket":{"name":"'), "host", F.lit('"}}}]}')))
        .when(F.col("page_id") % 5 == 2, F.concat(F.lit('{"test":true,"manual":"'), "host", F.lit('"}')))
        .otherwise(F.concat(F.lit('{"Records":['), whole, F.lit("]}")))
    )
    return raw.select(body.alias("body"))


_NOTIFIED = """
WITH notified AS (
    SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS bucket,
           'raw/' || regexp_extract(url, '^https?://([^/?#]+)', 1) || '-2024-01-'
               || lpad(CAST(page_id % 30 + 1 AS VARCHAR), 2, '0') || '.html' AS key
    FROM pages WHERE page_id % 5 NOT IN (2, 4)
)
SELECT bucket, key FROM notified
"""


@query("event_flatten", _NOTIFIED + " UNION ALL SELECT bucket, 'copy/' || key FROM notified WHERE page_id % 5 = 3")
def event_flatten(spark, folder):
    return announced_objects(_notifications(spark, folder))


@query("event_first_record", _NOTIFIED)
def event_first_record(spark, folder):
    return announced_objects(_notifications(spark, folder), first_only=True)
