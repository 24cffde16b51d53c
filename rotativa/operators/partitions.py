"""Partition upkeep over listings of object keys, and the catalog table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rotativa.fixed import CSV_COLUMNS, PARTITION_COLUMNS, RETENTION_DAYS
from rotativa.functions.dates import partition_date
from rotativa.functions.paths import level_value
from rotativa.sources.headlines import CSV_OPTIONS

KEYS = list(PARTITION_COLUMNS)
PARTITIONS_AT_ONCE = 200  # in one statement


# --- listings -----------------------------------------------------------------


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """``key, bytes`` of every file below ``root``; file contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(root)
    )
    return files.select(F.col("path").alias("key"), F.col("length").alias("bytes"))


def with_levels(listing: DataFrame) -> DataFrame:
    """Listing with one column per partition level, NULL where the key has none."""
    return listing.withColumns({name: level_value(F.col("key"), name) for name in KEYS})


def _partitioned(listing: DataFrame) -> DataFrame:
    marked = F.lit(True)
    for name in KEYS:
        marked = marked & F.col("key").contains(f"/{name}=")
    return with_levels(listing.where(marked))


def partitions_found(listing: DataFrame, *also: str) -> DataFrame:
    """Distinct partitions of the keys that have all four levels, with further columns if named."""
    return _partitioned(listing).select(*KEYS, *also).distinct()


def partition_inventory(listing: DataFrame) -> DataFrame:
    """Files and bytes per partition."""
    return _partitioned(listing).groupBy(*KEYS).agg(
        F.count("*").alias("files"), F.sum("bytes").alias("bytes")
    )


def partitions_missing(found: DataFrame, registered: DataFrame) -> DataFrame:
    """Found but not registered: to be added."""
    return found.select(*KEYS).join(registered.select(*KEYS).distinct(), KEYS, "left_anti")


def partitions_stale(found: DataFrame, registered: DataFrame) -> DataFrame:
    """Registered but no longer found: reported, never dropped."""
    return registered.select(*KEYS).distinct().join(found.select(*KEYS), KEYS, "left_anti")


def retention_report(partitions: DataFrame, as_of: Column, days_to_keep: int = RETENTION_DAYS) -> DataFrame:
    """Partitions older than the days to keep; those without a calendar date are left out.

    ``as_of`` is a date or a moment; a day counts as old from its first instant.
    """
    date = partition_date(F.col("year"), F.col("month"), F.col("day"))
    dated = partitions.where(F.col("periodico").isNotNull()).withColumn("partition_date", date)
    return dated.where(F.col("partition_date") < as_of - F.make_dt_interval(days=F.lit(days_to_keep)))


def merge_schemas(*parts: DataFrame) -> DataFrame:
    """Union by column name; a column a part lacks is NULL there."""
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part, allowMissingColumns=True)
    return merged


# --- catalog ------------------------------------------------------------------


def ensure_database(spark: SparkSession, database: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")


def recreate_table(spark: SparkSession, database: str, table: str, location: str) -> None:
    """Define the headline table over a folder of partitioned files; files stay untouched."""
    columns = ", ".join(f"{name} STRING" for name in (*CSV_COLUMNS, *PARTITION_COLUMNS))
    options = ", ".join(f"'{key}' = '{value}'" for key, value in CSV_OPTIONS.items())
    spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
    spark.sql(
        f"CREATE TABLE `{database}`.`{table}` ({columns}) USING csv OPTIONS ({options}) "
        f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)}) LOCATION '{location}'"
    )


def repair_partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Register every partition folder that is not registered yet, and return those; none is dropped."""
    before = registered_partitions(spark, database, table)
    spark.sql(f"MSCK REPAIR TABLE `{database}`.`{table}` ADD PARTITIONS")
    return partitions_missing(registered_partitions(spark, database, table), before)


def register_partitions(spark: SparkSession, database: str, table: str, found: DataFrame, at_once: int = PARTITIONS_AT_ONCE) -> int:
    """Register the found partitions that the catalog does not have, and return how many.

    ``found`` is what arrived (announced keys, written rows), so nothing is listed:
    the difference of two small tables goes to the catalog in batches.  Partitions
    that are there already, and a run that is repeated, change nothing.
    """
    missing = partitions_missing(found.distinct(), registered_partitions(spark, database, table))
    wanted = [tuple(row) for row in missing.where(" AND ".join(f"{name} <> ''" for name in KEYS)).collect()]

    def clause(values: tuple[str, ...]) -> str:
        pairs = (f"{name} = '{_quoted(value)}'" for name, value in zip(KEYS, values))
        return f"PARTITION ({', '.join(pairs)})"

    for low in range(0, len(wanted), at_once):
        clauses = " ".join(map(clause, wanted[low : low + at_once]))
        spark.sql(f"ALTER TABLE `{database}`.`{table}` ADD IF NOT EXISTS {clauses}")
    return len(wanted)


def _quoted(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def table_report(spark: SparkSession, database: str) -> DataFrame:
    """Each table of a database: name, location, partition keys, number of partitions."""
    rows = []
    for entry in spark.catalog.listTables(f"`{database}`"):
        described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED `{database}`.`{entry.name}`").collect()}
        keys = [c.name for c in spark.catalog.listColumns(f"`{database}`.`{entry.name}`") if c.isPartition]
        count = spark.sql(f"SHOW PARTITIONS `{database}`.`{entry.name}`").count() if keys else 0
        rows.append((entry.name, described.get("Location"), ",".join(keys), count))
    return spark.createDataFrame(rows, "table STRING, location STRING, keys STRING, partitions BIGINT")


def registered_partitions(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Partitions in the catalog; empty when there is no such table."""
    if not spark.catalog.tableExists(f"`{database}`.`{table}`"):
        return spark.createDataFrame([], ", ".join(f"{name} STRING" for name in KEYS))
    listing = spark.sql(f"SHOW PARTITIONS `{database}`.`{table}`").withColumnRenamed("partition", "key")
    # the catalog lists values as folder names, in which some characters stand as their code
    plain = (F.url_decode(F.replace(F.col(name), F.lit("+"), F.lit("%2B"))).alias(name) for name in KEYS)
    return with_levels(listing).select(*plain)


def drop_stray_tables(spark: SparkSession, database: str, tables: Sequence[str]) -> None:
    for table in tables:
        spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table}`")
