"""Raw pages: scan of landed HTML files, landing as a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rotativa.functions.paths import date_in_name, detect_source, file_base_name
from rotativa.schema import RAW_PAGES
from rotativa.session import stored


HTML_NAMES = "*.[hH][tT][mM][lL]"
SENT_PATHS = 100_000  # paths that may be sent to all tasks; more are joined by shuffling


def read_page_files(spark: SparkSession, root: str, *, ignore_case: bool = True) -> DataFrame:
    """``path, modified, content`` of every HTML file below ``root``; other files are listed and not read.

    The listing is recursive and complete, however many files there are; a file of
    no bytes gives no row.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", HTML_NAMES if ignore_case else "*.html")
        .load(root)
        .select("path", F.col("modificationTime").alias("modified"), "content")
    )


def page_of(path: Column) -> Column:
    """What makes two files the same page: the path, whatever its case."""
    return F.lower(path)


def newest_files(files: DataFrame) -> DataFrame:
    """Files without those that a later file of the same page replaces.

    Only paths and times are compared; the files to leave out are stored, and few
    of them are sent to all tasks.
    """
    names = files.select("path", "modified")
    newest = names.groupBy(page_of(F.col("path")).alias("page")).agg(
        F.max(F.struct("modified", "path")).alias("newest"), F.count("*").alias("files")
    )
    replaced = (
        names.join(newest.where("files > 1"), page_of(F.col("path")) == F.col("page"))
        .where(F.col("newest.path") != F.col("path"))
        .select("path")
    )
    replaced = stored(replaced, "replaced-files")
    few = replaced.count() <= SENT_PATHS
    return files.join(F.broadcast(replaced) if few else replaced, "path", "left_anti")


def decode_pages(files: DataFrame) -> DataFrame:
    """``path, source, fetch_date, html``; a body that is not UTF-8 has NULL ``html``.

    The time of a file, ``modified``, and why it has no body, ``refused``, are passed on if they are known.
    """
    name = file_base_name(F.col("path"))
    return files.select(
        "path",
        *(name for name in ("modified", "refused") if name in files.columns),
        detect_source(name).alias("source"),
        date_in_name(F.col("path")).alias("fetch_date"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("html"),
    )


def readable_pages(pages: DataFrame) -> DataFrame:
    """Pages that have a body."""
    return pages.where(F.col("html").isNotNull() & (F.col("html") != ""))


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Per source, pages read and pages without a readable body."""
    unreadable = F.col("html").isNull() | (F.col("html") == "")
    return pages.groupBy("source").agg(
        F.count("*").alias("pages"), F.count_if(unreadable).alias("rejected")
    )


def land_pages(pages: DataFrame, path: str) -> None:
    """Write raw pages as a table by date and source; a landed day is replaced."""
    (
        pages.select(*RAW_PAGES.fieldNames())
        .hint("rebalance", "fetch_date", "source")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("fetch_date", "source")
        .parquet(path)
    )
