"""Landed pages to headline rows to the partitioned dataset and its catalog table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rotativa.fixed import CSV_COLUMNS, EL_ESPECTADOR, EL_TIEMPO, PARTITION_COLUMNS, Site
from rotativa.functions.outline import page_outline
from rotativa.functions.paths import SOURCE_NAMES
from rotativa.operators.extract import (
    headlines_of,
    kept_items,
    page_items_by_markup,
    page_items_generic,
    reject_reason,
    rejected,
    rejected_items,
    stamp,
    with_source,
)
from rotativa.operators.partitions import ensure_database, recreate_table, repair_partitions
from rotativa.session import discard, remove_folder, stored
from rotativa.sinks.files import partition_folder, with_partition_columns, write_headline_files
from rotativa.sources.announced import fetch_pages
from rotativa.sources.notifications import announced_objects
from rotativa.sources.pages import decode_pages, newest_files, page_of, read_page_files, readable_pages
from rotativa.streaming.incremental import stream_identity
from rotativa.streaming.ingest import arriving_page_files


def extract_headlines(
    pages: DataFrame,
    run_date: str,
    *,
    generic: bool = False,
    always_run_date: bool = False,
    exact_address: bool = True,
    sites: tuple[Site, Site] = (EL_TIEMPO, EL_ESPECTADOR),
    names: Sequence[tuple[str, str]] = SOURCE_NAMES,
    domains: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Headline rows of ``pages`` (``path, html``), with their partition columns.

    ``generic`` picks the generic markup profiles instead of the site-specific ones.
    ``domains`` finds the source of a page with an unknown name by what it mentions.
    ``always_run_date`` dates every row with the run instead of the file name.
    """
    outlined, items = _with_items(
        pages, generic=generic, exact_address=exact_address, sites=sites, names=names, domains=domains
    )
    rows = stamp(headlines_of(outlined.drop("html"), items), run_date, always_run_date=always_run_date)
    return with_partition_columns(rows).select(
        "path", "position", *CSV_COLUMNS, *PARTITION_COLUMNS
    )


def _with_items(
    pages: DataFrame,
    *,
    generic: bool = False,
    exact_address: bool = True,
    sites: tuple[Site, Site] = (EL_TIEMPO, EL_ESPECTADOR),
    names: Sequence[tuple[str, str]] = SOURCE_NAMES,
    domains: Sequence[tuple[str, str]] | None = None,
    known_only: bool = True,
    judge: bool = False,
) -> tuple[DataFrame, Column]:
    """Pages with source and outline, and the expression of their headlines."""
    sourced = with_source(pages, names, domains)
    body = F.col("html")
    if generic:  # an unknown source has no generic profile: its pages leave, or at least are not parsed
        known = F.col("periodico").isin([site.name for site in sites])
        sourced = sourced.where(known) if known_only else sourced
        body = body if known_only else F.when(known | (body == ""), body).when(body.isNotNull(), "<p></p>")
    outlined = sourced.withColumn("outline", page_outline(body))
    outline, source = F.col("outline"), F.col("periodico")
    items = (
        page_items_generic(outline, source, *sites, judge=judge)
        if generic
        else page_items_by_markup(outline, source, *sites, exact_address=exact_address, judge=judge)
    )
    return outlined, items


def page_rejects(pages: DataFrame, **options) -> DataFrame:
    """``path, reason`` of each page (``path, html`` as decoded) that gives no headline."""
    return rejected(*_with_items(pages, known_only=False, **options))


def _judged_pages(pages: DataFrame, **options) -> DataFrame:
    """Pages (decoded) with their judged ``items`` and, if none is kept, the ``reason``; for storing, from one parse."""
    outlined, items = _with_items(pages, known_only=False, judge=True, **options)
    found = outlined.withColumn("items", items)
    return found.withColumn("reason", reject_reason(kept_items(F.col("items")))).drop("html", "outline")


def process_pages(
    spark: SparkSession,
    raw_root: str,
    output_root: str,
    run_date: str,
    rejects_root: str | None = None,
    item_rejects_root: str | None = None,
    **options,
) -> None:
    """Read landed pages, extract their headlines and write the partitioned dataset.

    Each page gives headlines or, with ``rejects_root``, a row there with the reason
    why not; ``item_rejects_root`` gets the items that are no headlines, each with its
    reason.  All come from one parse, whose results are stored per page.  Of files
    that are the same page the newest counts.
    """
    pages = decode_pages(newest_files(read_page_files(spark, raw_root)))
    if not rejects_root and not item_rejects_root:
        write_headline_files(extract_headlines(readable_pages(pages), run_date, **options), output_root)
        return
    always_run_date = options.pop("always_run_date", False)
    results = stored(_judged_pages(pages, **options).select("path", "periodico", "items", "reason"), "page-results")
    found = headlines_of(results.drop("reason"), kept_items(F.col("items"))).drop("items")
    rows = stamp(found, run_date, always_run_date=always_run_date)
    write_headline_files(with_partition_columns(rows), output_root)
    if rejects_root:
        results.where("reason IS NOT NULL").select("path", "reason").write.mode("overwrite").parquet(rejects_root)
    if item_rejects_root:
        rejected_items(results.select("path", "items"), F.col("items")).write.mode("overwrite").parquet(item_rejects_root)
    discard(results)


_ROW = ("path", "modified", "position", *CSV_COLUMNS)


def follow_pages(spark: SparkSession, raw_root: str, output_root: str, checkpoint: str, run_date: str, **options) -> StreamingQuery:
    """Extract the headlines of the pages that have landed since the last run, into the same dataset."""
    return follow_arriving(arriving_page_files(spark, raw_root), output_root, checkpoint, run_date, **options)


def follow_announced(
    notifications: DataFrame, store: str, output_root: str, checkpoint: str, run_date: str, **options
) -> StreamingQuery:
    """Headlines of the pages that arriving notifications (``body``) announce, into the partitioned dataset.

    A batch fetches its distinct objects by key; nothing is listed.  ``store`` stands
    before the buckets' names.  An object that is absent, or no page, changes no
    headline and is a reject; one announced again counts by its newest state.
    """

    def fetched(batch: DataFrame) -> DataFrame:
        return fetch_pages(announced_objects(batch), store)

    return follow_arriving(notifications, output_root, checkpoint, run_date, read=fetched, **options)


BATCH_COUNTS = "pages BIGINT, refused BIGINT, rejected BIGINT, headlines BIGINT, load STRING"


def follow_arriving(
    arriving: DataFrame,
    output_root: str,
    checkpoint: str,
    run_date: str,
    held_root: str | None = None,
    *,
    read: Callable[[DataFrame], DataFrame] | None = None,
    rejects_root: str | None = None,
    item_rejects_root: str | None = None,
    counts_root: str | None = None,
    always_run_date: bool = False,
    **options,
) -> StreamingQuery:
    """Headlines of arriving files (``path, modified, content``), into the partitioned dataset.

    A page replaces its own rows and no others, whichever batch it comes in, so the
    dataset ends up as a batch job over all files writes it.  The rows of every page
    are held beside the dataset (``held_root``), by partition and batch; of a touched
    partition the newest file of each page counts, and the partition is written
    anew from those, or removed when nothing is left.  Other partitions are neither
    read nor listed.  A batch that runs again replaces what it held; after a lost
    checkpoint the same files are held twice and count once.  A page without a
    date in its name belongs to the day it was read.

    ``read`` makes the files of a batch out of what arrives, with ``refused`` as the
    reason why one has no body.  A page is fetched and parsed once.  ``rejects_root``
    gets ``path, reason`` of what gives no headline, ``item_rejects_root`` the items of
    pages that are no headlines, and ``counts_root`` one row per batch, observed while
    its pages are parsed; all by batch, so a batch that runs again replaces its own.
    """
    held_root = held_root or output_root.rstrip("/") + "-pages"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        load = f"{stream_identity(spark, checkpoint)}-{batch_id}"
        files = read(batch) if read else batch.withColumn("refused", F.lit(None).cast("string"))
        judged = _judged_pages(decode_pages(files), **options)
        parsed = judged.select("path", "modified", "periodico", "items", F.coalesce("refused", "reason").alias("reason"), "refused")
        kept = kept_items(F.col("items"))
        watched = Observation()
        results = stored(
            parsed.observe(
                watched,
                F.count_if(F.col("refused").isNull()).alias("pages"),
                F.count("refused").alias("refused"),
                F.count_if(F.col("reason").isNotNull() & F.col("refused").isNull()).alias("rejected"),
                F.coalesce(F.sum(F.greatest(F.size(kept), F.lit(0))), F.lit(0)).cast("bigint").alias("headlines"),
            ),
            "page-results",
        )
        discard(*getattr(files, "working_tables", ()))
        if rejects_root:
            results.where("reason IS NOT NULL").select("path", "reason").write.mode("overwrite").parquet(f"{rejects_root}/load={load}")
        if item_rejects_root:
            items = rejected_items(results.select("path", "items"), F.col("items"))
            items.write.mode("overwrite").parquet(f"{item_rejects_root}/load={load}")
        if counts_root:
            names = [entry.split()[0] for entry in BATCH_COUNTS.split(", ")][:-1]
            schema = BATCH_COUNTS.rpartition(", ")[0]
            counts = spark.createDataFrame([tuple(watched.get[name] for name in names)], schema)
            counts.write.mode("overwrite").parquet(f"{counts_root}/load={load}")

        def dated(rows: DataFrame) -> DataFrame:
            return with_partition_columns(stamp(rows, run_date, always_run_date=always_run_date))

        read_pages = results.where("refused IS NULL").drop("reason", "refused")
        marks = dated(read_pages.drop("items")).withColumn("position", F.lit(-1))
        rows = dated(headlines_of(read_pages, kept).drop("items"))
        held = marks.unionByName(rows, allowMissingColumns=True).withColumn("load", F.lit(load))
        held = stored(held.select(*_ROW, *PARTITION_COLUMNS, "load"), "held-pages")
        discard(results)
        (
            held.hint("rebalance", *PARTITION_COLUMNS)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*PARTITION_COLUMNS, "load")
            .parquet(held_root)
        )
        # one row per source and day of the batch
        touched = [tuple(r) for r in held.where("position < 0").select(*PARTITION_COLUMNS).distinct().collect()]
        if touched:
            _publish(spark, held, held_root, touched, output_root)
        discard(held)

    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(availableNow=True)
        .start()
    )


def batch_counts(spark: SparkSession, counts_root: str) -> DataFrame:
    """One row per batch: pages read, objects refused, pages without headlines, headlines."""
    return spark.read.schema(BATCH_COUNTS).parquet(counts_root)


def _publish(spark: SparkSession, like: DataFrame, held_root: str, touched: list[tuple], output_root: str) -> None:
    """Write the touched partitions from the held rows of their pages' newest files."""
    folders = [f"{held_root}/{partition_folder(values)}" for values in touched]
    held = spark.read.schema(like.schema).option("basePath", held_root).parquet(*folders)
    newest = (
        held.where("position < 0")
        .groupBy(*PARTITION_COLUMNS, page_of(F.col("path")).alias("_page"))
        .agg(F.max(F.struct("modified", "path", "load")).alias("newest"))
        .select("newest.path", "newest.load")
        .distinct()
    )
    current = stored(held.where("position >= 0").join(newest, ["path", "load"]).select(*CSV_COLUMNS, *PARTITION_COLUMNS), "current-rows")
    write_headline_files(current, output_root)
    left = {tuple(r) for r in current.select(*PARTITION_COLUMNS).distinct().collect()}
    for values in touched:
        if values not in left:
            remove_folder(spark, f"{output_root}/{partition_folder(values)}")
    discard(current)


def refresh_catalog(spark: SparkSession, database: str, location: str, table: str = "headlines") -> DataFrame:
    """Define the table over the dataset, register its partitions and return it."""
    ensure_database(spark, database)
    recreate_table(spark, database, table, location)
    repair_partitions(spark, database, table)
    return spark.table(f"`{database}`.`{table}`")
