"""Streaming queries: arriving files, incremental loading, the running summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from rotativa.queries.base import HEADLINES, VALID, query, table
from rotativa.queries.rows import headlines
from rotativa.session import new_folder
from rotativa.sinks.files import write_headline_files
from rotativa.sources.adapters import document_headlines, event_arrivals
from rotativa.streaming.incremental import append_new_rows, compact_loads, load_new_headlines, stored_rows
from rotativa.streaming.ingest import append_stream, arriving_headline_files, arriving_table
from rotativa.streaming.repeats import keep_first
from rotativa.streaming.summary import keep_summary, latest_summary, running_counts


@query("stream_ingest", f"WITH {HEADLINES} SELECT * FROM headlines")
def stream_ingest(spark, folder):
    """Documents as arriving files, turned into headline rows by a stream; the pattern stands for a file or a folder of files."""
    root = new_folder(spark, "ingest")
    documents = table(spark, folder, "documents").schema
    arriving = document_headlines(arriving_table(spark, f"{folder}/document[s].parquet", documents))
    append_stream(arriving, f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(arriving.schema).parquet(f"{root}/rows")


@query(
    "incremental_load",
    f"""
    WITH {VALID}
    SELECT fecha, categoria, titular, enlace, periodico, CASE WHEN fecha < DATE '2024-02-01' THEN 0 ELSE 1 END AS batch
    FROM valid
    QUALIFY row_number() OVER (
        PARTITION BY fecha, rtrim(lower(strip_accents(left(titular, 500)))), rtrim(lower(strip_accents(periodico)))
        ORDER BY enlace) = 1
    """,
)
def incremental_load(spark, folder):
    """January arrives, then February together with January's last week again, then nothing.

    The second run takes only the new files, the repeated week adds no row, and
    the third run does nothing.
    """
    root = new_folder(spark, "incremental")
    rows = headlines(spark, folder)

    def run() -> None:
        arriving = arriving_headline_files(spark, f"{root}/landing")
        load_new_headlines(arriving, f"{root}/target", f"{root}/checkpoint").awaitTermination()

    write_headline_files(rows.where(F.col("fecha") < "2024-02-01"), f"{root}/landing")
    run()
    write_headline_files(rows.where(F.col("fecha") >= "2024-01-25"), f"{root}/landing")
    run()
    run()
    number = F.substring_index("load", "-", -1).cast("int")
    return stored_rows(spark, f"{root}/target").withColumn("batch", number).drop("load")


@query(
    "compacted_loads",
    f"""
    WITH {VALID}
    SELECT fecha, categoria, titular, enlace, periodico,
           CASE WHEN fecha < DATE '2024-02-01' THEN 'a-0' WHEN fecha < DATE '2024-02-10' THEN 'a-1' ELSE 'a-2' END AS load
    FROM valid
    QUALIFY row_number() OVER (
        PARTITION BY fecha, rtrim(lower(strip_accents(left(titular, 500)))), rtrim(lower(strip_accents(periodico)))
        ORDER BY enlace) = 1
    """,
)
def compacted_loads(spark, folder):
    """Two loads that overlap are compacted; a third arrives, a compacted one is run again, and all is compacted once more."""
    target = new_folder(spark, "compacted")
    rows = headlines(spark, folder)
    second = rows.where(F.col("fecha").between("2024-01-25", "2024-02-09"))
    append_new_rows(rows.where(F.col("fecha") < "2024-02-01"), "a-0", target)
    append_new_rows(second, "a-1", target)
    compact_loads(spark, target)
    append_new_rows(rows.where(F.col("fecha") >= "2024-02-05"), "a-2", target)
    append_new_rows(second, "a-1", target)
    compact_loads(spark, target)
    return stored_rows(spark, target)


@query(
    "stream_summary",
    """
    SELECT CAST(ts AS DATE) AS fecha, 'src' || (user_id % 4) AS periodico, event_type AS categoria,
           count(*) AS total_articles, min(ts) AS first_added, max(ts) AS last_added
    FROM events GROUP BY ALL
    """,
)
def stream_summary(spark, folder):
    """Two thirds of the events arrive, then the others, which belong to the same dates."""
    root = new_folder(spark, "summary")
    events = table(spark, folder, "events")
    for part in (F.col("event_id") % 3 > 0, F.col("event_id") % 3 == 0):
        events.where(part).write.mode("append").parquet(f"{root}/landing")
        arriving = event_arrivals(arriving_table(spark, f"{root}/landing", events.schema))
        keep_summary(running_counts(arriving, added="ts"), f"{root}/summary", f"{root}/checkpoint").awaitTermination()
    return latest_summary(spark, f"{root}/summary")


# Every event comes a second time so many days later.
RETURN_DAYS, WINDOW_DAYS = 12, 14


@query(
    "stream_repeats",
    f"""
    WITH ending AS (SELECT max(ts) - INTERVAL {WINDOW_DAYS} DAY AS passed FROM events)
    SELECT event_id, ts FROM events
    UNION ALL
    SELECT event_id, ts + INTERVAL {RETURN_DAYS} DAY AS ts FROM events, ending
    WHERE ts + INTERVAL {WINDOW_DAYS} DAY <= passed AND ts + INTERVAL {RETURN_DAYS} DAY >= passed
    """,
)
def stream_repeats(spark, folder):
    """Every event arrives twice at once, then all come back later.

    Of the first arrival one row stays.  What comes back is dropped while its first
    row is remembered, or if it is older than the window; otherwise it is new again.
    """
    root = new_folder(spark, "repeats")
    events = table(spark, folder, "events").select("event_id", F.col("ts").cast("timestamp"))
    later = events.select("event_id", (F.col("ts") + F.make_dt_interval(days=F.lit(RETURN_DAYS))).alias("ts"))
    for rows in (events.unionByName(events), later):
        rows.write.mode("append").parquet(f"{root}/landing")
        arriving = arriving_table(spark, f"{root}/landing", events.schema)
        keep_first(arriving, "ts", f"{WINDOW_DAYS} days", ("event_id",), f"{root}/rows", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(events.schema).parquet(f"{root}/rows").select("event_id", F.col("ts").cast("timestamp_ntz"))
