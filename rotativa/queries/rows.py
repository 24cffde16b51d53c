"""Queries over headline rows: cleaning, duplicates, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rotativa.functions.dates import date_parts
from rotativa.operators import clean, dedupe, reports, sketches
from rotativa.queries.base import HEADLINES, NEWS, VALID, query, table
from rotativa.session import new_folder
from rotativa.sources.adapters import document_headlines, document_news, event_arrivals


def headlines(spark: SparkSession, folder: str) -> DataFrame:
    return document_headlines(table(spark, folder, "documents"))


def news(spark: SparkSession, folder: str) -> DataFrame:
    return document_news(table(spark, folder, "documents"))


# --- cleaning -----------------------------------------------------------------


@query(
    "mysql_transform",
    f"""
    WITH {VALID}
    SELECT fecha, categoria, titular, enlace, periodico FROM valid WHERE length(titular) % 11 > 2
    QUALIFY row_number() OVER (PARTITION BY titular, fecha ORDER BY periodico, categoria, enlace) = 1
    """,
)
def sink_transform(spark, folder):
    """Rows of which some have an impossible date, no date or no title."""
    fault = F.char_length("titular") % 11
    rows = headlines(spark, folder).withColumns(
        {
            "fecha": F.when(fault == 0, "2024-13-01").when(fault == 1, F.lit(None)).otherwise(F.col("fecha")),
            "titular": F.when(fault == 2, F.lit(None)).otherwise(F.col("titular")),
        }
    )
    return clean.sink_rows(rows)


@query(
    "null_defaults",
    f"""
    WITH {HEADLINES}
    SELECT fecha, coalesce(categoria, 'General') AS categoria, titular, coalesce(enlace, '') AS enlace,
           coalesce(periodico, 'unknown') AS periodico
    FROM headlines
    """,
)
def null_defaults(spark, folder):
    return clean.with_defaults(headlines(spark, folder)).drop("year", "month", "day")


@query(
    "date_parts",
    """
    SELECT event_id, CAST(ts AS DATE) AS fecha, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
           strftime(ts, '%d') AS day, strftime(ts, '%Y-%m-%d') AS fecha_texto
    FROM events
    """,
)
def date_parts_of_events(spark, folder):
    arrivals = event_arrivals(table(spark, folder, "events"))
    return arrivals.select(
        "event_id",
        "fecha",
        *[part.alias(name) for name, part in date_parts(F.col("fecha")).items()],
        F.date_format("fecha", "yyyy-MM-dd").alias("fecha_texto"),
    )


# --- duplicates ---------------------------------------------------------------


@query(
    "dedupe_title_date",
    f"""
    WITH {NEWS}
    SELECT fecha, categoria, titular, enlace, periodico, created_at FROM news
    QUALIFY row_number() OVER (
        PARTITION BY titular, fecha ORDER BY periodico, categoria NULLS FIRST, enlace) = 1
    """,
)
def dedupe_title_date(spark, folder):
    return dedupe.one_per_title_and_date(news(spark, folder))


@query(
    "distinct_dates",
    f"WITH {NEWS} SELECT DISTINCT fecha FROM news ORDER BY fecha",
)
def distinct_dates(spark, folder):
    return reports.distinct_dates(news(spark, folder))


@query(
    "insert_if_absent",
    f"""
    WITH {VALID},
    keyed AS (
        SELECT *, rtrim(lower(strip_accents(left(titular, 500)))) AS title_key,
               rtrim(lower(strip_accents(periodico))) AS source_key,
               categoria IN ('en', 'General') AS held
        FROM valid
    )
    SELECT fecha, categoria, titular, enlace, periodico FROM keyed k
    WHERE NOT EXISTS (SELECT 1 FROM keyed h WHERE h.held AND h.fecha = k.fecha
                      AND h.title_key = k.title_key AND h.source_key = k.source_key)
    QUALIFY row_number() OVER (PARTITION BY fecha, title_key, source_key ORDER BY enlace) = 1
    """,
)
def insert_if_absent(spark, folder):
    """All rows arrive at a sink that already holds those of two categories."""
    rows = clean.valid_rows(headlines(spark, folder))
    return dedupe.absent_from(rows, rows.where(F.col("categoria").isin("en", "General")))


# --- counts -------------------------------------------------------------------


@query("row_count", f"WITH {HEADLINES} SELECT count(*) AS total FROM headlines")
def row_count(spark, folder):
    return reports.row_count(headlines(spark, folder))


@query(
    "processing_stats",
    f"""
    WITH {NEWS}
    SELECT count(*) AS total_records,
           count(DISTINCT fecha) + max(CASE WHEN fecha IS NULL THEN 1 ELSE 0 END) AS unique_dates,
           count(DISTINCT periodico) + max(CASE WHEN periodico IS NULL THEN 1 ELSE 0 END) AS unique_newspapers,
           count(DISTINCT categoria) + max(CASE WHEN categoria IS NULL THEN 1 ELSE 0 END) AS unique_categories
    FROM news
    """,
)
def processing_stats(spark, folder):
    return reports.processing_stats(news(spark, folder))


SKETCHED = "count(*) AS total_records, count(DISTINCT titular) AS unique_titles, count(DISTINCT enlace) AS unique_links"


@query(
    "sketched_stats",
    f"""
    WITH {NEWS}, months AS (SELECT * FROM news WHERE fecha BETWEEN DATE '2024-01-10' AND DATE '2024-02-14')
    SELECT periodico, {SKETCHED}, true AS titles_near, true AS links_near FROM months GROUP BY periodico
    UNION ALL SELECT 'all' AS periodico, {SKETCHED}, true AS titles_near, true AS links_near FROM months
    """,
)
def sketched_stats(spark, folder):
    """Statistics of some weeks from the sketches of their days, per source and in all, beside the exact counts.

    One day is written again: it replaces itself.
    """
    path = new_folder(spark, "sketches")
    rows = news(spark, folder)
    first, last = F.lit("2024-01-10").cast("date"), F.lit("2024-02-14").cast("date")
    sketches.write_sketches(sketches.daily_sketches(rows), path)
    sketches.write_sketches(sketches.daily_sketches(rows.where("fecha = DATE '2024-01-12'")), path)
    kept = sketches.between(spark.read.parquet(path), first, last)
    exact = rows.where(F.col("fecha").between(first, last))
    named = {"titular": "unique_titles", "enlace": "unique_links"}
    counts = [F.count("*").alias("total_records"), *(F.count_distinct(name).alias(made) for name, made in named.items())]

    def beside(estimates: DataFrame, counted: DataFrame) -> DataFrame:
        joined = estimates.alias("e").join(counted.alias("c"), F.col("e.periodico").eqNullSafe(F.col("c.periodico")))
        return joined.select(
            "e.periodico",
            "e.total_records",
            *(f"c.{made}" for made in named.values()),
            *(sketches.near(F.col(f"e.{made}"), F.col(f"c.{made}")).alias(f"{made[7:]}_near") for made in named.values()),
        )

    # not a literal, which would fold away the key that the two rows are joined by
    every = F.when(F.col("total_records") >= 0, "all").alias("periodico")
    by_source = beside(sketches.merged_statistics(kept, "periodico"), exact.groupBy("periodico").agg(*counts))
    in_all = beside(sketches.merged_statistics(kept).select(every, "*"), exact.agg(*counts).select(every, "*"))
    return by_source.unionByName(in_all)


@query(
    "count_by_source",
    f"WITH {HEADLINES} SELECT periodico, count(*) AS total_articles FROM headlines GROUP BY periodico",
)
def count_by_source(spark, folder):
    return reports.count_by(headlines(spark, folder), "periodico", name="total_articles")


@query(
    "count_by_source_month",
    f"""
    WITH {HEADLINES}
    SELECT periodico, count(*) AS total_noticias FROM headlines
    WHERE CAST(year AS INTEGER) = 2024 AND CAST(month AS INTEGER) = 1 GROUP BY periodico
    """,
)
def count_by_source_month(spark, folder):
    return reports.count_by_source_in_month(headlines(spark, folder), 2024, 1)


@query(
    "category_trend",
    f"""
    WITH {HEADLINES}
    SELECT categoria, count(*) AS cantidad, year, month, day FROM headlines
    GROUP BY categoria, year, month, day ORDER BY year, month, day, cantidad DESC, categoria
    """,
)
def category_trend(spark, folder):
    return reports.category_trend(headlines(spark, folder))


@query(
    "arrival_trend",
    """
    SELECT event_type AS categoria, count(*) AS cantidad, strftime(ts, '%Y') AS year,
           strftime(ts, '%m') AS month, strftime(ts, '%d') AS day
    FROM events GROUP BY ALL
    """,
)
def arrival_trend(spark, folder):
    arrivals = event_arrivals(table(spark, folder, "events"))
    return reports.category_trend(arrivals.withColumns(date_parts(F.col("fecha"))))


@query(
    "category_trend_delta",
    """
    WITH daily AS (
        SELECT event_type AS categoria, CAST(ts AS DATE) AS fecha, count(*) AS cantidad
        FROM events GROUP BY ALL
    )
    SELECT categoria, fecha, cantidad,
           cantidad - lag(cantidad) OVER (PARTITION BY categoria ORDER BY fecha) AS cambio,
           round(avg(cantidad) OVER (PARTITION BY categoria ORDER BY fecha
                 ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 6) AS media
    FROM daily
    """,
)
def category_trend_delta(spark, folder):
    return reports.category_trend_delta(event_arrivals(table(spark, folder, "events")))


@query(
    "calendar_trend",
    """
    WITH kept AS (SELECT event_type AS categoria, CAST(ts AS DATE) AS fecha FROM events WHERE day(ts) % 9 <> 4),
    counts AS (SELECT categoria, fecha, count(*) AS n FROM kept GROUP BY ALL),
    days AS (SELECT CAST(unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 DAY)) AS DATE) AS fecha FROM kept),
    daily AS (
        SELECT c.categoria, d.fecha, coalesce(n, 0) AS cantidad
        FROM (SELECT DISTINCT categoria FROM kept) c CROSS JOIN days d LEFT JOIN counts USING (categoria, fecha)
    ),
    framed AS (
        SELECT *, avg(cantidad) OVER (PARTITION BY categoria ORDER BY fecha ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean,
               coalesce(list(cantidad) OVER (PARTITION BY categoria ORDER BY fecha ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING), []) AS l
        FROM daily
    ),
    centred AS (SELECT *, list_aggregate(l, 'median') AS m FROM framed),
    spread AS (SELECT *, 1.4826::DOUBLE * list_aggregate(list_transform(l, lambda x: abs(x - m)), 'median') AS s FROM centred),
    scored AS (SELECT *, CASE WHEN len(l) >= 7 AND s > 0 THEN (cantidad - m) / s END AS z FROM spread)
    SELECT categoria, fecha, cantidad, round(mean, 6) AS media, round(z, 6) AS desviacion, coalesce(abs(z) > 3.5, false) AS destacado
    FROM scored
    """,
)
def calendar_trend(spark, folder):
    """Events of which whole days are missing: those days count as zero."""
    arrivals = event_arrivals(table(spark, folder, "events"))
    return reports.calendar_trend(arrivals.where(F.day("fecha") % 9 != 4))


@query(
    "news_summary",
    f"""
    WITH {NEWS},
    clean AS (
        SELECT fecha, coalesce(categoria, 'General') AS categoria, titular, enlace, periodico, created_at
        FROM news WHERE titular <> ''
    ),
    kept AS (
        SELECT * FROM clean
        QUALIFY row_number() OVER (PARTITION BY titular, fecha ORDER BY periodico, categoria, enlace) = 1
    )
    SELECT fecha AS date, periodico AS newspaper, categoria AS category, count(*) AS total_articles,
           min(created_at) AS first_added, max(created_at) AS last_added
    FROM kept GROUP BY ALL ORDER BY date DESC, newspaper, category
    """,
)
def news_summary(spark, folder):
    """Cleaned and deduplicated news, summed up per date, source and category."""
    rows = clean.with_defaults(news(spark, folder)).where(clean.has_title_and_date())
    return reports.news_summary(dedupe.one_per_title_and_date(rows))


@query(
    "articles_last_7_days",
    f"""
    WITH {NEWS}
    SELECT fecha, count(*) AS total_articles FROM news
    WHERE fecha >= (SELECT max(fecha) FROM news) - 7 GROUP BY fecha ORDER BY fecha DESC
    """,
)
def articles_last_7_days(spark, folder):
    return reports.articles_per_recent_day(news(spark, folder))


@query(
    "top_categories",
    f"""
    WITH {NEWS}
    SELECT categoria, count(*) AS total_articles FROM news
    GROUP BY categoria ORDER BY total_articles DESC, categoria NULLS LAST LIMIT 10
    """,
)
def top_categories(spark, folder):
    return reports.top_by_count(news(spark, folder), "categoria", 10)


@query(
    "recent_news",
    f"""
    WITH {NEWS}
    SELECT fecha, categoria, left(titular, 100) AS titulo_corto, periodico, created_at, enlace
    FROM news WHERE fecha >= (SELECT max(fecha) FROM news) - 7
    ORDER BY fecha DESC, created_at DESC, enlace
    """,
)
def recent_news(spark, folder):
    return reports.recent_news(news(spark, folder))


@query(
    "headline_sample",
    f"WITH {HEADLINES} SELECT * FROM headlines ORDER BY fecha, periodico, enlace LIMIT 10",
)
def headline_sample(spark, folder):
    return reports.sample_rows(headlines(spark, folder), 10, "fecha", "periodico", "enlace")


@query(
    "partition_filter",
    f"""
    WITH {HEADLINES}
    SELECT categoria, titular, enlace FROM headlines
    WHERE periodico = 'src3' AND CAST(year AS INTEGER) = 2024 AND CAST(month AS INTEGER) = 1
      AND CAST(day AS INTEGER) = 4
    """,
)
def partition_filter(spark, folder):
    return reports.partition_rows(headlines(spark, folder), "src3", 2024, 1, 4)
