"""Reports over headline rows: counts, summaries, trends, recent items.

Counting is a map-side partial aggregation followed by one small shuffle, so a
source or day holding most rows costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rotativa.fixed import RECENT_DAYS, SHORT_TITLE_CHARACTERS

# fixed value: from a median absolute deviation to a standard deviation of normal values
MAD_SCALE = 1.4826


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count("*").alias("total"))


def count_by(rows: DataFrame, *columns: str, name: str = "total") -> DataFrame:
    return rows.groupBy(*columns).agg(F.count("*").alias(name))


def processing_stats(news: DataFrame) -> DataFrame:
    """Rows and distinct dates, sources and categories, NULL counting as a value.

    The rows are counted per combination first; the distinct counts then run over
    the combinations, not over the rows.
    """
    columns = {"fecha": "unique_dates", "periodico": "unique_newspapers", "categoria": "unique_categories"}
    combinations = count_by(news, *columns, name="n")
    distinct = [
        (F.count_distinct(F.col(c)) + F.coalesce(F.max(F.col(c).isNull().cast("bigint")), F.lit(0))).alias(name)
        for c, name in columns.items()
    ]
    return combinations.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"), *distinct)


def distinct_dates(news: DataFrame) -> DataFrame:
    return news.select("fecha").distinct().orderBy("fecha")


def category_trend(headlines: DataFrame) -> DataFrame:
    """Headlines per category and day, by day and then by size."""
    counts = count_by(headlines, "categoria", "year", "month", "day", name="cantidad")
    return counts.orderBy("year", "month", "day", F.desc("cantidad"), "categoria")


def news_summary(news: DataFrame) -> DataFrame:
    """Articles and insertion times per date, source and category."""
    return (
        news.groupBy(
            F.col("fecha").cast("date").alias("date"),
            F.col("periodico").alias("newspaper"),
            F.col("categoria").alias("category"),
        )
        .agg(
            F.count("*").alias("total_articles"),
            F.min("created_at").alias("first_added"),
            F.max("created_at").alias("last_added"),
        )
        .orderBy(F.desc("date"), "newspaper", "category")
    )


def _last_days(news: DataFrame, as_of: Column | None, days: int) -> DataFrame:
    """Rows of the last days; ``as_of`` is the newest date of the rows by default."""
    today = news.agg(F.max("fecha")).scalar() if as_of is None else as_of
    return news.where(F.col("fecha") >= F.date_sub(today, days))


def recent_news(news: DataFrame, as_of: Column | None = None, days: int = RECENT_DAYS) -> DataFrame:
    """Recent items with a shortened title, newest first.

    The link ends the sort order, so the order is total and a single busy day can
    still be spread over many sort partitions.
    """
    return (
        _last_days(news, as_of, days)
        .orderBy(F.desc("fecha"), F.desc("created_at"), "enlace")
        .select(
            "fecha",
            "categoria",
            F.left("titular", F.lit(SHORT_TITLE_CHARACTERS)).alias("titulo_corto"),
            "periodico",
            "created_at",
            "enlace",
        )
    )


def articles_per_recent_day(news: DataFrame, as_of: Column | None = None, days: int = RECENT_DAYS) -> DataFrame:
    recent = _last_days(news, as_of, days)
    return count_by(recent, "fecha", name="total_articles").orderBy(F.desc("fecha"))


def top_by_count(rows: DataFrame, column: str, k: int, name: str = "total_articles") -> DataFrame:
    """The ``k`` most frequent values; ties by value."""
    return count_by(rows, column, name=name).orderBy(F.desc(name), F.asc_nulls_last(column)).limit(k)


def sample_rows(rows: DataFrame, k: int, *order_by: str) -> DataFrame:
    """The first ``k`` rows, for a look at the data; repeatable when an order is given."""
    return (rows.orderBy(*order_by) if order_by else rows).limit(k)


def partition_rows(
    headlines: DataFrame, periodico: str, year: int | str, month: int | str, day: int | str
) -> DataFrame:
    """``categoria, titular, enlace`` of one partition; month and day padded or not.

    Both spellings are compared as text, so the predicate prunes folders.
    """

    def spelled(column: str, value: int | str, width: int) -> Column:
        return F.col(column).isin(str(int(value)), str(int(value)).zfill(width))

    return headlines.where(
        (F.col("periodico") == periodico) & spelled("year", year, 4) & spelled("month", month, 2) & spelled("day", day, 2)
    ).select("categoria", "titular", "enlace")


def count_by_source_in_month(headlines: DataFrame, year: int, month: int) -> DataFrame:
    wanted = F.col("year").isin(str(year)) & F.col("month").isin(str(month), str(month).zfill(2))
    return count_by(headlines.where(wanted), "periodico", name="total_noticias")


def category_trend_delta(news: DataFrame, days: int = 7) -> DataFrame:
    """Daily headlines per category with the change to the previous day seen and the mean of the last days.

    The windows run over the counted days of a category, not over its rows.
    """
    daily = count_by(news, "categoria", "fecha", name="cantidad")
    by_day = Window.partitionBy("categoria").orderBy("fecha")
    return daily.select(
        "categoria",
        "fecha",
        "cantidad",
        (F.col("cantidad") - F.lag("cantidad").over(by_day)).alias("cambio"),
        F.round(F.avg("cantidad").over(by_day.rowsBetween(1 - days, 0)), 6).alias("media"),
    )


def calendar_trend(
    news: DataFrame, days: int = 7, baseline: int = 14, threshold: float = 3.5, least_days: int = 7
) -> DataFrame:
    """Headlines per category and calendar day with the mean of the last days, and whether the day stands out.

    Every category has a row for each day between the first and the last of the
    data, with zero where nothing appeared, so "the last seven days" are days of the
    calendar.  A day is compared with the ``baseline`` days before it: its distance
    from their median, in units of their median absolute deviation scaled to a
    standard deviation.  Without spread, or with fewer than ``least_days`` days
    before it, there is no score.  Windows run over counted days, never over rows.
    """
    counts = count_by(news.where(F.col("fecha").isNotNull()), "categoria", "fecha", name="cantidad")
    bounds = news.agg(F.min("fecha").alias("first"), F.max("fecha").alias("last"))
    every = F.explode(F.sequence(bounds.select("first").scalar(), bounds.select("last").scalar()))
    spine = counts.select("categoria").distinct().select(F.col("categoria").alias("_category"), every.alias("_day"))
    same = (F.col("categoria").eqNullSafe(F.col("_category"))) & (F.col("fecha") == F.col("_day"))
    daily = spine.join(counts, same, "left").select(
        F.col("_category").alias("categoria"), F.col("_day").alias("fecha"), F.coalesce("cantidad", F.lit(0)).alias("cantidad")
    )
    by_day = Window.partitionBy("categoria").orderBy(F.unix_date("fecha"))
    before = F.collect_list("cantidad").over(by_day.rangeBetween(-baseline, -1))
    framed = daily.select(
        "*",
        F.avg("cantidad").over(by_day.rangeBetween(1 - days, 0)).alias("mean"),
        before.alias("before"),
    )
    centred = framed.withColumn("median", _median(F.col("before")))
    spread = _median(F.transform("before", lambda x: F.abs(x - F.col("median"))))
    scored = centred.withColumn("spread", spread * MAD_SCALE)
    enough = (F.size("before") >= least_days) & (F.col("spread") > 0)
    score = F.when(enough, (F.col("cantidad") - F.col("median")) / F.col("spread"))
    return scored.select(
        "categoria",
        "fecha",
        "cantidad",
        F.round("mean", 6).alias("media"),
        F.round(score, 6).alias("desviacion"),
        F.coalesce(F.abs(score) > threshold, F.lit(False)).alias("destacado"),
    )


def _median(values: Column) -> Column:
    """Median of a short array; NULL when it is empty."""
    ordered = F.array_sort(values)
    half = (F.size(values) / 2).cast("int")
    upper, lower = F.get(ordered, half), F.get(ordered, F.greatest(half - 1, F.lit(0)))
    return F.when(F.size(values) % 2 == 1, upper.cast("double")).otherwise((upper + lower) / 2)
