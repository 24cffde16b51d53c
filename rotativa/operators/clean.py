"""Row cleaning: sink projection, defaults, validity, classifier text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rotativa.fixed import DEFAULT_CATEGORY, UNKNOWN_SOURCE, WANTED_CHARACTER
from rotativa.functions.dates import parse_date
from rotativa.functions.text import clean_text
from rotativa.operators.dedupe import one_per_title_and_date


def with_defaults(news: DataFrame) -> DataFrame:
    """Missing category, link and source get their default."""
    return news.withColumns(
        {
            "categoria": F.coalesce("categoria", F.lit(DEFAULT_CATEGORY)),
            "enlace": F.coalesce("enlace", F.lit("")),
            "periodico": F.coalesce("periodico", F.lit(UNKNOWN_SOURCE)),
        }
    )


def sink_columns(headlines: DataFrame) -> DataFrame:
    """The five columns of the sink, with a typed date; an impossible date is NULL."""
    return headlines.select(
        parse_date(F.col("fecha")).alias("fecha"), "categoria", "titular", "enlace", "periodico"
    )


def has_title_and_date() -> Column:
    return F.col("titular").isNotNull() & (F.col("titular") != "") & F.col("fecha").isNotNull()


def valid_rows(headlines: DataFrame) -> DataFrame:
    """Typed and defaulted rows that have a title and a date."""
    return with_defaults(sink_columns(headlines)).where(has_title_and_date())


def sink_rows(headlines: DataFrame) -> DataFrame:
    """Headlines as the sink takes them: typed, defaulted, valid, one per title and date."""
    return one_per_title_and_date(valid_rows(headlines))


def is_classifier_row(label: Column, text: Column, *, drop_empty: bool = True) -> Column:
    """The row has a label and a text, and cleaning leaves something of it.

    Something is left when the text has one wanted character; looking for that
    stops at the first and does not clean the text a second time.
    """
    present = label.isNotNull() & text.isNotNull()
    return present & text.rlike(WANTED_CHARACTER) if drop_empty else present


def classifier_rows(
    headlines: DataFrame, *keep: str, label: str = "categoria", text: str = "titular", drop_empty: bool = True
) -> DataFrame:
    """``label, clean_text`` (and the columns to keep) of the usable rows.

    A text of spaces only stays; ``drop_empty=False`` keeps empty text as well.
    """
    usable = headlines.where(is_classifier_row(F.col(label), F.col(text), drop_empty=drop_empty))
    return usable.select(*keep, F.col(label).alias("label"), clean_text(F.col(text)).alias("clean_text"))
