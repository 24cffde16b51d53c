"""Plan properties that keep the jobs usable at cluster scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rotativa.functions.dates import date_parts
from rotativa.operators import dedupe, extract, reports, text_features
from rotativa.plans.headlines import extract_headlines
from rotativa.schema import NEWS


def plan_of(rows) -> str:
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored_news(spark, tmp_path):
    path = str(tmp_path / "news")
    spark.createDataFrame([], NEWS).write.parquet(path)
    return spark.read.schema(NEWS).parquet(path)


def absent_from_itself(news):
    return dedupe.absent_from(news, news)


@pytest.mark.parametrize("operator", [dedupe.one_per_title_and_date, dedupe.one_per_sink_key, absent_from_itself])
def test_duplicates_are_reduced_before_the_shuffle(stored_news, operator):
    plan = plan_of(operator(stored_news))
    assert plan.index("functions=[min(") < plan.index("Exchange hashpartitioning") < plan.index("partial_min(")
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Window" not in plan and "Join" not in plan


def test_extraction_does_not_shuffle(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([], "path STRING, html STRING, other STRING").write.parquet(path)
    pages = spark.read.schema("path STRING, html STRING, other STRING").parquet(path)
    for generic in (False, True):
        plan = plan_of(extract_headlines(pages, "2024-02-01", generic=generic))
        assert "Exchange" not in plan and "Sort " not in plan
        assert plan.count("_outlines(") == 1  # a page is parsed once
        assert "ReadSchema: struct<path:string,html:string>" in plan


def test_unknown_sources_leave_before_parsing(spark, tmp_path):
    path = str(tmp_path / "pages")
    spark.createDataFrame([], "path STRING, html STRING").write.parquet(path)
    pages = spark.read.schema("path STRING, html STRING").parquet(path)
    plan = plan_of(extract_headlines(pages, "2024-02-01", generic=True))
    assert plan.index("ArrowEvalPython") < plan.index("Filter ")


def test_words_are_made_once(spark):
    """Neither a filter on the words nor one on the generated rows makes them again, before the rows are dealt or after."""
    rows = spark.createDataFrame([("a", "Uno dos"), ("b", " ")], "enlace STRING, clean_text STRING")
    counted = text_features.term_frequencies(text_features.with_words(rows.repartition(2)), "enlace")
    assert sorted(map(tuple, counted.collect())) == [("a", "dos", 1), ("a", "uno", 1)]
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(") == 1, plan


def test_terms_are_counted_once(spark):
    rows = spark.createDataFrame([("k", ["a", "b"])], "key STRING, words ARRAY<STRING>")
    assert "Exchange" not in plan_of(text_features.term_frequencies(rows, "key"))
    plan = plan_of(text_features.tfidf_terms(rows, "key"))
    assert plan.count("Join ") == 1 and "array_sort" not in plan and "Generate" not in plan  # it reads stored counts
    assert plan.index("Exchange") < plan.index("partial_count")


def test_statistics_count_combinations(stored_news):
    plan = plan_of(reports.processing_stats(stored_news))
    assert "Expand" in plan  # of the combinations ...
    assert plan.rindex("Expand") < plan.rindex("partial_count(1)")  # ... which are counted below it
    assert "ReadSchema: struct<fecha:date,categoria:string,periodico:string>" in plan


def test_reports_read_the_columns_they_need(stored_news):
    plan = plan_of(reports.articles_per_recent_day(stored_news, F.lit("2024-01-15").cast("date")))
    assert "ReadSchema: struct<fecha:date>" in plan
    assert "PushedFilters: [IsNotNull(fecha), GreaterThanOrEqual(fecha," in plan
    trend = reports.category_trend(stored_news.withColumns(date_parts(F.col("fecha"))))
    assert "ReadSchema: struct<fecha:date,categoria:string>" in plan_of(trend)


def test_top_lists_are_not_sorted_as_a_whole(stored_news):
    assert "TakeOrderedAndProject" in plan_of(reports.top_by_count(stored_news, "categoria", 10))


def test_in_page_duplicates_stay_in_the_row(spark):
    rows = spark.createDataFrame([([("a", 1)],)], "items ARRAY<STRUCT<enlace: STRING, n: INT>>")
    assert "Exchange" not in plan_of(rows.select(dedupe.first_in_page(F.col("items"), "enlace")))


@pytest.mark.parametrize(
    ("rule", "searches"),
    [
        (lambda outline: extract.cards_and_headings(outline), 2),
        (lambda outline: extract.page_items_by_markup(outline, F.col("periodico")), 3),
        (lambda outline: extract.generic_articles_or_links(outline), 3),
    ],
)
def test_rules_are_evaluated_once(spark, rule, searches):
    """Searches of a whole outline in the expression of a rule."""
    assert str(rule(F.col("outline"))).count("filter(outline['elements']") == searches


def test_outline_is_needed_once(spark):
    pages = spark.createDataFrame([("p", "<h1>x</h1>")], "path STRING, html STRING")
    rows = extract.headlines_of(extract.with_outline(pages), extract.cards_and_headings(F.col("outline")))
    assert plan_of(rows).count("_outlines(") == 1
