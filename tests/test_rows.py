from __future__ import annotations

import datetime as dt

import duckdb
import pytest
from pyspark.sql import functions as F

from rotativa.operators import clean, dedupe, partitions, quality, reports, sketches
from rotativa.plans.sink_load import load_sink
from rotativa.schema import NEWS
from rotativa.sinks.relational import jdbc_options
from rotativa.sources.notifications import announced_objects
from rotativa.sources.relational import schema_map, unexpected_columns

RAW = "fecha STRING, categoria STRING, titular STRING, enlace STRING, periodico STRING"
DAY = dt.date(2024, 1, 15)


@pytest.fixture
def raw(spark):
    return lambda *rows: spark.createDataFrame(rows, RAW)


@pytest.fixture
def news(spark):
    return lambda *rows: spark.createDataFrame(rows, NEWS)


def test_sink_rows(raw):
    rows = raw(
        ("2024-01-15", None, "Uno", None, None),
        ("2024-13-01", "C", "Mala fecha", "/x", "a"),
        (None, "C", "Sin fecha", "/x", "a"),
        ("2024-01-15", "C", "", "/x", "a"),
        ("2024-01-15", "C", None, "/x", "a"),
        ("2024-01-15", "C", "Dos", "/2", "b"),
        ("2024-01-15", "C", "Dos", "/1", "a"),
        ("2024-01-16", "C", "Dos", "/3", "a"),
    )
    assert sorted(map(tuple, clean.sink_rows(rows).collect()), key=repr) == sorted(
        [
            (DAY, "General", "Uno", "", "unknown"),
            (DAY, "C", "Dos", "/1", "a"),
            (dt.date(2024, 1, 16), "C", "Dos", "/3", "a"),
        ],
        key=repr,
    )


def test_duplicates_do_not_depend_on_the_partitioning(spark):
    rows = spark.range(3000).select(
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("fecha"),
        F.lit("c").alias("categoria"),
        F.when(F.col("id") % 3 == 0, "caliente").otherwise((F.col("id") % 70).cast("string")).alias("titular"),
        F.concat(F.lit("/"), F.col("id").cast("string")).alias("enlace"),
        (F.col("id") % 7).cast("string").alias("periodico"),
    )
    results = [
        sorted(map(tuple, dedupe.one_per_title_and_date(rows.repartition(n)).collect())) for n in (1, 3, 8)
    ]
    assert results[0] == results[1] == results[2]
    best = {}
    for r in rows.collect():
        key = (r.titular, r.fecha)
        best[key] = min(best.get(key, (r.periodico, r.categoria, r.enlace)), (r.periodico, r.categoria, r.enlace))
    assert {(r[2], r[0]): (r[4], r[1], r[3]) for r in results[0]} == best


def test_sink_key_ignores_case_accents_and_the_end_of_long_titles(news):
    long = "x" * 500
    rows = news(
        (DAY, "C", "Elección", "/1", "a"),
        (DAY, "C", "ELECCION ", "/2", "a"),
        (DAY, "C", "Elección", "/3", "b"),
        (DAY, "C", long + "1", "/4", "a"),
        (DAY, "C", long + "2", "/5", "a"),
        (DAY, "C", "x" * 499 + "y2", "/6", "a"),
    )
    assert sorted(r.enlace for r in dedupe.one_per_sink_key(rows).collect()) == ["/1", "/3", "/4", "/6"]
    exact = dedupe.one_per_sink_key(rows, "UTF8_BINARY")
    assert sorted(r.enlace for r in exact.collect()) == ["/1", "/2", "/3", "/4", "/6"]


def test_sink_key_of_any_text_is_that_of_the_sql(news):
    """``ß`` and ``ss``, ligatures, wide letters and characters without width are different titles, as in SQL."""
    titles = ["Straße", "Strasse", "STRASSE\u3000", "ﬁn", "fin", "Fín ", "ａ", "a", "a\u00ad", "a \u0301", "x²", "x2", "ΑΣ", "ας", "ασ", "Ñú", "nu\u00a0", "İ"]
    rows = [(DAY, "C", title, f"/{i:02d}", "a") for i, title in enumerate(titles)]
    groups = duckdb.execute("SELECT min(i) FROM (SELECT unnest(range(len($1))) AS i, unnest($1) AS t) GROUP BY rtrim(lower(strip_accents(t)))", [titles])
    expected = sorted(f"/{i:02d}" for (i,) in groups.fetchall())
    assert sorted(r.enlace for r in dedupe.one_per_sink_key(news(*rows)).collect()) == expected
    assert sorted(r.enlace for r in dedupe.absent_from(news(*rows), news()).collect()) == expected


def test_absent_from(news):
    held = news((DAY, "C", "elección", "/0", "A"), (DAY - dt.timedelta(days=9), "C", "Vieja", "/9", "a"))
    rows = news((DAY, "C", "Elección", "/1", "a"), (DAY, "C", "Nueva", "/2", "a"), (DAY, "C", "nueva", "/3", "a"), (DAY, "C", "Vieja", "/4", "a"))
    assert sorted(r.enlace for r in dedupe.absent_from(rows, held).collect()) == ["/2", "/4"]
    assert dedupe.absent_from(rows, dedupe.absent_from(rows, held).unionByName(held)).count() == 0
    assert dedupe.absent_from(rows, rows.limit(0)).count() == 3
    assert dedupe.absent_from(rows.limit(0), held).count() == 0


def test_load_sink_counts_in_one_write(raw, spark, tmp_path):
    rows = raw(("2024-01-15", "C", "Uno", "/1", "a"), ("2024-01-15", "C", "Uno", "/2", "a"), ("malo", "C", "Dos", "/3", "a"))
    out = str(tmp_path / "noticias")
    written = []

    def write(result):
        written.append(1)
        result.write.mode("append").parquet(out)

    assert load_sink(rows, write) == {"read": 3, "written": 1}
    assert load_sink(rows, write, held=spark.read.parquet(out)) == {"read": 3, "written": 0}
    assert load_sink(rows.limit(0), write) == {"read": 0, "written": 0}
    assert load_sink(rows.where("fecha = 'malo'"), write) == {"read": 1, "written": 0}
    assert len(written) == 2
    assert spark.read.parquet(out).count() == 1


def test_relational_options_and_schema_map(spark, news):
    options = jdbc_options("jdbc:mysql://host/news", "noticias", user="u", password="p")
    assert options["dbtable"] == "noticias" and options["batchsize"] == "10000" and options["numPartitions"] == "16"
    typed = options["createTableColumnTypes"]
    assert "periodico VARCHAR(100)" in typed and "titular" not in typed and "enlace" not in typed  # unbounded
    expected = schema_map(spark, {"noticias": news()})
    assert [(r.column, r.type) for r in expected.collect()] == [
        ("fecha", "date"),
        ("categoria", "string"),
        ("titular", "string"),
        ("enlace", "string"),
        ("periodico", "string"),
    ]
    found = schema_map(spark, {"noticias": news().drop("enlace").withColumn("fecha", F.lit("x"))})
    assert [r.column for r in unexpected_columns(found, expected).collect()] == ["enlace", "fecha"]


def test_stats_count_null_as_a_value(news):
    rows = news((DAY, None, "a", "/", "x"), (DAY, "C", "b", "/", "x"), (None, "C", "c", "/", None))
    assert reports.processing_stats(rows).first().asDict() == {
        "total_records": 3,
        "unique_dates": 2,
        "unique_newspapers": 2,
        "unique_categories": 2,
    }
    assert reports.processing_stats(rows.limit(0)).first()["total_records"] == 0


def test_recent_news_takes_a_day_as_parameter(news):
    rows = news(*[(DAY - dt.timedelta(days=n), "C", "t" * 150, f"/{n}", "x") for n in range(12)])
    rows = rows.withColumn("created_at", F.col("fecha").cast("timestamp_ntz"))
    recent = reports.recent_news(rows).collect()
    assert [r.enlace for r in recent] == [f"/{n}" for n in range(8)]
    assert {len(r.titulo_corto) for r in recent} == {100}
    older = reports.recent_news(rows, F.lit("2024-01-10").cast("date"), days=2)
    assert {r.enlace for r in older.collect()} == {f"/{n}" for n in range(8)}
    assert reports.articles_per_recent_day(rows).count() == 8


def test_retention(spark):
    rows = spark.createDataFrame(
        [("a", "2024", "1", "1"), ("a", "2024", "01", "31"), ("a", "2024", "02", "01"), ("a", "2024", "13", "1"), (None, "2023", "1", "1")],
        "periodico STRING, year STRING, month STRING, day STRING",
    )

    def old(as_of):
        return {str(r.partition_date) for r in partitions.retention_report(rows, as_of).collect()}

    assert old(F.lit("2024-03-01").cast("date")) == {"2024-01-01"}
    assert old(F.lit("2024-03-01 10:00:00").cast("timestamp")) == {"2024-01-01", "2024-01-31"}


def test_required_columns_and_items(raw):
    rows = raw(("2024-01-15", "Política", "Nueva ley", "/p", "a"), ("2024-01-15", "", "x", "/p", "a"), ("2024-01-15", "C", None, "/p", "a"))
    assert quality.missing_columns(rows) == []
    assert quality.missing_columns(rows.drop("enlace", "fecha")) == ["enlace", "fecha"]
    assert quality.valid_items(rows).count() == 1
    assert quality.rejected_items(rows).count() == 2
    assert quality.null_profile(rows).first()["titular_nulls"] == 1


def test_expected_outputs(spark, raw):
    rows = raw(("2024-01-15", "C", "t", "/", "a"), ("2024-01-15", "C", "t", "/", "b"))
    expected = quality.expected_outputs(rows, F.lit("2024-01-15").cast("date"), F.lit("2024-01-16").cast("date"))
    listing = spark.createDataFrame(
        [("final/periodico=a/year=2024/month=1/day=15/x.csv",), ("final/periodico=b/year=2024/month=01/day=16/x.csv",), ("headlines/raw/a-2024-01-15.html",)],
        "key STRING",
    )
    assert {(r.periodico, str(r.fecha)) for r in quality.missing_outputs(expected, listing).collect()} == {
        ("a", "2024-01-16"),
        ("b", "2024-01-15"),
    }
    assert quality.missing_raw_pages(expected, listing).count() == 3


def test_notifications(spark):
    bodies = [
        '{"Records":[{"eventVersion":"2.1","s3":{"bucket":{"name":"b"},"object":{"key":"portadas/eltiempo-2019-07-03.html"}}}]}',
        '{"Records":[{"s4":{"key":"x"}}]}',
        '{"Entries":[{"s3":{}}]}',
        '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"1"}}},{"s3":{"bucket":{"name":"b"},"object":{"key":"2"}}}]}',
        '{"Records":[{"s3":{"bucket":{"name":"b"},"object":{"key":"3"}}},{"s3":{"bucket":{"name":"b"}}}]}',
        "no json",
        None,
    ]
    rows = spark.createDataFrame([(body,) for body in bodies], "body STRING")
    assert sorted(r.key for r in announced_objects(rows).collect()) == ["1", "2", "portadas/eltiempo-2019-07-03.html"]
    assert sorted(r.key for r in announced_objects(rows, first_only=True).collect()) == ["1", "portadas/eltiempo-2019-07-03.html"]


def test_schema_merge(spark):
    merged = partitions.merge_schemas(
        spark.createDataFrame([("a", "b")], "x STRING, y STRING"), spark.createDataFrame([("c", "d")], "z STRING, x STRING")
    )
    assert merged.columns == ["x", "y", "z"]
    assert sorted(map(tuple, merged.collect()), key=repr) == sorted([("a", "b", None), ("d", None, "c")], key=repr)


def test_sketches_merge_without_rows(spark, tmp_path):
    rows = [(dt.date(2024, 1, 1 + i % 5), f"s{i % 3}" if i % 7 else None, f"t{i % 900}", f"/{i}", None) for i in range(3000)]
    news = spark.createDataFrame(rows, "fecha DATE, periodico STRING, titular STRING, enlace STRING, categoria STRING")
    sketches.write_sketches(sketches.daily_sketches(news), str(tmp_path / "s"))
    kept = spark.read.parquet(str(tmp_path / "s"))
    whole = sketches.merged_statistics(kept).first()
    assert whole.total_records == 3000 and whole.unique_categories == 0
    assert abs(whole.unique_titles - 900) <= 4 * 900 * sketches.STANDARD_ERROR
    other = sketches.merged_statistics(sketches.daily_sketches(news, "periodico")).first()  # the same rows, cut another way
    assert abs(other.unique_titles - 900) <= 4 * 900 * sketches.STANDARD_ERROR and other.total_records == 3000
    some = sketches.merged_statistics(sketches.between(kept, F.lit("2024-01-02").cast("date"), F.lit("2024-01-03").cast("date")), "periodico")
    assert {r.periodico for r in some.collect()} == {"s0", "s1", "s2", None}
    assert abs(sum(r.total_records for r in some.collect()) - 1200) == 0
    none = sketches.merged_statistics(sketches.daily_sketches(news.limit(0))).first()
    assert tuple(none) == (0, 0, 0, 0)


def test_calendar_trend(spark):
    start = dt.date(2024, 1, 1)
    rows = [(start + dt.timedelta(days=i), "a") for i in range(30) if i != 20 for _ in range(40 if i == 25 else 5 + i % 3)]
    rows += [(start, None), (start + dt.timedelta(days=29), None), (None, "a")]
    found = reports.calendar_trend(spark.createDataFrame(rows, "fecha DATE, categoria STRING")).orderBy("categoria", "fecha").collect()
    assert len(found) == 60 and {r.categoria for r in found} == {None, "a"}
    days = [r for r in found if r.categoria == "a"]
    assert days[20].cantidad == 0 and days[20].destacado and days[25].destacado and days[25].desviacion > 3.5
    assert sum(r.destacado for r in days) == 2 and days[3].desviacion is None
    assert days[20].media == pytest.approx(sum(r.cantidad for r in days[14:21]) / 7, abs=1e-6)
    assert reports.calendar_trend(spark.createDataFrame([], "fecha DATE, categoria STRING")).count() == 0
