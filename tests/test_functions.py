from __future__ import annotations

import datetime as dt
import re

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rotativa.fixed import EL_ESPECTADOR, EL_TIEMPO, UNWANTED_CHARACTERS
from rotativa.functions import dates, links, paths, text


def test_partition_levels_of_a_key(column):
    found = column(
        paths.partition_levels,
        "lago/diario/periodico=eltiempo/year=2019/month=7/day=3/tabla-0.csv",
        "lago/sin niveles/tabla.csv",
        "otro/lago/periodico=elespectador/year=2020/month=02/day=29/copia/tabla.csv",
        "a=1/b=x=y/a=2/f",
        "=empty/c=",
    )
    assert found == [
        {"periodico": "eltiempo", "year": "2019", "month": "7", "day": "3"},
        {},
        {"periodico": "elespectador", "year": "2020", "month": "02", "day": "29"},
        {"a": "2", "b": "x=y"},
        {"": "empty", "c": ""},
    ]


def test_partition_values_fill_missing_levels(column):
    found = column(
        lambda x: paths.partition_values(paths.partition_levels(x)),
        "periodico=eltiempo/year=2024/month=1/day=15/f",
        "periodico=eltiempo/f",
    )
    assert found == [["eltiempo", "2024", "1", "15"], ["eltiempo", "", "", ""]]


def test_storage_paths(column):
    valid = ["s3://lago/a", "s3://lago/2020/02/tabla.orc"]
    invalid = ["lago/2020/tabla.orc", "/mnt/lago/tabla.orc", "tabla.orc"]
    assert column(paths.is_storage_path, *valid, *invalid) == [True] * 2 + [False] * 3


def test_file_names(column):
    assert column(paths.file_format, "portada.xml", "a.b.orc", "sin punto") == ["xml", "orc", "sin punto"]
    assert column(paths.file_base_name, "a/b/eltiempo-2024-01-15.html", "x.html.html", "y") == [
        "eltiempo-2024-01-15",
        "x",
        "y",
    ]
    assert column(paths.is_html_name, "a.HTML", "a.html", "a.htm") == [True, True, False]
    assert column(lambda x: paths.is_html_name(x, ignore_case=False), "a.HTML", "a.html") == [False, True]


def test_source_detection_prefers_the_first_source(column):
    assert column(paths.detect_source, "ElTiempo-1", "x-elespectador", "elespectador-eltiempo", "otro") == [
        "eltiempo",
        "elespectador",
        "eltiempo",
        "unknown",
    ]
    assert column(lambda x: paths.detect_source(x, paths.SOURCE_DOMAINS), "<a href=HTTPS://WWW.ELTIEMPO.COM>") == ["eltiempo"]


def test_date_in_name(column):
    assert column(paths.date_in_name, "raw/eltiempo-2024-01-15.html", "raw/2024-01-15/x.html", "x-2024-13-01.html") == [
        dt.date(2024, 1, 15),
        None,
        None,
    ]


@pytest.mark.parametrize(
    ("value", "date"),
    [("2024-01-15", dt.date(2024, 1, 15)), ("2024-13-01", None), ("", None), ("ayer", None), (None, None)],
)
def test_bad_dates_are_null(column, value, date):
    assert column(dates.parse_date, value) == [date]


def test_partition_date(spark):
    rows = spark.createDataFrame(
        [("2024", "1", "5"), ("2024", "01", "05"), ("2024", "13", "01"), ("2024", "02", "30"), ("20240", "1", "1"), ("", "1", "1"), ("x", "1", "1")],
        "y STRING, m STRING, d STRING",
    )
    found = [r[0] for r in rows.select(dates.partition_date(F.col("y"), F.col("m"), F.col("d"))).collect()]
    assert found == [dt.date(2024, 1, 5)] * 2 + [None] * 5


def test_clean_text(column):
    assert column(text.clean_text, "¡Gana COLOMBIA 3-0!", "a\tb\nc  d", "Pingüino Ñandú", "123") == [
        "gana colombia ",
        "abc  d",
        "pingino ñandú",
        "",
    ]


def test_clean_text_collapsed(column):
    found = column(
        text.clean_text_collapsed,
        "El PINGÜINO cruzó 7 Mares",
        "\t lluvia   en   Tunja \n",
        "dó-lar / eu~ro",
    )
    assert found == ["el pingino cruzó mares", "lluvia en tunja", "dólar euro"]


def test_node_text_joins_stripped_pieces(column):
    assert column(text.node_text, "Hola <b>mundo</b>", " A &amp; B <i> C </i>", "&amp;lt;", "x &nbsp;", "corte &amp", "&ampx &am") == [
        "Holamundo",
        "A & BC",
        "&lt;",
        "x",
        "corte &",
        "&ampx &am",
    ]


def test_title_case(column):
    samples = ["salud y bienestar", "e-commerce", "o'neill", "ÁRBOL verde", "3er mundo"]
    assert column(text.title_case, *samples) == [sample.title() for sample in samples]


def test_absolute_link(column):
    every = column(lambda x: links.absolute_link(x, EL_TIEMPO.base_url), "/a", "#x", "", "http://b", "c")
    base = "https://www.eltiempo.com"
    assert every == [f"{base}/a", f"{base}#x", "", "http://b", f"{base}c"]
    rooted = column(lambda x: links.absolute_link(x, EL_TIEMPO.base_url, only_rooted=True), "/a", "#x", "")
    assert rooted == [f"{base}/a", "#x", ""]


def test_site_links(column):
    found = column(
        lambda x: links.is_site_link(x, EL_ESPECTADOR),
        "https://www.elespectador.com/politica/x",
        "https://www.elespectador.com/autores/x",
        "https://www.elespectador.com/display/x",
        "https://otro.com/x",
        "/politica/x",
    )
    assert found == [True, False, False, False, False]


def test_url_category(column):
    values = ["https://www.elespectador.com/salud-y-vida/x/", "https://www.elespectador.com/", "http://otro.com/deportes/x"]
    assert column(lambda x: links.url_category(x, EL_ESPECTADOR), *values) == ["Salud Y Vida", "Sin categoría", "Http:"]
    assert column(links.url_category, *values) == ["Salud Y Vida", "Sin categoría", "Deportes"]


def test_level_value_agrees_with_the_levels(column):
    samples = ["periodico=a/year=2024/f", "x/year=1/year=2/f", "x/fiscalyear=9/f", "x/year=/f", "x/year=a=b", "", "year"]
    by_map = column(lambda x: paths.partition_levels(x)["year"], *samples)
    assert column(lambda x: paths.level_value(x, "year"), *samples) == by_map == ["2024", "2", None, "", "a=b", None, None]


def test_first_valid_date_in_a_name(column):
    names = ["a/1234-56-78-2024-01-15.html", "2024-02-30-x.html", "x-2024-02-2910-11-12.html", "2020-01-01/x.html", "99992024-01-05"]
    found = column(paths.date_in_name, *names)
    assert found == [dt.date(2024, 1, 15), None, dt.date(2024, 2, 29), None, dt.date(9999, 1, 5)] or found[:4] == [
        dt.date(2024, 1, 15),
        None,
        dt.date(2024, 2, 29),
        None,
    ]


def test_folded_equals_sql_for_every_character(spark):
    codes = [*range(1, 0xD800), *range(0xE000, 0x110000)]
    texts = spark.createDataFrame(pa.table({"id": codes, "c": [chr(code) for code in codes]}))
    found = texts.select("id", text.folded(F.concat("c", F.lit("a "), "c")).alias("x")).toArrow()
    wanted = "rtrim(lower(strip_accents(chr(id::INT) || 'a ' || chr(id::INT))))"
    differing = duckdb.execute(f"SELECT count(*), sum((x <> {wanted})::INT) FROM found").fetchone()
    assert differing == (len(codes), 0)


def test_cleaning_has_no_ranges_to_search_and_deletes_the_same(spark, column):
    """A class with ranges takes Java more than ten times as long; the listed one is the same class."""
    codes = [*range(1, 0xD800), *range(0xE000, 0xFFFE), *range(0x1F600, 0x1F650)]
    sample = "".join(map(chr, codes))
    assert column(text.clean_text, sample) == [re.sub(UNWANTED_CHARACTERS, "", sample).lower()]
    kept = re.sub(r"[^a-záéíóúñ \t\n\x0b\f\r]", "", "".join(c for c in sample if c.lower() == c))
    assert column(text.clean_text_collapsed, "".join(c for c in sample if c.lower() == c)) == [re.sub(r"\s+", " ", kept).strip()]
    for made in (text.clean_text, text.clean_text_collapsed):
        plan = spark.range(1).select(made(F.col("id").cast("string")))._jdf.queryExecution().optimizedPlan().toString()
        assert "a-z" not in plan and "regexp_replace" in plan
