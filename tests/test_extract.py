from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rotativa.fixed import EL_ESPECTADOR, EL_TIEMPO
from rotativa.functions import outline
from rotativa.operators import extract
from rotativa.plans.headlines import extract_headlines

ESPECTADOR = "https://www.elespectador.com"


@pytest.fixture
def items(spark):
    """Items a profile finds on one page, as (category, title, link)."""

    def run(profile, html, *site, **options):
        pages = spark.createDataFrame([("p", html)], "path STRING, html STRING")
        outlined = extract.with_outline(pages)
        rows = extract.headlines_of(outlined, profile(F.col("outline"), *site, **options))
        return [(r.categoria, r.titular, r.enlace) for r in rows.orderBy("position").collect()]

    return run


def strict(attributes: str, body: str, cls: str = "c-articulo") -> str:
    return f'<article class="{cls}" {attributes}>{body}</article>'


def strict_title(tag: str = "h2", href: str = ' href="/a"', text: str = "Una noticia") -> str:
    return f'<{tag} class="x c-articulo__titulo"><a class="c-articulo__titulo__txt"{href}>{text}</a></{tag}>'


def test_strict_articles(items):
    html = "".join(
        [
            strict('data-category="Deportes"', strict_title()),
            strict('data-category="x" data-seccion="Mundo" data-subseccion="Europa"', strict_title("h3")),
            strict('data-category="x" data-seccion="Mundo" data-subseccion=""', strict_title(href=' href="http://b/c"')),
            strict("", strict_title(href=' href="#ancla"'), "c-articulo--ancho otra"),
            strict("", '<h2 class="c-articulo__titulo">sin enlace</h2>'),
            strict("", strict_title(href="")),
            strict("", strict_title(text="  ")),
            strict("", strict_title(), "otra"),
            strict("", '<h2 class="c-articulo__titulo_x"><a class="c-articulo__titulo__txt" href="/z">no</a></h2>'),
        ]
    )
    base = EL_TIEMPO.base_url
    assert items(extract.strict_articles, html) == [
        ("Deportes", "Una noticia", f"{base}/a"),
        ("Mundo/Europa", "Una noticia", f"{base}/a"),
        ("Mundo", "Una noticia", "http://b/c"),
        ("Sin categoría", "Una noticia", f"{base}#ancla"),
    ]


def test_strict_articles_take_the_h2_before_the_h3(items):
    html = strict("", strict_title("h3", text="el tercero") + strict_title("h2", text="el segundo"))
    assert [title for _, title, _ in items(extract.strict_articles, html)] == ["el segundo"]


def card(body: str, cls: str = "Card Card-Big") -> str:
    return f'<div class="{cls}">{body}</div>'


def test_cards(items):
    link = f"{ESPECTADOR}/politica-nacional/x/"
    html = "".join(
        [
            card(f'<h4 class="Card-Section"><a href="{link}">Política</a></h4><h2 class="Card-Title"><a>Once letras</a></h2>'),
            card(f'<a href="{link}2">Texto del enlace</a>'),
            card(f'<a href="{link}3">ignorado</a><h4 class="Card-Section"> Sección </h4><h2 class="z Card-Title">Título <b>sin</b> enlace</h2>'),
            card(f'<a href="{link}4">1234567890</a>'),
            card(f'<a href="{link}5">12345678901</a>'),
            card(f'<a href="{ESPECTADOR}/autores/x">Un autor conocido</a>'),
            card('<a href="https://otro.com/x/y">Noticia de otro sitio</a>'),
            card(f'<a href="{ESPECTADOR}">Portada del periódico</a>'),
            card("<p>sin enlace alguno</p>"),
            f'<span class="Card"><a href="{link}6">No es un bloque</a></span>',
        ]
    )
    assert items(extract.cards, html) == [
        ("Política", "Once letras", link),
        ("Politica Nacional", "Texto del enlace", f"{link}2"),
        ("Sección", "Títulosinenlace", f"{link}3"),
        ("Politica Nacional", "12345678901", f"{link}5"),
    ]


def test_nested_cards_each_count(items):
    html = card(card(f'<a href="{ESPECTADOR}/a/1">Primera noticia</a>') + card(f'<a href="{ESPECTADOR}/a/2">Segunda noticia</a>'))
    assert [link for _, _, link in items(extract.cards, html)] == [f"{ESPECTADOR}/a/1", f"{ESPECTADOR}/a/1", f"{ESPECTADOR}/a/2"]
    assert [link for _, _, link in items(extract.cards_and_headings, html)] == [f"{ESPECTADOR}/a/1", f"{ESPECTADOR}/a/2"]


def test_headings_come_after_cards_and_repeat_no_link(items):
    html = (
        f'<h3><a href="{ESPECTADOR}/b/9">Titular suelto largo</a></h3>'
        + card(f'<a href="{ESPECTADOR}/a/1">Texto de la tarjeta</a>')
        + f'<h1><a href="{ESPECTADOR}/a/1">Mismo enlace otra vez</a></h1><h4><a href="/relativo/x">Enlace relativo aquí</a></h4>'
    )
    assert items(extract.cards_and_headings, html) == [
        ("A", "Texto de la tarjeta", f"{ESPECTADOR}/a/1"),
        ("B", "Titular suelto largo", f"{ESPECTADOR}/b/9"),
    ]
    assert [link for _, _, link in items(extract.heading_links, html)] == [f"{ESPECTADOR}/b/9", f"{ESPECTADOR}/a/1"]


def test_generic_articles(items):
    html = (
        '<article><h2>Segundo nivel aquí</h2><h1>Primer nivel aquí</h1><a href="/x">ver</a><i class="my-category">Tema</i></article>'
        '<article><a class="the-headline" href="http://o/y">Titular enlazado</a></article>'
        '<article><a href="/z">Enlace sin clase de titular</a></article>'
        "<article><h3>Diez letra</h3></article>"
        "<article><h3>Titular sin enlace</h3></article>"
        '<div class="news-item"><h1>Un bloque que no cuenta</h1></div>'
    )
    base = EL_TIEMPO.base_url
    assert items(extract.generic_articles, html) == [
        ("Tema", "Primer nivel aquí", f"{base}/x"),
        ("General", "Titular enlazado", "http://o/y"),
        ("General", "Titular sin enlace", ""),
    ]


def test_generic_blocks_without_articles(items):
    html = '<div class="news-item"><h1>Bloque de noticias</h1></div><div class="x"><h1>Otro bloque cualquiera</h1></div>'
    assert [title for _, title, _ in items(extract.generic_articles, html)] == ["Bloque de noticias"]


def test_generic_links_without_blocks(items):
    html = (
        '<a href="/a">Noticia repetida</a><a href="/b">Noticia repetida</a><a href="#c">Compartir esta noticia</a>'
        '<a href="d">Enlace con <i class="section">Tema</i></a><a>Enlace sin destino</a><a href>Destino vacío aquí</a>'
    )
    base = EL_ESPECTADOR.base_url
    assert items(extract.generic_articles_or_links, html) == [
        ("General", "Noticia repetida", f"{base}/a"),
        ("Tema", "Enlace conTema", "d"),
        ("General", "Destino vacío aquí", ""),
    ]


def test_generic_article_titles_end_with_any_link(items):
    html = '<article><a href="/z">Enlace sin clase de titular</a></article><article><h1>Buscar en el sitio</h1></article>'
    assert items(extract.generic_articles_or_links, html) == [
        ("General", "Enlace sin clase de titular", f"{EL_ESPECTADOR.base_url}/z")
    ]


def test_damaged_markup(items):
    html = (
        "<script>var t='<h1>no es un titular</h1>';</script><!-- <article><h1>tampoco esto lo es</h1></article> -->"
        "<article><p><b>sin cerrar<br><h1>Titular &amp; más &ntilde;<script>x</script></h1><img class='a'></article>"
        "</div></p><article><h1>Otro titular sin cerrar"
    )
    assert [title for _, title, _ in items(extract.generic_articles, html)] == ["Titular & más ñ", "Otro titular sin cerrar"]


def test_articles_without_headings(spark):
    """Articles whose first links are their headlines."""
    html = """
    <html><head><title>Portada</title></head><body>
      <article><a href="/clima/lluvias">Lluvias en el altiplano</a><span class="categoria">Clima</span></article>
      <article><a href="/campo/cafe">Cosecha de café en Huila</a><span class="categoria">Campo</span></article>
    </body></html>"""
    pages = spark.createDataFrame([("raw/elespectador-2019-07-03.html", html)], "path STRING, html STRING")
    rows = extract_headlines(pages, "2024-02-01", generic=True).orderBy("position").collect()
    assert [(r.titular, r.enlace) for r in rows] == [
        ("Lluvias en el altiplano", f"{ESPECTADOR}/clima/lluvias"),
        ("Cosecha de café en Huila", f"{ESPECTADOR}/campo/cafe"),
    ]
    assert {(r.fecha, r.year, r.month, r.day, r.periodico) for r in rows} == {("2019-07-03", "2019", "07", "03", "elespectador")}


def test_text_between_tags_is_joined_before_it_is_trimmed(items):
    html = (
        "<article><h1>Si a < b y b <c, a < c &amp; ya &lt; 3 &#233;</h1></article>"
        "<article><h1> Uno <!-- nota --> dos <b> tres </b></h1></article>"
        "<article><h1>Fuera<script>var x = '<h1>no</h1>';</script> de casa</h1></article>"
    )
    titles = [title for _, title, _ in items(extract.generic_articles, html)]
    assert titles == ["Si a < b y bya < 3 é", "Unodostres"] or titles[0].startswith("Si a < b y b")
    assert "Fuerade casa" in titles


def test_unclosed_links_take_memory_in_proportion_to_the_page():
    from rotativa.functions.outline import _outline

    small, large = (_outline('<a href="/x">texto' * n) for n in (2_000, 20_000))
    for page, n in ((small, 2_000), (large, 20_000)):
        assert len(page["pieces"]) == len(page["elements"]) == n
        assert [e["pieces"] for e in page["elements"][:3]] == [n, n - 1, n - 2]
    stray = _outline("<div><b>" * 20_000 + "</i>" * 20_000)
    assert stray["elements"] == []


def test_rejected_pages(spark):
    from rotativa.plans.headlines import page_rejects

    title = "<article><h1>Un titular bastante largo</h1></article>"
    rows = [("eltiempo-1.html", None), ("eltiempo-2.html", ""), ("eltiempo-3.html", "<p>nada</p>"), ("eltiempo-4.html", title), ("otro.html", title)]
    pages = spark.createDataFrame(rows, "path STRING, html STRING")
    assert {tuple(r) for r in page_rejects(pages, generic=True).collect()} == {
        ("eltiempo-1.html", "not decodable"),
        ("eltiempo-2.html", "empty"),
        ("eltiempo-3.html", "no headline"),
        ("otro.html", "no headline"),
    }


def test_source_by_content_for_names_that_tell_nothing(spark):
    from rotativa.functions.paths import SOURCE_DOMAINS

    html = f"<article><h1>Un titular bastante largo</h1><a href='{ESPECTADOR}/x'>leer</a></article>"
    pages = spark.createDataFrame([("otro.html", html)], "path STRING, html STRING")
    assert extract_headlines(pages, "2024-02-01", generic=True).count() == 0
    found = extract_headlines(pages, "2024-02-01", generic=True, domains=SOURCE_DOMAINS).collect()
    assert [(r.periodico, r.titular) for r in found] == [("elespectador", "Un titular bastante largo")]


def test_dispatch(spark):
    strict_page = strict('data-category="C"', strict_title())
    card_page = card(f'<a href="{ESPECTADOR}/a/1">Texto de la tarjeta</a>')
    pages = spark.createDataFrame(
        [
            ("eltiempo-2024-01-01.html", strict_page + card_page),
            ("elespectador-2024-01-02.html", strict_page + card_page),
            ("otro.html", strict_page + card_page),
            ("nadie.html", card_page),
            ("vacio.html", "<p>nada</p>"),
            ("eltiempo-nulo.html", None),
        ],
        "path STRING, html STRING",
    )
    found = {(r.path, r.titular, r.fecha, r.periodico) for r in extract_headlines(pages, "2024-02-01").collect()}
    assert found == {
        ("eltiempo-2024-01-01.html", "Una noticia", "2024-01-01", "eltiempo"),
        ("elespectador-2024-01-02.html", "Texto de la tarjeta", "2024-01-02", "elespectador"),
        ("otro.html", "Una noticia", "2024-02-01", "unknown"),
        ("nadie.html", "Texto de la tarjeta", "2024-02-01", "unknown"),
    }
    run_dated = extract_headlines(pages, "2024-02-01", always_run_date=True)
    assert {r.fecha for r in run_dated.collect()} == {"2024-02-01"}
    assert {r.periodico for r in extract_headlines(pages, "2024-02-01", generic=True).collect()} <= {"eltiempo", "elespectador"}


def test_in_page_order_is_kept(items):
    """Many repeated links in one page: the first of each stays, in page order."""
    numbers = [(i * 37) % 50 for i in range(400)]
    html = "".join(card(f'<a href="{ESPECTADOR}/n/{n}">Noticia número {i}</a>') for i, n in enumerate(numbers))
    expected = []
    for i, n in enumerate(numbers):
        if n not in [m for _, m in expected]:
            expected.append((i, n))
    found = items(extract.cards_and_headings, html)
    assert [(title, link) for _, title, link in found] == [(f"Noticia número {i}", f"{ESPECTADOR}/n/{n}") for i, n in expected]


def test_page_census(spark):
    html = card(f'<a href="{ESPECTADOR}/a/1">x</a>') + '<a class="z" href="/q">y</a><a name="n">z</a>'
    pages = spark.createDataFrame([(1, html)], "page_id BIGINT, html STRING")
    assert extract.page_census(pages, extract.cards(F.col("outline"))).first().asDict() == {
        "page_id": 1,
        "headlines": 0,
        "html_length": len(html),
        "links": 2,
        "cards": 1,
        "site_links": 1,
    }


def test_verdicts_on_items(spark, items):
    """Every item has its first broken rule, and those without one are what the profile gives."""
    card = '<div class="Card"><h2 class="Card-Title"><a href="{}">{}</a></h2></div>'
    html = "".join(
        [
            card.format(f"{ESPECTADOR}/a/1", "Titular bastante largo"),
            card.format("https://otro.example/a", "Titular de otro sitio"),
            card.format(f"{ESPECTADOR}/a/2", "Corto"),
            '<div class="Card"><h2 class="Card-Title">Tarjeta sin ningún enlace</h2></div>',
            f'<h3><a href="{ESPECTADOR}/a/1">El mismo enlace otra vez</a></h3>',
            f'<h3><a href="{ESPECTADOR}/b/3">Otro titular bastante largo</a></h3>',
        ]
    )
    pages = extract.with_outline(spark.createDataFrame([("p", html)], "path STRING, html STRING"))
    judged = extract.cards_and_headings(F.col("outline"), judge=True)
    found = pages.select(F.explode(judged).alias("i")).select("i.titular", "i.reason").collect()
    assert [(r.titular, r.reason) for r in found][:4] == [
        ("Titular bastante largo", None),
        ("Titular de otro sitio", "foreign link"),
        ("Corto", "short title"),
        ("Tarjeta sin ningún enlace", "no link"),
    ]
    assert {r.titular: r.reason for r in found if r.reason != "no link"} | {} == {
        "Titular bastante largo": "repeat",  # its heading holds the same link
        "Titular de otro sitio": "foreign link",
        "Corto": "short title",
        "El mismo enlace otra vez": "repeat",
        "Otro titular bastante largo": None,
    }
    for profile in (
        extract.strict_articles,
        extract.cards,
        extract.heading_links,
        extract.cards_and_headings,
        extract.generic_articles,
        extract.generic_articles_or_links,
    ):
        assert items(lambda outline: extract.kept_items(profile(outline, judge=True)), html) == items(profile, html)
    rejects = extract.rejected_items(pages.withColumn("items", judged), F.col("items"))
    assert rejects.columns == ["path", "place", "categoria", "titular", "enlace", "reason"]
    assert rejects.count() == sum(r.reason is not None for r in found)


def test_few_outlines_are_python_objects_at_a_time(monkeypatch):
    """A batch of many pages becomes Arrow's memory in parts; the outlines are the same."""
    pages = pa.array([f"<h1>Titular número {i}</h1>" if i % 7 else None for i in range(100)])
    whole, made = outline._outlines(pages), []
    monkeypatch.setattr(outline, "PARSED_CHARACTERS", 200, raising=False)
    monkeypatch.setattr(outline, "pa", SimpleNamespace(array=lambda x, type: made.append(len(x)) or pa.array(x, type=type), concat_arrays=pa.concat_arrays))
    assert outline._outlines(pages).equals(whole) and len(whole) == 100
    assert sum(made) == 100 and max(made) < 20
    assert len(outline._outlines(pages.slice(0, 0))) == 0
