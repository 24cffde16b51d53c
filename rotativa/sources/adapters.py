"""Views of the generic test tables in the headline model.

``documents``, ``pages`` and ``events`` stand in for landed front pages and
headline rows.  Every adapter covers its whole table and whole texts.
"""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, functions as F

from rotativa.functions.dates import date_parts

FIRST_DAY = "2024-01-01"


def document_headlines(documents: DataFrame) -> DataFrame:
    """One headline per line of each document, as text columns plus partition values.

    Sixty publication days, the language as category (one language has none) and
    a link that is unique per line.
    """
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % 60).cast("int"))
    lines = documents.select(
        "doc_id", "lang", "source", day.alias("day_of"), F.posexplode(F.split("text", "\n")).alias("line", "titular")
    )
    link = F.concat_ws("/", F.lit("https://www.example.org"), "lang", F.col("doc_id").cast("string"), F.col("line").cast("string"))
    return lines.select(
        F.col("day_of").cast("string").alias("fecha"),
        F.nullif(F.col("lang"), F.lit("fr")).alias("categoria"),
        "titular",
        link.alias("enlace"),
        F.col("source").alias("periodico"),
        *[part.alias(name) for name, part in date_parts(F.col("day_of")).items()],
    )


def document_news(documents: DataFrame) -> DataFrame:
    """Document headlines with a typed date and an insertion time, as the sink holds them."""
    rows = document_headlines(documents)
    hour = F.length("titular") % 24
    return rows.select(
        F.col("fecha").cast("date").alias("fecha"),
        "categoria",
        "titular",
        "enlace",
        "periodico",
        (
            F.col("fecha").cast("timestamp_ntz") + F.make_dt_interval(hours=hour)
        ).alias("created_at"),
    )


def raw_pages(pages: DataFrame) -> DataFrame:
    """Pages under the path a landed front page has: ``raw/<host>-<date>.html``."""
    host = F.regexp_extract("url", r"^https?://([^/?#]+)", 1)
    day = F.lpad((F.col("page_id") % 30 + 1).cast("string"), 2, "0")
    return pages.select(
        "page_id",
        "url",
        F.concat(F.lit("raw/"), host, F.lit("-2024-01-"), day, F.lit(".html")).alias("path"),
        host.alias("host"),
        "html",
    )


def _with_title(pages: DataFrame) -> DataFrame:
    return pages.withColumn("h1", F.regexp_extract("html", r"(?s)<h1>(.*?)</h1>", 1)).withColumn(
        "lang", F.regexp_extract("url", r"^https?://[^/?#]+/([^/?#]*)", 1)
    )


def _linked_html() -> Column:
    block = F.concat(F.lit("<h1>"), "h1", F.lit("</h1>"))
    link = F.concat(F.lit('<h1><a href="'), "url", F.lit('">'), "h1", F.lit("</a></h1>"))
    return F.replace("html", block, link)


def linked_pages(pages: DataFrame) -> DataFrame:
    """Pages whose main title is a link to the page itself."""
    titled = _with_title(raw_pages(pages))
    return titled.select("page_id", "url", "path", "host", _linked_html().alias("html"))


def card_pages(pages: DataFrame) -> DataFrame:
    """Pages with a linked title and one more card that holds the title as a link.

    The card of a page from an ``.org`` host has no section, so that its category
    comes from the link.
    """
    titled = _with_title(raw_pages(pages))
    section = F.when(
        ~F.col("host").endswith(".org"),
        F.concat(F.lit('<h4 class="Card-Section"><a>'), "lang", F.lit("</a></h4>")),
    ).otherwise("")
    card = F.concat(
        F.lit('<div class="Card Card_wide">'),
        section,
        F.lit('<h2 class="Card-Title"><a href="'),
        "url",
        F.lit('">'),
        "h1",
        F.lit("</a></h2></div>"),
    )
    return titled.select(
        "page_id", "url", "path", "host", F.concat(_linked_html(), card).alias("html")
    )


def strict_pages(pages: DataFrame) -> DataFrame:
    """Pages with one more article in the strict markup, linked by a relative path.

    ``.net`` hosts have a section and a subsection, ``.org`` hosts a section only,
    the others the category attribute.
    """
    titled = _with_title(raw_pages(pages))
    attributes = (
        F.when(F.col("host").endswith(".net"), F.concat(F.lit(' data-seccion="'), "lang", F.lit('" data-subseccion="net"')))
        .when(F.col("host").endswith(".org"), F.concat(F.lit(' data-category="x" data-seccion="'), "lang", F.lit('"')))
        .otherwise(F.concat(F.lit(' data-category="'), "lang", F.lit('"')))
    )
    article = F.concat(
        F.lit('<article class="c-articulo"'),
        attributes,
        F.lit('><h3 class="c-articulo__titulo"><a class="c-articulo__titulo__txt" href="/'),
        "lang",
        F.lit('/nota">'),
        "h1",
        F.lit("</a></h3></article>"),
    )
    return titled.select("page_id", "url", "path", "host", F.concat("html", article).alias("html"))


def unblocked_pages(pages: DataFrame) -> DataFrame:
    """Pages without any article or block element, so that only links are left."""
    return raw_pages(pages).withColumn("html", F.regexp_replace("html", "</?article>", ""))


def event_arrivals(events: DataFrame) -> DataFrame:
    """Arriving rows at volume: date, category and source of each event."""
    return events.select(
        "event_id",
        "ts",
        F.col("ts").cast("date").alias("fecha"),
        F.col("event_type").alias("categoria"),
        F.concat(F.lit("src"), (F.col("user_id") % 4).cast("string")).alias("periodico"),
    )


def object_keys(documents: DataFrame) -> DataFrame:
    """One object key per document, with the faults that listings have.

    By document number: an unpadded month, a missing level, an impossible date, a
    value holding ``=``, a repeated level, and otherwise a regular key.
    """
    day_of = F.date_add(F.lit(FIRST_DAY).cast("date"), (F.col("doc_id") % 60).cast("int")).cast("string")
    month, day = F.substring(day_of, 6, 2), F.substring(day_of, 9, 2)
    fault = F.col("doc_id") % 12
    month_value = (
        F.when(fault == 5, F.ltrim(month, F.lit("0"))).when(fault == 7, "13").otherwise(month)
    )
    day_level = (
        F.when(fault == 6, "")
        .when(fault == 8, F.concat(F.lit("/day="), day, F.lit("=x")))
        .when(fault == 9, F.concat(F.lit("/day=00/day="), day))
        .otherwise(F.concat(F.lit("/day="), day))
    )
    raw = F.concat(F.lit("headlines/raw/"), "source", F.lit("-"), day_of, F.lit(".html"))
    final = F.concat(
        F.lit("headlines/final/periodico="),
        "source",
        F.lit("/year=2024/month="),
        month_value,
        day_level,
        F.lit("/f"),
        F.col("doc_id").cast("string"),
        F.lit(".csv"),
    )
    key = F.when(fault == 10, raw).otherwise(final)
    return documents.select("doc_id", "lang", key.alias("key"), F.col("n_chars").alias("bytes"))


def land_objects(objects: DataFrame, store: str) -> None:
    """Write the bodies of ``bucket, key, content`` as objects below ``store``, each in the task that holds it."""

    def land(batches):
        for batch in batches:
            for place in range(batch.num_rows):  # one body at a time is Python's object
                bucket, key, content = (batch.column(name)[place].as_py() for name in ("bucket", "key", "content"))
                system, base = fs.FileSystem.from_uri(store + bucket)
                system.create_dir(f"{base}/{key}".rpartition("/")[0], recursive=True)
                with system.open_output_stream(f"{base}/{key}") as stream:
                    stream.write(content)
            yield batch.select(["key"])

    objects.select("bucket", "key", "content").mapInArrow(land, "key STRING").write.format("noop").mode("overwrite").save()
