"""Queries over raw pages: scan, sources, links, markup profiles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rotativa.functions import links, paths
from rotativa.functions import text as text_functions
from rotativa.functions.outline import page_outline, page_text
from rotativa.operators import extract
from rotativa.plans.headlines import batch_counts, extract_headlines, follow_announced, follow_arriving, page_rejects as rejects_of
from rotativa.queries.base import (
    PAGES,
    STRICT_SITE,
    TEST_NAMES,
    TEST_SITE,
    URL_CATEGORY,
    decoded,
    query,
    table,
    title_case,
)
from rotativa.session import new_folder
from rotativa.sources import adapters
from rotativa.sources.headlines import read_headline_files
from rotativa.sources.pages import decode_pages, readable_pages
from rotativa.streaming.ingest import arriving_table


def pages(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages")


def _anchors(spark: SparkSession, folder: str) -> DataFrame:
    """Every link of every page as ``page_id, position, enlace, markup``."""
    pattern = F.lit(r'(?s)<a href="([^"]*)">(.*?)</a>')
    raw = pages(spark, folder)
    found = F.zip_with(
        F.regexp_extract_all("html", pattern, F.lit(1)),
        F.regexp_extract_all("html", pattern, F.lit(2)),
        lambda link, markup: F.struct(link.alias("enlace"), markup.alias("markup")),
    )
    return raw.select("page_id", F.posexplode(found).alias("position", "link")).select(
        "page_id", "position", "link.enlace", "link.markup"
    )


ANCHORS = """
anchors AS (
    SELECT page_id, CAST(unnest(range(len(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 1, 's')))) AS INTEGER) AS position,
           unnest(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 1, 's')) AS enlace,
           unnest(regexp_extract_all(html, '<a href="([^"]*)">(.*?)</a>', 2, 's')) AS markup
    FROM pages
)"""


# --- scan and sources ---------------------------------------------------------


@query(
    "raw_pages_scan",
    f"""
    WITH {PAGES}
    SELECT path, CAST('2024-01-' || dd AS DATE) AS fetch_date, host AS source, html FROM raw_pages
    WHERE html IS NOT NULL AND html <> ''
    """,
)
def raw_pages_scan(spark, folder):
    raw = adapters.raw_pages(pages(spark, folder))
    return readable_pages(
        raw.select("path", paths.date_in_name(F.col("path")).alias("fetch_date"), F.col("host").alias("source"), "html")
    )


def _named(spark: SparkSession, folder: str) -> DataFrame:
    """Page files under names with every spelling of the extension."""
    extension = (
        F.when(F.col("page_id") % 4 == 0, ".html")
        .when(F.col("page_id") % 4 == 1, ".HTML")
        .when(F.col("page_id") % 4 == 2, ".htm")
        .otherwise(".html.bak")
    )
    raw = adapters.raw_pages(pages(spark, folder))
    return raw.select("page_id", F.concat(F.replace("path", F.lit(".html"), F.lit("")), extension).alias("path"))


NAMED = f"""{PAGES},
named AS (
    SELECT page_id, replace(path, '.html', '') ||
           CASE page_id % 4 WHEN 0 THEN '.html' WHEN 1 THEN '.HTML' WHEN 2 THEN '.htm' ELSE '.html.bak' END AS path
    FROM raw_pages
)"""


@query(
    "html_name_filter",
    f"""
    WITH {NAMED}
    SELECT page_id, path, suffix(path, '.html') AS exact FROM named WHERE suffix(lower(path), '.html')
    """,
)
def html_name_filter(spark, folder):
    named = _named(spark, folder)
    return named.where(paths.is_html_name(F.col("path"))).withColumn(
        "exact", paths.is_html_name(F.col("path"), ignore_case=False)
    )


@query(
    "file_base_name",
    f"""
    WITH {NAMED}
    SELECT page_id, replace(string_split(path, '/')[-1], '.html', '') AS base_name FROM named
    """,
)
def file_base_name(spark, folder):
    return _named(spark, folder).select("page_id", paths.file_base_name(F.col("path")).alias("base_name"))


@query(
    "source_detect",
    f"""
    WITH {PAGES}
    SELECT page_id, CASE WHEN contains(lower(path), 'example.org') THEN 'org'
                         WHEN contains(lower(path), 'example.com') THEN 'com' ELSE 'unknown' END AS periodico
    FROM raw_pages
    """,
)
def source_detect(spark, folder):
    raw = adapters.raw_pages(pages(spark, folder))
    return extract.with_source(raw, TEST_NAMES).select("page_id", "periodico")


@query(
    "source_detect_content",
    """
    SELECT page_id, CASE WHEN contains(lower(html), 'example.org') THEN 'org'
                         WHEN contains(lower(html), 'example.com') THEN 'com' ELSE 'unknown' END AS periodico
    FROM pages
    """,
)
def source_detect_content(spark, folder):
    return extract.with_source_from_content(pages(spark, folder), TEST_NAMES).select("page_id", "periodico")


# --- links and titles ---------------------------------------------------------


@query(
    "absolute_links",
    f"""
    WITH {ANCHORS}
    SELECT page_id, position,
           CASE WHEN enlace <> '' AND NOT starts_with(enlace, 'http') THEN 'https://www.example.org' || enlace ELSE enlace END AS any_relative,
           CASE WHEN starts_with(enlace, '/') THEN 'https://www.example.org' || enlace ELSE enlace END AS rooted
    FROM anchors
    """,
)
def absolute_links(spark, folder):
    return _anchors(spark, folder).select(
        "page_id",
        "position",
        links.absolute_link(F.col("enlace"), TEST_SITE.base_url).alias("any_relative"),
        links.absolute_link(F.col("enlace"), TEST_SITE.base_url, only_rooted=True).alias("rooted"),
    )


@query(
    "link_filter",
    """
    SELECT page_id, url FROM pages WHERE contains(url, 'example.org') AND NOT contains(url, 'utm_source')
    """,
)
def link_filter(spark, folder):
    return pages(spark, folder).where(links.is_site_link(F.col("url"), TEST_SITE)).select("page_id", "url")


@query("url_category", f"SELECT page_id, {URL_CATEGORY} AS categoria FROM pages")
def url_category(spark, folder):
    return pages(spark, folder).select("page_id", links.url_category(F.col("url")).alias("categoria"))


@query("title_case", f"SELECT page_id, {title_case('url')} AS title FROM pages")
def title_case_of_urls(spark, folder):
    return pages(spark, folder).select("page_id", text_functions.title_case(F.col("url")).alias("title"))


@query(
    "node_text",
    f"""
    WITH pieces AS (
        SELECT page_id, string_split_regex(regexp_replace(html, '<(script|style)>.*?</(script|style)>', '<>', 'gs'), '<[^>]*>') AS p
        FROM pages
    )
    SELECT page_id, list_aggregate(list_transform(p, lambda x: regexp_replace({decoded('x')}, '^\\s+|\\s+$', '', 'g')),
                                   'string_agg', '') AS text
    FROM pieces
    """,
)
def node_text(spark, folder):
    """Text of each whole page, by the outline that the extraction uses."""
    outlined = pages(spark, folder).select("page_id", page_outline(F.col("html")).alias("outline"))
    return outlined.select("page_id", page_text(F.col("outline")).alias("text"))


@query(
    "title_length_filter",
    f"""
    WITH {ANCHORS}
    SELECT page_id, position, {decoded('markup')} AS titular FROM anchors WHERE length({decoded('markup')}) > 10
    """,
)
def title_length_filter(spark, folder):
    titled = _anchors(spark, folder).select(
        "page_id", "position", text_functions.node_text(F.col("markup")).alias("titular")
    )
    return titled.where(extract.is_long_title(F.col("titular")))


@query(
    "title_prefix_filter",
    f"""
    WITH {ANCHORS}
    SELECT page_id, position, {decoded('markup')} AS titular FROM anchors
    WHERE NOT starts_with(lower({decoded('markup')}), 'th') AND NOT starts_with(lower({decoded('markup')}), 'la')
    """,
)
def title_prefix_filter(spark, folder):
    titled = _anchors(spark, folder).select(
        "page_id", "position", text_functions.node_text(F.col("markup")).alias("titular")
    )
    return titled.where(~extract.has_denied_prefix(F.col("titular"), ("th", "la")))


@query(
    "page_census",
    r"""
    SELECT page_id, length(html) AS html_length,
           CASE WHEN length(HEADING) > 10 THEN 1 ELSE 0 END AS headlines,
           len(regexp_extract_all(html, '(?i)<a\s[^>]*href')) AS links,
           len(regexp_extract_all(html, '(?i)<div\s[^>]*class="[^"]*Card')) AS cards,
           len(regexp_extract_all(html, '(?i)<a\s[^>]*href="[^"]*example\.org')) AS site_links
    FROM pages
    """.replace("HEADING", decoded("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")),
)
def page_census(spark, folder):
    return extract.page_census(pages(spark, folder), extract.generic_articles(F.col("outline"), TEST_SITE), TEST_SITE)


# --- markup profiles ----------------------------------------------------------


def _items(raw: DataFrame, profile: Callable[..., Column], *site, **options) -> DataFrame:
    items = profile(F.col("outline"), *site, **options)
    rows = extract.headlines_of(extract.with_outline(raw), items)
    return rows.select("page_id", "position", "categoria", "titular", "enlace")


STRICT_ROWS = f"""
strict_rows AS (
    SELECT page_id, host, path, CASE WHEN suffix(host, '.net') THEN lang || '/net' ELSE lang END AS categoria,
           {decoded('h1')} AS titular, 'https://www.example.com/' || lang || '/nota' AS enlace
    FROM raw_pages WHERE {decoded('h1')} <> ''
)"""


@query(
    "strict_articles",
    f"""
    WITH {PAGES}, {STRICT_ROWS}
    SELECT page_id, 0 AS position, categoria, titular, enlace FROM strict_rows
    """,
)
def strict_articles(spark, folder):
    raw = adapters.strict_pages(pages(spark, folder))
    return _items(raw, extract.strict_articles, STRICT_SITE)


CARD_ROWS = f"""
card_rows AS (
    SELECT page_id, host, path, CASE WHEN suffix(host, '.org') THEN {URL_CATEGORY} ELSE lang END AS categoria,
           {decoded('h1')} AS titular, url AS enlace
    FROM raw_pages
    WHERE length({decoded('h1')}) > 10 AND contains(url, 'example') AND NOT contains(url, 'utm_source')
)"""
HEADING_ROWS = f"""
heading_rows AS (
    SELECT page_id, {URL_CATEGORY} AS categoria, {decoded('h1')} AS titular, url AS enlace
    FROM raw_pages
    WHERE length({decoded('h1')}) > 10 AND contains(url, 'example.org') AND NOT contains(url, 'utm_source')
)"""

# A site that matches every test host, so that cards with and without a section occur.
ANY_HOST = TEST_SITE.__class__("any", "example", "https://www.example.org", TEST_SITE.denied_words)


@query(
    "card_headlines",
    f"""
    WITH {PAGES}, {CARD_ROWS}
    SELECT page_id, 0 AS position, categoria, titular, enlace FROM card_rows
    """,
)
def card_headlines(spark, folder):
    raw = adapters.card_pages(pages(spark, folder))
    return _items(raw, extract.cards, ANY_HOST, exact_address=False)


@query(
    "heading_links",
    f"""
    WITH {PAGES}, {HEADING_ROWS}
    SELECT page_id, 0 AS position, categoria, titular, enlace FROM heading_rows
    """,
)
def heading_links(spark, folder):
    raw = adapters.linked_pages(pages(spark, folder))
    return _items(raw, extract.heading_links, TEST_SITE, exact_address=False)


@query(
    "dedupe_by_link",
    f"""
    WITH {PAGES}, {CARD_ROWS}
    SELECT page_id, 0 AS position, categoria, titular, enlace FROM card_rows
    """,
)
def dedupe_by_link(spark, folder):
    """Card, linked title and card title share a link: the card is kept."""
    raw = adapters.card_pages(pages(spark, folder))
    return _items(raw, extract.cards_and_headings, ANY_HOST, exact_address=False)


@query(
    "article_headlines",
    f"""
    WITH {PAGES}
    SELECT page_id, 0 AS position, 'General' AS categoria, {decoded('h1')} AS titular, '' AS enlace
    FROM raw_pages WHERE length({decoded('h1')}) > 10
    """,
)
def article_headlines(spark, folder):
    raw = adapters.raw_pages(pages(spark, folder))
    return _items(raw, extract.generic_articles, TEST_SITE)


def _link_titles(longer_than: int) -> str:
    return f"""
    WITH {ANCHORS},
    titled AS (
        SELECT page_id, position, {decoded('markup')} AS titular,
               CASE WHEN starts_with(enlace, '/') THEN 'https://www.example.org' || enlace ELSE enlace END AS enlace
        FROM anchors
    ),
    kept AS (
        SELECT * FROM titled
        WHERE length(titular) > {longer_than} AND NOT starts_with(lower(titular), 'buscar')
          AND NOT starts_with(lower(titular), 'seguir') AND NOT starts_with(lower(titular), 'compartir')
        QUALIFY row_number() OVER (PARTITION BY page_id, titular ORDER BY position) = 1
    )
    SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY position) - 1 AS INTEGER) AS position,
           'General' AS categoria, titular, enlace
    FROM kept
    """


@query("anchor_headlines", _link_titles(10))
def anchor_headlines(spark, folder):
    raw = adapters.unblocked_pages(pages(spark, folder))
    return _items(raw, extract.generic_articles_or_links, TEST_SITE)


@query("dedupe_by_title", _link_titles(0))
def dedupe_by_title(spark, folder):
    """Titles of any length, so that repeated ones occur in most pages."""
    raw = adapters.unblocked_pages(pages(spark, folder))
    return _items(raw, extract.generic_articles_or_links, TEST_SITE, longer_than=0)


@query(
    "item_verdicts",
    f"""
    WITH {ANCHORS},
    titled AS (SELECT page_id, position, {decoded('markup')} AS titular FROM anchors),
    judged AS (
        SELECT *, CASE WHEN length(titular) <= 10 THEN 'short title'
                       WHEN regexp_matches(lower(titular), '^(buscar|seguir|compartir)') THEN 'denied prefix' END AS broken
        FROM titled
    )
    SELECT page_id, position AS place, titular,
           CASE WHEN broken IS NULL AND row_number() OVER (PARTITION BY page_id, titular, broken ORDER BY position) > 1
                THEN 'repeat' ELSE broken END AS reason
    FROM judged
    """,
)
def item_verdicts(spark, folder):
    """Every link of every page with its verdict; NULL is a headline."""
    raw = extract.with_outline(adapters.unblocked_pages(pages(spark, folder)))
    judged = extract.generic_articles_or_links(F.col("outline"), TEST_SITE, judge=True)
    rows = raw.select("page_id", F.posexplode(judged).alias("place", "item"))
    return rows.select("page_id", "place", "item.titular", "item.reason")


# --- whole extraction ---------------------------------------------------------


@query(
    "headline_stamp",
    f"""
    WITH {PAGES}
    SELECT page_id, CASE WHEN page_id % 6 = 0 THEN '2024-02-01' ELSE '2024-01-' || dd END AS fecha FROM raw_pages
    """,
)
def headline_stamp(spark, folder):
    """Names with a date, without one, and with an impossible one before it."""
    path = (
        F.when(F.col("page_id") % 6 == 0, "raw/portada.html")
        .when(F.col("page_id") % 6 == 1, F.replace("path", F.lit("raw/"), F.lit("raw/1234-56-78-")))
        .otherwise(F.col("path"))
    )
    raw = adapters.raw_pages(pages(spark, folder)).withColumn("path", path)
    return extract.stamp(raw, "2024-02-01").select("page_id", "fecha")


@query(
    "page_rejects",
    f"""
    WITH {PAGES}
    SELECT path, CASE WHEN page_id % 7 = 0 THEN 'not decodable' WHEN page_id % 7 = 1 THEN 'empty' ELSE 'no headline' END AS reason
    FROM raw_pages
    WHERE page_id % 7 IN (0, 1) OR length({decoded('h1')}) <= 10
       OR NOT (contains(lower(path), 'example.org') OR contains(lower(path), 'example.com'))
       OR (contains(lower(path), 'example.org') AND regexp_matches(lower({decoded('h1')}), '^(buscar|seguir|compartir)'))
    """,
)
def page_rejects(spark, folder):
    """Pages of a landing in which some bodies are damaged and some are empty: those without a headline, and why."""
    raw = adapters.raw_pages(pages(spark, folder))
    body = F.encode("html", "UTF-8")
    content = (
        F.when(F.col("page_id") % 7 == 0, F.concat(body, F.lit(bytes([0xFF]))))
        .when(F.col("page_id") % 7 == 1, F.lit(b""))
        .otherwise(body)
    )
    landed = decode_pages(raw.select("path", content.alias("content")))
    return rejects_of(landed, generic=True, sites=(STRICT_SITE, TEST_SITE), names=TEST_NAMES)


@query(
    "headline_dispatch",
    f"""
    WITH {PAGES}, {STRICT_ROWS}, {HEADING_ROWS},
    sourced AS (
        SELECT *, CASE WHEN contains(lower(path), 'example.org') THEN 'org'
                       WHEN contains(lower(path), 'example.com') THEN 'com' ELSE 'unknown' END AS periodico
        FROM raw_pages
    )
    SELECT path, 0 AS position, '2024-01-' || dd AS fecha, s.categoria, s.titular, s.enlace, periodico,
           '2024' AS year, '01' AS month, dd AS day
    FROM sourced JOIN strict_rows s USING (page_id, path) WHERE periodico <> 'org'
    """,
)
def headline_dispatch(spark, folder):
    """Site-specific extraction of whole pages; the ``org`` pages hold no card, so they give none."""
    raw = adapters.strict_pages(pages(spark, folder)).select("path", "html")
    return extract_headlines(raw, "2024-02-01", sites=(STRICT_SITE, TEST_SITE), names=TEST_NAMES, exact_address=False)


@query(
    "headline_dispatch_generic",
    f"""
    WITH {PAGES}
    SELECT path, 0 AS position, '2024-01-' || dd AS fecha, 'General' AS categoria, {decoded('h1')} AS titular,
           '' AS enlace, CASE WHEN contains(lower(path), 'example.org') THEN 'org' ELSE 'com' END AS periodico,
           '2024' AS year, '01' AS month, dd AS day
    FROM raw_pages
    WHERE length({decoded('h1')}) > 10
      AND (contains(lower(path), 'example.org') OR contains(lower(path), 'example.com'))
      AND NOT (contains(lower(path), 'example.org') AND regexp_matches(lower({decoded('h1')}), '^(buscar|seguir|compartir)'))
    """,
)
def headline_dispatch_generic(spark, folder):
    """Generic extraction; pages of unknown sources give no headline."""
    raw = adapters.raw_pages(pages(spark, folder)).select("path", "html")
    return extract_headlines(raw, "2024-02-01", generic=True, sites=(STRICT_SITE, TEST_SITE), names=TEST_NAMES)


@query(
    "followed_pages",
    f"""
    WITH {PAGES}, {STRICT_ROWS},
    sourced AS (
        SELECT *, CASE WHEN contains(lower(path), 'example.org') THEN 'org'
                       WHEN contains(lower(path), 'example.com') THEN 'com' ELSE 'unknown' END AS periodico
        FROM raw_pages
    )
    SELECT '2024-01-' || dd AS fecha, s.categoria, s.titular, s.enlace, periodico, '2024' AS year, '01' AS month, dd AS day
    FROM sourced JOIN strict_rows s USING (page_id, path) WHERE periodico <> 'org' AND page_id % 10 <> 0
    """,
)
def followed_pages(spark, folder):
    """Two halves of the pages arrive, so that every source and day gets pages twice, and then a fifth lands again.

    Half of those are as before, the others have lost their article and leave no headline.
    """
    root = new_folder(spark, "followed")
    raw = adapters.strict_pages(pages(spark, folder))
    path = F.concat(F.lit("raw/"), F.col("page_id").cast("string"), F.lit("/"), F.substring_index("path", "/", -1))
    body = F.encode("html", "UTF-8")
    landing = raw.select("page_id", path.alias("path"), F.lit("2024-02-01 08:00").cast("timestamp").alias("modified"), body.alias("content"))
    again = landing.where("page_id % 5 = 0").select(
        "page_id",
        F.upper("path").alias("path"),
        F.lit("2024-02-02 08:00").cast("timestamp").alias("modified"),
        F.when(F.col("page_id") % 10 == 0, F.encode(F.lit("<p></p>"), "UTF-8")).otherwise(F.col("content")).alias("content"),
    )
    halves = (landing.where("page_id % 2 = 0"), landing.where("page_id % 2 = 1"))
    for files in (*halves, again):
        files.drop("page_id").write.mode("append").parquet(f"{root}/landing")
        arriving = arriving_table(spark, f"{root}/landing", files.drop("page_id").schema)
        follow_arriving(
            arriving, f"{root}/final", f"{root}/checkpoint", "2024-02-01", sites=(STRICT_SITE, TEST_SITE), names=TEST_NAMES, exact_address=False
        ).awaitTermination()
    return read_headline_files(spark, f"{root}/final")


def _follow_announcements(spark: SparkSession, folder: str) -> str:
    """Every page is landed; of three in five an object is announced, in two batches, each notification twice.

    One in five has a copy announced that was never landed.
    """
    root = new_folder(spark, "announced")
    store = f"{root}/objects/"
    key = F.concat(F.lit("raw/"), F.col("page_id").cast("string"), F.lit("/"), F.substring_index("path", "/", -1))
    landed = adapters.strict_pages(pages(spark, folder)).select(
        "page_id", F.col("host").alias("bucket"), key.alias("key"), F.encode("html", "UTF-8").alias("content")
    )
    adapters.land_objects(landed, store)

    def record(name: Column) -> Column:
        return F.concat(F.lit('{"s3":{"bucket":{"name":"'), "bucket", F.lit('"},"object":{"key":"'), name, F.lit('"}}}'))

    whole, copy = record(F.col("key")), record(F.concat(F.lit("copy/"), "key"))
    body = F.concat(F.lit('{"Records":['), F.when(F.col("page_id") % 5 == 3, F.concat(whole, F.lit(","), copy)).otherwise(whole), F.lit("]}"))
    announced = landed.where("page_id % 5 IN (0, 1, 3)").select("page_id", body.alias("body"))
    for half in (0, 1):
        bodies = announced.where(F.col("page_id") % 2 == half).select("body")
        bodies.unionByName(bodies).write.mode("append").parquet(f"{root}/queue")
        follow_announced(
            arriving_table(spark, f"{root}/queue", bodies.schema),
            store,
            f"{root}/final",
            f"{root}/checkpoint",
            "2024-02-01",
            rejects_root=f"{root}/rejects",
            counts_root=f"{root}/counts",
            sites=(STRICT_SITE, TEST_SITE),
            names=TEST_NAMES,
            exact_address=False,
        ).awaitTermination()
    return root


ANNOUNCED = f"""
WITH {PAGES}, {STRICT_ROWS},
announced AS (
    SELECT r.page_id, r.dd, s.categoria, s.titular, s.enlace,
           CASE WHEN contains(lower(r.path), 'example.org') THEN 'org'
                WHEN contains(lower(r.path), 'example.com') THEN 'com' ELSE 'unknown' END AS periodico,
           s.page_id IS NOT NULL AND NOT contains(lower(r.path), 'example.org') AS gives
    FROM raw_pages r LEFT JOIN strict_rows s ON r.page_id = s.page_id WHERE r.page_id % 5 IN (0, 1, 3)
)
"""


@query(
    "announced_pages",
    ANNOUNCED
    + """
    SELECT '2024-01-' || dd AS fecha, categoria, titular, enlace, periodico, '2024' AS year, '01' AS month, dd AS day
    FROM announced WHERE gives
    """,
)
def announced_pages(spark, folder):
    """Headlines of the announced pages only."""
    return read_headline_files(spark, f"{_follow_announcements(spark, folder)}/final")


@query(
    "announced_batches",
    ANNOUNCED
    + """
    SELECT CAST(page_id % 2 AS INTEGER) AS batch, count(*) AS pages, count(*) FILTER (page_id % 5 = 3) AS refused,
           count(*) FILTER (NOT gives) AS rejected, count(*) FILTER (gives) AS headlines
    FROM announced GROUP BY ALL
    """,
)
def announced_batches(spark, folder):
    """What each batch read, refused, rejected and kept, observed while it passed."""
    counts = batch_counts(spark, f"{_follow_announcements(spark, folder)}/counts")
    return counts.withColumn("batch", F.substring_index("load", "-", -1).cast("int")).drop("load")


@query(
    "announced_rejects",
    ANNOUNCED
    + """
    SELECT page_id, 'no headline' AS reason FROM announced WHERE NOT gives
    UNION ALL SELECT page_id, 'absent' AS reason FROM announced WHERE page_id % 5 = 3
    """,
)
def announced_rejects(spark, folder):
    """Announced objects that give no headline, and why."""
    rejects = spark.read.schema("path STRING, reason STRING").parquet(f"{_follow_announcements(spark, folder)}/rejects")
    return rejects.select(F.element_at(F.split("path", "/"), -2).cast("bigint").alias("page_id"), "reason")
