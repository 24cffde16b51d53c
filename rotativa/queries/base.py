"""Registry of the checked queries and the SQL fragments they share.

Each query covers its whole tables.  Where DuckDB can compute the same result,
the query carries that SQL; the fragments below restate the adapters of
``rotativa.sources.adapters`` as common table expressions.
"""

from __future__ import annotations

from collections.abc import Callable
from textwrap import dedent

from pyspark.sql import DataFrame, SparkSession

from rotativa.fixed import Site

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The host names of the test pages, in the roles of the news sites.
TEST_SITE = Site("org", "example.org", "https://www.example.org", ("utm_source",))
STRICT_SITE = Site("com", "example.com", "https://www.example.com")
TEST_NAMES = (("example.org", "org"), ("example.com", "com"))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = dedent(sql).strip()
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


HEADLINES = """
lines AS (
    SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS titular,
           unnest(range(len(string_split(text, chr(10))))) AS line,
           DATE '2024-01-01' + CAST(doc_id % 60 AS INTEGER) AS day_of
    FROM documents
),
headlines AS (
    SELECT strftime(day_of, '%Y-%m-%d') AS fecha, nullif(lang, 'fr') AS categoria, titular,
           'https://www.example.org/' || lang || '/' || doc_id || '/' || line AS enlace,
           source AS periodico, strftime(day_of, '%Y') AS year, strftime(day_of, '%m') AS month,
           strftime(day_of, '%d') AS day
    FROM lines
)"""

NEWS = (
    HEADLINES
    + """,
news AS (
    SELECT CAST(fecha AS DATE) AS fecha, categoria, titular, enlace, periodico,
           CAST(fecha AS TIMESTAMP) + to_hours(CAST(length(titular) % 24 AS INTEGER)) AS created_at
    FROM headlines
)"""
)

VALID = (
    HEADLINES
    + """,
valid AS (
    SELECT try_cast(fecha AS DATE) AS fecha, coalesce(categoria, 'General') AS categoria, titular,
           coalesce(enlace, '') AS enlace, coalesce(periodico, 'unknown') AS periodico
    FROM headlines
    WHERE titular IS NOT NULL AND titular <> '' AND try_cast(fecha AS DATE) IS NOT NULL
)"""
)

CLEAN = (
    HEADLINES
    + """,
cleaned AS (
    SELECT enlace, categoria AS label,
           lower(regexp_replace(titular, '[^a-zA-ZáéíóúñÁÉÍÓÚÑ ]', '', 'g')) AS clean_text
    FROM headlines
),
clean AS (
    SELECT * FROM cleaned WHERE label IS NOT NULL AND clean_text IS NOT NULL AND clean_text <> ''
)"""
)

# Tokens as the ML tokenizer gives them: trailing empty ones dropped.
WORDS = (
    CLEAN
    + """,
words AS (
    SELECT enlace, unnest(CASE WHEN rtrim(clean_text) = '' THEN []
                               ELSE string_split(rtrim(clean_text), ' ') END) AS word
    FROM clean
)"""
)

PAGES = r"""
raw_pages AS (
    SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host,
           'raw/' || regexp_extract(url, '^https?://([^/?#]+)', 1) || '-2024-01-'
               || lpad(CAST(page_id % 30 + 1 AS VARCHAR), 2, '0') || '.html' AS path,
           lpad(CAST(page_id % 30 + 1 AS VARCHAR), 2, '0') AS dd,
           regexp_extract(html, '<h1>(.*?)</h1>', 1, 's') AS h1,
           regexp_extract(url, '^https?://[^/?#]+/([^/?#]*)', 1) AS lang,
           html
    FROM pages
)"""


def decoded(text: str) -> str:
    """SQL for ``text`` with its entities decoded and surrounding space removed.

    A title cut off inside a page may end with an entity that lost its semicolon.
    """
    for entity, character in (
        ("&lt", "<"),
        ("&gt", ">"),
        ("&quot", '"'),
        ("&#39", "''"),
        ("&copy", "©"),
        ("&middot", "·"),
        ("&amp", "&"),
    ):
        text = f"regexp_replace({text}, '{entity}(;|$)', '{character}', 'g')"
    return f"trim({text})"


# Title case of the first path segment, whatever scheme and host precede it.
URL_SEGMENT = r"string_split(trim(regexp_replace(url, '^[a-zA-Z]+://[^/?#]*', ''), '/'), '/')[1]"


def title_case(text: str) -> str:
    return (
        f"list_aggregate(list_transform(regexp_extract_all({text}, '\\p{{L}}+|\\P{{L}}+'), "
        "lambda x: upper(x[1]) || lower(x[2:])), 'string_agg', '')"
    )


URL_CATEGORY = (
    f"CASE WHEN {URL_SEGMENT} <> '' THEN {title_case('replace(' + URL_SEGMENT + ', ' + chr(39) + '-' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ')')} "
    "ELSE 'Sin categoría' END"
)
