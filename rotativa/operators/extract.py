"""Headline extraction from page outlines.

A page outline (``functions.outline.page_outline``) holds arrays of elements and of text; each
markup profile is a Column expression from it to an array of
``categoria, titular, enlace`` in document order.  Pages are never shuffled:
extraction, filters and in-page duplicate elimination all happen in the row.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rotativa import fixed
from rotativa.fixed import EL_ESPECTADOR, EL_TIEMPO, Site
from rotativa.functions.links import absolute_link, contains_any, has_path, is_site_link, url_category
from rotativa.functions.outline import element_text, page_outline
from rotativa.functions.paths import (
    SOURCE_DOMAINS,
    SOURCE_NAMES,
    date_in_name,
    detect_source,
    file_base_name,
)
from rotativa.functions.values import once
from rotativa.operators.dedupe import first_in_page, mark_repeats

Predicate = Callable[[Column], Column]


# --- finding elements ---------------------------------------------------------


def inside(outline: Column, element: Column) -> Column:
    """The elements inside an element."""
    return F.slice(outline["elements"], element["pos"] + 1, element["size"] - 1)


def text(outline: Column, element: Column) -> Column:
    return element_text(outline["pieces"], element)


def first(elements: Column, wanted: Predicate) -> Column:
    """The first wanted element, NULL when there is none."""
    return F.get(F.filter(elements, wanted), F.lit(0))


def is_tag(*names: str) -> Predicate:
    return lambda element: element["tag"].isin(*names)


def has_class_like(*parts: str) -> Predicate:
    """The class attribute contains one of the parts."""
    return lambda element: contains_any(F.coalesce(element["cls"], F.lit("")), parts)


def has_class(name: str) -> Predicate:
    """``name`` is one of the element's classes."""
    return lambda element: F.array_contains(F.split(F.coalesce(element["cls"], F.lit("")), " "), name)


def is_link(element: Column) -> Column:
    return (element["tag"] == "a") & element["href"].isNotNull()


def both(*wanted: Predicate) -> Predicate:
    def test(element: Column) -> Column:
        result = F.lit(True)
        for condition in wanted:
            result = result & condition(element)
        return result

    return test


def _item(category: Column, title: Column, link: Column) -> Column:
    return F.struct(category.alias("categoria"), title.alias("titular"), link.alias("enlace"))


# --- title rules --------------------------------------------------------------


def is_long_title(title: Column, longer_than: int = fixed.MIN_TITLE_LENGTH) -> Column:
    return F.char_length(title) > longer_than


def has_denied_prefix(title: Column, prefixes: Sequence[str] = fixed.DENIED_TITLE_PREFIXES) -> Column:
    lowered = F.lower(title)
    result = F.lit(False)
    for prefix in prefixes:
        result = result | lowered.startswith(prefix)
    return result


# --- verdicts on items --------------------------------------------------------

Rule = tuple[str, Predicate]  # the reason for a reject, and what an item must be

NO_TITLE, NO_LINK, REPEAT = "no title", "no link", "repeat"
SHORT_TITLE, DENIED_PREFIX, FOREIGN_LINK, NO_PATH = "short title", "denied prefix", "foreign link", "no path"


def _ruled(items: Column, judge: bool, *rules: Rule) -> Column:
    """The items that keep to all rules; with ``judge`` all items, each with the first rule it breaks as ``reason``."""
    if not judge:
        return F.filter(items, both(*(rule for _, rule in rules)))

    def verdict(item: Column) -> Column:
        broken = [F.when(~F.coalesce(rule(item), F.lit(False)), reason) for reason, rule in rules]
        return F.struct(
            item["categoria"].alias("categoria"),
            item["titular"].alias("titular"),
            item["enlace"].alias("enlace"),
            F.coalesce(*broken).alias("reason"),
        )

    return F.transform(items, verdict)


def _firsts(items: Column, key: str, judge: bool) -> Column:
    """The first item of each key; with ``judge`` all items, the later ones of those kept marked as repeats."""
    return mark_repeats(items, key, REPEAT) if judge else first_in_page(items, key)


def kept_items(judged: Column) -> Column:
    """Of judged items those without a reason, in their order."""
    kept = F.filter(judged, lambda item: item["reason"].isNull())
    return F.transform(kept, lambda item: _item(item["categoria"], item["titular"], item["enlace"]))


def rejected_items(pages: DataFrame, judged: Column) -> DataFrame:
    """One row per item with a reason, with the page's other columns and its ``place`` among all items of the page."""
    others = [name for name in pages.columns if name not in ("html", "outline", "items")]
    rows = pages.select(*others, F.posexplode(judged).alias("place", "item")).where("item.reason IS NOT NULL")
    return rows.select(*others, "place", "item.categoria", "item.titular", "item.enlace", "item.reason")


# --- profiles -----------------------------------------------------------------
#
# With ``judge`` a profile gives every item it looks at, with the reason why it is
# no headline; ``kept_items`` of those are the items it gives without.


def strict_articles(outline: Column, site: Site = EL_TIEMPO, *, judge: bool = False) -> Column:
    """Articles in the strict markup: title link inside an ``h2`` or else an ``h3``."""
    articles = F.filter(outline["elements"], both(is_tag("article"), has_class_like(fixed.STRICT_ARTICLE_CLASS)))

    def title_link(article: Column) -> Column:
        content = inside(outline, article)
        heading = F.coalesce(
            first(content, both(is_tag("h2"), has_class(fixed.STRICT_TITLE_CLASS))),
            first(content, both(is_tag("h3"), has_class(fixed.STRICT_TITLE_CLASS))),
        )
        return first(inside(outline, heading), both(is_tag("a"), has_class(fixed.STRICT_LINK_CLASS)))

    def category(article: Column) -> Column:
        section, subsection = F.nullif(article["section"], F.lit("")), F.nullif(article["subsection"], F.lit(""))
        return F.coalesce(
            F.concat(section, F.lit("/"), subsection),
            section,
            article["category"],
            F.lit(fixed.NO_CATEGORY),
        )

    found = F.transform(
        articles, lambda article: F.struct(category(article).alias("category"), title_link(article).alias("link"))
    )
    items = F.transform(
        found,
        lambda hit: _item(
            hit["category"],
            text(outline, hit["link"]),
            absolute_link(F.coalesce(hit["link"]["href"], F.lit("")), site.base_url),
        ),
    )
    return _ruled(items, judge, (NO_TITLE, lambda item: item["titular"] != ""), (NO_LINK, lambda item: item["enlace"] != ""))


def cards(
    outline: Column, site: Site = EL_ESPECTADOR, *, exact_address: bool = True, judge: bool = False
) -> Column:
    """Cards whose first link leads to the site; nested cards each count.

    ``exact_address`` strips only the site's own address before the category is
    read from a link; otherwise any scheme and host are stripped.
    """
    blocks = F.filter(outline["elements"], both(is_tag("div"), has_class_like(fixed.CARD_CLASS)))
    contents = F.transform(blocks, lambda block: inside(outline, block))
    parts = F.transform(
        contents,
        lambda content: F.struct(
            first(content, is_link).alias("link"),
            first(content, both(is_tag("h2"), has_class_like(fixed.CARD_TITLE_CLASS))).alias("title"),
            first(content, both(is_tag("h4"), has_class_like(fixed.CARD_SECTION_CLASS))).alias("section"),
        ),
    )

    def own_text(element: Column) -> Column:
        return F.coalesce(text(outline, first(inside(outline, element), is_tag("a"))), text(outline, element))

    items = F.transform(
        parts,
        lambda part: _item(
            F.coalesce(
                own_text(part["section"]),
                url_category(part["link"]["href"], site if exact_address else None),
            ),
            F.coalesce(own_text(part["title"]), text(outline, part["link"])),
            part["link"]["href"],
        ),
    )
    return _ruled(
        items,
        judge,
        (NO_LINK, lambda item: item["enlace"].isNotNull()),
        (FOREIGN_LINK, lambda item: is_site_link(item["enlace"], site)),
        (NO_PATH, lambda item: has_path(item["enlace"], site)),
        (SHORT_TITLE, lambda item: is_long_title(item["titular"])),
    )


def heading_links(
    outline: Column, site: Site = EL_ESPECTADOR, *, exact_address: bool = True, judge: bool = False
) -> Column:
    """Headings that hold a link to the site."""
    headings = F.filter(outline["elements"], is_tag("h1", "h2", "h3", "h4"))
    links = F.transform(headings, lambda heading: first(inside(outline, heading), is_link))
    items = F.transform(
        links,
        lambda link: _item(
            url_category(link["href"], site if exact_address else None), text(outline, link), link["href"]
        ),
    )
    return _ruled(
        items,
        judge,
        (NO_LINK, lambda item: item["enlace"].isNotNull()),
        (FOREIGN_LINK, lambda item: is_site_link(item["enlace"], site)),
        (SHORT_TITLE, lambda item: is_long_title(item["titular"])),
    )


def cards_and_headings(
    outline: Column, site: Site = EL_ESPECTADOR, *, exact_address: bool = True, judge: bool = False
) -> Column:
    """Cards, then headings; the first item of each link is kept."""
    rules = {"exact_address": exact_address, "judge": judge}
    items = F.concat(cards(outline, site, **rules), heading_links(outline, site, **rules))
    return _firsts(items, "enlace", judge)


def _blocks(outline: Column) -> Column:
    """Articles, or the blocks with an article-like class when there is no article."""
    articles = F.filter(outline["elements"], is_tag("article"))
    divisions = F.filter(outline["elements"], both(is_tag("div"), has_class_like(*fixed.GENERIC_BLOCK_CLASSES)))
    return _either(articles, divisions)


def _either(preferred: Column, other: Column) -> Column:
    """The preferred elements, or the other ones when there is none."""
    return once(preferred, lambda found: F.when(F.size(found) > 0, found).otherwise(other))


def _block_items(outline: Column, blocks: Column, title_link: Predicate, site: Site) -> Column:
    """Item of each block: first heading by level, first link, first category element."""

    def parts(block: Column) -> Column:
        content = inside(outline, block)
        return F.struct(
            F.when(block["tag"] == "a", text(outline, block))
            .otherwise(
                F.coalesce(
                    text(outline, first(content, is_tag("h1"))),
                    text(outline, first(content, is_tag("h2"))),
                    text(outline, first(content, is_tag("h3"))),
                    text(outline, first(content, title_link)),
                    F.lit(""),
                )
            )
            .alias("title"),
            F.when(block["tag"] == "a", block["href"])
            .otherwise(F.coalesce(first(content, is_link)["href"], F.lit("")))
            .alias("link"),
            F.coalesce(
                text(outline, first(content, has_class_like(*fixed.GENERIC_CATEGORY_CLASSES))),
                F.lit(fixed.DEFAULT_CATEGORY),
            ).alias("category"),
        )

    return F.transform(
        F.transform(blocks, parts),
        lambda part: _item(
            part["category"], part["title"], absolute_link(part["link"], site.base_url, only_rooted=True)
        ),
    )


def generic_articles(outline: Column, site: Site = EL_TIEMPO, *, judge: bool = False) -> Column:
    """Article blocks with a long title; the link may be empty."""
    title_link = both(is_tag("a"), has_class_like(*fixed.GENERIC_TITLE_CLASSES))
    items = _block_items(outline, _blocks(outline), title_link, site)
    return _ruled(items, judge, (SHORT_TITLE, lambda item: is_long_title(item["titular"])))


def generic_articles_or_links(
    outline: Column, site: Site = EL_ESPECTADOR, *, longer_than: int = fixed.MIN_TITLE_LENGTH, judge: bool = False
) -> Column:
    """Article blocks, or every link when there is none; the first item of each title is kept."""
    blocks = _either(_blocks(outline), F.filter(outline["elements"], is_link))
    items = _ruled(
        _block_items(outline, blocks, is_tag("a"), site),
        judge,
        (SHORT_TITLE, lambda item: is_long_title(item["titular"], longer_than)),
        (DENIED_PREFIX, lambda item: ~has_denied_prefix(item["titular"])),
    )
    return _firsts(items, "titular", judge)


# --- dispatch by source -------------------------------------------------------


def page_items_by_markup(
    outline: Column,
    source: Column,
    strict_site: Site = EL_TIEMPO,
    card_site: Site = EL_ESPECTADOR,
    *,
    exact_address: bool = True,
    judge: bool = False,
) -> Column:
    """Site-specific profiles; an unknown source tries the strict one first."""
    strict = F.when(source != card_site.name, strict_articles(outline, strict_site, judge=judge))
    carded = cards_and_headings(outline, card_site, exact_address=exact_address, judge=judge)

    def any_kept(found: Column) -> Column:
        return F.exists(found, lambda item: item["reason"].isNull()) if judge else F.size(found) > 0

    return once(
        strict,
        lambda found: F.when((source == strict_site.name) | any_kept(found), found).otherwise(carded),
    )


def page_items_generic(
    outline: Column, source: Column, article_site: Site = EL_TIEMPO, link_site: Site = EL_ESPECTADOR, *, judge: bool = False
) -> Column:
    """Generic profiles; an unknown source gives no headline."""
    return F.when(source == article_site.name, generic_articles(outline, article_site, judge=judge)).when(
        source == link_site.name, generic_articles_or_links(outline, link_site, judge=judge)
    )


# --- DataFrame operators ------------------------------------------------------


def with_outline(pages: DataFrame) -> DataFrame:
    """Pages with their ``outline``; the body is not carried on."""
    return pages.withColumn("outline", page_outline(F.col("html"))).drop("html")


def headlines_of(pages: DataFrame, items: Column) -> DataFrame:
    """One row per item of each page, with the page's other columns and ``position``."""
    others = [name for name in pages.columns if name not in ("html", "outline")]
    return pages.select(*others, F.posexplode(items).alias("position", "item")).select(
        *others, "position", "item.categoria", "item.titular", "item.enlace"
    )


def with_source(
    pages: DataFrame,
    names: Sequence[tuple[str, str]] = SOURCE_NAMES,
    domains: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Source by file name; with ``domains``, a name that tells nothing leaves it to the page."""
    named = detect_source(file_base_name(F.col("path")), names)
    if domains is not None:
        named = F.when(named == fixed.UNKNOWN_SOURCE, detect_source(F.col("html"), domains)).otherwise(named)
    return pages.withColumn("periodico", named)


def reject_reason(items: Column) -> Column:
    """Why a page (``html`` as decoded, ``outline``) gives no headline; NULL if it gives any."""
    html = F.col("html")
    return (
        F.when(html.isNull(), "not decodable")
        .when(html == "", "empty")
        .when(F.col("outline").isNull(), "not parsed")
        .when(F.coalesce(F.size(items) > 0, F.lit(False)), F.lit(None).cast("string"))
        .otherwise("no headline")
    )


def rejected(pages: DataFrame, items: Column) -> DataFrame:
    """``path, reason`` of the pages that give no headline; the others are left out.

    ``pages`` has ``path, html`` as decoded, with its ``outline``; ``items`` is the extraction.
    """
    return pages.select("path", reject_reason(items).alias("reason")).where(F.col("reason").isNotNull())


def with_source_from_content(pages: DataFrame, domains: Sequence[tuple[str, str]] = SOURCE_DOMAINS) -> DataFrame:
    """Source by the domains a page mentions, for pages without a file name."""
    return pages.withColumn("periodico", detect_source(F.col("html"), domains))


def stamp(headlines: DataFrame, run_date: str | None = None, *, always_run_date: bool = False) -> DataFrame:
    """Publication date of each row, as text: the date in the file name, else the run date."""
    named = F.date_format(date_in_name(F.col("path")), "yyyy-MM-dd")
    fallback = F.lit(run_date)
    return headlines.withColumn("fecha", fallback if always_run_date else F.coalesce(named, fallback))


def page_census(pages: DataFrame, items: Column, site: Site = EL_ESPECTADOR) -> DataFrame:
    """Per page: size, links, cards and links to the site straight from the markup, and the headlines extracted.

    ``items`` is one of the profiles over the page's ``outline``.
    """
    html = F.col("html")
    return pages.withColumn("outline", page_outline(html)).select(
        "page_id",
        F.greatest(F.size(items), F.lit(0)).cast("bigint").alias("headlines"),
        F.char_length(html).cast("bigint").alias("html_length"),
        F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*href")).cast("bigint").alias("links"),
        F.regexp_count(html, F.lit(r'(?i)<div\s[^>]*class="[^"]*Card')).cast("bigint").alias("cards"),
        F.regexp_count(
            html, F.lit(r'(?i)<a\s[^>]*href="[^"]*' + site.domain.replace(".", r"\."))
        ).cast("bigint").alias("site_links"),
    )
