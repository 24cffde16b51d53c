"""Link expressions: absolute links, link filter, category from the path."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from rotativa.fixed import NO_CATEGORY, Site
from rotativa.functions.text import title_case


def absolute_link(link: Column, base_url: str, *, only_rooted: bool = False) -> Column:
    """Prefix a relative link with the site's address; an empty link stays empty.

    By default every link that does not start with ``http`` is relative;
    ``only_rooted`` limits that to links starting with ``/``.
    """
    relative = link.startswith("/") if only_rooted else ~link.startswith("http")
    return F.when((link != "") & relative, F.concat(F.lit(base_url), link)).otherwise(link)


def contains_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda found, word: found | text.contains(word), words, F.lit(False))


def is_site_link(link: Column, site: Site) -> Column:
    """The link holds the site's domain and none of its denied words (as substrings)."""
    return link.contains(site.domain) & ~contains_any(link, site.denied_words)


def has_path(link: Column, site: Site) -> Column:
    """Something with a slash is left once the site's address is taken away."""
    return F.replace(link, F.lit(site.base_url), F.lit("")).contains("/")


def url_category(link: Column, site: Site | None = None) -> Column:
    """Category from the first path segment of a link, in title case.

    With ``site`` only that site's exact address is stripped before the path is
    read; without it any scheme and host are.
    """
    if site is None:
        path = F.regexp_replace(link, r"^[a-zA-Z]+://[^/?#]*", "")
    else:
        path = F.replace(link, F.lit(site.base_url + "/"), F.lit(""))
    segment = F.element_at(F.split(F.regexp_replace(path, "^/+|/+$", ""), "/"), 1)
    return F.when(segment != "", title_case(F.replace(segment, F.lit("-"), F.lit(" ")))).otherwise(
        F.lit(NO_CATEGORY)
    )
