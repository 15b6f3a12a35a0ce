"""URL functions on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A query parameter whose lower-case name starts with one of these is dropped: by prefix, so ``reference`` goes with ``ref``.
TRACKING = ("cid", "fbclid", "gclid", "icid", "ito", "mc_cid", "mc_eid", "ncid", "ref", "share", "smid", "src", "utm_")
OPINION = r"/(?:opinions?|editorials?|op-?eds?|leaders?|commentary|comment|columnists?|column|blogs?)/"
PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def part(url: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), PARTS, group)


def scheme(url: Column) -> Column:
    return F.lower(part(url, 1))


def host(url: Column) -> Column:
    return F.lower(part(url, 2))


def path(url: Column) -> Column:
    return part(url, 3)


def site(url: Column) -> Column:
    """The host without ``www.`` and then without one ``m.`` or ``mobile.``."""
    return F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r"^(?:m|mobile)\.", "")


def canonical_url(url: Column) -> Column:
    """Site in lower case, tracking parameters and fragment out, trailing slashes off except for the root.

    A news-aggregator redirect keeps its host as written and loses its query. Null and empty give "".
    """
    keep = F.filter(F.split(part(url, 4), "&"), lambda p: (p != "") & ~F.lower(F.element_at(F.split(p, "="), 1)).rlike("^(?:" + "|".join(TRACKING) + ")"))
    query = F.array_join(F.transform(keep, lambda p: F.when(p.contains("="), p).otherwise(F.concat(p, F.lit("=")))), "&")
    trail = F.when(F.length(path(url)) > 1, F.regexp_replace(path(url), "/+$", "")).otherwise(path(url))
    head = F.when(scheme(url) != "", F.concat(scheme(url), F.lit(":"))).otherwise(F.lit(""))
    slashes = F.when(part(url, 2) != "", F.lit("//")).otherwise(F.lit(""))
    own = F.concat(head, slashes, site(url), trail, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))
    return F.when(site(url).startswith("news.google.com"), F.concat(head, slashes, part(url, 2), path(url))).otherwise(own)


def infer_section(url: Column, feed_section: Column | str = "news") -> Column:
    fallback = F.lit(feed_section) if isinstance(feed_section, str) else F.coalesce(feed_section, F.lit("news"))
    return F.when(F.lower(path(url)).rlike(OPINION), "opinion").otherwise(fallback)


def sitemap_url(url: Column) -> Column:
    """Scheme, site and path without trailing slash: the form in which feed and sitemap addresses meet."""
    return F.concat(F.coalesce(F.nullif(scheme(url), F.lit("")), F.lit("https")), F.lit("://"), site(url), F.regexp_replace(path(url), "/+$", ""))


def category(url: Column) -> Column:
    first = F.regexp_extract(path(url), "^/+([^/]+)", 1)
    return F.when(first != "", F.lower(first)).otherwise("(root)")


def is_google_news(url: Column) -> Column:
    return F.coalesce(url.contains("news.google.com"), F.lit(False))
