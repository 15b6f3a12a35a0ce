"""Feeds, sitemaps and web pages as columns of bytes or text, parsed by Arrow functions; fetching by a data source.

Parsing never raises: malformed input is an empty array, as a daily run must survive any feed.
"""

from __future__ import annotations

import re
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from urllib.parse import urlsplit
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..plans.session import shared_checkpoint

ITEM = "array<struct<title string, link string, summary string, published string>>"
_DATES = ("pubdate", "published", "updated", "date")
_LIMITS = {"title": 300, "link": 400, "summary": 500, "published": 60}


def _tag(e: ElementTree.Element) -> str:
    return e.tag.rpartition("}")[2].lower() if isinstance(e.tag, str) else ""


def _root(body: bytes | str | None) -> ElementTree.Element | None:
    if not body:
        return None
    raw = body.encode("utf-8", "replace") if isinstance(body, str) else bytes(body)
    try:
        return ElementTree.fromstring(raw.removeprefix(b"\xef\xbb\xbf").strip())
    except (ElementTree.ParseError, ValueError, LookupError):
        return None


def parse_feed_bytes(body: bytes | str | None, most: int = 50) -> list[dict]:
    """Items and entries at any depth of RSS, Atom or RDF, untitled ones left out, ``most`` at most."""
    root, found = _root(body), []
    for node in root.iter() if root is not None else ():
        if _tag(node) not in ("item", "entry"):
            continue
        item = dict.fromkeys(_LIMITS, "")
        encoded = ""
        for child in node:
            name, text = _tag(child), (child.text or "").strip()
            if name == "title":
                item["title"] = "".join(child.itertext()).strip()
            elif name == "link":
                item["link"] = child.get("href") or text or item["link"]
            elif name in ("description", "summary"):
                item["summary"] = "".join(child.itertext()).strip()
            elif name == "encoded":
                encoded = text
            elif name in _DATES and text:
                item["published"] = text
        if item["title"]:
            item["summary"] = item["summary"] or encoded
            found.append({k: v[: _LIMITS[k]] for k, v in item.items()})
            if len(found) == most:
                break
    return found


def parse_sitemap_bytes(body: bytes | str | None, most: int = 50_000) -> list[dict]:
    """Addresses of a news sitemap with title and date; nested sitemaps have ``nested`` true."""
    root, found = _root(body), []
    for node in root.iter() if root is not None else ():
        kind = _tag(node)
        if kind not in ("url", "sitemap"):
            continue
        parts = {_tag(x): (x.text or "").strip() for x in reversed(list(node.iter()))}
        if parts.get("loc"):
            found.append({"url": parts["loc"], "title": parts.get("title", ""), "raw_date": parts.get("publication_date") or parts.get("lastmod", ""), "nested": kind == "sitemap"})
            if len(found) == most:
                break
    return found


def _mapped(f, kind: str, column: Column | str) -> Column:
    def over(batch: pd.Series) -> pd.Series:
        return batch.map(f)

    return F.pandas_udf(over, kind)(column)


def parse_feed(body: Column | str) -> Column:
    return _mapped(parse_feed_bytes, ITEM, body)


def parse_sitemap(body: Column | str) -> Column:
    return _mapped(parse_sitemap_bytes, "array<struct<url string, title string, raw_date string, nested boolean>>", body)


def feed_items(feeds: DataFrame, body: str, *keep: str) -> DataFrame:
    """One row per item with its position in the feed, 50 a feed and fields cut as the archive of snapshots has them."""
    return feeds.select(*keep, F.posexplode(parse_feed(F.col(body))).alias("item_pos", "x")).select(*keep, "item_pos", "x.*")


def merge_fallback(feed: DataFrame, sitemap: DataFrame, by: str, few: int = 3) -> DataFrame:
    """Items of feeds, and for feeds with fewer than ``few`` (but some) also sitemap items whose title is new there."""
    thin = feed.groupBy(by).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") < few).select(by)
    extra = sitemap.join(thin, by, "left_semi").join(feed.select(by, "title"), [by, "title"], "left_anti")
    return feed.unionByName(extra, allowMissingColumns=True)


def flatten_snapshot(snapshot: DataFrame) -> DataFrame:
    """Nested daily snapshot (date, countries map of label and feeds of items) as one row per item, positions kept."""
    countries = snapshot.select("date", F.explode("countries").alias("country", "c"))
    feeds = countries.select("date", "country", F.col("c.label").alias("country_label"), F.posexplode("c.feeds").alias("feed_pos", "f"))
    items = feeds.select("date", "country", "country_label", "feed_pos", F.col("f.name").alias("outlet"), F.col("f.lang").alias("lang"), F.posexplode("f.items").alias("item_pos", "i"))
    return items.select("date", "country", "country_label", "outlet", "lang", "feed_pos", "item_pos", "i.*")


GKG = ("record_id", "date", "source_type", "source", "url", "counts1", "counts2", "themes1", "themes", "locations1", "locations", "persons1", "persons", "orgs1", "orgs", "tone",
       "dates", "gcam", "image", "related_images", "social_images", "social_videos", "quotations", "names", "amounts", "translation", "extras")


def parse_gkg(lines: DataFrame, line: str = "value") -> DataFrame:
    """Tab-separated knowledge-graph records of 27 columns; shorter rows are skipped; sub-fields become arrays."""
    named = lines.select(F.split(line, "\t").alias("v")).filter(F.size("v") >= len(GKG)).select(*[F.col("v")[i].alias(c) for i, c in enumerate(GKG)])
    for c in ("themes", "persons", "orgs"):
        named = named.withColumn(c, F.filter(F.transform(F.split(c, ";"), lambda x: F.element_at(F.split(x, ","), 1)), lambda x: x != ""))
    pieces = F.transform(F.split("locations", ";"), lambda x: F.split(x, "#"))
    country = F.filter(pieces, lambda p: (F.size(p) >= 4) & (p[0] == "1"))
    named = named.withColumn("places", F.filter(F.transform(pieces, lambda p: F.try_element_at(p, F.lit(2))), lambda x: x.isNotNull())).withColumn("country", F.try_element_at(country, F.lit(1))[2])
    return named.withColumn("language", F.coalesce(F.nullif(F.regexp_extract("translation", "srclc:([a-z]{3})", 1), F.lit("")), F.lit("eng")))


def read_gkg(spark: SparkSession, path: str) -> DataFrame:
    return parse_gkg(spark.read.text(path))


def gkg_counters(records: DataFrame, most: dict[str, int] | None = None) -> DataFrame:
    """(kind, item, n, rank) of the commonest source countries, sources, themes and languages. Ties go to the lower item."""
    most = most or {"country": 25, "source": 30, "theme": 30, "language": 20}
    parts = {"country": F.array("country"), "source": F.array(F.left("source", F.lit(60))), "theme": F.col("themes"), "language": F.array("language")}
    every = F.map_from_arrays(F.array(*map(F.lit, parts)), F.array(*parts.values()))
    each = records.select(F.explode(every).alias("kind", "items")).select("kind", F.explode("items").alias("item")).filter("item IS NOT NULL")
    limit = F.create_map(*[F.lit(x) for k, v in most.items() for x in (k, v)])[F.col("kind")]
    rank = F.row_number().over(W.partitionBy("kind").orderBy(F.desc("n"), "item")).cast("long")
    return each.groupBy("kind", "item").agg(F.count(F.lit(1)).alias("n")).withColumn("rank", rank).filter(F.col("rank") <= limit)


def dated_files(df: DataFrame, pattern: str = r"(\d{4}-\d{2}-\d{2})(?:_([^/]+?))?\.json$") -> DataFrame:
    """Adds ``file_date`` and ``file_key`` from the file's name; files named otherwise are left out."""
    name = F.col("_metadata.file_name")
    return df.withColumn("file_date", F.try_to_date(F.regexp_extract(name, pattern, 1), "yyyy-MM-dd")).withColumn("file_key", F.regexp_extract(name, pattern, 2)).filter("file_date IS NOT NULL")


class _Host(InputPartition):
    def __init__(self, urls: list[tuple[int, str]]):
        super().__init__(urls)
        self.urls = urls


class _HttpReader(DataSourceReader):
    def __init__(self, options: dict):
        self.urls = [u for u in options.get("urls", "").split("\n") if u]
        self.gap, self.tries, self.timeout = float(options.get("gap", 1)), int(options.get("attempts", 3)), float(options.get("timeout", 20))
        self.backoff = float(options.get("backoff", 2))

    def partitions(self) -> list[_Host]:
        """One partition per host, so that the least gap between requests to a host needs no lock across executors."""
        hosts: dict[str, list[tuple[int, str]]] = {}
        for pos, u in enumerate(self.urls):
            hosts.setdefault(urlsplit(u).netloc.lower(), []).append((pos, u))
        return [_Host(u) for u in hosts.values()]

    def read(self, partition: _Host) -> Iterator[tuple]:
        for i, (pos, url) in enumerate(partition.urls):
            if i:
                time.sleep(self.gap)
            yield pos, *self.fetch(url)

    def fetch(self, url: str) -> tuple:
        """Server errors and lost connections are tried again after ``backoff``, twice that, ..; other statuses are returned."""
        began, status, error = time.time(), None, None
        for k in range(self.tries):
            try:
                with urllib.request.urlopen(urllib.request.Request(url, headers={"User-Agent": "prismframe"}), timeout=self.timeout) as r:  # noqa: S310
                    return url, r.status, r.read(), None, int((time.time() - began) * 1000)
            except urllib.error.HTTPError as e:
                status, error = e.code, str(e)
                if e.code < 500:
                    break
            except (OSError, ValueError) as e:
                status, error = None, str(e)
                if "SSL" in error or isinstance(e, ValueError):
                    break
            if k + 1 < self.tries:
                time.sleep(self.backoff * 2**k)
        return url, status, None, error, int((time.time() - began) * 1000)


class HttpSource(DataSource):
    """``spark.read.format("prism_http").option("urls", "\\n".join(urls))``; register with ``spark.dataSource.register``."""

    @classmethod
    def name(cls) -> str:
        return "prism_http"

    def schema(self) -> str:
        return "url_pos int, url string, http_status int, body binary, error string, fetch_ms int"

    def reader(self, schema) -> _HttpReader:
        return _HttpReader(self.options)


def fetch(spark: SparkSession, urls: list[str], **options: str) -> DataFrame:
    """Every address once, with ``url_pos``, its place in the list: results come by host, the declared order is a sort away."""
    spark.dataSource.register(HttpSource)
    return spark.read.format("prism_http").option("urls", "\n".join(urls)).options(**options).load()


SITEMAPS = ("/sitemap-news.xml", "/news-sitemap.xml", "/sitemap_news.xml")


def sitemap_fallback(spark: SparkSession, feeds: list[str], most: int = 50, **options: str) -> DataFrame:
    """(feed_url, item_pos, title, link, summary, published) of the first usual sitemap of each feed's site that has titles."""
    wanted = [(f, p, "{0.scheme}://{0.netloc}".format(urlsplit(f)) + path) for f in feeds for p, path in enumerate(SITEMAPS)]
    places = spark.createDataFrame([(i, f, p) for i, (f, p, _) in enumerate(wanted)], "url_pos int, feed_url string, path_pos int")
    got = fetch(spark, [u for *_, u in wanted], attempts="1", **options).filter("http_status = 200").join(places, "url_pos")
    items = got.select("feed_url", "path_pos", F.posexplode(parse_sitemap("body")).alias("pos", "x")).filter("x.title <> '' AND NOT x.nested")
    w = W.partitionBy("feed_url").orderBy("path_pos", "pos")
    first = items.withColumn("_p", F.min("path_pos").over(W.partitionBy("feed_url"))).filter("path_pos = _p").withColumn("item_pos", F.row_number().over(w) - 1).filter(F.col("item_pos") < most)
    return first.select("feed_url", "item_pos", F.left("x.title", F.lit(300)).alias("title"), F.left("x.url", F.lit(400)).alias("link"), F.lit("").alias("summary"), F.left("x.raw_date", F.lit(60)).alias("published"))


def sitemap_pages(spark: SparkSession, sitemaps: list[str], children: int = 3, **options: str) -> DataFrame:
    """(sitemap, url, raw_date) of sitemaps. An index, which has nothing but sitemaps, is followed to its first ``children``.

    The children's addresses, few per declared sitemap, pass through the driver, which plans the second fetch.
    """
    def parsed(urls: list[str]) -> DataFrame:
        got = fetch(spark, urls, **options).filter("http_status = 200")
        return shared_checkpoint(got.select("url_pos", F.col("url").alias("sitemap"), F.posexplode(parse_sitemap("body")).alias("pos", "x")).select("url_pos", "sitemap", "pos", "x.*"))

    top = parsed(sitemaps)
    plain = top.filter("NOT nested").select("sitemap", "url", "raw_date")
    only = top.join(top.filter("NOT nested").select("url_pos").distinct(), "url_pos", "left_anti")
    nested = only.withColumn("r", F.row_number().over(W.partitionBy("url_pos").orderBy("pos"))).filter(F.col("r") <= children).select("sitemap", "url").orderBy("sitemap", "r").collect()
    if not nested:
        return plain
    parents = spark.createDataFrame([(i, r.sitemap) for i, r in enumerate(nested)], "url_pos int, parent string")
    below = parsed([r.url for r in nested]).filter("NOT nested").join(parents, "url_pos")
    return plain.unionByName(below.select(F.col("parent").alias("sitemap"), "url", "raw_date"))


_OPEN = re.compile(r"[“”«»„]")
_SAID = "said|told|claimed|warned|argued|denied|stated|explained|added|insisted|announced|declared|says|adds|dijo|afirmó|explicó|aseguró|advirtió|negó|declaró|añadió|dice|asegura"
_BEFORE = re.compile(rf"(?P<who>[^\".!?\n]{{2,60}}?)\s+(?P<verb>{_SAID})\b[^\"\n]{{0,100}}?\"(?P<quote>[^\"\n]{{5,}}?)\"", re.I)
_AFTER = re.compile(rf"\"(?P<quote>[^\"\n]{{5,}}?)\",?\s+(?:(?P<verb>{_SAID})\s+(?P<who>[^\".!?\n,]{{2,60}})|(?P<who2>[^\".!?\n,]{{2,60}}?)\s+(?P<verb2>{_SAID})\b)", re.I)


def quotes_in(text: str | None) -> list[dict]:
    """Direct quotes with speaker and verb, in order of their place; a quote found both ways counts once."""
    found: dict[int, dict] = {}
    plain = _OPEN.sub('"', text or "")
    for pattern in (_BEFORE, _AFTER):
        for m in pattern.finditer(plain):
            g = m.groupdict()
            found.setdefault(m.start("quote"), {"quote": g["quote"], "speaker": (g["who"] or g.get("who2") or "").strip(" ,;"), "verb": (g["verb"] or g.get("verb2") or "").lower()})
    return [found[k] for k in sorted(found)]


def extract_quotes(text: Column | str) -> Column:
    return _mapped(quotes_in, "array<struct<quote string, speaker string, verb string>>", text)


def page_feed(url: Column, title: Column, summary: Column, published: Column) -> Column:
    """One page as the XML of a one-item feed: the sink's inverse of ``parse_feed``."""
    def safe(c: Column) -> Column:
        return F.replace(F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))

    return F.concat(F.lit("<rss><channel><item><title>"), safe(title), F.lit("</title><link>"), safe(url), F.lit("</link><description>"), safe(summary), F.lit("</description><pubDate>"), safe(published), F.lit("</pubDate></item></channel></rss>"))
