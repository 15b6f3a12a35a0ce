"""Projections: titles, signal text, URLs, dates, identifiers."""

from pyspark.sql import functions as F

from ..functions import dates, hashing, urls
from ..functions import text as X
from .registry import ARTICLES, articles, query, read, title_tokens_sql, tokens_sql


@query(f"WITH {ARTICLES} SELECT doc_id, CAST(len({tokens_sql('body')}) AS BIGINT) AS n_tokens, CAST(len(list_distinct({tokens_sql('body')})) AS BIGINT) AS n_distinct FROM articles")
def tokenize_counts(spark, sf_dir):
    words = articles(spark, sf_dir).select("doc_id", X.tokens(F.col("body")).alias("w"))
    return words.select("doc_id", F.size("w").cast("long").alias("n_tokens"), F.size(F.array_distinct("w")).cast("long").alias("n_distinct"))


@query(f"WITH {ARTICLES} SELECT doc_id, array_to_string(list_sort({title_tokens_sql('title')}), ' ') AS words FROM articles")
def title_words(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", F.array_join(F.array_sort(X.title_tokens(F.col("title"))), " ").alias("words"))


@query(f"""WITH {ARTICLES}, t AS (SELECT doc_id, trim(body) AS b, trim(summary) AS s, trim(title) AS h FROM articles)
SELECT doc_id, CASE WHEN length(b) >= 500 THEN 'body' WHEN length(s) >= 60 THEN 'summary' WHEN h <> '' THEN 'title' ELSE 'empty' END AS level,
 md5(CASE WHEN length(b) >= 500 THEN trim(left(b, 2500)) WHEN length(s) >= 60 THEN h || chr(10) || chr(10) || s WHEN h <> '' THEN h ELSE '' END) AS text_md5 FROM t""")
def signal_text_levels(spark, sf_dir):
    a = articles(spark, sf_dir).select("doc_id", X.signal_text(F.col("body"), F.col("summary"), F.col("title")).alias("s"))
    return a.select("doc_id", "s.level", F.md5("s.text").alias("text_md5"))


@query(f"""WITH {ARTICLES} SELECT doc_id, CAST(length(trim(left(title, 240) || chr(10) || left(CASE WHEN length(body) >= 100 THEN body WHEN length(summary) >= 60 THEN summary ELSE '' END, 1500))) AS BIGINT) AS n_chars,
 left(sha256('m|v1|' || outlet || '|' || CAST(doc_id AS VARCHAR)), 12) AS article_id, left(md5(title || CAST(doc_id AS VARCHAR)), 8) AS item_id,
 'L' || left(sha256(CAST(day AS VARCHAR) || '|' || story), 10) AS lineage_id, left(sha256(array_to_string(list_sort([outlet, country]), ',')), 16) AS set_hash FROM articles""")
def identifiers(spark, sf_dir):
    a = articles(spark, sf_dir)
    link = F.col("doc_id").cast("string")
    return a.select(
        "doc_id", F.length(X.embedding_excerpt(F.col("body"), F.col("summary"), F.col("title"))).cast("long").alias("n_chars"), hashing.article_id("m", "v1", F.col("outlet"), link).alias("article_id"),
        hashing.item_id(F.col("title"), link).alias("item_id"), hashing.lineage_id(F.col("day"), F.col("story")).alias("lineage_id"), hashing.set_hash(F.array("outlet", "country")).alias("set_hash"),
    )


@query(f"""WITH {ARTICLES}, t AS (SELECT doc_id, title, summary, body, length(body) AS n FROM articles) SELECT doc_id,
 CASE WHEN n >= 1000 THEN 'FULL' WHEN n >= 200 THEN 'PARTIAL' WHEN n >= 50 THEN 'STUB' ELSE 'NONE' END AS status,
 summary = '' OR (starts_with(summary, left(title, 60)) AND abs(length(summary) - length(title)) < 40) AS is_stub,
 CASE WHEN body = '' THEN 'empty' WHEN regexp_matches(lower(body), '[ğşıçöü]') THEN 'tr-extlatin' WHEN regexp_matches(lower(body), '[áéíóúãâê]') THEN 'pt/es-extlatin' ELSE 'latin' END AS script,
 CASE WHEN length(title) <= 40 THEN title ELSE rtrim(left(title, 39)) || '…' END AS short_title FROM t""")
def item_classes(spark, sf_dir):
    a = articles(spark, sf_dir)
    return a.select("doc_id", X.extraction_class(F.length("body"), F.lit(None)).alias("status"), X.is_stub(F.col("title"), F.col("summary")).alias("is_stub"), X.script_of(F.col("body")).alias("script"), X.truncate(F.col("title"), 40).alias("short_title"))


_SUFFIX = r"\s*[|–—-]" + r"\s*[A-Z]" + r"(?:[/''.&]|[\p{L}\p{N}_]| ){1,30}" + r"\s*$"
_KEPT = "[^ 0-9" + "".join(X.KEPT) + "]"
_BARE = f"regexp_replace(regexp_replace(trim(title), '{_SUFFIX}', ''), '{_SUFFIX}', '')"
_TITLE = rf"trim(regexp_replace(regexp_replace(regexp_replace(lower({_BARE}), '[''‘’“”]', '', 'g'), '{_KEPT}', ' ', 'g'), '\s+', ' ', 'g'))"


@query(f"WITH {ARTICLES} SELECT doc_id, {_TITLE} AS normalised_title FROM articles")
def normalised_titles(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", X.normalise_title(F.col("title")).alias("normalised_title"))


_P = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"
_SITE = f"regexp_replace(regexp_replace(lower(regexp_extract(url, '{_P}', 2)), '^www\\.', ''), '^(?:m|mobile)\\.', '')"
CANONICAL = rf"""(lower(regexp_extract(url, '{_P}', 1)) || '://' || {_SITE} || CASE WHEN length(regexp_extract(url, '{_P}', 3)) > 1 THEN regexp_replace(regexp_extract(url, '{_P}', 3), '/+$', '') ELSE regexp_extract(url, '{_P}', 3) END
 || CASE WHEN array_to_string(list_filter(string_split(regexp_extract(url, '{_P}', 4), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(?:{"|".join(urls.TRACKING)})')), '&') <> ''
 THEN '?' || array_to_string(list_filter(string_split(regexp_extract(url, '{_P}', 4), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(?:{"|".join(urls.TRACKING)})')), '&') ELSE '' END)"""


@query(f"""SELECT page_id, {CANONICAL} AS canonical_url, {_SITE} AS site, CASE WHEN regexp_matches(lower(regexp_extract(url, '{_P}', 3)), '{urls.OPINION}') THEN 'opinion' ELSE 'news' END AS section,
 CASE WHEN regexp_extract(regexp_extract(url, '{_P}', 3), '^/+([^/]+)', 1) <> '' THEN lower(regexp_extract(regexp_extract(url, '{_P}', 3), '^/+([^/]+)', 1)) ELSE '(root)' END AS category,
 lower(regexp_extract(url, '{_P}', 1)) || '://' || {_SITE} || regexp_replace(regexp_extract(url, '{_P}', 3), '/+$', '') AS sitemap_url FROM pages""")
def canonical_urls(spark, sf_dir):
    u = F.col("url")
    return read(spark, sf_dir, "pages").select("page_id", urls.canonical_url(u).alias("canonical_url"), urls.site(u).alias("site"), urls.infer_section(u).alias("section"), urls.category(u).alias("category"), urls.sitemap_url(u).alias("sitemap_url"))


@query(r"""SELECT page_id, md5(trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'),
 '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&apos;', ''''), '&hellip;', '…'), '&mdash;', '—'), '&ndash;', '–'), '&amp;', '&'), '\s+', ' ', 'g'))) AS text_md5 FROM pages""")
def stripped_html(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.md5(X.strip_html(F.col("html"))).alias("text_md5"))


@query("SELECT event_id, CAST(ts AS DATE) AS day, round((epoch(TIMESTAMP '2024-02-01 00:00:00') - floor(epoch(ts))) / 3600, 1) AS age_hours, ts >= TIMESTAMP '2024-01-25 00:00:00' AS recent FROM events")
def published_ages(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    text = F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    return e.select("event_id", F.to_date(dates.parse_published(text)).alias("day"), dates.age_hours(dates.parse_published(text), now).alias("age_hours"), dates.within_days(text, 7, now).alias("recent"))


_LEX = " UNION ALL ".join(f"SELECT '{k}' AS label, '{v}' AS pattern" for k, v in X.FRAMING.items())


@query(f"""WITH {ARTICLES}, lex AS ({_LEX}), n AS (SELECT country, count(*) AS n FROM articles GROUP BY 1)
SELECT country, label, CAST(sum(CASE WHEN regexp_matches(lower(body), pattern) THEN 1 ELSE 0 END) AS BIGINT) AS hits, round(1000.0 * sum(CASE WHEN regexp_matches(lower(body), pattern) THEN 1 ELSE 0 END) / max(n.n), 4) AS per_1000
FROM articles JOIN n USING (country) CROSS JOIN lex GROUP BY country, label""")
def framing_lexicon(spark, sf_dir):
    a = articles(spark, sf_dir).withColumn("low", F.lower("body"))
    hits = a.groupBy("country").agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("low").rlike(p)).alias(k) for k, p in X.FRAMING.items()])
    return hits.unpivot(["country", "n"], list(X.FRAMING), "label", "hits").select("country", "label", "hits", F.round(1000.0 * F.col("hits") / F.col("n"), 4).alias("per_1000"))


@query(f"""WITH {ARTICLES} SELECT outlet, count(*) AS n, CAST(sum(CASE WHEN regexp_matches(lower(body), '(?:\\bthe\\b)|(?:\\bder\\b)') AND NOT regexp_matches(lower(body), '(?:idiot)|(?:\\bclown\\b)') THEN 1 ELSE 0 END) AS BIGINT) AS n_matching FROM articles GROUP BY outlet""")
def pattern_matches(spark, sf_dir):
    hit = X.matches(F.col("body"), [r"\bthe\b", r"\bder\b"], ["idiot", r"\bclown\b"])
    return articles(spark, sf_dir).groupBy("outlet").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("n_matching"))


@query("""WITH r AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents WHERE text <> '') SELECT doc_id, source, r AS pos FROM r WHERE r <= 5""")
def per_feed_quota(spark, sf_dir):
    from ..operators.similarity import top_k

    d = read(spark, sf_dir, "documents").filter("text <> ''").select("doc_id", "source")
    return top_k(d, ["source"], [F.col("doc_id")], 5).select("doc_id", "source", F.col("rank").cast("long").alias("pos"))


@query("SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) % 10 AS k10, count(*) AS n FROM events GROUP BY ALL")
def json_paths(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return read(spark, sf_dir, "events").groupBy("event_type", (k % 10).alias("k10")).agg(F.count(F.lit(1)).alias("n"))
