"""Days, feeds, health, coverage, duplicates over days."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import coverage as C
from ..operators import dedup as D
from ..operators import series as S
from .registry import ARTICLES, FACTS, articles, facts, query, read, title_tokens_sql
from .text import CANONICAL

_DAILY = f"{FACTS}, daily AS (SELECT bucket || story AS bucket, day, count(*) AS n FROM facts GROUP BY ALL)"


def _daily(spark, sf_dir):
    return facts(spark, sf_dir).groupBy(F.concat("bucket", "story").alias("bucket"), "day").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_DAILY} SELECT bucket, day, n, round(avg(n) OVER (PARTITION BY bucket ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING), 1) AS trailing_mean FROM daily")
def trailing_means(spark, sf_dir):
    return S.trailing_mean(_daily(spark, sf_dir), ["bucket"], "day", "n").withColumn("trailing_mean", F.round("trailing_mean", 1))


@query(f"WITH {_DAILY}, t AS (SELECT *, avg(n) OVER (PARTITION BY bucket ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS m FROM daily) SELECT bucket, day, n, round(m, 6) AS trailing_mean, round(100 * (1 - n / m), 4) AS drop_pct FROM t WHERE m >= 5 AND n * 2 < m")
def volume_drops(spark, sf_dir):
    return S.volume_drops(_daily(spark, sf_dir), ["bucket"], "day", "n").withColumn("trailing_mean", F.round("trailing_mean", 6))


@query(f"WITH {_DAILY}, b AS (SELECT bucket, day, n > 5 AS busy FROM daily), c AS (SELECT *, CASE WHEN lag(busy) OVER w IS NOT DISTINCT FROM busy AND lag(1) OVER w IS NOT NULL THEN 0 ELSE 1 END AS c FROM b WINDOW w AS (PARTITION BY bucket ORDER BY day)), g AS (SELECT *, sum(c) OVER (PARTITION BY bucket ORDER BY day) AS g FROM c) SELECT bucket, busy, min(day) AS from_day, max(day) AS to_day, count(*) AS n_days FROM g GROUP BY bucket, g, busy")
def run_lengths(spark, sf_dir):
    return S.runs(_daily(spark, sf_dir).select("bucket", "day", (F.col("n") > 5).alias("busy")), ["bucket"], "day", "busy")


_SHARES = f"{FACTS}, sh AS (SELECT story, day, count(DISTINCT feed) / 150.0 AS share FROM facts GROUP BY ALL), dl AS (SELECT *, share - lag(share) OVER (PARTITION BY story ORDER BY day) AS delta, row_number() OVER (PARTITION BY story ORDER BY day DESC) AS r FROM sh)"


def _shares(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("story", "day").agg((F.count_distinct("feed") / F.lit(150.0)).alias("share"))


@query(f"WITH {_SHARES} SELECT story, day, round(share, 6) AS share, round(delta, 6) AS delta, coalesce(abs(delta) > 0.1, false) AS moved FROM dl")
def frame_trajectory(spark, sf_dir):
    return S.share_changes(_shares(spark, sf_dir), ["story"], "day", "share").select("story", "day", F.round("share", 6).alias("share"), F.round("delta", 6).alias("delta"), "moved")


@query(f"WITH {_SHARES} SELECT story, round(max(abs(delta)), 6) AS max_move FROM dl WHERE r <= 7 GROUP BY story")
def largest_recent_moves(spark, sf_dir):
    return S.largest_recent_move(_shares(spark, sf_dir), ["story"], "day", "share").withColumn("max_move", F.round("max_move", 6))


_CCF = f"""{FACTS}, pr AS (SELECT bucket, story, day FROM facts GROUP BY ALL HAVING sum(value) > 250), ps AS (SELECT day, row_number() OVER (ORDER BY day) - 1 AS pos FROM (SELECT DISTINCT day FROM facts)),
pa AS (SELECT a.bucket AS a, b.bucket AS b FROM (SELECT DISTINCT bucket FROM pr) a JOIN (SELECT DISTINCT bucket FROM pr) b ON a.bucket < b.bucket), st AS (SELECT DISTINCT bucket, story FROM pr),
g AS (SELECT pa.a, pa.b, x.story, l.lag, p.pos FROM pa JOIN st x ON x.bucket = a JOIN st y ON y.bucket = b AND x.story = y.story CROSS JOIN (SELECT unnest(range(-7, 8)) AS lag) l CROSS JOIN ps p WHERE p.pos + lag BETWEEN 0 AND (SELECT max(pos) FROM ps)),
z AS (SELECT bucket, story, pos FROM pr JOIN ps USING (day)),
v AS (SELECT g.a, g.b, g.story, g.lag, CASE WHEN za.pos IS NULL THEN 0 ELSE 1 END AS x, CASE WHEN zb.pos IS NULL THEN 0 ELSE 1 END AS y FROM g LEFT JOIN z za ON za.bucket = g.a AND za.story = g.story AND za.pos = g.pos LEFT JOIN z zb ON zb.bucket = g.b AND zb.story = g.story AND zb.pos = g.pos + g.lag),
s AS (SELECT a, b, story, lag, count(*) AS n, sum(x) AS sa, sum(y) AS sb, sum(x * y) AS sab FROM v GROUP BY ALL),
r AS (SELECT a, b, story, CAST(lag AS INT) AS lag, n, CASE WHEN n >= 3 AND n * sa - sa * sa > 0 AND n * sb - sb * sb > 0 THEN round((n * sab - sa * sb) / sqrt(CAST(n * sa - sa * sa AS DOUBLE) * CAST(n * sb - sb * sb AS DOUBLE)), 6) END AS r FROM s)"""


def _ccf(spark, sf_dir):
    f = facts(spark, sf_dir)
    p = f.groupBy("bucket", "story", "day").agg(F.sum("value").alias("v")).filter("v > 250").select("bucket", "story", "day", F.lit(1).alias("x"))  # days of heavy coverage
    b = p.select("bucket").distinct()
    pairs = b.select(F.col("bucket").alias("a")).join(b.select(F.col("bucket").alias("b")), F.col("a") < F.col("b"))
    return S.lagged_correlation(p, pairs, f.select("day").distinct()).withColumn("r", F.round("r", 6))


@query(f"WITH {_CCF} SELECT * FROM r")
def lagged_correlation(spark, sf_dir):
    return _ccf(spark, sf_dir)


@query(f"WITH {_CCF}, k AS (SELECT *, row_number() OVER (PARTITION BY a, b, story ORDER BY r DESC, lag) AS k FROM r WHERE r IS NOT NULL) SELECT a, b, story, lag, n, r FROM k WHERE k = 1")
def peak_lags(spark, sf_dir):
    return S.peak_lag(_ccf(spark, sf_dir))


@query()
def lag_significance(spark, sf_dir):
    """p of r by an Arrow function, one family over every pair, story and lag."""
    from ..functions.stats import p_of_r
    from ..operators.terms import benjamini_hochberg

    tested = _ccf(spark, sf_dir).filter("r IS NOT NULL").withColumn("p", p_of_r(F.col("r"), F.col("n")))
    return benjamini_hochberg(tested, "p", []).filter("p <= 0.05")


@query(f"WITH {FACTS}, st AS (SELECT feed AS bucket, day, list_sort(list(DISTINCT story)) AS v FROM facts GROUP BY ALL), p AS (SELECT bucket, v, lag(v) OVER (PARTITION BY bucket ORDER BY day) AS b FROM st), j AS (SELECT bucket, len(list_intersect(v, b)) / len(list_distinct(list_concat(v, b))) AS j FROM p WHERE b IS NOT NULL) SELECT bucket, round(avg(j), 6) AS stability, count(*) AS n_pairs, avg(j) < 0.5 AS unstable FROM j GROUP BY bucket")
def frame_set_stability(spark, sf_dir):
    sets = facts(spark, sf_dir).groupBy(F.col("feed").alias("bucket"), "day").agg(F.array_sort(F.collect_set("story")).alias("v"))
    return S.set_stability(sets, ["bucket"], "day", "v").withColumn("stability", F.round("stability", 6))


_FEED = f"{FACTS}, fd AS (SELECT feed, day, count(*) AS n, sum(value) < 50 AS bad FROM facts GROUP BY ALL)"


@query(f"WITH {_FEED}, g AS (SELECT feed, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS n_bad, arg_min(n, day) AS first, arg_max(n, day) AS last, count(*) AS n_days FROM fd GROUP BY feed) SELECT *, n_bad >= 4 AS rotten, n_days >= 4 AND first >= 5 AND last * 2 < first AS declining FROM g")
def feed_rot(spark, sf_dir):
    d = facts(spark, sf_dir).groupBy("feed", "day").agg(F.count(F.lit(1)).alias("n"), (F.sum("value") < 50).alias("bad"))
    return S.feed_rot(d, "feed", "day", "bad", "n")


@query(f"WITH {_FEED}, u AS (SELECT feed, 100.0 * count(*) / 30 AS uptime FROM fd WHERE NOT bad GROUP BY 1) SELECT count(*) AS n_feeds, round(avg(uptime), 4) AS mean_uptime, round(median(uptime), 4) AS median_uptime FROM u")
def feed_uptime(spark, sf_dir):
    d = facts(spark, sf_dir).groupBy("feed", "day").agg((F.sum("value") < 50).alias("bad")).filter("NOT bad")
    u = d.groupBy("feed").agg((F.lit(100.0) * F.count(F.lit(1)) / 30).alias("uptime"))
    return u.agg(F.count(F.lit(1)).alias("n_feeds"), F.round(F.avg("uptime"), 4).alias("mean_uptime"), F.round(F.percentile("uptime", F.lit(0.5)), 4).alias("median_uptime"))


_STATUS = "CASE WHEN length(text) >= 1000 THEN 'FULL' WHEN length(text) >= 200 THEN 'PARTIAL' WHEN length(text) >= 50 THEN 'STUB' ELSE 'NONE' END"


@query(f"WITH s AS (SELECT source, {_STATUS} AS st FROM documents) SELECT source, " + ", ".join(f"CAST(sum(CASE WHEN st = '{x}' THEN 1 ELSE 0 END) AS BIGINT) AS {x.lower()}" for x in ("FULL", "PARTIAL", "STUB", "NONE", "ERROR", "SKIPPED")) + ", count(*) AS total, round(100.0 * sum(CASE WHEN st = 'FULL' THEN 1 ELSE 0 END) / count(*), 4) AS full_pct FROM s GROUP BY ROLLUP (source)")
def extraction_status(spark, sf_dir):
    d = read(spark, sf_dir, "documents").select("source", X.extraction_class(F.length("text"), F.lit(None)).alias("st"))
    return C.status_table(d, "source", "st")


@query(f"WITH {ARTICLES}, s AS (SELECT outlet, summary = '' OR (starts_with(summary, left(title, 60)) AND abs(length(summary) - length(title)) < 40) AS stub FROM articles) SELECT outlet, count(*) AS n, round(100.0 * sum(CASE WHEN stub THEN 1 ELSE 0 END) / count(*), 4) AS stub_pct, sum(CASE WHEN stub THEN 1 ELSE 0 END) >= 0.8 * count(*) AS flagged FROM s GROUP BY outlet")
def stub_share(spark, sf_dir):
    s = articles(spark, sf_dir).select("outlet", X.is_stub(F.col("title"), F.col("summary")).alias("stub"))
    n = F.count(F.lit(1))
    return s.groupBy("outlet").agg(n.alias("n"), F.round(100.0 * F.count_if("stub") / n, 4).alias("stub_pct"), (F.count_if("stub") >= 0.8 * n).alias("flagged"))


@query(f"WITH {ARTICLES}, m AS (SELECT *, regexp_matches(lower(body), '\\bwith\\b') AS hit FROM articles) SELECT outlet, CAST(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS BIGINT) AS n_matching, min(CASE WHEN hit THEN doc_id + 1 END) AS first_match_rank, arg_min(CASE WHEN hit THEN length(body) END, CASE WHEN hit THEN doc_id END) AS first_match_n_chars FROM m GROUP BY outlet")
def first_matches(spark, sf_dir):
    a = articles(spark, sf_dir).withColumn("hit", F.lower("body").rlike(r"\bwith\b")).withColumn("n_chars", F.length("body").cast("long"))
    return C.first_matches(a, "outlet", "doc_id", "hit", ["n_chars"])


@query(f"""WITH {FACTS}, m AS (SELECT story, bucket FROM facts GROUP BY ALL HAVING sum(value) > (SELECT sum(value) / 60 FROM facts)), o AS (SELECT bucket, sum(value) < 0 AS failed FROM facts WHERE bucket <> 'b7' GROUP BY 1), g AS (SELECT * FROM (SELECT DISTINCT story FROM facts) CROSS JOIN (SELECT DISTINCT bucket FROM facts))
SELECT g.story, g.bucket, CASE WHEN m.story IS NOT NULL THEN 'covered' WHEN failed THEN 'errored' WHEN failed IS NOT NULL THEN 'silent' ELSE 'dark' END AS state FROM g LEFT JOIN m ON g.story = m.story AND g.bucket = m.bucket LEFT JOIN o ON o.bucket = g.bucket""")
def coverage_matrix(spark, sf_dir):
    f = facts(spark, sf_dir)
    observed = f.filter("bucket <> 'b7'").groupBy("bucket").agg((F.sum("value") < 0).alias("failed"))
    total = f.agg((F.sum("value") / 60).alias("mean"))  # covered: more than the mean of all stories and buckets
    covered = f.groupBy("story", "bucket").agg(F.sum("value").alias("v")).crossJoin(total).filter("v > mean")
    return C.matrix(f, f, covered, observed)


@query(f"WITH {FACTS} SELECT story, count(DISTINCT bucket) AS n_buckets, count(DISTINCT feed) AS n_feeds, list_sort(list(value))[count(*) // 2 + 1] AS upper_median FROM facts GROUP BY story")
def coverage_summary(spark, sf_dir):
    f = facts(spark, sf_dir)
    n = f.groupBy("story").agg(F.count_distinct("bucket").alias("n_buckets"), F.count_distinct("feed").alias("n_feeds"))
    return n.join(C.upper_median(f, ["story"], "value"), "story")


@query(f"WITH {FACTS}, d AS (SELECT feed AS bucket, day, count(*) AS n FROM facts GROUP BY ALL), g AS (SELECT * FROM (SELECT DISTINCT feed AS bucket FROM facts) CROSS JOIN (SELECT DISTINCT day FROM facts)) SELECT g.bucket, CAST(sum(CASE WHEN d.n IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS zero_days, round(sum(coalesce(d.n, 0)) / count(*), 6) AS mean_volume FROM g LEFT JOIN d USING (bucket, day) GROUP BY g.bucket")
def zero_days(spark, sf_dir):
    f = facts(spark, sf_dir)
    days = f.agg(F.count_distinct("day").alias("d"))
    n = f.groupBy(F.col("feed").alias("bucket")).agg(F.count_distinct("day").alias("seen"), F.count(F.lit(1)).alias("n"))
    return n.crossJoin(days).select("bucket", (F.col("d") - F.col("seen")).alias("zero_days"), F.round(F.col("n") / F.col("d"), 6).alias("mean_volume"))


@query(f"WITH {FACTS}, d AS (SELECT day, story, bucket FROM facts), a AS (SELECT day, count(DISTINCT story) AS n_stories, arg_max(story, story) AS hero FROM d GROUP BY 1) SELECT day, n_stories, hero, date_trunc('month', day) IS DISTINCT FROM date_trunc('month', lag(day) OVER (ORDER BY day)) AS month_break FROM a")
def archive_summary(spark, sf_dir):
    a = facts(spark, sf_dir).groupBy("day").agg(F.count_distinct("story").alias("n_stories"), F.max("story").alias("hero"))
    month = F.trunc("day", "month")
    return a.withColumn("month_break", ~month.eqNullSafe(F.lag(month).over(W.partitionBy(F.lit(1)).orderBy("day"))))


_ITEMS = f"items AS (SELECT page_id, {CANONICAL} AS cu, 'f' || CAST(page_id % 6 AS VARCHAR) AS feed, html FROM pages)"


@query(f"WITH {_ITEMS} SELECT page_id, cu AS canonical_url, CASE WHEN cu <> '' THEN count(*) OVER (PARTITION BY cu) ELSE 0 END AS url_dup_count, CASE WHEN cu <> '' AND count(*) OVER (PARTITION BY cu) > 1 THEN array_to_string(list_sort(list_distinct(list(feed) OVER (PARTITION BY cu))), ',') ELSE '' END AS url_dup_feeds FROM items")
def url_duplicates(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", "url", F.lit("").alias("title"), F.concat(F.lit("f"), (F.col("page_id") % 6).cast("string")).alias("feed"))
    return D.annotate(p, "url", "title", "feed").select("page_id", "canonical_url", "url_dup_count", F.array_join("url_dup_feeds", ",").alias("url_dup_feeds"))


@query(f"WITH {_ITEMS} SELECT cu AS dedup_key, arg_max(page_id, (length(html), -page_id)) AS primary_id, count(*) AS n_items, array_to_string(list_sort(list(DISTINCT feed)), ',') AS source_feeds FROM items GROUP BY cu")
def dedup_primaries(spark, sf_dir):
    p = read(spark, sf_dir, "pages").select("page_id", "url", "html", F.lit("").alias("title"), F.concat(F.lit("f"), (F.col("page_id") % 6).cast("string")).alias("feed"))
    out = D.primaries(D.annotate(p, "url", "title", "feed"), "page_id", "html", "feed")
    return out.withColumn("source_feeds", F.array_join("source_feeds", ","))


@query(f"""WITH {ARTICLES}, s AS (SELECT title, min(day) AS first_seen FROM articles WHERE title <> '' AND day < DATE '2024-01-20' GROUP BY 1), k AS (SELECT * FROM s WHERE first_seen >= DATE '2024-01-20' - 15)
SELECT doc_id, first_seen AS cross_day_first_seen, first_seen IS NOT NULL AS cross_day_duplicate FROM articles LEFT JOIN k USING (title) WHERE day >= DATE '2024-01-20'""")
def cross_day_duplicates(spark, sf_dir):
    a = articles(spark, sf_dir).select("doc_id", "day", F.col("title").alias("normalised_title"), F.lit("").alias("canonical_url"))
    cut = F.lit("2024-01-20").cast("date")
    state = D.prune(D.first_seen(a.filter(F.col("day") < cut), "normalised_title", "day"), cut, 15)
    urls = state.filter("false").select(F.col("normalised_title").alias("canonical_url"), "first_seen")
    return D.cross_day(a.filter(F.col("day") >= cut), urls, state).select("doc_id", "cross_day_first_seen", "cross_day_duplicate")


@query(f"""WITH {ARTICLES}, t AS (SELECT doc_id, {title_tokens_sql('title')} AS w FROM articles), x AS (SELECT a.doc_id AS a, b.doc_id AS b, len(list_intersect(a.w, b.w)) AS k, len(a.w) AS na, len(b.w) AS nb FROM t a JOIN t b ON a.doc_id < b.doc_id AND len(a.w) > 0 AND len(b.w) > 0 AND len(a.w) <= len(b.w) / 0.6 + 1e-9 AND len(b.w) <= len(a.w) / 0.6 + 1e-9)
SELECT a, b, round(k / (na + nb - k), 6) AS jaccard FROM x WHERE k / (na + nb - k) >= 0.6""")
def syndicated_titles(spark, sf_dir):
    a = articles(spark, sf_dir)
    return D.similar_titles(a, "doc_id", X.title_tokens(F.col("title")), digits=6)


_SITE = "regexp_replace(lower(regexp_extract(url, '^https?://([^/?#]*)', 1)), '^(?:www\\.)?(?:m\\.)?', '') || regexp_replace(regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1), '/+$', '')"


@query(f"WITH p AS (SELECT url, {_SITE} AS u, regexp_extract(url, '^https?://[^/?#]*/([^/?#]+)', 1) AS cat FROM pages), f AS (SELECT DISTINCT u FROM p WHERE url LIKE 'http://%'), s AS (SELECT DISTINCT u, cat FROM p WHERE url LIKE 'https://%'), m AS (SELECT cat, count(*) AS n FROM s WHERE u NOT IN (SELECT u FROM f) GROUP BY 1) SELECT cat AS category, n AS n_missing, row_number() OVER (ORDER BY n DESC, cat) AS rank FROM m ORDER BY n DESC, cat LIMIT 10")
def sitemap_gaps(spark, sf_dir):
    from ..functions import urls

    u = F.concat(urls.site(F.col("url")), F.regexp_replace(urls.path(F.col("url")), "/+$", ""))
    p = read(spark, sf_dir, "pages").select(urls.scheme(F.col("url")).alias("scheme"), u.alias("u"), urls.category(F.col("url")).alias("category"))
    missing = p.filter("scheme = 'https'").select("u", "category").distinct().join(p.filter("scheme = 'http'").select("u"), "u", "left_anti")
    n = missing.groupBy("category").agg(F.count(F.lit(1)).alias("n_missing"))
    top = n.orderBy(F.desc("n_missing"), "category").limit(10)
    return top.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(1)).orderBy(F.desc("n_missing"), "category")).cast("long"))


@query(r"WITH h AS (SELECT regexp_extract(url, '^(https?)://', 1) AS sc, regexp_replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '^(?:www|m|blog)\.', '') AS url FROM pages), a AS (SELECT DISTINCT url FROM h WHERE sc = 'http'), b AS (SELECT DISTINCT url FROM h WHERE sc = 'https') SELECT 'both' AS side, url FROM (SELECT url FROM a INTERSECT SELECT url FROM b) UNION ALL SELECT 'first', url FROM (SELECT url FROM a EXCEPT SELECT url FROM b) UNION ALL SELECT 'second', url FROM (SELECT url FROM b EXCEPT SELECT url FROM a)")
def set_differences(spark, sf_dir):
    from ..functions import urls

    p = read(spark, sf_dir, "pages").select(urls.scheme(F.col("url")).alias("sc"), F.regexp_replace(urls.host(F.col("url")), r"^(?:www|m|blog)\.", "").alias("url"))
    a, b = p.filter("sc = 'http'").select("url"), p.filter("sc = 'https'").select("url")
    parts = (("both", a.intersect(b)), ("first", a.subtract(b)), ("second", b.subtract(a)))
    out = None
    for name, part in parts:
        part = part.select(F.lit(name).alias("side"), "url")
        out = part if out is None else out.unionByName(part)
    return out


@query(f"WITH {FACTS} SELECT CAST(date_trunc('month', day) AS DATE) AS month, bucket, count(*) AS n_files, min(event_id) AS first_name, max(event_id) AS last_name FROM facts WHERE day < DATE '2024-01-20' GROUP BY ALL")
def retention_manifest(spark, sf_dir):
    from ..sources.retention import manifest

    return manifest(facts(spark, sf_dir), "day", ["bucket"], "event_id", F.lit("2024-01-20").cast("date"), 0)
