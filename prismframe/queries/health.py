"""Health of feeds, story signals, lineage ids, cards, loose input: the operators of a daily run on the driver's tables."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import loose, urls
from ..functions import text as X
from ..operators import health as H
from ..operators import publish as P
from ..operators import quality as QL
from ..operators import series as S
from ..operators import stories as ST
from ..sources import encoding, feeds
from .registry import ARTICLES, FACTS, articles, facts, query, read, title_tokens_sql

_FEEDS = f"""{FACTS}, fd AS (SELECT bucket, 'u' || CAST(feed AS VARCHAR) AS feed, count(*) AS n_items, CAST(sum(CASE WHEN value < 20 THEN 1 ELSE 0 END) AS BIGINT) AS n_stubs, CASE WHEN feed % 11 = 0 THEN NULL WHEN feed % 7 = 0 THEN 503 ELSE 200 END AS http_status,
 CASE WHEN feed % 13 = 0 THEN 'timeout' END AS error, CAST(count(*) * 29 + feed AS INT) AS fetch_ms FROM facts GROUP BY bucket, feed.feed),
h AS (SELECT *, round(100.0 * n_stubs / n_items, 1) AS stub_pct, 100.0 * n_stubs / n_items >= 30 AS stub_only, fetch_ms > 3000 AS slow, error IS NOT NULL OR coalesce(http_status, 200) <> 200 AS failed, error IS NOT NULL OR coalesce(http_status, 0) <> 200 AS errored FROM fd)""".replace("feed.feed", "facts.feed")


def _feeds(spark, sf_dir):
    """A feed per user of the events: an eleventh has no status, a seventh fails, stubs are events below 20."""
    f = facts(spark, sf_dir).groupBy("bucket", F.col("feed").alias("u")).agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("value") < 20).alias("n_stubs"))
    status = F.when(F.col("u") % 11 == 0, F.lit(None)).when(F.col("u") % 7 == 0, 503).otherwise(200)
    return f.select("bucket", F.concat(F.lit("u"), F.col("u").cast("string")).alias("feed"), "n_items", "n_stubs", status.alias("http_status"), F.when(F.col("u") % 13 == 0, "timeout").alias("error"), (F.col("n_items") * 29 + F.col("u")).cast("int").alias("fetch_ms"))


@query(f"WITH {_FEEDS} SELECT bucket, feed, n_items, stub_pct, stub_only, slow, failed FROM h")
def feed_health(spark, sf_dir):
    return H.feed_health(_feeds(spark, sf_dir), 30, 3000).select("bucket", "feed", "n_items", "stub_pct", "stub_only", "slow", "failed")


@query(f"""WITH {_FEEDS}, s80 AS (SELECT *, 100.0 * n_stubs / n_items >= 80 AS so FROM h) SELECT 'total' AS section, x.name AS bucket, NULL::VARCHAR AS feed, CAST(x.v AS DOUBLE) AS value FROM (SELECT unnest(['feeds', 'items', 'errored', 'stub_only']) AS name, unnest([count(*), CAST(sum(n_items) AS BIGINT), CAST(sum(CASE WHEN errored THEN 1 ELSE 0 END) AS BIGINT), CAST(sum(CASE WHEN so THEN 1 ELSE 0 END) AS BIGINT)]) AS v FROM s80) x
UNION ALL SELECT 'items', bucket, NULL, CAST(sum(n_items) AS DOUBLE) FROM h GROUP BY bucket UNION ALL SELECT 'errored', bucket, feed, CAST(http_status AS DOUBLE) FROM h WHERE errored UNION ALL SELECT 'stub_only', bucket, feed, stub_pct FROM s80 WHERE so
UNION ALL SELECT 'slow', bucket, feed, CAST(fetch_ms AS DOUBLE) FROM (SELECT * FROM h ORDER BY fetch_ms DESC, bucket, feed LIMIT 15)""")
def pull_report(spark, sf_dir):
    return H.pull_report(_feeds(spark, sf_dir))


@query(f"""WITH {FACTS}, d AS (SELECT bucket, day, CAST(sum(CASE WHEN value > 120 THEN 1 ELSE 0 END) AS BIGINT) AS now FROM facts GROUP BY ALL), a AS (SELECT *, avg(now) OVER (PARTITION BY bucket ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS avg7 FROM d)
SELECT bucket, day, 'structural_silence' AS alert_type, now, round(avg7, 6) AS avg7 FROM a WHERE now * 2 < avg7 AND now = 0 AND avg7 >= 2""")
def structural_silence(spark, sf_dir):
    d = facts(spark, sf_dir).groupBy("bucket", "day").agg(F.count_if(F.col("value") > 120).alias("now"))
    alerts = S.trailing_mean(d, ["bucket"], "day", "now").withColumnRenamed("trailing_mean", "avg7").filter("now * 2 < avg7").withColumn("alert_type", F.lit("volume_drop"))
    return H.structural_silence(alerts).select("bucket", "day", "alert_type", "now", F.round("avg7", 6).alias("avg7"))


_PAY = "(subscribers?|members?) only|(subscribe to|register to|sign in to) read|subscribe to continue|to continue reading|premium content|unlock this article|this article is for"


@query(f"""WITH {ARTICLES}, i AS (SELECT outlet, doc_id, title, summary || CASE WHEN doc_id % 11 = 0 THEN ' Subscribers only' WHEN doc_id % 17 = 0 THEN ' Sign in to read on' ELSE '' END AS summary, CASE WHEN doc_id % 5 = 0 THEN 'https://news.google.com/x' ELSE 'https://a.org/' END AS link FROM articles),
n AS (SELECT *, trim(summary) AS s, trim(regexp_replace(summary, '&nbsp;|\\s+', ' ', 'g')) AS sc, trim(regexp_replace(title, '&nbsp;|\\s+', ' ', 'g')) AS tc FROM i)
SELECT outlet, count(*) AS n, round(avg(length(s)), 4) AS mean_chars, round(100.0 * sum(CASE WHEN regexp_matches(lower(s), '{_PAY}') THEN 1 ELSE 0 END) / count(*), 4) AS paywall_pct, round(100.0 * sum(CASE WHEN contains(link, 'news.google.com') THEN 1 ELSE 0 END) / count(*), 4) AS aggregator_pct,
round(100.0 * sum(CASE WHEN starts_with(sc, left(tc, 60)) AND length(sc) - length(tc) < 60 THEN 1 ELSE 0 END) / count(*), 4) AS title_pct FROM n GROUP BY outlet""")
def content_signals(spark, sf_dir):
    a = articles(spark, sf_dir)
    tail = F.when(F.col("doc_id") % 11 == 0, " Subscribers only").when(F.col("doc_id") % 17 == 0, " Sign in to read on").otherwise("")
    i = a.select("outlet", "title", F.concat("summary", tail).alias("summary"), F.when(F.col("doc_id") % 5 == 0, "https://news.google.com/x").otherwise("https://a.org/").alias("link"))
    return H.content_signals(i, ["outlet"], "title", "summary", "link")


@query("""WITH p AS (SELECT page_id, lower(url) AS u, ['confirmed', 'ok?', 'likely', 'expected fail', 'uncertain', 'new', NULL][page_id % 7 + 1] AS st FROM pages) SELECT CASE st WHEN 'confirmed' THEN 'CONFIRMED' WHEN 'ok?' THEN 'OK' WHEN 'likely' THEN 'LIKELY OK' WHEN 'expected fail' THEN 'EXPECTED FAIL' WHEN 'uncertain' THEN 'UNCERTAIN' ELSE 'OTHER' END AS status,
CASE WHEN contains(regexp_extract(u, '^https?://[^/?#]*([^?#]*)', 1), '/en/') THEN 'world' ELSE 'root/other' END AS section, count(*) AS n FROM p GROUP BY ALL""")
def status_and_section(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    words = F.array(*[F.lit(x) for x in ("confirmed", "ok?", "likely", "expected fail", "uncertain", "new", None)])
    path = F.regexp_replace(urls.path(F.col("url")), "/en/", "/world/")
    return p.groupBy(H.status_bucket(F.get(words, (F.col("page_id") % 7).cast("int"))).alias("status"), H.section_hint(path, urls.host(F.col("url"))).alias("section")).agg(F.count(F.lit(1)).alias("n"))


_CLUSTERS = f"""{ARTICLES}, cl AS (SELECT day, story AS cluster_id, count(*) AS n_articles, count(DISTINCT outlet) AS n_outlets, count(DISTINCT country) AS n_countries FROM articles GROUP BY ALL)"""


def _clusters(spark, sf_dir):
    return articles(spark, sf_dir).groupBy("day", F.col("story").alias("cluster_id")).agg(F.count(F.lit(1)).alias("n_articles"), F.count_distinct("outlet").alias("n_outlets"), F.count_distinct("country").alias("n_countries"))


@query(f"WITH {_CLUSTERS} SELECT day, cluster_id, n_countries, n_articles, row_number() OVER (PARTITION BY day ORDER BY n_countries DESC, n_articles DESC, cluster_id) AS rank FROM cl WHERE n_outlets >= 3")
def qualifying_clusters(spark, sf_dir):
    return ST.ordered_clusters(ST.qualifying(_clusters(spark, sf_dir))).select("day", "cluster_id", "n_countries", "n_articles", "rank")


_LINEAGES = """li AS (SELECT 'L' || left(md5(cluster_id), 10) AS lineage_id, min(day) AS seed_day, cluster_id AS seed_cluster, max(day) AS latest_day, cluster_id AS latest_cluster, count(*) AS n_days, max(n_countries) AS n_countries FROM cl WHERE cluster_id <> 's3' GROUP BY cluster_id)"""


def _lineages(clusters):
    c = clusters.filter("cluster_id <> 's3'").groupBy("cluster_id").agg(F.min("day").alias("seed_day"), F.max("day").alias("latest_day"), F.count(F.lit(1)).alias("n_days"), F.max("n_countries").alias("n_countries"))
    return c.select(F.concat(F.lit("L"), F.left(F.md5("cluster_id"), F.lit(10))).alias("lineage_id"), "seed_day", F.col("cluster_id").alias("seed_cluster"), "latest_day", F.col("cluster_id").alias("latest_cluster"), "n_days", "n_countries")


@query(f"""WITH {_CLUSTERS}, {_LINEAGES}, e AS (SELECT seed_day AS day, seed_cluster AS cluster_id, lineage_id FROM li UNION SELECT latest_day, latest_cluster, lineage_id FROM li)
SELECT cl.day, cl.cluster_id, coalesce(lineage_id, 'L' || left(sha256(CAST(cl.day AS VARCHAR) || '|' || cl.cluster_id), 10)) AS lineage_id FROM cl LEFT JOIN e ON cl.day = e.day AND cl.cluster_id = e.cluster_id""")
def lineage_reuse(spark, sf_dir):
    c = _clusters(spark, sf_dir)
    return ST.lineage_ids(c, _lineages(c)).select("day", "cluster_id", "lineage_id")


@query(f"WITH {_CLUSTERS}, {_LINEAGES} SELECT lineage_id, n_days, n_countries FROM li ORDER BY n_days DESC, n_countries DESC, lineage_id LIMIT 10")
def longest_lineages(spark, sf_dir):
    return ST.ordered_lineages(_lineages(_clusters(spark, sf_dir)), 10).select("lineage_id", "n_days", "n_countries")


_SIGNAL = f"""{FACTS}, st AS (SELECT DISTINCT day, story FROM facts), an AS (SELECT day, story, max(event_id) AS top FROM facts WHERE value > 150 GROUP BY ALL), tr AS (SELECT story, count(DISTINCT day) AS days FROM facts WHERE story <> 'error' GROUP BY 1), cv AS (SELECT day, count(DISTINCT bucket) AS buckets FROM facts GROUP BY 1),
so AS (SELECT day, story, count(DISTINCT feed) AS speakers FROM facts WHERE value > 60 GROUP BY ALL), ll AS (SELECT day, story, max(value) AS best FROM facts WHERE value > 200 GROUP BY ALL), pm AS (SELECT day, story, min(value) AS least FROM facts WHERE value < 1 GROUP BY ALL), me AS (SELECT day, story, count(*) AS n FROM facts GROUP BY ALL),
bk AS (SELECT DISTINCT day, story, bucket FROM facts WHERE value > 100), ti AS (SELECT bucket, 'u' || CAST(feed AS VARCHAR) AS outlet, max(value) AS z FROM facts WHERE feed % 10 = 0 GROUP BY bucket, feed), tl AS (SELECT day, story, count(*) AS n_tilt, max(z) AS top_z FROM bk JOIN ti USING (bucket) GROUP BY ALL)"""


@query(f"""WITH {_SIGNAL} SELECT st.day, st.story, an.top, tr.days, cv.buckets, so.speakers, ll.best, pm.least, me.n, coalesce(tl.n_tilt, 0) AS n_tilt, tl.top_z FROM st LEFT JOIN an USING (day, story) LEFT JOIN tr ON st.story = tr.story LEFT JOIN cv ON st.day = cv.day LEFT JOIN so ON so.day = st.day AND so.story = st.story
LEFT JOIN ll ON ll.day = st.day AND ll.story = st.story LEFT JOIN pm ON pm.day = st.day AND pm.story = st.story LEFT JOIN me ON me.day = st.day AND me.story = st.story LEFT JOIN tl ON tl.day = st.day AND tl.story = st.story""")
def story_signals(spark, sf_dir):
    f, key = facts(spark, sf_dir), ["day", "story"]
    parts = {
        "analysis": (f.filter("value > 150").groupBy(*key).agg(F.max("event_id").alias("top")), key), "trajectory": (f.filter("story <> 'error'").groupBy("story").agg(F.count_distinct("day").alias("days")), ["story"]),
        "coverage": (f.groupBy("day").agg(F.count_distinct("bucket").alias("buckets")), ["day"]), "sources": (f.filter("value > 60").groupBy(*key).agg(F.count_distinct("feed").alias("speakers")), key),
        "llr": (f.filter("value > 200").groupBy(*key).agg(F.max("value").alias("best")), key), "pmi": (f.filter("value < 1").groupBy(*key).agg(F.min("value").alias("least")), key), "metrics": (f.groupBy(*key).agg(F.count(F.lit(1)).alias("n")), key),
    }
    tilt = f.filter("feed % 10 = 0").groupBy("bucket", F.concat(F.lit("u"), F.col("feed").cast("string")).alias("outlet")).agg(F.max("value").alias("z"))
    s = ST.story_signals(f.select(*key).distinct(), parts, f.filter("value > 100"), tilt)
    return s.select("day", "story", "analysis.top", "trajectory.days", "coverage.buckets", "sources.speakers", "llr.best", "pmi.least", "metrics.n", F.coalesce(F.size("tilt"), F.lit(0)).cast("long").alias("n_tilt"), F.array_max(F.col("tilt.z")).alias("top_z")).withColumn("n_tilt", F.greatest("n_tilt", F.lit(0)))


@query(f"""WITH {ARTICLES}, c AS (SELECT outlet, length(body) AS n, day FROM articles), fd AS (SELECT outlet, day, CAST(sum(n) AS BIGINT) AS n FROM c GROUP BY ALL), g AS (SELECT outlet, arg_min(n, day) AS first, arg_max(n, day) AS last, count(*) AS d FROM fd GROUP BY 1) SELECT outlet, first, last FROM g WHERE d >= 4 AND first >= 5 AND last * 2 < first ORDER BY first DESC, outlet LIMIT 20""")
def steepest_declines(spark, sf_dir):
    d = articles(spark, sf_dir).groupBy("outlet", "day").agg(F.sum(F.length("body")).alias("n")).withColumn("bad", F.lit(False))
    return S.steepest_declines(S.feed_rot(d, "outlet", "day", "bad", "n"), "outlet")


@query(f"WITH {FACTS}, t AS (SELECT bucket, story AS term, sum(value) AS v FROM facts GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY v DESC, term) AS rank FROM t) SELECT bucket, term, round(v, 4) AS g2 FROM r WHERE rank = 1 ORDER BY g2 DESC, bucket LIMIT 6")
def word_card(spark, sf_dir):
    t = facts(spark, sf_dir).groupBy("bucket", F.col("story").alias("term")).agg(F.sum("value").alias("v"))
    ranked = t.withColumn("rank", F.row_number().over(W.partitionBy("bucket").orderBy(F.desc("v"), "term"))).withColumn("g2", F.round("v", 4))
    return P.word_card(ranked)


@query(f"WITH {FACTS}, w AS (SELECT bucket, greatest(max(value - 300), 0) AS z FROM facts WHERE story = 'view' GROUP BY 1), m AS (SELECT bucket, greatest(max(value - 200), 0) AS z FROM facts WHERE story = 'click' GROUP BY 1) SELECT bucket, coalesce(w.z, 0) AS z_wire, coalesce(m.z, 0) AS z_mean FROM w FULL JOIN m USING (bucket) ORDER BY z_wire DESC, bucket LIMIT 5")
def tilt_card(spark, sf_dir):
    f = facts(spark, sf_dir)
    return P.tilt_card(f.filter("story = 'view'").select("bucket", (F.col("value") - 300).alias("z")), f.filter("story = 'click'").select("bucket", (F.col("value") - 200).alias("z")))


@query(f"WITH {FACTS}, sh AS (SELECT story, day, count(DISTINCT feed) / 150.0 AS share FROM facts GROUP BY ALL), dl AS (SELECT *, share - lag(share) OVER (PARTITION BY story ORDER BY day) AS delta, row_number() OVER (PARTITION BY story ORDER BY day DESC) AS r FROM sh), b AS (SELECT story, max(abs(delta)) AS m FROM dl WHERE r <= 7 GROUP BY 1 ORDER BY m DESC, story LIMIT 1) SELECT story, day, round(share, 6) AS share, round(delta, 6) AS delta FROM dl WHERE r <= 7 AND story IN (SELECT story FROM b)")
def shift_card(spark, sf_dir):
    sh = facts(spark, sf_dir).groupBy("story", "day").agg((F.count_distinct("feed") / F.lit(150.0)).alias("share"))
    return P.shift_card(sh, "story", "day", "share").select("story", "day", F.round("share", 6).alias("share"), F.round("delta", 6).alias("delta"))


@query(f"""WITH {ARTICLES}, t AS (SELECT title, count(DISTINCT outlet) AS n_countries, max(day) AS day FROM articles GROUP BY 1), r AS (SELECT *, row_number() OVER (PARTITION BY left(title, 40) ORDER BY n_countries DESC, day DESC, title DESC) AS r FROM t) SELECT title, n_countries, day FROM r WHERE r = 1 ORDER BY n_countries DESC, day DESC, title DESC LIMIT 10""")
def widest_stories(spark, sf_dir):
    t = articles(spark, sf_dir).groupBy("title").agg(F.count_distinct("outlet").alias("n_countries"), F.max("day").alias("day"))
    return ST.widest(t).select("title", "n_countries", "day")


@query(f"""WITH {ARTICLES}, c AS (SELECT day, story, count(DISTINCT outlet) AS n FROM articles GROUP BY ALL), t AS (SELECT DISTINCT a.day, unnest({title_tokens_sql('title')}) AS term FROM articles a JOIN c USING (day, story) WHERE n >= 2) SELECT term, count(DISTINCT day) AS n_days FROM t GROUP BY 1""")
def themes_of_wide_stories(spark, sf_dir):
    """Two outlets make a story wide here: at the smallest scale no more share one on a day."""
    a = articles(spark, sf_dir)
    c = a.groupBy("day", "story").agg(F.count_distinct("outlet").alias("n_countries"))
    return ST.persistent_themes(a.join(c, ["day", "story"]), X.title_tokens(F.col("title")), 2)


@query("""WITH r AS (SELECT page_id, left(regexp_extract(url, '^https?://([^/?#]*)', 1), 60) AS src, 'C' || CAST(page_id % 9 AS VARCHAR) AS c, ['TAX', 'WAR', 'ART'][page_id % 3 + 1] AS th, CASE WHEN page_id % 4 = 0 THEN 'fra' ELSE 'eng' END AS l FROM pages WHERE page_id % 13 <> 5),
x AS (SELECT 'country' AS kind, c AS item FROM r UNION ALL SELECT 'source', src FROM r UNION ALL SELECT 'theme', th FROM r UNION ALL SELECT 'theme', 'ALL' FROM r UNION ALL SELECT 'language', l FROM r), n AS (SELECT kind, item, count(*) AS n FROM x GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY n DESC, item) AS rank FROM n)
SELECT * FROM k WHERE rank <= CASE kind WHEN 'country' THEN 25 WHEN 'language' THEN 20 ELSE 30 END""")
def gkg_counters(spark, sf_dir):
    """Pages as knowledge-graph records of 27 columns; every thirteenth is cut short and skipped."""
    p = read(spark, sf_dir, "pages")
    i = F.col("page_id")
    values = {name: F.lit("") for name in feeds.GKG} | {
        "source": urls.host(F.col("url")), "themes": F.concat(F.get(F.array(F.lit("TAX"), F.lit("WAR"), F.lit("ART")), (i % 3).cast("int")), F.lit(",12;ALL,3;")),
        "locations": F.concat(F.lit("4#Town#XX#1;1#Land#C"), (i % 9).cast("string"), F.lit("#5;1#Other#ZZ#2")), "translation": F.when(i % 4 == 0, "srclc:fra;eng:x").otherwise(""),
    }
    line = F.array_join(F.array(*[values[name] for name in feeds.GKG]), "\t")
    return feeds.gkg_counters(feeds.parse_gkg(p.select(F.when(i % 13 == 5, "short\tline").otherwise(line).alias("value"))))


@query("""SELECT event_id, array_to_string(list_filter([CASE event_id % 5 WHEN 1 THEN 'k: STRING instead of BIGINT' WHEN 2 THEN 'k: missing' END, CASE WHEN event_id % 5 = 3 THEN 'not JSON' END, CASE WHEN event_id % 5 = 4 THEN 'name: BIGINT instead of STRING' END], lambda e: e IS NOT NULL), ',') AS errors FROM events""")
def json_schema_errors(spark, sf_dir):
    e, m = read(spark, sf_dir, "events"), F.col("event_id") % 5
    doc = F.when(m == 1, '{"k": "x"}').when(m == 2, '{"name": "n"}').when(m == 3, '{"k": ').when(m == 4, '{"k": 1, "name": 7}').otherwise(F.col("props"))
    return QL.json_errors(e.select("event_id", doc.alias("doc")), "doc", {"k": "BIGINT", "name": "STRING"}, ("k",)).select("event_id", F.array_join("errors", ",").alias("errors"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 4 THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""")
def loose_json(spark, sf_dir):
    e, m = read(spark, sf_dir, "events"), F.col("event_id") % 5
    said = F.when(m == 0, F.col("props")).when(m == 1, F.concat(F.lit("```json\n"), "props", F.lit("\n```"))).when(m == 2, F.concat(F.lit("Here it is: "), "props", F.lit(" Bye."))).when(m == 3, F.concat(F.lit("\n```\n"), "props", F.lit("```\n"))).otherwise("none {k: }")
    return e.select("event_id", F.try_variant_get(loose.loose_json(said), "$.k", "bigint").alias("k"))


@query("""WITH c AS (SELECT conv_id, turn, coalesce(text, '') AS t FROM conversations) SELECT conv_id, turn, CASE turn % 3 WHEN 0 THEN true WHEN 1 THEN true ELSE contains(lower(t), 'not in the text') END AS found FROM c""")
def quotes_found(spark, sf_dir):
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.coalesce("text", F.lit("")).alias("t"))
    q = F.when(F.col("turn") % 3 == 0, F.regexp_replace("t", " ", "  ")).when(F.col("turn") % 3 == 1, F.lower(F.left("t", F.lit(30)))).otherwise("not in the text")
    return c.select("conv_id", "turn", loose.quote_found(q, F.col("t")).alias("found"))


@query("SELECT doc_id, 64 AS dims, CASE WHEN text IS NULL OR trim(text) = '' THEN 0.0 ELSE 1.0 END AS norm FROM documents")
def encoded_documents(spark, sf_dir):
    """Through the pluggable encoder, here word hashes; a model's encoder takes the same place."""
    from ..functions.vectors import norm

    d = encoding.embed(read(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")), "text")
    return d.select("doc_id", F.size("embedding").alias("dims"), F.round(norm(F.col("embedding")), 6).alias("norm"))
