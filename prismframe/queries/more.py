"""Selection, contracts, cards, dimensions and archives."""

from pyspark.sql import functions as F

from ..functions import urls
from ..operators import quality as QL
from ..operators import selection as SL
from ..sources import snapshots, webarchive
from .registry import ARTICLES, FACTS, QUOTES, articles, facts, query, quotes, read


@query("""WITH i AS (SELECT doc_id, source, text, CASE doc_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'ERROR' WHEN 2 THEN 'FULL' ELSE 'NONE' END AS st FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM i WHERE st IS NULL OR st IN ('ERROR', 'NONE')) SELECT doc_id, source FROM r WHERE r <= 3 OR length(text) > 5000""")
def items_to_extract(spark, sf_dir):
    m = F.col("doc_id") % 4
    d = read(spark, sf_dir, "documents").select("doc_id", "source", F.length("text").alias("n"), F.lit("x").alias("link"), F.when(m == 1, "ERROR").when(m == 2, "FULL").when(m == 3, "NONE").alias("st"))
    return SL.select_items(d, "source", "doc_id", "link", "st", F.col("n") > 5000, 3).select("doc_id", "source")


@query("""SELECT doc_id, CASE WHEN length(text) >= 200 THEN 'done' WHEN doc_id % 3 = 0 OR doc_id % 3 = 1 THEN 'archive' WHEN doc_id % 2 = 0 THEN 'crawl' ELSE 'none' END AS tier FROM documents""")
def extraction_tiers(spark, sf_dir):
    m = F.col("doc_id") % 3
    http = F.when(m == 1, 403).when(m == 2, 200)
    return read(spark, sf_dir, "documents").select("doc_id", SL.next_tier(F.length("text"), http, F.col("doc_id") % 2 == 0).alias("tier"))


@query()
def stable_sample(spark, sf_dir):
    """Sampling is the feature: 200 rows by a seeded hash."""
    return SL.stable_sample(read(spark, sf_dir, "documents").select("doc_id", "source"), "doc_id", 200)


@query()
def headline_strip(spark, sf_dir):
    """Greedy, so without SQL: headlines of different frames and buckets."""
    return SL.headline_strip(quotes(spark, sf_dir), ["story"], "frame", "speaker_type", "idx")


@query(f"WITH {ARTICLES} SELECT story, arg_min(title, (CASE WHEN outlet = 'src1' THEN 0 ELSE 1 END, doc_id)) AS representative, count(DISTINCT outlet) AS n_feeds FROM articles GROUP BY story")
def cluster_representatives(spark, sf_dir):
    a = articles(spark, sf_dir).select("story", "outlet", "doc_id", F.col("title").alias("t"), (F.col("outlet") == "src1").alias("wire"))
    r = SL.representative(a, ["story"], "wire", "doc_id", "t")
    return r.join(a.groupBy("story").agg(F.count_distinct("outlet").alias("n_feeds")), "story")


@query(f"""WITH {FACTS}, s AS (SELECT story, day, count(DISTINCT bucket) AS n, max(value) AS v FROM facts GROUP BY ALL) SELECT story, day, array_to_string(list_filter([CASE WHEN n < 12 THEN 'silence' END, CASE WHEN v > 180 THEN 'tilt' END, 'word'], lambda x: x IS NOT NULL), ',') AS kinds,
n >= 8 AND v >= 100 AS shown, story || ': ' || CAST(n AS VARCHAR) || ' buckets' || CASE WHEN n < 12 THEN ', ' || CAST(12 - n AS VARCHAR) || ' silent' ELSE '' END || '.' AS sentence FROM s""")
def story_cards(spark, sf_dir):
    s = facts(spark, sf_dir).groupBy("story", "day").agg(F.count_distinct("bucket").alias("n"), F.max("value").alias("v"))
    kinds = SL.archetypes(silence=F.col("n") < 12, tilt=F.col("v") > 180, word=F.lit(True))
    shown = SL.precondition({"type": "count_in_state", "field": "n", "value": 8, "and": {"type": "max_z_score", "field": "v", "value": 100}})
    sentence = SL.synthesis(F.col("story"), F.col("n"), 12 - F.col("n"), F.lit("frame"), F.lit(0.0))
    return s.select("story", "day", F.array_join(kinds, ",").alias("kinds"), shown.alias("shown"), sentence.alias("sentence"))


@query("WITH o AS (SELECT o_custkey % 500 AS key, o_orderkey AS t, CASE o_orderkey % 5 WHEN 0 THEN 'stage' WHEN 1 THEN 'approve' WHEN 2 THEN 'reject' ELSE 'none' END AS a FROM orders), l AS (SELECT key, max(CASE WHEN a = 'stage' THEN t END) AS s FROM o GROUP BY 1), f AS (SELECT l.key, s, arg_min(a, t) FILTER (WHERE t > s AND a IN ('approve', 'reject')) AS d FROM l JOIN o USING (key) GROUP BY ALL) SELECT key, CASE WHEN s IS NULL THEN 'none' WHEN d = 'approve' THEN 'approved' WHEN d = 'reject' THEN 'rejected' ELSE 'pending' END AS state FROM f")
def staging_states(spark, sf_dir):
    m = F.col("o_orderkey") % 5
    o = read(spark, sf_dir, "orders").select((F.col("o_custkey") % 500).alias("key"), F.col("o_orderkey").alias("t"), F.when(m == 0, "stage").when(m == 1, "approve").when(m == 2, "reject").otherwise("none").alias("a"))
    return SL.staging(o, "key", "t", "a")


@query(f"WITH {QUOTES}, c AS (SELECT DISTINCT frame FROM quotes WHERE frame <> 'f3') SELECT story, idx, frame, CASE WHEN frame NOT IN (SELECT frame FROM c) THEN 'unknown frame' END AS error FROM quotes WHERE frame NOT IN (SELECT frame FROM c)")
def codebook_check(spark, sf_dir):
    q = quotes(spark, sf_dir)
    return QL.codebook_errors(q, q.filter("frame <> 'f3'").select("frame"), "frame", "stance").select("story", "idx", "frame", "error")


@query("WITH m AS (SELECT source, count(*) AS n, sum(n_chars) AS chars FROM documents GROUP BY 1), s AS (SELECT source, n + CASE WHEN source IN ('src3', 'src9') THEN 1 ELSE 0 END AS n, chars + CASE WHEN source = 'src9' THEN 5 ELSE 0 END AS chars FROM m WHERE source <> 'src5') SELECT source, 'n' AS name, CAST(s.n AS DOUBLE) AS stated, CAST(m.n AS DOUBLE) AS measured FROM s JOIN m USING (source) WHERE s.n <> m.n UNION ALL SELECT source, 'chars', CAST(s.chars AS DOUBLE), CAST(m.chars AS DOUBLE) FROM s JOIN m USING (source) WHERE s.chars <> m.chars")
def number_check(spark, sf_dir):
    m = read(spark, sf_dir, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))
    s = m.filter("source <> 'src5'").select("source", (F.col("n") + F.col("source").isin("src3", "src9").cast("int")).alias("n"), (F.col("chars") + F.when(F.col("source") == "src9", 5).otherwise(0)).alias("chars"))
    return QL.number_errors(s, m, ["source"], ["n", "chars"])


@query("SELECT r_name, 'v2.1' AS meta_version, r_regionkey % 2 <> 0 AS restamped FROM region")
def version_stamps(spark, sf_dir):
    r = read(spark, sf_dir, "region").withColumn("meta_version", F.when(F.col("r_regionkey") % 2 == 0, "v2.1").otherwise("v1.0"))
    return QL.restamp(r, "v2.1").select("r_name", "meta_version", "restamped")


@query("WITH v AS (SELECT c_nationkey, CASE WHEN c_custkey % 40 = 0 THEN '9' ELSE '10' END AS m FROM customer) SELECT c_nationkey, array_to_string(list_sort(list(DISTINCT m)), ',') AS majors FROM v GROUP BY 1 HAVING count(DISTINCT m) > 1")
def mixed_versions(spark, sf_dir):
    v = read(spark, sf_dir, "customer").select("c_nationkey", F.when(F.col("c_custkey") % 40 == 0, "9.1.0").otherwise("10.0.3").alias("meta_version"))
    return QL.mixed_majors(v, ["c_nationkey"]).withColumn("majors", F.array_join("majors", ","))


@query("SELECT s_suppkey, s_name, 'first' AS side FROM supplier WHERE s_suppkey % 10 = 3 UNION ALL SELECT s_suppkey, s_name || '!', 'second' FROM supplier WHERE s_suppkey % 10 = 3")
def baseline_diff(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return QL.structural_diff(s, s.withColumn("s_name", F.when(F.col("s_suppkey") % 10 == 3, F.concat("s_name", F.lit("!"))).otherwise(F.col("s_name"))))


@query()
def input_pins(spark, sf_dir):
    """Order-free hashes of the dimension tables: without SQL, since the hash is Spark's."""
    return QL.pin({t: read(spark, sf_dir, t) for t in ("region", "nation", "supplier")})


@query(f"WITH {ARTICLES}, o AS (SELECT 'src' || CAST(n_nationkey AS VARCHAR) AS outlet, 'L' || CAST(n_regionkey AS VARCHAR) AS lean, CASE WHEN n_nationkey % 2 = 0 THEN 'xx' END AS lang FROM nation) SELECT doc_id, coalesce(o.lang, a.lang, 'en') AS lang, lean FROM articles a LEFT JOIN o ON a.outlet = o.outlet")
def outlet_defaults(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    o = n.select(F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("outlet"), F.concat(F.lit("L"), F.col("n_regionkey").cast("string")).alias("lean"), F.when(F.col("n_nationkey") % 2 == 0, "xx").alias("lang"))
    return snapshots.with_defaults(articles(spark, sf_dir).select("doc_id", "outlet", "lang"), o).select("doc_id", "lang", "lean")


@query(f"WITH {FACTS}, d AS (SELECT DISTINCT day, story FROM facts), x AS (SELECT day, count(*) AS n_stories, array_to_string((list(story ORDER BY story))[1:3], ',') AS first_titles FROM d GROUP BY 1) SELECT *, day = (SELECT max(day) FROM d) AS latest FROM x")
def publication_index(spark, sf_dir):
    d = facts(spark, sf_dir).select("day", "story").distinct().withColumn("title", F.col("story"))
    return snapshots.index(d, "day", "story", "title").withColumn("first_titles", F.array_join("first_titles", ","))


@query("SELECT o_orderkey, 'C' || CAST(year(o_orderdate) AS VARCHAR) AS crawl FROM orders")
def crawl_by_date(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"))
    years = spark.range(1980, 2040).select(F.concat(F.lit("C"), F.col("id").cast("string")).alias("crawl"), F.make_date(F.col("id").cast("int"), F.lit(1), F.lit(1)).alias("from_day"), F.make_date(F.col("id").cast("int"), F.lit(12), F.lit(31)).alias("to_day"))
    return webarchive.crawl_for(o, "day", years).select("o_orderkey", "crawl")


@query("SELECT page_id, CASE WHEN page_id % 4 <> 3 THEN 'f' || CAST(page_id AS VARCHAR) END AS filename, CASE WHEN page_id % 4 <> 3 THEN 'bytes=' || CAST(page_id AS VARCHAR) || '-' || CAST(page_id + length(html) - 1 AS VARCHAR) END AS range FROM pages")
def capture_ranges(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    line = F.to_json(F.struct("url", F.when(F.col("page_id") % 4 == 3, "404").otherwise("200").alias("status"), F.concat(F.lit("f"), F.col("page_id").cast("string")).alias("filename"), F.col("page_id").cast("string").alias("offset"), F.length("html").cast("string").alias("length")))
    hit = webarchive.first_capture(F.concat(F.lit('{"status": "301"}\n'), line))
    return p.select("page_id", hit["filename"].alias("filename"), webarchive.byte_range(hit).alias("range"))


@query(f"WITH {ARTICLES} SELECT doc_id, array_to_string(list_filter(regexp_extract_all(lower(title), '[a-z]{{4,}}'), lambda w: w NOT IN ('that', 'with', 'this'))[1:5], ' ') AS q FROM articles")
def breadth_queries(spark, sf_dir):
    return articles(spark, sf_dir).select("doc_id", SL.breadth_query(F.col("title"), ("that", "with", "this")).alias("q"))


@query(r"SELECT regexp_extract(url, '^https?://(?:www\.|m\.|blog\.)?([^/?#]*)', 1) AS name, count(*) AS n, CAST(sum(CASE WHEN contains(url, 'utm_') THEN 1 ELSE 0 END) AS BIGINT) AS n_tracked, bool_or(contains(url, 'news.google.com')) AS google FROM pages GROUP BY 1")
def host_shares(spark, sf_dir):
    name = F.regexp_replace(urls.site(F.col("url")), r"^blog\.", "")
    return read(spark, sf_dir, "pages").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("url").contains("utm_")).alias("n_tracked"), F.bool_or(urls.is_google_news(F.col("url"))).alias("google"))


@query(f"WITH {FACTS}, p AS (SELECT DISTINCT story, bucket FROM facts) SELECT bucket, coalesce(r_name, 'other') AS region, count(*) AS n FROM p LEFT JOIN (SELECT 'b' || CAST(n_nationkey AS VARCHAR) AS bucket, r_name FROM nation JOIN region ON n_regionkey = r_regionkey) x USING (bucket) GROUP BY ALL")
def bucket_regions(spark, sf_dir):
    n, r = read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")
    m = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).select(F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("bucket"), "r_name")
    p = facts(spark, sf_dir).select("story", "bucket").distinct()
    return p.join(m, "bucket", "left").groupBy("bucket", F.coalesce("r_name", F.lit("other")).alias("region")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT item_id, text FROM benchmark ANTI JOIN (SELECT DISTINCT text FROM conversations) c USING (text)")
def pending_quotes(spark, sf_dir):
    """What a content-hash cache does not hold yet."""
    b, c = read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "conversations")
    return b.withColumn("h", F.sha2("text", 256)).join(c.select(F.sha2("text", 256).alias("h")), "h", "left_anti").select("item_id", "text")
