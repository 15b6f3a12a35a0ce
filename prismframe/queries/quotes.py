"""Quotes, frames, validation, publishing signals, dimensions."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import coverage as C
from ..operators import publish as P
from ..operators import quotes as Q
from ..operators.similarity import top_k
from .registry import ARTICLES, FACTS, QUOTES, articles, facts, query, quotes, read

_LONG = " UNION ALL ".join(f"SELECT '{lv}' AS level, CAST({lv} AS VARCHAR) AS key, '{d}' AS dim, {d} AS value, count(*) AS n FROM quotes GROUP BY ALL" for lv in ("outlet", "bucket") for d in ("speaker_type", "stance", "frame"))


@query(f"WITH {QUOTES} {_LONG}")
def quote_rollups(spark, sf_dir):
    return Q.rollups(quotes(spark, sf_dir), ["outlet", "bucket"], ["speaker_type", "stance", "frame"])


@query(f"WITH {QUOTES}, l AS ({_LONG}), r AS (SELECT *, row_number() OVER (PARTITION BY level, key, dim ORDER BY n DESC, value) AS rank FROM l) SELECT * FROM r WHERE rank <= 2")
def quote_top_values(spark, sf_dir):
    rolled = Q.rollups(quotes(spark, sf_dir), ["outlet", "bucket"], ["speaker_type", "stance", "frame"])
    return Q.top_values(rolled, 2).withColumn("rank", F.col("rank").cast("long"))


@query(f"WITH {QUOTES} SELECT speaker_type, frame, count(DISTINCT outlet) AS n_outlets, count(*) AS n FROM quotes GROUP BY ALL")
def speaker_reach(spark, sf_dir):
    return quotes(spark, sf_dir).groupBy("speaker_type", "frame").agg(F.count_distinct("outlet").alias("n_outlets"), F.count(F.lit(1)).alias("n"))


_DOM = f"""{QUOTES}, n AS (SELECT story, frame, count(*) AS n, min(idx) AS p FROM quotes WHERE speaker_type = 'assistant' GROUP BY ALL), best AS (SELECT story, frame FROM (SELECT *, row_number() OVER (PARTITION BY story ORDER BY n DESC, p, frame) AS r FROM n) WHERE r = 1),
ls AS (SELECT story, arg_min(frame, (idx, frame)) AS f FROM quotes GROUP BY 1), dom AS (SELECT story, coalesce(frame, f) AS frame FROM best FULL OUTER JOIN ls USING (story)), hl AS (SELECT story, arg_min(frame, (idx, frame)) AS headline_frame FROM quotes WHERE speaker_type = 'user' GROUP BY 1),
ag AS (SELECT story, dom.frame AS body_frame, headline_frame, dom.frame = headline_frame AS agrees FROM dom FULL OUTER JOIN hl USING (story))"""


def _agreement(spark, sf_dir):
    q = quotes(spark, sf_dir)
    body = Q.dominant(q.filter("speaker_type = 'assistant'"), "story", "frame", "idx", q.select("story", "frame", "idx"))
    head = q.filter("speaker_type = 'user'").groupBy("story").agg(F.min_by("frame", F.struct("idx", "frame")).alias("frame"))
    return Q.agreement(body, head, "story", "frame")


@query(f"WITH {_DOM} SELECT story, body_frame, headline_frame, agrees FROM ag")
def dominant_frames(spark, sf_dir):
    return _agreement(spark, sf_dir)


@query(f"WITH {_DOM} SELECT count(*) AS n, count(agrees) AS n_compared, round(avg(CASE WHEN agrees THEN 1.0 WHEN NOT agrees THEN 0.0 END), 6) AS agreement_rate FROM ag")
def agreement_rate(spark, sf_dir):
    a = _agreement(spark, sf_dir)
    return a.agg(F.count(F.lit(1)).alias("n"), F.count("agrees").alias("n_compared"), F.round(F.avg(F.col("agrees").cast("double")), 6).alias("agreement_rate"))


@query(f"""WITH {QUOTES}, c AS (SELECT story, idx + CASE WHEN idx % 5 = 4 THEN 100 ELSE 0 END AS idx, CASE idx % 3 WHEN 0 THEN '?' WHEN 1 THEN outlet ELSE 'o1' END AS outlet, CASE WHEN idx % 4 = 3 THEN 'invented words' ELSE substr(quote, 3, 20) END AS q FROM quotes WHERE quote IS NOT NULL),
j AS (SELECT c.story, c.idx, c.outlet, q, k.quote AS text, k.outlet AS own FROM c LEFT JOIN quotes k ON c.story = k.story AND c.idx = k.idx)
SELECT story, idx, CASE WHEN text IS NULL THEN 'out of range' WHEN outlet NOT IN ('', '?') AND outlet <> own THEN 'outlet differs' WHEN NOT contains(text, q) THEN 'not found verbatim' END AS error, CASE WHEN outlet IN ('', '?') THEN own ELSE outlet END AS outlet_filled FROM j""")
def citation_checks(spark, sf_dir):
    q = quotes(spark, sf_dir)
    i = F.col("idx")
    c = q.filter("quote IS NOT NULL").select("story", (i + F.when(i % 5 == 4, 100).otherwise(0)).alias("idx"), F.when(i % 3 == 0, "?").when(i % 3 == 1, F.col("outlet")).otherwise("o1").alias("outlet"), F.when(i % 4 == 3, "invented words").otherwise(F.substring("quote", 3, 20)).alias("q"))
    corpus = q.select("story", "idx", "outlet", F.col("quote").alias("text"))
    return Q.citation_errors(c, corpus, "idx", "q", "outlet", ["story"]).select("story", "idx", "error", "outlet_filled")


@query(f"""WITH {QUOTES} SELECT story, idx, array_to_string(list_filter([CASE WHEN NOT coalesce(speaker_type IN ('user', 'assistant'), false) THEN 'speaker_type' END, CASE WHEN NOT coalesce(length(quote) >= 20, false) THEN 'quote' END, CASE WHEN frame = 'f4' AND stance <> 'neutral' THEN 'stance' END], lambda e: e IS NOT NULL), ',') AS errors FROM quotes""")
def quote_rules(spark, sf_dir):
    rules = {"speaker_type": F.col("speaker_type").isin("user", "assistant"), "quote": F.length("quote") >= 20, "stance": ~((F.col("frame") == "f4") & (F.col("stance") != "neutral"))}
    return Q.rule_errors(quotes(spark, sf_dir), rules).select("story", "idx", F.array_join("errors", ",").alias("errors"))


@query("SELECT b.item_id, count(d.doc_id) AS n_documents, min(d.doc_id) AS first_document FROM benchmark b LEFT JOIN documents d ON contains(d.text, b.text) GROUP BY b.item_id")
def verbatim_grounding(spark, sf_dir):
    return Q.verbatim(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"), "item_id", "text", "doc_id", "text")


_CARRY = f"{FACTS}, ca AS (SELECT DISTINCT story AS frame, bucket FROM facts GROUP BY day, story, bucket HAVING sum(value) > 300), wt AS (SELECT 'b' || CAST(n_nationkey AS VARCHAR) AS bucket, 1.0 + n_regionkey AS weight FROM nation)"


def _carriers(spark, sf_dir):
    """A bucket carries a frame with a day of more than 300 on it."""
    c = facts(spark, sf_dir).groupBy("day", F.col("story").alias("frame"), "bucket").agg(F.sum("value").alias("v")).filter("v > 300").select("frame", "bucket")
    w = read(spark, sf_dir, "nation").select(F.concat(F.lit("b"), F.col("n_nationkey").cast("string")).alias("bucket"), (F.col("n_regionkey") + 1.0).alias("weight"))
    return c, w


@query(f"WITH {_CARRY}, e AS (SELECT frame, ca.bucket, coalesce(weight, 1.0) AS w FROM ca LEFT JOIN wt USING (bucket)), t AS (SELECT sum(w) AS w, count(*) AS n FROM (SELECT DISTINCT bucket, w FROM e)) SELECT frame, round(sum(e.w) / max(t.w), 6) AS weighted_share, round(count(*) / max(t.n), 6) AS share FROM e, t GROUP BY frame")
def weighted_frame_share(spark, sf_dir):
    return C.weighted_share(*_carriers(spark, sf_dir)).select("frame", F.round("weighted_share", 6).alias("weighted_share"), F.round("share", 6).alias("share"))


@query()
def frame_share_intervals(spark, sf_dir):
    """Bootstrap over buckets with a fixed seed: without SQL."""
    return C.bootstrap_shares(*_carriers(spark, sf_dir))


@query(f"WITH {FACTS}, c AS (SELECT story, bucket, min(event_id) AS e FROM facts GROUP BY ALL) SELECT story, " + ", ".join(f"max(CASE WHEN bucket = 'b{i}' THEN e END) AS b{i}" for i in range(12)) + " FROM c GROUP BY story")
def frame_bucket_carry(spark, sf_dir):
    return facts(spark, sf_dir).groupBy("story").pivot("bucket", [f"b{i}" for i in range(12)]).agg(F.min("event_id"))


_SIGNALS = f"""{FACTS}, sg AS (SELECT day, story AS key, count(DISTINCT bucket) AS n_buckets, CAST(count(*) AS DOUBLE) AS max_llr, 12 - count(DISTINCT bucket) AS n_silent, max(value) / 40 AS max_z, count(DISTINCT feed) AS n_speakers, CAST(3 AS BIGINT) AS n_types, CAST(2 AS BIGINT) AS n_outlets, (event_id_max % 70) AS joint_len, (event_id_max % 9) / 20.0 AS max_delta_7d
 FROM (SELECT *, max(event_id) OVER (PARTITION BY day, story) AS event_id_max FROM facts) GROUP BY day, story, event_id_max)"""
_KIND = "CASE WHEN joint_len >= 60 THEN 'joint' WHEN abs(max_delta_7d) >= 0.20 THEN 'shift' WHEN n_silent >= 3 THEN 'silence' WHEN max_z >= 4 THEN 'tilt' WHEN n_speakers >= 5 AND n_types >= 3 AND n_outlets >= 2 THEN 'sources' WHEN max_llr >= 20 THEN 'word' ELSE 'fallback' END"


def _signals(spark, sf_dir):
    g = facts(spark, sf_dir).groupBy("day", F.col("story").alias("key")).agg(
        F.count_distinct("bucket").alias("n_buckets"), F.count(F.lit(1)).cast("double").alias("max_llr"), (F.max("value") / 40).alias("max_z"), F.count_distinct("feed").alias("n_speakers"), F.max("event_id").alias("m")
    )
    return g.select("day", "key", "n_buckets", "max_llr", (12 - F.col("n_buckets")).alias("n_silent"), "max_z", "n_speakers", F.lit(3).alias("n_types"), F.lit(2).alias("n_outlets"), (F.col("m") % 70).alias("joint_len"), (F.col("m") % 9 / 20.0).alias("max_delta_7d"))


@query(f"WITH {_SIGNALS} SELECT day, key, {_KIND} AS kind FROM sg")
def card_cascade(spark, sf_dir):
    return _signals(spark, sf_dir).select("day", "key", P.standard_cascade().alias("kind"))


_STRENGTH = "CASE kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in P.STRENGTH.items()) + " ELSE 0 END"


@query(f"""WITH {_SIGNALS}, k AS (SELECT day, key, n_buckets, {_KIND} AS kind FROM sg), rc AS (SELECT day, kind, key FROM k WHERE key = 'view'),
s AS (SELECT k.*, coalesce((SELECT max(CASE WHEN rc.kind = k.kind THEN 1 ELSE 0 END) FROM rc WHERE rc.day < k.day AND rc.day >= k.day - 5), 0) AS a, coalesce((SELECT max(CASE WHEN rc.key = k.key THEN 1 ELSE 0 END) FROM rc WHERE rc.day < k.day AND rc.day >= k.day - 5), 0) AS b FROM k WHERE n_buckets >= 8),
x AS (SELECT day, key, n_buckets, kind, round((n_buckets / 54 * 0.30 + {_STRENGTH}) * greatest(0, 1 - 0.3 * a - 0.5 * b), 6) AS score FROM s) SELECT day, key, n_buckets, kind, score FROM (SELECT *, row_number() OVER (PARTITION BY day ORDER BY score DESC, key) AS r FROM x) WHERE r = 1""")
def hero_pick(spark, sf_dir):
    k = _signals(spark, sf_dir).select("day", "key", "n_buckets", P.standard_cascade().alias("kind"))
    return P.hero(k, k.filter("key = 'view'").select("day", "kind", "key"), "day")


@query(f"WITH {QUOTES}, s AS (SELECT story, max(length(quote)) AS m, count(*) AS n, count(DISTINCT frame) AS f FROM quotes GROUP BY 1) SELECT story, CASE WHEN m > 350 THEN 'paradox' WHEN f / n < 0.30 THEN 'isolation' WHEN n > 4 THEN 'exclusive' ELSE 'generic' END AS hook FROM s")
def thread_hooks(spark, sf_dir):
    s = quotes(spark, sf_dir).groupBy("story").agg(F.max(F.length("quote")).alias("m"), F.count(F.lit(1)).alias("n"), F.count_distinct("frame").alias("f"))
    return s.select("story", P.hook(F.col("m") > 350, F.col("f") / F.col("n"), F.col("n") > 4).alias("hook"))


@query("""WITH j AS (SELECT a.vec_id, a.label = b.label AS same, list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) / (sqrt(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))) * sqrt(list_inner_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])))) AS c FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 10)
SELECT count(*) AS n, round(avg(CASE WHEN same THEN 1.0 ELSE 0.0 END), 6) AS match_rate, round(avg(c), 6) AS mean_cosine, avg(CASE WHEN same THEN 1.0 ELSE 0.0 END) < 0.75 OR avg(c) < 0.92 AS drifted FROM j""")
def canary_drift(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    d = P.drift(e, e.withColumn("vec_id", F.col("vec_id") - 10), "vec_id", "label", "embedding")
    return d.select("n", F.round("match_rate", 6).alias("match_rate"), F.round("mean_cosine", 6).alias("mean_cosine"), "drifted")


@query("SELECT r_name, n_name, count(c_custkey) AS n_outlets, round(coalesce(sum(c_acctbal), 0), 2) AS reach FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY ALL")
def outlet_dimension(spark, sf_dir):
    """Dimensions join by whatever Catalyst picks from their sizes."""
    n, r, c = (read(spark, sf_dir, t) for t in ("nation", "region", "customer"))
    j = n.join(r, F.col("n_regionkey") == F.col("r_regionkey")).join(c, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return j.groupBy("r_name", "n_name").agg(F.count("c_custkey").alias("n_outlets"), F.round(F.coalesce(F.sum(F.col("c_acctbal").cast("decimal(18,2)")), F.lit(0)).cast("double"), 2).alias("reach"))


@query("SELECT d.source, count(*) AS n, count(l.doc_id) AS n_rated FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE NOT EXISTS (SELECT 1 FROM labels x WHERE x.doc_id = d.doc_id AND x.quality = 0) GROUP BY d.source")
def tier_exclusion(spark, sf_dir):
    d, t = read(spark, sf_dir, "documents").select("doc_id", "source"), read(spark, sf_dir, "labels")
    kept = d.join(t.filter("quality = 0"), "doc_id", "left_anti").join(t.select("doc_id", F.lit(1).alias("rated")), "doc_id", "left")
    return kept.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.count("rated").alias("n_rated"))


@query(f"WITH {ARTICLES}, c AS (SELECT outlet, lang, count(*) AS n FROM articles GROUP BY ALL) SELECT outlet, lang, n FROM (SELECT *, row_number() OVER (PARTITION BY outlet ORDER BY n DESC, lang) AS r FROM c) WHERE r = 1")
def dominant_language(spark, sf_dir):
    c = articles(spark, sf_dir).groupBy("outlet", "lang").agg(F.count(F.lit(1)).alias("n"))
    return top_k(c, ["outlet"], [F.desc("n"), F.col("lang")], 1).drop("rank")


@query("WITH o AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS p, o_totalprice FROM orders) SELECT month, p AS priority, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM o GROUP BY ROLLUP (month, p)")
def monthly_rollup(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.trunc("o_orderdate", "month").alias("month"), F.col("o_orderpriority").alias("priority"), F.col("o_totalprice").cast("decimal(18,2)").alias("v"))
    return o.rollup("month", "priority").agg(F.count(F.lit(1)).alias("n"), F.sum("v").cast("double").alias("total"))


@query("SELECT n_name, p_brand, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue, count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey WHERE l_shipdate >= TIMESTAMP '1995-01-01' AND l_quantity > 10 GROUP BY ALL")
def star_join(spark, sf_dir):
    """Story signals meet as a star: facts filtered at the scan, dimensions joined by size, one partial aggregation."""
    li = read(spark, sf_dir, "lineitem").filter((F.col("l_shipdate") >= F.lit("1995-01-01").cast("timestamp_ntz")) & (F.col("l_quantity") > 10))
    s, n, p = (read(spark, sf_dir, t) for t in ("supplier", "nation", "part"))
    j = li.join(s, F.col("l_suppkey") == F.col("s_suppkey")).join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(p, F.col("l_partkey") == F.col("p_partkey"))
    return j.groupBy("n_name", "p_brand").agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("revenue"), F.count(F.lit(1)).alias("n"))


@query(f"WITH {FACTS}, d AS (SELECT bucket, day, count(*) AS n FROM facts GROUP BY ALL), a AS (SELECT bucket, day, n, avg(n) OVER (PARTITION BY bucket ORDER BY day RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS m FROM d) SELECT bucket, day FROM a WHERE n < 28 AND m >= 2 ORDER BY bucket")
def coverage_warnings(spark, sf_dir):
    from ..operators.series import trailing_mean

    d = facts(spark, sf_dir).groupBy("bucket", "day").agg(F.count(F.lit(1)).alias("n"))
    return trailing_mean(d, ["bucket"], "day", "n").filter((F.col("n") < 28) & (F.col("trailing_mean") >= 2)).select("bucket", "day")


@query(f"WITH {QUOTES} SELECT story, idx, coalesce(CASE WHEN length(quote) <= 60 THEN quote ELSE rtrim(left(quote, 59)) || '…' END, '') AS short FROM quotes")
def quote_excerpts(spark, sf_dir):
    return quotes(spark, sf_dir).select("story", "idx", F.coalesce(X.truncate(F.col("quote"), 60), F.lit("")).alias("short"))


@query("WITH d AS (SELECT doc_id, lag(doc_id) OVER (ORDER BY doc_id) AS p FROM documents) SELECT source, lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY CUBE (source, lang)")
def source_language_cube(spark, sf_dir):
    return read(spark, sf_dir, "documents").cube("source", "lang").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {ARTICLES}, w AS (SELECT outlet, doc_id, length(body) AS n FROM articles WHERE lower(body) LIKE '%the%'), r AS (SELECT *, row_number() OVER (PARTITION BY outlet ORDER BY n DESC, doc_id) AS rank FROM w) SELECT outlet, doc_id, n AS n_chars, rank FROM r WHERE rank <= 3""")
def longest_matching(spark, sf_dir):
    a = articles(spark, sf_dir).filter(F.lower("body").contains("the")).select("outlet", "doc_id", F.length("body").cast("long").alias("n_chars"))
    return top_k(a, ["outlet"], [F.desc("n_chars"), F.col("doc_id")], 3).select("outlet", "doc_id", "n_chars", F.col("rank").cast("long").alias("rank"))


@query(f"WITH {FACTS}, t AS (SELECT bucket, story, count(*) AS n FROM facts GROUP BY ALL), b AS (SELECT *, row_number() OVER (PARTITION BY story ORDER BY n DESC, bucket) AS r FROM t) SELECT story, bucket AS outlier, n FROM b WHERE r = 1")
def outlier_bucket(spark, sf_dir):
    t = facts(spark, sf_dir).groupBy("bucket", "story").agg(F.count(F.lit(1)).alias("n"))
    return t.withColumn("r", F.row_number().over(W.partitionBy("story").orderBy(F.desc("n"), "bucket"))).filter("r = 1").select("story", F.col("bucket").alias("outlier"), "n")
