"""Vectors, clusters, stories."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import similarity as S
from ..operators import stories as ST
from .registry import ARTICLES, FACTS, articles, facts, query, read, title_tokens_sql

_DOT = "list_inner_product(CAST({a} AS DOUBLE[]), CAST({b} AS DOUBLE[]))"
_LONG = "long AS (SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS m, sum(CAST(embedding[i] AS DOUBLE)) AS s, count(*) AS n FROM embeddings, range(1, 65) r(i) GROUP BY label, i)"


def _vectors(spark, sf_dir):
    return read(spark, sf_dir, "embeddings")


@query(f"WITH {_LONG} SELECT label, max(n) AS n, round(sqrt(sum(m * m)), 6) AS norm, round(sum(m), 6) AS total FROM long GROUP BY label")
def centroids(spark, sf_dir):
    c = S.centroids(_vectors(spark, sf_dir), ["label"], "embedding")
    return c.select("label", "n", F.round(V.norm(F.col("centroid")), 6).alias("norm"), F.round(F.aggregate("centroid", F.lit(0.0), lambda a, x: a + x), 6).alias("total"))


_PAIRS = f"{_LONG}, p AS (SELECT a.label AS a, b.label AS b, sum(a.m * b.m) / (sqrt(sum(a.m * a.m)) * sqrt(sum(b.m * b.m))) AS sim FROM long a JOIN long b ON a.i = b.i AND a.label < b.label GROUP BY ALL)"


@query(f"WITH {_PAIRS} SELECT a, b, round(sim, 6) AS similarity FROM p")
def bucket_similarity(spark, sf_dir):
    c = S.centroids(_vectors(spark, sf_dir), ["label"], "embedding")
    return S.pairs(c, "label").select("a", "b", F.round("similarity", 6).alias("similarity"))


@query(f"WITH {_PAIRS}, e AS (SELECT a AS label, sim FROM p UNION ALL SELECT b, sim FROM p) SELECT label, round(avg(sim), 6) AS isolation FROM e GROUP BY label")
def bucket_isolation(spark, sf_dir):
    c = S.centroids(_vectors(spark, sf_dir), ["label"], "embedding")
    return S.isolation(c, "label", "centroid").select("label", F.round("isolation", 6).alias("isolation"))


@query(f"WITH {_PAIRS}, r AS (SELECT a, b, round(sim, 6) AS similarity FROM p), x AS (SELECT *, 'most' AS side, row_number() OVER (ORDER BY similarity DESC, a, b) AS rank FROM r UNION ALL SELECT *, 'least', row_number() OVER (ORDER BY similarity, a, b) FROM r) SELECT side, rank, a, b, similarity FROM x WHERE rank <= 10")
def extreme_pairs(spark, sf_dir):
    p = S.pairs(S.centroids(_vectors(spark, sf_dir), ["label"], "embedding"), "label").select("a", "b", F.round("similarity", 6).alias("similarity"))
    sides = p.withColumn("side", F.explode(F.array(F.lit("most"), F.lit("least"))))
    order = F.when(F.col("side") == "most", -F.col("similarity")).otherwise(F.col("similarity"))
    return S.top_k(sides, ["side"], [order, F.col("a"), F.col("b")], 10).select("side", F.col("rank").cast("long").alias("rank"), "a", "b", "similarity")


@query(f"WITH {_LONG} SELECT label, max(n) AS n, round(sum(s * s) / (max(n) * max(n)), 6) AS mean_similarity FROM long GROUP BY label")
def cluster_convergence(spark, sf_dir):
    return S.convergence(_vectors(spark, sf_dir), ["label"], "embedding").select("label", "n", F.round("mean_similarity", 6).alias("mean_similarity"))


@query(f"""WITH n AS (SELECT a.vec_id AS a, count(*) AS n FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND 1 - {_DOT.format(a='a.embedding', b='b.embedding')} <= 0.62 GROUP BY 1)
SELECT a AS vec_id, n FROM n""")
def epsilon_graph(spark, sf_dir):
    return S.neighbour_counts(_vectors(spark, sf_dir), "vec_id", "embedding", 0.62).withColumnRenamed("id", "vec_id")


@query(f"""WITH RECURSIVE e AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id AND 1 - {_DOT.format(a='a.embedding', b='b.embedding')} <= 0.62),
c AS MATERIALIZED (SELECT a AS id FROM e GROUP BY 1 HAVING count(*) >= 2), i AS MATERIALIZED (SELECT a, b FROM e SEMI JOIN c ON e.a = c.id WHERE b IN (SELECT id FROM c)),
w AS (SELECT id AS root, id FROM c UNION SELECT w.root, i.b FROM w JOIN i ON w.id = i.a), r AS (SELECT id, min(root) AS root FROM w GROUP BY 1),
b AS (SELECT e.a AS id, min(r.root) AS root FROM e JOIN r ON e.b = r.id WHERE e.a NOT IN (SELECT id FROM c) GROUP BY 1), f AS (SELECT * FROM r UNION ALL SELECT * FROM b)
SELECT vec_id AS id, coalesce(root, -1) AS cluster FROM embeddings LEFT JOIN f ON vec_id = id""")
def dbscan(spark, sf_dir):
    return S.dbscan(_vectors(spark, sf_dir), "vec_id", "embedding", eps=0.62)


@query(f"""WITH {_LONG}, g AS (SELECT label AS g, max(n) AS n, list(s ORDER BY i) AS s FROM long GROUP BY label),
m AS (SELECT vec_id, label, label = g AS own, CASE WHEN label = g THEN CASE WHEN n > 1 THEN 1 - ({_DOT.format(a='embedding', b='s')} - {_DOT.format(a='embedding', b='embedding')}) / (n - 1) END ELSE 1 - {_DOT.format(a='embedding', b='s')} / n END AS m FROM embeddings CROSS JOIN g),
x AS (SELECT vec_id, label, max(CASE WHEN own THEN m END) AS a, min(CASE WHEN NOT own THEN m END) AS b FROM m GROUP BY ALL)
SELECT label, count(*) AS n, round(avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM x GROUP BY label""")
def silhouette(spark, sf_dir):
    s = S.silhouette(_vectors(spark, sf_dir), "vec_id", "embedding", "label")
    return s.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


@query("""WITH t AS (SELECT label AS a, vec_id % 7 AS b, count(*) AS n FROM embeddings GROUP BY ALL), r AS (SELECT sum(n * (n - 1) / 2) AS p FROM (SELECT sum(n) AS n FROM t GROUP BY a)), c AS (SELECT sum(n * (n - 1) / 2) AS p FROM (SELECT sum(n) AS n FROM t GROUP BY b)),
j AS (SELECT sum(n * (n - 1) / 2) AS p, sum(n) * (sum(n) - 1) / 2 AS al FROM t) SELECT round((r.p + c.p - 2 * j.p) / j.al, 6) AS disagreement FROM r, c, j""")
def labeling_disagreement(spark, sf_dir):
    v = _vectors(spark, sf_dir).select("label", (F.col("vec_id") % 7).alias("other"))
    return S.pair_disagreement(v, "label", "other").select(F.round("disagreement", 6).alias("disagreement"))


@query()
def hdbscan(spark, sf_dir):
    """Density clusters without a radius, per label group as a day would be."""
    from ..operators.hdbscan import hdbscan as run

    return run(_vectors(spark, sf_dir).withColumn("day", F.lit(0)), ["day"], "vec_id", "embedding", 3)


@query(f"""WITH {ARTICLES}, m AS (SELECT story, count(*) AS n_articles, count(DISTINCT country) AS n_countries, count(DISTINCT outlet) AS n_outlets, count(DISTINCT lang) AS n_langs FROM articles GROUP BY 1), t AS (SELECT count(DISTINCT country) AS c FROM articles),
s AS (SELECT *, round(n_articles * least(1.0, n_countries / c) * CASE WHEN n_langs >= 2 THEN 1.5 ELSE 1 END, 3) AS salience FROM m, t) SELECT story, n_articles, n_countries, n_langs, salience FROM s WHERE n_outlets >= 3 ORDER BY salience DESC, story LIMIT 15""")
def story_salience(spark, sf_dir):
    a = articles(spark, sf_dir)
    m = a.groupBy(F.col("story").alias("cluster_id")).agg(F.count(F.lit(1)).alias("n_articles"), F.count_distinct("country").alias("n_countries"), F.count_distinct("outlet").alias("n_outlets"), F.count_distinct("lang").alias("n_langs"))
    total = a.agg(F.count_distinct("country").alias("all_countries"))
    ready = m.filter("n_outlets >= 3").crossJoin(total).withColumn("stability", F.lit(None).cast("double"))
    return ST.salience(ready, F.col("all_countries")).select(F.col("cluster_id").alias("story"), "n_articles", "n_countries", "n_langs", "salience")


@query(f"""WITH {ARTICLES}, c AS (SELECT story, lang, count(*) AS n FROM articles GROUP BY ALL) SELECT story, array_to_string(list(lang || '=' || CAST(n AS VARCHAR) ORDER BY lang), ',') AS langs FROM c GROUP BY story""")
def story_distributions(spark, sf_dir):
    d = S.distribution(articles(spark, sf_dir), "story", "lang")
    return d.select("story", F.array_join(F.transform(F.map_entries("lang_distribution"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("langs"))


@query(f"""WITH {ARTICLES}, t AS (SELECT story, unnest({title_tokens_sql('title')}) AS term FROM articles), c AS (SELECT story, term, count(*) AS n FROM t GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY story ORDER BY n DESC, term) AS rank FROM c) SELECT story, term, n, rank FROM r WHERE rank <= 10""")
def story_top_words(spark, sf_dir):
    from ..functions.text import title_tokens

    t = articles(spark, sf_dir).select("story", F.explode(title_tokens(F.col("title"))).alias("term")).groupBy("story", "term").agg(F.count(F.lit(1)).alias("n"))
    return S.top_k(t, ["story"], [F.desc("n"), F.col("term")], 10).select("story", "term", "n", F.col("rank").cast("long").alias("rank"))


_MEMBERS = f"{FACTS}, members AS (SELECT DISTINCT day, story || '-' || CAST(feed % 7 AS VARCHAR) AS cluster_id, feed AS article_id FROM facts)"


def _members(spark, sf_dir):
    return facts(spark, sf_dir).select("day", F.concat("story", F.lit("-"), (F.col("feed") % 7).cast("string")).alias("cluster_id"), F.col("feed").alias("article_id")).distinct()


_LINKS = f"""{_MEMBERS}, d AS (SELECT day, lag(day) OVER (ORDER BY day) AS prev_day FROM (SELECT DISTINCT day FROM members)), s AS (SELECT day, cluster_id, count(*) AS n FROM members GROUP BY ALL),
j AS (SELECT a.day, a.cluster_id, b.day AS prev_day, b.cluster_id AS prev_cluster, count(*) AS k FROM members a JOIN d USING (day) JOIN members b ON b.day = d.prev_day AND a.article_id = b.article_id GROUP BY ALL),
x AS (SELECT j.*, k / (s.n + p.n - k) AS jaccard FROM j JOIN s ON j.day = s.day AND j.cluster_id = s.cluster_id JOIN s p ON j.prev_day = p.day AND j.prev_cluster = p.cluster_id),
l AS (SELECT *, row_number() OVER (PARTITION BY day, cluster_id ORDER BY jaccard DESC, prev_cluster) AS r FROM x WHERE jaccard >= 0.3)"""


@query(f"WITH {_LINKS} SELECT day, cluster_id, prev_day, prev_cluster, round(jaccard, 6) AS jaccard FROM l WHERE r = 1")
def predecessor_links(spark, sf_dir):
    return ST.predecessor_links(_members(spark, sf_dir)).withColumn("jaccard", F.round("jaccard", 6))


@query(f"""WITH RECURSIVE {_LINKS.replace('members AS', 'members AS MATERIALIZED', 1)}, lk AS MATERIALIZED (SELECT * FROM l WHERE r = 1), w AS (SELECT day, cluster_id, day AS root_day, cluster_id AS root_cluster FROM members m WHERE NOT EXISTS (SELECT 1 FROM lk WHERE lk.day = m.day AND lk.cluster_id = m.cluster_id)
 UNION SELECT lk.day, lk.cluster_id, w.root_day, w.root_cluster FROM w JOIN lk ON lk.prev_day = w.day AND lk.prev_cluster = w.cluster_id), n AS (SELECT *, count(*) OVER (PARTITION BY root_day, root_cluster) AS n FROM w) SELECT day, cluster_id, root_day, root_cluster FROM n WHERE n > 1""")
def lineages(spark, sf_dir):
    return ST.lineages(_members(spark, sf_dir), window=32)


@query()
def briefing_novelty(spark, sf_dir):
    """Greedy, so without SQL: at most two new titles per story and outlet."""
    from ..functions.text import signal_text, title_tokens

    s = signal_text(F.col("body"), F.col("summary"), F.col("title"))
    a = articles(spark, sf_dir).select("doc_id", "story", "outlet", title_tokens(F.col("title")).alias("w"), s["level"].alias("level"), F.length(s["text"]).alias("n"))
    return ST.novel_articles(a, ["story", "outlet"], "w", "level", "n", "doc_id")


@query(f"""WITH {ARTICLES}, p AS (SELECT DISTINCT story || CAST(day AS VARCHAR) AS story, country FROM articles), n AS (SELECT country, count(*) AS n FROM p GROUP BY 1) SELECT x.country AS a, y.country AS b, count(*) AS "both", round(count(*) / (max(na.n) + max(nb.n) - count(*)), 6) AS jaccard
FROM p x JOIN p y ON x.story = y.story AND x.country < y.country JOIN n na ON na.country = x.country JOIN n nb ON nb.country = y.country GROUP BY ALL""")
def country_co_presence(spark, sf_dir):
    p = articles(spark, sf_dir).withColumn("story", F.concat("story", F.col("day").cast("string")))
    return ST.co_presence(p, "story", "country").withColumn("jaccard", F.round("jaccard", 6))


@query(f"""WITH {FACTS}, p AS (SELECT DISTINCT day || story AS story, bucket FROM facts), n AS (SELECT story FROM p GROUP BY 1 HAVING count(*) >= 8), g AS (SELECT n.story, b.bucket FROM n CROSS JOIN (SELECT DISTINCT bucket FROM p) b) SELECT bucket, story FROM g ANTI JOIN p USING (story, bucket)""")
def silence_audit(spark, sf_dir):
    p = facts(spark, sf_dir).select(F.concat(F.col("day").cast("string"), "story").alias("story"), "bucket")
    return ST.coverage_absence(p, "story", "bucket", 8)


@query(f"""WITH {FACTS}, s AS (SELECT date_trunc('hour', ts) AS hour, story, list_sort(list(DISTINCT bucket)) AS who FROM facts GROUP BY ALL) SELECT CAST(hour AS TIMESTAMP) AS hour, story, CAST(len(who) AS BIGINT) AS n, list_has_all(who, ['b1', 'b2']) AS consensus, list_has_all(['b1', 'b2', 'b3', 'b4'], who) AS exclusive,
CAST(len(list_filter(['b1', 'b2', 'b3'], lambda b: NOT list_contains(who, b))) AS BIGINT) AS n_missing FROM s""")
def consensus_sets(spark, sf_dir):
    s = facts(spark, sf_dir).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour"), "story").agg(F.collect_set("bucket").alias("who"))
    def every(of, within):
        return F.size(F.array_except(of, within)) == 0
    pair, four, three = (F.array(*[F.lit(f"b{i}") for i in range(1, k)]) for k in (3, 5, 4))
    return s.select("hour", "story", F.size("who").cast("long").alias("n"), every(pair, F.col("who")).alias("consensus"), every(F.col("who"), four).alias("exclusive"), F.size(F.array_except(three, "who")).cast("long").alias("n_missing"))


@query(f"""WITH {ARTICLES}, p AS (SELECT country, story, count(*) AS n FROM articles GROUP BY ALL), x AS (SELECT *, row_number() OVER (PARTITION BY left(story, 2) ORDER BY n DESC, country, story) AS r FROM p) SELECT country, story, n FROM x WHERE r = 1""")
def widest_without_repeats(spark, sf_dir):
    p = articles(spark, sf_dir).groupBy("country", "story").agg(F.count(F.lit(1)).alias("n"))
    return p.withColumn("r", F.row_number().over(W.partitionBy(F.left("story", F.lit(2))).orderBy(F.desc("n"), "country", "story"))).filter("r = 1").drop("r")


@query("""WITH p AS (SELECT a.label AS a, b.label AS b, avg(list_inner_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS s FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id GROUP BY ALL), o AS (SELECT least(a, b) AS a, greatest(a, b) AS b, s FROM p WHERE a = b),
l AS (SELECT label, i, sum(CAST(embedding[i] AS DOUBLE)) AS s, count(*) AS n FROM embeddings, range(1, 65) r(i) GROUP BY ALL), c AS (SELECT x.label AS a, y.label AS b, sum(x.s * y.s) / (max(x.n) * max(y.n)) AS cross_mean FROM l x JOIN l y ON x.i = y.i AND x.label <> y.label GROUP BY ALL),
best AS (SELECT a, b, cross_mean, row_number() OVER (PARTITION BY a ORDER BY round(cross_mean, 9) DESC, b) AS r FROM c) SELECT best.a AS label, best.b AS nearest, round(cross_mean, 6) AS cross_mean, round(o.s, 6) AS intra_mean, cross_mean - o.s > 0.15 AS defects FROM best JOIN o ON best.a = o.a WHERE r = 1""")
def defectors(spark, sf_dir):
    """Mean similarity within and across groups from group sums: sum_a . sum_b / (n_a n_b), no pairs of rows."""
    long = _vectors(spark, sf_dir).select("label", F.posexplode("embedding").alias("i", "x")).groupBy("label", "i").agg(F.sum(F.col("x").cast("double")).alias("s"), F.sum(F.col("x").cast("double") * F.col("x").cast("double")).alias("q"), F.count(F.lit(1)).alias("n"))
    intra = long.groupBy("label").agg(((F.sum(F.col("s") * F.col("s")) - F.sum("q")) / (F.max("n") * (F.max("n") - 1))).alias("intra"))
    b = long.select(F.col("label").alias("b"), "i", F.col("s").alias("sb"), F.col("n").alias("nb"))
    cross = long.join(b, "i").filter("label <> b").groupBy("label", "b").agg((F.sum(F.col("s") * F.col("sb")) / (F.max("n") * F.max("nb"))).alias("cross_mean"))
    best = cross.withColumn("r", F.row_number().over(W.partitionBy("label").orderBy(F.desc(F.round("cross_mean", 9)), "b"))).filter("r = 1")
    return best.join(intra, "label").select("label", F.col("b").alias("nearest"), F.round("cross_mean", 6).alias("cross_mean"), F.round("intra", 6).alias("intra_mean"), (F.col("cross_mean") - F.col("intra") > 0.15).alias("defects"))
