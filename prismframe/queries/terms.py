"""Term statistics over documents."""

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.stats import p_of_z
from ..operators import terms as T
from ..plans.session import shared_checkpoint
from .registry import ARTICLES, LOG_ODDS, Z, articles, bigrams_sql, g2_sql, query, tokens_sql

_WORDS = f"words AS (SELECT doc_id, outlet AS bucket, lang, country, section, day, {tokens_sql('body')} AS w FROM articles)"
_NEWS = "WHERE section <> 'opinion'"
_COHORT = """cohort AS (SELECT bucket, lang, term, n AS a, CAST(sum(n) OVER (PARTITION BY lang, term) AS BIGINT) - n AS b, CAST(sum(n) OVER (PARTITION BY bucket, lang) AS BIGINT) AS total_a,
 greatest(CAST(sum(n) OVER (PARTITION BY lang) AS BIGINT) - CAST(sum(n) OVER (PARTITION BY bucket, lang) AS BIGINT), 1) AS total_b FROM counts)"""


def _rows(spark, sf_dir):
    """A row per word of the news articles."""
    a = articles(spark, sf_dir).filter("section <> 'opinion'")
    return X.token_rows(a.withColumn("bucket", F.col("outlet")), ["bucket", "lang"], F.col("body"))


def _words(spark, sf_dir):
    return articles(spark, sf_dir).filter("section <> 'opinion'").select(F.col("outlet").alias("bucket"), "lang", "country", "day", X.tokens(F.col("body")).alias("w"))


@query(f"""WITH {ARTICLES}, {_WORDS}, counts AS (SELECT bucket, lang, term, count(*) AS n FROM (SELECT bucket, lang, unnest(w) AS term FROM words {_NEWS}) GROUP BY ALL), {_COHORT},
g AS (SELECT *, round({g2_sql()}, 6) AS g2 FROM cohort WHERE a >= 5 AND a * total_b > b * total_a),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket, lang ORDER BY g2 DESC, term) AS rank FROM g WHERE g2 >= 10.827566170662733)
SELECT bucket, lang, term, a, b, g2, CASE WHEN b > 0 THEN round(log2((a / total_a) / (b / total_b)), 6) END AS log_ratio, rank FROM r WHERE rank <= 20""")
def within_language_llr(spark, sf_dir):
    found = T.count_rows(_rows(spark, sf_dir), ["bucket", "lang"])
    return T.log_likelihood(T.against_cohort(found), ["bucket", "lang"]).select("bucket", "lang", "term", "a", "b", "g2", "log_ratio", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {ARTICLES}, {_WORDS}, counts AS (SELECT bucket, lang, term, count(*) AS n FROM (SELECT bucket, lang, unnest({bigrams_sql('w')}) AS term FROM words {_NEWS}) GROUP BY ALL), {_COHORT},
g AS (SELECT *, round({LOG_ODDS}, 6) AS log_odds, round({Z}, 6) AS z FROM cohort WHERE a >= 2),
r AS (SELECT *, row_number() OVER (PARTITION BY bucket, lang ORDER BY z DESC, term) AS rank FROM g WHERE z >= 1.96)
SELECT bucket, lang, term, a, b, log_odds, z, rank FROM r WHERE rank <= 25""")
def within_language_bigrams(spark, sf_dir):
    found = T.counts(_words(spark, sf_dir), ["bucket", "lang"], X.bigrams(F.col("w")), together=["lang", "term"])
    return T.log_odds_terms(T.against_cohort(found, least=2), ["bucket", "lang"]).select("bucket", "lang", "term", "a", "b", "log_odds", "z", F.col("rank").cast("long").alias("rank"))


_NAMES = ("Therland", "north Eauria")
_CLEAN = """len(list_filter(string_split(term, ' '), lambda w: length(w) >= 4 AND len(list_filter(['therland', 'eauria'], lambda p: starts_with(p, left(w, 4)) OR starts_with(w, left(p, 4)))) > 0)) = 0"""


@query(f"""WITH {ARTICLES}, {_WORDS}, gc AS (SELECT bucket, lang, term, count(*) AS n FROM (SELECT bucket, lang, unnest({bigrams_sql('w')}) AS term FROM words {_NEWS}) GROUP BY ALL), wc AS (SELECT bucket, lang, term, count(*) AS n FROM (SELECT bucket, lang, unnest(w) AS term FROM words {_NEWS}) GROUP BY ALL),
{_COHORT.replace('cohort AS', 'gt AS').replace('FROM counts', 'FROM gc')}, {_COHORT.replace('cohort AS', 'wt AS').replace('FROM counts', 'FROM wc')},
g AS (SELECT bucket, term, round({Z}, 6) AS score FROM gt WHERE a >= 8), w AS (SELECT bucket, term, round({g2_sql()}, 6) AS score FROM wt WHERE a >= 5 AND a * total_b > b * total_a),
gr AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY score DESC, term) AS r FROM g WHERE score >= 1.96 AND {_CLEAN}), wr AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY score DESC, term) AS r FROM w WHERE score >= 10.827566170662733 AND {_CLEAN}),
p AS (SELECT bucket, term, score, 'bigram' AS kind FROM gr WHERE r = 1), x AS (SELECT * FROM p UNION ALL SELECT bucket, term, score, 'word' FROM wr WHERE r = 1 AND bucket NOT IN (SELECT bucket FROM p) AND (SELECT count(*) FROM p) < 25) SELECT * FROM x ORDER BY score DESC, bucket LIMIT 12""")
def distinctive_phrases(spark, sf_dir):
    """Bigrams by z and words by log-likelihood, all of them, before the leakage filter; words stand in where bigrams are few."""
    from ..functions import stats
    from ..operators import selection as SL

    terms = T.counts(_words(spark, sf_dir), ["bucket", "lang"], F.concat(F.col("w"), X.bigrams(F.col("w"))))  # texts are split once for both
    every = T.against_cohort(terms.withColumn("pool", F.struct("lang", F.col("term").contains(" ").alias("pair"))), cohort="pool", least=5)
    grams, found = every.filter("pool.pair"), every.filter("NOT pool.pair AND a >= 5 AND a * total_b > b * total_a")
    _, z = stats.log_odds(F.col("a"), F.col("b"), F.col("total_a"), F.col("total_b"))
    pairs = grams.filter("a >= 8").select("bucket", "term", F.round(z, 6).alias("score")).filter("score >= 1.96")
    single = found.select("bucket", "term", F.round(stats.g2(F.col("a"), F.col("b"), F.col("total_a"), F.col("total_b")), 6).alias("score")).filter(F.col("score") >= stats.CHI2_001)
    return SL.distinctive_phrases(pairs, single, F.array(*map(F.lit, _NAMES)), least=25, top=12)


@query(f"""WITH {ARTICLES}, {_WORDS}, c AS (SELECT bucket, term, count(*) AS n FROM (SELECT country AS bucket, unnest(w) AS term FROM words) GROUP BY ALL), d AS (SELECT *, count(*) OVER (PARTITION BY term) AS df FROM c)
SELECT bucket, term, n FROM d WHERE df <= 1 AND n >= 3""")
def exclusive_vocabulary(spark, sf_dir):
    a = articles(spark, sf_dir).withColumn("bucket", F.col("country"))
    return T.exclusive(T.count_rows(X.token_rows(a, ["bucket"], F.col("body")), ["bucket"]))


@query(f"""WITH {ARTICLES}, {_WORDS}, c AS (SELECT country, count(DISTINCT term) AS n_terms, count(*) AS n_tokens FROM (SELECT country, unnest(w) AS term FROM words) GROUP BY ALL) SELECT country, n_terms, n_tokens, n_tokens < 30 AS thin FROM c""")
def bucket_vocabulary(spark, sf_dir):
    found = T.count_rows(X.token_rows(articles(spark, sf_dir), ["country"], F.col("body")), ["country"])
    return found.groupBy("country").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("n").alias("n_tokens")).withColumn("thin", F.col("n_tokens") < 30)


_BIG = f"big AS (SELECT bucket, day, unnest({bigrams_sql('w')}) AS term FROM words {_NEWS})"


@query(f"""WITH {ARTICLES}, {_WORDS}, {_BIG}, wire AS (SELECT * FROM big WHERE bucket IN ('src1', 'src2')), n AS (SELECT term, count(*) AS n FROM wire GROUP BY 1 HAVING count(*) >= 2)
SELECT term, n FROM n WHERE (SELECT count(DISTINCT day) FROM words WHERE section <> 'opinion' AND bucket IN ('src1', 'src2')) >= 14""")
def wire_baseline(spark, sf_dir):
    wire = _words(spark, sf_dir).filter(F.col("bucket").isin("src1", "src2"))
    return T.persistent_baseline(wire, "day", X.bigrams(F.col("w")))


_TILT = f"""{ARTICLES}, {_WORDS}, {_BIG}, own AS (SELECT bucket, term, count(*) AS n FROM big WHERE bucket NOT IN ('src1', 'src2') GROUP BY ALL), base AS (SELECT term, count(*) AS n FROM big WHERE bucket IN ('src1', 'src2') GROUP BY ALL),
tot AS (SELECT bucket, CAST(sum(n) AS BIGINT) AS total_a FROM own GROUP BY 1), bt AS (SELECT CAST(sum(n) AS BIGINT) AS total_b FROM base),
k AS (SELECT bucket, term FROM own WHERE n >= 2 UNION SELECT bucket, term FROM tot CROSS JOIN base WHERE n >= 2),
j AS (SELECT k.bucket, k.term, coalesce(own.n, 0) AS a, coalesce(base.n, 0) AS b, total_a, total_b FROM k LEFT JOIN own USING (bucket, term) LEFT JOIN base USING (term) JOIN tot USING (bucket) CROSS JOIN bt),
t AS (SELECT bucket, term, a, b, round({LOG_ODDS}, 6) AS log_odds, round({Z}, 6) AS z FROM j)"""


def _tilt(spark, sf_dir):
    found = shared_checkpoint(T.counts(_words(spark, sf_dir), ["bucket"], X.bigrams(F.col("w")), together=["term"]))  # read four times
    own, wire = found.filter(~F.col("bucket").isin("src1", "src2")), found.filter(F.col("bucket").isin("src1", "src2")).groupBy("term").agg(F.sum("n").alias("n"))
    return T.tilt(own, wire, "bucket")


@query(f"""WITH {_TILT}, s AS (SELECT *, CASE WHEN z > 0 THEN 'positive' ELSE 'negative' END AS side FROM t WHERE z <> 0), r AS (SELECT *, row_number() OVER (PARTITION BY bucket, side ORDER BY abs(z) DESC, term) AS rank FROM s)
SELECT bucket, side, term, a, b, log_odds, z, rank FROM r WHERE rank <= 15""")
def tilt_against_wire(spark, sf_dir):
    from ..operators.similarity import top_k

    t = _tilt(spark, sf_dir).filter("z <> 0").withColumn("side", F.when(F.col("z") > 0, "positive").otherwise("negative"))
    return top_k(t, ["bucket", "side"], [F.desc(F.abs("z")), F.col("term")], 15).select("bucket", "side", "term", "a", "b", "log_odds", "z", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {ARTICLES}, {_WORDS}, {_BIG} SELECT term, count(*) AS n FROM big WHERE bucket NOT IN ('src1', 'src2') GROUP BY 1 HAVING count(*) >= 3""")
def bucket_mean_baseline(spark, sf_dir):
    a = _words(spark, sf_dir).filter(~F.col("bucket").isin("src1", "src2"))
    return T.counts(a, ["bucket"], X.bigrams(F.col("w"))).groupBy("term").agg(F.sum("n").alias("n")).filter("n >= 3")


@query()
def tilt_significance(spark, sf_dir):
    """p of z by an Arrow function on the terms that are left, then false-discovery control per outlet and sign."""
    t = _tilt(spark, sf_dir).filter("z <> 0").withColumn("side", F.when(F.col("z") > 0, "positive").otherwise("negative")).withColumn("p", p_of_z(F.col("z")))
    t = shared_checkpoint(t.select("bucket", "side", "term", "z", "p"))  # read twice
    return T.benjamini_hochberg(t, "p", ["bucket", "side"]).filter("p <= 0.05").select("bucket", "side", "term", "z", "p", "significant")


_P = "(SELECT l_orderkey AS k, l_linenumber AS i, l_suppkey % 50 AS fam, (l_partkey * 7919 % 100003) / 1000030.0 AS p FROM lineitem)"


@query(f"""WITH t AS {_P}, r AS (SELECT *, row_number() OVER (PARTITION BY fam ORDER BY p) AS rk, count(*) OVER (PARTITION BY fam) AS n FROM t), c AS (SELECT fam, max(CASE WHEN p <= rk / n * 0.05 THEN p END) AS pc, max(n) AS n FROM r GROUP BY 1)
SELECT fam, count(*) AS n, CAST(sum(CASE WHEN p <= pc THEN 1 ELSE 0 END) AS BIGINT) AS n_bh, CAST(sum(CASE WHEN p <= 0.05 / c.n THEN 1 ELSE 0 END) AS BIGINT) AS n_bonferroni FROM t JOIN c USING (fam) GROUP BY fam""")
def multiple_testing(spark, sf_dir):
    from .registry import read

    t = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 50).alias("fam"), ((F.col("l_partkey") * 7919 % 100003) / F.lit(1000030.0)).alias("p"))
    bh = T.benjamini_hochberg(t, "p", ["fam"]).withColumnRenamed("significant", "bh")
    both = T.bonferroni(bh, "p", ["fam"])
    return both.groupBy("fam").agg(F.count(F.lit(1)).alias("n"), F.count_if("bh").alias("n_bh"), F.count_if("significant").alias("n_bonferroni"))


@query(f"""WITH {ARTICLES}, {_WORDS}, t AS (SELECT DISTINCT day, unnest(w) AS term FROM words) SELECT term, count(DISTINCT day) AS n_days FROM t GROUP BY 1 HAVING count(DISTINCT day) >= 10""")
def theme_persistence(spark, sf_dir):
    a = X.token_rows(articles(spark, sf_dir), ["day"], F.col("body")).distinct()
    return a.groupBy("term").agg(F.count(F.lit(1)).alias("n_days")).filter("n_days >= 10")


@query(f"""WITH {ARTICLES}, {_WORDS}, s AS (SELECT bucket, list_distinct(flatten(list(w))) AS v FROM words GROUP BY 1)
SELECT a.bucket AS a, b.bucket AS b, CAST(len(list_intersect(a.v, b.v)) AS BIGINT) AS common, round(len(list_intersect(a.v, b.v)) / (len(a.v) + len(b.v) - len(list_intersect(a.v, b.v))), 6) AS jaccard FROM s a JOIN s b ON a.bucket < b.bucket""")
def vocabulary_overlap(spark, sf_dir):
    """Through the inverted index: buckets meet at the terms they share."""
    a = articles(spark, sf_dir).withColumn("bucket", F.col("outlet"))
    long = shared_checkpoint(X.token_rows(a, ["bucket"], F.col("body")).distinct())  # read three times
    n = long.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    both = long.select("term", F.col("bucket").alias("a")).join(long.select("term", F.col("bucket").alias("b")), "term").filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("common"))
    sized = both.join(n.select(F.col("bucket").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("bucket").alias("b"), F.col("n").alias("nb")), "b")
    return sized.select("a", "b", "common", F.round(F.col("common") / (F.col("na") + F.col("nb") - F.col("common")), 6).alias("jaccard"))
