import gzip

import numpy as np
from pyspark.sql import functions as F

from prismframe.operators import dedup, quotes, selection, series, similarity, stories
from prismframe.operators.hdbscan import cluster_points
from prismframe.sources import feeds, snapshots, webarchive
from prismframe.streaming import first_seen


def test_feeds_survive_anything(spark):
    rss = b"\xef\xbb\xbf<rss><channel><item><title>A</title><link>http://x</link><content:encoded xmlns:content='c'>body</content:encoded><dc:date xmlns:dc='d'>2026</dc:date></item><item><link>no title</link></item><item><title>B</title></item></channel></rss>"
    assert feeds.parse_feed_bytes(rss) == [{"title": "A", "link": "http://x", "summary": "body", "published": "2026"}, {"title": "B", "link": "", "summary": "", "published": ""}]
    atom = "<feed xmlns='a'><entry><title>T</title><link href='http://h'/><summary>S</summary><updated>u</updated></entry></feed>"
    assert feeds.parse_feed_bytes(atom)[0] == {"title": "T", "link": "http://h", "summary": "S", "published": "u"}
    assert feeds.parse_feed_bytes(rss[:60]) == [] and feeds.parse_feed_bytes(b"<a>\x00</a>") == [] and feeds.parse_feed_bytes(None) == [] and len(feeds.parse_feed_bytes(rss, 1)) == 1
    site = "<urlset xmlns:n='n'><url><loc>u1</loc><n:news><n:title>t</n:title><n:publication_date>d</n:publication_date></n:news></url><sitemap><loc>s2</loc></sitemap></urlset>"
    assert feeds.parse_sitemap_bytes(site) == [{"url": "u1", "title": "t", "raw_date": "d", "nested": False}, {"url": "s2", "title": "", "raw_date": "", "nested": True}]
    df = spark.createDataFrame([(1, bytearray(rss)), (2, None), (3, bytearray(b"<"))], "f long, body binary")
    assert [(r.f, r.item_pos, r.title) for r in feeds.feed_items(df, "body", "f").collect()] == [(1, 0, "A"), (1, 1, "B")]


def test_sitemap_fallback_only_for_thin_feeds(spark):
    f = spark.createDataFrame([("a", "t1"), *[("b", f"x{i}") for i in range(3)]], "feed string, title string")
    s = spark.createDataFrame([("a", "t1"), ("a", "t2"), ("b", "t9"), ("c", "t3")], "feed string, title string")
    assert sorted(map(tuple, feeds.merge_fallback(f, s, "feed").collect())) == [("a", "t1"), ("a", "t2"), ("b", "x0"), ("b", "x1"), ("b", "x2")]


def test_quotes():
    got = feeds.quotes_in('Minister Ana Ruiz said: "we will not accept this". “Never again,” said John Smith.')
    assert [(q["speaker"], q["verb"], q["quote"]) for q in got] == [("Minister Ana Ruiz", "said", "we will not accept this"), ("John Smith", "said", "Never again,")]
    assert feeds.quotes_in(None) == []


def test_archive_records(spark):
    raw = gzip.compress(b"WARC/1.0\r\n\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html; charset=latin-1\r\n\r\n<p>\xe9</p>")
    assert webarchive.record_html(raw) == {"status": "ok", "html": "<p>é</p>"}
    assert webarchive.record_html(b"junk")["status"] == "bad_record" and webarchive.record_html(None)["status"] == "no_record"
    out = spark.createDataFrame([(bytearray(raw),)], "b binary").select(webarchive.parse_record("b").alias("r")).first().r
    assert out.status == "ok"


def test_lineage_thresholds(spark):
    def run(day1, day2):
        rows = [("2026-01-01", 1, a) for a in day1] + [("2026-01-03", 7, a) for a in day2]
        m = spark.createDataFrame(rows, "day string, cluster_id int, article_id string").withColumn("day", F.to_date("day"))
        return {(str(r.day), r.cluster_id, r.root_cluster) for r in stories.lineages(m).collect()}

    assert run("abcde", "abcfg") == {("2026-01-01", 1, 1), ("2026-01-03", 7, 1)}  # 3/7
    assert run("abcd", "axyz") == set()  # 1/7
    assert run("ab", "") == set()


def test_salience(spark):
    rows = [(1, 10, 5, 1, None), (2, 10, 20, 1, None), (3, 10, 5, 3, None), (4, 10, 5, 1, 0.5)]
    c = spark.createDataFrame(rows, "cluster_id int, n_articles int, n_countries int, n_langs int, stability double")
    got = {r.cluster_id: r.salience for r in stories.salience(c, F.lit(10)).collect()}
    assert got == {1: 5.0, 2: 10.0, 3: 7.5, 4: 2.5}


def test_novelty(spark):
    rows = [("o", 1, ["a", "b", "c"], "title", 9), ("o", 2, ["a", "b", "c"], "body", 5), ("o", 3, ["x", "y"], "summary", 4), ("o", 4, ["z"], "title", 1), ("p", 5, [], "title", 0), ("p", 6, [], "title", 0)]
    df = spark.createDataFrame(rows, "outlet string, id int, w array<string>, level string, n int")
    assert sorted(map(tuple, stories.novel_articles(df, ["outlet"], "w", "level", "n", "id").collect())) == [("o", 2, 0), ("o", 3, 1), ("p", 5, 0), ("p", 6, 1)]


def test_hdbscan_finds_blobs_and_noise():
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(0, 0.05, (20, 4)), rng.normal(3, 0.05, (15, 4)), [[9, -9, 9, -9.0]]])
    labels, persistence = cluster_points(x, 5)
    assert len(set(labels[:20])) == 1 and len(set(labels[20:35])) == 1 and labels[0] != labels[20] and labels[-1] == -1
    assert (persistence[:35] > 0).all()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    assert (cluster_points(d, 5, precomputed=True)[0] == labels).all()
    assert (cluster_points(x[:2], 3)[0] == -1).all()


def test_dbscan_against_brute_force(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 3))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (1 - x @ x.T) <= 0.05
    core = near.sum(1) >= 3
    root = {i: i for i in range(60) if core[i]}
    for _ in range(60):
        root = {i: min(root[j] for j in root if near[i, j]) for i in root}
    want = {i: root.get(i, min([root[j] for j in root if near[i, j]], default=-1)) for i in range(60)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>")
    assert {r.id: r.cluster for r in similarity.dbscan(df, "id", "v", 0.05).collect()} == want


def test_dedup_of_a_small_day(spark):
    rows = [(1, "http://e.com/a?utm_x=1", "One - CNN", "f1", "s"), (2, "http://www.e.com/a/", "Other", "f2", "longer"), (3, None, "One", "f3", None), (4, None, None, "f4", None), (5, None, None, "f4", None)]
    a = dedup.annotate(spark.createDataFrame(rows, "id long, link string, title string, feed string, summary string"), "link", "title", "feed")
    assert {r.id: (r.url_dup_count, r.title_dup_count) for r in a.collect()} == {1: (2, 2), 2: (2, 1), 3: (0, 2), 4: (0, 0), 5: (0, 0)}
    p = dedup.primaries(a, "id", "summary", "feed").collect()
    assert {(r.primary_id, r.n_items) for r in p} == {(2, 2), (3, 1), (4, 1), (5, 1)}


def test_runs_and_moves(spark):
    rows = [("a", i, v) for i, v in enumerate(["x", "x", None, None, "x"])]
    r = series.runs(spark.createDataFrame(rows, "k string, d int, v string"), ["k"], "d", "v").collect()
    assert sorted((x.from_day, x.to_day, x.v) for x in r) == [(0, 1, "x"), (2, 3, None), (4, 4, "x")]


def test_citations(spark):
    corpus = spark.createDataFrame([("s", 0, "Reuters", "the exact words here")], "story string, idx int, outlet string, text string")
    c = spark.createDataFrame([("s", 0, "?", "exact words"), ("s", 9, "Reuters", "x"), ("s", 0, "BBC", "exact"), ("s", 0, "Reuters", "invented")], "story string, idx int, outlet string, quote string")
    got = [(r.idx, r.error, r.outlet_filled) for r in quotes.citation_errors(c, corpus, "idx", "quote", "outlet", ["story"]).collect()]
    assert sorted(got, key=str) == sorted([(0, None, "Reuters"), (9, "out of range", "Reuters"), (0, "outlet differs", "BBC"), (0, "not found verbatim", "Reuters")], key=str)


def test_leakage_and_rules(spark):
    df = spark.createDataFrame([("french wine",), ("solid wine",)], "t string")
    assert [r[0] for r in df.select(selection.leaks_bucket(F.col("t"), F.array(F.lit("France")))).collect()] == [False, False]
    assert df.select(selection.leaks_bucket(F.lit("franc zone"), F.array(F.lit("France")))).first()[0]
    assert df.select(selection.precondition({"type": "no such"})).first()[0] is False


def test_history_skips_corrupt_and_old_files(spark, tmp_path):
    from pyspark.sql import types as T

    for name, body in (("2026-08-06_a.json", '{"x": 1}'), ("2026-08-05_b.json", "{broken"), ("2025-01-01_c.json", '{"x": 3}'), ("notes.json", '{"x": 4}')):
        (tmp_path / name).write_text(body)
    got = snapshots.read_history(spark, str(tmp_path), T.StructType([T.StructField("x", T.IntegerType())]), F.lit("2026-08-07").cast("date"))
    assert [(r.x, str(r.file_date), r.file_key) for r in got.collect()] == [(1, "2026-08-06", "a")]


def test_word_list(spark, tmp_path):
    (tmp_path / "w.txt").write_text("# head\nThe and  # tail\n\nAND of\n")
    assert sorted(r.word for r in snapshots.read_word_list(spark, str(tmp_path / "w.txt")).collect()) == ["and", "of", "the"]


def test_stream_drops_repeats(spark, tmp_path):
    rows = [(i, f"k{i % 3}", f"2026-01-0{1 + i}T00:00:00") for i in range(6)]
    spark.createDataFrame(rows, "id long, k string, t string").withColumn("t", F.to_timestamp("t")).write.parquet(str(tmp_path / "in"))
    s = spark.readStream.schema("id long, k string, t timestamp").parquet(str(tmp_path / "in"))
    assert first_seen.drain(first_seen.distinct_items(s, "t", "k"), "t_distinct").count() == 3
    flagged = first_seen.drain(first_seen.flag_repeats(s, "t", "k", "id", days=2), "t_flagged").collect()
    assert {(r.id, r.is_repeat) for r in flagged} == {(i, False) for i in range(6)}  # three days apart, remembered for two
