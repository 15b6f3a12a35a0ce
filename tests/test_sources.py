"""Sources against a server on this machine, encoders, caches and functions by name."""

import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from prismframe.functions.register import register
from prismframe.operators import health, stories
from prismframe.sources import encoding, feeds, snapshots

INDEX = "<sitemapindex>" + "".join(f"<sitemap><loc>{{base}}/child{i}.xml</loc></sitemap>" for i in range(5)) + "</sitemapindex>"
NEWS = "<urlset xmlns:n='n'><url><loc>u1</loc><n:news><n:title>First</n:title><n:publication_date>2026</n:publication_date></n:news></url><url><loc>u2</loc></url></urlset>"


@pytest.fixture(scope="module")
def server():
    seen = Counter()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):  # noqa: N802
            seen[self.path] += 1
            base = f"http://127.0.0.1:{self.server.server_port}"
            status, body = 404, ""
            if self.path == "/flaky" and seen[self.path] < 3 or self.path == "/down":
                status = 503
            elif self.path in ("/flaky", "/feed", "/other"):
                status, body = 200, "<rss><item><title>T</title></item></rss>"
            elif self.path == "/news-sitemap.xml":
                status, body = 200, NEWS
            elif self.path == "/index.xml":
                status, body = 200, INDEX.format(base=base)
            elif self.path.startswith("/child"):
                status, body = 200, f"<urlset><url><loc>{self.path}</loc><lastmod>2026-01-0{self.path[6]}</lastmod></url></urlset>"
            self.send_response(status)
            self.end_headers()
            self.wfile.write(body.encode())

        def log_message(self, *_):
            pass

    s = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}", seen
    s.shutdown()


def test_fetching_retries_and_keeps_the_order(spark, server):
    base, seen = server
    urls = [f"{base}/flaky", f"{base}/missing", f"{base}/down", "http://127.0.0.1:9/none", f"{base}/feed", "nonsense"]
    got = sorted(feeds.fetch(spark, urls, gap="0", backoff="0.01", timeout="5").collect())
    assert [r.url for r in got] == urls and [r.http_status for r in got] == [200, 404, 503, None, 200, None]
    assert seen["/flaky"] == 3 and seen["/missing"] == 1 and seen["/down"] == 3
    assert got[4].body == b"<rss><item><title>T</title></item></rss>" and got[3].error and got[5].error


def test_one_partition_per_host_and_a_gap(server):
    base, _ = server
    reader = feeds._HttpReader({"urls": f"{base}/feed\nhttp://b.invalid/x\n{base}/other", "gap": "0.2"})
    parts = reader.partitions()
    assert [[p for p, _ in x.urls] for x in parts] == [[0, 2], [1]]
    import time

    began = time.perf_counter()
    assert [r[0] for r in reader.read(parts[0])] == [0, 2] and time.perf_counter() - began >= 0.2


def test_sitemap_paths_are_tried_in_order(spark, server):
    base, _ = server
    got = feeds.sitemap_fallback(spark, [f"{base}/rss", "http://127.0.0.1:9/rss"], gap="0", backoff="0.01", timeout="5").collect()
    assert [(r.feed_url, r.item_pos, r.title, r.link, r.published) for r in got] == [(f"{base}/rss", 0, "First", "u1", "2026")]


def test_sitemap_index_is_followed_to_three_children(spark, server):
    base, _ = server
    got = feeds.sitemap_pages(spark, [f"{base}/index.xml", f"{base}/news-sitemap.xml"], gap="0", timeout="5").collect()
    assert sorted((r.sitemap[len(base):], r.url) for r in got) == [("/index.xml", f"/child{i}.xml") for i in range(3)] + [("/news-sitemap.xml", "u1"), ("/news-sitemap.xml", "u2")]


def test_encoder_and_cache(spark, tmp_path):
    df = spark.createDataFrame([(1, "a b c"), (2, "a b d"), (3, None), (4, "x y")], "id long, t string")
    v = {r.id: r.embedding for r in encoding.embed(df, "t", batch=2).collect()}
    dot = lambda a, b: sum(x * y for x, y in zip(v[a], v[b], strict=True))
    assert v[3] is None and abs(dot(1, 1) - 1) < 1e-9 and dot(1, 2) > dot(1, 4)
    cache, log = f"file://{tmp_path}/cache", tmp_path / "log"

    def shout(texts):
        with log.open("a") as f:
            f.writelines(t + "\n" for t in texts)
        return [t.upper() for t in texts]

    assert {r.id: r.u for r in encoding.cached(df, "t", cache, shout, "u").collect()} == {1: "A B C", 2: "A B D", 3: None, 4: "X Y"}
    more = df.unionByName(spark.createDataFrame([(5, "new"), (6, "new")], "id long, t string"))
    assert {r.id: r.u for r in encoding.cached(more, "t", cache, shout, "u").collect()}[6] == "NEW"
    assert Counter(log.read_text().split("\n")) == Counter(["a b c", "a b d", "x y", "new", ""])


def test_broken_runs_go_on(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i}") for i in range(50)] + [(None, "x")], "id long, t string")
    path, log = f"file://{tmp_path}/done", tmp_path / "log"

    def work(part, fail=False):
        def run(batches):
            import pyarrow as pa

            for b in batches:
                if fail and any(i > 40 for i in b.column(0).to_pylist()):
                    raise ValueError("broken off")
                with log.open("a") as f:
                    f.writelines(f"{i}\n" for i in b.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["id", "t"])

        return part.mapInArrow(run, "id long, t string")

    with pytest.raises(Exception, match="broken off"):
        encoding.checkpointed(df, "id", path, lambda d: work(d, True), 10)
    kept = spark.read.parquet(path).count()
    out = encoding.checkpointed(df, "id", path, work, 10)
    assert sorted(r.id for r in out.collect()) == list(range(50)) and kept < 50
    ran = Counter(log.read_text().split())
    assert set(ran) == {str(i) for i in range(50)}


def test_functions_by_name(spark):
    register(spark)
    r = spark.sql("SELECT erfc(1.0D) AS e, t_tail(2.0D, 10.0D) AS t, quotes('Ann Lee said: \"we go now\".')[0].speaker AS s").first()
    assert abs(r.e - 0.157299207) < 1e-8 and abs(r.t - 0.07338803) < 1e-7 and r.s == "Ann Lee"
    assert [tuple(x) for x in spark.sql("SELECT item_pos, title FROM parse_feed('<rss><item><title>A</title></item></rss>')").collect()] == [(0, "A")]


def test_snapshot_flattening_and_sources(spark):
    nested = spark.sql("""SELECT '2026-01-01' AS date, map('us', named_struct('label', 'US', 'feeds', array(named_struct('name', 'F1', 'lang', 'en', 'items', array(named_struct('title', 'a'), named_struct('title', 'b'))))),
      'fr', named_struct('label', 'FR', 'feeds', array(named_struct('name', 'F2', 'lang', 'fr', 'items', array(named_struct('title', 'c')))))) AS countries""")
    got = sorted((r.country, r.outlet, r.item_pos, r.title) for r in feeds.flatten_snapshot(nested).collect())
    assert got == [("fr", "F2", 0, "c"), ("us", "F1", 0, "a"), ("us", "F1", 1, "b")]
    s = spark.sql("SELECT 'k' AS story_key, '2026' AS date, array(named_struct('quote', 'q1'), named_struct('quote', 'q2')) AS sources")
    assert [(r.pos, r.quote) for r in snapshots.flatten_sources(s).orderBy("pos").collect()] == [(0, "q1"), (1, "q2")]
    ids = spark.createDataFrame([("d1", ["x", "y"]), ("d2", ["z"])], "date string, article_ids array<string>")
    m = spark.createDataFrame([("d1", [[1.0], [2.0]]), ("d2", [[1.0], [2.0]])], "date string, matrix array<array<double>>")
    assert sorted((r.date, r.article_id, r.embedding) for r in snapshots.aligned_embeddings(ids, m).collect()) == [("d1", "x", [1.0]), ("d1", "y", [2.0])]


def test_health_edges(spark):
    f = spark.createDataFrame([("b", "f1", 0, 0, None, None, None), ("b", "f2", 10, 8, 200, "", 5001), ("c", "f3", 1, 0, 404, None, 5000)], "bucket string, feed string, n_items int, n_stubs int, http_status int, error string, fetch_ms int")
    got = {r.feed: (r.stub_pct, r.stub_only, r.slow, r.failed) for r in health.feed_health(f).collect()}
    assert got == {"f1": (None, False, False, False), "f2": (80.0, True, True, False), "f3": (0.0, False, False, True)}
    report = {(r.section, r.bucket, r.feed): r.value for r in health.pull_report(f).collect()}
    assert report["total", "errored", None] == 2 and report["items", "b", None] == 10 and report["slow", "b", "f2"] == 5001


def test_lineage_reuse_at_both_ends_only(spark):
    c = spark.createDataFrame([("d1", 1), ("d2", 1), ("d3", 4), (None, 5)], "day string, cluster_id long")
    known = spark.createDataFrame([("L1", "d1", 1, "d3", 4), ("L0", "d1", 1, None, None)], "lineage_id string, seed_day string, seed_cluster long, latest_day string, latest_cluster long")
    got = {(r.day, r.cluster_id): r.lineage_id for r in stories.lineage_ids(c, known).collect()}
    assert got["d1", 1] == "L1" and got["d3", 4] == "L1" and got["d2", 1].startswith("L") and len(got["d2", 1]) == 11


def test_counters(spark):
    from prismframe.operators.terms import subtract_counts, union_counts

    a = spark.createDataFrame([("x", 3), ("y", 1)], "term string, n long")
    b = spark.createDataFrame([("x", 1), ("y", 2), ("z", 5)], "term string, n long")
    assert {r.term: r.n for r in union_counts(a, b).collect()} == {"x": 4, "y": 3, "z": 5}
    assert {r.term: r.n for r in subtract_counts(a, b).collect()} == {"x": 2}


def test_streams_end_in_the_shared_folder(spark, tmp_path):
    from prismframe.streaming import first_seen as FS

    later = F.when(F.col("id") == 5, 3 * 86400).otherwise(0)  # beyond the day that keys are remembered for
    spark.range(6).select(F.timestamp_seconds(F.col("id") * 3600 + 1_700_000_000 + later).alias("ts"), (F.col("id") % 2).alias("k"), "id").write.parquet(f"{tmp_path}/in")
    s = spark.readStream.schema("ts timestamp, k long, id long").parquet(f"{tmp_path}/in")
    out = FS.drain(FS.flag_repeats(s, "ts", "k", "id", days=1), "t")
    assert sorted((r.id, r.is_repeat) for r in out.collect()) == [(0, False), (1, False), (2, True), (3, True), (4, True), (5, False)]
    sessions = FS.drain(FS.sessions(s, "ts", ["k"]), "sessions")
    assert sorted((r.k, r.n) for r in sessions.collect()) == [(0, 3), (1, 2)]  # the last one is still open
    assert out.inputFiles() and "memory" not in out._jdf.queryExecution().analyzed().toString().lower()
