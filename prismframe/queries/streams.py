"""Sources and streams: feeds parsed from bytes, first-seen state, windows."""

from pyspark.sql import functions as F

from ..sources import feeds
from ..streaming import first_seen as FS
from .registry import query, read

_P = r"^https?://([^/?#]+)"


@query(f"SELECT page_id, 0 AS item_pos, left('T' || CAST(page_id AS VARCHAR) || ' <b> & c', 300) AS title, left(url, 400) AS link, 'about ' || regexp_extract(url, '{_P}', 1) AS summary, '' AS published FROM pages")
def feed_parsing(spark, sf_dir):
    p = read(spark, sf_dir, "pages")
    xml = feeds.page_feed(F.col("url"), F.concat(F.lit("T"), F.col("page_id").cast("string"), F.lit(" <b> & c")), F.concat(F.lit("about "), F.regexp_extract("url", _P, 1)), F.lit(""))
    return feeds.feed_items(p.select("page_id", xml.alias("body")), "body", "page_id")


@query()
def quote_extraction(spark, sf_dir):
    """Whole turns quoted twice, with the attribution before and after."""
    plain = F.translate(F.coalesce("text", F.lit("")), '"“”«»„\n', "       ")
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat(F.lit('Ana Ruiz said: "'), plain, F.lit('".\n"'), plain, F.lit('", added Bo Chen.')).alias("t"))
    return c.select("conv_id", "turn", F.explode(feeds.extract_quotes("t")).alias("q")).select("conv_id", "turn", "q.*")


def _stream(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/events*.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


@query("SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_daily_volume(spark, sf_dir):
    s = FS.daily_volume(_stream(spark, sf_dir), "ts", ["event_type"])
    return FS.drain(s, "prism_daily", "complete").withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("SELECT CAST(f + INTERVAL 1 DAY * k AS TIMESTAMP) AS from_day, event_type, count(*) AS n FROM (SELECT date_trunc('day', ts) - INTERVAL 6 DAYS AS f, event_type FROM events), range(7) r(k) GROUP BY ALL")
def stream_sliding_volume(spark, sf_dir):
    s = FS.sliding_volume(_stream(spark, sf_dir), "ts", ["event_type"])
    return FS.drain(s, "prism_sliding", "complete").withColumn("from_day", F.col("from_day").cast("timestamp_ntz"))


@query("""WITH d AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 6 HOURS THEN 0 ELSE 1 END AS c FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM d)
SELECT user_id, min(ts) AS from_ts, max(ts) + INTERVAL 6 HOURS AS to_ts, count(*) AS n FROM g GROUP BY user_id, g""")
def feed_sessions(spark, sf_dir):
    e = read(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return FS.sessions(e, "ts", ["user_id"]).withColumn("from_ts", F.col("from_ts").cast("timestamp_ntz")).withColumn("to_ts", F.col("to_ts").cast("timestamp_ntz"))


@query("SELECT user_id, count(*) AS n, min(ts) AS first_seen, count(*) - 1 AS n_repeats FROM events GROUP BY user_id")
def stream_first_seen(spark, sf_dir):
    s = FS.flag_repeats(_stream(spark, sf_dir), "ts", "user_id", "event_id", days=3650)
    out = FS.drain(s, "prism_first_seen")
    g = out.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.min("first_seen").alias("f"), F.count_if("is_repeat").alias("n_repeats"))
    return g.select("user_id", "n", F.col("f").cast("timestamp_ntz").alias("first_seen"), "n_repeats")
