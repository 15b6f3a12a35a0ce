"""Which items to work on, what of them to show: selection, sampling, leakage filters, strips, cards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def select_items(items: DataFrame, feed: str, pos: str, link: str, status: str, in_top_cluster: Column | None = None, per_feed: int | None = None) -> DataFrame:
    """Items to extract: with a link, not yet extracted (ERROR and NONE try again), and in a top cluster or among the
    feed's first ``per_feed`` such items. Without either criterion all of them.
    """
    ready = items.filter((F.coalesce(F.col(link), F.lit("")) != "") & (F.col(status).isNull() | F.col(status).isin("ERROR", "NONE")))
    if in_top_cluster is None and per_feed is None:
        return ready
    chosen = F.lit(False)
    if per_feed is not None:
        ready = ready.withColumn("_r", F.row_number().over(W.partitionBy(feed).orderBy(pos)))
        chosen = F.col("_r") <= per_feed
    if in_top_cluster is not None:
        chosen = chosen | F.coalesce(in_top_cluster, F.lit(False))
    return ready.filter(chosen).drop("_r")


def next_tier(body_chars: Column, http: Column, paywalled: Column) -> Column:
    """Where to look next for a body: done, the web archive's copy, the crawl's copy, or give up."""
    short = F.coalesce(body_chars, F.lit(0)) < 200
    blocked = http.isNull() | http.isin(400, 401, 403, 404, 429)
    return F.when(~short, "done").when(blocked, "archive").when(F.coalesce(paywalled, F.lit(False)), "crawl").otherwise("none")


def stable_sample(rows: DataFrame, id_col: str, n: int, seed: int = 0) -> DataFrame:
    """``n`` rows by a seeded hash of their id: the same rows whatever the partitioning. All rows if there are no more."""
    return rows.orderBy(F.xxhash64(F.lit(seed), id_col), id_col).limit(n)


def leaks_bucket(term: Column, names: Column, skip: tuple[str, ...] = ("north", "south", "east", "west", "united", "republic")) -> Column:
    """Whether any word of ``term`` and any part of a bucket's names share a four-letter prefix either way."""
    parts = F.filter(F.flatten(F.transform(names, lambda n: F.split(F.lower(n), r"[\s_\-]+"))), lambda p: (F.length(p) >= 4) & ~p.isin(*skip))
    return F.exists(F.split(F.lower(term), " "), lambda w: (F.length(w) >= 4) & F.exists(parts, lambda p: p.startswith(F.left(w, F.lit(4))) | w.startswith(F.left(p, F.lit(4)))))


def distinctive_phrases(bigrams: DataFrame, words: DataFrame, names: Column, least: int = 3, top: int = 3) -> DataFrame:
    """Per bucket its first clean bigram; where fewer than ``least`` buckets have one, the first clean word of the others.

    Both inputs: bucket, term, score. Best ``top`` by score.
    """
    def first_clean(terms: DataFrame, kind: str) -> DataFrame:
        clean = terms.filter(~leaks_bucket(F.col("term"), names))
        r = F.row_number().over(W.partitionBy("bucket").orderBy(F.desc("score"), "term"))
        return clean.withColumn("_r", r).filter("_r = 1").select("bucket", "term", "score", F.lit(kind).alias("kind"))

    pairs = first_clean(bigrams, "bigram")
    enough = pairs.agg((F.count(F.lit(1)) >= least).alias("enough"))
    spare = first_clean(words, "word").join(pairs.select("bucket"), "bucket", "left_anti").crossJoin(enough).filter("NOT enough").drop("enough")
    return pairs.unionByName(spare).orderBy(F.desc("score"), "bucket").limit(top)


def headline_strip(rows: DataFrame, by: list[str], frame: str, bucket: str, pos: str, most: int = 4) -> DataFrame:
    """In order of ``pos``, at most ``most`` rows per group with frames and buckets that differ pairwise: a greedy fold."""
    ordered = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(frame).alias("f"), F.col(bucket).alias("b")))).alias("x"))

    def step(kept: Column, x: Column) -> Column:
        clash = F.exists(kept, lambda k: (k["f"] == x["f"]) | (k["b"] == x["b"]))
        return F.when((F.size(kept) < most) & ~clash, F.array_append(kept, x)).otherwise(kept)

    return ordered.select(*by, F.explode(F.aggregate("x", F.slice("x", 1, 0), step)).alias("k")).select(*by, F.col("k.p").alias(pos), F.col("k.f").alias(frame), F.col("k.b").alias(bucket))


def representative(members: DataFrame, by: list[str], wire: str, pos: str, title: str) -> DataFrame:
    """A cluster's title: the first from a wire, else the first."""
    return members.groupBy(*by).agg(F.min_by(title, F.struct(~F.coalesce(F.col(wire), F.lit(False)), F.col(pos))).alias("representative"))


def archetypes(**signals: Column) -> Column:
    """Names of the card types whose signal holds, in the order given."""
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in signals.items()]), lambda x: x.isNotNull())


def precondition(rule: dict) -> Column:
    """A published rule as a condition on signal columns; unknown types are false.

    ``type`` one of fallback, field_present (and ``and``), min_length, max_abs_delta_share, count_in_state, max_z_score,
    sources_diversity, max_llr; ``field`` names the column.
    """
    kind, field, value = rule.get("type"), rule.get("field"), rule.get("value", 0)
    c = F.col(field) if field else None
    made = {
        "fallback": lambda: F.lit(True),
        "field_present": lambda: c.isNotNull() & (F.coalesce(c.cast("string"), F.lit("")) != ""),
        "min_length": lambda: F.length(c) >= value,
        "max_abs_delta_share": lambda: F.abs(c) >= value,
        "count_in_state": lambda: c >= value,
        "max_z_score": lambda: c >= value,
        "max_llr": lambda: c >= value,
        "sources_diversity": lambda: (F.col("n_speakers") >= rule.get("speakers", 5)) & (F.col("n_types") >= rule.get("types", 3)) & (F.col("n_outlets") >= rule.get("outlets", 2)),
    }.get(kind)
    if made is None:
        return F.lit(False)
    own = F.coalesce(made(), F.lit(False))
    return own & precondition(rule["and"]) if "and" in rule else own


def breadth_query(title: Column, stop: tuple[str, ...]) -> Column:
    """The first five words of four letters or more that are no stopword."""
    words = F.regexp_extract_all(F.lower(title), F.lit(r"([a-z]{4,})"), F.lit(1))
    return F.array_join(F.slice(F.filter(words, lambda w: ~w.isin(*stop)), 1, 5), " ")


def synthesis(story: Column, n_buckets: Column, n_silent: Column, frame: Column, delta: Column) -> Column:
    """One sentence on a story from its signals; parts without data are left out."""
    moved = F.when(F.abs(delta) >= 0.1, F.concat(F.lit("; "), frame, F.when(delta > 0, " rose").otherwise(" fell"), F.lit(" by "), F.round(F.abs(delta) * 100).cast("int").cast("string"), F.lit(" points")))
    silent = F.when(n_silent > 0, F.concat(F.lit(", "), n_silent.cast("string"), F.lit(" silent")))
    return F.concat(story, F.lit(": "), n_buckets.cast("string"), F.lit(" buckets"), F.coalesce(silent, F.lit("")), F.coalesce(moved, F.lit("")), F.lit("."))


def staging(decisions: DataFrame, key: str, at: str, action: str) -> DataFrame:
    """Last state per key of a log of stage, approve and reject: decisions count only while pending, others are ignored."""
    ordered = decisions.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(at).alias("t"), F.col(action).alias("a")))).alias("x"))

    def step(state: Column, x: Column) -> Column:
        return F.when(x["a"] == "stage", "pending").when((state == "pending") & (x["a"] == "approve"), "approved").when((state == "pending") & (x["a"] == "reject"), "rejected").otherwise(state)

    return ordered.select(key, F.aggregate("x", F.lit("none"), step).alias("state"))
