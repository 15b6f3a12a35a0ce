"""Stories: salience of clusters, lineages across days, the corpus of a briefing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import jaccard


def salience(clusters: DataFrame, total_countries: Column, top: int = 15) -> DataFrame:
    """Articles x capped spread x 1.5 for two languages or more x stability (1 if unknown), rounded to 3, the ``top`` best."""
    spread = F.least(F.lit(1.0), F.col("n_countries") / F.nullif(total_countries, F.lit(0)))
    score = F.col("n_articles") * F.coalesce(spread, F.lit(0.0)) * F.when(F.col("n_langs") >= 2, 1.5).otherwise(1.0) * F.coalesce(F.col("stability"), F.lit(1.0))
    return clusters.withColumn("salience", F.round(score, 3)).orderBy(F.desc("salience"), "cluster_id").limit(top)


def predecessor_links(members: DataFrame, least: float = 0.3) -> DataFrame:
    """Each cluster's best predecessor on the previous day that has clusters: (day, cluster_id, prev_day, prev_cluster, jaccard).

    ``members``: day, cluster_id, article_id. An inverted-index join on (article, day before) counts intersections, so
    clusters without a common article never meet. Ties go to the lower predecessor.
    """
    days = members.select("day").distinct().withColumn("prev_day", F.lag("day").over(W.partitionBy(F.lit(1)).orderBy("day")))
    sizes = members.groupBy("day", "cluster_id").agg(F.count(F.lit(1)).alias("n"))
    now = members.join(days.filter("prev_day IS NOT NULL"), "day")
    before = members.select(F.col("day").alias("prev_day"), F.col("cluster_id").alias("prev_cluster"), "article_id")
    shared = now.join(before, ["prev_day", "article_id"]).groupBy("day", "cluster_id", "prev_day", "prev_cluster").agg(F.count(F.lit(1)).alias("both"))
    with_sizes = shared.join(sizes, ["day", "cluster_id"]).join(sizes.select(F.col("day").alias("prev_day"), F.col("cluster_id").alias("prev_cluster"), F.col("n").alias("m")), ["prev_day", "prev_cluster"])
    j = with_sizes.withColumn("jaccard", F.col("both") / (F.col("n") + F.col("m") - F.col("both"))).filter(F.col("jaccard") >= least)
    rank = F.row_number().over(W.partitionBy("day", "cluster_id").orderBy(F.desc("jaccard"), "prev_cluster"))
    return j.withColumn("r", rank).filter("r = 1").select("day", "cluster_id", "prev_day", "prev_cluster", "jaccard")


def lineages(members: DataFrame, least: float = 0.3, window: int = 7) -> DataFrame:
    """(day, cluster_id, root_day, root_cluster) of clusters in a lineage of two days or more.

    Every cluster has one predecessor at most, so the links are a forest: doubling pointers reaches every root in
    log2(window) self joins. Each step is written to the session's shared folder, since the next reads it twice.
    """
    from ..plans.session import shared_checkpoint

    links = predecessor_links(members, least)
    nodes = members.select("day", "cluster_id").distinct()
    at = nodes.join(links.select("day", "cluster_id", "prev_day", "prev_cluster"), ["day", "cluster_id"], "left").select("day", "cluster_id", F.coalesce("prev_day", "day").alias("root_day"), F.coalesce("prev_cluster", "cluster_id").alias("root_cluster"))
    for _ in range(max(1, (window - 1).bit_length())):
        at = shared_checkpoint(at)
        up = at.select(F.col("day").alias("root_day"), F.col("cluster_id").alias("root_cluster"), F.col("root_day").alias("_d"), F.col("root_cluster").alias("_c"))
        at = at.join(up, ["root_day", "root_cluster"]).select("day", "cluster_id", F.col("_d").alias("root_day"), F.col("_c").alias("root_cluster"))
    n = F.count(F.lit(1)).over(W.partitionBy("root_day", "root_cluster"))
    return at.withColumn("n", n).filter("n > 1").drop("n")


def novel_articles(corpus: DataFrame, by: list[str], words: str, level: str, length: str, id_col: str, most: int = 2, least: float = 0.6) -> DataFrame:
    """Per outlet the ``most`` best articles whose title is new: body before summary before title, longer first; a title
    with Jaccard >= ``least`` to a kept one is skipped. Greedy, as a fold over the sorted array: no Python.
    """
    rank = F.when(F.col(level) == "body", 0).when(F.col(level) == "summary", 1).otherwise(2)
    item = F.struct(rank.alias("r"), (-F.col(length)).alias("l"), F.col(id_col).alias("id"), F.col(words).alias("w"))
    sorted_ = corpus.groupBy(*by).agg(F.array_sort(F.collect_list(item)).alias("items"))

    def step(kept: Column, x: Column) -> Column:
        novel = ~F.exists(kept, lambda k: F.coalesce(jaccard(k["w"], x["w"], "null") >= least, F.lit(False)))
        return F.when((F.size(kept) < most) & novel, F.array_append(kept, x)).otherwise(kept)

    kept = F.aggregate("items", F.slice("items", 1, 0), step)
    return sorted_.select(*by, F.posexplode(kept).alias("pos", "x")).select(*by, F.col("x.id").alias(id_col), F.col("pos").cast("long").alias("kept_rank"))


def coverage_absence(presence: DataFrame, story: str, bucket: str, least: int) -> DataFrame:
    """(bucket, story) of stories that at least ``least`` buckets carry and this one does not."""
    wide = presence.select(story, bucket).distinct().groupBy(story).agg(F.collect_set(bucket).alias("who")).filter(F.size("who") >= least)
    return wide.crossJoin(presence.select(bucket).distinct()).filter(~F.array_contains("who", F.col(bucket))).select(bucket, story)


def co_presence(presence: DataFrame, story: str, bucket: str) -> DataFrame:
    """Jaccard of the story sets of each pair of buckets a < b that share a story."""
    p = presence.select(story, bucket).distinct()
    n = p.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    both = p.select(story, F.col(bucket).alias("a")).join(p.select(story, F.col(bucket).alias("b")), story).filter("a < b").groupBy("a", "b").agg(F.count(F.lit(1)).alias("both"))
    return both.join(n.select(F.col(bucket).alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col(bucket).alias("b"), F.col("n").alias("nb")), "b").select("a", "b", "both", (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("jaccard"))


def qualifying(clusters: DataFrame, least: int = 3) -> DataFrame:
    """Clusters that ``least`` outlets carry: what a briefing is built for. An unknown number is none."""
    return clusters.filter(F.coalesce(F.col("n_outlets"), F.lit(0)) >= least)


def ordered_clusters(clusters: DataFrame, day: str = "day") -> DataFrame:
    """Adds ``rank`` within the day: more countries first, then more articles, then the lower cluster."""
    return clusters.withColumn("rank", F.row_number().over(W.partitionBy(day).orderBy(F.desc("n_countries"), F.desc("n_articles"), "cluster_id")).cast("long"))


def ordered_lineages(lineages: DataFrame, most: int) -> DataFrame:
    """The ``most`` longest lineages: more days first, then more countries, then the lower id."""
    return lineages.orderBy(F.desc("n_days"), F.desc("n_countries"), "lineage_id").limit(most)


def lineage_ids(clusters: DataFrame, lineages: DataFrame) -> DataFrame:
    """Adds ``lineage_id`` to clusters (day, cluster_id): that of the lineage that starts or last appeared there, else a new one.

    ``lineages``: lineage_id, seed_day, seed_cluster, latest_day, latest_cluster. Only these two ends are looked up; where
    several lineages have the same end, the greatest id counts. A new id is hashed from day and cluster.
    """
    ends = lineages.select("lineage_id", F.explode(F.array(F.struct(F.col("seed_day").alias("day"), F.col("seed_cluster").alias("cluster_id")), F.struct(F.col("latest_day").alias("day"), F.col("latest_cluster").alias("cluster_id")))).alias("e"))
    known = ends.select("lineage_id", "e.*").filter("day IS NOT NULL AND cluster_id IS NOT NULL").groupBy("day", "cluster_id").agg(F.max("lineage_id").alias("_known"))
    minted = F.concat(F.lit("L"), F.left(F.sha2(F.concat_ws("|", F.col("day").cast("string"), F.col("cluster_id").cast("string")), 256), F.lit(10)))
    return clusters.join(known, ["day", "cluster_id"], "left").withColumn("lineage_id", F.coalesce("_known", minted)).drop("_known")


def story_signals(stories: DataFrame, parts: dict[str, tuple[DataFrame, list[str]]], buckets: DataFrame, tilt: DataFrame) -> DataFrame:
    """``stories`` with every part that exists, as a struct of its name, or null: all are left joins.

    ``parts``: name -> (table of one row per key, the keys it joins on); a table without the story leaves null. ``tilt`` (bucket,
    outlet and figures) is kept for the buckets of each story (``buckets``: day, story, bucket) and comes as ``tilt``, an
    array by bucket and outlet: a story has a few.
    """
    out = stories
    for name, (table, keys) in parts.items():
        rest = [c for c in table.columns if c not in keys]
        out = out.join(table.select(*keys, F.struct(*rest).alias(name)), keys, "left")
    carried = buckets.select("day", "story", "bucket").distinct()
    used = tilt.join(carried, "bucket", "left_semi")
    figures = [c for c in tilt.columns if c not in ("bucket", "outlet")]
    each = carried.join(used, "bucket").groupBy("day", "story").agg(F.array_sort(F.collect_list(F.struct("bucket", "outlet", *figures))).alias("tilt"))
    return out.join(each, ["day", "story"], "left")


def persistent_themes(clusters: DataFrame, words: Column, least_countries: int = 8, least_days: int = 1) -> DataFrame:
    """(term, n_days): on how many days a word is in the title of a story that ``least_countries`` carry."""
    wide = clusters.filter(F.col("n_countries") >= least_countries).select("day", F.explode(words).alias("term")).distinct()
    return wide.groupBy("term").agg(F.count(F.lit(1)).alias("n_days")).filter(F.col("n_days") >= least_days)


def widest(clusters: DataFrame, most: int = 10, same: int = 40) -> DataFrame:
    """The ``most`` stories with most countries; titles that agree in ``same`` characters are one. Later days and titles first."""
    order = [F.desc("n_countries"), F.desc("day"), F.desc("title")]
    best = clusters.select("n_countries", "day", "title").distinct().withColumn("_r", F.row_number().over(W.partitionBy(F.left("title", F.lit(same))).orderBy(*order))).filter("_r = 1").drop("_r")
    return best.orderBy(*order).limit(most)
