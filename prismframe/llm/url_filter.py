"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join of its possible hits.

The filter is itself a table: one row per block with 256 bits in four BIGINTs, built by a distributed ``bit_or``. A URL
touches a single block, so probing is one equi-join on the block number and a mask test, all in generated code; Catalyst
broadcasts the blocks if their written size allows and shuffles block numbers otherwise. Survivors meet the list itself
by exact string equality, which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, cut, table

WORDS, BITS_A_KEY = 4, 8
#: Query parameters that name a campaign or a referrer, not a page.
TRACKING = r"[?&](?:utm_[a-z]+|ref|src|fbclid|gclid|cid|share)=[^&#]*"
#: (pattern, replacement) in order, on the URL with its scheme and host in lower case; the same in Java and RE2.
CANONICAL = (
    (r"#.*$", ""),
    (TRACKING, "&"),
    (r"&+", "&"),
    (r"[?&]+$", ""),
    (r"^([^?&]*)&", r"\1?"),
    (r"\?&", "?"),
    (r"^[a-z][a-z0-9+.-]*://(?:[^/?]*@)?", ""),
    (r"^(?:www\.)?(?:m\.|mobile\.)?", ""),
    (r"^([^/?]*):(?:80|443)([/?]|$)", r"\1\2"),
    (r"/+(\?|$)", r"\1"),
)
AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*"


def canonical_url(url: Column) -> Column:
    """Host and path without scheme, ``www.``/``m.``, default port, tracking parameters, fragment and trailing slash."""
    trimmed = F.trim(url)
    head = F.regexp_extract(trimmed, AUTHORITY, 0)
    text = F.concat(F.lower(head), F.substring(trimmed, F.length(head) + 1, F.lit(2_000_000_000)))
    for pattern, by in CANONICAL:
        text = F.regexp_replace(text, pattern, by.replace("\\", "$"))
    return text


def _masks(key: Column) -> list[Column]:
    """Four words with the key's bits: eight 8-bit slices of a second hash choose eight of 256 positions."""
    spread = F.xxhash64(F.lit("bits"), key)
    at = [F.shiftrightunsigned(spread, 8 * i).bitwiseAND(F.lit(255)) for i in range(BITS_A_KEY)]
    words = []
    for w in range(WORDS):
        word = F.lit(0).cast("long")
        for p in at:
            word = word.bitwiseOR(F.when(F.shiftright(p, 6) == w, F.call_function("shiftleft", F.lit(1).cast("long"), p.bitwiseAND(F.lit(63)).cast("int"))).otherwise(F.lit(0).cast("long")))
        words.append(word)
    return words


def bloom_blocks(listed: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """``block`` and ``w0``..``w3``: the filter's blocks that hold any bit."""
    hashed = listed.select(F.pmod(F.xxhash64(key), F.lit(n_blocks)).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return hashed.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(pages: DataFrame, listed: DataFrame, id_col: str = "page_id", url_col: str = "url", listed_col: str = "url", keys_a_block: int = 16) -> DataFrame:
    """The rows of ``pages`` whose canonical URL is listed: id, url, ``canonical``.

    ``listed`` holds URLs in any form; they are made canonical and distinct first. Null and empty URLs match nothing, on
    either side. Repeated page rows all come back. An empty list gives no rows. ``keys_a_block`` 16 with 8 bits each in
    256 bits lets about 3 in 1,000 unlisted URLs through to the exact join. An empty table gives an empty one; very long URLs
    are used whole; of URLs with one canonical form all match. Other columns are not read, so no names clash.
    """
    keys = cut(listed.select(canonical_url(col(listed_col)).alias("canonical")).filter("canonical <> ''").distinct())
    n_blocks = max(1, keys.count() // keys_a_block)
    blocks = cut(bloom_blocks(keys, "canonical", n_blocks))
    read = pages.select(col(id_col).alias("id"), col(url_col).alias("url"), canonical_url(col(url_col)).alias("canonical")).filter("canonical <> ''")
    probe = read.withColumn("block", F.pmod(F.xxhash64("canonical"), F.lit(n_blocks))).join(blocks, "block")
    for i, m in enumerate(_masks(F.col("canonical"))):
        probe = probe.filter(F.col(f"w{i}").bitwiseAND(m) == m)
    exact = probe.select("id", "url", "canonical").join(keys, "canonical", "left_semi")
    return exact.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "canonical")


#: A list as an abuse feed would give it: every address seen on these hosts.
LISTED_HOSTS = r"://(?:www\.|m\.)?(?:spam-farm|cheap-pills|casino)[^/?#]*"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return filter_urls(pages, pages.filter(F.lower("url").rlike(LISTED_HOSTS)).select("url"))


def _sql() -> str:
    text = f"lower(regexp_extract(trim(url), '{AUTHORITY}')) || substring(trim(url), length(regexp_extract(trim(url), '{AUTHORITY}')) + 1)"
    for pattern, by in CANONICAL:
        text = f"regexp_replace({text}, '{pattern}', '{by}', 'g')"
    return f"""
WITH c AS (SELECT page_id, url, {text} AS canonical FROM pages),
listed AS (SELECT DISTINCT canonical FROM c WHERE canonical <> '' AND regexp_matches(lower(url), '{LISTED_HOSTS}'))
SELECT page_id, url, canonical FROM c WHERE canonical IN (SELECT canonical FROM listed)"""


SQL = _sql()
