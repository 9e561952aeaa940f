"""URL filters: a blocked Bloom filter in front of an exact hash join, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import join_counted, keep, prepare, with_row_key

# The rules of the registered query, as (host, path, verdict).
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
RULES_DDL = "host string, path string, verdict string"
# The verdict on a URL that no rule fits: it is not listed.
UNLISTED = "allow"
# A block has 8 words of 64 bits; an entry sets one bit in each word of one block.
WORDS = 8
BITS_PER_ENTRY = 16
# The filter is broadcast up to this many blocks (64 bytes each); a longer list meets the hashes in a join.
BROADCAST_BLOCKS = 1 << 17
# A list of at most this many rules is broadcast for the exact join.
BROADCAST_RULES = 20_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# How lengths and the verdict share one long, so that the longest rule is a maximum of numbers.
HOST_BITS = 24


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_host(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return lower_ascii(F.coalesce(rest, F.lit("")))


def url_path(url: Column) -> Column:
    """What follows the host, up to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """For each word of a block, the word with the entry's one bit set."""
    second = F.xxhash64(F.lit(7), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(second, 6 * i).bitwiseAND(63).cast("int")) for i in range(WORDS)]


def blocked_bloom(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter's blocks that are not empty: one row (block, w0..w7). Entries combine before the shuffle."""
    bits = listed.select(_block(F.col(key), blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(F.col(key)))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def _dense(spark: SparkSession, bloom: DataFrame, blocks: int) -> Column:
    """All words of all blocks in order, as one array value."""
    words = F.array(*[F.coalesce(F.col(f"w{i}"), F.lit(0).cast("long")) for i in range(WORDS)]).alias("words")
    every = spark.range(blocks).select(F.col("id").cast("int").alias("block")).join(bloom, "block", "left")
    laid = every.select(F.struct("block", words).alias("e")).agg(F.array_sort(F.collect_list("e")).alias("all"))
    return laid.select(F.flatten(F.col("all.words")).alias("words")).scalar()


def _may_hold(words: Column, key: Column, blocks: int) -> Column:
    at = _block(key, blocks) * WORDS
    tests = [F.get(words, at + i).bitwiseAND(bit) != 0 for i, bit in enumerate(_bits(key))]
    held = tests[0]
    for test in tests[1:]:
        held = held & test
    return held


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    unlisted: str = UNLISTED,
    broadcast_blocks: int = BROADCAST_BLOCKS,
    broadcast_rules: int = BROADCAST_RULES,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    ``rules`` has host, path (empty or from its first slash) and verdict (allow or block). A rule fits
    its host and all subdomains where the page's path starts with its own. The longest rule wins; of
    equally long ones the one with the longer host. Without a rule the verdict is ``unlisted``.

    A rule's key is its host and path in one text. A page has one possible key per shape, the number of
    labels and the length of path that some rule has; shapes come from the list and do not grow with the
    pages. Keys pass the blocked Bloom filter inside the row that makes them, so only possible hits
    become rows. An exact hash join with the list then removes false positives. A list within
    ``broadcast_rules`` is broadcast; in a longer one the keys that very many pages hit are broadcast (at
    most 1,000), and the others meet in a shuffled join. A filter beyond ``broadcast_blocks`` blocks is
    not broadcast: the keys meet its blocks in a shuffled join.

    Null URLs and those without :// have an empty host and path. Rules that differ in letter case of the
    host are one; where a rule is listed twice, block wins; rules with a null are left out, and a null
    verdict is no rule. Repeated rows and null identifiers are judged row by row; very long URLs are read
    whole; an empty table gives an empty result, an empty list fits nothing; other columns are not read.
    """
    spark = prepare(pages.sparkSession)
    key = F.concat(lower_ascii(F.col("host")), F.col("path"))
    listed = rules.where(F.col("verdict").isin("allow", "block")).select(
        lower_ascii(F.col("host")).alias("host"), "path", key.alias("key"), (F.col("verdict") == "block").cast("long").alias("blocked"))
    listed = keep(listed.where(F.col("key").isNotNull()).groupBy("key", "host", "path").agg(F.max("blocked").alias("blocked")))
    entries = listed.count()
    rows, put_back = with_row_key(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), "page_id", "row")
    shapes = listed.agg(F.collect_set(F.struct(_labels(F.col("host")).alias("labels"), F.length("path").alias("reach")))).scalar()
    parsed = rows.select(
        "row", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), shapes.alias("shapes"))
    # the last labels of the host, and the path as far as some rule reaches
    fits = F.filter("shapes", lambda s: (s["labels"] <= _labels(F.col("host"))) & (s["reach"] <= F.length("path")))
    tail = lambda s: F.call_function("substring_index", F.col("host"), F.lit("."), -s["labels"])
    head = lambda s: F.call_function("left", F.col("path"), s["reach"])
    rank = lambda s: ((F.length(tail(s)) + s["reach"]).cast("long") * F.lit(1 << HOST_BITS)) + F.length(tail(s))
    keys = F.transform(fits, lambda s: F.struct(F.concat(tail(s), head(s)).alias("key"), rank(s).alias("rank")))
    blocks = max(1, -(-entries * BITS_PER_ENTRY // (64 * WORDS)))
    bloom = blocked_bloom(listed, "key", blocks)
    if blocks <= broadcast_blocks:
        words = _dense(spark, bloom, blocks)
        probed = parsed.withColumn("words", words)
        probed = probed.withColumn("keys", F.filter(keys, lambda k: _may_hold(F.col("words"), k["key"], blocks)))
        hits = probed.select("row", "url", F.explode_outer("keys").alias("k")).select("row", "url", "k.*")
    else:
        every = parsed.select("row", "url", F.explode_outer(keys).alias("k")).select("row", "url", "k.*")
        bloom = keep(bloom)
        met = every.withColumn("block", _block(F.col("key"), blocks)).join(bloom, "block", "left")
        possible = F.lit(True)
        for i, bit in enumerate(_bits(F.col("key"))):
            possible = possible & (F.coalesce(F.col(f"w{i}"), F.lit(0).cast("long")).bitwiseAND(bit) != 0)
        # a page keeps one row without a key, so that it is not lost with its false candidates
        hits = met.where(possible).select("row", "url", "key", "rank").union(
            parsed.select("row", "url", F.lit(None).cast("string"), F.lit(None).cast("long")))
    exact = listed.select("key", "blocked")
    if entries <= broadcast_rules:
        confirmed = hits.join(F.broadcast(exact), "key", "left")
    else:
        hits = keep(hits)
        often = hits.where(F.col("key").isNotNull()).groupBy("key").agg(F.count("*").alias("n"))
        found = join_counted(hits.where(F.col("key").isNotNull()).select("key", "row", "url", "rank"), keep(exact.join(often, "key")), ["key"], "n")
        none = F.lit(None).cast("long")
        confirmed = found.select("row", "url", "rank", "blocked").union(parsed.select("row", "url", none, none))
    # the longest rule is a maximum over one number: length, host's length, verdict
    won = F.max(F.when(F.col("blocked").isNotNull(), F.col("rank") * 2 + F.col("blocked")))
    best = confirmed.groupBy("row", "url").agg(won.alias("won"))
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    best = best.select("row", host.alias("host"), path.alias("path"), "won")
    rank_won = F.shiftright("won", 1)
    in_host = rank_won.bitwiseAND((1 << HOST_BITS) - 1).cast("int")
    in_path = (F.shiftright(rank_won, HOST_BITS).cast("int") - in_host)
    rule = F.concat(F.call_function("right", F.col("host"), in_host), F.call_function("left", F.col("path"), in_path))
    verdict = F.when(F.col("won").isNull(), F.lit(unlisted)).when(F.col("won").bitwiseAND(1) == 1, "block").otherwise("allow")
    out = best.select(F.col("row").alias("page_id"), "host", "path", F.when(F.col("won").isNotNull(), rule).alias("rule"), verdict.alias("verdict"))
    return put_back(out, "page_id")


ORACLE = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id, rest, regexp_extract(coalesce(rest, ''), '^[^/?#]*') AS h FROM cut
), named AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(coalesce(rest, ''), length(h) + 1), '^[^?#]*') AS path,
         row_number() OVER () AS r
  FROM parsed
), rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path, h || p AS rule, coalesce(v, 'allow') AS verdict
FROM named LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC NULLS LAST, length(h) DESC) = 1
"""
