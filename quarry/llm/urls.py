"""URL filter: blocked Bloom filter of listed canonical URLs, then an exact hash join
(DataFrame functions only).

The filter is a table of blocks of eight 32-bit words, built with ``bit_or``; a URL sets,
or needs, one bit in each word of one block. Only URLs whose bits are all set go to the
exact join, which removes the false positives. Rules on host and path prefix overrule
the list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_URL = 16
BLOCK_BITS = 256
#: the filter is broadcast up to this many blocks (about 80 bytes each, 16 MB)
BROADCAST_BLOCKS = 200_000


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, url path starting with ``path``."""

    host: str
    path: str
    verdict: str


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty
    for null or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty for null or without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """``host/path?query``: host lower-cased, without scheme, leading ``www.``, default
    port, fragment, ``utm_*`` parameters and trailing slash. Null has none (null)."""
    host = F.regexp_replace(F.regexp_replace(url_host(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(url_path(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_")), "&")
    return F.when(url.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule as 'host' + 'path', verdict) of the longest fitting rule, both null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host) + len(r.path), len(r.host))):  # the last one tested wins
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _block(url: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), url), F.lit(blocks))


def _bit(url: Column, word: int) -> Column:
    """The int with the one bit that ``url`` sets in ``word``: 5 bits of its second hash."""
    five = F.shiftrightunsigned(F.xxhash64(F.lit("bits"), url), 5 * word).bitwiseAND(F.lit(31)).cast("int")
    return F.call_function("shiftleft", F.lit(1), five)


def bloom_filter(listed: DataFrame, url: str, blocks: int) -> DataFrame:
    """(block, w0..w7) of the URLs in column ``url``; at most ``blocks`` rows."""
    u = F.col(url)
    rows = listed.select(_block(u, blocks).alias("block"), *[_bit(u, i).alias(f"w{i}") for i in range(8)])
    return rows.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(8)])


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule], *, key: str = "page_id",
                url: str = "url") -> DataFrame:
    """(key, host, path, canonical, rule, listed, verdict) for every row of ``pages``.

    ``listed`` has a column ``url``; a page is listed if the canonical forms agree. The
    verdict is that of the longest fitting rule, else ``block`` for a listed page and
    ``allow`` for others. A null url, or one without ``://``, has empty host and path,
    fits no rule with a host and is listed only if its canonical form is; null is never
    listed. Repeated pages give repeated rows; empty tables on either side are fine; other
    columns of ``pages`` are not carried.
    """
    blocked = listed.select(canonical_url(F.col("url")).alias("canonical")).where("canonical is not null").distinct()
    blocks = max(1, -(-blocked.count() * BITS_PER_URL // BLOCK_BITS))
    bloom = bloom_filter(blocked, "canonical", blocks).withColumnRenamed("block", "_block")
    if blocks <= BROADCAST_BLOCKS:
        bloom = F.broadcast(bloom)  # else a shuffled join on the block
    u = F.col("_url")
    rows = pages.select(F.col(key).alias("_id"), F.col(url).cast("string").alias("_url"))
    rows = rows.select("_id", url_host(u).alias("host"), url_path(u).alias("path"), canonical_url(u).alias("canonical"))
    name, verdict = rule_for(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", name).withColumn("_ruled", verdict)
    probe = rows.withColumn("_block", _block(F.coalesce("canonical", F.lit("")), blocks)).join(bloom, "_block", "left")
    possible = F.lit(True)
    for i in range(8):
        bit = _bit(F.col("canonical"), i)
        possible = possible & (F.col(f"w{i}").bitwiseAND(bit) == bit)
    probe = probe.withColumn("_maybe", F.coalesce(possible, F.lit(False))).drop("_block", *[f"w{i}" for i in range(8)])
    # a second key: on the bare one the list would stay as its distinct dealt it, and Spark splits
    # a hot address only if both sides are dealt for the join
    spread = F.xxhash64("canonical").alias("_spread")
    exact = blocked.select("canonical", spread, F.lit(True).alias("listed"))
    hits = probe.where("_maybe").select("*", spread).join(exact, ["canonical", "_spread"], "left").drop("_spread")
    rest = probe.where("not _maybe").withColumn("listed", F.lit(False))
    return hits.unionByName(rest).select(
        F.col("_id").alias(key), "host", "path", "canonical", "rule", F.coalesce("listed", F.lit(False)).alias("listed"),
        F.coalesce("_ruled", F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"))
