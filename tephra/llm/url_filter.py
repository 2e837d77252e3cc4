"""URL verdicts: host rules first, then a list of canonical URLs behind a blocked Bloom filter.

The filter has one block of eight 64-bit words per listed-URL share; a URL sets one
bit in each word of its block. It is built by an aggregation over the list. Possible
hits go to an exact hash join with the list, which removes the false positives; the
other URLs never reach that join.

Null URLs and URLs without ``://`` have an empty host and path; no rule fits them and
no listed URL equals them, so they are allowed. Repeated rows are judged one by one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tephra.llm.common import setup, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rules of the contract: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Query parameters that do not change what a URL shows.
TRACKING = "^(?:utm_[^=]*|ref|fbclid|gclid)(?:=|$)"
WORDS = 8
URLS_PER_BLOCK = 32  # 16 bits a URL: about one false positive in a thousand
# A filter up to this size is broadcast; a larger one is joined by block number.
BROADCAST_BYTES = 32 << 20
BLOCK_BYTES = 8 * (WORDS + 2)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(None))


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical_of(url: Column) -> Column:
    """Host without a leading ``www.`` or ``m.``, path without closing slashes, sorted query without tracking."""
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(F.lit(""))
    host = F.regexp_replace(host_of(url), r"^(?:www|m)\.", "")
    path = F.regexp_replace(path_of(url), r"/++$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, tail))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct of the longest fitting rule and its verdict; null where none fits."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        own = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        best = F.when(fits, own).otherwise(best)
    return best


# ---- the blocked Bloom filter -------------------------------------------------------------


def _block(canonical: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(canonical), F.lit(n_blocks)).cast("long")


def _bit(canonical: Column, word: int) -> Column:
    """One bit of a word: six bits of a second hash."""
    picked = F.shiftrightunsigned(F.xxhash64(F.lit("bit"), canonical), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), picked.cast("int"))


def bloom_filter(listed: DataFrame, n_blocks: int) -> DataFrame:
    """``block, word_0 .. word_7`` of a list of canonical URLs (column ``canonical``)."""
    words = [F.bit_or(_bit(F.col("canonical"), w)).alias(f"word_{w}") for w in range(WORDS)]
    return listed.groupBy(_block(F.col("canonical"), n_blocks).alias("block")).agg(*words)


def possible_hits(urls: DataFrame, blocks: DataFrame, n_blocks: int) -> DataFrame:
    """The rows of ``urls`` (column ``canonical``) whose bits are all set."""
    if n_blocks * BLOCK_BYTES <= BROADCAST_BYTES:
        blocks = F.broadcast(blocks)
    joined = urls.withColumn("block", _block(F.col("canonical"), n_blocks)).join(blocks, "block")
    for w in range(WORDS):
        bit = _bit(F.col("canonical"), w)
        joined = joined.filter(F.col(f"word_{w}").bitwiseAND(bit) == bit)
    return joined.drop("block", *(f"word_{w}" for w in range(WORDS)))


def url_verdicts(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``id, host, path, rule, verdict, canonical`` for every row of ``pages``.

    ``listed`` holds blocked URLs in canonical form (its first column). A rule decides
    where one fits; else the verdict is ``block`` for listed URLs and ``allow`` for others.
    """
    setup(pages.sparkSession)
    listed = listed.select(F.col(listed.columns[0]).alias("canonical")).filter("canonical is not null").distinct()
    listed = written(listed, "url-list")
    n_blocks = max(1, -(-listed.count() // URLS_PER_BLOCK))
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.select("id", host_of(url).alias("host"), path_of(url).alias("path"), canonical_of(url).alias("canonical"))
    rows = rows.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select("id", "host", "path", "canonical", "r.*")
    # Hit URLs, once each: only these meet the list.
    asked = rows.filter("verdict is null and canonical is not null").select("canonical").distinct()
    passed = possible_hits(asked, bloom_filter(listed, n_blocks), n_blocks)
    hits = passed.join(listed, "canonical", "left_semi").withColumn("hit", F.lit(True))
    return rows.join(hits, "canonical", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.col("hit"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "canonical",
    )
