"""URL filter: host/path rules first, then a listed-URL test in which a
blocked Bloom filter passes possible hits to an exact hash join.

DataFrame functions only.  The Bloom filter is itself a DataFrame, one row per
256-bit block, so neither the list nor the filter passes through the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlab.llm.common import ascii_lower, saved

BLOCK_BITS = 256
WORDS = 4              # 64-bit words of a block, two bits set in each
BITS_PER_URL = 16
BLOCK_BYTES = 64       # a block's row, with its key
BROADCAST_BYTES = 16 << 20


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str       # "allow" or "block"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; null or no ``://`` gives two empty strings."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    u = F.coalesce(url, F.lit(""))
    return ascii_lower(F.regexp_extract(u, pattern, 1)), F.regexp_extract(u, pattern, 2)


def canonical_url(url: Column) -> Column:
    """Scheme, ``www.``, default port, fragment, ``utm_`` parameters and a
    trailing slash dropped, host lower-cased; null without ``://``."""
    host, path = host_path(url)
    host = F.regexp_replace(F.regexp_replace(host, "^www[.]", ""), ":(80|443)$", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*[?]([^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, r"(^|&)utm_[^&]*", ""), "^&", "")
    tail = F.when(kept == "", F.lit("")).otherwise(F.concat(F.lit("?"), kept))
    out = F.concat(host, F.regexp_replace(path, "/+$", ""), tail)
    return F.when(F.coalesce(url, F.lit("")).contains("://"), out)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule as ``(rule, verdict)``, nulls if none fits."""
    name = verdict = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _block_and_masks(key: Column, blocks: int) -> list[Column]:
    bits = F.xxhash64(key, F.lit("bits"))

    def bit(i: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"),
                               F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int"))
    masks = [bit(2 * w).bitwiseOR(bit(2 * w + 1)).alias(f"__m{w}") for w in range(WORDS)]
    return [F.pmod(F.xxhash64(key), F.lit(blocks)).alias("__block"), *masks]


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter: ``__block`` and the OR of its URLs' masks in each word."""
    return (listed.select(*_block_and_masks(F.col(key), blocks)).groupBy("__block")
            .agg(*[F.bit_or(f"__m{w}").alias(f"__w{w}") for w in range(WORDS)]))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: Sequence[Rule] = (), url: str = "url") -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` added (columns of these
    names are replaced).

    ``listed`` has one column of canonical URLs (repeats and nulls allowed).
    A page that no rule fits is blocked if its canonical URL is listed, else
    allowed.  A null URL, or one without ``://``, is in no list: allowed unless
    a rule fits.  An empty list allows everything; repeated rows get the same
    verdict each.  The filter is broadcast only below ``BROADCAST_BYTES``
    (its size follows from the count of the list); above that the probe is a
    shuffle join on the block, and AQE splits a block that many rows share.
    """
    exact = saved(listed.toDF("__url").filter(F.col("__url").isNotNull()).distinct(), "url-list")
    n = exact.count()
    blocks = max(1, -(-n * BITS_PER_URL // BLOCK_BITS))
    bloom = saved(bloom_blocks(exact, "__url", blocks), "url-bloom")
    if blocks * BLOCK_BYTES <= BROADCAST_BYTES:
        bloom = F.broadcast(bloom)

    host, path = host_path(F.col(url))
    base = pages.withColumns({"host": host, "path": path})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    base = base.withColumns({"rule": rule, "verdict": verdict, "__url": canonical_url(F.col(url))})
    probes = _block_and_masks(F.col("__url"), blocks)
    probed = base.select("*", *probes).join(bloom, "__block", "left")
    hit = F.lit(True)
    for w in range(WORDS):
        hit = hit & (F.col(f"__m{w}").bitwiseAND(F.col(f"__w{w}")) == F.col(f"__m{w}"))
    possible = F.col("rule").isNull() & F.col("__url").isNotNull() & F.coalesce(hit, F.lit(False))
    helpers = ["__block", *[f"__m{w}" for w in range(WORDS)], *[f"__w{w}" for w in range(WORDS)]]
    probed = probed.withColumn("__possible", possible).drop(*helpers)

    passed = probed.filter(~F.col("__possible")).withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    hits = (probed.filter("__possible")
            .join(exact.withColumn("__listed", F.lit(True)).hint("shuffle_hash"), "__url", "left")
            .withColumn("verdict", F.when(F.col("__listed"), "block").otherwise("allow")).drop("__listed"))
    return passed.unionByName(hits).drop("__possible", "__url")
