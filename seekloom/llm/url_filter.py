"""URL filter: a blocked Bloom filter before an exact join.

A list has entries of two kinds. A *rule* is a host and the beginning of a path with a verdict;
it fits its host and all subdomains. A *listed URL* is a canonical URL that is blocked itself.
Both are looked up by keys: the suffixes of a URL's host with the beginnings of its path that
have the length of some rule's path, and the canonical URL. The filter is a table of 64-bit
blocks; a key sets four bits of one block. A key whose bits are all set is a possible hit and
goes to the exact join on the key itself, which removes false positives. The filter is
broadcast while it has at most ``MAX_BROADCAST_BLOCKS`` blocks, and joined by block otherwise.

Of the rules that fit, the longest wins (host and path together; of equal ones, block). A URL
that no rule fits is blocked when it is listed, else allowed. Null URLs and URLs without
``://`` have empty host and path and are allowed. Rows may repeat; other columns stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_BLOCKS = 2_000_000
#: Bits of the filter per key.
KEY_BITS = 16
_SEED = 0x5BD1E995


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path up to ``?`` or ``#``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(after, r"^[^/?#]*(/[^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def canonical(host: Column, path: Column) -> Column:
    """One spelling of a URL: without ``www.`` or ``m.``, final slash and ``.html``."""
    return F.concat(F.regexp_replace(host, r"^(www|m)\.", ""), F.regexp_replace(path, r"(/|\.html)$", ""))


def rule_key(host: Column, path: Column) -> Column:
    return F.concat(F.lit("rule "), host, path)


def listed_key(canonical_url: Column) -> Column:
    return F.concat(F.lit("url "), canonical_url)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _mask(key: Column) -> Column:
    """Four bits of a block, from a second hash of the key."""
    second = F.xxhash64(key, F.lit(_SEED))
    mask = F.lit(0).cast("long")
    for k in range(4):
        bit = F.shiftrightunsigned(second, 6 * k).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    return mask


class BloomFilter:
    """A blocked Bloom filter of the keys of a table."""

    def __init__(self, keys: DataFrame):
        self.blocks = max(1, keys.count() * KEY_BITS // 64)
        key = F.col("key")
        self.table = keys.groupBy(_block(key, self.blocks).alias("block")).agg(F.bit_or(_mask(key)).alias("bits"))

    def possible(self, rows: DataFrame) -> DataFrame:
        """The rows whose ``key`` may be in the table; all that are, and few others."""
        table = F.broadcast(self.table) if self.blocks <= MAX_BROADCAST_BLOCKS else self.table
        joined = rows.withColumn("block", _block(F.col("key"), self.blocks)).join(table, "block")
        mask = _mask(F.col("key"))
        return joined.where(F.col("bits").bitwiseAND(mask) == mask).drop("block", "bits")


def _keys(urls: DataFrame, path_lengths: list[int], labels: int) -> DataFrame:
    """``(url, key)``: everything that is looked up for distinct ``(url, host, path)``."""
    parts = F.split("host", r"\.")
    counts = F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels))))
    suffixes = F.transform(counts, lambda n: F.array_join(F.slice(parts, -n, n), "."))
    lengths = F.filter(F.lit(path_lengths).cast("array<int>"), lambda n: n <= F.length("path"))
    prefixes = F.transform(lengths, lambda n: F.substring(F.col("path"), F.lit(1), n))
    rules = F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: rule_key(s, p))))
    keys = F.array_append(rules, listed_key(canonical(F.col("host"), F.col("path"))))
    return urls.where("host != ''").select("url", F.explode(keys).alias("key"))


def judge_urls(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """The rows with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``(host, path, verdict)``, ``listed`` has ``(canonical)``. The distinct
    lengths of the rules' paths and the most labels of a rule's host go to the driver.
    """
    entries = (
        rules.select(
            rule_key(F.col("host"), F.col("path")).alias("key"),
            F.concat(F.col("host"), F.col("path")).alias("entry"),
            F.col("verdict").alias("said"),
        )
        .unionByName(listed.distinct().select(listed_key(F.col("canonical")).alias("key"), F.lit(None).cast("string").alias("entry"), F.lit("block").alias("said")))
    )
    path_lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    labels = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 0
    host, path = host_and_path(F.col("url"))
    distinct = pages.select(F.col(url).alias("url")).where(F.col(url).isNotNull()).distinct()
    urls = distinct.select("url", host.alias("host"), path.alias("path"))
    possible = BloomFilter(entries.select("key")).possible(_keys(urls, path_lengths, labels))
    found = possible.join(entries, "key")
    # Rules come before listed URLs, longer ones before shorter ones, block before allow.
    weight = F.struct(F.coalesce(F.length("entry"), F.lit(-1)), F.col("said") == "block")
    best = found.groupBy("url").agg(F.max_by(F.struct("entry", "said"), weight).alias("best"))
    own_host, own_path = host_and_path(F.col(url))
    judged = pages.drop("host", "path", "rule", "verdict").withColumn("__url", F.col(url)).join(best.withColumnRenamed("url", "__url").withColumnRenamed("best", "__best"), "__url", "left")
    return judged.withColumns(
        {
            "host": own_host,
            "path": own_path,
            "rule": F.col("__best.entry"),
            "verdict": F.coalesce(F.col("__best.said"), F.lit("allow")),
        }
    ).drop("__url", "__best")
