"""Link frontier: edges, dedupe, and which URLs come next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.functions import urls
from seekloom.operators.joins import without_stored
from seekloom.operators.ordering import first_rows
from seekloom.session import cut_lineage



def queue_order():
    return [F.col("round"), F.col("seq")]


def link_edges(hrefs: DataFrame, suffixes: tuple[str, ...] = fv.FILE_SUFFIXES) -> DataFrame:
    """``hrefs(link, hrefs)`` -> ``(src, dst, pos)`` of the links that may be followed."""
    found = hrefs.select(F.col("link").alias("src"), F.posexplode("hrefs").alias("pos", "href"))
    bare = found.where(~urls.is_fragment(F.col("href"))).select(
        "src", "pos", urls.strip_fragment(F.col("href")).alias("href")
    )
    resolved = bare.select("src", urls.resolve_link(urls.base_url(F.col("src")), F.col("href")).alias("dst"), "pos")
    return resolved.where(urls.is_eligible(F.col("dst"), suffixes))


def earliest_links(found: DataFrame) -> DataFrame:
    """``found(url, *order)`` with each link once, at its earliest place."""
    order = [c for c in found.columns if c != "url"]
    if not order:
        return found.distinct()
    first = found.groupBy("url").agg(F.min(F.struct(*order)).alias("at"))
    return first.select("url", *[F.col(f"at.{c}").alias(c) for c in order])


def new_links(found: DataFrame, *known: DataFrame) -> DataFrame:
    """Links found, once each, that none of the known tables ``(url, ...)`` holds."""
    fresh = earliest_links(found)
    if not known:
        return fresh
    seen = known[0].select("url")
    for table in known[1:]:
        seen = seen.unionByName(table.select("url"))
    return without_stored(cut_lineage(fresh), seen, "url")


def within_host_cap(frontier: DataFrame, per_host: int) -> DataFrame:
    """The first ``per_host`` URLs of each host.

    Ranks are cut before the shuffle, so a host with most of the URLs sends few.
    """
    by_host = Window.partitionBy("base_url").orderBy("round", "seq")
    ranked = frontier.withColumn("base_url", urls.base_url(F.col("url"))).withColumn("_n", F.row_number().over(by_host))
    return ranked.where(F.col("_n") <= per_host).drop("_n", "base_url")


def next_batch(frontier: DataFrame, n: int) -> DataFrame:
    """The next ``n`` URLs of the queue."""
    return first_rows(frontier, n, *queue_order())


def room_left(max_pages: int, done: int) -> int:
    """How many pages may still be crawled."""
    return max(0, max_pages - done)
