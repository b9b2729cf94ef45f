"""Crawl over a page table: hop by hop from seeds, with all filters."""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import schemas
from seekloom.config import CrawlConfig
from seekloom.functions import urls
from seekloom.operators import frontier as fr
from seekloom.operators.filters import url_reject_reason, with_reject_reason
from seekloom.operators.html import parse_pages
from seekloom.operators.joins import BROADCAST_BYTES, lookup_join, row_bytes, without_stored
from seekloom.operators.robots import robots_rules, with_robots
from seekloom.session import cut_lineage, new_folder
from seekloom.sources.crawl_state import CrawlState

_VISITED = "url string, reason string"


@dataclass(frozen=True)
class Web:
    """What a crawl needs to know of each page, worked out once for all hops."""

    verdicts: DataFrame
    edges: DataFrame


def survey_pages(pages: DataFrame, config: CrawlConfig = CrawlConfig()) -> Web:
    """``pages(link, html)`` -> a verdict per page and its outgoing links, in one HTML walk."""
    parsed = parse_pages(pages, "lang", "xml_lang", "has_html", "page_text", "hrefs")
    judged = with_reject_reason(parsed, config)
    facts = cut_lineage(judged.select("link", "reason", "hrefs"))
    edges = fr.link_edges(facts.where(F.col("reason").isNull()), config.file_suffixes)
    return Web(facts.select(F.col("link").alias("url"), "reason"), cut_lineage(edges))


def _visit(batch: DataFrame, web: Web, rules: DataFrame | None, config: CrawlConfig, small: bool) -> DataFrame:
    """``(url, round, seq, reason)`` of a batch; a URL without a page is empty."""
    checked = batch.withColumn("allowed", F.lit(True)) if rules is None else with_robots(batch, rules)
    verdicts = web.verdicts.withColumn("found", F.lit(True))
    found = lookup_join(verdicts, batch.select("url"), ["url"], "left_semi", small=small)
    reason = F.coalesce(
        url_reject_reason(F.col("url"), F.col("allowed"), config),
        F.when(F.col("found").isNull(), "empty").otherwise(F.col("reason")),
    )
    return checked.join(found, "url", "left").select("url", "round", "seq", reason.alias("reason"))


def crawl(
    spark: SparkSession,
    state: CrawlState,
    web: Web,
    config: CrawlConfig = CrawlConfig(),
    robots: DataFrame | None = None,
) -> CrawlState:
    """Follow links from the frontier until it is empty, or a limit that is set is reached.

    ``finished`` of the state tells which. A hop takes the queue, or the next URLs of it as
    far as limits are set. URLs that the
    host limit held back move behind the rest of the queue, and new links behind
    those. The loop runs once per hop; every table stays distributed, and each
    hop's tables are stored, so a lost executor does not cost earlier hops.
    """
    rules = None if robots is None else cut_lineage(robots_rules(robots))
    visited_path = new_folder(spark, "visited")
    before = state.done.select("url", F.lit(None).cast("string").alias("reason")).unionByName(
        state.rejected.select("url", "reason")
    )
    before.write.parquet(f"{visited_path}/hop=-1")
    known = spark.read.schema(_VISITED).parquet(f"{visited_path}/hop=-1")
    queue = cut_lineage(without_stored(state.frontier, known, "url"))
    done = known.where(F.col("reason").isNull()).count()
    hop = state.frontier.agg(F.coalesce(F.max("round"), F.lit(0)).alias("r")).first()["r"]
    for step in itertools.count() if config.max_hops is None else range(config.max_hops):
        room = None if config.max_pages is None else fr.room_left(config.max_pages, done)
        sizes = [n for n in (config.batch_size, room) if n is not None]
        if 0 in sizes:
            break
        open_urls = queue if config.per_host is None else fr.within_host_cap(queue, config.per_host)
        batch = cut_lineage(fr.next_batch(open_urls, min(sizes)) if sizes else open_urls)
        facts = batch.agg(
            F.count("*").alias("n"),
            F.sum(row_bytes(batch).cast("long")).alias("bytes"),
            F.max(F.struct("round", "seq")).alias("last"),
        ).first()
        if facts["n"] == 0:
            break
        small = facts["bytes"] <= BROADCAST_BYTES
        folder = f"{visited_path}/hop={step}"
        _visit(batch, web, rules, config, small).write.parquet(folder)
        visited = spark.read.schema("url string, round int, seq bigint, reason string").parquet(folder)
        passed = visited.where(F.col("reason").isNull()).select("url", "round", "seq")
        done += passed.count()
        known = spark.read.schema(_VISITED).parquet(visited_path).select("url", "reason")

        links = web.edges.withColumnRenamed("src", "url")
        found = lookup_join(links, passed, ["url"], "inner", small=small).select(
            F.col("dst").alias("url"), "round", "seq", "pos"
        )
        fresh = fr.new_links(found, known, queue)
        waiting = queue.join(F.broadcast(batch.select("url")) if small else batch.select("url"), "url", "left_anti")
        last = facts["last"]
        held_back = (F.col("round") < last["round"]) | (
            (F.col("round") == last["round"]) & (F.col("seq") < last["seq"])
        )
        hop += 1
        appended = (
            waiting.where(held_back)
            .select("url", "round", "seq", F.lit(0).alias("pos"), F.lit(0).alias("kind"))
            .unionByName(fresh.withColumn("kind", F.lit(1)))
            .orderBy("kind", "round", "seq", "pos")
            .select("url", F.lit(hop).alias("round"), F.monotonically_increasing_id().alias("seq"))
        )
        queue = cut_lineage(waiting.where(~held_back).unionByName(appended).select("url", "round", "seq"))
    return CrawlState(
        queue,
        known.where(F.col("reason").isNotNull()),
        known.where(F.col("reason").isNull()).select("url"),
    )


def discovered(state: CrawlState) -> DataFrame:
    """URLs that were crawled with success."""
    return state.done.select("url")
