"""Link edges, frontier bookkeeping and the crawl."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.catalog import sql
from seekloom.catalog.registry import documents, pages, query, table
from seekloom.config import CrawlConfig
from seekloom.functions import urls
from seekloom.operators import frontier as fr
from seekloom.operators.html import parse_pages
from seekloom.plans.crawl import crawl, survey_pages
from seekloom.session import new_folder
from seekloom.sources.crawl_state import CrawlState, load_state, save_state, start_state


def _edges(spark: SparkSession, folder: str) -> DataFrame:
    return fr.link_edges(parse_pages(pages(spark, folder), "hrefs"))


def _frontier(spark: SparkSession, folder: str) -> DataFrame:
    """All links of the pages as a queue: one round per position on the page."""
    found = _edges(spark, folder).select(F.col("dst").alias("url"), "src", "pos")
    ids = pages(spark, folder).select(F.col("link").alias("src"), F.col("page_id").alias("seq"))
    queue = found.join(ids, "src").select("url", F.col("pos").alias("round"), "seq")
    return fr.new_links(queue)


_FRONTIER = (
    f"{sql.EDGES}, frontier AS (SELECT url, min({{'round': pos, 'seq': page_id}}) AS place FROM "
    "(SELECT dst AS url, pos, page_id FROM edges JOIN pages ON url = src) GROUP BY url), "
    "queue AS (SELECT url, place.round AS round, place.seq AS seq FROM frontier)"
)


@query("link_edges", f"WITH {sql.EDGES} SELECT src, dst, pos FROM edges")
def link_edges(spark: SparkSession, folder: str) -> DataFrame:
    return _edges(spark, folder).withColumn("pos", F.col("pos").cast("long"))


@query(
    "new_frontier_links",
    f"WITH {sql.EDGES} SELECT DISTINCT dst AS url FROM edges WHERE dst NOT IN "
    "(SELECT dst FROM edges WHERE contains(src, '/fr/'))",
)
def new_frontier_links(spark: SparkSession, folder: str) -> DataFrame:
    edges = _edges(spark, folder)
    known = edges.where(F.col("src").contains("/fr/")).select(F.col("dst").alias("url"))
    return fr.new_links(edges.select(F.col("dst").alias("url")), known)


@query(
    "links_within_host_cap",
    f"WITH {_FRONTIER} SELECT url, round, seq FROM queue "
    f"QUALIFY row_number() OVER (PARTITION BY {sql.base_url('url')} ORDER BY round, seq, url) <= 5",
)
def links_within_host_cap(spark: SparkSession, folder: str) -> DataFrame:
    return fr.within_host_cap(_frontier(spark, folder), 5).withColumn("round", F.col("round").cast("long"))


@query("next_links", f"WITH {_FRONTIER} SELECT url FROM queue ORDER BY round, seq LIMIT 50")
def next_links(spark: SparkSession, folder: str) -> DataFrame:
    return fr.next_batch(_frontier(spark, folder), 50).select("url")


@query(
    "links_until_size_cap",
    f"WITH {_FRONTIER} SELECT url FROM queue ORDER BY round, seq LIMIT (SELECT 1000 - count(*) FROM pages WHERE url LIKE '%/en/%')",
)
def links_until_size_cap(spark: SparkSession, folder: str) -> DataFrame:
    done = pages(spark, folder).where(F.col("link").contains("/en/")).count()
    return fr.next_batch(_frontier(spark, folder), fr.room_left(1000, done)).select("url")


@query("crawl_state_round_trip", f"WITH {_FRONTIER} SELECT 'frontier' AS part, url FROM queue "
       "UNION ALL SELECT 'rejected', url FROM pages WHERE url LIKE '%/fr/%' "
       "UNION ALL SELECT 'done', url FROM pages WHERE url LIKE '%/en/%'")
def crawl_state_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    links = pages(spark, folder).select(F.col("link").alias("url"))
    rejected = links.where(F.col("url").contains("/fr/")).withColumn("reason", F.lit("language"))
    queue = _frontier(spark, folder)
    path = new_folder(spark, "crawl")
    save_state(CrawlState(queue.unionByName(queue), rejected, links.where(F.col("url").contains("/en/"))), path)
    state = load_state(spark, path, queue)
    parts = [
        table.select(F.lit(name).alias("part"), "url")
        for name, table in (("frontier", state.frontier), ("rejected", state.rejected), ("done", state.done))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def document_web(spark: SparkSession, folder: str) -> DataFrame:
    """``(link, html)``: every document as a page that links to five others."""
    texts = documents(spark, folder)
    n = texts.agg(F.count("*").alias("n")).scalar()
    doc = F.col("doc_id")

    def anchor(target) -> F.Column:
        return F.concat(F.lit('<a href="/d/'), target.cast("string"), F.lit('"></a>'))

    return texts.select(
        F.concat(F.lit("https://docs.example.org/d/"), doc).alias("link"),
        F.concat(
            F.lit('<html lang="'),
            F.col("lang"),
            F.lit('"><body><p>'),
            F.translate("text", "<>&", "   "),
            F.lit("</p>"),
            anchor(doc * 2 + 1),
            anchor(doc * 2 + 2),
            anchor((doc * 7 + 3) % n),
            anchor((doc * 31 + 11) % n),
            anchor((doc * 101 + 29) % n),
            F.lit('<a href="#top"></a><a href="/file.pdf"></a></body></html>'),
        ).alias("html"),
    )


_LANGUAGES = ("en", "fr")
_PASSED = (
    f"judged AS (SELECT doc_id, lang IN ('en', 'fr') OR coalesce({sql.detected('w')} IN ('en', 'fr'), false) AS passed FROM "
    f"(SELECT doc_id, lang, {sql.LANGUAGE_WORDS.format(e='text')} AS w FROM documents)), "
    "seeds AS (SELECT doc_id FROM documents WHERE source = 'src1'), "
    "reached(doc_id) AS (SELECT doc_id FROM seeds UNION SELECT unnest([r.doc_id * 2 + 1, r.doc_id * 2 + 2, "
    "(r.doc_id * 7 + 3) % n, (r.doc_id * 31 + 11) % n, (r.doc_id * 101 + 29) % n]) FROM (SELECT count(*) AS n FROM documents), reached r JOIN judged j USING (doc_id) WHERE passed)"
)


def _crawl(spark: SparkSession, folder: str, **limits) -> CrawlState:
    config = CrawlConfig(languages=_LANGUAGES, required_keywords=("",), blocked_domains=(), **limits)
    web = document_web(spark, folder)
    seeds = table(spark, folder, "documents").where(F.col("source") == "src1").select(
        F.concat(F.lit("https://docs.example.org/d/"), "doc_id").alias("url"),
        F.lit(0).alias("round"),
        F.col("doc_id").alias("seq"),
    )
    return crawl(spark, start_state(spark, seeds), survey_pages(web, config), config)


@query(
    "multi_hop_crawl",
    f"WITH RECURSIVE {_PASSED} SELECT 'https://docs.example.org/d/' || doc_id AS url, "
    "coalesce(passed, false) AS crawled FROM reached LEFT JOIN judged USING (doc_id)",
)
def multi_hop_crawl(spark: SparkSession, folder: str) -> DataFrame:
    state = _crawl(spark, folder)
    return state.done.withColumn("crawled", F.lit(True)).unionByName(
        state.rejected.select("url", F.lit(False).alias("crawled"))
    )
