"""URL functions, robots rules and link predicates over page URLs and links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.catalog import sql
from seekloom.catalog.registry import pages, query, table
from seekloom.functions import urls
from seekloom.operators.html import anchor_links
from seekloom.operators.robots import robots_rules, with_robots


def _hrefs(spark: SparkSession, folder: str) -> DataFrame:
    found = pages(spark, folder).select("link", F.posexplode(anchor_links(F.col("html"))).alias("pos", "href"))
    return found.withColumn("pos", F.col("pos").cast("long"))


@query("url_domains", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS domain FROM pages")
def url_domains(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", urls.domain(F.col("link")).alias("domain"))


@query("url_bases", f"SELECT page_id, {sql.base_url('url')} AS base_url FROM pages")
def url_bases(spark: SparkSession, folder: str) -> DataFrame:
    return pages(spark, folder).select("page_id", urls.base_url(F.col("link")).alias("base_url"))


@query(
    "resolve_links",
    f"WITH {sql.EDGES} SELECT src AS link, pos, href, {sql.base_url('src')} || href AS resolved FROM hrefs",
)
def resolve_links(spark: SparkSession, folder: str) -> DataFrame:
    resolved = urls.resolve_link(urls.base_url(F.col("link")), F.col("href"))
    return _hrefs(spark, folder).select("link", "pos", "href", resolved.alias("resolved"))


@query(
    "resolve_parent_links",
    "SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/b/c' || page_id AS resolved FROM pages",
)
def resolve_parent_links(spark: SparkSession, folder: str) -> DataFrame:
    link = F.concat(F.lit("../a/./../b/x/../c"), F.col("page_id"))
    return pages(spark, folder).select(
        "page_id", urls.resolve_link(urls.base_url(F.col("link")), link).alias("resolved")
    )


@query(
    "strip_fragments",
    "SELECT page_id, string_split(url, '#')[1] AS link FROM pages WHERE NOT starts_with(url, '#')",
)
def strip_fragments(spark: SparkSession, folder: str) -> DataFrame:
    kept = pages(spark, folder).where(~urls.is_fragment(F.col("link")))
    return kept.select("page_id", urls.strip_fragment(F.col("link")).alias("link"))


_SUFFIX_LIST = ", ".join(sql.text(s) for s in fv.FILE_SUFFIXES)


@query(
    "eligible_links",
    "WITH links AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN url || '.pdf' WHEN 1 THEN 'mailto:' || url "
    "WHEN 2 THEN url || '.PDF' ELSE url END AS link FROM pages) SELECT page_id, link FROM links "
    "WHERE starts_with(link, 'http') AND NOT (contains(link, '.') AND "
    f"list_contains([{_SUFFIX_LIST}], string_split(link, '.')[-1]))",
)
def eligible_links(spark: SparkSession, folder: str) -> DataFrame:
    link = F.expr(
        "case page_id % 4 when 0 then concat(link, '.pdf') when 1 then concat('mailto:', link) "
        "when 2 then concat(link, '.PDF') else link end"
    )
    links = pages(spark, folder).select("page_id", link.alias("link"))
    return links.where(urls.is_eligible(F.col("link")))


@query(
    "scheme_filter",
    "SELECT page_id, url FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN 'ftp' || substr(url, 5) ELSE url END AS url "
    "FROM pages) WHERE url LIKE 'http%'",
)
def scheme_filter(spark: SparkSession, folder: str) -> DataFrame:
    url = F.expr("if(page_id % 3 = 0, concat('ftp', substr(url, 5)), url)")
    links = table(spark, folder, "pages").select("page_id", url.alias("url"))
    return links.where(urls.has_http_scheme(F.col("url")))


_DOMAIN_LIST = " OR ".join(f"contains(url, {sql.text(d)})" for d in fv.BLOCKED_DOMAINS)


@query(
    "blocked_domains",
    "SELECT page_id, url FROM (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url || '/?via=youtube.com' ELSE url END "
    f"AS url FROM pages) WHERE NOT ({_DOMAIN_LIST})",
)
def blocked_domains(spark: SparkSession, folder: str) -> DataFrame:
    url = F.expr("if(page_id % 3 = 0, concat(url, '/?via=youtube.com'), url)")
    links = table(spark, folder, "pages").select("page_id", url.alias("url"))
    return links.where(~urls.is_blocked(F.col("url")))


@query(
    "robots_filter",
    # Every host forbids /fr and all below /es but /es/1..., and one in two forbids /en/9... as well.
    f"SELECT page_id, url, NOT (path LIKE '/fr%' OR (path LIKE '/es%' AND path NOT LIKE '/es/1%') "
    "OR (length(base) % 2 = 0 AND path LIKE '/en/9%')) AS allowed FROM "
    f"(SELECT page_id, url, {sql.base_url('url')} AS base, regexp_extract(url, '^[a-z]+://[^/?#]*([^#]*)', 1) AS path "
    "FROM pages)",
)
def robots_filter(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "pages").select("page_id", "url")
    body = F.concat(
        F.lit("User-agent: other\nDisallow: /\n\nUser-agent: *\nDisallow: /fr\nAllow: /es/1\nDisallow: /es\n"),
        F.when(F.length("base_url") % 2 == 0, "Disallow: /en/9 # old\n").otherwise(""),
        F.lit("\nUser-agent: *\nDisallow: /\n"),
    )
    hosts = links.select(urls.base_url(F.col("url")).alias("base_url")).distinct().withColumn("body", body)
    return with_robots(links, robots_rules(hosts)).select("page_id", "url", "allowed")


@query(
    "valid_addresses",
    "SELECT event_id, address, event_id % 4 IN (0, 3) AND user_id <= 255 AS valid FROM (SELECT event_id, user_id, "
    "CASE event_id % 4 WHEN 0 THEN '10.0.0.' || user_id WHEN 1 THEN '10.0.' || user_id "
    "WHEN 2 THEN '2001:db8::' || user_id || '::1' ELSE '2001:db8::' || (user_id % 256) END AS address FROM events)",
)
def valid_addresses(spark: SparkSession, folder: str) -> DataFrame:
    address = F.expr(
        "case event_id % 4 when 0 then concat('10.0.0.', user_id) when 1 then concat('10.0.', user_id) "
        "when 2 then concat('2001:db8::', user_id, '::1') else concat('2001:db8::', user_id % 256) end"
    )
    rows = table(spark, folder, "events").select("event_id", "user_id", address.alias("address"))
    return rows.select("event_id", "address", urls.is_valid_ip(F.col("address")).alias("valid"))


@query(
    "join_skipping_nulls",
    "SELECT doc_id, concat_ws(' ', CASE WHEN n_chars % 2 = 0 THEN lang END, source, n_chars::VARCHAR) AS joined "
    "FROM documents",
)
def join_skipping_nulls(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents")
    lang = F.when(F.col("n_chars") % 2 == 0, F.col("lang"))
    return rows.select("doc_id", urls.safe_join(lang, F.col("source"), F.col("n_chars")).alias("joined"))


@query(
    "null_to_empty",
    "SELECT doc_id, coalesce(CASE WHEN n_chars % 2 = 0 THEN n_chars::VARCHAR END, '') AS value FROM documents",
)
def null_to_empty(spark: SparkSession, folder: str) -> DataFrame:
    value = F.when(F.col("n_chars") % 2 == 0, F.col("n_chars"))
    return table(spark, folder, "documents").select("doc_id", urls.safe_str(value).alias("value"))
