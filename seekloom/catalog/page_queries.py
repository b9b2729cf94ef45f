"""Page store, HTML fields and page filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.catalog import sql
from seekloom.catalog.registry import documents, pages, query, table
from seekloom.config import CrawlConfig
from seekloom.functions import language as lg
from seekloom.functions import text as tx
from seekloom.operators import filters as fl
from seekloom.operators import html as hw
from seekloom.operators import index as ix
from seekloom.plans.build import parsed_documents
from seekloom.session import new_folder
from seekloom.sources.pages import one_per_link, read_pages, read_vectors, write_pages

_COPIES = "copies AS (SELECT page_id, string_split(url, '#')[1] AS link, html FROM pages UNION ALL SELECT page_id + 1000000, string_split(url, '#')[1], NULL FROM pages)"


@query("one_page_per_link", f"WITH {_COPIES} SELECT link, min(page_id) AS page_id FROM copies WHERE html IS NOT NULL GROUP BY link")
def one_page_per_link(spark: SparkSession, folder: str) -> DataFrame:
    bare = pages(spark, folder).withColumn("link", F.substring_index("link", "#", 1))
    empty = bare.withColumn("page_id", F.col("page_id") + 1000000).withColumn("html", F.lit(None).cast("string"))
    return one_per_link(bare.unionByName(empty), F.col("page_id")).select("link", "page_id")


@query("stored_pages", "SELECT url AS link, length(html) AS n_chars FROM pages WHERE html IS NOT NULL")
def stored_pages(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "pages")
    write_pages(pages(spark, folder).where(F.col("link").contains("/en/")), path)
    write_pages(pages(spark, folder), path, stored=read_pages(spark, path))
    return read_pages(spark, path).select("link", F.length("html").cast("long").alias("n_chars"))


@query(
    "document_rows",
    f"SELECT page_id AS doc_id, url AS link, {sql.TITLE} AS title, '' AS description, 'no summary' AS summary FROM pages",
)
def document_rows(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsed_documents(pages(spark, folder), doc_id="page_id")
    return ix.documents_table(parsed, F.col("doc_id")).withColumn("title", tx.clean_text(F.col("title")))


def _walked(name: str, field: str, expression: str) -> None:
    @query(name, f"SELECT page_id, {expression} AS {field} FROM pages")
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return hw.parse_pages(pages(spark, folder), field).select("page_id", field)


_walked("page_titles", "title", sql.unescape("regexp_extract(html, '(?s)<title>(.*?)</title>', 1)"))
_walked("meta_descriptions", "description", "regexp_extract(html, '<meta name=\"description\" content=\"([^\"]*)\"', 1)")
_walked("main_tags", "main_tag", "CASE WHEN html LIKE '%<article>%' THEN 'article' END")
_walked("main_texts", "main_text", sql.MAIN_TEXT)

_BODY = "regexp_extract(html, '(?s)<body>(.*?)(?:</body>|\\z)', 1)"
_BODY_SEEN = sql.remove(_BODY, "(?s)<!--.*?-->", "<>")
_BODY_TEXT = (
    f"array_to_string(list_transform(string_split_regex({_BODY_SEEN}, '<[^>]*>'), "
    f"lambda p: {sql.unescape(sql.remove('p', r'^\s+|\s+$'))}), '')"
)
_walked("body_texts", "body_text", _BODY_TEXT)


@query("lowercase_page_texts", f"SELECT page_id, lower({sql.PAGE_TEXT}) AS text FROM pages")
def lowercase_page_texts(spark: SparkSession, folder: str) -> DataFrame:
    return hw.parse_pages(pages(spark, folder), "page_text").select("page_id", F.lower("page_text").alias("text"))


@query("block_texts")
def block_texts(spark: SparkSession, folder: str) -> DataFrame:
    parsed = hw.parse_pages(pages(spark, folder), "blocks")
    return parsed.select("page_id", F.posexplode("blocks").alias("pos", "block")).select(
        "page_id", "pos", "block.tag", "block.text"
    )


@query(
    "image_texts",
    "SELECT page_id, unnest(regexp_extract_all(html, '<img[^>]*?alt=\"([^\"]+)\"', 1)) AS alt FROM pages",
)
def image_texts(spark: SparkSession, folder: str) -> DataFrame:
    return hw.parse_pages(pages(spark, folder), "alts").select("page_id", F.explode("alts").alias("alt"))


@query("searchable_texts", f"SELECT page_id, {sql.SEARCHABLE} AS text FROM pages")
def searchable_texts(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsed_documents(pages(spark, folder), doc_id="page_id")
    return parsed.select(F.col("doc_id").alias("page_id"), "text")


@query("searchable_block_texts")
def searchable_block_texts(spark: SparkSession, folder: str) -> DataFrame:
    parsed = parsed_documents(pages(spark, folder), "blocks", "page_id")
    return parsed.select(F.col("doc_id").alias("page_id"), "text")


@query(
    "declared_languages",
    "SELECT page_id, regexp_extract(html, '<html[^>]*\\slang=\"([^\"]*)\"', 1) AS lang FROM pages",
)
def declared_languages(spark: SparkSession, folder: str) -> DataFrame:
    return hw.parse_pages(pages(spark, folder), "lang").select("page_id", "lang")


@query(
    "anchors",
    "SELECT page_id, unnest(h) AS href, unnest(range(len(h))) AS pos FROM "
    "(SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href=\"([^\"]*)\"', 1) AS h FROM pages)",
)
def anchors(spark: SparkSession, folder: str) -> DataFrame:
    found = hw.parse_pages(pages(spark, folder), "hrefs").select("page_id", F.posexplode("hrefs").alias("pos", "href"))
    return found.select("page_id", "href", F.col("pos").cast("long").alias("pos"))


@query(
    "title_language_and_links_without_walk",
    "SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title, "
    "regexp_extract(html, '<html[^>]*\\slang=\"([^\"]*)\"', 1) AS lang, "
    "len(regexp_extract_all(html, '<a\\s[^>]*?href=\"([^\"]*)\"', 1)) AS n_links FROM pages",
)
def without_walk(spark: SparkSession, folder: str) -> DataFrame:
    html = F.col("html")
    return pages(spark, folder).select(
        "page_id",
        hw.title_of(html).alias("title"),
        hw.declared_language(html).alias("lang"),
        F.size(hw.anchor_links(html)).cast("long").alias("n_links"),
    )


@query("non_empty_documents", "SELECT doc_id FROM documents WHERE length(text) > 0")
def non_empty_documents(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).where(fl.has_text(F.col("text"))).select("doc_id")


@query(
    "complete_rows",
    "SELECT doc_id FROM (SELECT doc_id, nullif(lang, 'fr') AS lang, text FROM documents) "
    "WHERE lang IS NOT NULL AND text IS NOT NULL",
)
def complete_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder).withColumn("lang", F.nullif("lang", F.lit("fr")))
    return rows.where(fl.not_null(F.col("lang"), F.col("text"))).select("doc_id")


_DETECTED = (
    f"(SELECT doc_id, lang, {sql.detected('w')} AS detected FROM "
    f"(SELECT doc_id, lang, {sql.LANGUAGE_WORDS.format(e='text')} AS w FROM documents))"
)


@query("detected_languages", f"SELECT doc_id, lang, detected FROM {_DETECTED}")
def detected_languages(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).select("doc_id", "lang", lg.detected_language(F.col("text")).alias("detected"))


_PAGE_FACTS = (
    f"facts AS (SELECT page_id, url, text, {sql.detected('w')} AS detected, "
    "regexp_extract(html, '<html[^>]*\\slang=\"([^\"]*)\"', 1) AS lang FROM "
    f"(SELECT page_id, url, html, text, {sql.LANGUAGE_WORDS.format(e='text')} AS w FROM "
    f"(SELECT page_id, url, html, lower({sql.PAGE_TEXT}) AS text FROM pages)))"
)
_LANGUAGES = "['en', 'en-de', 'eng', 'en-GB', 'en-US', 'english']"
_IN_LANGUAGE = (
    f"(list_contains({_LANGUAGES}, lang) OR list_has_any(string_split(url, '/'), {_LANGUAGES}) "
    f"OR coalesce(list_contains({_LANGUAGES}, detected), false))"
)


@query("pages_in_language", f"WITH {_PAGE_FACTS} SELECT page_id FROM facts WHERE {_IN_LANGUAGE}")
def pages_in_language(spark: SparkSession, folder: str) -> DataFrame:
    parsed = hw.parse_pages(pages(spark, folder), "lang", "xml_lang", "page_text")
    detected = lg.detected_language(F.col("page_text"))
    kept = fl.in_language(F.col("lang"), F.col("xml_lang"), F.col("link"), detected)
    return parsed.where(kept).select("page_id")


@query(
    "pages_with_keywords",
    f"SELECT page_id FROM (SELECT page_id, lower({sql.PAGE_TEXT}) AS text FROM pages) "
    "WHERE contains(text, 'onwh') OR contains(text, 'ñado')",
)
def pages_with_keywords(spark: SparkSession, folder: str) -> DataFrame:
    text = F.lower("page_text")
    parsed = hw.parse_pages(pages(spark, folder), "page_text")
    return parsed.where(fl.has_keyword(text, ("onwh", "ñado"))).select("page_id")


@query("texts_within_char_cap", "SELECT doc_id FROM documents WHERE length(text) <= 5000")
def texts_within_char_cap(spark: SparkSession, folder: str) -> DataFrame:
    return documents(spark, folder).where(fl.within_char_cap(F.col("text"), 5000)).select("doc_id")


@query(
    "texts_within_token_cap",
    f"SELECT doc_id FROM (SELECT doc_id, {sql.analyze('text')} AS tokens FROM documents) WHERE len(tokens) <= 300",
)
def texts_within_token_cap(spark: SparkSession, folder: str) -> DataFrame:
    tokens = documents(spark, folder).select("doc_id", tx.analyze(F.col("text")).alias("tokens"))
    return tokens.where(fl.within_token_cap(F.col("tokens"), 300)).select("doc_id")


@query(
    "rejected_pages_by_reason",
    f"WITH {_PAGE_FACTS} SELECT CASE WHEN contains(url, 'spam-farm') THEN 'blocked domain' "
    f"WHEN length(text) = 0 THEN 'empty' WHEN NOT {_IN_LANGUAGE} THEN 'language' "
    "WHEN NOT contains(text, 'onwh') THEN 'keywords' ELSE 'none' END AS reason, count(*) AS n FROM facts GROUP BY 1",
)
def rejected_pages_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    config = CrawlConfig(blocked_domains=("spam-farm",), required_keywords=("onwh",))
    parsed = hw.parse_pages(pages(spark, folder), "lang", "xml_lang", "has_html", "page_text")
    judged = fl.with_reject_reason(parsed, config)
    return judged.groupBy(F.coalesce("reason", F.lit("none")).alias("reason")).agg(F.count("*").alias("n"))


@query("vector_rows", "SELECT vec_id, len(embedding) AS n_values FROM embeddings")
def vector_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Stored as word vectors and read back; words are ids here."""
    path = new_folder(spark, "vectors")
    rows = table(spark, folder, "embeddings")
    rows.select(F.col("vec_id").cast("string").alias("word"), F.col("embedding").alias("vector")).write.parquet(path)
    return read_vectors(spark, path).select(F.col("word").cast("long").alias("vec_id"), F.size("vector").cast("long").alias("n_values"))


def _described(spark: SparkSession, folder: str) -> DataFrame:
    """The pages with a description and images that name their link."""
    head = F.concat(F.lit('</title><meta name="description" content="about '), F.col("link"), F.lit('">'))
    image = F.concat(F.lit('<article><img src="a.png" alt="seen at '), F.col("link"), F.lit('"><img alt=""><img src="b.png">'))
    html = F.replace(F.replace(F.col("html"), F.lit("</title>"), head), F.lit("<article>"), image)
    return pages(spark, folder).withColumn("html", html)


@query("meta_descriptions_of_described_pages", "SELECT page_id, 'about ' || url AS description FROM pages")
def meta_descriptions_of_described_pages(spark: SparkSession, folder: str) -> DataFrame:
    return hw.parse_pages(_described(spark, folder), "description").select("page_id", "description")


@query("image_texts_of_described_pages", "SELECT page_id, 'seen at ' || url AS alt FROM pages WHERE html LIKE '%<article>%'")
def image_texts_of_described_pages(spark: SparkSession, folder: str) -> DataFrame:
    return hw.parse_pages(_described(spark, folder), "alts").select("page_id", F.explode("alts").alias("alt"))
