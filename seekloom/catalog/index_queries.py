"""Index tables of all documents and of all pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.catalog import sql
from seekloom.catalog.registry import document_index, documents, pages, query
from seekloom.operators import index as ix
from seekloom.operators.ordering import with_position
from seekloom.plans.build import (
    append_documents,
    build_index,
    build_index_from_pages,
    parsed_documents,
    postings,
    titles_and_links,
)
from seekloom.session import new_folder
from seekloom.sources.index_store import document_count as count_documents


@query("document_count", "SELECT count(*) AS doc_count FROM documents")
def document_count(spark: SparkSession, folder: str) -> DataFrame:
    return count_documents(document_index(spark, folder))


@query("document_ids", "SELECT page_id AS doc_id, url AS link FROM pages")
def document_ids(spark: SparkSession, folder: str) -> DataFrame:
    found = pages(spark, folder).withColumnRenamed("page_id", "doc_id")
    return ix.ids_by_link(found.select("link"), found)


@query(
    "sequence_ids",
    "SELECT url AS link, row_number() OVER (ORDER BY url) AS doc_id FROM pages",
)
def sequence_ids(spark: SparkSession, folder: str) -> DataFrame:
    numbered = with_position(pages(spark, folder).select("link"), F.col("link"), name="doc_id")
    return numbered.select("link", (F.col("doc_id") + 1).alias("doc_id"))


@query("vocabulary", f"WITH {sql.TF} SELECT DISTINCT word FROM tf")
def vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return ix.vocabulary(postings(documents(spark, folder))).select("word")


@query(
    "new_vocabulary_words",
    f"WITH {sql.TF}, known AS (SELECT DISTINCT word FROM tf JOIN documents USING (doc_id) WHERE lang <> 'en') "
    "SELECT DISTINCT word FROM tf ANTI JOIN known USING (word)",
)
def new_vocabulary_words(spark: SparkSession, folder: str) -> DataFrame:
    texts = documents(spark, folder)
    known = ix.vocabulary(postings(texts.where(F.col("lang") != "en")))
    return ix.new_words(postings(texts), known).select("word")


@query("term_frequencies", f"WITH {sql.TF} SELECT word, doc_id, tf FROM tf")
def term_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return postings(documents(spark, folder))


@query(
    "term_frequencies_of_long_texts",
    f"WITH {sql.TF} SELECT word, doc_id, tf * 60 AS tf FROM tf JOIN documents USING (doc_id) WHERE n_chars > 5000",
)
def term_frequencies_of_long_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Long documents sixty times over: 300,000 characters and more, none of them dropped."""
    line = F.concat("text", F.lit("\n"))
    long_texts = documents(spark, folder).where("n_chars > 5000").select("doc_id", F.repeat(line, 60).alias("text"))
    return postings(long_texts)


@query("document_frequencies", f"WITH {sql.IDF} SELECT word, df FROM idf")
def document_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    return ix.document_frequencies(postings(documents(spark, folder)))


@query("inverse_frequencies", f"WITH {sql.IDF} SELECT word, df, round(idf, 6) AS idf FROM idf")
def inverse_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    texts = documents(spark, folder)
    return ix.inverse_frequencies(postings(texts), texts).withColumn("idf", F.round("idf", 6))


_PAGE_TF = (
    f"texts AS (SELECT page_id, {sql.SEARCHABLE} AS text FROM pages), "
    f"{sql.tokens_cte('texts', 'page_id')}, "
    "tf AS (SELECT word, page_id AS doc_id, count(*) AS tf FROM "
    "(SELECT page_id, unnest(tokens) AS word FROM tok) GROUP BY ALL)"
)


@query(
    "index_from_pages",
    f"WITH {_PAGE_TF}, idf AS (SELECT word, log10((SELECT count(*) FROM pages) / count(*)) AS idf FROM tf GROUP BY word) "
    "SELECT word, doc_id, tf, round(idf, 6) AS idf FROM tf JOIN idf USING (word)",
)
def index_from_pages(spark: SparkSession, folder: str) -> DataFrame:
    built = build_index_from_pages(pages(spark, folder), new_folder(spark, "index"), doc_id="page_id")
    rows = built.tf.join(built.idf, "word")
    return rows.select("word", "doc_id", "tf", F.round("idf", 6).alias("idf"))


@query(
    "index_in_two_steps",
    f"WITH {sql.IDF} SELECT word, count(*) AS df, sum(tf)::BIGINT AS n, any_value(round(idf, 6)) AS idf "
    "FROM tf JOIN idf USING (word) GROUP BY word",
)
def index_in_two_steps(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "index")
    english = documents(spark, folder).where(F.col("lang") == "en")
    build_index(titles_and_links(english), path)
    texts = titles_and_links(documents(spark, folder))
    append_documents(texts, path, "second")
    built = append_documents(texts, path, "second")
    totals = built.tf.groupBy("word").agg(F.count("*").alias("df"), F.sum("tf").alias("n"))
    return totals.join(built.idf.select("word", F.round("idf", 6).alias("idf")), "word")


@query(
    "duplicate_keys",
    "SELECT doc_id // 2 AS half_id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_keys(spark: SparkSession, folder: str) -> DataFrame:
    halves = documents(spark, folder).select(F.expr("doc_id div 2").alias("half_id"))
    return ix.duplicate_keys(halves, "half_id")


@query("duplicate_postings", f"WITH {sql.TF} SELECT word, doc_id, count(*) AS n FROM tf GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_postings(spark: SparkSession, folder: str) -> DataFrame:
    return ix.duplicate_keys(document_index(spark, folder).tf, "word", "doc_id", rows_per_task=1_000_000)


@query(
    "orphan_postings",
    f"WITH {sql.TF} SELECT DISTINCT doc_id FROM tf WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')",
)
def orphan_postings(spark: SparkSession, folder: str) -> DataFrame:
    english = documents(spark, folder).where(F.col("lang") == "en")
    return ix.orphans(document_index(spark, folder).tf, english, "doc_id")


@query(
    "tokens_per_page",
    f"WITH {_PAGE_TF} SELECT doc_id, sum(tf)::BIGINT AS n_tokens, count(*) AS n_words FROM tf GROUP BY doc_id",
)
def tokens_per_page(spark: SparkSession, folder: str) -> DataFrame:
    tf = postings(parsed_documents(pages(spark, folder), doc_id="page_id"))
    return tf.groupBy("doc_id").agg(F.sum("tf").alias("n_tokens"), F.count("*").alias("n_words"))
