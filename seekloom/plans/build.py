"""Index build: whole rebuild from pages or texts, and appending new ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.config import IndexConfig
from seekloom.operators import html, lemmas as lem
from seekloom.operators import index as ix
from seekloom.operators.joins import without_stored
from seekloom.session import cut_lineage
from seekloom.sources import index_store as store
from seekloom.sources.pages import one_per_link


class DuplicateIds(ValueError):
    """Two documents got the same id, or one link occurs twice."""


def parsed_documents(
    pages: DataFrame, text_mode: str = "leaf", doc_id: str | None = None, unique: bool = False
) -> DataFrame:
    """``pages(link, html[, id])`` -> ``(doc_id, link, title, description, text)`` in one HTML walk.

    ``unique`` says that no link occurs twice and no page is null, as in a page store.
    """
    parsed = html.parse_pages(pages if unique else one_per_link(pages), *html.text_fields(text_mode))
    identity = ix.hash_id(F.col("link")) if doc_id is None else F.col(doc_id)
    return parsed.select(
        identity.alias("doc_id"), "link", "title", "description", html.searchable_text(text_mode).alias("text")
    )


def postings(texts: DataFrame, config: IndexConfig = IndexConfig(), lemmas: DataFrame | None = None) -> DataFrame:
    """``texts(doc_id, text)`` -> ``(word, doc_id, tf)``."""
    tf = ix.term_frequencies(ix.document_tokens(texts, config))
    return tf if lemmas is None else lem.lemmatize_terms(tf, lemmas)


def check_documents(spark: SparkSession, path: str) -> None:
    """Ids and links of all stored documents occur once each."""
    for key in ("doc_id", "link"):
        clash = ix.duplicate_keys(store.read_documents(spark, path), key).limit(1).collect()
        if clash:
            raise DuplicateIds(f"{key} {clash[0][key]} occurs {clash[0]['n']} times")


def build_index(
    documents: DataFrame,
    path: str,
    config: IndexConfig = IndexConfig(),
    lemmas: DataFrame | None = None,
    tf: DataFrame | None = None,
) -> store.Index:
    """Rebuild the index at ``path`` from ``(doc_id, link, title, description, text)``.

    Postings that were counted before may be given as ``tf``.
    """
    spark = documents.sparkSession
    store.reset_index(spark, path, config)
    store.write_documents(ix.documents_table(documents, F.col("doc_id")), path)
    check_documents(spark, path)
    store.write_postings(postings(documents, config, lemmas) if tf is None else tf, path, config)
    store.write_frequencies(spark, path)
    return store.read_index(spark, path)


def build_index_from_pages(
    pages: DataFrame,
    path: str,
    config: IndexConfig = IndexConfig(),
    lemmas: DataFrame | None = None,
    text_mode: str = "leaf",
    doc_id: str | None = None,
    unique: bool = False,
) -> store.Index:
    """Rebuild the index at ``path`` from pages. The HTML is walked once."""
    return build_index(cut_lineage(parsed_documents(pages, text_mode, doc_id, unique)), path, config, lemmas)


def append_documents(
    documents: DataFrame,
    path: str,
    batch: str,
    config: IndexConfig = IndexConfig(),
    lemmas: DataFrame | None = None,
) -> store.Index:
    """Add documents whose link is not indexed yet, then renew the frequencies.

    ``batch`` names the addition. Running it again under its name replaces it.
    """
    spark = documents.sparkSession
    earlier = store.read_documents(spark, path, without_batch=batch)
    fresh = cut_lineage(without_stored(documents, earlier, "link"))
    store.write_documents(ix.documents_table(fresh, F.col("doc_id")), path, batch)
    check_documents(spark, path)
    store.write_postings(postings(fresh, config, lemmas), path, config, batch)
    store.write_frequencies(spark, path)
    return store.read_index(spark, path)


def titles_and_links(texts: DataFrame) -> DataFrame:
    """Plain texts ``(doc_id, text)`` as documents: the first line serves as title."""
    return texts.select(
        "doc_id",
        F.concat(F.lit("document:"), F.col("doc_id").cast("string")).alias("link"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.lit("").alias("description"),
        "text",
    )
