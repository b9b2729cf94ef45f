"""Ranking: lookups, scores and results for many queries at once."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.catalog import sql
from seekloom.catalog.expansion_queries import CONFIG, EXPANSION_WEIGHTS_SQL, KEPT_SQL, NEAR_SQL, TERMS_SQL, TOKEN_WEIGHTS_SQL, word_vectors
from seekloom.catalog.text_queries import LEMMAS_SQL
from seekloom.catalog.registry import document_index, documents, query, table, user_queries
from seekloom.operators import expand as ex
from seekloom.operators import index as ix
from seekloom.operators import present as pr
from seekloom.operators import rank as rk
from seekloom.operators.lemmas import lemmatize_terms, plural_lemmas
from seekloom.config import IndexConfig
from seekloom.plans import search as se
from seekloom.plans.build import build_index, postings, titles_and_links
from seekloom.session import cut_lineage, new_folder
from seekloom.sources.index_store import Index, read_index
from seekloom.sources.queries import read_queries, write_results

_ITEMS = (
    f"queries AS (SELECT item_id AS query_id, text FROM benchmark), "
    f"terms AS (SELECT DISTINCT query_id, unnest({sql.analyze('text')}) AS word, 1.0::DOUBLE AS weight FROM queries)"
)
_SCORED = (
    "post AS (SELECT query_id, word, weight, doc_id, tf, idf, count(*) OVER (PARTITION BY query_id, doc_id) AS matched "
    "FROM terms JOIN tf USING (word) JOIN idf USING (word)), "
    "parts AS (SELECT query_id, word, doc_id, matched, weight, weight * idf * (tf * 2.5) / (tf + 1.5 * (0.25 + 0.75 * "
    "matched / (SELECT count(*) FROM documents))) AS part FROM post), "
    "scores AS (SELECT query_id, doc_id, sum(part) AS score FROM parts GROUP BY 1, 2)"
)
_ITEM_BASE = f"WITH {sql.IDF}, {_ITEMS}"
_ITEM_SCORES = f"{_ITEM_BASE}, {_SCORED}"
# Scores are compared after rounding, so that equal scores rank by document on both sides.
_RANKED = (
    "ranked AS (SELECT query_id, doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 10) DESC, "
    "doc_id) AS rank FROM scores)"
)
_USER_RANKED = f"WITH {sql.IDF}, {sql.QUERY_WORDS}, {TERMS_SQL}, {_SCORED}, {_RANKED}"


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    return cut_lineage(ex.expanded_terms(_items(spark, folder), None))


def _postings(spark: SparkSession, folder: str) -> DataFrame:
    index = document_index(spark, folder)
    terms = rk.with_gain(rk.idf_of(_terms(spark, folder), index.idf))
    return rk.postings_of(terms, index.tf.select("word", "doc_id", "tf"))


@query("posting_lookup", f"{_ITEM_BASE} SELECT query_id, word, doc_id, tf FROM terms JOIN tf USING (word)")
def posting_lookup(spark: SparkSession, folder: str) -> DataFrame:
    tf = document_index(spark, folder).tf
    return rk.postings_of(_terms(spark, folder), tf).select("query_id", "word", "doc_id", "tf")


@query("idf_lookup", f"{_ITEM_BASE} SELECT query_id, word, round(idf, 6) AS idf FROM terms JOIN idf USING (word)")
def idf_lookup(spark: SparkSession, folder: str) -> DataFrame:
    found = rk.idf_of(_terms(spark, folder), document_index(spark, folder).idf)
    return found.select("query_id", "word", F.round("idf", 6).alias("idf"))


@query("corpus_size", "SELECT count(*) AS n FROM documents")
def corpus_size(spark: SparkSession, folder: str) -> DataFrame:
    return document_index(spark, folder).size


@query("matched_term_counts", f"{_ITEM_SCORES} SELECT DISTINCT query_id, doc_id, matched FROM parts")
def matched_term_counts(spark: SparkSession, folder: str) -> DataFrame:
    matched = _postings(spark, folder).withColumn("matched", rk.matched_terms())
    return matched.select("query_id", "doc_id", "matched").distinct()


@query(
    "term_scores",
    f"{_ITEM_SCORES} SELECT query_id, word, doc_id, round(part, 6) AS part FROM parts",
)
def term_scores(spark: SparkSession, folder: str) -> DataFrame:
    n = document_index(spark, folder).size.scalar()
    parts = rk.term_scores(_postings(spark, folder), n)
    return parts.select("query_id", "word", "doc_id", F.round("part", 6).alias("part"))


@query(
    "expanded_document_scores",
    f"WITH {sql.IDF}, {sql.QUERY_WORDS}, {TERMS_SQL}, {_SCORED} "
    "SELECT query_id, doc_id, round(score, 6) AS score FROM scores",
)
def expanded_document_scores(spark: SparkSession, folder: str) -> DataFrame:
    vectors = cut_lineage(word_vectors(spark, folder))
    terms = cut_lineage(ex.expanded_terms(user_queries(spark, folder), vectors, config=CONFIG))
    scores = se.score_terms(document_index(spark, folder), terms, CONFIG)
    return scores.withColumn("score", F.round("score", 6))


@query("document_scores", f"{_ITEM_SCORES} SELECT query_id, doc_id, round(score, 6) AS score FROM scores")
def document_scores(spark: SparkSession, folder: str) -> DataFrame:
    scores = se.score_terms(document_index(spark, folder), _terms(spark, folder))
    return scores.withColumn("score", F.round("score", 6))


_RESULT = "'document:' || doc_id AS link, round(score, 6) AS score"


@query(
    "all_ranked_results",
    f"{_ITEM_SCORES}, {_RANKED} SELECT query_id, rank, doc_id, {_RESULT} FROM ranked",
)
def all_ranked_results(spark: SparkSession, folder: str) -> DataFrame:
    config = dataclasses.replace(CONFIG, limit=None)
    terms = _rounded_scores_ranked(spark, folder, config)
    return terms.select("query_id", "rank", "doc_id", "link", F.round("score", 6).alias("score"))


def _rounded_scores_ranked(spark: SparkSession, folder: str, config) -> DataFrame:
    return se.search_terms(document_index(spark, folder), _terms(spark, folder), config)


@query(
    "top_documents",
    f"{_ITEM_SCORES}, {_RANKED} SELECT query_id, rank, doc_id, {_RESULT} FROM ranked WHERE rank <= 100",
)
def top_documents(spark: SparkSession, folder: str) -> DataFrame:
    found = se.search_terms(document_index(spark, folder), _terms(spark, folder))
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "link", F.round("score", 6).alias("score")
    )


_ONE = "reon anes, onwh onea les!"


_ONE_RANKED = (
    f"WITH {sql.IDF}, terms AS (SELECT DISTINCT 1 AS query_id, unnest({sql.analyze(sql.text(_ONE))}) AS word, "
    f"1.0::DOUBLE AS weight), {_SCORED}, {_RANKED} SELECT rank, doc_id, {_RESULT} FROM ranked WHERE rank <= 100"
)


@query("single_search", _ONE_RANKED)
def single_search(spark: SparkSession, folder: str) -> DataFrame:
    found = se.search_one(spark, document_index(spark, folder), _ONE)
    return found.select(F.col("rank").cast("long").alias("rank"), "doc_id", "link", F.round("score", 6).alias("score"))


@query("search_other_bucket_count", _ONE_RANKED)
def search_other_bucket_count(spark: SparkSession, folder: str) -> DataFrame:
    """An index with another number of directories is read in its own layout."""
    path = new_folder(spark, "index")
    build_index(titles_and_links(documents(spark, folder)), path, IndexConfig(word_buckets=3))
    found = se.search_one(spark, read_index(spark, path), _ONE)
    return found.select(F.col("rank").cast("long").alias("rank"), "doc_id", "link", F.round("score", 6).alias("score"))


_LEMMATIZED = (
    f"WITH {LEMMAS_SQL}, ltf AS (SELECT coalesce(lemma, word) AS word, doc_id, sum(tf)::BIGINT AS tf "
    "FROM tf LEFT JOIN lemmas ON surface = word GROUP BY 1, 2), "
    "lidf AS (SELECT word, log10((SELECT count(*) FROM documents) / count(*)) AS idf FROM ltf GROUP BY word), "
    "terms AS (SELECT DISTINCT query_id, coalesce(lemma, w) AS word, 1.0::DOUBLE AS weight FROM "
    f"(SELECT item_id AS query_id, unnest({sql.analyze('text')}) AS w FROM benchmark) LEFT JOIN lemmas ON surface = w), "
    + _SCORED.replace("JOIN tf USING", "JOIN ltf AS tf USING").replace("JOIN idf USING", "JOIN lidf AS idf USING")
)


@query(
    "search_lemmatized",
    f"{_LEMMATIZED}, {_RANKED} SELECT query_id, rank, doc_id, {_RESULT} FROM ranked WHERE rank <= 100",
)
def search_lemmatized(spark: SparkSession, folder: str) -> DataFrame:
    """Lemmas in the index and in the queries."""
    index, lemmas = _lemmatized_index(spark, folder)
    found = se.search(index, _items(spark, folder), lemmas=lemmas)
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "link", F.round("score", 6).alias("score")
    )


def _lemmatized_index(spark: SparkSession, folder: str) -> tuple[Index, DataFrame]:
    """An index by lemma and the lemmas; texts are analysed once for both."""
    texts = documents(spark, folder)
    tf = cut_lineage(postings(texts))
    lemmas = cut_lineage(plural_lemmas(ix.vocabulary(tf)))
    return build_index(titles_and_links(texts), new_folder(spark, "index"), tf=lemmatize_terms(tf, lemmas)), lemmas


_JOINT = (
    f"WITH {LEMMAS_SQL}, idf AS (SELECT word, count(*) AS df FROM tf GROUP BY word), {sql.QUERY_TOKENS}, "
    "lqtok AS (SELECT query_id, coalesce(lemma, token) AS token FROM qtok LEFT JOIN lemmas ON surface = token), "
    "qsize AS (SELECT query_id, count(*) AS n FROM lqtok GROUP BY query_id), "
    "qword AS (SELECT DISTINCT query_id, token, CASE WHEN n <= 7 THEN 7 ELSE trunc(7 * exp(-0.08 * n))::INT END AS budget "
    f"FROM lqtok JOIN qsize USING (query_id)), {NEAR_SQL}, "
    "lnear AS (SELECT token, coalesce(lemma, lower(word)) AS word, cos, rank FROM near LEFT JOIN lemmas ON surface = lower(word)), "
    + KEPT_SQL.replace("near", "lnear")
    + f", {TOKEN_WEIGHTS_SQL}, {EXPANSION_WEIGHTS_SQL}, "
    "terms AS (SELECT query_id, word, sum(weight)::DOUBLE AS weight FROM "
    "(SELECT * FROM tweight UNION ALL SELECT * FROM eweight) GROUP BY 1, 2), "
    "ltf AS (SELECT coalesce(lemma, word) AS word, doc_id, sum(tf)::BIGINT AS tf FROM tf LEFT JOIN lemmas ON surface = word GROUP BY 1, 2), "
    "lidf AS (SELECT word, log10((SELECT count(*) FROM documents) / count(*)) AS idf FROM ltf GROUP BY word), "
    + _SCORED.replace("JOIN tf USING", "JOIN ltf AS tf USING").replace("JOIN idf USING", "JOIN lidf AS idf USING")
    + f", {_RANKED}"
)


@query(
    "search_expanded_lemmatized",
    f"{_JOINT} SELECT query_id, rank, doc_id, {_RESULT} FROM ranked WHERE rank <= 100",
)
def search_expanded_lemmatized(spark: SparkSession, folder: str) -> DataFrame:
    """The whole path of a query: lemmas in index, queries and neighbours, and expansion by vectors."""
    index, lemmas = _lemmatized_index(spark, folder)
    vectors = cut_lineage(word_vectors(spark, folder))
    found = se.search(index, user_queries(spark, folder), vectors, lemmas, CONFIG)
    return found.select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "link", F.round("score", 6).alias("score")
    )


@query(
    "search_without_index",
    f"{_ITEM_SCORES}, {_RANKED} SELECT query_id, rank, doc_id, round(score, 6) AS score FROM ranked WHERE rank <= 100",
)
def search_without_index(spark: SparkSession, folder: str) -> DataFrame:
    found = se.search_texts(documents(spark, folder), _items(spark, folder))
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), "doc_id", F.round("score", 6).alias("score"))


def batch_results(spark: SparkSession, folder: str) -> DataFrame:
    vectors = cut_lineage(word_vectors(spark, folder))
    return se.search(document_index(spark, folder), user_queries(spark, folder), vectors, config=CONFIG)


@query(
    "batch_search",
    f"{_USER_RANKED} SELECT query_id, rank, doc_id, {_RESULT} FROM ranked WHERE rank <= 100",
)
def batch_search(spark: SparkSession, folder: str) -> DataFrame:
    return batch_results(spark, folder).select(
        "query_id", F.col("rank").cast("long").alias("rank"), "doc_id", "link", F.round("score", 6).alias("score")
    )


@query(
    "search_envelopes",
    f"{_USER_RANKED} SELECT query_id, text AS query, text AS spellchecked_query, "
    "(SELECT count(*) FROM ranked r WHERE r.query_id = q.query_id AND rank <= 100) AS n_results FROM queries q",
)
def search_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    answers = pr.search_envelopes(user_queries(spark, folder), batch_results(spark, folder))
    parsed = F.from_json("envelope", "query string, spellchecked_query string, results array<struct<id bigint>>")
    return answers.select("query_id", parsed.alias("e")).select(
        "query_id", "e.query", "e.spellchecked_query", F.size("e.results").cast("long").alias("n_results")
    )


@query(
    "search_envelope_results",
    f"{_USER_RANKED} SELECT query_id, rank - 1 AS position, doc_id AS id, split_part(text, chr(10), 1) AS title, "
    "'document:' || doc_id AS url, '' AS description, 'no summary' AS summary, round(score, 6) AS score "
    "FROM ranked JOIN documents USING (doc_id) WHERE rank <= 100",
)
def search_envelope_results(spark: SparkSession, folder: str) -> DataFrame:
    """Every result of every answer as its user gets it, in the order of the answer."""
    answers = pr.search_envelopes(user_queries(spark, folder), batch_results(spark, folder))
    fields = "id bigint, title string, url string, description string, summary string, score double"
    parsed = F.from_json("envelope", f"results array<struct<{', '.join(f.replace(' ', ': ') for f in fields.split(', '))}>>")
    rows = answers.select("query_id", F.posexplode(parsed["results"]).alias("position", "r"))
    names = ("id", "title", "url", "description", "summary")
    return rows.select("query_id", F.col("position").cast("long").alias("position"), *(f"r.{n}" for n in names), F.round("r.score", 6).alias("score"))


@query(
    "result_counts",
    f"{_USER_RANKED} SELECT q.query_id, count(r.doc_id) AS n_results FROM queries q "
    "LEFT JOIN (SELECT * FROM ranked WHERE rank <= 100) r USING (query_id) GROUP BY 1",
)
def result_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pr.result_counts(user_queries(spark, folder), batch_results(spark, folder))


@query("queries_from_file", f"SELECT item_id::VARCHAR AS query_id, {sql.squeeze('text')} AS text FROM benchmark")
def queries_from_file(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "queries")
    line = F.concat_ws("\t", F.col("query_id"), F.trim(F.regexp_replace("text", r"\s+", " ")))
    _items(spark, folder).select(F.concat(F.lit("  "), line, F.lit(" \n"))).write.text(path)
    return read_queries(spark, path)


@query(
    "results_to_file",
    f"{_ITEM_SCORES}, {_RANKED} SELECT query_id, rank, 'document:' || doc_id AS link, round(score, 6) AS score "
    "FROM ranked WHERE rank <= 100",
)
def results_to_file(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "results")
    write_results(se.search_terms(document_index(spark, folder), _terms(spark, folder)), path)
    lines = spark.read.schema("query_id bigint, rank bigint, link string, score double").csv(path, sep="\t")
    return lines.withColumn("score", F.round("score", 6))
