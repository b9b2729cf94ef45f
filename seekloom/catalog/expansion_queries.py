"""Query analysis and expansion. Vectors stand for words of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.catalog import sql
from seekloom.catalog.registry import document_index, documents, query, table, user_queries
from seekloom.catalog.text_queries import LEMMAS_SQL
from seekloom.config import SearchConfig
from seekloom.operators import expand as ex
from seekloom.operators import index as ix
from seekloom.operators.lemmas import plural_lemmas
from seekloom.plans.build import postings
from seekloom.session import cut_lineage

# The given vectors are nearly orthogonal, so a lower bound lets some neighbours in.
CONFIG = SearchConfig(min_cosine=0.25)


def word_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """``(word, vector)``: words are hashed onto the vectors, the most frequent one wins."""
    vectors = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    n = vectors.agg(F.count("*").alias("n")).scalar()
    hashed = F.conv(F.substring(F.md5(F.col("word").cast("binary")), 1, 8), 16, 10).cast("long") % n
    slots = document_index(spark, folder).idf.withColumn("vec_id", hashed)
    best = slots.groupBy("vec_id").agg(F.max(F.struct("df", "word")).alias("best"))
    return vectors.join(best, "vec_id").select("best.word", "vector")


VECTORS_SQL = (
    "slots AS (SELECT word, df, ('0x' || substr(md5(word), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings) AS vec_id "
    "FROM idf), best AS (SELECT vec_id, arg_max(word, struct_pack(df := df, word := word)) AS word FROM slots GROUP BY vec_id), "
    "vectors AS (SELECT word, embedding::DOUBLE[] AS v FROM embeddings JOIN best USING (vec_id))"
)
NEAR_SQL = (
    f"{VECTORS_SQL}, near AS (SELECT token, word, cos, row_number() OVER (PARTITION BY token ORDER BY cos DESC, word) "
    "AS rank FROM (SELECT a.word AS token, b.word, list_cosine_similarity(a.v, b.v) AS cos FROM vectors a, vectors b "
    "WHERE a.word <> b.word AND a.word IN (SELECT token FROM qword)) QUALIFY rank <= 7)"
)
KEPT_SQL = (
    "kept AS (SELECT q.query_id, q.token, near.word, cos FROM qword q JOIN near USING (token) "
    "WHERE rank <= budget AND cos > 0.25 AND NOT EXISTS "
    "(SELECT 1 FROM qword o WHERE o.query_id = q.query_id AND o.token = near.word))"
)
TOKEN_WEIGHTS_SQL = (
    "tweight AS (SELECT query_id, token AS word, CASE WHEN budget > 0 AND token IN (SELECT token FROM near) "
    "THEN 1.0 ELSE 4.0 END AS weight FROM qword)"
)
EXPANSION_WEIGHTS_SQL = (
    "eweight AS (SELECT query_id, word, cos / count(*) OVER (PARTITION BY query_id) AS weight FROM kept)"
)
TERMS_SQL = (
    f"{NEAR_SQL}, {KEPT_SQL}, {TOKEN_WEIGHTS_SQL}, {EXPANSION_WEIGHTS_SQL}, "
    "terms AS (SELECT query_id, word, sum(weight)::DOUBLE AS weight FROM "
    "(SELECT * FROM tweight UNION ALL SELECT * FROM eweight) GROUP BY 1, 2)"
)
_BASE = f"WITH {sql.IDF}, {sql.QUERY_WORDS}"


def _words(spark: SparkSession, folder: str) -> DataFrame:
    return cut_lineage(ex.distinct_query_tokens(ex.query_tokens(user_queries(spark, folder)), CONFIG))


def _near(spark: SparkSession, folder: str, words: DataFrame) -> DataFrame:
    return cut_lineage(ex.nearest_words(words, cut_lineage(word_vectors(spark, folder)), CONFIG.max_synonyms))


@query("word_vectors", f"WITH {sql.IDF}, {VECTORS_SQL} SELECT word, round(v[1], 6) AS first_value FROM vectors")
def standing_vectors(spark: SparkSession, folder: str) -> DataFrame:
    first = F.round(F.element_at("vector", 1).cast("double"), 6)
    return word_vectors(spark, folder).select("word", first.alias("first_value"))


@query("query_tokens", f"WITH {sql.QUERY_TOKENS} SELECT query_id, pos, token FROM qtok")
def query_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return ex.query_tokens(user_queries(spark, folder)).withColumn("pos", F.col("pos").cast("long"))


@query("synonym_budgets", f"WITH {sql.QUERY_WORDS} SELECT DISTINCT query_id, budget::BIGINT AS budget FROM qword")
def synonym_budgets(spark: SparkSession, folder: str) -> DataFrame:
    words = ex.distinct_query_tokens(ex.query_tokens(user_queries(spark, folder)), CONFIG)
    return words.groupBy("query_id").agg(F.max("budget").cast("long").alias("budget"))


@query("nearest_words", f"{_BASE}, {NEAR_SQL} SELECT token, word, rank, round(cos, 6) AS cos FROM near")
def nearest_words(spark: SparkSession, folder: str) -> DataFrame:
    near = _near(spark, folder, _words(spark, folder))
    return near.select("token", "word", F.col("rank").cast("long").alias("rank"), F.round("cos", 6).alias("cos"))


@query(
    "nearest_words_of_all_words",
    f"WITH {sql.IDF}, {VECTORS_SQL} SELECT token, word, rank, round(cos, 6) AS cos FROM (SELECT token, word, cos, "
    "row_number() OVER (PARTITION BY token ORDER BY cos DESC, word) AS rank FROM (SELECT a.word AS token, b.word, "
    "list_cosine_similarity(a.v, b.v) AS cos FROM vectors a, vectors b WHERE a.word <> b.word)) WHERE rank <= 7",
)
def nearest_words_of_all_words(spark: SparkSession, folder: str) -> DataFrame:
    vectors = cut_lineage(word_vectors(spark, folder))
    # A small bound makes this take the block-wise path.
    near = ex.nearest_words(vectors.select(F.col("word").alias("token")), vectors, 7, max_bytes=100_000)
    return near.select("token", "word", F.col("rank").cast("long").alias("rank"), F.round("cos", 6).alias("cos"))


@query(
    "normalized_neighbours",
    f"WITH {LEMMAS_SQL}, idf AS (SELECT word, count(*) AS df FROM tf GROUP BY word), {sql.QUERY_WORDS}, {NEAR_SQL} "
    "SELECT token, coalesce(lemma, lower(word)) AS word, rank FROM near LEFT JOIN lemmas ON surface = lower(word)",
)
def normalized_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    lemmas = cut_lineage(plural_lemmas(ix.vocabulary(cut_lineage(postings(documents(spark, folder))))))
    near = ex.normalize_neighbours(_near(spark, folder, _words(spark, folder)), lemmas)
    return near.select("token", "word", F.col("rank").cast("long").alias("rank"))


@query(
    "kept_expansions",
    f"{_BASE}, {NEAR_SQL}, {KEPT_SQL} SELECT query_id, token, word, round(cos, 6) AS cos FROM kept",
)
def kept_expansions(spark: SparkSession, folder: str) -> DataFrame:
    words = _words(spark, folder)
    kept = ex.expansion_rows(words, ex.normalize_neighbours(_near(spark, folder, words)), CONFIG)
    return kept.select("query_id", "token", "word", F.round("cos", 6).alias("cos"))


@query(
    "expansion_weights",
    f"{_BASE}, {NEAR_SQL}, {KEPT_SQL}, {EXPANSION_WEIGHTS_SQL} "
    "SELECT query_id, word, round(weight, 6) AS weight FROM eweight",
)
def expansion_weights(spark: SparkSession, folder: str) -> DataFrame:
    words = _words(spark, folder)
    kept = ex.expansion_rows(words, ex.normalize_neighbours(_near(spark, folder, words)), CONFIG)
    return ex.expansion_weights(kept).withColumn("weight", F.round("weight", 6))


@query(
    "token_weights",
    f"{_BASE}, {NEAR_SQL}, {TOKEN_WEIGHTS_SQL} SELECT query_id, word, weight::DOUBLE AS weight FROM tweight",
)
def token_weights(spark: SparkSession, folder: str) -> DataFrame:
    words = _words(spark, folder)
    return ex.token_weights(words, _near(spark, folder, words), CONFIG)


@query("weighted_search_terms", f"{_BASE}, {TERMS_SQL} SELECT query_id, word, round(weight, 6) AS weight FROM terms")
def weighted_search_terms(spark: SparkSession, folder: str) -> DataFrame:
    vectors = cut_lineage(word_vectors(spark, folder))
    terms = ex.expanded_terms(user_queries(spark, folder), vectors, config=CONFIG)
    return terms.withColumn("weight", F.round("weight", 6))
