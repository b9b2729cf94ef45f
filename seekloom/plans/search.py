"""Search: one query or many, one plan."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import schemas
from seekloom.config import IndexConfig, SearchConfig
from seekloom.operators import index as ix
from seekloom.operators import rank as rk
from seekloom.operators.blocks import all_by_block, best_by_block
from seekloom.operators.expand import distinct_query_tokens, expanded_terms, query_tokens
from seekloom.operators.joins import BROADCAST_BYTES, lookup_join, row_bytes
from seekloom.operators.ordering import with_position
from seekloom.session import cut_lineage
from seekloom.sources.index_store import Index

_FEW_BYTES = 64 * 1024
_FEW_ROWS = 1_000
_RANKED_ROW_BYTES = 64


@dataclass(frozen=True)
class TermFacts:
    """What is measured of the terms once, and decides how the index is read."""

    small: bool
    n_queries: int
    buckets: list[int] | None
    words: list[str] | None


def measure_terms(terms: DataFrame, buckets: int | None) -> TermFacts:
    """Size, number of queries, touched buckets, and the words if they are few."""
    bucketed = terms if buckets is None else ix.with_bucket(terms, buckets)
    measures = [F.sum(row_bytes(terms).cast("long")).alias("bytes"), F.count_distinct("query_id").alias("n_queries")]
    if buckets is not None:
        measures.append(F.collect_set("word_bucket").alias("buckets"))
    facts = bucketed.agg(*measures).first()
    size = facts["bytes"] or 0
    words = None
    if size <= _FEW_BYTES:
        words = [r["word"] for r in terms.select("word").distinct().collect()]
    return TermFacts(size <= BROADCAST_BYTES, facts["n_queries"], facts["buckets"] if buckets else None, words)


def _index_slice(index: Index, facts: TermFacts) -> tuple[DataFrame, DataFrame]:
    """Postings and frequencies narrowed to what the terms can touch.

    Buckets, and the words where they are few, become literals: unneeded
    directories and row groups are then skipped by the scans.
    """
    tf, idf = index.tf, index.idf
    if facts.buckets is not None:
        tf = tf.where(F.col("word_bucket").isin(facts.buckets))
    if facts.words is not None:
        tf, idf = tf.where(F.col("word").isin(facts.words)), idf.where(F.col("word").isin(facts.words))
    return tf.select("word", "doc_id", "tf"), idf


def score_terms(
    index: Index, terms: DataFrame, config: SearchConfig = SearchConfig(), facts: TermFacts | None = None
) -> DataFrame:
    """``terms(query_id, word, weight)`` -> ``(query_id, doc_id, score)`` of all matches.

    Few terms are joined with their postings. Of many, that would be a row per query and posting,
    so they are scored in blocks of documents, and only the results are so many.
    """
    facts = facts or measure_terms(terms, index.buckets)
    if facts.words is None:
        gains, tf, n_postings = _gains(index, terms, facts)
        return all_by_block(gains, tf, n_postings, index.size.first()["n"], config)
    tf, idf = _index_slice(index, facts)
    found = rk.postings_of(rk.with_gain(rk.idf_of(terms, idf, facts.small)), tf, facts.small)
    return rk.document_scores(found, index.size.scalar(), config)


def search_terms(
    index: Index, terms: DataFrame, config: SearchConfig = SearchConfig(), facts: TermFacts | None = None
) -> DataFrame:
    """Ranked results for weighted terms.

    With a limit, each query gets its best documents. If those are at most a few
    hundred, their ids become literals for the scan of the documents. Without one, all matches are
    ranked; positions then come from one range sort over all queries.
    """
    facts = facts or measure_terms(terms, index.buckets)
    scores = score_terms(index, terms, config, facts)
    if config.limit is None:
        ordered = with_position(cut_lineage(scores), F.col("query_id"), *rk.result_order())
        first = ordered.groupBy("query_id").agg(F.min("position").alias("first"))
        ranked = lookup_join(ordered, first, ["query_id"], "inner", F.col("doc_id")).select(
            "query_id", "doc_id", "score", (F.col("position") - F.col("first") + 1).alias("rank")
        )
        return rk.ranked_results(ranked, index.documents)
    return _top_results(index, scores, config.limit, facts)


def _top_results(index: Index, scores: DataFrame, limit: int, facts: TermFacts) -> DataFrame:
    ranked = rk.top_ranked(scores, limit)
    most = facts.n_queries * limit
    if most <= _FEW_ROWS:
        rows = ranked.collect()
        found = index.documents.where(F.col("doc_id").isin([r["doc_id"] for r in rows]))
        return rk.ranked_results(found.sparkSession.createDataFrame(rows, ranked.schema), found, small=True)
    return rk.ranked_results(ranked, index.documents, small=most * _RANKED_ROW_BYTES <= BROADCAST_BYTES)


def _gains(index: Index, terms: DataFrame, facts: TermFacts) -> tuple[DataFrame, DataFrame, int]:
    """Terms with their gain, the postings that they can touch, and how many their words have."""
    tf, idf = _index_slice(index, facts)
    gains = cut_lineage(rk.with_gain(rk.idf_of(terms, idf, facts.small)))
    held = lookup_join(idf.select("word", "df"), gains.select("word").distinct(), ["word"], "left_semi", small=facts.small)
    return gains, tf, held.agg(F.coalesce(F.sum("df"), F.lit(0))).first()[0]


def search_in_blocks(
    index: Index, terms: DataFrame, config: SearchConfig = SearchConfig(), facts: TermFacts | None = None
) -> DataFrame:
    """As ``search_terms`` with a limit, without a row per query and posting.

    Facts are looked up once per word, and postings are shuffled once per document instead of
    once per query; only the best documents of each task go on.
    """
    facts = facts or measure_terms(terms, index.buckets)
    gains, tf, n_postings = _gains(index, terms, facts)
    scores = best_by_block(gains, tf, n_postings, index.size.first()["n"], config.limit, config)
    return _top_results(index, scores, config.limit, facts)


def search(
    index: Index,
    queries: DataFrame,
    vectors: DataFrame | None = None,
    lemmas: DataFrame | None = None,
    config: SearchConfig = SearchConfig(),
    index_config: IndexConfig = IndexConfig(),
) -> DataFrame:
    """``queries(query_id, text)`` -> ranked documents of all queries.

    The weighted terms are stored first, and every later decision reads their real size. With a
    limit they are scored in blocks of documents, however many they are, else by a join.
    """
    terms = cut_lineage(expanded_terms(queries, vectors, lemmas, config, index_config))
    facts = measure_terms(terms, index.buckets)
    if config.limit is not None:
        return search_in_blocks(index, terms, config, facts)
    return search_terms(index, terms, config, facts)


def search_one(
    spark: SparkSession,
    index: Index,
    text: str,
    vectors: DataFrame | None = None,
    lemmas: DataFrame | None = None,
    config: SearchConfig = SearchConfig(),
    index_config: IndexConfig = IndexConfig(),
) -> DataFrame:
    """Ranked documents for one query.

    Its terms are no more than the query holds, so they go through the driver.
    """
    queries = spark.createDataFrame([(1, text)], schemas.QUERIES)
    planned = expanded_terms(queries, vectors, lemmas, config, index_config).select("query_id", "word", "weight")
    rows = ix.with_bucket(planned, index.buckets or 1).collect()
    terms = spark.createDataFrame([r[:3] for r in rows], planned.schema)
    buckets = sorted({r["word_bucket"] for r in rows}) if index.buckets else None
    return search_terms(index, terms, config, TermFacts(True, 1, buckets, sorted({r["word"] for r in rows})))


def search_texts(texts: DataFrame, queries: DataFrame, config: SearchConfig = SearchConfig()) -> DataFrame:
    """Rank ``texts(doc_id, text)`` without a stored index, unexpanded, in one plan.

    Only postings of query words leave the scan of the texts.
    """
    terms = cut_lineage(
        distinct_query_tokens(query_tokens(queries), config).select(
            "query_id", F.col("token").alias("word"), F.lit(1.0).alias("weight")
        )
    )
    facts = measure_terms(terms, None)
    tf = ix.term_frequencies(ix.document_tokens(texts))
    wanted = terms.select("word").distinct()
    held = cut_lineage(lookup_join(tf, wanted, ["word"], "left_semi", F.col("doc_id"), small=facts.small))
    idf = ix.inverse_frequencies(held, texts)
    found = rk.postings_of(rk.with_gain(rk.idf_of(terms, idf, facts.small)), held, facts.small)
    scores = rk.document_scores(found, ix.corpus_size(texts).scalar(), config)
    return scores if config.limit is None else rk.top_ranked(scores, config.limit)
