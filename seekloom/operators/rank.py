"""Weighted ranking of documents for many queries in one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekloom.config import SearchConfig
from seekloom.operators.joins import lookup_join


def postings_of(terms: DataFrame, tf: DataFrame, small: bool | None = None) -> DataFrame:
    """Terms with the postings ``(doc_id, tf)`` of their word.

    ``small`` says whether the terms are known to be few; else they are measured.
    """
    return lookup_join(tf, terms, ["word"], "inner", F.col("doc_id"), small=small)


def idf_of(terms: DataFrame, idf: DataFrame, small: bool | None = None) -> DataFrame:
    """Terms with the idf of their word; words that are not indexed vanish."""
    return lookup_join(idf.select("word", "idf"), terms, ["word"], "inner", small=small)


def with_gain(found: DataFrame) -> DataFrame:
    """Terms with ``gain``, their weight times idf, in place of both.

    The product is taken once per term, and one column less is shuffled.
    """
    return found.withColumn("gain", F.col("weight") * F.col("idf")).drop("weight", "idf")


def term_score(gain: Column, tf: Column, matched: Column, n: Column, config: SearchConfig = SearchConfig()) -> Column:
    """Score of one term in one document.

    The length norm is the number of matched terms over the number of documents.
    """
    norm = config.k1 * (1 - config.b + config.b * matched / n)
    return gain * (tf * (config.k1 + 1)) / (tf + norm)


def matched_terms() -> Column:
    """Number of search terms a document holds, on rows of one per term.

    The document comes first in the key: it has more values, so sorting decides
    most comparisons by it alone.
    """
    return F.count("*").over(Window.partitionBy("doc_id", "query_id"))


def term_scores(postings: DataFrame, n: Column, config: SearchConfig = SearchConfig()) -> DataFrame:
    """Add ``matched`` and the weighted ``part`` to ``postings(query_id, doc_id, tf, gain)``."""
    counted = postings.withColumn("matched", matched_terms())
    part = term_score(F.col("gain"), F.col("tf"), F.col("matched"), n, config)
    return counted.withColumn("part", part)


def document_scores(postings: DataFrame, n: Column, config: SearchConfig = SearchConfig()) -> DataFrame:
    """``(query_id, doc_id, score)``. Window and sum share one shuffle."""
    parts = term_scores(postings, n, config)
    return parts.groupBy("doc_id", "query_id").agg(F.sum("part").alias("score"))


def result_order() -> list[Column]:
    """Best score first, then the document.

    Scores are compared rounded far below what matters, so that equal documents tie
    whatever the order in which their parts were added.
    """
    return [F.desc(F.round("score", 10)), F.col("doc_id")]


def top_ranked(scores: DataFrame, limit: int) -> DataFrame:
    """The best documents of each query with their rank; each task keeps at most ``limit``."""
    best = Window.partitionBy("query_id").orderBy(*result_order())
    return scores.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= limit)


def ranked_results(ranked: DataFrame, documents: DataFrame, small: bool = False) -> DataFrame:
    """Join the documents' columns to ranked scores, in result order.

    ``small`` says that the ranked rows are known to be few, so they are sent to
    the documents' scan instead of shuffling the documents.
    """
    results = documents.join(F.broadcast(ranked) if small else ranked, "doc_id")
    return results.orderBy("query_id", "rank")
