"""Key sentences of documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.catalog import sql
from seekloom.catalog.page_queries import _BODY_TEXT
from seekloom.catalog.registry import documents, pages, query
from seekloom.operators import sentence_ranks as sr
from seekloom.operators.html import parse_pages

N_SENTENCES = 3


def _ranks(source: str, key: str) -> str:
    """``rank(key, place, sentence, score)``: the walk over shared words, step by step."""
    return (
        f"WITH RECURSIVE split AS (SELECT {key}, list_filter(list_transform(string_split_regex(coalesce(text, ''), {sql.text(sr.SENTENCE_END)}), "
        f"lambda s: trim(s, ' ')), lambda s: s <> '') AS sentences FROM {source}), "
        f"sentence AS (SELECT {key}, unnest(range(len(sentences))) AS place, unnest(sentences) AS sentence FROM split), "
        f"word AS MATERIALIZED (SELECT {key}, place, unnest(words) AS word, 1 / sqrt(len(words)) AS scale FROM (SELECT {key}, place, "
        f"list_filter(list_distinct(string_split_regex(lower(sentence), {sql.text(sr.WORD_GAP)})), "
        f"lambda w: length(w) > 1 AND NOT list_contains({sql.strings(fv.STOP_WORDS)}, w)) AS words FROM sentence)), "
        f"link AS MATERIALIZED (SELECT a.{key}, a.place, b.place AS other, sum(a.scale * b.scale) AS weight FROM word a JOIN word b "
        f"ON a.{key} = b.{key} AND a.word = b.word AND a.place <> b.place GROUP BY ALL), "
        f"share AS MATERIALIZED (SELECT {key}, place, other, weight / sum(weight) OVER (PARTITION BY {key}, other) AS part FROM link), "
        f"walk AS (SELECT 0 AS step, {key}, place, 1.0::DOUBLE AS score FROM (SELECT DISTINCT {key}, place FROM share) "
        f"UNION ALL SELECT any_value(step) + 1, s.{key}, s.place, {1 - sr.DAMPING} + {sr.DAMPING} * sum(part * score) "
        f"FROM walk JOIN share s ON s.{key} = walk.{key} AND s.other = walk.place WHERE step < {sr.STEPS} GROUP BY s.{key}, s.place), "
        f"rank AS (SELECT {key}, place, sentence, round(coalesce(score, {1 - sr.DAMPING}), {sr.DECIMALS}) AS score "
        f"FROM sentence LEFT JOIN (SELECT * FROM walk WHERE step = {sr.STEPS}) USING ({key}, place)) "
    )


def _summaries(source: str, key: str) -> str:
    return (
        f"{_ranks(source, key)}, best AS (SELECT * FROM rank QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY score DESC, place) <= {N_SENTENCES}) "
        f"SELECT {key}, len(sentences)::BIGINT AS n_sentences, coalesce(summary, '') AS summary FROM split LEFT JOIN "
        f"(SELECT {key}, string_agg(sentence || '.', ' ' ORDER BY place) AS summary FROM best GROUP BY {key}) USING ({key})"
    )


def _summarized(texts: DataFrame, key: str) -> DataFrame:
    split = texts.select(key, sr.split_sentences(F.col("text")).alias("sentences"))
    ranked = split.withColumn("ranks", sr.sentence_ranks(F.col("sentences")))
    return ranked.select(
        key,
        F.size("sentences").cast("long").alias("n_sentences"),
        sr.best_sentences(F.col("sentences"), F.col("ranks"), N_SENTENCES).alias("summary"),
    )


@query("sentence_ranks", f"{_ranks('documents', 'doc_id')} SELECT doc_id, place::INTEGER AS place, score FROM rank")
def sentence_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """The rank of every sentence of every document."""
    split = documents(spark, folder).select("doc_id", sr.split_sentences(F.col("text")).alias("sentences"))
    ranks = split.select("doc_id", F.posexplode(sr.sentence_ranks(F.col("sentences"))).alias("place", "score"))
    return ranks.withColumn("score", F.round("score", sr.DECIMALS))


@query("key_sentence_summaries", _summaries("documents", "doc_id"))
def key_sentence_summaries(spark: SparkSession, folder: str) -> DataFrame:
    return _summarized(documents(spark, folder), "doc_id")


@query("key_sentence_summaries_of_pages", _summaries(f"(SELECT page_id, {_BODY_TEXT} AS text FROM pages)", "page_id"))
def key_sentence_summaries_of_pages(spark: SparkSession, folder: str) -> DataFrame:
    bodies = parse_pages(pages(spark, folder), "body_text").withColumnRenamed("body_text", "text")
    return _summarized(bodies, "page_id")
