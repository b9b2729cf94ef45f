"""Lemmas that are learned from the words of the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seekloom.catalog import sql
from seekloom.catalog.registry import document_index, query
from seekloom.operators import suffix_rules as sf
from seekloom.operators.lemmas import lemmatize_terms
from seekloom.session import cut_lineage

CONFIG = sf.RuleConfig()
_LETTER = CONFIG.bits_per_letter


def _cuts(shortest: int, longest: int, name: str) -> str:
    return (
        f"SELECT word, left(word, length(word) - k) AS stem, right(word, k) AS {name} "
        f"FROM (SELECT word, unnest(range({shortest}, {longest + 1})) AS k FROM words) WHERE length(word) - k >= {CONFIG.min_stem}"
    )


_LEMMAS = (
    f"{sql.TF}, words AS MATERIALIZED (SELECT DISTINCT word FROM tf), surfaces AS ({_cuts(1, CONFIG.max_ending, 'ending')}), "
    f"lemmas AS ({_cuts(0, CONFIG.max_replacement, 'replacement')}), "
    "matches AS MATERIALIZED (SELECT s.word AS surface, l.word AS lemma, ending, replacement FROM surfaces s JOIN lemmas l USING (stem) "
    "WHERE length(replacement) < length(ending) AND left(replacement, 1) <> left(ending, 1)), "
    "counts AS (SELECT ending, replacement, n, m, letters, n / m AS share FROM (SELECT ending, replacement, count(*) AS n, sum(length(surface)) AS letters "
    "FROM matches GROUP BY ALL) JOIN (SELECT ending, count(*) AS m FROM surfaces GROUP BY ending) USING (ending)), "
    f"rules AS (SELECT ending, replacement, n, m, letters * {_LETTER}::DOUBLE - n * log2((SELECT count(*) FROM words)) "
    "- CASE WHEN n < m THEN m * -(share * log2(share) + (1 - share) * log2(1 - share)) ELSE 0 END "
    f"- (length(ending) + length(replacement) + 2) * {_LETTER}::DOUBLE AS gain FROM counts), "
    f"kept AS (SELECT * FROM rules WHERE n >= {CONFIG.min_words} AND gain > {CONFIG.min_gain}), "
    "learned AS (SELECT surface, lemma FROM matches JOIN kept USING (ending, replacement) "
    "QUALIFY row_number() OVER (PARTITION BY surface ORDER BY round(gain, 6) DESC, length(ending) DESC, ending, replacement) = 1)"
)


def _learned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    words = document_index(spark, folder).words
    matches = sf.rule_matches(words, CONFIG)
    return matches, cut_lineage(sf.suffix_rules(words, matches, CONFIG))


@query("suffix_rules", f"WITH {_LEMMAS} SELECT ending, replacement, n, m, round(gain, 4) AS gain FROM kept")
def suffix_rules(spark: SparkSession, folder: str) -> DataFrame:
    return _learned(spark, folder)[1].withColumn("gain", F.round("gain", 4))


@query("induced_lemmas", f"WITH {_LEMMAS} SELECT surface, lemma FROM learned")
def induced_lemmas(spark: SparkSession, folder: str) -> DataFrame:
    return sf.induced_lemmas(*_learned(spark, folder))


@query(
    "term_frequencies_by_induced_lemmas",
    f"WITH {_LEMMAS} SELECT coalesce(lemma, word) AS word, doc_id, sum(tf)::BIGINT AS tf FROM tf LEFT JOIN learned ON surface = word GROUP BY 1, 2",
)
def term_frequencies_by_induced_lemmas(spark: SparkSession, folder: str) -> DataFrame:
    """Postings by learned lemma."""
    tf = document_index(spark, folder).tf.select("word", "doc_id", "tf")
    found = lemmatize_terms(tf, cut_lineage(sf.induced_lemmas(*_learned(spark, folder))), rows_per_task=1_000_000)
    return found.withColumn("tf", F.col("tf").cast("long"))
