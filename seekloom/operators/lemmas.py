"""Noun lemmas from a lookup table, and a table made from the vocabulary itself."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seekloom.operators.index import DEALT_AT_MOST
from seekloom.operators.joins import SALTS, lookup_join

#: A word has one posting in a document at most, so none holds a large share of them.
POSTING_SALTS = 2


def plural_lemmas(words: DataFrame) -> DataFrame:
    """``(surface, lemma)`` for plurals whose singular is a word as well.

    Endings: -ies to -y, -es after a hiss to nothing, -s to nothing but not after
    -s, -u or -i. The longest ending whose result is in the vocabulary wins.
    """
    word = F.col("word")
    candidates = F.filter(
        F.array(
            F.when(word.rlike("[a-z]{2}ies$"), F.regexp_replace(word, "ies$", "y")),
            F.when(word.rlike("[a-z]{2}(?:s|x|z|ch|sh)es$"), F.regexp_replace(word, "es$", "")),
            F.when(word.rlike("[a-z]{2}[^siu]s$"), F.regexp_replace(word, "s$", "")),
        ),
        lambda c: c.isNotNull(),
    )
    guesses = words.where(word.endswith("s")).select(
        word.alias("surface"), F.posexplode(candidates).alias("rank", "lemma")
    )
    known = guesses.join(words.select(word.alias("lemma")).distinct(), "lemma", "left_semi")
    return known.groupBy("surface").agg(F.min_by("lemma", "rank").alias("lemma"))


def lemmatize(rows: DataFrame, lemmas: DataFrame, word: str = "word", spread: str | None = None, salts: int = SALTS) -> DataFrame:
    """Put the lemma in place of each word that has one."""
    table = lemmas.select(F.col("surface").alias(word), F.lower("lemma").alias("_lemma"))
    joined = lookup_join(rows, table, [word], "left", F.col(spread) if spread else None, salts=salts)
    return joined.withColumn(word, F.coalesce("_lemma", word)).drop("_lemma")


def lemmatize_terms(tf: DataFrame, lemmas: DataFrame, rows_per_task: int | None = None) -> DataFrame:
    """Postings by lemma. Words are looked up once per document, not per occurrence.

    Few postings of a document have their lemma in common, so they are dealt out by both
    first: summed before that, they would only fill memory. With ``rows_per_task``, for stored
    postings, they go to so many tasks that each holds about that number, up to ``DEALT_AT_MOST``.
    """
    tasks = [] if rows_per_task is None else [min(max(1, -(-tf.count() // rows_per_task)), DEALT_AT_MOST)]
    merged = lemmatize(tf.select("word", "doc_id", "tf"), lemmas, spread="doc_id", salts=POSTING_SALTS)
    return merged.repartition(*tasks, "word", "doc_id").groupBy("word", "doc_id").agg(F.sum("tf").alias("tf"))
