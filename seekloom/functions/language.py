"""Language of a text by how often each language's frequent words occur."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.functions.binding import let


def language_words(text: Column) -> Column:
    """Lowercase letter runs of a text."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")


def language_scores(words: Column, profiles: dict[str, tuple[str, ...]] = fv.LANGUAGE_PROFILES) -> list[Column]:
    """One ``struct(hits, lang)`` per profile, for words from :func:`language_words`."""
    return [
        F.struct(
            F.size(F.filter(words, lambda w: w.isin(*profile))).alias("hits"),
            F.lit(lang).alias("lang"),
        )
        for lang, profile in profiles.items()
    ]


def detected_language(text: Column, profiles: dict[str, tuple[str, ...]] = fv.LANGUAGE_PROFILES) -> Column:
    """The language with most hits, the alphabetically last on a tie; null for none."""
    best = let(language_words(text), lambda words: F.array_max(F.array(*language_scores(words, profiles))))
    return let(best, lambda b: F.when(b["hits"] > 0, b["lang"]))
