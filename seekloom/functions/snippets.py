"""Summary and snippet expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seekloom import fixed_values as fv
from seekloom.functions.binding import let
from seekloom.functions.text import remove_unicode


def summary_input(text: Column, max_chars: int = 512) -> Column:
    """What a summariser gets to see; null where there is too little of it."""
    head = F.substring(F.coalesce(text, F.lit("")), 1, max_chars)
    return let(head, lambda h: F.when(F.length(h) >= 40, remove_unicode(h)))


def limit_words(text: Column, max_words: int = 20) -> Column:
    """The first words, with ``...`` where there were more; a message for no text."""

    def cut(words: Column) -> Column:
        head = F.array_join(F.slice(words, 1, max_words), " ")
        return F.concat(head, F.when(F.size(words) > max_words, "...").otherwise(""))

    marked = let(F.filter(F.split(text, r"\s+"), lambda w: w != ""), cut)
    return F.when(F.coalesce(text, F.lit("")) == "", fv.NO_TEXT_MESSAGE).otherwise(marked)


def finish_summary(model_input: Column, model_output: Column, max_words: int = 20) -> Column:
    """Summary of a page: a message for too little text, else the limited output."""
    return F.when(model_input.isNull(), fv.SHORT_TEXT_MESSAGE).otherwise(limit_words(model_output, max_words))


def description_snippet(description: Column, max_chars: int = 100) -> Column:
    """Long descriptions are cut and marked; empty ones are hidden (null)."""
    cut = F.concat(F.substring(description, 1, max_chars), F.lit("..."))
    shown = F.when(F.length(description) > max_chars, cut).otherwise(description)
    return F.when(description != "", shown)
