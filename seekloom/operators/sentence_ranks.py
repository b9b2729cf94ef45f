"""Key sentences of a text: those that share most words with other well connected ones.

Sentences of one text are the nodes of a graph. Two of them are linked by the number of words
they share, over the square root of the product of their numbers of words. Ranks come from
power iteration over that graph. Links are never listed: a step adds up ranks by word and reads
them back by sentence, so a text costs what its words cost, however many sentences it has.
Texts are independent rows, so nothing is shuffled.

Words are runs of letters and digits in lower case, each counted once in a sentence, without
single characters and stop words. A sentence that shares no word has the least rank; equal
ranks are in order of the text. Null and empty texts have no sentences.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from seekloom import fixed_values as fv

#: Ends of sentences: marks before white space, or new lines.
SENTENCE_END = r"[.!?]+(?:\s+|$)|\n+"
WORD_GAP = r"[^\p{L}\p{N}]+"
#: Part of a rank that comes from linked sentences.
DAMPING = 0.85
STEPS = 30
#: Decimals in which ranks are compared.
DECIMALS = 6


def split_sentences(text: Column) -> Column:
    """The sentences of a text, without the marks that end them."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), SENTENCE_END), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def sentence_words(sentences: Column, stop_words: tuple[str, ...] = fv.STOP_WORDS) -> Column:
    """The distinct words of each sentence."""

    def words(sentence: Column) -> Column:
        found = F.array_distinct(F.split(F.lower(sentence), WORD_GAP))
        return F.filter(found, lambda w: (F.length(w) > 1) & ~w.isin(*stop_words))

    return F.transform(sentences, words)


def graph_ranks(text: np.ndarray, sentence: np.ndarray, word: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Ranks of the sentences of several texts at once.

    ``text`` has the text of each sentence, ``sentence`` and ``word`` one entry for each
    distinct word of a sentence. Words of different texts are told apart.
    """
    n = len(text)
    own = text[sentence] * (int(word.max(initial=0)) + 1) + word
    _, node = np.unique(own, return_inverse=True)
    size = np.bincount(sentence, minlength=n)
    scale = 1 / np.sqrt(np.maximum(size, 1))

    def linked(values: np.ndarray) -> np.ndarray:
        """Sum over the other sentences of their value times the link's weight."""
        by_word = np.bincount(node, weights=(scale * values)[sentence])
        return scale * np.bincount(sentence, weights=by_word[node], minlength=n) - values * (size > 0)

    strength = linked(np.ones(n))
    alone = strength < 1e-9
    strength[alone] = 1.0
    rank = np.ones(n)
    for _ in range(steps):
        rank = (1 - DAMPING) + DAMPING * linked(np.where(alone, 0.0, rank / strength))
    rank[alone] = 1 - DAMPING
    return rank


@F.arrow_udf(ArrayType(DoubleType()))
def _ranks(words: pa.Array) -> pa.Array:
    inner = words.flatten()
    codes = pc.dictionary_encode(inner.flatten()).indices.to_numpy(zero_copy_only=False)
    text = pc.list_parent_indices(words).to_numpy(zero_copy_only=False)
    sentence = pc.list_parent_indices(inner).to_numpy(zero_copy_only=False)
    ranks = graph_ranks(text.astype(np.int64), sentence.astype(np.int64), codes.astype(np.int64))
    ends = np.cumsum(pc.list_value_length(words).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(np.append(np.int32(0), ends), pa.int32()), pa.array(ranks))


def sentence_ranks(sentences: Column, stop_words: tuple[str, ...] = fv.STOP_WORDS) -> Column:
    """``array<double>``: the rank of each sentence of ``split_sentences``."""
    return _ranks(sentence_words(sentences, stop_words))


def best_sentences(sentences: Column, ranks: Column, n: int) -> Column:
    """The ``n`` sentences of the highest rank, in the order of the text, as one string."""
    placed = F.arrays_zip(
        F.transform(ranks, lambda r: -F.round(r, DECIMALS)).alias("back"),
        F.transform(ranks, lambda _, i: i).alias("place"),
    )
    chosen = F.array_sort(F.transform(F.slice(F.array_sort(placed), 1, n), lambda p: p["place"]))
    return F.array_join(F.transform(chosen, lambda i: F.concat(F.get(sentences, i), F.lit("."))), " ")


def key_sentences(n: int = 3, stop_words: tuple[str, ...] = fv.STOP_WORDS) -> Callable[[Column], Column]:
    """A summariser that takes the ``n`` sentences of the highest rank from a text."""

    def summarize(text: Column) -> Column:
        sentences = split_sentences(text)
        return best_sentences(sentences, sentence_ranks(sentences, stop_words), n)

    return summarize
