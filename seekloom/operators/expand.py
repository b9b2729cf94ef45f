"""Query analysis and expansion with nearest words."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seekloom.config import IndexConfig, SearchConfig
from seekloom.functions.text import analyze
from seekloom.operators.joins import BROADCAST_BYTES, fits_broadcast
from seekloom.operators.lemmas import lemmatize
from seekloom.session import cut_lineage

_NEIGHBOURS = "token string, word string, cos double"


def query_tokens(queries: DataFrame, config: IndexConfig = IndexConfig(), lemmas: DataFrame | None = None) -> DataFrame:
    """``queries(query_id, text)`` -> ``(query_id, pos, token)``; empty queries vanish."""
    tokens = (
        queries.where(F.trim("text") != "")
        .select("query_id", analyze(F.col("text"), config).alias("tokens"))
        .select("query_id", F.posexplode_outer("tokens").alias("pos", "token"))
        .where(F.col("token").isNotNull())
    )
    return tokens if lemmas is None else lemmatize(tokens, lemmas, "token", "query_id")


def synonym_budget(n_tokens: Column, config: SearchConfig = SearchConfig()) -> Column:
    """How many neighbours each token of a query may bring."""
    most, decay = config.max_synonyms, config.synonym_decay
    return F.when(n_tokens <= most, most).otherwise((most * F.exp(-decay * n_tokens)).cast("int"))


def distinct_query_tokens(tokens: DataFrame, config: SearchConfig = SearchConfig()) -> DataFrame:
    """``(query_id, token, budget)``; the budget counts repeated tokens."""
    counted = tokens.groupBy("query_id", "token").agg(F.count("*").alias("n"))
    size = F.sum("n").over(Window.partitionBy("query_id"))
    return counted.select("query_id", "token", synonym_budget(size, config).alias("budget"))


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """``(word, vector)`` scaled to length one, as doubles; zero vectors are left out."""

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            values, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().astype(np.int64)
            sizes = np.diff(ends)
            rows = np.flatnonzero(sizes)
            norms = np.sqrt([float(values[ends[i] : ends[i + 1]] @ values[ends[i] : ends[i + 1]]) for i in rows.tolist()])
            rows, norms = rows[norms > 0], norms[norms > 0]
            scaled = [values[ends[i] : ends[i + 1]] / norm for i, norm in zip(rows.tolist(), norms.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("word").take(pa.array(rows)), pa.array(scaled, pa.list_(pa.float64()))], names=["word", "vector"])

    values = vectors.where(F.col("vector").isNotNull()).select("word", F.col("vector").cast("array<double>").alias("v"))
    return values.mapInArrow(scale, "word string, vector array<double>")


def _neighbour_rows(found: list[tuple[str, str, float]]) -> pd.DataFrame:
    tokens, words, cosines = zip(*found, strict=True) if found else ((), (), ())
    return pd.DataFrame(
        {
            "token": pd.Series(tokens, dtype=object),
            "word": pd.Series(words, dtype=object),
            "cos": pd.Series(cosines, dtype="float64"),
        }
    )


#: Rows of tokens and of words that are multiplied at once; bounds a task's memory.
_TOKEN_TILE, _WORD_TILE = 512, 4_096
#: Cosines are compared after rounding, as their last bits depend on the shape of the product.
_DIGITS = 10
#: A rounded cosine and a word's place make one number, larger for nearer and earlier words.
_PLACE_BITS = 29
_LAST_PLACE = (1 << _PLACE_BITS) - 1
_NONE = np.iinfo(np.int64).min


def _best(tokens: list[str], queries: np.ndarray, words: np.ndarray, vectors: np.ndarray, n: int) -> pd.DataFrame:
    """Per token the n nearest of a block of words, not itself; ties by word.

    Works in tiles and keeps the best so far of each token.
    """
    # Objects, as an array of fixed width would give every word the room of the longest one.
    words = np.array([str(w) for w in words], dtype=object)
    order = np.argsort(words, kind="stable")
    words, vectors = words[order], vectors[order]
    found = []
    for first in range(0, len(tokens), _TOKEN_TILE):
        names = np.array(tokens[first : first + _TOKEN_TILE], dtype=object)
        own = np.searchsorted(words, names)
        own = np.where(words[np.minimum(own, len(words) - 1)] == names, own, -1)
        kept = np.full((len(names), n), _NONE)
        for start in range(0, len(words), _WORD_TILE):
            product = queries[first : first + _TOKEN_TILE] @ vectors[start : start + _WORD_TILE].T
            places = np.arange(start, start + product.shape[1])
            keys = (np.rint(product * 10.0**_DIGITS).astype(np.int64) << _PLACE_BITS) + (_LAST_PLACE - places)
            inside = np.flatnonzero((own >= start) & (own < start + product.shape[1]))
            keys[inside, own[inside] - start] = _NONE
            if keys.shape[1] > n:
                keys = np.partition(keys, keys.shape[1] - n, axis=1)[:, -n:]
            kept = np.concatenate([kept, keys], axis=1)
            if kept.shape[1] > n:
                kept = np.partition(kept, kept.shape[1] - n, axis=1)[:, -n:]
        row, column = np.nonzero(kept != _NONE)
        best = kept[row, column]
        found.append((names[row], words[_LAST_PLACE - (best & _LAST_PLACE)], (best >> _PLACE_BITS) / 10.0**_DIGITS))
    if not found:
        return _neighbour_rows([])
    token, word, cos = (np.concatenate(part) for part in zip(*found, strict=True))
    return pd.DataFrame({"token": token, "word": word, "cos": cos})


def nearest_words(tokens: DataFrame, vectors: DataFrame, n: int, max_bytes: int = BROADCAST_BYTES // 4) -> DataFrame:
    """``(token, word, cos, rank)``: the n nearest words of each distinct token.

    Exact. Every task compares its words with all tokens as one matrix product and
    keeps n per token, so pairs never become rows. The tokens' vectors are sent to
    the tasks if their measured size is small; else tokens and words are both cut
    into blocks and each pair of blocks is one task (``block_count``). A token without a vector has
    no neighbours.
    """
    if n < 1:
        return tokens.sparkSession.createDataFrame([], _NEIGHBOURS + ", rank int")
    # Stored once, as sizes, tokens' vectors and all vectors are read one after the other.
    unit = cut_lineage(unit_vectors(vectors))
    names = tokens.select(F.col("token").alias("name")).distinct()
    wanted = unit.join(names, F.col("word") == F.col("name"), "left_semi")
    size = wanted.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("vector") * 8), F.lit(0)).alias("bytes")).first()
    if size["n"] == 0:
        return tokens.sparkSession.createDataFrame([], _NEIGHBOURS + ", rank int")
    if size["bytes"] <= max_bytes:
        partial = _near_by_broadcast(wanted, unit, n)
    else:
        partial = _near_by_blocks(wanted, unit, n, size["bytes"], max_bytes)
    by_token = Window.partitionBy("token").orderBy(F.desc("cos"), "word")
    return partial.withColumn("rank", F.row_number().over(by_token)).where(F.col("rank") <= n)


def _near_by_broadcast(wanted: DataFrame, unit: DataFrame, n: int) -> DataFrame:
    rows = wanted.collect()
    names = [r["word"] for r in rows]
    sent = unit.sparkSession.sparkContext.broadcast(np.array([r["vector"] for r in rows]))

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield _best(names, sent.value, batch["word"].to_numpy(), np.stack(batch["vector"]), n)

    return unit.mapInPandas(compare, _NEIGHBOURS)


def block_count(size: int, max_bytes: int, tasks: int, block_bytes: int = BROADCAST_BYTES) -> int:
    """Into how many blocks one side of the comparison is cut.

    Each side is copied once for every block of the other, so there are only as many blocks as
    memory needs (``block_bytes`` each), or as give every task a pair; none is smaller than asked.
    """
    needed = max(-(-size // block_bytes), math.isqrt(max(0, tasks - 1)) + 1)
    return max(1, min(-(-size // max_bytes), needed))


def _near_by_blocks(wanted: DataFrame, unit: DataFrame, n: int, token_bytes: int, max_bytes: int) -> DataFrame:
    word_bytes = unit.agg(F.coalesce(F.sum(F.size("vector") * 8), F.lit(0))).first()[0]
    tasks = unit.sparkSession.sparkContext.defaultParallelism
    token_blocks, word_blocks = (block_count(size, max_bytes, tasks) for size in (token_bytes, word_bytes))

    def block(column: str, count: int) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(count)).cast("int")

    def copies(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    left = wanted.withColumn("tb", block("word", token_blocks)).withColumn("wb", copies(word_blocks))
    right = unit.select(
        F.col("word").alias("other"), F.col("vector").alias("values"), block("word", word_blocks).alias("other_wb")
    ).withColumn("other_tb", copies(token_blocks))

    def compare(tokens: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if not len(tokens) or not len(words):
            return _neighbour_rows([])
        return _best(
            list(tokens["word"]), np.stack(tokens["vector"]), words["other"].to_numpy(), np.stack(words["values"]), n
        )

    by_block = right.groupBy("other_tb", "other_wb")
    return left.groupBy("tb", "wb").cogroup(by_block).applyInPandas(compare, _NEIGHBOURS)


def normalize_neighbours(neighbours: DataFrame, lemmas: DataFrame | None = None) -> DataFrame:
    """Lowercase each neighbour, then its noun lemma."""
    lowered = neighbours.withColumn("word", F.lower("word"))
    return lowered if lemmas is None else lemmatize(lowered, lemmas, "word", "token")


def expansion_rows(query_words: DataFrame, neighbours: DataFrame, config: SearchConfig = SearchConfig()) -> DataFrame:
    """``(query_id, token, word, cos)`` that are kept: near enough and not in the query.

    The same word may be there twice, from two tokens or two forms.
    """
    within = query_words.join(neighbours, "token").where(F.col("rank") <= F.col("budget"))
    near = within.where(F.col("cos") > config.min_cosine).select("query_id", "token", "word", "cos")
    own = query_words.select("query_id", F.col("token").alias("word"))
    return near.join(own, ["query_id", "word"], "left_anti")


def expansion_weights(kept: DataFrame) -> DataFrame:
    """``(query_id, word, weight)``: cosine over the number of kept rows of the query."""
    n = F.count("*").over(Window.partitionBy("query_id"))
    return kept.select("query_id", "word", (F.col("cos") / n).alias("weight"))


def token_weights(query_words: DataFrame, neighbours: DataFrame, config: SearchConfig = SearchConfig()) -> DataFrame:
    """``(query_id, word, weight)`` of the tokens: more for those without neighbours."""
    have = neighbours.select("token").distinct().withColumn("found", F.lit(True))
    joined = query_words.join(have, "token", "left")
    expanded = F.coalesce(F.col("found"), F.lit(False)) & (F.col("budget") > 0)
    return joined.select(
        "query_id",
        F.col("token").alias("word"),
        F.when(expanded, 1.0).otherwise(config.unexpanded_weight).alias("weight"),
    )


def search_terms(weights: DataFrame, *more: DataFrame) -> DataFrame:
    """Union of weighted words, one row per query and word."""
    for other in more:
        weights = weights.unionByName(other)
    return weights.groupBy("query_id", "word").agg(F.sum("weight").alias("weight"))


def expanded_terms(
    queries: DataFrame,
    vectors: DataFrame | None,
    lemmas: DataFrame | None = None,
    config: SearchConfig = SearchConfig(),
    index_config: IndexConfig = IndexConfig(),
) -> DataFrame:
    """Queries -> ``(query_id, word, weight)``, with expansion where vectors are given."""
    words = distinct_query_tokens(query_tokens(queries, index_config, lemmas), config)
    if vectors is None:
        return words.select("query_id", F.col("token").alias("word"), F.lit(1.0).alias("weight"))
    near = nearest_words(words, vectors, config.max_synonyms)
    kept = expansion_rows(words, normalize_neighbours(near, lemmas), config)
    return search_terms(token_weights(words, near, config), expansion_weights(kept))
