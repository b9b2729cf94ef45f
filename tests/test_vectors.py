"""Word vectors learned from texts, against numpy on the whole matrix."""

import collections
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seekloom.operators import expand as ex
from seekloom.operators import word_vectors as wv
from seekloom.session import cut_lineage

CONFIG = wv.VectorConfig(window=2, min_count=1, dimensions=6, spare=20, rounds=12)


def plain_counts(texts, window):
    counts = collections.Counter()
    for tokens in texts:
        for i, a in enumerate(tokens):
            for b in tokens[i + 1 : i + 1 + window]:
                counts[a, b] += 1
                counts[b, a] += 1
    return counts


def plain_information(counts, min_count):
    totals = collections.Counter()
    for (a, _), n in counts.items():
        totals[a] += n
    whole = sum(totals.values())
    out = {}
    for (a, b), n in counts.items():
        value = math.log(n * whole / totals[a] / totals[b])
        if value > 0 and totals[a] >= min_count and totals[b] >= min_count:
            out[a, b] = value
    return out


@pytest.fixture(scope="module")
def sentences():
    """Words of two themes; ``alpha`` and ``beta`` always stand in the same company."""
    draw = random.Random(1)
    themes = [[f"one{i}" for i in range(12)], [f"two{i}" for i in range(12)]]
    rows = []
    for i in range(300):
        words = draw.choices(themes[i % 2], k=14)
        if i % 2:
            words[draw.randrange(14)] = draw.choice(["alpha", "beta"])
        rows.append(words)
    return rows


def test_counts_and_information(spark, sentences):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*sentences, [], ["solo"], ["same", "same", "same"]])], "doc_id long, tokens array<string>")
    counts = plain_counts([r.tokens for r in frame.collect()], 2)
    found = wv.cooccurrences(frame, 2)
    assert {(r.word, r.context): r.n for r in found.collect()} == counts
    values = {(r.word, r.context): r.value for r in wv.mutual_information(found, 40, 1.0).collect()}
    expected = plain_information(counts, 40)
    assert values.keys() == expected.keys() and all(abs(values[k] - v) < 1e-12 for k, v in expected.items())


@pytest.mark.parametrize("entries", [40, 10**6])
def test_factors_equal_dense_ones(spark, sentences, entries):
    matrix = plain_information(plain_counts(sentences, 2), 1)
    words = sorted({a for a, _ in matrix})
    dense = np.array([[matrix.get((a, b), 0.0) for b in words] for a in words])
    rows = spark.createDataFrame([(a, b, v) for (a, b), v in matrix.items()], "word string, context string, value double")
    config = wv.VectorConfig(dimensions=6, spare=20, rounds=12, entries_per_block=entries)
    found = {r.word: r.vector for r in wv.factorized(rows, config).collect()}
    vectors = np.array([found[w] for w in words])
    values, own = np.linalg.eigh(dense)
    best = np.argsort(-np.abs(values))[:6]
    expected = own[:, best] * np.sqrt(np.abs(values[best]))
    assert np.allclose(np.abs(vectors), np.abs(expected), atol=1e-6)


def test_planted_words_are_neighbours_and_runs_agree(spark, sentences):
    frame = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(sentences)], "doc_id long, text string")
    config = wv.VectorConfig(window=3, min_count=3, dimensions=4, spare=12, rounds=6)
    vectors = wv.learn_vectors(frame, config)
    again = wv.learn_vectors(frame.repartition(5), config)
    one, two = ({r.word: np.array(r.vector) for r in v.collect()} for v in (vectors, again))
    assert one.keys() == two.keys() and all(np.allclose(one[w], two[w], atol=1e-6) for w in one)
    tokens = spark.createDataFrame([("alpha",), ("one1",)], "token string")
    near = ex.nearest_words(tokens, vectors, 5).collect()
    assert all(r.word.startswith(("two", "beta")) for r in near if r.token == "alpha")
    assert all(r.word.startswith("one") for r in near if r.token == "one1")


def test_nothing_to_learn_from(spark):
    frame = spark.createDataFrame([(1, None), (2, ""), (3, "alone")], "doc_id long, text string")
    assert wv.learn_vectors(frame).collect() == []


def test_blocks_of_nearest_words_do_not_follow_a_small_bound():
    mb = 1024 * 1024
    # 51 MB were cut into 535 blocks of 100 kB, so every vector was copied 535 times.
    assert ex.block_count(51 * mb, 100_000, 12) == 4
    assert ex.block_count(6 * 51 * mb, 100_000, 12) == 5
    assert ex.block_count(500, 600, 12) == 1
    assert ex.block_count(5_000, 600, 100) == 9
    assert ex.block_count(0, 600, 1) == 1


def test_nearest_words_in_blocks_with_a_very_long_word(spark):
    words = [f"w{i}" for i in range(60)] + ["x" * 200_000]
    rows = [(w, [float(i % 7), float(i % 5), 1.0]) for i, w in enumerate(words)]
    frame = spark.createDataFrame(rows, "word string, vector array<double>")
    tokens = frame.select(F.col("word").alias("token"))
    ways = [{tuple(r) for r in ex.nearest_words(tokens, frame, 5, max_bytes=size).collect()} for size in (10**9, 200)]
    assert ways[0] == ways[1] and len(ways[0]) == 5 * len(words)


def test_counts_are_shuffled_once(spark, sentences):
    frame = spark.createDataFrame(list(enumerate(sentences)), "doc_id long, tokens array<string>")
    plan = wv.cooccurrences(frame, 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_partial_rows_grow_with_the_root_of_the_tiles(spark):
    values = np.random.default_rng(1).standard_normal((40, 40))
    entries = spark.createDataFrame([(i, j, float(values[i, j])) for i in range(40) for j in range(40)], "row long, column long, value double")
    dense = np.random.default_rng(2).standard_normal((40, 3))
    block = spark.createDataFrame([(i, dense[i].tolist()) for i in range(40)], "number long, values array<double>")
    # One row came for each of the 16 column blocks and each word.
    assert wv.partial_products(entries, block, 16).count() == 40 * 4
    for blocks in (1, 5, 16):
        found = {r["number"]: r["values"] for r in wv.multiplied(entries, block, blocks).collect()}
        assert np.allclose([found[i] for i in range(40)], values @ dense)


def _disk_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return manager.getAllFiles().size()


def test_stored_rows_leave_no_shuffle_files(spark):
    """They stayed until the driver collected its garbage, so every step of a factorisation added to them."""
    sums = spark.range(1000).groupBy((F.col("id") % 300).alias("k")).count()
    before = _disk_files(spark)
    stored = cut_lineage(sums)
    assert stored.count() == 300
    assert sum(r["count"] for r in sums.collect()) == 1000
    stored = cut_lineage(stored.repartition(5, "k"))
    cut_lineage(stored.groupBy("k").agg(F.sum("count")))
    files = _disk_files(spark)
    cut_lineage(stored.repartition(7, "k"))
    assert _disk_files(spark) <= files
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) != "true" and before >= 0


@pytest.mark.parametrize("at_once", [1, 40, 10**6])
def test_pairs_are_counted_by_texts_not_one_by_one(spark, monkeypatch, at_once):
    draw = random.Random(8)
    texts = [[f"w{draw.randrange(9)}" for _ in range(draw.randrange(12))] for _ in range(40)] + [["é", "z", "é"], [], None]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, tokens array<string>")
    monkeypatch.setattr(wv, "TOKENS_AT_ONCE", at_once)
    expected = plain_counts([t for t in texts if t], 3)
    assert {(r["word"], r["context"]): r["n"] for r in wv.cooccurrences(frame, 3).collect()} == dict(expected)
    stored = wv.cooccurrences(frame, 3, store=True)
    assert {(r["word"], r["context"]): r["n"] for r in stored.collect()} == dict(expected)
    # Each pair was stored in both directions, and a row was made for each pair of places.
    assert spark.read.parquet(*stored.inputFiles()).count() == len({frozenset(pair) for pair in expected})
    assert "explode(slice" not in wv.cooccurrences(frame, 3)._jdf.queryExecution().executedPlan().toString()
